import hashlib
import random
import re
import zlib

import pytest

from genrec.llm import prefix_trie as q
from genrec.llm.common import table
from tests.llm.conftest import SF001

SCHEMA = "conv_id long, turn long, role string, text string"
COLS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def digest(role, text):
    return hashlib.sha256(f"{len(role)}:{role}:{text}".encode()).hexdigest()[:32]


def brute(rows):
    """The contract, by a dictionary of prefixes."""
    convs = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            convs.setdefault(conv, []).append((turn is not None, turn or 0, digest(role or "", text or ""), role or "", text or ""))
    own = {c: [t[3:] for t in sorted(ts)] for c, ts in convs.items()}
    built = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        built[c] = own.get(c - c % 20, [])[:h] + ts[h:]
    nodes = {}
    for c, ts in built.items():
        for d in range(len(ts) + 1):
            nodes.setdefault(tuple(ts[:d]), []).append(c)
    kids = {p: 0 for p in nodes}
    for p in nodes:
        if p:
            kids[p[:-1]] += 1
    out = set()
    for p, members in nodes.items():
        below = [u for u in nodes if u[:len(p)] == p]
        saved = sum((len(nodes[u]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", u[-1][1])) for u in below if u)
        ends = ",".join(str(c) for c in sorted(members) if len(built[c]) == len(p))
        out.add((min(members), len(p), min(nodes[p[:-1]]) if p else None, len(members), kids[p],
                 sum(kids[u] == 0 for u in below), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return out


def run(df):
    got = [tuple(r) for r in q.trie(df).select(*COLS).collect()]
    assert len(got) == len(set(got))
    return set(got)


def test_equals_brute_force_on_the_table(spark):
    df = table(spark, SF001, "conversations")
    assert run(df) == brute([tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()])


@pytest.mark.parametrize("superblock", [1024, 2])
def test_long_and_shared_conversations(spark, monkeypatch, superblock):
    """Conversations over several column blocks; groups of equal ones; families with a base shorter than the head."""
    monkeypatch.setattr(q, "SUPERBLOCK", superblock)
    rng = random.Random(5)
    rows = []
    for conv in range(60):
        stem = rng.choice([0, 9, 17, 33])
        n = stem + rng.choice([0, 1, 2, 8])
        rows += [(conv, d, "user" if d % 2 else "assistant", f"t{d} x" if d < stem else f"own {rng.randrange(3)}") for d in range(n)]
    rows += [(2000, d, "user", "a long one " + str(d % 5)) for d in range(70)]
    assert run(spark.createDataFrame(rows, SCHEMA)) == brute(rows)


def test_edges(spark):
    long = "w " * 50000
    rows = [(1, None, None, None), (1, 0, "", ""), (2, 0, "user", long), (2, 0, "user", long), (2, None, "user", "a\tb\nc\x0bd"),
            (None, 1, "user", "x"), (3, 5, "u", "ser:x"), (23, 5, "us", "er:x"), (3, 5, "u", "a"), (9007199254740993, 0, "user", "big"),
            (9007199254740992, 0, "user", "big"), (-5, 1, "user", "below"), (40, 0, "user", "base"), (41, 0, "user", "own"),
            (42, 0, "user", None), (55, 0, "s", "")]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "turn as pos", "text as tid", "1 as depth", "2 as b")
    assert run(df) == brute(rows)
    assert run(df.limit(0)) == set()
    assert run(df.where("conv_id = 3")) == brute([r for r in rows if r[0] == 3])


def test_turnless_conversations_are_members_of_the_root(spark):
    # the base is absent and the whole conversation lies within its first h turns
    conv = next(c for c in range(1, 20) if zlib.crc32(str(c).encode()) % 4 == 3)
    rows = [(conv, 0, "user", "a"), (conv, 1, "assistant", "b")]
    nothing = hashlib.sha256(str(conv).encode()).hexdigest()
    assert run(spark.createDataFrame(rows, SCHEMA)) == brute(rows) == {(conv, 0, None, 1, 0, 1, 0, nothing)}
