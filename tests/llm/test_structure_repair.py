import hashlib
import random
import re
import zlib

import pytest

from genrec.llm import structure_repair as q
from genrec.llm.common import table
from tests.llm.conftest import SF001

SCHEMA = "conv_id long, turn long, role string, text string"
COLS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
WORD = r"[^\x20\x09-\x0D]"


def cheapest(faults, roles, texts):
    """Least (cost, audit, repaired lines) over all edits, by prefixes of rows and what the roles end in."""
    best = {"": (0, "", ())}                     # kept roles' end: "" none, s, u, p (a pair)

    def offer(table, state, value):
        if state not in table or value < table[state]:
            table[state] = value

    def inserted(table):
        for _ in range(3):
            for state, (c, a, o) in list(table.items()):
                role = "assistant" if state == "u" else "user"
                offer(table, "p" if state == "u" else "u", (c + 2, a + "I", (*o, role + ":")))
        return table

    for fault, role, text in zip(faults, roles, texts):
        after = {}
        for state, (c, a, o) in inserted(best).items():
            offer(after, state, (c + 3, a + "D", o))
            if fault in ("blank", "duplicate"):
                continue
            late = int(fault == "truncated")
            to, name = ("p", "assistant") if state == "u" else ("u", "user")
            offer(after, to, (c + 2 + late, a + "R", (*o, f"{name}:{text}")))
            if role[:1] == "s" and state == "":
                offer(after, "s", (c + late, a + "K", (*o, f"{role}:{text}")))
            if role[:1] == name[0]:
                offer(after, to, (c + late, a + "K", (*o, f"{role}:{text}")))
        best = after
    return min(v for state, v in inserted(best).items() if state in ("", "p"))


def brute(rows):
    convs = {}
    for conv, turn, role, text in rows:
        kept = convs.setdefault(conv, [])
        role, text = role if role is not None else " ", text if text is not None else " "
        draw = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if draw == 0:
            continue
        text = "" if draw == 1 else re.sub("[.!?]", "", text) if draw == 2 else text
        role = "user" if draw == 4 else role
        digest = hashlib.sha256(f"{len(role)}:{role}:{text}".encode()).hexdigest()[:32]
        kept += [(turn is not None, turn or 0, digest, role, text, turn)] * (2 if draw == 3 else 1)
    out = set()
    for conv, kept in convs.items():
        kept.sort(key=lambda x: x[:3])
        faults, seen = [], set()
        for x in kept:
            said = re.findall(WORD, x[4])
            faults.append("blank" if not said else "duplicate" if x[3:5] in seen else "" if said[-1] in ".!?" else "truncated")
            seen.add(x[3:5])
        turns = [x[5] for x in kept if x[5] is not None]
        pairs = [a[3][:1] + b[3][:1] for a, b in zip(kept, kept[1:])]
        cost, audit, lines = cheapest(faults, [x[3] for x in kept], [x[4] for x in kept])
        out.add((conv, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *(faults.count(f) for f in (
            "blank", "duplicate", "truncated")), sum(p not in ("su", "ua", "au") for p in pairs), cost, audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return out


def run(df):
    got = [tuple(r) for r in q.repair(df).select(*COLS).collect()]
    assert len(got) == len(set(got))
    return set(got)


def test_equals_brute_force_on_the_table(spark):
    df = table(spark, SF001, "conversations")
    assert run(df) == brute([tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()])


def made(seed, convs, longest):
    rng = random.Random(seed)
    return [(c, t, rng.choice(["system", "user", "user", "assistant", "assistant", "tool"]),
             rng.choice(["Yes.", "No!", "cut off", "", f"row {t}.", f"row {t}"]))
            for c in range(convs) for t in range(rng.randrange(longest)) if rng.random() < 0.9]


@pytest.mark.parametrize("segment, step", [(256, 16), (3, 2)])
def test_many_shapes(spark, monkeypatch, segment, step):
    """Also with conversations cut into segments of three rows."""
    monkeypatch.setattr(q, "SEGMENT", segment)
    monkeypatch.setattr(q, "STEP", step)
    rows = made(segment, 80, 30)
    assert run(spark.createDataFrame(rows, SCHEMA)) == brute(rows)


def test_edges(spark, monkeypatch):
    monkeypatch.setattr(q, "CHUNK", 1000)
    rows = [(1, None, None, None), (1, 3, "user", "a b. " * 20000), (1, 3, "user", "a b. " * 20000), (1, 9, "", "x."), (None, None, "user", "hi."),
            (None, 1, "assistant", "a\U00010000" * 1500 + "."), (2, 0, "system", "only"), (9007199254740993, 9007199254740993, "user", "q?"),
            (9007199254740992, 1, "user", "q?"), (5, 1, "user", "x.\x0b"), (5, 2, "user", "y.\xa0")] + [
            (c, 0, "user", "x.") for c in range(100, 140)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "role as k", "text as tid", "turn as pos", "1 as seg")
    got = run(df)
    assert got == brute(rows)
    assert any(r[7] == "" and r[8] == hashlib.sha256(b"").hexdigest() for r in got)      # a conversation that was dropped
    assert run(df.limit(0)) == set()


def test_auction_prices_are_distances():
    """Converged prices equal the distances by relaxation, for every entry state; the work is linear in the rows."""
    rng = random.Random(3)
    for _ in range(150):
        codes = "".join(rng.choice("suaoSUAOx") for _ in range(rng.randrange(1, 40)))
        exits = q.ENDS if rng.random() < 0.5 else tuple(rng.choice([0, 3, 7, q.NO_WAY]) if s < 2 else rng.randrange(9) for s in q.STATES)
        last = exits == q.ENDS
        arcs, price = q.prices(codes, exits, last, tuple(q.STATES))
        far = [q.NO_WAY] * (len(arcs) - 1) + [0]
        for _ in range(3):
            for at in range(len(arcs) - 2, -1, -1):
                far[at] = min([far[at]] + [min(cost + far[to], q.NO_WAY) for _, cost, to in arcs[at]])
        assert price[:4] == far[:4]
        assert all(price[at] <= cost + price[to] for at, out in enumerate(arcs) for _, cost, to in out)


def test_work_is_linear(monkeypatch):
    looks = []
    real = q.lattice

    class Counted(list):
        def __getitem__(self, i):
            looks.append(i)
            return super().__getitem__(i)

    monkeypatch.setattr(q, "lattice", lambda *a: Counted(real(*a)))
    rng, counts = random.Random(1), []
    for n in (200, 1600):
        looks.clear()
        q.prices("".join(rng.choice("uuaasoUAx") for _ in range(n)), q.ENDS, True, (q.NONE,))
        counts.append(len(looks))
    assert counts[1] < 12 * counts[0]
