import random
from collections import Counter, defaultdict

import numpy as np

from genrec.llm import order_minhash as q
from genrec.llm.common import table
from tests.llm.conftest import SF001


def shingles(text):
    w = (text or "").split()
    return [tuple(w[i:i + 5]) for i in range(len(w) - 4)] if len(w) >= 5 else [tuple(w)] if w else []


def brute(texts):
    """Smallest id of each component; pairs by an alignment that need not be banded."""
    def lcs(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            last = 0
            for j, y in enumerate(b):
                last, row[j + 1] = row[j + 1], last + 1 if x == y else max(row[j + 1], row[j])
        return row[-1]

    s = {i: shingles(t) for i, t in texts.items()}
    where = defaultdict(set)
    for i, x in s.items():
        for k in x:
            where[k].add(i)
    up = {i: i for i in texts}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for a, b in {(x, y) for v in where.values() for x in v for y in v if x < y}:
        common = sum((Counter(s[a]) & Counter(s[b])).values())
        if common < 0.8 * (len(s[a]) + len(s[b]) - common):
            continue
        m = lcs(s[a], s[b])
        if m >= 0.8 * (len(s[a]) + len(s[b]) - m) - 1e-9:
            x, y = sorted((root(a), root(b)))
            up[y] = x
    return {i: root(i) for i in texts}


def test_tables_equal_brute_force(spark):
    df = table(spark, SF001, "documents")
    want = brute({r.doc_id: r.text for r in df.collect() if len(r.text or "") < 6000})
    got = {r.doc_id: r.component_id for r in q.classes(df.where("length(text) < 6000")).collect()}
    assert got == want


def _family(n, edits, seed=3, words=150):
    rnd = random.Random(seed)
    base = [f"w{rnd.randint(0, 10 ** 6)}" for _ in range(words)]
    out = [" ".join(base)]
    for _ in range(n):
        copy = base[:]
        for _ in range(rnd.randint(*edits)):
            copy[rnd.randrange(words)] = f"x{rnd.randint(0, 10 ** 6)}"
        out.append(" ".join(copy))
    return out


def test_large_family_and_shared_passage(spark, docs, monkeypatch):
    monkeypatch.setattr(q, "BLOCK_TEXTS", 7)      # many blocks, hub and far texts
    texts = _family(60, (1, 7)) + _family(25, (1, 2), seed=4, words=40)
    passage = " ".join(f"p{i}" for i in range(60))
    rnd = random.Random(9)
    texts += [passage + " " + " ".join(f"q{rnd.randint(0, 10 ** 6)}" for _ in range(50)) for _ in range(40)]
    df = docs([(i, t, "s") for i, t in enumerate(texts)])
    got = {r.doc_id: r.component_id for r in q.classes(df).collect()}
    assert got == brute(dict(enumerate(texts)))


def _sections(n, common, own, seed=11):
    """A text of sections that share a line, without line breaks, as lists of words."""
    rnd = random.Random(seed)
    line = [f"c{i}" for i in range(common)]
    return [line + [f"s{rnd.randint(0, 10 ** 9)}" for _ in range(own)] for _ in range(n)]


def test_sections_with_a_common_line(spark, docs):
    texts = []
    for seed, (n, common, own) in enumerate([(10, 10, 30), (12, 10, 40), (15, 20, 20)]):
        parts = _sections(n, common, own, seed)
        added = _sections(1, common, own, seed + 100)
        texts += [" ".join(sum(x, [])) for x in (parts, parts[1:], added + parts, parts[:-1], parts[4:])]
    got = {r.doc_id: r.component_id for r in q.classes(docs([(i, t, "s") for i, t in enumerate(texts)])).collect()}
    assert got == brute(dict(enumerate(texts)))
    assert got[1] == 0 and got[4] == 4


def test_alignment_of_repeats_equals_plain_lcs():
    rnd = np.random.default_rng(2)
    for _ in range(300):
        a, b = (rnd.integers(0, rnd.integers(2, 40), rnd.integers(1, 60)) for _ in range(2))
        if rnd.random() < 0.7:
            b = np.delete(np.insert(a, rnd.integers(0, len(a), 3), 99), rnd.integers(0, len(a), 2))
        for t in (0.8, 0.5):
            band = int((len(a) + len(b)) * (1 - t) / (1 + t)) + 1
            best = np.zeros((len(a) + 1, len(b) + 1), dtype=int)
            for i, x in enumerate(a):
                for j, y in enumerate(b):
                    best[i + 1, j + 1] = max(best[i, j + 1], best[i + 1, j], best[i, j] + (x == y and abs(i - j) <= band))
            assert q.aligned(a, b, t) == best[-1, -1]
    z = np.zeros(20000, dtype=np.int64)
    assert q.aligned(z, z[:-100]) == 19900


def test_order_matters():
    a = np.arange(100, dtype=np.uint64)
    moved = np.concatenate([a[50:], a[:50]])
    assert q.similar(a, a) and not q.similar(a, moved)
    assert q.aligned(a, moved) < 60


def test_labels_and_recall():
    rnd = np.random.default_rng(5)
    assert len(set(q.labelled(np.array([7, 7, 7, 8])).tolist())) == 4
    missed = 0
    for n in (20, 90, 400):
        for _ in range(60):
            a = rnd.integers(1, 1 << 60, n)
            b = a.copy()
            k = int(n * 0.1)                      # 0.1 n replaced on each side: similarity 0.82
            at = rnd.choice(n, k, replace=False)
            b[at] = rnd.integers(1, 1 << 60, k)
            missed += not set(q.sketch_keys(a)) & set(q.sketch_keys(b))
    assert missed == 0


def test_edges(spark, docs):
    long = "z " * 60000
    rows = [(5, "a b c d e f g", "s"), (3, "a b c d e f g", "s"), (3, "a b c d e f g", "s"), (7, None, "s"), (8, "", "s"), (9, " \n", "s"),
            (None, "a b c d e f g", "s"), (None, "only here now", "s"), (10, "two words", "s"), (11, "two words", None), (12, long, "s")]
    got = sorted((r.doc_id or -1, r.component_id or -1, r.kept) for r in q.classes(docs(rows, ["node", "grp"])).collect())
    assert got == [(-1, -1, True), (-1, 3, False), (3, 3, True), (3, 3, True), (5, 3, False), (7, 7, True), (8, 8, True),
                   (9, 9, True), (10, 10, True), (11, 10, False), (12, 12, True)]
    kept = q.drop_near_copies(docs(rows, ["omh_node"]))
    assert "omh_node" in kept.columns and len(kept.columns) == 6
    assert sorted((r.doc_id or -1) for r in kept.collect()) == [-1, 3, 7, 8, 9, 10, 12]
    assert q.classes(docs([])).count() == 0 and q.drop_near_copies(docs([])).count() == 0
