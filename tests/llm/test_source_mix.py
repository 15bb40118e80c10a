import heapq
import random
import re
from collections import defaultdict

import pytest

from genrec.llm import source_mix as q


def size(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def brute_targets(sizes):
    order = sorted((s for s in sizes if s is not None), key=lambda s: s) + ([None] if None in sizes else [])
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total, capped = sum(sizes.values()), set()
    while True:
        rest = total - sum(3 * sizes[s] for s in capped)
        w = sum(weight[s] for s in sizes if s not in capped) or 1
        target = {s: 3.0 * sizes[s] if s in capped else rest * weight[s] / w for s in sizes}
        more = {s for s in sizes if s not in capped and target[s] > 3 * sizes[s]}
        if not more:
            return target
        capped |= more


def corpus(seed=3):
    rnd = random.Random(seed)
    rows = [(0, None, "b"), (1, "", None), (2, " \n", "tiny"), (3, "z " * 30000, "é"), (4, "dup dup", "b"), (4, "dup dup", "b"), (None, "q r s", "")]
    for i in range(5, 400):
        source = rnd.choice(["hot"] * 6 + ["a", "b", "c", "é", None, "", "tiny"])
        rows.append((i, " ".join("w" for _ in range(rnd.randint(1, 8 if source == "tiny" else 200))), source))
    return rows


@pytest.fixture(scope="module")
def mixed(spark):
    rows = corpus()
    df = spark.createDataFrame([(i, t, "en", s, 0) for i, t, s in rows], "doc_id long, text string, lang string, source string, n_chars long")
    df = df.selectExpr("*", "source as target", "1 as mix")
    return rows, df, q.mix(df).collect()


def test_sizes_and_targets(mixed):
    rows, _, got = mixed
    sizes = defaultdict(int)
    for _, t, s in rows:
        sizes[s] += size(t)
    want = brute_targets(sizes)
    source = {i: s for i, _, s in rows}
    assert len(got) == len(rows)
    for r in got:
        assert r.source_size == sizes[source[r.doc_id]]
        assert r.target == pytest.approx(want[source[r.doc_id]])
    assert sum(want.values()) == pytest.approx(sum(sizes.values()))
    assert any(t == 3 * sizes[s] and t for s, t in want.items())


def test_taken_is_near_the_target(mixed):
    rows, df, got = mixed
    source, taken, target = {i: s for i, _, s in rows}, defaultdict(int), {}
    for r in got:
        assert 0 <= r.taken <= 3 * r.size
        taken[source[r.doc_id]] += r.taken
        target[source[r.doc_id]] = r.target
    for s, t in target.items():
        assert abs(taken[s] - t) <= 2 * q.BLOCK_WORDS, s
    assert sorted(map(tuple, q.mix(df.repartition(5)).collect()), key=str) == sorted(map(tuple, got), key=str)


def test_documents_of_the_mix(mixed):
    rows, df, got = mixed
    out = q.mixed_documents(df)
    assert out.columns == df.columns
    words = defaultdict(int)
    for r in out.collect():
        words[r.doc_id] += size(r.text)
        assert r.n_chars == len(r.text)
    want = defaultdict(int)
    for r in got:
        want[r.doc_id] += r.taken
    assert words == {k: v for k, v in want.items() if v}


def test_quota_equals_highest_quotients():
    """floor(weight / block + 1/2) seats: the seats that a heap gives out by highest quotient."""
    rnd = random.Random(8)
    weights = [rnd.uniform(1, 5000) for _ in range(40)]
    quotas = [int(w / q.BLOCK_WORDS + 0.5) for w in weights]
    heap = [(-w, i, 0) for i, w in enumerate(weights)]
    heapq.heapify(heap)
    seats = [0] * 40
    for _ in range(sum(quotas)):
        _, i, k = heapq.heappop(heap)
        seats[i] += 1
        heapq.heappush(heap, (-weights[i] / (2 * k + 3), i, k + 1))
    assert seats == quotas


def test_block_steps_are_permutations():
    for n in list(range(1, 200)) + [1563, 7919, 2053 * 4]:
        step = next(s for s in q.STEPS if n % s) if n > 1 else 1
        assert len({step * j % n for j in range(n)}) == n


def test_edges(spark, docs):
    assert q.mix(docs([])).count() == 0 and q.mixed_documents(docs([])).count() == 0
    blank = docs([(1, None, None), (2, " ", "a")])
    assert sorted((r.doc_id, r.size, r.source_size, r.target, r.taken) for r in q.mix(blank).collect()) == [(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)]
    assert q.mixed_documents(blank).count() == 0
