import numpy as np
import pytest

from genrec.llm import cover_tree as q

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows):
    """(n_links, smallest id of the component) of each row, by all pairs."""
    ok = [r for r in rows if r[2] is not None and r[1] and all(x is not None and np.isfinite(x) for x in r[1]) and any(r[1])]
    n = {id(r): 0 for r in rows}
    up = {id(r): r[0] for r in rows}
    links = []
    for i, a in enumerate(ok):
        for b in ok[:i]:
            if a[2] != b[2] or len(a[1]) != len(b[1]):
                continue
            x, y = (np.array(v, np.float32).astype(float) for v in (a[1], b[1]))
            if x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= 0.98:
                links.append((a, b))
                n[id(a)] += 1
                n[id(b)] += 1
    for _ in rows:
        for a, b in links:
            up[id(a)] = up[id(b)] = min(up[id(a)], up[id(b)])
    return sorted((r[0], n[id(r)], up[id(r)]) for r in rows)


def vectors(seed=1, n=160, d=6):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, d))
    out = []
    for i in range(n):
        v = centres[i % 12] + rng.normal(size=d) * (0.02 if i % 3 else 0.3)
        out.append((i, (v * (1 + i % 4)).astype(np.float32).tolist(), i % 2))
    return out + [(n, out[0][1], 0), (n + 1, out[0][1], 0)]


@pytest.mark.parametrize("leaf, block", [(4096, 512), (20, 7)])
def test_links_equal_brute_force(spark, monkeypatch, leaf, block):
    monkeypatch.setattr(q, "LEAF", leaf)
    monkeypatch.setattr(q, "BLOCK", block)
    monkeypatch.setattr(q, "SAMPLE", 10)
    rows = vectors()
    got = sorted((r.vec_id, r.n_links, r.component_id) for r in q.near_vectors(spark.createDataFrame(rows, SCHEMA)).collect())
    assert got == brute(rows)
    assert any(n > 3 for _, n, _ in got)


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.0], None), (4, [0.0, 0.0], 1), (5, [nan, 1.0], 1), (6, [inf, 1.0], 1),
            (7, [None, 1.0], 1), (8, None, 1), (9, [], 1), (10, [1.0, 0.0, 0.0], 1), (11, [1.0, 0.0], 2), (12, [-1.0, 0.0], 1),
            (13, [1e-30, 0.0], 1), (13, [1e-30, 0.0], 1), (14, [3e38, 0.0], 1)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "vec_id as node", "label as cell")
    got = sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in q.near_vectors(df).collect())
    assert got == sorted((i, n, c, i == c) for i, n, c in brute(rows))
    assert dict((i, n) for i, n, _, _ in got)[1] == 4
    assert q.near_vectors(spark.createDataFrame([], SCHEMA)).count() == 0


def test_threshold_is_exact():
    a = np.array([[1.0, 0.0]])
    for c in (0.98, 0.9799999999):
        b = np.array([[c, np.sqrt(1 - c * c)]])
        i, _ = q._traverse(q._Tree(a, np.sqrt(0.04)), q._Tree(b, np.sqrt(0.04)), 0.98)
        assert len(i) == (c >= 0.98)
