"""Best inner products against brute force on given factors."""

import math
import random

import numpy as np
import pytest

from genrec.operators import factors
from genrec.plans import catalog
from tests.conftest import SF001


def brute(users, items, n):
    out = set()
    for u, f in users.items():
        scored = sorted((-math.floor(sum(a * b for a, b in zip(f, g)) * 1e6 + 0.5) / 1e6, m) for m, g in items.items())
        out |= {(u, i + 1, m, -s + 0.0) for i, (s, m) in enumerate(scored[:n])}
    return out


def frames(spark, users, items):
    return (spark.createDataFrame(sorted(users.items()), "userid int, factors array<double>"),
            spark.createDataFrame(sorted(items.items()), "movieid int, factors array<double>"))


def run(spark, users, items, n=5):
    got = [tuple(r) for r in factors.factor_top_n(*frames(spark, users, items), n).collect()]
    assert len(got) == len(set(got))
    return set(got)


def made(seed, n, rank, low=-3):
    rng = random.Random(seed)
    return {i: [rng.randrange(low * 1000, 3000) / 1000 for _ in range(rank)] for i in rng.sample(range(10 * n), n)}


@pytest.mark.parametrize("block, low", [(4, -3), (16, 0), (1024, -3)])
def test_equals_brute_force(spark, monkeypatch, block, low):
    monkeypatch.setattr(factors, "BLOCK", block)
    monkeypatch.setattr(factors, "BROADCAST_BLOCKS", 2)
    users, items = made(1, 40, 3, low), made(2, 90, 3, low)
    assert run(spark, users, items) == brute(users, items, 5)


def test_ties_zeros_and_short_lists(spark, monkeypatch):
    monkeypatch.setattr(factors, "BLOCK", 3)
    users = {1: [0.0, 0.0], 2: [1.0, 0.0], 3: [0.0, -1.0], 4: [2.0, 2.0]}
    items = {m: [[1.0, 0.0], [0.0, 1.0], [0.0, 0.0]][m % 3] for m in range(30, 0, -1)}
    assert run(spark, users, items, 12) == brute(users, items, 12)
    assert run(spark, users, {7: [1.0, 1.0], 5: [2.0, 0.0]}, 10) == brute(users, {7: [1.0, 1.0], 5: [2.0, 0.0]}, 10)
    assert run(spark, users, {}) == set() and run(spark, {}, items) == set()


def test_users_stop_at_the_bound(spark, monkeypatch):
    """Norms fall off, so most blocks are met by nobody."""
    monkeypatch.setattr(factors, "BLOCK", 8)
    met = []
    real = factors._meet
    monkeypatch.setattr(factors, "_meet", lambda opened, blocks, start, end, *a: met.append((end - start, opened.count())) or real(
        opened, blocks, start, end, *a))
    items = {m: [4.0 / (1 + m // 8), 1.0 / (1 + m // 8)] for m in range(800)}
    users = {u: [1.0 + u / 10, 1.0] for u in range(20)}
    assert run(spark, users, items) == brute(users, items, 5)
    assert sum(blocks for blocks, _ in met) <= 4 and len(met) < 4          # of 100 blocks


def test_rounds_are_broadcast_whole(spark, monkeypatch):
    """No round has more blocks than may be broadcast, and the bar keeps later blocks from giving n rows each."""
    monkeypatch.setattr(factors, "BLOCK", 8)
    monkeypatch.setattr(factors, "BROADCAST_BLOCKS", 3)
    met = []
    real = factors._meet
    monkeypatch.setattr(factors, "_meet", lambda opened, blocks, start, end, *a: met.append((start, end)) or real(opened, blocks, start, end, *a))
    users, items = made(5, 20, 2), {m: [1.0 + m % 7 / 10, -1.0 - m % 5 / 10] for m in range(120)}
    assert run(spark, users, items) == brute(users, items, 5)
    assert met[:4] == [(0, 1), (1, 2), (2, 4), (4, 7)] and max(end - start for start, end in met) == 3


def test_trained_factors(spark):
    c = catalog._Ctx(spark, SF001)
    users, items = factors.als_factors(c.p.training, rank=4, iterations=3)
    given = [{r[0]: list(r[1]) for r in f.collect()} for f in (users, items)]
    got = {(r.userid, r.rank): (r.movieid, r.score) for r in factors.factor_top_n(*frames(spark, *given), 5).collect()}
    want = {(u, i): (m, s) for u, i, m, s in brute(*given, 5)}
    # products that differ in the last digit of the sum may round apart
    assert got.keys() == want.keys()
    assert all(abs(got[k][1] - want[k][1]) < 2e-6 for k in want)
    assert catalog.queries()["als_top_n"](spark, SF001).count() == len(given[0])


def in_one_group(users, items, n, size=None):
    """``_meet_round`` by hand: users (a matrix) against blocks of ``size`` movies, best norms first."""
    order = np.argsort(-np.linalg.norm(items, axis=1), kind="stable")
    best = factors._Best(users, np.full((len(users), n), np.iinfo("i4").max, "i4"), np.full((len(users), n), -np.inf), 1e6)
    for at in np.split(order, range(size, len(items), size)) if size else [order]:
        inside, centres, parts = factors._parts(items[at])
        assert parts["size"].sum() == len(at) and sorted(inside) == list(range(len(at)))
        factors._meet_round(best, [[at[inside].astype("i4"), items[at][inside].ravel(), centres.ravel(), parts, np.linalg.norm(items[at[0]])]])
    return best


def by_matrix(users, items, n):
    scores = np.floor((users @ items.T) * 1e6 + 0.5) / 1e6
    ids = np.lexsort((np.broadcast_to(np.arange(len(items)), scores.shape), -scores))[:, :n]
    return ids, np.take_along_axis(scores, ids, axis=1)


@pytest.mark.parametrize("kind", ["normal", "equal norms", "far apart norms", "copies", "one direction", "few"])
@pytest.mark.parametrize("size", [None, 500])
def test_parts_lose_no_product(kind, size):
    rng = np.random.default_rng(3)
    users, items = np.round(rng.normal(size=(150, 6)), 3), np.round(rng.normal(size=(3000, 6)), 3)
    if kind == "equal norms":
        items = np.round(2 * items / np.linalg.norm(items, axis=1, keepdims=True), 3)
    elif kind == "far apart norms":
        items = np.round(items, 1) * 10.0 ** rng.integers(-2, 5, (3000, 1))
    elif kind == "copies":
        items = items[rng.integers(0, 20, 3000)]
    elif kind == "one direction":
        items = np.outer(np.round(rng.normal(size=3000), 2), [1.0, -2.0, 0.0, 0.0, 1.0, 3.0])
    elif kind == "few":
        items = items[:7]
    best = in_one_group(users, items, 10, size)
    ids, scores = by_matrix(users, items, 10)
    found = best.scores[:, :ids.shape[1]]
    assert np.allclose(found, scores, rtol=1e-12, atol=1e-6 + 1e-9)
    if kind != "far apart norms":                               # there the last digit of a sum may round apart
        assert np.array_equal(best.ids[:, :ids.shape[1]], ids) and np.array_equal(found, scores)


def test_equal_norms_do_not_form_all_products():
    """Trained factors have about equal norms, so the order by norm alone leaves nearly all products."""
    rng = np.random.default_rng(5)
    users, items = rng.normal(size=(300, 5)), rng.normal(size=(20000, 5))
    items *= 2 / np.linalg.norm(items, axis=1, keepdims=True)
    best = in_one_group(users, items, 10)
    assert np.allclose(best.scores, by_matrix(users, items, 10)[1], atol=2e-6)
    assert best.formed < len(users) * len(items) / 10


def test_factors_that_are_not_finite():
    rng = np.random.default_rng(7)
    users, items = np.round(rng.normal(size=(40, 3)), 3), np.round(rng.normal(size=(400, 3)), 3)
    items[[5, 9]], users[4] = math.nan, math.nan
    items[11] = math.inf, 0.0, 0.0
    users[:, 0] = np.abs(users[:, 0]) + 1
    best = in_one_group(users, items, 5)
    fine = [u for u in range(40) if u != 4]
    assert np.all(best.scores[4] == -np.inf) and np.all(best.ids[fine, 0] == 11)
    others = [m for m in range(400) if m not in (5, 9, 11)]
    ids, scores = by_matrix(users[fine], items[others], 4)
    assert np.array_equal(best.ids[fine, 1:], np.array(others)[ids]) and np.array_equal(best.scores[fine, 1:], scores)


def test_many_groups_and_blocks(spark, monkeypatch):
    """Groups of few users, which close at different rounds."""
    monkeypatch.setattr(factors, "BLOCK", 16)
    monkeypatch.setattr(factors, "GROUP", 4)
    rng = random.Random(4)
    users = {u: [rng.randrange(1, 3000) / 1000, rng.randrange(1, 3000) / 1000 if u % 3 else 0.001] for u in range(60)}
    items = {m: [rng.randrange(0, 1000) / 1000 * 0.9 ** (m % 40), 3 * (m % 7) / 10] for m in range(300)}
    items = {m: [round(a, 3), round(b, 3)] for m, (a, b) in items.items()}
    assert run(spark, users, items) == brute(users, items, 5)


def test_blocks_of_long_factors_are_small(spark, monkeypatch):
    """A block is never more than a round may broadcast."""
    monkeypatch.setattr(factors, "BROADCAST_DOUBLES", 64)
    blocks = factors.item_blocks(spark.createDataFrame(sorted(made(8, 30, 10).items()), "movieid int, factors array<double>"))
    assert [r.width for r in blocks.collect()] == [60] * 5
