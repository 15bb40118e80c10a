"""Item neighbours and neighbour scores against plain Python."""

import random
from collections import defaultdict
from decimal import Decimal
from math import sqrt

import pytest

from genrec.operators import neighbours
from genrec.plans import catalog
from tests.brute import round3
from tests.conftest import SF001

RATED = "userid int, movieid int, rating double"


def cosines(rows):
    vec = defaultdict(dict)
    for u, m, r in rows:
        if round(r * 100):
            vec[m][u] = round(r * 100)
    out = {}
    for a in vec:
        for b in vec:
            common = vec[a].keys() & vec[b].keys()
            if a != b and common:
                dot = sum(vec[a][u] * vec[b][u] for u in common)
                out[a, b] = len(common), dot / sqrt(float(sum(x * x for x in vec[a].values())) * float(sum(x * x for x in vec[b].values())))
    return out


def best(rows, k, least, min_common):
    lists = defaultdict(list)
    for (a, b), (n, c) in cosines(rows).items():
        if c >= least and n >= min_common:
            lists[a].append((-round3(c, 6), b, n))
    return {(a, i + 1, b, n, -c) for a, xs in lists.items() for i, (c, b, n) in enumerate(sorted(xs)[:k])}


def made(seed, users, movies, heavy):
    """Ratings in which the first ``heavy`` users rate nearly everything and others a few movies of one corner."""
    rng, rows = random.Random(seed), {}
    for u in range(users):
        home = rng.randrange(movies)
        some = rng.sample(range(movies), movies * 9 // 10) if u < heavy else {(home + rng.randrange(8)) % movies for _ in range(rng.randrange(1, 7))}
        for m in some:
            rows[u, m] = rng.choice([0.0, 0.5, 1.0, 3.0, 4.5, 5.0])
    return [(u, m, r) for (u, m), r in rows.items()]


@pytest.mark.parametrize("least, min_common, chunk", [(0.05, 1, 256), (0.5, 1, 7), (0.5, 2, 7), (0.8, 3, 256), (1.0, 1, 256)])
def test_neighbours_equal_brute_force(spark, monkeypatch, least, min_common, chunk):
    """Also with heavy users cut into many chunks, and where bounds leave them out of the index."""
    monkeypatch.setattr(neighbours, "CHUNK", chunk)
    rows = made(11, 150, 90, 2)
    got = neighbours.item_neighbours(spark.createDataFrame(rows, RATED), 5, least, min_common).collect()
    assert {tuple(r) for r in got} == best(rows, 5, least, min_common) and len(got) == len({tuple(r) for r in got})


def test_a_heavy_user_leaves_the_index(spark):
    """One user holds a third of the ratings: movies with other raters do not index that user, and few pairs are met."""
    rng = random.Random(4)
    rows = [(0, m, 1.0) for m in range(400)] + [(1 + m // 4 * 2 + i, m, rng.choice([4.0, 5.0])) for m in range(400) for i in range(2)]
    df = spark.createDataFrame(rows, RATED)
    entries = neighbours._with_weight(neighbours.item_vectors(df))
    bounds = neighbours.movie_bounds(entries, 0.5)
    index = entries.join(bounds, "movieid").where(neighbours._size_class("heavy") <= bounds["cut"])
    assert index.where("userid = 0").count() == 0
    assert neighbours._chunk_pairs(index, 0.5).count() == 100 * 6          # the four movies of a pair of users; 79,800 pairs in all
    got = {tuple(r) for r in neighbours.item_neighbours(df, 10, 0.5).collect()}
    assert got == best(rows, 10, 0.5, 1)


@pytest.mark.parametrize("min_common", [1, 2])
def test_pairs_carry_their_products(spark, min_common):
    """Vectors are not looked up again: the products that form the pairs add up to the dot products."""
    rows = made(3, 60, 40, 0)
    entries = neighbours._with_weight(neighbours.item_vectors(spark.createDataFrame(rows, RATED)))
    pairs = neighbours._chunk_pairs(entries.join(neighbours.movie_bounds(entries, 0.05), "movieid"), 0.05, min_common).collect()
    got = {(p.a, p.b): (p.n_common, p.dot / sqrt(p.n2ab)) for p in pairs if not p.open}
    want = cosines(rows)
    assert len(got) == len(pairs) and all(want[k] == v for k, v in got.items())
    assert {k for k, (n, c) in want.items() if k[0] < k[1] and c >= 0.05 and n >= min_common} <= got.keys()


def test_repeated_rows_count_each_time(spark):
    """Movie 2 has every rating twice; user 2, who rates most, is left out of the index of both movies."""
    rows = [(1, 1, 4.0), (2, 1, 3.0), (2, 3, 1.0)] + [(1, 2, 5.0), (2, 2, 2.0)] * 2
    got = neighbours.item_neighbours(spark.createDataFrame(rows, RATED), 5, 0.02, 2).where("movieid = 1 and neighbour = 2").collect()
    assert [(r.n_common, r.cosine) for r in got] == [(4, round3(2 * 26 / sqrt(25 * 58), 6))]


def test_neighbours_are_written_before_they_are_scored(spark, monkeypatch):
    """The lookups of the scores count requests, so neighbours would be found several times."""
    names, real = [], catalog.stored
    monkeypatch.setattr(catalog, "stored", lambda df, name: names.append(name) or real(df, name))
    catalog.queries()["neighbour_scores"](spark, SF001)
    assert names.count("neighbours") == 1


def test_no_self_join_on_users(spark):
    df = spark.createDataFrame(made(2, 40, 30, 1), RATED)
    plan = neighbours.item_neighbours(df)._jdf.queryExecution().optimizedPlan().toString()
    keys = [line for line in plan.splitlines() if "Join Inner" in line]
    assert keys and not [k for k in keys if "userid" in k and "movieid" not in k and " l#" not in k and "AND" not in k]


def test_edges(spark):
    empty = spark.createDataFrame([], RATED)
    assert neighbours.item_neighbours(empty).count() == 0
    alone = spark.createDataFrame([(1, 1, 4.0), (2, 2, 0.0), (3, 2, 5.0)], RATED)
    assert neighbours.item_neighbours(alone).count() == 0
    for bad in ({"least": 0.0}, {"least": 1.5}, {"min_common": 0}):
        with pytest.raises(ValueError):
            neighbours.item_neighbours(alone, **bad)


@pytest.mark.parametrize("boost", [0.0, 0.5])
def test_scores_equal_brute_force(spark, boost):
    rng = random.Random(6)
    rows = [r for r in made(9, 80, 40, 1) if r[2]]
    genres = {m: rng.sample(["A", "B", "C", "D"], rng.randrange(4)) for m in range(38)}          # two movies are unknown
    movies = spark.createDataFrame([(m, g) for m, g in genres.items()], "movieid int, genres array<string>")
    df = spark.createDataFrame(rows, RATED)
    found = best(rows, 4, 0.1, 1)
    cands = {(u, m) for u in range(80) for m in rng.sample(range(40), 6)}
    sims = {}
    for m, _, j, _, c in found:
        a, b = set(genres.get(m, [])), set(genres.get(j, []))
        share = len(a & b) / len(a | b) if m in genres and j in genres and a | b else 0.0
        sims.setdefault(m, {})[j] = Decimal(repr(round3(c * (1 + boost * share), 6)))
    rated = {(u, m): r for u, m, r in rows}
    want = set()
    for u, m in cands:
        met = [(s, Decimal(repr(rated[u, j]))) for j, s in sims.get(m, {}).items() if (u, j) in rated]
        if met:
            want.add((u, m, len(met), round3(float(sum(s * r for s, r in met)) / float(sum(s for s, _ in met)))))
    asked = spark.createDataFrame(sorted(cands), "userid int, movieid int")
    got = neighbours.neighbour_scores(asked, df, neighbours.boosted(neighbours.item_neighbours(df, 4, 0.1), movies, boost))
    assert {tuple(r) for r in got.collect()} == want and len(want) > 50
