"""Skewed inputs with broadcasts off and AQE skew splitting forced: results
equal brute force.  One user rated every movie, one movie was rated by every
user, and most users share one favourite set."""

import random

import pytest

from genrec.operators import skew
from genrec.plans import jobs
from tests import brute
from tests.conftest import rows

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256",
    "spark.sql.shuffle.partitions": "5",
}


@pytest.fixture
def skewed(spark, monkeypatch):
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    monkeypatch.setattr(skew, "ROWS_PER_TASK", 5)          # salt every key asked for by > 5 rows
    yield
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def _data(seed=3):
    rnd = random.Random(seed)
    vocab = ["A", "B", "C", "D", "E"]
    movies = {m: (rnd.choice([2.0, 3.5, 4.0, 4.5]), rnd.sample(vocab, rnd.randint(1, 3))) for m in range(1, 61)}
    fav = {u: (["A", "C"] if u % 5 else rnd.sample(vocab, 2)) for u in range(1, 41)}
    seen = {u: set(rnd.sample(sorted(movies), rnd.randint(1, 8))) | {1} for u in fav}
    test = {u: set(rnd.sample(sorted(set(movies) - seen[u]), 5)) | ({1} if u % 2 else set()) for u in fav}
    seen[1] = set(movies) - {7, 8, 9}                          # the heavy user
    test[1] = {7, 8, 9}
    return movies, fav, seen, test


def test_skewed_predictions_and_unseen(spark, skewed):
    movies, fav, seen, test = _data()
    mdf = spark.createDataFrame([(m, a, g) for m, (a, g) in movies.items()],
                                "movieid int, avgrating double, genres array<string>")
    fdf = spark.createDataFrame(list(fav.items()), "userid int, favgenres array<string>")
    tr = spark.createDataFrame([(u, m, 4.0, 1, movies[m][1]) for u, s in seen.items() for m in s],
                               "userid int, movieid int, rating double, timestamp bigint, genres array<string>")
    te = spark.createDataFrame([(u, m, 3.0) for u, s in test.items() for m in s],
                               "userid int, movieid int, rating double")
    w = brute.weights([g for _, g in movies.values()])

    got = rows(jobs.predict(mdf, fdf, te, n=3).predictions, "userid", "rank", "movieid", "score")
    expect = []
    for u, ms in test.items():
        scored = sorted(((brute.score(fav[u], movies[m][1], movies[m][0], w), m) for m in ms),
                        key=lambda t: (-t[0], t[1]))[:3]
        expect += [(u, i + 1, m, s) for i, (s, m) in enumerate(scored)]
    assert got == sorted(expect)

    out = {}
    for r in jobs.recommend_unseen(mdf, fdf, tr, n=4).collect():
        out.setdefault(r["userid"], [])
        if r["movieid"] is not None:
            out[r["userid"]].append((r["rank"], r["movieid"], r["score"]))
    assert {u: sorted(v) for u, v in out.items()} == brute.unseen_top(movies, fav, seen, 4)


def _skewed_raw(spark):
    rnd = random.Random(2)
    movies = spark.createDataFrame(
        [(m, f"M{m} ({1950 + m % 60})", "Drama|Comedy" if m % 2 else "Action|Drama") for m in range(1, 120)],
        "movieid int, title string, genres string")
    data = []
    for u in range(2, 400):
        for m in rnd.sample(range(2, 120), rnd.randint(3, 9)):
            data.append((u, m, rnd.choice([2.0, 3.0, 4.0, 5.0]), rnd.randint(1, 1000)))
        data.append((u, 1, 4.0, rnd.randint(1, 1000)))           # movie 1: rated by everyone
    data += [(1, m, 4.0, m * 7) for m in range(1, 120)]           # user 1: rated everything
    return spark.createDataFrame(data, "userid int, movieid int, rating double, timestamp bigint"), movies


def test_prepare_salted_equals_plain(spark, monkeypatch):
    from genrec.operators import prep
    ratings, movies = _skewed_raw(spark)
    plain = prep.prepare(ratings, movies, user_low=0.0, user_high=1.0)
    want = {n: rows(getattr(plain, n)) for n in ("training", "test", "avg_ratings", "fav_genres")}
    monkeypatch.setattr(skew, "ROWS_PER_TASK", 5)
    salted = prep.prepare(ratings, movies, user_low=0.0, user_high=1.0)
    lookup = prep.popular_movie_ratings(ratings, prep.valid_movies(movies))
    plan = lookup._jdf.queryExecution().optimizedPlan().toString()
    assert "xxhash64" in plan
    for n, expect in want.items():
        assert rows(getattr(salted, n)) == expect, n
