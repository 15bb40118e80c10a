"""The merge of genre sets' lists and the bitmaps behind unseen recommendations."""

import random

import pytest

from genrec.operators import model, recommend
from genrec.plans import jobs
from tests import brute

MOVIES = "movieid int, avgrating double, genres array<string>"
TRAINING = "userid int, movieid int, rating double, timestamp bigint, genres array<string>"


def frames(spark, movies, fav, seen):
    return (spark.createDataFrame([(m, a, g) for m, (a, g) in movies.items()], MOVIES),
            spark.createDataFrame(list(fav.items()), "userid int, favgenres array<string>"),
            spark.createDataFrame([(u, m, 4.0, 1, movies[m][1]) for u, s in seen.items() for m in s], TRAINING))


def lists(df):
    out = {}
    for r in df.collect():
        out.setdefault(r.userid, [])
        if r.movieid is not None:
            out[r.userid].append((r["rank"], r.movieid, r.score))
    return {u: sorted(v) for u, v in out.items()}


@pytest.mark.parametrize("first", [1, 4])
def test_only_the_blocks_that_are_needed_are_read(spark, monkeypatch, first):
    """Movies fetched for a favourite set: at most need + equal scores + one block per list read."""
    monkeypatch.setattr(recommend, "SET_CHUNK", first)
    rng = random.Random(first)
    vocab = [f"G{i}" for i in range(9)]
    movies = {m: (rng.randrange(100, 500) / 100, rng.sample(vocab, rng.randint(1, 2))) for m in range(1, 1500)}
    fav = {u: rng.sample(vocab, rng.randint(1, 4)) for u in range(60)}
    seen = {u: set(rng.sample(sorted(movies), rng.randint(0, 9))) for u in fav}
    mdf, fdf, tdf = frames(spark, movies, fav, seen)
    weights = model.genre_weights(mdf)
    assert lists(recommend.unseen_recommendations(fdf, tdf, mdf, weights, 5)) == brute.unseen_top(movies, fav, seen, 5)

    blocks = recommend._set_blocks(mdf)
    need = {}
    for u, g in fav.items():
        key = "|".join(sorted(g))
        need[key] = max(need.get(key, 0), 5 + len(seen[u]))
    profiles = spark.createDataFrame([(k, k.split("|"), v, 1) for k, v in need.items()],
                                     "pkey string, pgenres array<string>, need long, n_users long")
    wanted = recommend.wanted_blocks(profiles, blocks, mdf, weights).where("chunk >= 0")
    read = {}
    for r in wanted.join(blocks, ["skey", "chunk"]).collect():
        read.setdefault(r.pkey, {}).setdefault(r.skey, {}).setdefault(r.chunk, []).append(r.movieid)
    w = brute.weights([g for _, g in movies.values()])
    for key, by_set in read.items():
        scores = sorted((brute.score(key.split("|"), g, a, w) for a, g in movies.values()), reverse=True)
        at_least = sum(s >= scores[need[key] - 1] - 0.001 for s in scores)            # need and equal scores
        last_blocks = sum(len(chunks[max(chunks)]) for chunks in by_set.values())
        fetched = sum(len(ms) for chunks in by_set.values() for ms in chunks.values())
        assert need[key] <= fetched <= at_least + last_blocks
        assert fetched < len(movies) / 2


def test_no_anti_join_in_the_plan(spark):
    movies = {1: (4.0, ["A", "B"]), 2: (3.0, ["B"]), 3: (2.0, ["C"])}
    mdf, fdf, tdf = frames(spark, movies, {1: ["A"], 2: ["B", "A"]}, {1: {1}})
    plan = jobs.recommend_unseen(mdf, fdf, tdf)._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftAnti" not in plan and "Cross" not in plan and "bit_or" in plan


def test_a_user_over_several_bitmaps(spark):
    """One user has rated all but a few of 70,000 movies: a thousand bitmaps, few of which have free ranks."""
    movies = {m: (round(5 - m / 20000, 4), ["A", "B"]) for m in range(70000)}
    free = {40000, 66000, 66001, 69999}
    fav = {1: ["A"], 2: ["B", "A"], 3: ["A"]}
    mdf, fdf, _ = frames(spark, {0: movies[0]}, fav, {1: {0}})
    ids = spark.range(70000).selectExpr("cast(id as int) as movieid")
    mdf = ids.selectExpr("movieid", "round(5 - movieid / 20000, 4) as avgrating", "array('A', 'B') as genres")
    tdf = ids.where(~ids.movieid.isin(*free)).selectExpr("1 as userid", "movieid", "4.0D as rating", "1L as timestamp", "array('A', 'B') as genres")
    got = lists(jobs.recommend_unseen(mdf, fdf, tdf, n=3))
    w = brute.weights([["A", "B"]])
    by_score = sorted(((-brute.score(fav[1], *reversed(movies[m]), w), m) for m in range(70000)))
    for u in fav:
        rest = [(-s, m) for s, m in by_score if u != 1 or m in free][:3] if u != 2 else None
        if rest:
            assert got[u] == [(i + 1, m, s) for i, (s, m) in enumerate(rest)]
