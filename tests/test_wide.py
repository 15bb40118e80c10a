"""A realistic vocabulary: 19 genres, over 1000 favourite sets, hundreds of genre sets."""

import random

from genrec.operators import prep, recommend
from genrec.plans import jobs
from genrec.session import stored
from genrec.sources.views import edition_movies_view, edition_ratings_view, ratings_view
from tests import brute
from tests.conftest import SF001, rows

VOCAB = [f"G{i:02d}" for i in range(19)]


def _data(spark, n_movies=300, n_users=1200, seed=5):
    rnd = random.Random(seed)
    movies = {m: (rnd.choice([1.5, 2.0, 3.25, 3.5, 4.0]), rnd.sample(VOCAB, rnd.randint(1, 5))) for m in range(1, n_movies + 1)}
    fav = {u: rnd.sample(VOCAB, rnd.randint(2, 6)) for u in range(1, n_users + 1)}
    mdf = spark.createDataFrame([(m, a, g) for m, (a, g) in movies.items()],
                                "movieid int, avgrating double, genres array<string>")
    fdf = spark.createDataFrame(list(fav.items()), "userid int, favgenres array<string>")
    return rnd, movies, fav, mdf, fdf


def test_scores_in_the_row(spark):
    rnd, movies, fav, mdf, fdf = _data(spark)
    assert len({tuple(sorted(f)) for f in fav.values()}) > 1000
    pairs = sorted({(rnd.choice(list(fav)), rnd.choice(list(movies))) for _ in range(2000)})
    test = spark.createDataFrame([(u, m, 3.0) for u, m in pairs], "userid int, movieid int, rating double")
    res = jobs.predict(mdf, fdf, test, n=5000)
    w = brute.weights([g for _, g in movies.values()])
    want = sorted((u, m, brute.score(fav[u], movies[m][1], movies[m][0], w)) for u, m in pairs)
    assert rows(res.predictions, "userid", "movieid", "score") == want
    # no table of favourite set x genre set: maps are built from genre sets alone
    plan = res.predictions._jdf.queryExecution().optimizedPlan().toString()
    assert "pkey" not in plan


def test_unseen_with_ties_at_the_cut(spark, monkeypatch):
    monkeypatch.setattr(recommend, "SET_CHUNK", 3)
    rnd, movies, fav, mdf, fdf = _data(spark, n_movies=120, n_users=40, seed=8)
    seen = {u: set(rnd.sample(sorted(movies), rnd.randint(0, 12))) for u in fav}
    training = spark.createDataFrame([(u, m, 4.0, 1, movies[m][1]) for u, s in seen.items() for m in s],
                                     "userid int, movieid int, rating double, timestamp bigint, genres array<string>")
    got = {}
    for r in jobs.recommend_unseen(mdf, fdf, training, n=4).collect():
        got.setdefault(r["userid"], []).append((r["rank"], r["movieid"], r["score"]))
    assert {u: sorted(v) for u, v in got.items()} == brute.unseen_top(movies, fav, seen, 4)


def test_the_movie_table_is_not_broadcast(spark):
    """Its planned size is that of the parts' file, without the editions that are exploded from it."""
    ratings, valid = edition_ratings_view(spark, SF001), prep.valid_movies(edition_movies_view(spark, SF001))
    counts = stored(prep.movie_counts(ratings, valid), "movie-counts")
    for df in (prep.movie_counts(ratings, valid), prep.popular_movie_ratings(ratings, valid, counts=counts)):
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        assert "SortMergeJoin" in plan and "BroadcastHashJoin [movieid" not in plan and "BroadcastHashJoin [cast(movieid" not in plan, plan


def test_orders_are_not_broadcast(spark):
    """Their planned size is two columns of a compressed file: 9 million orders look like less than 10 MB."""
    for view in (ratings_view, edition_ratings_view):
        plan = view(spark, SF001)._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Broadcast" not in plan, plan


def test_editions_are_spelled_after_the_parts_are_dealt(spark):
    """A small parts file is read by one task; genres and filters on them must not be worked on in it."""
    plan = prep.valid_movies(edition_movies_view(spark, SF001))._jdf.queryExecution().executedPlan().toString()
    over, under = plan.split("REPARTITION_BY_COL", 1)
    assert "initcap" in over and "Filter" in over and "initcap" not in under and "Filter " not in under, plan
