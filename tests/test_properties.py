"""Properties over the driver's sf0.001 tables and random small inputs."""

import random

import pytest
from pyspark.sql import functions as F

from genrec.operators import model, prep, recommend, serve
from genrec.operators.rank import group_rank
from genrec.plans import catalog, jobs
from tests import brute
from tests.conftest import SF001, rows


@pytest.fixture(scope="module")
def prepared(spark):
    return jobs.prepared_from_tables(spark, SF001)


def test_split_is_a_partition(prepared):
    active = rows(prepared.ratings.select("userid", "movieid"))
    tr, te = prep.time_split(prepared.ratings)
    a, b = rows(tr.select("userid", "movieid")), rows(te.select("userid", "movieid"))
    assert sorted(a + b) == active and not set(a) & set(b)


def test_test_movies_in_training(prepared):
    assert prepared.test.join(prepared.training.select("movieid"), "movieid", "left_anti").count() == 0


def test_weights_rows_sum_to_one(prepared):
    w = model.genre_weights(prepared.avg_ratings, digits=None)
    assert all(abs(r[1] - 1) < 1e-9 for r in w.groupBy("genre_a").sum("weight").collect())


def test_predictions_at_most_n(prepared):
    res = jobs.predict(prepared.avg_ratings, prepared.fav_genres, prepared.test, n=3)
    assert res.predictions.groupBy("userid").count().where("count > 3").count() == 0


def test_export_parse_roundtrip(prepared):
    res = jobs.predict(prepared.avg_ratings, prepared.fav_genres, prepared.test)
    back = serve.parse_predictions(res.stored)
    assert rows(back) == rows(recommend.clip_scores(res.predictions).select("userid", "rank", "movieid", "score"))


def test_unseen_disjoint_from_seen(prepared):
    out = jobs.recommend_unseen(prepared.avg_ratings, prepared.fav_genres, prepared.training)
    assert out.where("movieid is not null").join(
        prepared.training, ["userid", "movieid"], "left_semi").count() == 0
    assert out.groupBy("userid").count().where("count > 10").count() == 0


def test_independent_of_partition_count(spark):
    q = catalog.queries()["predictions"]
    base = rows(q(spark, SF001))
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        assert rows(q(spark, SF001)) == base
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_group_rank_matches_row_number(spark):
    rnd = random.Random(7)
    # one hot group with most rows, ties on score broken by id
    data = [("hot" if rnd.random() < 0.7 else f"g{rnd.randint(0, 5)}", i, float(rnd.randint(0, 20)))
            for i in range(3000)]
    df = spark.createDataFrame(data, "g string, id int, score double")
    got = rows(group_rank(df, ["g"], [F.col("score").desc(), F.col("id").asc()], partitions=7), "g", "id", "rank")
    expect = []
    by = {}
    for g, i, s in data:
        by.setdefault(g, []).append((-s, i))
    for g, items in by.items():
        for r, (_, i) in enumerate(sorted(items), 1):
            expect.append((g, i, r))
    assert got == sorted(expect)
    one = rows(group_rank(df.select("id"), [], [F.col("id").asc()], partitions=5), "id", "rank")
    assert one == [(i, i + 1) for i in range(3000)]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_unseen_matches_brute_force(spark, seed):
    rnd = random.Random(seed)
    vocab = ["A", "B", "C", "D", "Solo"]
    movies = {}
    for m in range(1, 41):
        k = rnd.randint(0, 3)
        g = rnd.sample(vocab[:4], k) if rnd.random() < 0.8 else ["Solo"]
        movies[m] = (rnd.choice([1.5, 2.0, 3.5, 4.0, 4.5, 2.75]), g)
    fav = {u: (rnd.sample(vocab, rnd.randint(1, 3)) if u != 9 else ["Solo"]) for u in range(1, 13)}
    seen = {u: set(rnd.sample(sorted(movies), rnd.randint(0, 38))) for u in fav}
    seen[5] = set(movies)            # nothing left to recommend
    n = 6
    mdf = spark.createDataFrame([(m, a, g) for m, (a, g) in movies.items()],
                                "movieid int, avgrating double, genres array<string>")
    fdf = spark.createDataFrame(list(fav.items()), "userid int, favgenres array<string>")
    tdf = spark.createDataFrame([(u, m, 4.0, 1, movies[m][1]) for u, s in seen.items() for m in s],
                                "userid int, movieid int, rating double, timestamp bigint, genres array<string>")
    got = {}
    for r in jobs.recommend_unseen(mdf, fdf, tdf, n).collect():
        got.setdefault(r["userid"], [])
        if r["movieid"] is not None:
            got[r["userid"]].append((r["rank"], r["movieid"], r["score"]))
    expect = brute.unseen_top(movies, fav, seen, n)
    assert {u: sorted(v) for u, v in got.items()} == expect


def test_scores_match_brute_force(spark):
    rnd = random.Random(11)
    vocab = ["A", "B", "C", "D", "E"]
    movies = {m: (rnd.choice([1.5, 3.0, 4.5, 3.25]), rnd.sample(vocab, rnd.randint(1, 4))) for m in range(1, 30)}
    fav = {u: rnd.sample(vocab, rnd.randint(1, 3)) for u in range(1, 9)}
    cands = [(u, m) for u in fav for m in rnd.sample(sorted(movies), 8)]
    mdf = spark.createDataFrame([(m, a, g) for m, (a, g) in movies.items()],
                                "movieid int, avgrating double, genres array<string>")
    fdf = spark.createDataFrame(list(fav.items()), "userid int, favgenres array<string>")
    cdf = spark.createDataFrame(cands, "userid int, movieid int")
    got = rows(recommend.score_candidates(cdf, fdf, mdf, model.genre_weights(mdf)))
    w = brute.weights([g for _, g in movies.values()])
    expect = sorted((u, m, brute.score(fav[u], movies[m][1], movies[m][0], w)) for u, m in cands)
    assert got == expect


def test_written_prepared_equals_lazy(spark, prepared):
    from genrec.session import scratch_dir
    from genrec.sources.views import movies_view, ratings_view
    folder = scratch_dir(spark, "prep-test")
    jobs.write_prepared(spark, ratings_view(spark, SF001), movies_view(spark, SF001), folder)
    d = jobs.read_prepared(spark, folder)
    for name in ("training", "test", "avg_ratings", "fav_genres", "titles"):
        assert rows(d[name]) == rows(getattr(prepared, name).select(*d[name].columns)), name


def test_explode_ranks_chunks(spark):
    df = spark.createDataFrame([(1, "p", 7), (2, "q", 1), (3, "p", 3)], "userid int, pkey string, upto bigint")
    got = rows(recommend.explode_ranks(df, chunk=3), "userid", "pkey", "rank")
    assert got == sorted([(1, "p", r) for r in range(1, 8)] + [(2, "q", 1)] + [(3, "p", r) for r in range(1, 4)])


def test_id_rank(spark):
    from genrec.operators import rank as R
    ids = [5, 3, 70000, 65535, 65536, 1, 200000, 3]
    df = spark.createDataFrame([(i,) for i in ids], "movieid int")
    got = rows(R.id_rank(df, "movieid"), "movieid", "rank")
    assert got == [(m, r) for r, m in enumerate(sorted(set(ids)), 1)]


def test_exact_scores_match_brute_force(spark):
    rnd = random.Random(5)
    vocab = ["A", "B", "C", "D"]
    movies = {m: (rnd.choice([1.5, 3.0, 4.5, 3.25]), rnd.sample(vocab, rnd.randint(1, 4))) for m in range(1, 40)}
    fav = {u: rnd.sample(vocab, rnd.randint(1, 3)) for u in range(1, 7)}
    test = [(u, m, 4.0) for u in fav for m in rnd.sample(sorted(movies), 12)]
    mdf = spark.createDataFrame([(m, a, g) for m, (a, g) in movies.items()],
                                "movieid int, avgrating double, genres array<string>")
    fdf = spark.createDataFrame(list(fav.items()), "userid int, favgenres array<string>")
    tdf = spark.createDataFrame(test, "userid int, movieid int, rating double")
    got = rows(jobs.predict(mdf, fdf, tdf, n=20, exact=True).predictions, "userid", "movieid", "score")
    w = brute.weights([g for _, g in movies.values()], exact=True)
    expect = sorted((u, m, brute.score_exact(fav[u], movies[m][1], movies[m][0], w)) for u, m, _ in test)
    assert got == expect


def test_written_predictions(spark, prepared):
    from genrec.session import scratch_dir
    folder = scratch_dir(spark, "pred-test")
    acc = jobs.write_predicted(spark, prepared.avg_ratings, prepared.fav_genres, prepared.test, folder)
    res = jobs.predict(prepared.avg_ratings, prepared.fav_genres, prepared.test)
    assert rows(spark.read.parquet(f"{folder}/stored")) == rows(res.stored)
    assert acc == res.accuracy.first()


def test_salted_lookup_matches_join(spark):
    from genrec.operators.skew import salted_lookup
    rnd = random.Random(9)
    req = spark.createDataFrame([(u, "hot" if rnd.random() < 0.8 else f"k{rnd.randint(0, 4)}", rnd.randint(1, 3))
                                 for u in range(500)], "userid int, pkey string, rank int")
    table = spark.createDataFrame([(k, r, f"{k}-{r}") for k in ["hot"] + [f"k{i}" for i in range(4)]
                                   for r in range(1, 3)], "pkey string, rank int, movie string")
    got = rows(salted_lookup(req, table, ["pkey", "rank"], "userid", rows_per_task=20))
    want = rows(req.join(table, ["pkey", "rank"]))
    assert got == want and len(got) > 0


def test_salted_left_lookup_matches_join(spark):
    from genrec.operators.skew import salted_lookup
    req = spark.createDataFrame([(u, "hot" if u % 4 else "missing") for u in range(200)], "userid int, pkey string")
    table = spark.createDataFrame([("hot", 1.5), ("other", 2.0)], "pkey string, aff double")
    got = rows(salted_lookup(req, table, ["pkey"], "userid", rows_per_task=10, how="left"), "userid", "pkey", "aff")
    assert got == rows(req.join(table, ["pkey"], "left"), "userid", "pkey", "aff")
