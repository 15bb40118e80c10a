"""Edge rows (FIXTURES.md §4)."""

import pytest
from pyspark.sql import functions as F

from genrec.operators import model, prep, recommend
from genrec.sources import csv_io
from genrec.session import scratch_dir
from tests.conftest import rows

RATED = "userid int, movieid int, rating double, timestamp bigint, genres array<string>"


def test_valid_movie_rules(spark):
    movies = spark.createDataFrame([
        (1, "Old (1942)", "Drama"), (2, "New (1943)", "Drama"), (3, "No year", "Drama"),
        (4, "Two (1950) (1930)", "Drama"), (5, "Late (1930) (1950)", "Drama"),
        (6, "Imax (2000)", "IMAX"), (7, "Null (2000)", None), (8, "Blank (2000)", "(no genres listed)"),
        (9, "Mixed (2001)", "Comedy|IMAX|Drama|Comedy"),
    ], "movieid int, title string, genres string")
    got = rows(prep.valid_movies(movies), "movieid", "genres", "year")
    assert got == [(2, ["Drama"], 1943), (4, ["Drama"], 1950), (6, [], 2000), (9, ["Comedy", "Drama"], 2001)]


def test_imax_only_movie_has_no_pairs_and_no_score(spark):
    movies = spark.createDataFrame([(1, 4.0, []), (2, 3.0, ["Drama", "Comedy"])],
                                   "movieid int, avgrating double, genres array<string>")
    assert model.genre_pairs(movies).where("movieid = 1").count() == 0
    assert rows(recommend.movie_profiles(movies), "movieid") == [(2,)]


def test_cold_movie_dropped_by_movie_id(spark):
    active = spark.createDataFrame([
        (1, 10, 4.0, 100, ["Drama"], 100, 200), (1, 20, 4.0, 200, ["Drama"], 100, 200),
        (20, 10, 3.0, 100, ["Drama"], 100, 300), (20, 30, 3.0, 300, ["Drama"], 100, 300),
    ], RATED + ", ts_min bigint, ts_max bigint")
    training, test_raw = prep.time_split(active)
    assert rows(prep.cold_movies(training, test_raw)) == [(20,), (30,)]
    assert prep.drop_cold(test_raw, training).count() == 0
    # the user whose id equals a cold movie id keeps their training rows
    assert rows(training, "userid", "movieid") == [(1, 10), (20, 10)]


def test_single_timestamp_user_all_training(spark):
    active = spark.createDataFrame([(1, 10, 4.0, 50, ["Drama"], 50, 50), (1, 11, 2.0, 50, ["Drama"], 50, 50)],
                                   RATED + ", ts_min bigint, ts_max bigint")
    training, test_raw = prep.time_split(active)
    assert training.count() == 2 and test_raw.count() == 0


def test_split_uses_time_span(spark):
    # span 0..100: cut = 80; rows at 80 train, 81 test
    active = spark.createDataFrame([(1, m, 4.0, t, ["Drama"], 0, 100) for m, t in [(1, 0), (2, 80), (3, 81), (4, 100)]],
                                   RATED + ", ts_min bigint, ts_max bigint")
    training, test_raw = prep.time_split(active)
    assert rows(training, "movieid") == [(1,), (2,)] and rows(test_raw, "movieid") == [(3,), (4,)]


def test_fav_share_ties_and_fallback(spark):
    def tr(user, lists):
        return [(user, i, 4.0, i, g) for i, g in enumerate(lists)]
    data = (
        # shares: A 2/5, B 1/5, C 1/5, D 1/5 -> all >= 0.2 -> all four, A first then names
        tr(1, [["A", "B"], ["A", "C"], ["D"]])
        # shares: A 3/6, B 1/6, C 1/6, D 1/6 -> only A >= 0.2 -> top 2: A, then B by name
        + tr(2, [["A", "B"], ["A", "C"], ["A", "D"]])
        # exactly 0.2 twice: X 3/5, Y 1/5, Z 1/5 -> all three
        + tr(3, [["X", "Y"], ["X", "Z"], ["X"]])
    )
    training = spark.createDataFrame(data, RATED)
    got = dict(rows(prep.fav_genres(training)))
    assert got == {1: ["A", "B", "C", "D"], 2: ["A", "B"], 3: ["X", "Y", "Z"]}


def test_norm_zero_single_genre(spark):
    movies = spark.createDataFrame([(1, 4.0, ["Drama"]), (2, 3.0, ["Drama", "Comedy"])],
                                   "movieid int, avgrating double, genres array<string>")
    fav = spark.createDataFrame([(1, ["Drama"])], "userid int, favgenres array<string>")
    cands = spark.createDataFrame([(1, 1)], "userid int, movieid int")
    w = model.genre_weights(movies)
    out = recommend.score_candidates(cands, fav, movies, w).first()
    assert out["score"] == 4.0   # coefficient 1.0, no division by norm 0


def test_user_without_positives_dropped(spark):
    stats = spark.createDataFrame([(1, 0, 1, 2), (2, 3, 1, 2), (3, 3, 1, 2)],
                                  "userid int, n_pos bigint, ts_min bigint, ts_max bigint")
    assert rows(prep.band_users(stats), "userid") == [(2,), (3,)]


def test_equal_scores_lower_id_first(spark):
    scored = spark.createDataFrame([(1, 9, 2.0), (1, 3, 2.0), (1, 5, 1.0)], "userid int, movieid int, score double")
    assert rows(recommend.top_n(scored, 2), "rank", "movieid") == [(1, 3), (2, 9)]


def test_unknown_favourite_genre(spark):
    movies = spark.createDataFrame([(1, 4.0, ["Drama", "Comedy"])], "movieid int, avgrating double, genres array<string>")
    fav = spark.createDataFrame([(1, ["Drama", "Western"])], "userid int, favgenres array<string>")
    test = spark.createDataFrame([(1, 1, 4.0)], "userid int, movieid int, rating double")
    w = model.genre_weights(movies)
    # Drama: norm 1, Drama->Drama 1, Drama->Comedy 1.0 ; Western contributes 0 -> 2 * 4 / 2
    out = recommend.predictions(fav, test, movies, w).first()
    assert out["score"] == 4.0
    with pytest.raises(ValueError, match="Western"):
        model.check_known(fav, movies)


def test_csv_doubled_quotes_and_lists(spark):
    import os
    folder = scratch_dir(spark, "csvtest").removeprefix("file:")
    os.makedirs(folder)
    path = f"{folder}/movies.csv"
    with open(path, "w") as f:
        f.write('movieId,title,genres\n1,"""Great Performances"" Cats (1998)",Musical\n2,Plain (1999),Drama|Comedy\n')
    got = rows(csv_io.read_movies(spark, path))
    assert got == [(1, '"Great Performances" Cats (1998)', "Musical"), (2, "Plain (1999)", "Drama|Comedy")]


def test_prepared_csv_roundtrip(spark):
    training = spark.createDataFrame([(1, 1, 4.0, 5, ["A", "B"]), (1, 2, 3.0, 6, [])], RATED)
    avg = prep.avg_ratings(training)
    fav = prep.fav_genres(training)
    titles = spark.createDataFrame([(1, 'x "q" (2000)')], "movieid int, title string")
    tables = csv_io.export_tables(training, training.limit(0), avg, fav, titles)
    assert rows(tables["training"], "movieid", "genres") == [(1, "A|B|"), (2, "")]
    folder = csv_io.run_folder(scratch_dir(spark, "prep"), small=True, run_id=123)
    assert folder.endswith("/123-small")
    csv_io.write_prepared(tables, folder)
    back = csv_io.read_prepared(spark, folder)
    assert rows(back["training"]) == rows(training)
    assert rows(back["titles"]) == [(1, 'x "q" (2000)')]
    with pytest.raises(Exception):
        csv_io.write_prepared(tables, folder)   # a run folder is written once


def test_schema_check(spark):
    with pytest.raises(ValueError):
        prep.test_ratings(spark.createDataFrame([(1, 2)], "userid int, movieid int"))


def test_parse_malformed_items(spark):
    from genrec.operators import serve
    stored = spark.createDataFrame([(1, "5:4.0|x:y|7:1.5|")], "userid int, recommendations string")
    got = rows(serve.parse_predictions(stored), "rank", "movieid", "score")
    assert got == [(1, 5, 4.0), (2, None, None), (3, 7, 1.5)]


def test_read_predictions_model_check(spark):
    with pytest.raises(ValueError):
        csv_io.read_predictions(spark, "/nowhere", "knn")


def test_csv_rows_do_not_depend_on_the_projection(spark):
    import os
    folder = scratch_dir(spark, "badcsv").removeprefix("file:")
    os.makedirs(folder)
    path = f"{folder}/ratings.csv"
    with open(path, "w") as f:
        # a bad number, a short row, a long row, an empty field, two good rows
        f.write("userId,movieId,rating,timestamp\n1,10,4.0,5\nx,10,4.0,5\n2,10\n3,11,4.0,5,9\n,11,3.5,6\n4,11,2.5,7\n")
    df = csv_io.read_ratings(spark, path)
    want = [(None, 11, 3.5, 6), (1, 10, 4.0, 5), (4, 11, 2.5, 7)]
    assert sorted(map(tuple, df.collect()), key=str) == sorted(want, key=str)
    assert df.count() == 3
    assert df.select("userid").count() == 3 and df.select(F.lit(1)).count() == 3
    assert rows(df.groupBy("movieid").count()) == [(10, 1), (11, 2)]
    assert df.where("movieid = 10").select("rating").collect()[0][0] == 4.0


@pytest.mark.parametrize("name", ["gbcf", "ibcf", "als"])
def test_read_predictions_of_each_model(spark, name):
    root = scratch_dir(spark, "stored")
    df = spark.createDataFrame([(1, "5:4.0|7:1.5"), (2, "")], "userid int, recommendations string")
    csv_io.write_predictions(df, f"{root}/{name}.csv")
    assert rows(csv_io.read_predictions(spark, root, name), "userid") == [(1,), (2,)]


def test_schema_check_types(spark):
    bad = spark.createDataFrame([("1", 2, 3.0)], "userid string, movieid int, rating double")
    with pytest.raises(ValueError, match="userid"):
        prep.test_ratings(bad)
    ok = spark.createDataFrame([(1, 2, 3)], "userid bigint, movieid int, rating int")
    assert rows(prep.test_ratings(ok)) == [(1, 2, 3.0)]


def test_dropped_candidates(spark):
    movies = spark.createDataFrame([(1, 4.0, ["A"]), (2, 4.0, [])], "movieid int, avgrating double, genres array<string>")
    fav = spark.createDataFrame([(1, ["A"]), (2, [])], "userid int, favgenres array<string>")
    cands = spark.createDataFrame([(1, 1), (1, 2), (1, 3), (2, 1), (3, 1)], "userid int, movieid int")
    assert rows(recommend.dropped_candidates(cands, fav, movies)) == [("no_favourites", 2), ("no_genres", 1), ("no_movie", 1)]


def test_seen_movies(spark):
    training = spark.createDataFrame([(1, 1, 4.0, 5, ["A"]), (1, 1, 4.0, 5, ["A"]), (1, 2, 4.0, 5, ["A"])], RATED)
    assert rows(recommend.seen_movies(training)) == [(1, 1), (1, 2)]
    assert rows(recommend.seen_counts(training)) == [(1, 3)]
