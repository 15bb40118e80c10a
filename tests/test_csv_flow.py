"""Raw CSV sources (O1/O2) through the prepare job equal the parquet path."""

from genrec.plans import jobs
from genrec.session import scratch_dir
from genrec.sources import csv_io
from genrec.sources.views import movies_view, ratings_view
from tests.conftest import SF001, rows


def test_prepare_from_csv_equals_views(spark):
    raw = scratch_dir(spark, "raw")
    csv_io.write_csv(movies_view(spark, SF001), f"{raw}/movies.csv")
    csv_io.write_csv(ratings_view(spark, SF001), f"{raw}/ratings.csv")
    from_csv = scratch_dir(spark, "from-csv")
    jobs.write_prepared(spark, csv_io.read_ratings(spark, f"{raw}/ratings.csv"),
                        csv_io.read_movies(spark, f"{raw}/movies.csv"), from_csv)
    from_views = scratch_dir(spark, "from-views")
    jobs.write_prepared(spark, ratings_view(spark, SF001), movies_view(spark, SF001), from_views)
    a, b = jobs.read_prepared(spark, from_csv), jobs.read_prepared(spark, from_views)
    for name in jobs.PREPARED_TABLES:
        assert rows(a[name]) == rows(b[name]), name


def test_predictions_from_prepared_csv(spark):
    """Job A written as CSV (the original hand-off format) and read back gives
    the same predictions as the parquet hand-off."""
    p = jobs.prepared_from_tables(spark, SF001)
    folder = csv_io.run_folder(scratch_dir(spark, "prepared-csv"))
    csv_io.write_prepared(csv_io.export_tables(p.training, p.test, p.avg_ratings, p.fav_genres, p.titles), folder)
    d = csv_io.read_prepared(spark, folder)
    got = jobs.predict(d["avg_ratings"], d["users_fav_genres"], d["test"]).predictions
    want = jobs.predict(p.avg_ratings, p.fav_genres, p.test).predictions
    assert rows(got) == rows(want)
