"""Committed runs: manifests, failed runs, helpers."""

import json
import os

import pytest

from genrec.operators import prep
from genrec.plans import jobs
from genrec.session import delete_folder, path_exists, scratch_dir
from genrec.sources import csv_io, runs
from genrec.sources.views import movies_view, ratings_view
from tests.conftest import SF001


def local(path):
    return path.removeprefix("file:")


def test_manifest_holds_rows_and_schemas(spark):
    folder = scratch_dir(spark, "run")
    jobs.write_prepared(spark, ratings_view(spark, SF001), movies_view(spark, SF001), folder)
    found = runs.manifest(spark, folder)
    assert sorted(found) == ["avg_ratings", "fav_genres", "ratings", "test", "titles"]
    d = jobs.read_prepared(spark, folder)
    runs.verify(spark, d, folder)
    assert found["ratings"][0] == spark.read.parquet(f"{folder}/ratings").count() > 0
    assert [f["name"] for f in json.loads(found["avg_ratings"][1])["fields"]] == ["movieid", "avgrating", "genres"]
    assert not os.path.exists(f"{local(folder)}/_helpers")
    with pytest.raises(FileExistsError):
        jobs.write_prepared(spark, ratings_view(spark, SF001), movies_view(spark, SF001), folder)


def test_a_run_that_fails_midway_is_refused(spark, monkeypatch):
    """The favourites fail after the ratings were written."""
    folder = scratch_dir(spark, "run")
    monkeypatch.setattr(prep, "fav_genres", lambda training: training.selectExpr("raise_error('disk full') as userid"))
    with pytest.raises(Exception, match="disk full"):
        jobs.write_prepared(spark, ratings_view(spark, SF001), movies_view(spark, SF001), folder)
    assert path_exists(spark, f"{folder}/ratings") and not os.path.exists(f"{local(folder)}/_helpers")
    with pytest.raises(FileNotFoundError, match="no committed run"):
        jobs.read_prepared(spark, folder)


def test_a_failed_csv_run_is_refused(spark):
    p = jobs.prepared_from_tables(spark, SF001)
    tables = csv_io.export_tables(p.training, p.test, p.avg_ratings, p.fav_genres, p.titles)
    folder = csv_io.run_folder(scratch_dir(spark, "csv"))
    with pytest.raises(Exception, match="disk full"):
        csv_io.write_prepared(tables | {"training": tables["training"].selectExpr("cast(raise_error('disk full') as int) as userid")}, folder)
    assert path_exists(spark, f"{folder}/avg_ratings.csv")
    with pytest.raises(FileNotFoundError):
        csv_io.read_prepared(spark, folder)
    again = csv_io.run_folder(scratch_dir(spark, "csv"))
    csv_io.write_prepared(tables, again)
    runs.verify(spark, csv_io.read_prepared(spark, again), again)


def test_verify_notices_lost_rows(spark):
    folder = scratch_dir(spark, "run")
    with runs.Run(spark, folder) as run:
        run.tables({"a": spark.range(10), "b": spark.range(3)})
    a = spark.read.parquet(f"{folder}/a")
    runs.verify(spark, {"a": a}, folder)
    with pytest.raises(ValueError, match="a has 7 rows, its manifest 10"):
        runs.verify(spark, {"a": a.where("id < 7")}, folder)


def test_delete_folder(spark):
    folder = scratch_dir(spark, "gone")
    spark.range(3).write.parquet(folder)
    delete_folder(spark, folder)
    assert not path_exists(spark, folder)
