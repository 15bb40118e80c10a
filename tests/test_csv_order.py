"""Later duplicates, and where malformed rows go."""

import random

import pytest

from genrec.operators import metrics
from genrec.plans import jobs
from genrec.session import scratch_dir
from genrec.sources import csv_io
from tests.conftest import rows


def write_lines(spark, folder, files, header="userid,movieid,rating,timestamp"):
    """Text files by name; Spark gives a file a name of its own, so each goes through its own folder."""
    import os
    os.makedirs(folder)
    for name, lines in files.items():
        with open(f"{folder}/{name}", "w") as f:
            f.write("\n".join([header, *lines]) + "\n")


def local(spark, name):
    return scratch_dir(spark, name).removeprefix("file:")


@pytest.mark.parametrize("split", ["128m", "64", "1k"])
def test_later_duplicate_wins_at_any_partitioning(spark, split):
    """Blocks down to 64 bytes, files of very different sizes whose names are not in the order of their sizes."""
    rng, want, files = random.Random(2), {}, {}
    for name, n in (("a.csv", 5), ("b.csv", 300), ("c.csv", 2), ("d.csv", 120)):
        lines = []
        for i in range(n):
            pair = rng.randrange(12), rng.randrange(6)
            want[pair] = (rng.choice([0.5, 3.0, 5.0]), rng.randrange(10 ** 6))
            lines.append(f"{pair[0]},{pair[1]},{want[pair][0]},{want[pair][1]}")
            if i % 7 == 0:
                lines.append(f"{pair[0]},{pair[1]},high,1")            # malformed: counts for nothing
        files[name] = lines
    folder = local(spark, "dups")
    write_lines(spark, folder, files)
    old = {k: spark.conf.get(k, None) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        assert rows(csv_io.read_ratings(spark, folder)) == sorted((u, m, r, t) for (u, m), (r, t) in want.items())
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_duplicates_in_the_test_file_do_not_multiply(spark):
    """accuracy and rmse over a test file with a repeated pair equal those over the file without its earlier row."""
    movies = spark.createDataFrame([(1, 4.0, ["A", "B"]), (2, 3.0, ["B", "A"]), (3, 2.0, ["A"])],
                                   "movieid int, avgrating double, genres array<string>")
    fav = spark.createDataFrame([(7, ["A"]), (8, ["B"])], "userid int, favgenres array<string>")
    lines = ["7,1,1.0,5,A|B|", "7,2,4.0,6,B|A|", "8,3,2.0,1,A|", "7,1,5.0,3,A|B|", "8,1,4.5,2,A|B|"]
    out = []
    for kept in (lines, lines[1:]):
        folder = local(spark, "prepared")
        for name in csv_io.DATASETS:
            write_lines(spark, f"{folder}/{name}.csv", {"f.csv": kept if name in ("test", "training") else []},
                        "userid,movieid,rating,timestamp,genres" if name in ("test", "training") else ",".join(
                            {"avg_ratings": csv_io.AVG_RATINGS, "users_fav_genres": csv_io.FAV_GENRES, "titles": csv_io.TITLES}[name].names))
        d = csv_io.read_prepared(spark, folder, unmarked=True)
        found = jobs.predict(movies, fav, d["test"])
        out.append((rows(found.accuracy), rows(metrics.rmse(found.predictions, d["test"])), rows(d["training"]), d["test"].count()))
    assert out[0] == out[1] and out[0][3] == 4


def test_rejects_and_rows_are_all_lines(spark):
    lines = ["1,2,3.0,4", "1,2,3.0", "1,2,3.0,4,5", "x,2,3.0,4", "1,y,z,4", '"1",2,"3.5",4', "1,2,,", '1,"2,3.0,4', ",,,"]
    folder = local(spark, "bad")
    write_lines(spark, folder, {"a.csv": lines[:5], "b.csv": lines[5:]})
    fine, rejects = csv_io.read_with_rejects(spark, folder, csv_io.RATINGS)
    kept = csv_io.read_csv(spark, folder, csv_io.RATINGS)
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(map(tuple, fine.collect()), key=key) == sorted(map(tuple, kept.collect()), key=key)
    got = sorted((r.reason, r.text, r.file[-5:]) for r in rejects.collect())
    assert got == [("fields", '1,"2,3.0,4', "b.csv"), ("fields", "1,2,3.0", "a.csv"), ("fields", "1,2,3.0,4,5", "a.csv"),
                   ("movieid: no int", "1,y,z,4", "a.csv"), ("userid: no int", "x,2,3.0,4", "a.csv")]
    assert fine.count() + rejects.count() == len(lines)
