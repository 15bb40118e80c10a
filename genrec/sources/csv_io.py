"""CSV sources and sinks of the method.

Schemas are explicit (no inference pass); quotes are doubled inside quoted
fields; lists are pipe strings with a trailing pipe on disk and arrays inside.
"""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from genrec.functions.genres import parse_pipe, pipe_string
from genrec.session import stored
from genrec.sources.runs import Run, manifest

# Column names, types and dataset names of the hand-off files
MOVIES = T.StructType([T.StructField("movieid", T.IntegerType()), T.StructField("title", T.StringType()),
                       T.StructField("genres", T.StringType())])
RATINGS = T.StructType([T.StructField("userid", T.IntegerType()), T.StructField("movieid", T.IntegerType()),
                        T.StructField("rating", T.DoubleType()), T.StructField("timestamp", T.LongType())])
RATED = T.StructType(RATINGS.fields + [T.StructField("genres", T.StringType())])
AVG_RATINGS = T.StructType([T.StructField("movieid", T.IntegerType()), T.StructField("avgrating", T.DoubleType()),
                            T.StructField("genres", T.StringType())])
FAV_GENRES = T.StructType([T.StructField("userid", T.IntegerType()), T.StructField("favgenres", T.StringType())])
TITLES = T.StructType([T.StructField("movieid", T.IntegerType()), T.StructField("title", T.StringType())])
PREDICTIONS = T.StructType([T.StructField("userid", T.IntegerType()),
                            T.StructField("recommendations", T.StringType())])

MODELS = ("gbcf", "ibcf", "als")
DATASETS = ("avg_ratings", "test", "training", "users_fav_genres", "titles")


def read_csv(spark: SparkSession, path: str, schema: T.StructType, header: bool = True,
             sep: str = ",", order: str | None = None) -> DataFrame:
    """O1: headed CSV, malformed rows dropped, ``""`` inside quotes read as ``"``.

    A row is malformed if it has more or fewer fields than the schema, or a
    field that is no value of its type.  The parser drops rows by the columns
    that a query asks for, so fields are read as strings, always all of them,
    and checked here: every query sees the same rows.  ``order`` names a column
    that grows with the input: see ``input_order``.
    """
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    rows = (spark.read.schema(text).option("header", header).option("sep", sep)
            .option("mode", "DROPMALFORMED").option("columnPruning", False)
            .option("quote", '"').option("escape", '"').csv(path))
    if order is not None:
        rows = input_order(rows, order)
    typed = {f.name: F.col(f.name).try_cast(f.dataType) for f in schema.fields if f.dataType != T.StringType()}
    for name, value in typed.items():
        rows = rows.where(F.col(name).isNull() | value.isNotNull())
    return rows.withColumns(typed) if typed else rows


# so many files' names are broadcast at most; a longer list is joined
MAX_BROADCAST_FILES = 100_000


def input_order(rows: DataFrame, name: str) -> DataFrame:
    """Adds ``name``, a ``decimal(38,0)`` that orders the rows of a file source as they stand: by file name, then by
    position, whatever the number and order of partitions.

    A file's number in the driver's listing, a block's start and the row's number
    in its task, which reads a block from start to end, are packed into one
    number (files < 10^13, starts < 10^15, rows of a task < 2^33).
    """
    spark = rows.sparkSession
    files = sorted(rows.inputFiles())
    listed = spark.createDataFrame(list(enumerate(files)), "_file long, _path string")
    if len(files) <= MAX_BROADCAST_FILES:
        listed = F.broadcast(listed)

    def part(value: Column, zeros: int) -> Column:
        return value.cast("decimal(19,0)") * F.lit("1" + "0" * zeros).cast(f"decimal({zeros + 1},0)")

    row = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    placed = rows.select("*", F.input_file_name().alias("_path"), F.input_file_block_start().alias("_start"), row.alias("_row"))
    key = part(F.col("_file"), 18) + part(F.col("_start"), 10) + F.col("_row").cast("decimal(19,0)")
    return placed.join(listed, "_path").select(*rows.columns, key.cast("decimal(38,0)").alias(name))


def later_wins(rows: DataFrame, keys: tuple[str, ...], order: str) -> DataFrame:
    """One row per ``keys``, the last by ``order`` (``input_order``; dropped).

    Numbers are chosen by a hash aggregate, rows with other values by a window
    limited to one row; both combine before the shuffle, so a pair that a third
    of the rows repeat meets in one row per task.
    """
    out = [c for c in rows.columns if c != order]
    values = [f for f in rows.schema.fields if f.name not in (*keys, order)]
    if all(isinstance(f.dataType, T.NumericType) for f in values):
        return rows.groupBy(*keys).agg(*[F.max_by(f.name, order).alias(f.name) for f in values]).select(*out)
    last = F.row_number().over(Window.partitionBy(*keys).orderBy(F.col(order).desc()))
    return rows.withColumn("_last", last).where("_last = 1").select(*out)


def read_with_rejects(spark: SparkSession, path: str, schema: T.StructType, header: bool = True,
                      sep: str = ",") -> tuple[DataFrame, DataFrame]:
    """``(rows, rejects)``: what ``read_csv`` reads, and ``file, reason, text`` of every other line that is not blank.

    The reason is ``fields`` (their number, or a quote that does not end), or the
    first column whose text is no value of its type; such a row's text is
    its fields written again.  One scan, whose outcome is written once (one job).
    """
    bad = "_bad"
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields] + [T.StructField(bad, T.StringType())])
    rows = (spark.read.schema(text).option("header", header).option("sep", sep).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", bad).option("columnPruning", False)
            .option("quote", '"').option("escape", '"').csv(path))
    reason = F.when(F.col(bad).isNotNull(), "fields")
    for f in schema.fields:
        if f.dataType != T.StringType():
            reason = reason.when(F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull(), f"{f.name}: no {f.dataType.simpleString()}")
    whole = F.coalesce(bad, F.to_csv(F.struct(*schema.names), {"sep": sep, "escape": '"'}))
    read = stored(rows.select(*schema.names, F.col("_metadata.file_path").alias("_file"), reason.alias("_reason"),
                              F.when(reason.isNotNull(), whole).alias("_text")), "csv-rows")
    fine = read.where("_reason is null").select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields])
    return fine, read.where("_reason is not null").select(F.col("_file").alias("file"), F.col("_reason").alias("reason"), F.col("_text").alias("text"))


_CSV = {"header": True, "quote": '"', "escape": '"'}


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).options(**_CSV).csv(path)


def read_movies(spark: SparkSession, path: str) -> DataFrame:
    """O2: raw movies table."""
    return read_csv(spark, path, MOVIES)


PAIR = ("userid", "movieid")


def read_ratings(spark: SparkSession, path: str) -> DataFrame:
    """Raw ratings table; of several rows of a (user, movie) the last in the input counts."""
    return later_wins(read_csv(spark, path, RATINGS, order="_order"), PAIR, "_order")


def _lists_in(df: DataFrame, col: str) -> DataFrame:
    # an empty list is written as '' and read back as NULL: both mean []
    return df.withColumn(col, F.coalesce(parse_pipe(col), F.array().cast("array<string>")))


def _read_rated(spark: SparkSession, path: str) -> DataFrame:
    """Ratings with genres, the last row of each (user, movie)."""
    return later_wins(read_csv(spark, path, RATED, order="_order"), PAIR, "_order")


def _lists_out(df: DataFrame, col: str) -> DataFrame:
    return df.withColumn(col, pipe_string(F.col(col)))


def export_tables(training: DataFrame, test: DataFrame, avg: DataFrame, fav: DataFrame,
                  titles: DataFrame) -> dict[str, DataFrame]:
    """O3 shapes: the five datasets with lists as pipe strings."""
    cols = ["userid", "movieid", "rating", "timestamp", "genres"]
    return {
        "avg_ratings": _lists_out(avg.select("movieid", "avgrating", "genres"), "genres"),
        "test": _lists_out(test.select(*cols), "genres"),
        "training": _lists_out(training.select(*cols), "genres"),
        "users_fav_genres": _lists_out(fav.select("userid", "favgenres"), "favgenres"),
        "titles": titles.select("movieid", "title"),
    }


def run_folder(root: str, small: bool = False, run_id: int | None = None) -> str:
    """One new folder per run, named by epoch milliseconds (``-small`` suffix)."""
    rid = run_id if run_id is not None else round(time.time() * 1000)
    return f"{root.rstrip('/')}/{rid}{'-small' if small else ''}"


def write_prepared(tables: dict[str, DataFrame], folder: str) -> str:
    """Write each dataset as ``<folder>/<name>.csv``, as a committed run: the folder is new, and counts once its
    manifest is written."""
    with Run(tables[DATASETS[0]].sparkSession, folder) as run:
        for name in DATASETS:
            run.table(name, tables[name], lambda df: df.write.options(**_CSV), "csv", f"{name}.csv")
    return folder


def read_prepared(spark: SparkSession, folder: str, unmarked: bool = False) -> dict[str, DataFrame]:
    """Read the five datasets back, lists as arrays; the last row of a (user, movie) counts.

    A folder without a manifest is refused, unless ``unmarked`` says that it comes from elsewhere.
    """
    if not unmarked:
        manifest(spark, folder)
    return {
        "avg_ratings": _lists_in(read_csv(spark, f"{folder}/avg_ratings.csv", AVG_RATINGS), "genres"),
        "test": _lists_in(_read_rated(spark, f"{folder}/test.csv"), "genres"),
        "training": _lists_in(_read_rated(spark, f"{folder}/training.csv"), "genres"),
        "users_fav_genres": _lists_in(read_csv(spark, f"{folder}/users_fav_genres.csv", FAV_GENRES), "favgenres"),
        "titles": read_titles(spark, f"{folder}/titles.csv"),
    }


def write_predictions(preds: DataFrame, path: str) -> None:
    """Predictions CSV, overwritten."""
    write_csv(preds.select("userid", "recommendations"), path, mode="overwrite")


def read_predictions(spark: SparkSession, root: str, model: str = "gbcf") -> DataFrame:
    """Stored predictions of one model (``gbcf``, ``ibcf`` or ``als``)."""
    if model not in MODELS:
        raise ValueError(f"model must be one of {', '.join(MODELS)}")
    return read_csv(spark, f"{root.rstrip('/')}/{model}.csv", PREDICTIONS)


def read_titles(spark: SparkSession, path: str) -> DataFrame:
    """Titles table."""
    return read_csv(spark, path, TITLES)
