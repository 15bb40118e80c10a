"""Clustered store of predictions: one table for all models, bucketed by user.

Rows lie in partitions by ``model`` and, within them, in buckets by ``userid``,
so one user's list is one file's scan, many users' lists meet their ids in a join
that does not move the store, and a model is replaced without touching the
others.  The table is external: ``open_store`` attaches it in a session that
does not know it yet.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from genrec.session import path_exists
from genrec.sources.csv_io import MODELS

BUCKETS = 64
LOOKUP_IDS = 1000              # so many ids at most are named in a filter, more are joined


def open_store(spark: SparkSession, name: str, path: str, buckets: int = BUCKETS) -> str:
    """Create the table over ``path``, or attach what an earlier session wrote there; returns ``name``.

    ``buckets`` is a property of the files, so it has to be that of the first call.
    """
    if not re.fullmatch(r"[A-Za-z_][A-Za-z0-9_]*", name):
        raise ValueError("a table's name has letters, digits and _ only")
    location = path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} (userid INT, recommendations STRING, model STRING) USING parquet "
              f"PARTITIONED BY (model) CLUSTERED BY (userid) SORTED BY (userid) INTO {int(buckets)} BUCKETS LOCATION '{location}'")
    if path_exists(spark, path):
        spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
    return name


def _known(model: str) -> str:
    if model not in MODELS:
        raise ValueError(f"model must be one of {', '.join(MODELS)}")
    return model


def buckets_of(spark: SparkSession, name: str) -> int:
    found = [r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {name}").collect() if r.col_name == "Num Buckets"]
    return int(found[0])


def put_predictions(stored: DataFrame, name: str, model: str) -> None:
    """Replace one model's rows (``userid, recommendations``); other models stay.  One writing job, whose
    tasks each hold whole buckets, so a bucket is one file."""
    spark = stored.sparkSession
    rows = stored.select(F.col("userid").cast("int").alias("userid"), "recommendations").repartition(buckets_of(spark, name), "userid")
    spark.sql(f"INSERT OVERWRITE TABLE {name} PARTITION (model = '{_known(model)}') SELECT userid, recommendations FROM {{rows}}", rows=rows)


def get_predictions(spark: SparkSession, name: str, model: str, users: Iterable[int] | DataFrame | None = None) -> DataFrame:
    """``userid, recommendations`` of one model.

    ``users``: a few ids become a filter that selects buckets; more than
    ``LOOKUP_IDS`` of them, or a table with ``userid``, are joined on the
    buckets; ``None`` is everyone.
    """
    rows = spark.table(name).where(F.col("model") == _known(model)).select("userid", "recommendations")
    if users is None:
        return rows
    if not isinstance(users, DataFrame):
        ids = sorted(set(users))
        if len(ids) <= LOOKUP_IDS:
            return rows.where(F.col("userid").isin(ids))
        users = spark.createDataFrame([(i,) for i in ids], "userid int")
    return rows.join(users.select(F.col("userid").cast("int").alias("userid")), "userid", "left_semi")
