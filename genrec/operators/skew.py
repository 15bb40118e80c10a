"""Lookup joins whose keys can be requested by a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# requests per (key, salt) group that one task should handle (read at call time)
ROWS_PER_TASK = 1_000_000
# so many keys at most can exceed the bound below, so their table is broadcast
HOT_KEYS = 100_000


def salted_lookup(requests: DataFrame, table: DataFrame, keys: Sequence[str], spread: str,
                  demand: DataFrame | None = None, rows_per_task: int | None = None,
                  how: str = "inner") -> DataFrame:
    """``requests`` joined with ``table`` on ``keys`` (``how``: inner or left).

    Meant for tables with one row per key; with several rows per key every
    replica carries all of them, so the result is the same join.

    A key with more than ``bound = max(rows_per_task, ceil(requests / HOT_KEYS))``
    requests is split: its table row is replicated f = ceil(its requests /
    bound) times with salts 0..f-1, and each request takes salt
    ``hash(spread) mod f``.  Fewer than ``HOT_KEYS`` keys can exceed that
    bound, so the table of hot keys is always broadcast.  Other keys keep salt
    0; with no hot key AQE drops both joins with the empty table.

    ``demand`` (``keys + [_n]``) gives the request counts, or upper bounds of
    them, when an aggregate that already exists has them; otherwise the
    requests are counted, which evaluates them a second time.  Lazy: no action.

    The table is never broadcast: its planned size is that of compressed files
    (and leaves out what ``explode`` adds), so a table far too large for the
    driver can look small.
    """
    keys = list(keys)
    if demand is None:
        demand = requests.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    total = demand.select(F.ceil(F.sum("_n") / HOT_KEYS).alias("b")).scalar()
    bound = F.greatest(F.lit(rows_per_task or ROWS_PER_TASK).cast("long"), F.coalesce(total, F.lit(1)))
    hot = F.broadcast(demand.select(*keys, F.ceil(F.col("_n") / bound).cast("int").alias("_f")).where(F.col("_f") > 1))
    fan = F.coalesce(F.col("_f"), F.lit(1))
    salted_requests = requests.join(hot, keys, "left").withColumn(
        "_salt", F.pmod(F.xxhash64(spread), fan).cast("int")).drop("_f")
    salted_table = table.join(hot, keys, "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), fan - 1))).drop("_f")
    return salted_requests.join(salted_table.hint("merge"), [*keys, "_salt"], how).drop("_salt")


COPIES = 16


def fanned_join(rows: DataFrame, table: DataFrame, key: str, spread: str, copies: int = COPIES) -> DataFrame:
    """Inner join on a key with few values: ``rows`` go to one of ``copies`` salts by
    ``hash(spread)``, ``table`` to all of them, so tasks number values x ``copies``.  Lazy."""
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(copies)).cast("int"))
    fanned = table.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
    return salted.join(fanned, [key, "_salt"]).drop("_salt")
