"""Exact row numbers within groups that stay correct and balanced when one
group holds a large share of the rows.

``row_number() over (partition by g order by o)`` sends a whole group to one
task.  Here the rows are range-partitioned on ``(g, o)`` (hot groups span
several partitions), sorted within partitions and numbered by position; a
small per-(group, partition) summary gives each partition's offset.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from genrec.session import scratch_dir

# monotonically_increasing_id() keeps the partition index above bit 33
_POS_BITS = 33


def group_rank(df: DataFrame, group_cols: Sequence[str], order: Sequence[Column],
               rank_col: str = "rank", partitions: int | None = None) -> DataFrame:
    """Add ``rank_col`` = 1, 2, ... within each group in ``order``.
    """
    return ranked_groups(df, group_cols, order, rank_col, partitions)[0]


def ranked_groups(df: DataFrame, group_cols: Sequence[str], order: Sequence[Column],
                  rank_col: str = "rank", partitions: int | None = None) -> tuple[DataFrame, DataFrame]:
    """``group_rank`` plus a ``group_cols + [n_rows]`` table of group sizes
    (from the per-partition summary, without another pass over the rows).

    ``order`` must be a total order inside a group (end it with a unique key).
    Runs one action: the sorted, numbered rows are written below the session's
    checkpoint folder so both uses below see the same positions, also after an
    executor is lost.
    """
    spark = df.sparkSession
    keys = [F.col(c).asc() for c in group_cols] + list(order)
    # without an explicit count the range partitioning follows
    # spark.sql.shuffle.partitions and AQE may coalesce small partitions
    ranged = df.repartitionByRange(partitions, *keys) if partitions else df.repartitionByRange(*keys)
    # Written (not Dataset.checkpoint, which would compute the input twice) to
    # a fresh folder below spark.checkpoint.dir: positions are fixed once and
    # the lineage is cut.
    folder = scratch_dir(spark, "rank")
    (ranged.sortWithinPartitions(*keys)
     .withColumn("_pos", F.monotonically_increasing_id())
     .withColumn("_part", F.shiftright("_pos", _POS_BITS))
     .write.parquet(folder))
    numbered = spark.read.parquet(folder)
    summary = numbered.groupBy(*group_cols, "_part").agg(
        F.min("_pos").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*group_cols).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1) \
        if group_cols else Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    summary = summary.select(*group_cols, "_part", "_first", "_n",
                             F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    out = numbered.join(summary.drop("_n"), [*group_cols, "_part"])
    rank = F.col("_pos") - F.col("_first") + 1 + F.col("_before")
    sizes = summary.groupBy(*group_cols).agg(F.sum("_n").alias("n_rows"))
    return out.select(*df.columns, rank.alias(rank_col)), sizes


# ids per bucket of the lazy id rank; the prefix sums run over at most
# 2^31 / ID_BUCKET rows
ID_BUCKET = 1 << 16


def id_rank(df: DataFrame, id_col: str, rank_col: str = "rank") -> DataFrame:
    """``id_col, rank_col``: 1, 2, ... over the distinct non-negative integer
    ids of ``df`` in ascending order, without an action.

    ids are bucketed by ``id div ID_BUCKET``: a bucket holds at most
    ID_BUCKET distinct ids, so the row number inside a bucket and the prefix
    sum over bucket counts are both bounded windows.
    """
    ids = df.select(F.col(id_col)).distinct().withColumn("_b", F.floor(F.col(id_col) / ID_BUCKET))
    counts = ids.groupBy("_b").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_b", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = F.row_number().over(Window.partitionBy("_b").orderBy(id_col))
    return (ids.select(id_col, "_b", inside.alias("_r")).join(offsets, "_b")
            .select(id_col, (F.col("_before") + F.col("_r")).alias(rank_col)))
