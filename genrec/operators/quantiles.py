"""Exact percentiles in bounded memory: a mergeable sketch brackets the rank, a counting pass makes it exact.

``percentile`` keeps a counter per distinct value.  Here a quantile sketch of a few
kilobytes gives two values that hold the wanted rank between them; a pass counts
the rows below and between; and only rows between them are looked at again.  Where
they still have more than ``limit`` distinct values they are sketched in turn.  A sketch
that misses the rank (its bounds are probable, not certain) shows in the
counts, and the bracket is widened, so results are exact in any case.

Sketches of parts (days) merge into that of the whole, so a new day costs its own rows
and the counting pass.
"""

from __future__ import annotations

from math import ceil, floor

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SKETCH_SIZE = 800              # the sketch's k: a rank error of about 0.4 % of the rows
MARGIN = 0.01                  # of the rows, on both sides of the wanted rank
LIMIT = 1_000_000              # distinct values that are ranked in one task


def quantile_sketch(values: DataFrame, column: str, by: list[str] | None = None) -> DataFrame:
    """``by + [sketch]``: a sketch of whole numbers per group (of everything without ``by``); nulls do not count."""
    return values.groupBy(*(by or [])).agg(F.kll_sketch_agg_bigint(F.col(column).cast("long"), SKETCH_SIZE).alias("sketch"))


def merged_sketch(sketches: DataFrame) -> DataFrame:
    """One row ``sketch`` from ``quantile_sketch`` rows of parts."""
    return sketches.agg(F.kll_merge_agg_bigint("sketch", SKETCH_SIZE).alias("sketch"))


def _bracket(sketch: DataFrame, share: float, margin: float) -> tuple[int, int, int] | None:
    """Rows sketched, and the values at ``share`` less and plus ``margin``; ``None`` without rows."""
    if sketch.where("sketch is not null").isEmpty():
        return None
    ends = F.array(F.lit(max(share - margin, 0.0)), F.lit(min(share + margin, 1.0)))
    n = F.kll_sketch_get_n_bigint("sketch")
    found = sketch.select(n.alias("n"), F.when(n > 0, F.kll_sketch_get_quantile_bigint("sketch", ends)).alias("q")).first()
    return (found.n, *found.q) if found.n else None


def exact_percentile(values: DataFrame, column: str, share: float, sketch: DataFrame | None = None, limit: int | None = None) -> float | None:
    """The percentile with linear interpolation, as ``percentile`` gives it; ``None`` without values.

    ``sketch``: one row of ``quantile_sketch`` or ``merged_sketch`` over the same
    values, where there is one.  Runs a few aggregates; numbers only reach the driver.
    """
    limit = limit or LIMIT
    v = F.col(column).cast("long")
    rows = values.select(v.alias("v")).where("v is not null")
    first = _bracket(sketch if sketch is not None else quantile_sketch(rows, "v"), share, MARGIN)
    if first is None:
        return None
    n, low, high = first
    position = (n - 1) * share
    ranks = floor(position), ceil(position)           # from 0
    margin = MARGIN
    while True:
        inside = rows.where(F.col("v").between(low, high))
        below, held, distinct = rows.agg(F.count_if(F.col("v") < low), F.count_if(F.col("v").between(low, high)),
                                         F.approx_count_distinct(F.when(F.col("v").between(low, high), F.col("v")))).first()
        if not (below <= ranks[0] and ranks[1] < below + held):
            margin *= 4                               # the sketch missed: look further to both sides
            _, low, high = _bracket(quantile_sketch(rows, "v"), share, margin) if margin < 1 else (n, *rows.agg(F.min("v"), F.max("v")).first())
        elif distinct <= limit or low == high:
            return _interpolate(inside, below, position, ranks)
        else:
            part = (ranks[0] - below) / max(held - 1, 1)
            _, low_in, high_in = _bracket(quantile_sketch(inside, "v"), part, MARGIN)
            if (low_in, high_in) == (low, high):
                return _interpolate(inside, below, position, ranks)
            below_in, held_in = inside.agg(F.count_if(F.col("v") < low_in), F.count_if(F.col("v").between(low_in, high_in))).first()
            if not (below + below_in <= ranks[0] and ranks[1] < below + below_in + held_in):
                return _interpolate(inside, below, position, ranks)
            low, high = low_in, high_in


def _interpolate(inside: DataFrame, below: int, position: float, ranks: tuple[int, int]) -> float:
    """The values at two ranks of the few distinct values between the brackets, weighed by the position."""
    counts = inside.groupBy("v").agg(F.count(F.lit(1)).alias("n"))
    upto = F.sum("n").over(Window.orderBy("v").rowsBetween(Window.unboundedPreceding, 0)) + below

    def at(rank: int) -> Column:
        return F.min(F.when(F.col("upto") > rank, F.col("v")))

    low, high = counts.select("v", upto.alias("upto")).agg(at(ranks[0]), at(ranks[1])).first()
    return float(low) if low == high else (ranks[1] - position) * low + (position - ranks[0]) * high
