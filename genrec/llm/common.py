"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable
from itertools import repeat

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from genrec.session import scratch_dir

# characters that separate words: space and \t \n \v \f \r
SPACES = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once per row.

    A column that is named inside a lambda is evaluated again for every
    element; a lambda variable is not.
    """
    return F.transform(F.array(value), body)[0]


def spaced(text: Column) -> Column:
    """``text`` (null: empty) with every separator replaced by a plain space."""
    out = F.coalesce(text, F.lit(""))
    for c in SPACES[1:]:
        out = F.replace(out, F.lit(c), F.lit(" "))
    return out


def words_of_spaced(spaced_text: Column) -> Column:
    """The words of a ``spaced`` text; a split at one plain character needs no regular expression."""
    return F.array_remove(F.split(spaced_text, " "), "")


def words(text: Column) -> Column:
    """The maximal runs of non-space characters; null and blank text: none."""
    return words_of_spaced(spaced(text))


def free_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened until ``df`` has no such column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the cluster's checkpoint folder and read it back.

    Cuts the lineage with a table that every executor can read, so a lost
    executor recomputes nothing before it.  Runs one job.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Numbers(dict):
    """Numbers strings in the order in which they are first looked up; ``new`` collects those since it was emptied."""

    def __init__(self) -> None:
        super().__init__()
        self.new: list[str] = []

    def of(self, keys: list[str]) -> np.ndarray:
        found = np.fromiter(map(self.get, keys, repeat(-1)), np.int64, len(keys))
        unknown = np.flatnonzero(found < 0)
        if len(unknown):
            missed = [keys[i] for i in unknown.tolist()]
            fresh = dict.fromkeys(missed)
            self.update(zip(fresh, range(len(self), len(self) + len(fresh)), strict=True))
            self.new += fresh
            found[unknown] = np.fromiter(map(self.__getitem__, missed), np.int64, len(missed))
        return found


def arrow_batch_rows(spark: SparkSession, rows: int) -> None:
    """At most ``rows`` rows in an Arrow batch sent to Python.

    Texts are sent whole, so the bound on a batch's memory is this number
    times the longest texts.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
