"""Turns of a conversation table, numbered; shared by the conversation operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from genrec.operators.rank import ranked_groups


def turn_digest(role: Column, text: Column) -> Column:
    """16 bytes that stand for a (role, text): the first half of a SHA-256, the role's length written before it."""
    whole = F.concat_ws(":", F.char_length(role).cast("string"), role, text)
    return F.unhex(F.substring(F.sha2(whole, 256), 1, 32))


def numbered_turns(rows: DataFrame, group: str) -> tuple[DataFrame, DataFrame]:
    """``(rows + pos, group + n_rows)``: positions 1, 2, ... in each group by ``turn``, null
    first; rows of one turn stand in the order of their ``tid`` (``turn_digest``).

    A group of any size is spread over range partitions.  Runs one writing job.
    """
    return ranked_groups(rows, [group], [F.col("turn").asc_nulls_first(), F.col("tid").asc()], "pos")
