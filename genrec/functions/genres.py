"""Column expressions shared by the operators (all JVM-side, no UDF)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the method's for the same results:
#   the genre that is never a genre, the marker of a movie without genres,
#   and the year pattern inside a title.
EXCLUDED_GENRE = "IMAX"
BLANK_GENRES = "(no genres listed)"
YEAR_PATTERN = r"\(([0-9]{4})\)"


def parse_pipe(col: Column | str) -> Column:
    """``'A|B|'`` -> ``[A, B]``: split on the pipe and drop empty parts.

    A NULL input stays NULL.
    """
    return F.array_remove(F.split(F.col(col) if isinstance(col, str) else col, r"[|]"), "")


def clean_genres(arr: Column) -> Column:
    """Genre set of a movie: drop IMAX, keep the first occurrence of each genre in
    source order (order decides pair direction in the model)."""
    return F.array_except(arr, F.array(F.lit(EXCLUDED_GENRE)))


def pipe_string(arr: Column) -> Column:
    """``[A, B]`` -> ``'A|B|'``; the empty list gives ``''`` (the CSV convention)."""
    return F.when(F.size(arr) == 0, F.lit("")).otherwise(F.concat(F.array_join(arr, "|"), F.lit("|")))


def title_year(title: Column | str) -> Column:
    """First ``(dddd)`` in the title, ``''`` when there is none."""
    return F.regexp_extract(F.col(title) if isinstance(title, str) else title, YEAR_PATTERN, 1)


def coefficient(fav: Column, genre: Column, weight: Column, norm: Column,
                digits: int | None = 3) -> Column:
    """Genre coefficient of a favourite genre against one genre of a movie.

    Equal genres give 1.0 without division; a missing weight (no pair seen,
    unknown genre) gives 0.0; otherwise ``round(weight * (1 / norm), 3)``
    (unrounded when ``digits`` is None).  ``norm`` is never 0 on the branch
    that divides.
    """
    ratio = weight * (F.lit(1.0) / norm.cast("double"))
    return (
        F.when(fav == genre, F.lit(1.0))
        .when(weight.isNull(), F.lit(0.0))
        .otherwise(F.round(ratio, digits) if digits is not None else ratio)
    )
