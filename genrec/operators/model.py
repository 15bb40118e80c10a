"""Genre model: ordered genre pairs, pair counts, directional weights, and the
affinity of a genre to a movie genre set.

The model is an n x n table over genres, so everything after the pair counts
is tiny.  Pairs are built from distinct genre lists with their movie counts
(a movie table of any size collapses to the distinct lists first).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from genrec.functions.genres import coefficient

# Affinity sums are exact: coefficients have 3 decimals, so they are added as
# decimals and only the final product is a double.
COEFF_TYPE = "decimal(18,3)"
AFF_TYPE = "decimal(28,3)"


def genre_pairs(movies: DataFrame) -> DataFrame:
    """``movieid, genre_a, genre_b`` for every ordered pair i < j of list positions."""
    a = movies.select("movieid", "genres", F.posexplode("genres").alias("pos_a", "genre_a"))
    b = a.select("movieid", "pos_a", "genre_a", F.posexplode("genres").alias("pos_b", "genre_b"))
    return b.where(F.col("pos_a") < F.col("pos_b")).select("movieid", "genre_a", "genre_b")


def genre_pair_counts(movies: DataFrame) -> DataFrame:
    """``genre_a, genre_b, n`` = movies listing a before b.

    Movies are first reduced to their distinct genre lists (partial aggregate),
    pairs are emitted once per list and weighted by its movie count.
    """
    lists = movies.where(F.size("genres") >= 2).groupBy("genres").agg(F.count(F.lit(1)).alias("movies"))
    a = lists.select("genres", "movies", F.posexplode("genres").alias("pos_a", "genre_a"))
    b = a.select("movies", "pos_a", "genre_a", F.posexplode("genres").alias("pos_b", "genre_b"))
    return (b.where(F.col("pos_a") < F.col("pos_b"))
            .groupBy("genre_a", "genre_b").agg(F.sum("movies").alias("n")))


def genre_weights(movies: DataFrame, digits: int | None = 3) -> DataFrame:
    """``genre_a, genre_b, n, weight``, weight = n / sum of n over genre_a.

    Rounded half-up to ``digits`` (None keeps the exact ratio).  The window is
    over one genre's row of the matrix: at most n genres.
    """
    counts = genre_pair_counts(movies)
    total = F.sum("n").over(Window.partitionBy("genre_a"))
    ratio = F.col("n") / total
    w = F.round(ratio, digits) if digits is not None else ratio
    return counts.select("genre_a", "genre_b", "n", w.alias("weight"))


def known_genres(movies: DataFrame) -> DataFrame:
    """Distinct genres over the model movies."""
    return movies.select(F.explode("genres").alias("genre")).distinct()


def check_known(fav: DataFrame, movies: DataFrame) -> None:
    """Strict mode for D10: raise if a favourite genre is not a known genre.

    This runs one small action (a ``first()`` over the anti-join).
    """
    unknown = (fav.select(F.explode("favgenres").alias("genre")).distinct()
               .join(known_genres(movies), "genre", "left_anti").first())
    if unknown is not None:
        raise ValueError(f"genre does not exist: {unknown['genre']}")


def set_coefficients(sets: DataFrame, weights: DataFrame, exact: bool = False) -> DataFrame:
    """``skey, genre_u, genre_m, norm, coeff`` for every genre set (``skey, sgenres``)
    and every genre ``u`` that is in the set or has a weight to one of its genres;
    every other coefficient is 0.

        norm(u) = |genres| - [u in genres]

    ``exact=True`` (D13, the single-machine variant): coefficients are not
    rounded; pair it with unrounded weights.  Rows: genre sets times linked
    genres, whatever the number of users or movies.
    """
    m = sets.select("skey", "sgenres", F.explode("sgenres").alias("m"))
    own = m.select("skey", "sgenres", "m", F.col("m").alias("u"), F.lit(None).cast("double").alias("weight"))
    w = weights.select(F.col("genre_a").alias("u"), F.col("genre_b").alias("m"), "weight")
    linked = m.join(w, "m").select("skey", "sgenres", "m", "u", "weight")
    x = own.unionByName(linked).withColumn(
        "norm", F.size("sgenres") - F.array_contains("sgenres", F.col("u")).cast("int"))
    coeff = coefficient(F.col("u"), F.col("m"), F.col("weight"), F.col("norm"), digits=None if exact else 3)
    return x.select("skey", F.col("u").alias("genre_u"), F.col("m").alias("genre_m"), "norm", coeff.alias("coeff"))


def set_affinities(sets: DataFrame, weights: DataFrame, exact: bool = False) -> DataFrame:
    """``skey, genre_u, aff``: the sum of a genre's coefficients over a genre set
    (exact decimals; doubles for ``exact=True``)."""
    coeff = F.col("coeff") if exact else F.col("coeff").cast(COEFF_TYPE)
    return set_coefficients(sets, weights, exact).groupBy("skey", "genre_u").agg(
        F.sum(coeff).cast("double" if exact else AFF_TYPE).alias("aff"))


def set_maps(sets: DataFrame, weights: DataFrame, exact: bool = False) -> DataFrame:
    """``skey, affinity MAP<genre, aff>``: at most one entry per genre of the vocabulary."""
    return set_affinities(sets, weights, exact).groupBy("skey").agg(
        F.map_from_entries(F.collect_list(F.struct("genre_u", "aff"))).alias("affinity"))


def affinity_of(favgenres: Column, affinity: Column, exact: bool = False) -> Column:
    """O46 core, in the row: the favourites' affinities to the movie's genre set
    (unlinked genres and sets without a map count 0)."""
    kind = "double" if exact else AFF_TYPE
    zero = F.lit(0).cast(kind)
    return F.aggregate(favgenres, zero, lambda total, u: (
        total + F.coalesce(F.try_element_at(affinity, u), zero)).cast(kind))


EXACT_DIGITS = 6


def score_expr(aff: Column, avg: Column, n_fav: Column, exact: bool = False) -> Column:
    """O46 final step: ``round(aff * avg / |fav|, 3)`` (double arithmetic after
    the exact sum); the exact variant rounds to 6 digits."""
    return F.round(aff * avg / n_fav, EXACT_DIGITS if exact else 3)
