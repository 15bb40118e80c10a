"""Movie and rating tables over the driver's star-schema parquet files.

There is no movie data in the test tables, so movies are parts and ratings are
a customer's latest line item of a part.  The view definitions are fixed: the
DuckDB oracle runs the same definitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the movies view (same text in the oracle SQL):
#   a part whose key is a multiple of 41 has no year in its title,
#   the year is 1925 + key mod 95, a key multiple of 37 has "(no genres listed)",
#   and genres in this order:
#     Action   when key mod 5 < 2
#     Comedy   when key mod 3 = 0
#     Drama    when key mod 2 = 0
#     IMAX     when key mod 11 = 0
#     Romance  when size mod 4 = 0
#     Thriller when size mod 7 = 0
NO_YEAR_EVERY = 41
YEAR_BASE = 1925
YEAR_SPAN = 95
NO_GENRES_EVERY = 37


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _genre_tags(key: Column, size: Column) -> Column:
    return F.concat_ws(
        "|",
        F.when(key % 5 < 2, F.lit("Action")),
        F.when(key % 3 == 0, F.lit("Comedy")),
        F.when(key % 2 == 0, F.lit("Drama")),
        F.when(key % 11 == 0, F.lit("IMAX")),
        F.when(size % 4 == 0, F.lit("Romance")),
        F.when(size % 7 == 0, F.lit("Thriller")),
    )


def movies_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw movies: ``movieid INT, title STRING, genres STRING`` (``A|B``; may be NULL)."""
    part = read_table(spark, sf_dir, "part")
    key, size, name = F.col("p_partkey"), F.col("p_size"), F.col("p_name")
    title = F.when(key % NO_YEAR_EVERY == 0, name).otherwise(
        F.concat(name, F.lit(" ("), (F.lit(YEAR_BASE) + key % YEAR_SPAN).cast("string"), F.lit(")")))
    genres = F.when(key % NO_GENRES_EVERY == 0, F.lit("(no genres listed)")).otherwise(
        F.nullif(_genre_tags(key, size), F.lit("")))
    return part.select(key.cast("int").alias("movieid"), title.alias("title"), genres.alias("genres"))


def _pow10(n: int) -> Column:
    return F.lit(str(10 ** n)).cast(f"decimal({n + 1},0)")


def ratings_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw ratings: ``userid INT, movieid INT, rating DOUBLE, timestamp BIGINT``.

    One row per (customer, part): the latest line item by (ship date, order,
    line number).  Rating = ceil(quantity / 5) / 2 on the half-star scale;
    timestamp = epoch seconds of the ship day + line number.

    The latest item is found by a hash aggregate with map-side combine:
    (ship day, order key, line number) is packed into one ``decimal(38,0)``
    that orders the same way (order keys < 10^19, line numbers < 10^10 leave
    the lower 29 digits to them), and ``max_by`` keeps the quantity of the
    largest key.  ``max(struct(...))`` would give the same rows but is planned
    as a sort aggregate, and a ``row_number`` window sorts every line item of
    a customer in one task.
    """
    return _latest_items(spark, sf_dir, F.col("l_partkey"))


# Fixed values of the editions view (same text in the oracle SQL): every part has an
# edition per year from 1995 to 2001, with id = key * 10 + years since 1995; its
# genres are the words of the part's name and its type, capitalised.
FIRST_EDITION, LAST_EDITION = 1995, 2001


def edition_movies_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second raw movies table, with a wide vocabulary of genres: a movie is a part's edition of one year."""
    # a small file is one task, however many editions come from it: parts are dealt to tasks, where genres are
    # spelled once a part; they come out of the generator, or filters on them would move back into the scan
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type").repartition("p_partkey")
    genres = F.array_join(F.transform(F.concat(F.split("p_name", " "), F.array("p_type")), F.initcap), "|")
    years = F.sequence(F.lit(FIRST_EDITION), F.lit(LAST_EDITION))
    editions = F.transform(years, lambda year: F.struct(year.alias("year"), F.col("genres").alias("genres")))
    rows = part.select("p_partkey", "p_name", genres.alias("genres")).select("p_partkey", "p_name", F.inline(editions))
    return rows.select((F.col("p_partkey") * 10 + F.col("year") - FIRST_EDITION).cast("int").alias("movieid"),
                       F.concat("p_name", F.lit(" ("), F.col("year").cast("string"), F.lit(")")).alias("title"), "genres")


def edition_ratings_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ratings of editions: one row per (customer, part, year shipped), otherwise as ``ratings_view``.  The
    editions of the last year are rated late in every user's time, so many are not in training."""
    return _latest_items(spark, sf_dir, F.col("l_partkey") * 10 + F.year("l_shipdate") - FIRST_EDITION)


def _latest_items(spark: SparkSession, sf_dir: str, movie: Column) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_shipdate")
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    # merged, never broadcast: the planner takes orders for as small as two columns of its compressed
    # file, and sends millions of rows through the driver
    joined = li.join(orders.hint("merge"), li["l_orderkey"] == orders["o_orderkey"])
    days = F.datediff(F.col("l_shipdate").cast("date"), F.lit("1970-01-01").cast("date"))
    key = (days.cast("decimal(7,0)") * _pow10(29)
           + F.col("l_orderkey").cast("decimal(19,0)") * _pow10(10)
           + F.col("l_linenumber").cast("decimal(10,0)")).cast("decimal(38,0)")
    latest = (joined.select(F.col("o_custkey").alias("userid"), movie.alias("movieid"),
                            "l_quantity", key.alias("key"))
              .groupBy("userid", "movieid")
              .agg(F.max_by("l_quantity", "key").alias("qty"), F.max("key").alias("k")))
    k = F.col("k")
    last_day = F.floor(k / _pow10(29)).cast("bigint")
    line = F.pmod(k, _pow10(10)).cast("bigint")
    return latest.select(
        F.col("userid").cast("int").alias("userid"),
        F.col("movieid").cast("int").alias("movieid"),
        (F.ceil(F.col("qty") / 5).cast("double") / 2).alias("rating"),
        (last_day * 86400 + line).alias("timestamp"),
    )
