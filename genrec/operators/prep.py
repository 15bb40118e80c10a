"""Preparation: clean movies, filter thin movies and users, split by time,
average ratings and favourite genres.

Thresholds are percentiles computed by aggregates and applied through scalar
subqueries (``DataFrame.scalar()``): no value goes through the driver and no
cross join is planned.  Percentiles are exact (``percentile`` keeps one counter
per distinct value, and the values here are counts, so the buffer stays small).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from genrec.functions.genres import BLANK_GENRES, clean_genres, parse_pipe, title_year
from genrec.operators.skew import salted_lookup
from genrec.session import stored

# Fixed values of the method:
#   a rating >= 3 is positive; a movie needs a year after 1942;
#   favourite genres reach a 0.2 share of the user's genre mentions,
#   or else the top 2 by share are taken.
POSITIVE = 3.0
MIN_YEAR_EXCLUSIVE = 1942
FAV_SHARE = 0.2
FAV_FALLBACK = 2


def is_positive(rating: str = "rating"):
    return F.col(rating) >= F.lit(POSITIVE)


# ---------------------------------------------------------------- movies

def movie_years(movies: DataFrame) -> DataFrame:
    """``movieid, title, year`` with year ``''`` when the title has none."""
    return movies.select("movieid", "title", title_year("title").alias("year"))


def split_genres(movies: DataFrame) -> DataFrame:
    """``movieid, genres ARRAY`` (NULL genres stay NULL)."""
    return movies.select("movieid", parse_pipe("genres").alias("genres"))


def valid_movies(movies: DataFrame) -> DataFrame:
    """Movies with a year after 1942 and listed genres; genres without IMAX.

    ``movieid INT, title STRING, genres ARRAY<STRING>, year INT``.  A movie whose
    only genre is IMAX stays, with an empty list.
    """
    raw = parse_pipe("genres")
    year = title_year("title").try_cast("int")
    return (
        movies.where(F.col("genres").isNotNull())
        .select("movieid", "title", raw.alias("raw"), year.alias("year"))
        .where((F.col("year") > MIN_YEAR_EXCLUSIVE) & ~F.array_contains("raw", BLANK_GENRES))
        .select("movieid", "title", clean_genres(F.col("raw")).alias("genres"), "year")
    )


def titles(valid: DataFrame) -> DataFrame:
    return valid.select("movieid", "title")


# ---------------------------------------------------------------- ratings

def positive_ratings(ratings: DataFrame) -> DataFrame:
    """O13."""
    return ratings.where(is_positive())


def ratings_with_genres(ratings: DataFrame, valid: DataFrame, counts: DataFrame | None = None) -> DataFrame:
    """Ratings of valid movies, with their genres (a movie-row lookup per
    rating, salted for very popular movies by ``movie_counts``)."""
    return salted_lookup(ratings, valid.select("movieid", "genres"), ["movieid"], "userid",
                         movie_demand(counts if counts is not None else movie_counts(ratings, valid))).select(
        "userid", "movieid", "rating", "timestamp", "genres")


def movie_demand(counts: DataFrame) -> DataFrame:
    """``movieid, _n``: from ``movie_counts``, the most rows that can ask for a movie."""
    return counts.select("movieid", F.col("n_all").alias("_n"))


def user_demand(stats: DataFrame) -> DataFrame:
    """``userid, _n``: from ``user_stats``, the most rows that can ask for a user."""
    return stats.select("userid", F.col("n_all").alias("_n"))


def movie_counts(ratings: DataFrame, valid: DataFrame) -> DataFrame:
    """``movieid, n_pos, n_all`` for valid movies with at least one rating.

    Counted on the raw ratings (partial aggregation map-side) and then kept for
    valid movies only, so the big ratings table is joined once, later; ``n_all``
    is the number of rating rows that will look the movie up.  Joins of whole
    movie tables are merged here and below: the planner takes a movie table for
    as small as its files (see ``salted_lookup``) and would broadcast it.
    """
    counts = ratings.groupBy("movieid").agg(F.count_if(is_positive()).alias("n_pos"),
                                            F.count(F.lit(1)).alias("n_all"))
    # not a semi join, which the planner would move below the counts
    return counts.join(valid.select("movieid").distinct().hint("merge"), "movieid")


def positive_count_per_movie(ratings: DataFrame, valid: DataFrame) -> DataFrame:
    """Positive ratings per valid movie (movies with none do not appear)."""
    return movie_counts(ratings, valid).where(F.col("n_pos") > 0).select("movieid", "n_pos")


def movie_threshold(counts: DataFrame, quantile: float = 0.7) -> DataFrame:
    """One row, the linear-interpolated percentile of the per-movie counts."""
    return counts.select(F.percentile("n_pos", F.lit(quantile)).alias("threshold"))


def popular_movies(counts: DataFrame, quantile: float = 0.7) -> DataFrame:
    """Movies whose positive count reaches the percentile."""
    return counts.where(F.col("n_pos") >= movie_threshold(counts, quantile).scalar())


def popular_movie_ratings(ratings: DataFrame, valid: DataFrame, quantile: float = 0.7,
                          counts: DataFrame | None = None) -> DataFrame:
    """O18+O19+O32 in one join: ratings of popular valid movies, with genres.

    The join looks up one movie row per rating; a movie rated by a large share
    of all rows is salted (``salted_lookup``), with the request counts taken
    from the same per-movie aggregate that gives the percentile.
    """
    counts = counts if counts is not None else movie_counts(ratings, valid)
    keep = popular_movies(counts.where(F.col("n_pos") > 0), quantile)
    movies = valid.select("movieid", "genres").join(keep.select("movieid").hint("merge"), "movieid", "left_semi")
    return salted_lookup(ratings, movies, ["movieid"], "userid", movie_demand(counts)).select(
        "userid", "movieid", "rating", "timestamp", "genres")


def user_stats(ratings: DataFrame) -> DataFrame:
    """O33 + O21 in one aggregate: positive count, first and last timestamp and
    number of rows per user."""
    return ratings.groupBy("userid").agg(
        F.count_if(is_positive()).alias("n_pos"),
        F.min("timestamp").alias("ts_min"),
        F.max("timestamp").alias("ts_max"),
        F.count(F.lit(1)).alias("n_all"),
    )


def positive_count_per_user(ratings: DataFrame) -> DataFrame:
    """Users with at least one positive rating and their count."""
    return positive_ratings(ratings).groupBy("userid").agg(F.count(F.lit(1)).alias("n_pos"))


def user_band(stats: DataFrame, low: float = 0.5, high: float = 0.98) -> DataFrame:
    """One row ``p_low, p_high`` over users with at least one positive rating."""
    q = F.percentile("n_pos", F.array(F.lit(low), F.lit(high)))
    return stats.where(F.col("n_pos") > 0).select(q[0].alias("p_low"), q[1].alias("p_high"))


def band_users(stats: DataFrame, low: float = 0.5, high: float = 0.98) -> DataFrame:
    """Users whose positive count lies in ``[p_low, p_high]`` (O34 filter)."""
    q = stats.where(F.col("n_pos") > 0).select(
        F.percentile("n_pos", F.array(F.lit(low), F.lit(high))).alias("q")).scalar()
    return stats.where(F.col("n_pos").between(q[0], q[1]))


def split_cut():
    """O53 cut: 80 % of each user's time span, same operation order as the method."""
    return (F.col("ts_max") - F.col("ts_min")) / 5 * 4 + F.col("ts_min")


def active_user_ratings(ratings: DataFrame, low: float = 0.5, high: float = 0.98,
                        stats: DataFrame | None = None) -> DataFrame:
    """O20 + O21: ratings of users in the band, with the user's time span.

    One user row per rating; a user with a large share of all rows is salted,
    with the request counts from the per-user aggregate of the band.
    """
    stats = stats if stats is not None else user_stats(ratings)
    users = band_users(stats, low, high).select("userid", "ts_min", "ts_max")
    return salted_lookup(ratings, users, ["userid"], "movieid", user_demand(stats))


def time_split(active: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(training, test before cold-movie removal).

    ``(userid, movieid)`` is unique, so "ratings minus training" is the
    complement of the cut; no set difference (which would de-duplicate) is used.
    """
    cols = ["userid", "movieid", "rating", "timestamp", "genres"]
    early = F.col("timestamp") <= split_cut()
    return active.where(early).select(*cols), active.where(~early).select(*cols)


def cold_movies(training: DataFrame, test_raw: DataFrame) -> DataFrame:
    """Movies rated in test only."""
    return (test_raw.select("movieid").distinct()
            .join(training.select("movieid").distinct().hint("merge"), "movieid", "left_anti"))


def drop_cold(test_raw: DataFrame, training: DataFrame, counts: DataFrame | None = None) -> DataFrame:
    """Test rows whose movie also occurs in training (by movie id).

    A lookup of the distinct training movies, salted for movies that a large
    share of the test rows carry.  ``counts`` (``movie_counts``) bounds the
    test rows per movie from above, which is all the salting needs; without
    it the test rows are counted.
    """
    demand = movie_demand(counts) if counts is not None else None
    return salted_lookup(test_raw, training.select("movieid").distinct(), ["movieid"], "userid",
                         demand).select(*test_raw.columns)


TEST_TYPES = {"userid": T.IntegralType, "movieid": T.IntegralType, "rating": T.NumericType}


def test_ratings(test: DataFrame) -> DataFrame:
    """The three columns the predictor uses; raises before any job if one is
    missing or not a number (ids: whole numbers)."""
    found = {f.name: f.dataType for f in test.schema.fields}
    missing = set(TEST_TYPES) - set(found)
    if missing:
        raise ValueError(f"test table lacks columns {sorted(missing)}")
    wrong = {c: found[c].simpleString() for c, kind in TEST_TYPES.items() if not isinstance(found[c], kind)}
    if wrong:
        raise ValueError(f"test table has columns of the wrong type: {wrong}")
    return test.select(F.col("userid").cast("int"), F.col("movieid").cast("int"),
                       F.col("rating").cast("double"))


# ---------------------------------------------------------------- derived

def avg_ratings(training: DataFrame) -> DataFrame:
    """``movieid, avgrating, genres`` over training.

    Genres depend on the movie only, so they are carried as a grouping key
    (same groups, hash aggregate with map-side combine) instead of a second
    join; ``any_value`` on an array would force a sort aggregate.
    """
    return training.groupBy("movieid", "genres").agg(F.avg("rating").alias("avgrating")).select(
        "movieid", "avgrating", "genres")


def user_genre_hist(training: DataFrame) -> DataFrame:
    """``userid, genre, cnt`` (a genre counts once per seen movie)."""
    return (training.select("userid", F.explode("genres").alias("genre"))
            .groupBy("userid", "genre").agg(F.count(F.lit(1)).alias("cnt")))


def fav_genres(training: DataFrame, share: float = FAV_SHARE, fallback: int = FAV_FALLBACK) -> DataFrame:
    """``userid, favgenres ARRAY`` ordered by share desc, then name.

    If at least two genres reach ``share`` of the user's genre mentions they
    are all favourites, otherwise the top ``fallback`` by share.  The histogram
    is aggregated first, so the per-user list holds one entry per genre, never
    one per rating.
    """
    hist = user_genre_hist(training)
    per_user = hist.groupBy("userid").agg(
        F.sort_array(F.collect_list(F.struct((-F.col("cnt")).alias("neg"), F.col("genre")))).alias("h"),
        F.sum("cnt").alias("total"))
    above = F.filter("h", lambda x: (-x["neg"]) / F.col("total") >= F.lit(share))
    chosen = F.when(F.size(above) >= 2, above).otherwise(F.slice("h", 1, fallback))
    return per_user.select("userid", F.transform(chosen, lambda x: x["genre"]).alias("favgenres"))


# ---------------------------------------------------------------- all steps

@dataclass
class Prepared:
    valid_movies: DataFrame
    ratings: DataFrame       # popular movies, active users, with genres and time span
    training: DataFrame
    test: DataFrame
    avg_ratings: DataFrame
    fav_genres: DataFrame
    titles: DataFrame
    by_movie: DataFrame      # movieid, _n: the most rows that can ask for a movie
    by_user: DataFrame       # userid, _n


def prepare(ratings: DataFrame, movies: DataFrame, movie_quantile: float = 0.7,
            user_low: float = 0.5, user_high: float = 0.98) -> Prepared:
    """Whole preparation (A).

    The movie percentile, the user band and the split are global barriers, so
    the ratings, the per-movie and per-user statistics and the two filtered
    ratings tables are written once below the checkpoint folder and read by
    everything after them: five writing jobs; what is returned is lazy over
    those tables.
    """
    valid = valid_movies(movies)
    ratings = stored(ratings, "ratings")
    counts = stored(movie_counts(ratings, valid), "movie-counts")
    rated = stored(popular_movie_ratings(ratings, valid, movie_quantile, counts), "rated")
    stats = stored(user_stats(rated), "user-stats")
    active = stored(active_user_ratings(rated, user_low, user_high, stats), "active")
    training, test_raw = time_split(active)
    test = drop_cold(test_raw, training, counts)
    return Prepared(valid, active, training, test, avg_ratings(training), fav_genres(training),
                    titles(valid), movie_demand(counts), user_demand(stats))
