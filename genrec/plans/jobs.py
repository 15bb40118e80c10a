"""The method's jobs end to end: prepare (A), model + predict + evaluate (B),
serve (C), and unseen-movie recommendation (D), as lazy DataFrames."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from genrec.operators import metrics, model, prep, recommend, serve
from genrec.sources.runs import Run, manifest
from genrec.sources.views import movies_view, ratings_view


def prepared_from_tables(spark: SparkSession, sf_dir: str) -> prep.Prepared:
    """Job A over the driver's tables (movies and ratings views)."""
    return prep.prepare(ratings_view(spark, sf_dir), movies_view(spark, sf_dir))


@dataclass
class Predicted:
    weights: DataFrame
    predictions: DataFrame   # userid, movieid, score (raw), rank
    accuracy: DataFrame      # one row
    stored: DataFrame        # userid, recommendations


def predict(avg: DataFrame, fav: DataFrame, test: DataFrame, n: int = 10, strict: bool = False, exact: bool = False,
            by_user: DataFrame | None = None, by_movie: DataFrame | None = None) -> Predicted:
    """Job B (O64): weights from the model movies, top-n over each user's test
    movies, hit accuracy, and the stored ``id:score|...`` form.

    ``strict=True`` first checks that every favourite genre is known (one
    small action) and raises otherwise; by default unknown genres count 0.
    ``exact=True`` uses unrounded weights and coefficients and rounds the
    score once to 6 digits (the single-machine variant, D13); by default
    every stage rounds to 3 digits.  ``by_user``, ``by_movie``: see
    ``recommend.score_candidates``.
    """
    if strict:
        model.check_known(fav, avg)
    test = prep.test_ratings(test)
    weights = model.genre_weights(avg, digits=None if exact else 3)
    preds = recommend.predictions(fav, test, avg, weights, n, exact, by_user, by_movie)
    return Predicted(weights, preds, metrics.accuracy(preds, test), serve.export_predictions(preds))


def recommend_unseen(avg: DataFrame, fav: DataFrame, training: DataFrame, n: int = 10,
                     exact: bool = False) -> DataFrame:
    """Job D: top-n unseen movies per user (new users need only favourites)."""
    weights = model.genre_weights(avg, digits=None if exact else 3)
    return recommend.unseen_recommendations(fav, training, avg, weights, n, exact)


def recommend_for(stored: DataFrame, titles: DataFrame, user_ids: list[int] | None = None,
                  by_movie: DataFrame | None = None) -> DataFrame:
    """Job C: ranked titles for the given users (all users when None); ``by_movie``: the written ``item_counts``."""
    return serve.user_recommendations(stored, titles, user_ids, by_movie)



PREPARED_TABLES = ("training", "test", "avg_ratings", "fav_genres", "titles")
_RATED = ["userid", "movieid", "rating", "timestamp", "genres"]


def write_prepared(spark: SparkSession, ratings: DataFrame, movies: DataFrame, folder: str,
                   movie_quantile: float = 0.7, user_low: float = 0.5, user_high: float = 0.98) -> str:
    """Job A as a sink: the five datasets as parquet with real arrays.

    The input ratings, the ratings of popular movies and the per-movie and
    per-user counts are written once as helpers; the filtered ratings are
    written partitioned by ``split`` (training / test_raw) in one pass;
    everything else is derived from those written tables, so the big joins
    run once and a lost executor never recomputes them.  The folder is a
    committed run (``sources.runs``): new, marked by a manifest at the end,
    and without helpers whether it succeeds or fails.
    ``<folder>/ratings/split=training`` is the training dataset.
    """
    with Run(spark, folder) as run:
        # The movie percentile, the user band and the split are three global
        # barriers, each needing a pass over the ratings.  The ratings (a join and
        # an aggregate over the raw tables, or a CSV parse) are written once and
        # every pass reads that table instead of recomputing it.
        ratings = run.helper(ratings, "ratings")
        valid = prep.valid_movies(movies)
        counts = run.helper(prep.movie_counts(ratings, valid), "movie-counts")
        # the ratings of popular movies feed the user band and the final join:
        # written once, so the shuffle by movie id runs once
        rated = run.helper(prep.popular_movie_ratings(ratings, valid, movie_quantile, counts), "rated")
        active = prep.active_user_ratings(rated, user_low, user_high, run.helper(prep.user_stats(rated), "user-stats"))
        split = F.when(F.col("timestamp") <= prep.split_cut(), F.lit("training")).otherwise(F.lit("test_raw"))
        run.table("ratings", active.select(*_RATED, split.alias("split")), lambda df: df.write.partitionBy("split"))
        split_ratings = spark.read.parquet(f"{folder}/ratings")
        training = split_ratings.where(F.col("split") == "training").drop("split")
        test_raw = split_ratings.where(F.col("split") == "test_raw").drop("split")
        run.tables({
            "test": prep.drop_cold(test_raw, training, counts),
            "avg_ratings": prep.avg_ratings(training),
            "fav_genres": prep.fav_genres(training),
            "titles": prep.titles(valid),
        })
    return folder


def read_prepared(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The datasets written by ``write_prepared`` (training by partition pruning); raises if the run is not committed."""
    manifest(spark, folder)
    out = {name: spark.read.parquet(f"{folder}/{name}") for name in PREPARED_TABLES if name != "training"}
    out["training"] = spark.read.parquet(f"{folder}/ratings").where(F.col("split") == "training").drop("split")
    return out


def write_predicted(spark: SparkSession, avg: DataFrame, fav: DataFrame, test: DataFrame,
                    folder: str, n: int = 10, strict: bool = False, exact: bool = False):
    """Job B as a sink: predictions written once (parquet), the stored
    ``id:score|...`` strings, the number of lists per movie (``item_counts``)
    and the accuracy row derived from the written table.  Returns the accuracy
    row (one small action)."""
    predict(avg, fav, test, n, strict, exact).predictions.write.mode("errorifexists").parquet(f"{folder}/predictions")
    written = spark.read.parquet(f"{folder}/predictions")
    with ThreadPoolExecutor(max_workers=3) as pool:       # independent jobs
        stored = pool.submit(serve.export_predictions(written).write.mode("errorifexists").parquet,
                             f"{folder}/stored")
        counts = pool.submit(serve.item_counts(written).write.mode("errorifexists").parquet, f"{folder}/item_counts")
        acc = pool.submit(metrics.accuracy(written, prep.test_ratings(test)).first)
        stored.result(), counts.result()
        return acc.result()
