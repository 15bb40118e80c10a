"""Registered queries: one per operator of the method, each over the whole
driver tables.  Lists are returned as ``|``-joined strings so that results
compare across engines; every computed column has a fixed name."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from genrec.operators import factors, metrics, model, neighbours, prep, quantiles, recommend, serve
from genrec.operators.skew import salted_lookup
from genrec.plans import jobs
from genrec.sources import csv_io, store
from genrec.sources.views import edition_movies_view, edition_ratings_view, movies_view, ratings_view, read_table
from genrec.session import scratch_dir, stored

N = 10
RATED = ["userid", "movieid", "rating", "timestamp", "genres"]

Query = Callable[[SparkSession, str], DataFrame]


def _joined(df: DataFrame, *cols: str) -> DataFrame:
    for c in cols:
        df = df.withColumn(c, F.array_join(c, "|"))
    return df


class _Ctx:
    """Building blocks for one (session, folder); ``p`` and ``popular`` write their stages once."""

    def __init__(self, spark: SparkSession, sf_dir: str, views=(movies_view, ratings_view)):
        self.spark, self.sf_dir = spark, sf_dir
        self.movies, self.ratings = (view(spark, sf_dir) for view in views)
        self.valid = prep.valid_movies(self.movies)

    @cached_property
    def popular(self):
        counts = stored(prep.movie_counts(self.ratings, self.valid), "movie-counts")
        return stored(prep.popular_movie_ratings(self.ratings, self.valid, counts=counts), "rated")

    @cached_property
    def p(self) -> prep.Prepared:
        return prep.prepare(self.ratings, self.movies)

    @cached_property
    def weights(self) -> DataFrame:
        return model.genre_weights(self.p.avg_ratings)

    @property
    def demand(self) -> dict[str, DataFrame]:
        return {"by_user": self.p.by_user, "by_movie": self.p.by_movie}

    @cached_property
    def predictions(self) -> DataFrame:
        p = self.p
        return recommend.predictions(p.fav_genres, prep.test_ratings(p.test), p.avg_ratings, self.weights, N, **self.demand)

    @cached_property
    def candidate_pairs(self) -> DataFrame:
        """Distinct ``pkey, pgenres, skey`` of the candidates."""
        p = self.p
        c = salted_lookup(recommend.test_candidates(p.fav_genres, p.test, p.by_user),
                          recommend.user_profiles(p.fav_genres), ["userid"], "movieid", p.by_user)
        c = salted_lookup(c, recommend.movie_profiles(p.avg_ratings).select("movieid", "skey"),
                          ["movieid"], "userid", p.by_movie)
        return c.select("pkey", "pgenres", "skey").distinct()


def _q(build: Callable[[_Ctx], DataFrame]) -> Query:
    return lambda spark, sf_dir: build(_Ctx(spark, sf_dir))


def _editions(build: Callable[[_Ctx], DataFrame]) -> Query:
    """The same over the editions of parts: a wide vocabulary, and movies that only test ratings know."""
    return lambda spark, sf_dir: build(_Ctx(spark, sf_dir, (edition_movies_view, edition_ratings_view)))


def _time_span(c: _Ctx) -> DataFrame:
    users = prep.band_users(prep.user_stats(c.popular))
    return users.select("userid", "ts_min", "ts_max", prep.split_cut().alias("cut"))


def _user_genre_hist(c: _Ctx) -> DataFrame:
    h = prep.user_genre_hist(c.p.training)
    total = F.sum("cnt").over(Window.partitionBy("userid"))
    return h.select("userid", "genre", "cnt", total.alias("total"), (F.col("cnt") / total).alias("share"))


def _accuracy(c: _Ctx) -> DataFrame:
    a = metrics.accuracy(c.predictions, prep.test_ratings(c.p.test))
    return a.withColumn("accuracy_macro", F.round("accuracy_macro", 10))


def _exported(c: _Ctx) -> dict[str, DataFrame]:
    p = c.p
    return csv_io.export_tables(p.training, p.test, p.avg_ratings, p.fav_genres, p.titles)


def _csv_roundtrip(c: _Ctx) -> DataFrame:
    """All five datasets written and read back: ``dataset`` and a row as JSON text."""
    folder = csv_io.write_prepared(_exported(c), csv_io.run_folder(scratch_dir(c.spark, "prepared")))
    back = csv_io.read_prepared(c.spark, folder)
    tables = {name: _joined(back[name], *[f for f, t in back[name].dtypes if t.startswith("array")])
              for name in csv_io.DATASETS}
    out = None
    for name, df in tables.items():
        values = [F.coalesce(F.col(x).cast("string"), F.lit("")) for x in df.columns]
        rows = df.select(F.lit(name).alias("dataset"), F.concat_ws(";", *values).alias("row"))
        out = rows if out is None else out.unionByName(rows)
    return out


def _read_csv(c: _Ctx) -> DataFrame:
    path = f"{scratch_dir(c.spark, 'raw')}/movies.csv"
    csv_io.write_csv(c.movies, path)
    return csv_io.read_movies(c.spark, path)


def _read_ratings_csv(c: _Ctx) -> DataFrame:
    path = f"{scratch_dir(c.spark, 'raw')}/ratings.csv"
    csv_io.write_csv(c.ratings, path)
    return csv_io.read_ratings(c.spark, path)


def _line_ratings(c: _Ctx) -> DataFrame:
    """Every line item as a rating, so a customer's later items of a part repeat the pair."""
    li, orders = (read_table(c.spark, c.sf_dir, t) for t in ("lineitem", "orders"))
    rows = li.join(orders.hint("merge"), li["l_orderkey"] == orders["o_orderkey"])    # never broadcast, see views
    day = F.datediff(F.col("l_shipdate").cast("date"), F.lit("1970-01-01").cast("date")).cast("long")
    return rows.select(F.col("o_custkey").cast("int").alias("userid"), F.col("l_partkey").cast("int").alias("movieid"),
                       (F.ceil(F.col("l_quantity") / 5).cast("double") / 2).alias("rating"),
                       (day * 86400 + F.col("l_linenumber")).alias("timestamp"), "l_shipdate", "l_orderkey", "l_linenumber")


def _later_duplicates(c: _Ctx) -> DataFrame:
    """All line items written in the order of their dates; the reader keeps the last of each pair."""
    path = f"{scratch_dir(c.spark, 'raw')}/ratings.csv"
    ordered = _line_ratings(c).orderBy("l_shipdate", "l_orderkey", "l_linenumber")
    csv_io.write_csv(ordered.select("userid", "movieid", "rating", "timestamp"), path)
    return csv_io.read_ratings(c.spark, path)


def _damaged_csv(c: _Ctx) -> str:
    """Line items as rating lines, of which some lack a field, have one too many, or words for numbers."""
    path = f"{scratch_dir(c.spark, 'raw')}/ratings.csv"
    n = F.col("l_linenumber")
    line = F.concat_ws(",", "userid", F.when(n == 3, F.concat(F.lit("m"), F.col("movieid"))).otherwise(F.col("movieid").cast("string")),
                       F.when(n == 4, F.lit("good")).otherwise(F.col("rating").cast("string")), F.when(n != 5, F.col("timestamp")),
                       F.when(n == 6, F.lit("more")))
    _line_ratings(c).select(line.alias("value")).write.text(path)
    return path


def _csv_outcome(c: _Ctx) -> DataFrame:
    """``reason, n``: where the lines of a damaged file went; ``kept`` is the rows that are read."""
    rows, rejects = csv_io.read_with_rejects(c.spark, _damaged_csv(c), csv_io.RATINGS, header=False)
    count = F.count(F.lit(1)).alias("n")
    return rows.agg(count).select(F.lit("kept").alias("reason"), "n").unionByName(rejects.groupBy("reason").agg(count))


def _csv_rejects(c: _Ctx) -> DataFrame:
    return csv_io.read_with_rejects(c.spark, _damaged_csv(c), csv_io.RATINGS, header=False)[1].select("reason", "text")


def _read_titles_csv(c: _Ctx) -> DataFrame:
    path = f"{scratch_dir(c.spark, 'raw')}/titles.csv"
    csv_io.write_csv(prep.titles(c.valid), path)
    return csv_io.read_titles(c.spark, path)


def _predictions_csv(c: _Ctx, name: str = "gbcf") -> DataFrame:
    root = scratch_dir(c.spark, "outputs")
    csv_io.write_predictions(_stored(c), f"{root}/{name}.csv")
    return csv_io.read_predictions(c.spark, root, name)


def _coefficients(c: _Ctx) -> DataFrame:
    """The coefficients that candidates ask for, 0 where the model has no entry."""
    coeffs = model.set_coefficients(recommend.genre_sets(c.p.avg_ratings), c.weights)
    sets = F.split("skey", r"[|]")
    asked = c.candidate_pairs.select("skey", F.explode("pgenres").alias("genre_u")).distinct().select(
        "skey", "genre_u", (F.size(sets) - F.array_contains(sets, F.col("genre_u")).cast("int")).alias("norm"),
        F.explode(sets).alias("genre_m"))
    return asked.join(coeffs, ["skey", "genre_u", "genre_m", "norm"], "left").select(
        "genre_u", "genre_m", "norm", F.coalesce("coeff", F.lit(0.0)).alias("coeff")).distinct()


def _affinities(c: _Ctx) -> DataFrame:
    maps = model.set_maps(recommend.genre_sets(c.p.avg_ratings), c.weights)
    return c.candidate_pairs.join(maps, "skey").select(
        "pkey", "skey", F.size("pgenres").alias("n_fav"),
        model.affinity_of(F.col("pgenres"), F.col("affinity")).cast("double").alias("aff"))


def _score(c: _Ctx) -> DataFrame:
    p = c.p
    return recommend.score_candidates(recommend.test_candidates(p.fav_genres, p.test, p.by_user), p.fav_genres,
                                      p.avg_ratings, c.weights, **c.demand)


def _stored(c: _Ctx) -> DataFrame:
    return serve.export_predictions(c.predictions)


LEAST_COSINE, BOOST = 0.05, 0.5


def _neighbours(c: _Ctx) -> DataFrame:
    return neighbours.item_neighbours(c.p.training, N, LEAST_COSINE)


def _neighbour_scores(c: _Ctx, boost: float) -> DataFrame:
    sims = neighbours.boosted(stored(_neighbours(c), "neighbours"), c.p.avg_ratings, boost)
    return neighbours.neighbour_scores(prep.test_ratings(c.p.test), c.p.training, sims)


def _rmse_by_method(c: _Ctx) -> DataFrame:
    """C1 of the genre scores beside that of neighbour scores without and with the genre boost."""
    found = stored(_neighbours(c), "neighbours")
    out = metrics.rmse(c.predictions, c.p.test).select(F.lit("genres").alias("method"), "n", "rmse")
    for name, boost in (("neighbours", 0.0), ("neighbours_boosted", BOOST)):
        sims = neighbours.boosted(found, c.p.avg_ratings, boost)
        scores = neighbours.neighbour_scores(prep.test_ratings(c.p.test), c.p.training, sims)
        out = out.unionByName(metrics.rmse(scores, c.p.test).select(F.lit(name).alias("method"), "n", "rmse"))
    return out


def _als_top_n(c: _Ctx) -> DataFrame:
    """Trained factors, their top-N stored as the model ``als`` and read back."""
    best = factors.factor_top_n(*factors.als_factors(c.p.training), N)
    root = scratch_dir(c.spark, "outputs")
    csv_io.write_predictions(serve.export_predictions(best), f"{root}/als.csv")
    return csv_io.read_predictions(c.spark, root, "als")


def _store(c: _Ctx) -> str:
    """A store of two models: genre predictions and the top-N of neighbour scores."""
    path = scratch_dir(c.spark, "store")
    name = store.open_store(c.spark, path.rsplit("/", 1)[-1].replace("-", "_"), path, 8)
    best = recommend.top_n(_neighbour_scores(c, 0.0), N)
    for model_name, stored_lists in (("gbcf", _stored(c)), ("ibcf", serve.export_predictions(best))):
        store.put_predictions(stored_lists, name, model_name)
    return name


def _bounded_thresholds(c: _Ctx) -> DataFrame:
    """The three thresholds by sketches; users' sketches are merged from those of parts (of a day each in a running system)."""
    movies = stored(prep.positive_count_per_movie(c.ratings, c.valid), "movie-positives")
    users = stored(prep.positive_count_per_user(c.popular), "user-positives")
    parts = quantiles.quantile_sketch(users.withColumn("part", F.pmod("userid", F.lit(2))), "n_pos", ["part"])
    whole = stored(quantiles.merged_sketch(parts), "user-sketch")
    found = [("movie", 0.7, quantiles.exact_percentile(movies, "n_pos", 0.7))] + [
        ("user", q, quantiles.exact_percentile(users, "n_pos", q, whole)) for q in (0.5, 0.98)]
    return c.spark.createDataFrame(found, "what string, share double, threshold double")


def queries() -> dict[str, Query]:
    return {
        # sources: driver tables as movies and ratings
        "movies": _q(lambda c: c.movies),
        "ratings": _q(lambda c: c.ratings),
        # the second view: cold movies and a wide vocabulary
        "edition_movies": _editions(lambda c: c.movies),
        "edition_ratings": _editions(lambda c: c.ratings),
        "edition_training": _editions(lambda c: _joined(c.p.training, "genres")),
        "edition_test_raw": _editions(lambda c: _joined(prep.time_split(c.p.ratings)[1], "genres")),
        "edition_cold_movies": _editions(lambda c: prep.cold_movies(*prep.time_split(c.p.ratings))),
        "edition_test": _editions(lambda c: _joined(c.p.test, "genres")),
        "edition_fav_genres": _editions(lambda c: _joined(c.p.fav_genres, "favgenres")),
        "edition_genre_weights": _editions(lambda c: c.weights),
        "edition_predictions": _editions(lambda c: c.predictions),
        "edition_accuracy": _editions(lambda c: _accuracy(c)),
        "edition_unseen": _editions(lambda c: jobs.recommend_unseen(c.p.avg_ratings, c.p.fav_genres, c.p.training, N)),
        # projections and filters
        "movie_year": _q(lambda c: prep.movie_years(c.movies)),
        "split_genres": _q(lambda c: _joined(prep.split_genres(c.movies), "genres")),
        "valid_movies": _q(lambda c: _joined(c.valid, "genres")),
        "positive_ratings": _q(lambda c: prep.positive_ratings(c.ratings)),
        # joins and aggregates of preparation
        "ratings_with_genres": _q(lambda c: _joined(prep.ratings_with_genres(c.ratings, c.valid), "genres")),
        "positive_count_per_movie": _q(lambda c: prep.positive_count_per_movie(c.ratings, c.valid)),
        "movie_threshold": _q(lambda c: prep.movie_threshold(prep.positive_count_per_movie(c.ratings, c.valid))),
        "popular_movie_ratings": _q(lambda c: _joined(c.popular, "genres")),
        "bounded_thresholds": _q(_bounded_thresholds),
        "positive_count_per_user": _q(lambda c: prep.positive_count_per_user(c.popular)),
        "user_band": _q(lambda c: prep.user_band(prep.user_stats(c.popular))),
        "user_time_span": _q(_time_span),
        "active_user_ratings": _q(lambda c: _joined(c.p.ratings.select(*RATED), "genres")),
        "training": _q(lambda c: _joined(c.p.training, "genres")),
        "test_raw": _q(lambda c: _joined(prep.time_split(c.p.ratings)[1], "genres")),
        "cold_movies": _q(lambda c: prep.cold_movies(*prep.time_split(c.p.ratings))),
        "test": _q(lambda c: _joined(c.p.test, "genres")),
        "test_ratings": _q(lambda c: prep.test_ratings(c.p.test)),
        "avg_ratings": _q(lambda c: _joined(c.p.avg_ratings, "genres")),
        "movie_profiles": _q(lambda c: recommend.movie_profiles(c.p.avg_ratings).select(
            "movieid", "avgrating", "skey", F.size("sgenres").alias("n_genres"))),
        "user_genre_hist": _q(_user_genre_hist),
        "fav_genres": _q(lambda c: _joined(c.p.fav_genres, "favgenres")),
        "titles": _q(lambda c: prep.titles(c.valid)),
        # model
        "genre_pairs": _q(lambda c: model.genre_pairs(c.p.avg_ratings)),
        "genre_pair_counts": _q(lambda c: model.genre_pair_counts(c.p.avg_ratings)),
        "genre_weights": _q(lambda c: model.genre_weights(c.p.avg_ratings)),
        "known_genres": _q(lambda c: model.known_genres(c.p.avg_ratings)),
        # scoring
        "test_candidates": _q(lambda c: recommend.test_candidates(c.p.fav_genres, c.p.test, c.p.by_user)),
        "genre_coefficient": _q(_coefficients),
        "genre_affinity": _q(_affinities),
        "score": _q(_score),
        "dropped_candidates": _q(lambda c: recommend.dropped_candidates(
            c.ratings, c.p.fav_genres, c.p.avg_ratings)),
        "predictions": _q(lambda c: c.predictions),
        "top_n": _q(lambda c: recommend.top_n(_score(c), 3)),
        "predictions_exact": _q(lambda c: jobs.predict(c.p.avg_ratings, c.p.fav_genres, c.p.test,
                                                       N, exact=True, **c.demand).predictions),
        "clip_scores": _q(lambda c: recommend.clip_scores(c.predictions)),
        # evaluation
        "accuracy_per_user": _q(lambda c: metrics.accuracy_per_user(c.predictions, prep.test_ratings(c.p.test))),
        "accuracy": _q(_accuracy),
        "rmse": _q(lambda c: metrics.rmse(c.predictions, c.p.test)),
        # export and serving
        "predictions_export": _q(_stored),
        "predictions_parse": _q(lambda c: serve.parse_predictions(_stored(c))),
        "first_predictions": _q(lambda c: serve.first_predictions(_stored(c), 50)),
        "user_recommendations": _q(lambda c: jobs.recommend_for(_stored(c), prep.titles(c.valid))),
        # item neighbours
        "item_cosine": _q(_neighbours),
        "item_cosine_common": _q(lambda c: neighbours.item_neighbours(c.p.training, N, 0.02, min_common=2)),
        "neighbour_scores": _q(lambda c: _neighbour_scores(c, 0.0)),
        "neighbour_scores_boosted": _q(lambda c: _neighbour_scores(c, BOOST)),
        "rmse_by_method": _q(_rmse_by_method),
        # clustered store of predictions
        "prediction_store_ibcf": _q(lambda c: store.get_predictions(c.spark, _store(c), "ibcf")),
        "prediction_store_users": _q(lambda c: serve.parse_predictions(store.get_predictions(
            c.spark, _store(c), "gbcf", prep.positive_ratings(c.p.test).select("userid").distinct()))),
        # best inner products of factors
        "factor_top_n": _q(lambda c: factors.factor_top_n(*factors.genre_factors(c.p.training, c.p.avg_ratings), N)),
        "als_top_n": _q(_als_top_n),
        # unseen movies
        "seen_movies": _q(lambda c: recommend.seen_movies(c.p.training)),
        "unseen_counts": _q(lambda c: recommend.unseen_counts(
            c.p.fav_genres, c.p.training, c.p.avg_ratings, c.p.by_movie)),
        "unseen_recommendations": _q(lambda c: jobs.recommend_unseen(c.p.avg_ratings, c.p.fav_genres,
                                                                     c.p.training, N)),
        # CSV sinks and sources (write below the checkpoint folder, read back)
        "read_csv": _q(_read_csv),
        "read_ratings_csv": _q(_read_ratings_csv),
        "later_duplicates": _q(_later_duplicates),
        "csv_outcome": _q(_csv_outcome),
        "csv_rejects": _q(_csv_rejects),
        "read_titles_csv": _q(_read_titles_csv),
        "export_training": _q(lambda c: _exported(c)["training"]),
        "csv_roundtrip": _q(_csv_roundtrip),
        "predictions_csv": _q(_predictions_csv),
        "predictions_csv_als": _q(lambda c: _predictions_csv(c, "als")),
    }


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top-10 predictions per user with scores: preparation, model and scoring."""
    return queries()["predictions"](spark, sf_dir)
