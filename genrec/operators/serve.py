"""Stored predictions: the ``id:score|id:score`` format, parsing it back, and
per-user ranked titles."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from genrec.operators.recommend import clip_scores
from genrec.operators.skew import salted_lookup


def export_predictions(preds: DataFrame, cap: float = 5.0) -> DataFrame:
    """``userid, recommendations`` with ``movieid:score`` by rank, clipped scores.

    The per-user list holds the top-N only; no single-partition repartition.
    """
    p = clip_scores(preds, cap)
    return p.groupBy("userid").agg(
        F.sort_array(F.collect_list(F.struct("rank", "movieid", "score"))).alias("xs")
    ).select("userid", F.array_join(F.transform("xs", lambda x: F.concat(
        x["movieid"].cast("string"), F.lit(":"), x["score"].cast("string"))), "|").alias("recommendations"))


def parse_predictions(stored: DataFrame) -> DataFrame:
    """``userid, rank, movieid, score`` from ``userid, recommendations``.

    Malformed items give NULL ids or scores (``try_cast``) instead of failing.
    """
    items = stored.select("userid", F.posexplode(F.split("recommendations", r"[|]")).alias("pos", "item"))
    parts = F.split("item", ":")
    return items.where(F.col("item") != "").select(
        "userid", (F.col("pos") + 1).alias("rank"),
        parts[0].try_cast("int").alias("movieid"), parts[1].try_cast("double").alias("score"))


def first_predictions(stored: DataFrame, n: int = 50) -> DataFrame:
    """The first ``n`` stored rows by user id (a report: the limit is the feature)."""
    return stored.orderBy("userid").limit(n)


def item_counts(preds: DataFrame) -> DataFrame:
    """``movieid, _n``: in how many lists a movie stands, which the writer of the lists keeps for those who join titles."""
    return preds.groupBy("movieid").agg(F.count(F.lit(1)).alias("_n"))


def user_recommendations(stored: DataFrame, titles: DataFrame, user_ids: list[int] | None = None,
                         by_movie: DataFrame | None = None) -> DataFrame:
    """``userid, rank, title, score`` — stored predictions with titles,
    ranked by score desc then movie id; movies without a title drop out.

    ``user_ids`` filters before parsing (the filter reaches the parquet scan);
    ``None`` serves every user.  An empty result means no recommendations.
    ``by_movie`` (``item_counts``) saves parsing every string again to find the
    movies that most lists hold.
    """
    if user_ids is not None:
        stored = stored.where(F.col("userid").isin(list(user_ids)))
    parsed, names = parse_predictions(stored), titles.select("movieid", "title")
    # a movie in most users' lists is a hot key; some users' lists are a few rows
    recs = (parsed.join(names, "movieid") if user_ids is not None
            else salted_lookup(parsed, names, ["movieid"], "userid", by_movie))
    w = Window.partitionBy("userid").orderBy(F.col("score").desc(), F.col("movieid").asc())
    return recs.select("userid", F.row_number().over(w).alias("rank"),
                       F.trim("title").alias("title"), "score")
