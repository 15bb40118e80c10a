"""Evaluation: hit accuracy of the top-N against positive test ratings, and RMSE."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from genrec.operators.prep import is_positive


def accuracy_per_user(preds: DataFrame, test: DataFrame) -> DataFrame:
    """``userid, n_pred, n_pos, k, hits`` for users with predictions and test rows.

    k = min(positives in test, predictions); hits = positives among the first k
    predictions by rank.  The per-user list holds at most N predictions.
    """
    truth = test.select("userid", "movieid", is_positive().alias("positive"))
    marked = preds.select("userid", "movieid", "rank").join(truth, ["userid", "movieid"], "left")
    per_user = marked.groupBy("userid").agg(
        F.count(F.lit(1)).alias("n_pred"),
        F.collect_list(F.struct("rank", F.coalesce("positive", F.lit(False)).alias("positive"))).alias("marks"))
    n_pos = test.groupBy("userid").agg(F.count_if(is_positive()).alias("n_pos"))
    joined = per_user.join(n_pos, "userid")
    k = F.least("n_pred", "n_pos")
    hits = F.size(F.filter("marks", lambda x: (x["rank"] <= k) & x["positive"]))
    return joined.select("userid", "n_pred", "n_pos", k.alias("k"), hits.cast("bigint").alias("hits"))


def accuracy(preds: DataFrame, test: DataFrame) -> DataFrame:
    """One row ``hits, k, accuracy, accuracy_macro``.

    ``accuracy`` = sum(hits) / sum(k) over users (NULL when no user has k > 0);
    ``accuracy_macro`` = mean of hits / k over users with k > 0, averaged as
    decimals (18 places per ratio) so the result does not depend on the order
    of the partial sums.
    """
    per_user = accuracy_per_user(preds, test)
    ratio = F.try_divide(F.col("hits").cast("decimal(20,0)"), F.col("k").cast("decimal(20,0)"))
    return per_user.agg(
        F.sum("hits").alias("hits"), F.sum("k").alias("k"),
        F.try_divide(F.sum("hits").cast("double"), F.sum("k").cast("double")).alias("accuracy"),
        F.avg(ratio).cast("double").alias("accuracy_macro"))


def rmse(preds: DataFrame, test: DataFrame, cap: float = 5.0) -> DataFrame:
    """One row ``n, rmse`` of the clipped predicted score against the test rating.

    Scores have 3 decimals and ratings 1, so squared errors are summed exactly as
    decimals (the result does not depend on the order of the partial sums).
    """
    j = preds.join(test.select("userid", "movieid", "rating"), ["userid", "movieid"])
    err = (F.least(F.col("score"), F.lit(cap)).cast("decimal(10,3)")
           - F.col("rating").cast("decimal(10,3)"))
    return j.agg(F.count(F.lit(1)).alias("n"),
                 F.sqrt(F.sum(err * err).cast("double") / F.count(F.lit(1))).alias("rmse"))
