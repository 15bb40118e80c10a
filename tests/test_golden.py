"""Golden samples: hand-computed weights, scores, accuracy and rankings."""

import pytest

from genrec.operators import metrics, model, recommend, serve
from genrec.plans import jobs
from tests.conftest import rows
from tests.fixtures import model_sample, serving_sample, unseen_sample


def test_weights(spark):
    movies, _, _ = model_sample(spark)
    w = model.genre_weights(movies)
    assert rows(w, "genre_a", "genre_b", "n", "weight") == sorted([
        ("Crime", "Drama", 2, 0.5), ("Crime", "War", 2, 0.5), ("Drama", "War", 3, 0.75),
        ("Drama", "Crime", 1, 0.25), ("War", "Crime", 1, 1.0), ("Horror", "Crime", 1, 1.0)])


def test_exact_weights_sum_to_one(spark):
    movies, _, _ = model_sample(spark)
    w = model.genre_weights(movies, digits=None)
    sums = w.groupBy("genre_a").sum("weight").collect()
    assert all(abs(r[1] - 1.0) < 1e-12 for r in sums)


def test_known_genres(spark):
    movies, _, _ = model_sample(spark)
    assert rows(model.known_genres(movies)) == [("Crime",), ("Drama",), ("Horror",), ("War",)]


def test_scores_and_ranks(spark):
    movies, fav, test = model_sample(spark)
    res = jobs.predict(movies, fav, test, n=10)
    got = rows(res.predictions, "userid", "rank", "movieid", "score")
    assert got == [(1, 1, 14, 5.0), (1, 2, 15, 2.25), (1, 3, 13, 1.875),
                   (2, 1, 15, 6.0), (2, 2, 12, 1.75), (2, 3, 13, 0.0),
                   (3, 1, 14, 6.25), (3, 2, 11, 6.0), (3, 3, 12, 1.75),
                   (4, 1, 12, 4.375), (4, 2, 16, 4.124), (4, 3, 11, 3.666)]


def test_export_and_accuracy(spark):
    movies, fav, test = model_sample(spark)
    res = jobs.predict(movies, fav, test, n=10)
    assert rows(res.stored) == [(1, "14:5.0|15:2.25|13:1.875"), (2, "15:5.0|12:1.75|13:0.0"),
                                (3, "14:5.0|11:5.0|12:1.75"), (4, "12:4.375|16:4.124|11:3.666")]
    per_user = rows(metrics.accuracy_per_user(res.predictions, test), "userid", "hits", "k")
    assert per_user == [(1, 1, 2), (2, 2, 2), (3, 1, 2), (4, 0, 0)]
    a = res.accuracy.first()
    assert (a["hits"], a["k"]) == (4, 6)
    assert a["accuracy"] == pytest.approx(4 / 6)
    assert a["accuracy_macro"] == pytest.approx(2 / 3)
    r = metrics.rmse(res.predictions, test).first()
    assert r["n"] == 12 and r["rmse"] == pytest.approx(2.313974, abs=1e-6)


def test_top_n_limits(spark):
    movies, fav, test = model_sample(spark)
    res = jobs.predict(movies, fav, test, n=1)
    assert max(r["rank"] for r in res.predictions.collect()) == 1
    # k = min(positives, predictions): user 2 has 2 positives but 1 prediction
    per_user = dict((u, (h, k)) for u, h, k in rows(
        metrics.accuracy_per_user(res.predictions, test), "userid", "hits", "k"))
    assert per_user[2] == (1, 1)


def test_unseen_sample(spark):
    training, movies, fav = unseen_sample(spark)
    w = model.genre_weights(movies)
    assert rows(w, "genre_a", "genre_b", "weight") == [("War", "Crime", 1.0)]
    out = jobs.recommend_unseen(movies, fav, training, n=10)
    assert rows(out, "userid", "rank", "movieid", "score") == [
        (5, None, None, None), (6, 1, 21, 4.0), (6, 2, 22, 4.0)]


def test_serving_sample(spark):
    stored, titles = serving_sample(spark)
    out = jobs.recommend_for(stored, titles, [7])
    assert [(r["rank"], r["title"], r["score"]) for r in out.orderBy("rank").collect()] == [
        (1, "Nine Doors (2003)", 5.0), (2, "Harbour Lights (1951)", 4.4), (3, "The Long Ferry (1987)", 4.4),
        (4, "Salt (1966)", 0.25)]
    # movie 99 has no title
    assert rows(jobs.recommend_for(stored, titles), "userid", "rank", "score")[4:] == [(8, 1, 3.0), (8, 2, 1.0), (9, 1, 0.0)]
    assert jobs.recommend_for(stored, titles, [99]).count() == 0


def test_parse_export_roundtrip(spark):
    movies, fav, test = model_sample(spark)
    res = jobs.predict(movies, fav, test, n=10)
    back = serve.parse_predictions(res.stored)
    clipped = recommend.clip_scores(res.predictions)
    assert rows(back, "userid", "rank", "movieid", "score") == rows(clipped, "userid", "rank", "movieid", "score")


def test_first_predictions(spark):
    stored, _ = serving_sample(spark)
    assert [r["userid"] for r in serve.first_predictions(stored, 2).collect()] == [7, 8]
