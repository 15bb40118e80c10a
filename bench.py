"""Benchmark the method's jobs end to end on the driver's tables.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_RUNS (default 3).  Prints one JSON line; times are warm medians.

  prepare  views -> filters -> split -> five datasets written as parquet
  predict  weights, top-10 over test movies, accuracy, stored strings (parquet)
  unseen   top-10 unseen movies for every user
  serve    ranked titles for every user from the stored strings
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from genrec.plans import jobs  # noqa: E402
from genrec.session import local_session, scratch_dir  # noqa: E402
from genrec.sources.views import movies_view, ratings_view  # noqa: E402


def _noop(df):
    df.write.format("noop").mode("overwrite").save()


def run_once(spark, sf_dir):
    t = {}
    folder = scratch_dir(spark, "bench")
    s = time.perf_counter()
    jobs.write_prepared(spark, ratings_view(spark, sf_dir), movies_view(spark, sf_dir), f"{folder}/prepared")
    t["prepare"] = time.perf_counter() - s

    d = jobs.read_prepared(spark, f"{folder}/prepared")
    s = time.perf_counter()
    acc = jobs.write_predicted(spark, d["avg_ratings"], d["fav_genres"], d["test"], folder, n=10)
    t["predict"] = time.perf_counter() - s

    s = time.perf_counter()
    _noop(jobs.recommend_unseen(d["avg_ratings"], d["fav_genres"], d["training"], n=10))
    t["unseen"] = time.perf_counter() - s

    s = time.perf_counter()
    _noop(jobs.recommend_for(spark.read.parquet(f"{folder}/stored"), d["titles"],
                             by_movie=spark.read.parquet(f"{folder}/item_counts")))
    t["serve"] = time.perf_counter() - s
    return t, acc


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session(cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8, app_name="genrec-bench")
    run_once(spark, sf_dir)                      # warm-up
    samples = [run_once(spark, sf_dir) for _ in range(runs)]
    queries = {k: round(statistics.median(s[0][k] for s in samples), 3) for k in samples[0][0]}
    acc = samples[-1][1]
    sf = sf_dir.rstrip("/").rsplit("sf", 1)[-1]
    print(json.dumps({
        "metric": "end_to_end_jobs", "value": round(sum(queries.values()), 3), "unit": "sec",
        "queries": queries, "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
        "cpus": cpus, "runs": runs, "accuracy": acc["accuracy"], "hits": acc["hits"], "k": acc["k"],
    }))


if __name__ == "__main__":
    main()
