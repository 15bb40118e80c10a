"""The clustered store: partitions by model, buckets by user."""

import uuid

import pytest

from genrec.operators import serve
from genrec.session import scratch_dir
from genrec.sources import store
from tests.conftest import rows

LISTS = "userid int, recommendations string"


@pytest.fixture
def opened(spark):
    path = scratch_dir(spark, "store")
    name = store.open_store(spark, "store_" + uuid.uuid4().hex, path, 8)
    yield name, path
    spark.sql(f"DROP TABLE {name}")


def lists(spark, users, mark):
    return spark.createDataFrame([(u, f"{u}:{mark}|7:1.0") for u in users], LISTS)


def test_a_model_is_replaced_alone(spark, opened):
    name, _ = opened
    store.put_predictions(lists(spark, range(50), "1.5"), name, "gbcf")
    store.put_predictions(lists(spark, range(20), "2.5"), name, "als")
    store.put_predictions(lists(spark, range(30, 40), "3.5"), name, "gbcf")
    assert rows(store.get_predictions(spark, name, "gbcf")) == [(u, f"{u}:3.5|7:1.0") for u in range(30, 40)]
    assert store.get_predictions(spark, name, "als").count() == 20
    assert store.get_predictions(spark, name, "ibcf").count() == 0
    with pytest.raises(ValueError):
        store.get_predictions(spark, name, "other")


def scan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_lookups_select_partition_and_buckets(spark, opened):
    name, path = opened
    store.put_predictions(lists(spark, range(400), "1.5"), name, "gbcf")
    few = store.get_predictions(spark, name, "gbcf", [3, 5])
    assert rows(serve.parse_predictions(few), "userid", "movieid") == [(3, 3), (3, 7), (5, 5), (5, 7)]
    # the planner leaves the scan unordered by buckets where nothing asks for them; pruned it is all the same
    assert "Bucketed: false (disabled by query planner)" in scan(few) and len(few.inputFiles()) <= 8
    read = [r[0] for r in few.selectExpr("_metadata.file_path as f").distinct().collect()]
    assert len(read) <= 2
    spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")
    try:
        plan = scan(store.get_predictions(spark, name, "gbcf", [3, 5]))
    finally:
        spark.conf.unset("spark.sql.sources.bucketing.autoBucketedScan.enabled")
    chosen = int(plan.split("SelectedBucketsCount: ")[1].split(" ")[0])
    assert chosen <= 2 and "out of 8" in plan and "PartitionFilters: [isnotnull(model" in plan
    files = list(spark.read.parquet(f"{path}/model=gbcf").inputFiles())
    assert len(files) <= 8


def test_many_ids_join_without_moving_the_store(spark, opened, monkeypatch):
    name, _ = opened
    store.put_predictions(lists(spark, range(400), "1.5"), name, "gbcf")
    monkeypatch.setattr(store, "LOOKUP_IDS", 10)
    old = {k: spark.conf.get(k, None) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        many = store.get_predictions(spark, name, "gbcf", range(100, 300, 2))
        assert [r[0] for r in rows(many)] == list(range(100, 300, 2))
        plan = scan(many)
        assert "SortMergeJoin" in plan and plan.count("Exchange") == 1          # of the ids
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_a_new_session_attaches_what_was_written(spark, opened):
    name, path = opened
    store.put_predictions(lists(spark, range(5), "1.5"), name, "ibcf")
    again = store.open_store(spark, "store_" + uuid.uuid4().hex, path, 8)
    assert store.get_predictions(spark, again, "ibcf").count() == 5
    spark.sql(f"DROP TABLE {again}")
    with pytest.raises(ValueError):
        store.open_store(spark, "no good", path)
