"""Whole results and bounded steps of jobs whose tables grow."""

import shutil

from pyspark.sql import functions as F

from tests.conftest import plan, rows
from tiffin import catalog
from tiffin.catalog.registry import SCHEMAS
from tiffin.functions.columns import money
from tiffin.plans import restaurants
from tiffin.sources import sinks
from tiffin.sources.files import stream_files
from tiffin.streaming import streams as st


def test_sized_write_query_gives_back_every_row(spark, tmp_path):
    lines = [(i, i % 7, 1, 1, 1.0, i + 0.5, 0.0, 0.0, "N", "O", None) for i in range(300)]
    lines += [(None, None, 1, 1, 1.0, None, 0.0, 0.0, "N", "O", None)] * 2
    spark.createDataFrame(lines, SCHEMAS["lineitem"]).write.parquet(str(tmp_path / "lineitem.parquet"))
    found = catalog.load()[0]["k19_sized_write"](spark, str(tmp_path))
    whole = spark.createDataFrame([(r[0], r[1], r[5]) for r in lines], "a bigint, b bigint, c double")
    assert rows(found, "l_orderkey", "l_partkey", "l_extendedprice") == rows(whole)
    assert rows(found.select("row_count", "within_bounds", "few_files").distinct()) == [(302, True, True)]


def test_state_parts_stay_bounded_as_shuffle_partitions_rise(spark, tmp_path):
    source, sink, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))
    spark.range(500).select(F.col("id") % 50).toDF("k").coalesce(1).write.parquet(source)
    before = spark.conf.get(st.SHUFFLE_PARTITIONS)
    spark.conf.set(st.SHUFFLE_PARTITIONS, "60")
    try:
        query = st.update_files(stream_files(spark, source, "k bigint").groupBy("k").agg(F.count("*").alias("n")), sink, checkpoint, ["k"])
        assert query.lastProgress.stateOperators[0].numShufflePartitions == st.state_parts(spark) < 60
        assert spark.conf.get(st.SHUFFLE_PARTITIONS) == "60"
    finally:
        spark.conf.set(st.SHUFFLE_PARTITIONS, before)
    assert rows(st.latest_groups(spark, sink, ["k"]), "k", "n") == [(k, 10) for k in range(50)]


def test_every_core_writes_where_records_bound_the_files(spark, tmp_path):
    path = sinks.write_table(spark.range(1000).toDF("k"), str(tmp_path / "small"), files=2, max_records=100)
    by_file = spark.read.parquet(path).groupBy(F.col("_metadata.file_name").alias("name")).agg(F.count("*").alias("n")).collect()
    assert len({r["name"].split("-")[1] for r in by_file}) == spark.sparkContext.defaultParallelism > 2
    assert sum(r["n"] for r in by_file) == 1000 and max(r["n"] for r in by_file) <= 100
    two = sinks.write_table(spark.range(1000).toDF("k"), str(tmp_path / "two"), files=2)
    assert len(spark.read.parquet(two).inputFiles()) == 2


def test_stock_of_a_hot_restaurant_is_dealt_by_product(spark):
    lines = [(1, p % 40, 2.0, 3.0) for p in range(120)] + [(2, 7, 1.0, None), (2, 7, 1.0, 2.0)]
    inventory = spark.createDataFrame(lines, "restaurant_id bigint, product_id bigint, quantity double, v double").withColumn("inventory_value", money("v")).drop("v")
    dim = spark.createDataFrame([(1, "a", "X"), (2, "b", "Y")], "restaurant_id bigint, name string, city string")
    products = spark.createDataFrame([(7, "bolt", "T")], "product_id bigint, product_name string, product_type string")
    found = restaurants.restaurant_inventory(inventory, dim)
    assert rows(found) == [(1, 40, 240.0, 360.0, 3.0, "a", "X"), (2, 1, 2.0, 2.0, 2.0, "b", "Y")]
    assert "hashpartitioning(restaurant_id" in plan(found) and "REPARTITION_BY_NUM" in plan(found)
    assert rows(restaurants.product_summary(inventory, products)) == [(7, 2, 8.0, 11.0, 1.6, "bolt", "T")]


def test_streamed_join_keeps_few_parts(spark, tmp_path):
    left, right, sink, checkpoint = (str(tmp_path / n) for n in ("l", "r", "out", "cp"))
    spark.sql("SELECT id AS k, timestamp_seconds(id * 60) AS ts FROM range(1, 41)").coalesce(1).write.parquet(left)
    spark.sql("SELECT id AS rk, timestamp_seconds(id * 60 + 30) AS rts FROM range(1, 41)").coalesce(1).write.parquet(right)
    before = spark.conf.get(st.SHUFFLE_PARTITIONS)
    spark.conf.set(st.SHUFFLE_PARTITIONS, "48")
    try:
        a, b = stream_files(spark, left, "k bigint, ts timestamp"), stream_files(spark, right, "rk bigint, rts timestamp")
        query = st.append_files(st.stream_interval_join(a, b, ("k", "rk"), ("ts", "rts"), 60), sink, checkpoint)
        assert query.lastProgress.stateOperators[0].numShufflePartitions == st.state_parts(spark) < 48
    finally:
        spark.conf.set(st.SHUFFLE_PARTITIONS, before)
    assert rows(spark.read.parquet(sink), "k", "rk") == [(k, k) for k in range(1, 41)]


def test_alerts_join_only_rows_that_may_become_one(spark, tmp_path, monkeypatch):
    at = lambda minute: f"2024-01-01 0{minute // 60}:{minute % 60:02d}:00"
    lines = [(1, at(0), 1, "view", 30.0), (2, at(50), 1, "click", None), (3, at(55), 1, "purchase", 1.0), (4, at(20), 1, "click", 2.0)]
    lines += [(5, at(0), 2, "view", 5.0), (6, at(50), 2, "click", 1.0), (7, at(0), 3, "view", None), (8, at(60), 3, "click", 1.0)]
    lines += [(9, at(0), 4, "view", 20.0), (10, at(100), 4, "click", 1.0), (11, at(100), None, "click", 1.0), (12, at(0), None, "view", 99.0)]
    table = spark.createDataFrame(lines, "event_id bigint, ts string, user_id bigint, event_type string, value double")
    table.select("event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type", "value", F.lit("{}").alias("props")).coalesce(1).write.parquet(str(tmp_path / "rows"))
    (tmp_path / "in").mkdir()
    shutil.copy(next((tmp_path / "rows").glob("part-*.parquet")), tmp_path / "in" / "events.parquet")
    seen, finish = [], st.finish
    monkeypatch.setattr(st, "finish", lambda query: seen.append(finish(query)) or seen[-1])
    found = catalog.load()[0]["e03_alert_messages"](spark, str(tmp_path / "in"))
    message = '{{"order_id":{0},"alert_type":"DELIVERY_DELAY","current_status":"click","message":"Order {0} is delayed ({1} minutes). Driver: {2}"}}'
    assert rows(found) == [("1", message.format(1, "50.0", 1)), ("9", message.format(9, "100.0", 4))]
    kept = sum(o.numRowsUpdated for p in seen[0].recentProgress for o in p.stateOperators)
    assert kept == 2 + 2 * 5  # orders of 20 and more, each click of a known user in two buckets
