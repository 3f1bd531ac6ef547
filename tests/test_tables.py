"""Row changes, snapshot datasets, layout, sources and sinks."""

import pytest
from pyspark.sql import functions as F, types as T

from tests.conftest import plan, rows
from tiffin.operators import versions as v
from tiffin.operators.quality import FAIL, QualityError, Rule
from tiffin.sources import files, generators, jdbc, sinks


@pytest.fixture
def states(spark):
    old = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0), (3, None, 3.0)], "id int, s string, x double")
    new = spark.createDataFrame([(2, "B", 2.0), (3, None, 3.0), (4, "d", 4.0)], "id int, s string, x double")
    return old, new


def test_update_and_delete_leave_rows_without_answer(spark, states):
    old, _ = states
    assert rows(v.update_where(old, F.col("s") != "a", {"x": F.lit(9)})) == [(1, "a", 1.0), (2, "b", 9.0), (3, None, 3.0)]
    assert rows(v.delete_where(old, F.col("s") != "a"), "id") == [(1,), (3,)]


def test_upsert(spark, states):
    old, new = states
    assert rows(v.upsert(old, new, ["id"])) == [(1, "a", 1.0), (2, "B", 2.0), (3, None, 3.0), (4, "d", 4.0)]
    assert rows(v.upsert(old, new, ["id"], insert=False), "id") == [(1,), (2,), (3,)]


def test_upsert_fails_on_duplicate_source_keys(spark, states):
    old, new = states
    with pytest.raises(Exception, match="matches more than one source row"):
        v.upsert(old, new.union(new), ["id"]).collect()


def test_change_feed_and_merge_on_read(spark, states):
    old, new = states
    feed = v.change_feed(old, new, ["id"])
    assert rows(feed, "id", "change_type") == [
        (1, "delete"), (2, "update_postimage"), (2, "update_preimage"), (4, "insert")
    ]
    gone = feed.filter(F.col("change_type").isin("delete", "update_preimage")).select("id")
    added = feed.filter(F.col("change_type").isin("insert", "update_postimage")).drop("change_type")
    assert rows(v.read_merged(old, gone, added, ["id"])) == rows(new)


def test_deliveries_dated_by_the_data(spark, tmp_path):
    days = spark.createDataFrame([(1, "2024-01-05"), (2, "2024-01-31"), (3, "2024-02-01"), (4, None)], "id int, d string").withColumn("d", F.to_timestamp("d"))
    base = v.append_by_month(days, str(tmp_path / "t"), "d")
    v.append_by_month(spark.createDataFrame([(5, "2024-03-01"), (6, "2024-01-07")], "id int, d string").withColumn("d", F.to_timestamp("d")), base, "d")
    loads = v.read_deliveries(spark, base)
    assert rows(v.delivered(loads, only="2024-01"), "id") == [(1,), (2,), (6,)] and rows(v.delivered(loads, until="2024-02"), "id") == [(1,), (2,), (3,), (6,)]
    assert "PartitionFilters: [isnotnull(delivery" in plan(v.delivered(loads, only="2024-01"))
    counts = v.delivery_counts(loads, "d")
    assert rows(v.delivery_evolution(counts), "delivery", "rows", "row_change") == [("2024-01", 3, 3), ("2024-02", 1, -2), ("2024-03", 1, 0)]
    assert rows(v.beyond_retention(counts, 1, "2024-03"), "delivery") == [("2024-01",), ("2024-02",)]


def test_write_audit_publish(spark, states, tmp_path):
    old, new = states
    base = v.write_audit_publish(old, [], str(tmp_path / "w"), 1)
    before = sorted(str(p) for p in (tmp_path / "w").rglob("*.parquet"))
    with pytest.raises(QualityError):
        v.write_audit_publish(new, [Rule("known", "s IS NOT NULL", FAIL)], base, 2)
    assert sorted(str(p) for p in (tmp_path / "w").rglob("*.parquet")) == before
    v.write_audit_publish(new, [Rule("known", "s IS NOT NULL")], base, 2)
    assert set(before) < {str(p) for p in (tmp_path / "w").rglob("*.parquet")}
    assert rows(spark.read.parquet(base), "id") == [(1,), (2,), (2,), (3,), (4,)]


def test_evolve_and_fit_schema(spark, states):
    old, _ = states
    assert v.evolve(old, add={"c": F.lit(1)}, rename={"s": "name"}, drop=["x"]).columns == ["id", "name", "c"]
    text = spark.createDataFrame([("1", "x"), ("oops", "y"), (None, "z")], "id string, s string")
    good, bad = v.fit_schema(text, T.StructType.fromDDL("id int, s string, x double"))
    assert rows(good) == [(None, "z", None), (1, "x", None)] and rows(bad) == [("oops", "y")]
    with pytest.raises(QualityError):
        v.fit_schema(text.withColumn("other", F.lit(1)), old.schema)


def overlap(spark, path, column):
    """Share of files a point lookup has to open, on average over some points."""
    ranges = v.file_ranges(spark.read.parquet(path), [column]).collect()
    return sum(r[f"min_{column}"] <= point <= r[f"max_{column}"] for r in ranges for point in range(0, 1000, 50)) / (20 * len(ranges))


def test_zorder_narrows_file_ranges(spark, tmp_path):
    df = spark.range(4000).select(
        F.pmod(F.xxhash64("id"), F.lit(1000)).alias("a"), F.pmod(F.xxhash64("id", F.lit(1)), F.lit(1000)).alias("b")
    )
    plain, clustered = str(tmp_path / "plain"), str(tmp_path / "z")
    df.repartition(16).write.parquet(plain)
    v.zorder(df, ["a", "b"], 16).write.parquet(clustered)
    assert rows(spark.read.parquet(clustered)) == rows(df)
    for column in ("a", "b"):
        assert overlap(spark, clustered, column) < 0.6 * overlap(spark, plain, column)


def test_compact_and_metrics(spark, tmp_path):
    many, few = str(tmp_path / "many"), str(tmp_path / "few")
    spark.range(100).repartition(10).write.parquet(many)
    v.compact(spark, many, few, 2)
    before, after = (v.table_metrics(spark.read.parquet(p)).first() for p in (many, few))
    assert (before.files, after.files, after.row_count) == (10, 2, 100)


def test_partition_and_pushed_filters(spark, tmp_path):
    df = spark.range(100).select("id", F.pmod("id", F.lit(3)).alias("p"))
    path = sinks.write_table(df, str(tmp_path / "p"), partition_by=["p"])
    read = files.read_table(spark, path).filter("p = 1 AND id > 50").select("id")
    text = plan(read)
    assert "PartitionFilters: [isnotnull(p" in text and "GreaterThan(id,50)" in text
    assert read.count() == 16


def test_dynamic_overwrite_keeps_other_partitions(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, p string")
    path = sinks.write_table(df, str(tmp_path / "d"), partition_by=["p"])
    sinks.overwrite_partitions(spark.createDataFrame([(9, "a")], "id int, p string"), path, ["p"])
    assert rows(files.read_table(spark, path), "id", "p") == [(2, "b"), (9, "a")]


def test_write_modes(spark, tmp_path):
    df, path = spark.range(3), str(tmp_path / "m")
    sinks.write_table(df, path)
    with pytest.raises(Exception, match="already exists"):
        sinks.write_table(df, path)
    sinks.write_table(df, path, mode="append")
    assert files.read_table(spark, path).count() == 6


def test_bucketed_join_has_no_exchange(spark, tmp_path):
    for name in ("b_left", "b_right"):
        sinks.save_bucketed(spark.range(50).withColumnRenamed("id", "k"), name, str(tmp_path / name), 4, ["k"])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = spark.table("b_left").join(spark.table("b_right"), "k")
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
        assert joined.count() == 50
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP TABLE b_left")
        spark.sql("DROP TABLE b_right")


def test_bloom_column_reads_back(spark, tmp_path):
    path = v.write_with_bloom(spark.range(1000).select(F.col("id").cast("string").alias("s")), str(tmp_path / "bloom"), "s", 1000)
    assert rows(files.read_table(spark, path).filter("s = '77'")) == [("77",)]


def test_hinted_and_rescued(spark, tmp_path):
    path = str(tmp_path / "j")
    spark.createDataFrame([('{"a":1,"b":"x"}',), ('{"a":2,"c":3}',)], "value string").write.text(path)
    read = files.read_hinted(spark, path, "a STRING, d DOUBLE")
    assert dict(read.dtypes) == {"a": "string", "b": "string", "c": "bigint", "d": "double"}
    lines = spark.createDataFrame([('{"a":1,"z":5}',), ('{"a":2}',), ("broken",)], "value string")
    assert rows(files.rescue_columns(lines, "a INT")) == [(None, '{"_corrupt":"broken"}'), (1, '{"z":"5"}'), (2, None)]


def test_generators(spark):
    orders = spark.range(700).select(F.col("id").alias("n"), (F.col("id") * 2).alias("v"))
    made = generators.skewed_orders(orders, "n", 3)
    assert rows(made.groupBy("n", "v").count(), "n", "v", "count") == [(i, 2 * i, 3) for i in range(700)]
    assert made.select("order_id").distinct().count() == 2100
    hot = made.filter(F.col("restaurant_key").isin("REST0", "REST1", "REST2")).count()
    assert hot == 1890 and made.select("restaurant_key").distinct().count() > 60
    assert rows(generators.recursive_numbers(spark, 4)) == [(1,), (2,), (3,), (4,)]


def test_sized_write_counts_nothing(spark, tmp_path):
    df = spark.range(200_000).select("id", F.xxhash64("id").alias("h"))
    spark.conf.set(sinks.ADVISORY, "64m")
    sizes = sinks.write_sized(df, str(tmp_path / "s"), 300_000)
    assert max(sizes) < 600_000 and 3 < len(sizes) < 40 and sum(sizes) > 1_000_000
    assert spark.conf.get(sinks.ADVISORY) == "64m" and spark.read.parquet(str(tmp_path / "s")).count() == 200_000
    spark.conf.unset(sinks.ADVISORY)
    assert len(sinks.write_sized(df, str(tmp_path / "one"))) == 1


def test_bloom_filter_spares_rows(spark, tmp_path):
    df = spark.range(20_000).select(F.pmod(F.xxhash64("id"), F.lit(1 << 40)).alias("k"), "id").repartition(16, "id")
    path = v.write_with_bloom(df, str(tmp_path / "b"), "k")
    plain = str(tmp_path / "p")
    df.write.option("parquet.enable.dictionary", "false").parquet(plain)
    wanted = df.filter("id = 77").first().k
    with_filter, without = (v.rows_and_scanned(spark.read.parquet(p).filter(F.col("k") == wanted)) for p in (path, plain))
    assert with_filter[0] == without[0] == 1 and with_filter[1] < without[1] / 4


class FakeReader:
    """Stands in for a database, which the tests may not start."""

    def __init__(self, spark, answer):
        self.calls, self.answer = [], answer
        self.read, self.sparkContext = self, spark.sparkContext

    def jdbc(self, url, table, **options):
        self.calls.append((table, options))
        return self.answer


def test_jdbc_reads(spark):
    bounds = spark.createDataFrame([(5, 105)], "lo int, hi int")
    fake = FakeReader(spark, bounds)
    jdbc.read_jdbc(fake, "jdbc:x", "orders", column="id", parts=4)
    assert fake.calls[0][0] == "(SELECT MIN(id) AS lo, MAX(id) AS hi FROM orders) b"
    assert fake.calls[1][1] == {"column": "id", "lowerBound": 5, "upperBound": 106, "numPartitions": 4, "properties": {}}
    fake.calls.clear()
    jdbc.read_jdbc(fake, "jdbc:x", "SELECT a FROM t", partition_predicates=["a < 1", "a >= 1"])
    assert fake.calls[0] == ("(SELECT a FROM t) q", {"predicates": ["a < 1", "a >= 1"], "properties": {}})


def test_schema_diff(spark):
    df = spark.createDataFrame([(1, 2)], "ID int, extra int")
    assert jdbc.schema_diff(df, ["id", "name"]) == (["extra"], ["name"])


def test_lake_layers(spark, tmp_path):
    """Gold tables from the written layers equal those computed directly; the hour of an order survives."""
    import datetime as dt

    from tiffin.plans import lake

    restaurants = spark.createDataFrame(
        [(1, "A", "x", "c1", 4.6, 10), (2, "B", "y", "c1", 3.0, 20), (3, "N", "y", "c2", None, 1)],
        "restaurant_id int, name string, cuisine string, city string, rating double, reviews int",
    )
    drivers = spark.createDataFrame([(7, "D", "c1", "bike"), (8, "E", "c2", "car")], "driver_id int, driver_name string, city string, vehicle string")
    sales = spark.createDataFrame(
        [(1, 1, 7, 10.0, dt.datetime(2024, 1, 1, 9)), (2, 1, 7, 20.5, dt.datetime(2024, 2, 1, 21)), (3, 2, 7, None, dt.datetime(2024, 2, 1, 21))],
        "order_id int, restaurant_id int, driver_id int, amount double, order_date timestamp",
    )
    base = str(tmp_path / "lake")
    lake.build_lake(restaurants, drivers, sales, base, [(4.5, "Excellent")])
    gold = lambda name: files.read_table(spark, f"{base}/gold/{name}")
    assert rows(gold("restaurant_performance"), "name", "rating_category", "order_count", "total_revenue", "avg_order_value") == [
        ("A", "Excellent", 2, 30.5, 15.25), ("B", "Below Average", 0, None, None)
    ]
    assert rows(gold("cuisine_performance"), "cuisine", "total_orders", "total_revenue") == [("x", 2, 30.5), ("y", 0, None)]
    assert rows(gold("driver_performance"), "driver_name", "delivery_count", "total_revenue") == [("D", 2, 30.5), ("E", 0, None)]
    assert rows(gold("time_analytics"), "month", "hour", "order_count") == [(1, 9, 1), (2, 21, 1)]


def test_relational_job_writes_every_table(spark, monkeypatch):
    from tiffin.plans import lake

    written = []
    monkeypatch.setattr(lake, "write_jdbc", lambda df, url, name, mode, properties: written.append((name, mode, df.columns[0])))
    lake.load_relational({"a": spark.range(1), "b": spark.range(1)}, "jdbc:x", {})
    assert written == [("a", "overwrite", "id"), ("b", "overwrite", "id")]


def test_staged_refresh_stops_on_a_short_load(spark, monkeypatch):
    statements = []
    monkeypatch.setattr(jdbc, "write_jdbc", lambda *a, **k: None)

    class Frame:
        def __init__(self, loaded):
            self.sparkSession = FakeReader(spark, spark.createDataFrame([(loaded,)], "n bigint"))

        def count(self):
            return 3

    with pytest.raises(ValueError):
        jdbc.staged_refresh(Frame(2), "jdbc:x", "orders", statements.extend)
    assert not statements
    assert jdbc.staged_refresh(Frame(3), "jdbc:x", "orders", statements.extend) == 3
    assert [s.split()[0] for s in statements] == ["DROP", "ALTER", "ALTER", "DROP"]


def test_scratch_tables_go_when_asked(spark, tmp_path, monkeypatch):
    from pathlib import Path

    from tiffin import session

    monkeypatch.setattr(session, "shared_dir", lambda _: str(tmp_path))
    kept = session.durable(spark.range(5), "numbers")
    assert kept.count() == 5 and Path(session.scratch_root(spark)).exists()
    session.clear_scratch(spark)
    assert not Path(session.scratch_root(spark)).exists()
