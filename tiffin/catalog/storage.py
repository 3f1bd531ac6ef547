"""Reading and writing queries (S*, K*). Each writes the input in some form and gives back what it reads there."""

import uuid

from pyspark.sql import functions as F

from tiffin.catalog import roles as r
from tiffin.catalog.projections import ENRICHED_SQL, deliveries
from tiffin.catalog.registry import SCHEMAS, query
from tiffin.session import scratch_path
from tiffin.sources import files, generators, sinks
from tiffin.streaming.delivery import actionable_alerts, to_messages

EVENTS_SQL = "SELECT event_id, ts, user_id, event_type, value, props FROM events"
PART_SQL = "SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part"


def table_name(label):
    return f"tiffin_{label}_{uuid.uuid4().hex[:12]}"


@query("s01_json_inferred", "SELECT CAST(p_partkey AS BIGINT) AS p_partkey, p_name, p_type, CAST(p_size AS BIGINT) AS p_size, p_retailprice FROM part")
def s01(t):
    path = sinks.write_table(t.part.drop("p_brand"), scratch_path(t.spark, "json"), "json")
    return files.read_table(t.spark, path, "json")


@query("s02_json_schema_glob", EVENTS_SQL)
def s02(t):
    micros = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
    path = sinks.write_table(t.events, scratch_path(t.spark, "json"), "json", files=3, **micros)
    return files.read_table(t.spark, f"{path}/*.json", "json", SCHEMAS["events"], **micros)


@query("s02_json_hinted", "SELECT p_partkey, p_name, p_type, CAST(p_size AS DOUBLE) AS p_size, CAST(p_retailprice AS VARCHAR) AS p_retailprice FROM part")
def s02_hinted(t):
    path = sinks.write_table(t.part.drop("p_brand"), scratch_path(t.spark, "json"), "json")
    return files.read_hinted(t.spark, path, "p_size DOUBLE, p_retailprice STRING")


@query("s03_csv", PART_SQL)
def s03(t):
    path = sinks.write_table(t.part, scratch_path(t.spark, "csv"), "csv")
    return files.read_table(t.spark, path, "csv").withColumn("p_partkey", F.col("p_partkey").cast("bigint"))


@query("s04_parquet_orc", PART_SQL + " UNION ALL " + PART_SQL)
def s04(t):
    orc = sinks.write_table(t.part, scratch_path(t.spark, "orc"), "orc")
    return files.read_table(t.spark, t.path("part"), schema=SCHEMAS["part"]).unionByName(files.read_table(t.spark, orc, "orc"))


@query("s05_many_files", "SELECT s_suppkey AS id, s_name AS name FROM supplier UNION ALL SELECT c_custkey, c_name FROM customer")
def s05(t):
    a = sinks.write_table(t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name")), scratch_path(t.spark, "a"))
    b = sinks.write_table(t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name")), scratch_path(t.spark, "b"))
    return files.read_table(t.spark, [a, b])


@query("s06_partition_pruning", "SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 100000")
def s06(t):
    path = sinks.write_table(t.orders, scratch_path(t.spark, "parts"), partition_by=["o_orderstatus"])
    rows = files.read_table(t.spark, path).filter((F.col("o_orderstatus") == "F") & (F.col("o_totalprice") > 100000))
    return rows.select("o_orderkey", "o_totalprice", "o_orderstatus")


@query("s07_sql_over_files", "SELECT p_type, count(*) AS n, max(p_size) AS top FROM part GROUP BY p_type")
def s07(t):
    view = table_name("view")
    files.file_view(t.spark, view, "parquet", t.path("part"))
    return t.spark.sql(
        f"SELECT v.p_type, count(*) AS n, max(f.p_size) AS top FROM {view} v "
        f"JOIN parquet.`{t.path('part')}` f ON v.p_partkey = f.p_partkey GROUP BY v.p_type"
    )


@query("s13_rescue_fields", """
SELECT event_id, event_type, CASE WHEN value > 100 THEN '{"bonus":"' || event_type || '"}' END AS rescued FROM events""")
def s13(t):
    bonus = F.when(F.col("value") > 100, F.col("event_type")).alias("bonus")
    lines = t.events.select(F.to_json(F.struct("event_id", "event_type", bonus)).alias("value"))
    return files.rescue_columns(lines, "event_id BIGINT, event_type STRING")


@query("s14_lineage", "SELECT c_custkey, c_name, 'customer.parquet' AS file, true AS stamped FROM customer")
def s14(t):
    rows = files.add_lineage(t.customer)
    return rows.select(
        "c_custkey", "c_name", F.element_at(F.split("source_file", "/"), -1).alias("file"),
        F.col("ingestion_timestamp").isNotNull().alias("stamped"),
    )


@query("s15_literal_rows", """
SELECT o_orderkey, o_orderpriority, weight FROM orders JOIN (VALUES ('1-URGENT', 5), ('2-HIGH', 3), ('3-MEDIUM', 2)) w(p, weight) ON o_orderpriority = p""")
def s15(t):
    weights = generators.rows_from(t.spark, [("1-URGENT", 5), ("2-HIGH", 3), ("3-MEDIUM", 2)], "p STRING, weight INT")
    return t.orders.join(F.broadcast(weights), F.col("o_orderpriority") == F.col("p")).select("o_orderkey", "o_orderpriority", "weight")


@query("s16_generated_orders", """
SELECT id AS order_id, 'REST' || CASE WHEN id % 10 < 5 THEN (id // 10) % 3 ELSE 3 + (id // 10) % 497 END AS restaurant_key, o_custkey, o_totalprice
FROM (SELECT *, unnest([o_orderkey * 3, o_orderkey * 3 + 1, o_orderkey * 3 + 2]) AS id FROM orders)""")
def s16(t):
    """The orders three times as many, half of them on three restaurants."""
    made = generators.skewed_orders(t.orders, "o_orderkey", 3, hot_tenths=5)
    return made.select("order_id", "restaurant_key", "o_custkey", "o_totalprice")


@query("s17_number_sequence", "SELECT p_partkey, unnest(range(1, p_size + 1)) AS n FROM part")
def s17(t):
    return generators.number_sequence(t.part.withColumn("_one", F.lit(1)), "_one", "p_size").select("p_partkey", "n")


@query("s18_random_shifts", "SELECT s_suppkey, 'Day' AS shift_type, true AS in_range FROM supplier")
def s18(t):
    shifts = generators.gen_shifts(t.supplier, "s_suppkey", F.lit("2024-02-01").cast("date"))
    ok = (
        F.col("earnings").between(0, 500) & F.col("shift_minutes").between(0, 300) & F.col("distance_km").between(0, 100)
        & F.col("start_date").between(F.lit("2024-01-02").cast("date"), F.lit("2024-02-01").cast("date"))
    )
    return shifts.select("s_suppkey", "shift_type", ok.alias("in_range"))


@query("k01_formats", "SELECT f AS format, p_partkey, p_name FROM part, (VALUES ('csv'), ('json'), ('orc'), ('parquet')) x(f)")
def k01(t):
    rows, parts = t.part.select("p_partkey", "p_name"), []
    for kind in ("csv", "json", "orc", "parquet"):
        path = sinks.write_table(rows, scratch_path(t.spark, kind), kind)
        options = {"header": "true"} if kind == "csv" else {}
        parts.append(files.read_table(t.spark, path, kind, rows.schema, **options).withColumn("format", F.lit(kind)))
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


@query("k02_modes", "SELECT s_suppkey, s_name FROM supplier UNION ALL SELECT s_suppkey, s_name FROM supplier")
def k02(t):
    rows, path = t.supplier.select("s_suppkey", "s_name"), scratch_path(t.spark, "modes")
    sinks.write_table(rows, path)
    sinks.write_table(rows.filter("s_suppkey < 0"), path, mode="ignore")
    sinks.write_table(rows, path, mode="overwrite")
    sinks.write_table(rows, path, mode="append")
    return files.read_table(t.spark, path)


@query("k03_compression", "SELECT x AS codec, y AS file_codec, p_partkey FROM part, (VALUES ('gzip', 'gz'), ('snappy', 'snappy'), ('zstd', 'zstd'), ('none', '')) c(x, y)")
def k03(t):
    parts = []
    for codec in ("gzip", "snappy", "zstd", "none"):
        path = sinks.write_table(t.part, scratch_path(t.spark, codec), compression=codec)
        named = F.regexp_extract(F.col("_metadata.file_name"), r"\.(\w+)\.parquet$", 1)
        parts.append(files.read_table(t.spark, path).select(F.lit(codec).alias("codec"), named.alias("file_codec"), "p_partkey"))
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


@query("k04_partitioned_write", "SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders")
def k04(t):
    rows = t.orders.select("o_orderkey", "o_orderstatus", "o_orderpriority")
    path = sinks.write_table(rows, scratch_path(t.spark, "two-level"), partition_by=["o_orderstatus", "o_orderpriority"])
    return files.read_table(t.spark, path)


@query("k05_dynamic_overwrite", """
SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderstatus = 'F' THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice FROM orders""")
def k05(t):
    rows, path = t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice"), scratch_path(t.spark, "dynamic")
    sinks.write_table(rows, path, partition_by=["o_orderstatus"])
    changed = rows.filter(F.col("o_orderstatus") == "F").withColumn("o_totalprice", F.col("o_totalprice") * 2)
    sinks.overwrite_partitions(changed, path, ["o_orderstatus"])
    return files.read_table(t.spark, path)


@query("k06_file_size", "SELECT count(*) AS row_count, true AS small_files FROM part")
def k06(t):
    path = sinks.write_table(t.part, scratch_path(t.spark, "small"), files=2, max_records=100)
    sizes = files.read_table(t.spark, path).groupBy(F.col("_metadata.file_path")).agg(F.count(F.lit(1)).alias("n"))
    return sizes.agg(F.sum("n").alias("row_count"), (F.max("n") <= 100).alias("small_files"))


@query("k07_bucketed_join", """
SELECT o_orderkey, o_totalprice, count(*) AS lines FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1, 2""")
def k07(t):
    a, b = table_name("orders"), table_name("lines")
    sinks.save_bucketed(t.orders.select("o_orderkey", "o_totalprice"), a, scratch_path(t.spark, "bucket-o"), 8, ["o_orderkey"])
    sinks.save_bucketed(
        t.lineitem.select(F.col("l_orderkey").alias("o_orderkey")), b, scratch_path(t.spark, "bucket-l"), 8, ["o_orderkey"]
    )
    return t.spark.table(a).join(t.spark.table(b), "o_orderkey").groupBy("o_orderkey", "o_totalprice").agg(F.count(F.lit(1)).alias("lines"))


@query("k08_create_table_as", "SELECT p_partkey, p_type FROM part")
def k08(t):
    name, path = table_name("ctas"), scratch_path(t.spark, "ctas")
    t.part.createOrReplaceTempView(f"{name}_src")
    t.spark.sql(f"CREATE TABLE {name} USING parquet LOCATION '{path}' AS SELECT p_partkey, p_type FROM {name}_src")
    return t.spark.table(name)


@query("k09_partitioned_ctas", "SELECT o_orderkey, c_mktsegment, o_totalprice FROM orders JOIN customer ON o_custkey = c_custkey")
def k09(t):
    joined = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "c_mktsegment", "o_totalprice")
    name = sinks.save_table(joined, table_name("segments"), scratch_path(t.spark, "segments"), partition_by=["c_mktsegment"])
    return t.spark.table(name)


@query("k10_table_formats", "SELECT 'csv' AS format, count(*) AS n FROM part UNION ALL SELECT 'orc', count(*) FROM part UNION ALL SELECT 'parquet', count(*) FROM part")
def k10(t):
    parts = []
    for kind in ("csv", "orc", "parquet"):
        name = sinks.save_table(t.part, table_name(kind), scratch_path(t.spark, kind), kind)
        parts.append(t.spark.table(name).agg(F.count(F.lit(1)).alias("n")).withColumn("format", F.lit(kind)))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("k11_statistics", """
SELECT 'min' AS info_name, min(o_totalprice) AS info_value FROM orders UNION ALL SELECT 'max', max(o_totalprice) FROM orders
UNION ALL SELECT 'num_nulls', CAST(count(*) - count(o_totalprice) AS DOUBLE) FROM orders UNION ALL SELECT 'rows', CAST(count(*) AS DOUBLE) FROM orders""")
def k11(t):
    name = sinks.save_table(t.orders, table_name("stats"), scratch_path(t.spark, "stats"))
    sinks.analyze(t.spark, name, ["o_orderpriority", "o_totalprice"])
    column = t.spark.sql(f"DESCRIBE EXTENDED {name} o_totalprice").filter(F.col("info_name").isin("min", "max", "num_nulls"))
    table = t.spark.sql(f"DESCRIBE EXTENDED {name}").filter("col_name = 'Statistics'")
    rows = table.select(F.lit("rows").alias("info_name"), F.regexp_extract("data_type", r"(\d+) rows", 1).alias("info_value"))
    return column.select("info_name", "info_value").unionByName(rows).withColumn("info_value", F.col("info_value").cast("double"))


@query("k12_bi_view", r.with_ctes(r.RESTAURANTS, r.TIMED_SALES) + f"""
SELECT r.cuisine, year(s.order_date) AS order_year, count(s.order_id) AS order_count, CAST(sum(s.amount_d) AS DOUBLE) AS revenue,
  CAST(sum(s.amount_d) AS DOUBLE) / nullif(count(s.order_id), 0) AS revenue_per_order
FROM restaurants r JOIN timed_sales s USING (restaurant_id) GROUP BY 1, 2""")
def k12(t):
    name = table_name("bi")
    r.timed_sales(t).join(r.restaurants(t), "restaurant_id").createOrReplaceTempView(f"{name}_src")
    t.spark.sql(f"""
        CREATE TEMPORARY VIEW {name} AS
        SELECT cuisine, CAST(year(order_date) AS BIGINT) AS order_year, count(order_id) AS order_count,
          CAST(sum(CAST(amount AS DECIMAL(18,2))) AS DOUBLE) AS revenue,
          CAST(sum(CAST(amount AS DECIMAL(18,2))) AS DOUBLE) / nullif(count(order_id), 0) AS revenue_per_order
        FROM {name}_src GROUP BY cuisine, year(order_date)""")
    path = sinks.write_table(t.spark.table(name), scratch_path(t.spark, "bi"), "csv")
    return files.read_table(t.spark, path, "csv", t.spark.table(name).schema, header="true")


@query("k18_messages", r.with_ctes(ENRICHED_SQL) + """
SELECT CAST(order_id AS VARCHAR) AS key, '{"order_id":' || order_id || ',"current_status":"' || current_status || '","status_id":' || status_id || '}' AS value
FROM deliveries WHERE delivery_time_minutes > 45 AND current_status = 'click' AND total_amount >= 20 AND delivery_time_minutes < 180""")
def k18(t):
    alerts = actionable_alerts(deliveries(t), 45, 20, 180, ["click"]).filter(F.col("current_status") != "purchase")
    return to_messages(alerts, "order_id", ["order_id", "current_status", "status_id"])


@query("k19_sized_write", """
SELECT l_orderkey, l_partkey, l_extendedprice, (SELECT count(*) FROM lineitem) AS row_count, true AS within_bounds, true AS few_files FROM lineitem""")
def k19(t):
    """Files of a wanted size without counting rows first: as many as the bytes written ask for, none much beyond the size. Every row is read back."""
    rows = t.lineitem.select("l_orderkey", "l_partkey", "l_extendedprice")
    path, size = scratch_path(t.spark, "sized"), 256 << 10
    sizes = sinks.write_sized(rows, path, size)
    few = len(sizes) <= 2 + 4 * sum(sizes) // size
    stored = files.read_table(t.spark, path, schema=rows.schema)
    counted = stored.agg(F.count(F.lit(1))).scalar()
    return stored.withColumns({"row_count": counted, "within_bounds": F.lit(max(sizes) <= 2 * size), "few_files": F.lit(few)})


@query("k20_overwrite_directory", "SELECT p_partkey, p_name FROM part")
def k20(t):
    view, path = table_name("dir"), scratch_path(t.spark, "dir")
    t.part.select("p_partkey", "p_name").createOrReplaceTempView(view)
    sinks.overwrite_directory(t.spark, view, path)
    return files.read_table(t.spark, sinks.overwrite_directory(t.spark, view, path))


