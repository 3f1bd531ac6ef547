"""Versioned-table and layout queries (V*)."""

from pyspark.sql import functions as F

from tiffin.catalog import roles as r
from tiffin.catalog.joining import SNAPSHOTS, snapshots
from tiffin.catalog.registry import query
from tiffin.functions import columns as c
from tiffin.operators import quality as q, versions as v
from tiffin.session import scratch_path
from tiffin.sources import sinks

STATES = r.with_ctes(SNAPSHOTS)


def orders_by_month(t):
    """Orders in one folder, appended as they come: first the older ones, then those from 1996 on."""
    base, late = scratch_path(t.spark, "orders"), F.col("o_orderdate") >= F.lit("1996-01-01").cast("timestamp")
    for part in (~late, late):
        v.append_by_month(t.orders.filter(part).select("o_orderkey", "o_orderpriority", "o_totalprice", "o_orderdate"), base, "o_orderdate")
    return base


def deliveries(t):
    return v.read_deliveries(t.spark, orders_by_month(t))


@query("v01_update_where", """
SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 'DEBT' ELSE c_mktsegment END AS c_mktsegment,
  CASE WHEN c_acctbal < 0 THEN c_acctbal * 2 ELSE c_acctbal END AS c_acctbal FROM customer""")
def v01(t):
    rows = t.customer.select("c_custkey", "c_mktsegment", "c_acctbal")
    return v.update_where(rows, F.col("c_acctbal") < 0, {"c_mktsegment": F.lit("DEBT"), "c_acctbal": F.col("c_acctbal") * 2})


@query("v02_delete_where", STATES + "SELECT * FROM new_s WHERE NOT coalesce(segment = 'MOVED', false)")
def v02(t):
    return v.delete_where(snapshots(t)[1], F.col("segment") == "MOVED")


@query("v03_upsert_all", STATES + """
SELECT coalesce(n.id, o.id) AS id, CASE WHEN n.id IS NOT NULL THEN n.segment ELSE o.segment END AS segment,
  CASE WHEN n.id IS NOT NULL THEN n.balance ELSE o.balance END AS balance, coalesce(n.nation, o.nation) AS nation
FROM old_s o FULL JOIN new_s n ON o.id = n.id""")
def v03(t):
    old, new = snapshots(t)
    return v.upsert(old, new, ["id"])


@query("v03_upsert_conditional", STATES + """
SELECT coalesce(o.id, n.id) AS id, CASE WHEN o.id IS NULL THEN n.segment ELSE o.segment END AS segment,
  CASE WHEN o.id IS NULL THEN n.balance WHEN n.balance > o.balance THEN n.balance + 1 ELSE o.balance END AS balance,
  coalesce(o.nation, n.nation) AS nation FROM old_s o FULL JOIN new_s n ON o.id = n.id""")
def v03_conditional(t):
    old, new = snapshots(t)
    return v.upsert(
        old, new, ["id"], when_matched=F.col("s.balance") > F.col("t.balance"), update={"balance": F.col("s.balance") + 1}
    )


@query("v04_insert", STATES + "SELECT * FROM old_s UNION ALL SELECT s_suppkey + 1000000, 'SUPPLIER', s_acctbal, NULL FROM supplier")
def v04(t):
    rows = t.supplier.select((F.col("s_suppkey") + 1000000).alias("id"), F.lit("SUPPLIER").alias("segment"), F.col("s_acctbal").alias("balance"))
    return v.insert_rows(snapshots(t)[0], rows)


MONTHS = r.with_ctes("""d AS (SELECT o_orderkey, o_orderpriority, o_totalprice, o_orderdate, strftime(o_orderdate, '%Y-%m') AS delivery FROM orders)""",
    "log AS (SELECT delivery, count(*) AS rows, min(o_orderdate) AS first_ts, max(o_orderdate) AS last_ts FROM d GROUP BY 1)")


@query("v05_read_version", MONTHS + "SELECT * FROM d WHERE delivery = '1995-03'")
def v05(t):
    return v.delivered(deliveries(t), only="1995-03")


@query("v05_read_timestamp", MONTHS + "SELECT * FROM d WHERE delivery <= '1996-06'")
def v05_ts(t):
    return v.delivered(deliveries(t), until="1996-06")


@query("v06_history", MONTHS + "SELECT *, CAST(rows - lag(rows, 1, 0) OVER (ORDER BY delivery) AS BIGINT) AS row_change FROM log")
def v06(t):
    return v.delivery_evolution(v.delivery_counts(deliveries(t), "o_orderdate"))


@query("v06_operations", MONTHS + """
SELECT delivery[:4] AS year, count(*) AS deliveries, min(first_ts) AS first_ts, max(last_ts) AS last_ts, max(rows) AS most_rows FROM log GROUP BY 1""")
def v06_operations(t):
    return v.delivery_counts(deliveries(t), "o_orderdate").groupBy(F.substring("delivery", 1, 4).alias("year")).agg(
        F.count(F.lit(1)).alias("deliveries"), F.min("first_ts").alias("first_ts"), F.max("last_ts").alias("last_ts"), F.max("rows").alias("most_rows")
    )


@query("j28_log_join", MONTHS + "SELECT o_orderkey, delivery, rows, last_ts FROM d JOIN log USING (delivery) WHERE o_totalprice > 100000")
def j28(t):
    rows = deliveries(t)
    log = v.delivery_counts(rows, "o_orderdate").select("delivery", "rows", "last_ts")
    return rows.filter(F.col("o_totalprice") > 100000).join(log, "delivery").select("o_orderkey", "delivery", "rows", "last_ts")


@query("v07_restore", MONTHS + "SELECT * FROM d")
def v07(t):
    """One delivery came with doubled prices; it is put right from the orders, and nothing else is written again."""
    base = orders_by_month(t)
    rows = v.read_deliveries(t.spark, base)
    wrong = v.delivered(rows, only="1995-03").withColumn("o_totalprice", F.col("o_totalprice") * 2)
    sinks.overwrite_partitions(wrong, base, ["delivery"])
    right = t.orders.withColumn("delivery", F.date_format("o_orderdate", "yyyy-MM")).filter(F.col("delivery") == "1995-03")
    sinks.overwrite_partitions(right.select(*rows.columns), base, ["delivery"])
    return v.read_deliveries(t.spark, base)


@query("v08_compare", STATES + """
SELECT 'old' AS measure, count(*) AS row_count FROM old_s UNION ALL SELECT 'new', count(*) FROM new_s
UNION ALL SELECT 'only in new', count(*) FROM (SELECT * FROM new_s EXCEPT ALL SELECT * FROM old_s)
UNION ALL SELECT 'only in old', count(*) FROM (SELECT * FROM old_s EXCEPT ALL SELECT * FROM new_s)""")
def v08(t):
    return v.compare_versions(*snapshots(t))


FEED_SQL = STATES + """, j AS (SELECT o.id AS oid, n.id AS nid, (o.segment IS DISTINCT FROM n.segment OR o.balance IS DISTINCT FROM n.balance) AS diff
  FROM old_s o FULL JOIN new_s n ON o.id = n.id)
SELECT n.*, 'insert' AS change_type FROM new_s n JOIN j ON n.id = nid WHERE oid IS NULL
UNION ALL SELECT o.*, 'delete' FROM old_s o JOIN j ON o.id = oid WHERE nid IS NULL
UNION ALL SELECT o.*, 'update_preimage' FROM old_s o JOIN j ON o.id = oid WHERE nid IS NOT NULL AND diff
UNION ALL SELECT n.*, 'update_postimage' FROM new_s n JOIN j ON n.id = nid WHERE oid IS NOT NULL AND diff"""


@query("v09_change_feed", FEED_SQL)
def v09(t):
    old, new = snapshots(t)
    return v.change_feed(old, new, ["id"])


@query("v10_merge_on_read", STATES + """
SELECT * FROM old_s WHERE segment IN ('AUTOMOBILE', 'FURNITURE')
UNION ALL SELECT id, segment, balance + 5, nation FROM old_s WHERE segment = 'BUILDING'""")
def v10(t):
    old = snapshots(t)[0]
    gone = old.filter(~F.col("segment").isin("AUTOMOBILE", "FURNITURE")).select("id")
    changed = old.filter(F.col("segment") == "BUILDING").withColumn("balance", F.col("balance") + 5)
    return v.read_merged(old, gone, changed, ["id"])


@query("v11_write_audit_publish", STATES + "SELECT * FROM old_s UNION ALL SELECT id + 1000000, segment, balance, nation FROM new_s WHERE balance >= 0")
def v11(t):
    base = scratch_path(t.spark, "published")
    old, new = snapshots(t)
    v.write_audit_publish(old, [], base, 1)
    rules = [q.Rule("has_id", "id IS NOT NULL", q.FAIL), q.Rule("no_debt", "balance >= 0")]
    v.write_audit_publish(new.withColumn("id", F.col("id") + 1000000), rules, base, 2)
    return t.spark.read.parquet(base).drop("snapshot_id")


@query("v12_evolve", """
SELECT c_custkey, c_name AS full_name, c_nationkey, c_mktsegment, 'BR' AS country, CAST(NULL AS DOUBLE) AS tip FROM customer""")
def v12(t):
    return v.evolve(
        t.customer, add={"country": F.lit("BR"), "tip": F.lit(None).cast("double")}, rename={"c_name": "full_name"}, drop=["c_acctbal"]
    )


@query("v13_change_type", "SELECT p_partkey, CAST(p_size AS BIGINT) AS p_size, TRY_CAST(substr(p_brand, 7) AS INT) AS brand_no FROM part")
def v13(t):
    rows = t.part.select("p_partkey", "p_size", F.expr("substring(p_brand, 7)").alias("brand_no"))
    return v.change_type(v.change_type(rows, "p_size", "bigint"), "brand_no", "int")


@query("v14_merge_schema", """
SELECT s_suppkey AS id, s_name AS name, s_acctbal AS earnings, CAST(NULL AS VARCHAR) AS segment FROM supplier
UNION ALL SELECT c_custkey, c_name, NULL, c_mktsegment FROM customer""")
def v14(t):
    path = scratch_path(t.spark, "merged")
    drivers = t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("earnings"))
    drivers.write.parquet(path)
    t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment")).write.mode(
        "append").parquet(path)
    return t.spark.read.option("mergeSchema", "true").parquet(path).select("id", "name", "earnings", "segment")


@query("v15_enforce_schema", """
SELECT c_custkey AS id, CASE WHEN c_nationkey < 20 THEN c_nationkey END AS nation, c_nationkey < 20 AS accepted FROM customer""")
def v15(t):
    shown = F.when(F.col("c_nationkey") < 20, F.col("c_nationkey").cast("string")).otherwise(F.lit("unknown"))
    rows = t.customer.select(F.col("c_custkey").alias("id"), shown.alias("nation"))
    schema = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("nation")).schema
    good, bad = v.fit_schema(rows, schema)
    rejected = bad.select("id", F.lit(None).cast("int").alias("nation"), F.lit(False).alias("accepted"))
    return good.withColumn("accepted", F.lit(True)).unionByName(rejected)


@query("v16_generated_columns", """
SELECT c_custkey, c_name || ' ' || c_mktsegment AS full_name, lower(c_mktsegment) || '.com' AS email_domain FROM customer""")
def v16(t):
    email = F.concat("c_name", F.lit("@"), "c_mktsegment", F.lit(".COM"))
    return t.customer.select(
        "c_custkey", c.full_name("c_name", "c_mktsegment").alias("full_name"), c.email_domain(email).alias("email_domain")
    )


@query("v17_business_view", "SELECT s_suppkey AS driver_id, s_name AS driver_name FROM supplier")
def v17(t):
    return v.business_view(t.supplier, {"s_suppkey": "driver_id", "s_name": "driver_name"})



ORDERS_SQL = "SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate FROM orders"


def short_orders(t):
    return t.orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")


@query("v18_compact", ORDERS_SQL)
def v18(t):
    many, few = scratch_path(t.spark, "many"), scratch_path(t.spark, "few")
    short_orders(t).repartition(32).write.parquet(many)
    return t.spark.read.parquet(v.compact(t.spark, many, few, 4))


@query("v19_zorder", "SELECT count(*) AS row_count, true AS narrower_o_custkey, true AS narrower_o_totalprice FROM orders")
def v19(t):
    """Rows after clustering, and whether the files' ranges got narrower in both columns than without it."""
    columns = ["o_custkey", "o_totalprice"]
    plain, clustered = scratch_path(t.spark, "plain"), scratch_path(t.spark, "zorder")
    short_orders(t).repartition(8).write.parquet(plain)
    v.zorder(short_orders(t), columns, 8).write.parquet(clustered)

    def width(path, column):
        return v.file_ranges(t.spark.read.parquet(path), [column]).agg(F.avg(F.col(f"max_{column}") - F.col(f"min_{column}"))).scalar()

    total = t.spark.read.parquet(clustered).agg(F.count(F.lit(1)).alias("row_count"))
    return total.select("row_count", *[(width(clustered, c) < width(plain, c)).alias(f"narrower_{c}") for c in columns])


@query("v20_partition_transforms", """
SELECT year(ts) AS ts_year, strftime(ts, '%Y-%m') AS ts_month, CAST(ts AS DATE) AS ts_day, date_trunc('hour', ts) AS ts_hour,
  substr(event_type, 1, 2) AS event_type_trunc, count(*) AS n FROM events GROUP BY ALL""")
def v20(t):
    rows = t.events.withColumns(v.partition_transforms("ts", ("user_id", 16), ("event_type", 2)))
    return rows.groupBy("ts_year", "ts_month", "ts_day", "ts_hour", "event_type_trunc").agg(F.count(F.lit(1)).alias("n")).withColumn(
        "ts_year", F.col("ts_year").cast("bigint")
    )


@query("v20_pruned_read", """
SELECT event_id, user_id, event_type FROM events WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-09'""")
def v20_read(t):
    path = scratch_path(t.spark, "by-day")
    days = t.events.withColumn("ts_day", F.to_date("ts"))
    sinks.write_table(days, path, partition_by=["ts_day"])
    return v.between_days(t.spark.read.parquet(path), "ts", "2024-01-05", "2024-01-09").select("event_id", "user_id", "event_type")


@query("v21_two_layouts", "SELECT event_id, user_id, event_type FROM events")
def v21(t):
    old, new = scratch_path(t.spark, "layout-old"), scratch_path(t.spark, "layout-new")
    turn = F.lit("2024-01-16").cast("timestamp")
    earlier = t.events.filter(F.col("ts") < turn).withColumn("month", F.date_format("ts", "yyyy-MM"))
    sinks.write_table(earlier, old, partition_by=["month"])
    sinks.write_table(t.events.filter(F.col("ts") >= turn).withColumn("day", F.to_date("ts")), new, partition_by=["day"])
    columns = ["event_id", "user_id", "event_type"]
    return t.spark.read.parquet(old).select(*columns).unionByName(t.spark.read.parquet(new).select(*columns))


@query("v22_write_distribution", """
SELECT 'none' AS mode, count(*) AS row_count, true AS spread FROM orders UNION ALL SELECT 'hash', count(*), true FROM orders UNION ALL SELECT 'range', count(*), true FROM orders""")
def v22(t):
    parts = []
    for mode in ("none", "hash", "range"):
        path = scratch_path(t.spark, f"dist-{mode}")
        v.distribute(short_orders(t), mode, ["o_custkey"], 8).write.parquet(path)
        written = t.spark.read.parquet(path)
        if mode == "hash":  # the rows of a key lie together; only a key too large for a file would be in several
            files_of = written.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"), F.countDistinct(F.col("_metadata.file_name")).alias("files"))
            parts.append(files_of.agg(F.lit(mode).alias("mode"), F.sum("n").alias("row_count"), (F.max("files") == 1).alias("spread")))
        else:
            metrics = v.table_metrics(written)
            parts.append(metrics.select(F.lit(mode).alias("mode"), "row_count", (F.col("files") >= (1 if mode == "none" else 4)).alias("spread")))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("v23_sorted_write", ORDERS_SQL)
def v23(t):
    path = scratch_path(t.spark, "sorted")
    return t.spark.read.parquet(v.sorted_write(short_orders(t), path, ["o_orderdate", "o_orderkey"], 4))


@query("v24_file_metrics", "SELECT count(*) AS row_count, CAST(4 AS BIGINT) AS files, true AS has_bytes FROM orders")
def v24(t):
    path = scratch_path(t.spark, "metrics")
    short_orders(t).repartition(4).write.parquet(path)
    return v.table_metrics(t.spark.read.parquet(path)).select("row_count", "files", (F.col("bytes") > 0).alias("has_bytes"))


@query("v25_file_ranges", "SELECT min(o_orderkey) AS least, max(o_orderkey) AS most, CAST(4 AS BIGINT) AS files FROM orders")
def v25(t):
    path = scratch_path(t.spark, "ranges")
    v.sorted_write(short_orders(t), path, ["o_orderkey"], 4)
    ranges = v.file_ranges(t.spark.read.parquet(path), ["o_orderkey", "o_totalprice"])
    return ranges.agg(
        F.min("min_o_orderkey").alias("least"), F.max("max_o_orderkey").alias("most"), F.count(F.lit(1)).alias("files")
    )


@query("v26_bloom_write", """
SELECT o_custkey, count(*) AS orders, true AS fewer_rows_read FROM orders
WHERE o_custkey = (SELECT max(o_custkey) FROM orders WHERE o_custkey <= (SELECT max(o_custkey) / 2 FROM orders)) GROUP BY 1""")
def v26(t):
    """Orders of one customer, and whether the filter on the customer spared rows of other files: customers lie all over, so ranges skip nothing."""
    half = t.orders.agg(F.max("o_custkey") / 2).scalar()
    wanted = t.orders.filter(F.col("o_custkey") <= half).agg(F.max("o_custkey")).first()[0]  # in the middle of every file's range
    scanned = []
    for bloom in (False, True):
        path = scratch_path(t.spark, "bloom" if bloom else "plain")
        rows = short_orders(t).repartition(32, "o_orderkey")
        v.write_with_bloom(rows, path, "o_custkey") if bloom else rows.write.option("parquet.enable.dictionary", "false").parquet(path)
        found = t.spark.read.parquet(path).filter(F.col("o_custkey") == wanted)
        scanned.append(v.rows_and_scanned(found)[1])
    return found.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("orders")).withColumn("fewer_rows_read", F.lit(scanned[1] < scanned[0]))


@query("v27_expired", MONTHS + """
SELECT * FROM log WHERE delivery < '1997-01' AND delivery NOT IN (SELECT delivery FROM log ORDER BY delivery DESC LIMIT 12)""")
def v27(t):
    return v.beyond_retention(v.delivery_counts(deliveries(t), "o_orderdate"), keep=12, before="1997-01")


@query("v28_convert", ORDERS_SQL)
def v28(t):
    source, target = scratch_path(t.spark, "parquet"), scratch_path(t.spark, "orc")
    short_orders(t).write.parquet(source)
    v.convert(t.spark, source, "parquet", target, "orc")
    return t.spark.read.orc(target)
