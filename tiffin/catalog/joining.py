"""Join queries (J*) and unions (T*)."""

from pyspark.sql import functions as F

from tiffin.catalog import roles as r
from tiffin.catalog.registry import query
from tiffin.functions import columns as c
from tiffin.operators import aggs, joins, windows as win

BASE = r.with_ctes(r.RESTAURANTS, r.SALES, r.DRIVERS)


@query("flagship_top_brands", r.with_ctes(r.RESTAURANTS, r.TIMED_SALES, """b AS (SELECT cuisine, city, count(*) AS order_count, count(DISTINCT user_id) AS customers, sum(amount_d) AS revenue_d
  FROM timed_sales JOIN restaurants USING (restaurant_id) GROUP BY cuisine, city)""",
    "k AS (SELECT *, dense_rank() OVER (PARTITION BY cuisine ORDER BY revenue_d DESC) AS sales_rank FROM b)") + """
SELECT cuisine, city, order_count, customers, CAST(revenue_d AS DOUBLE) AS revenue, sales_rank FROM k WHERE sales_rank <= 3""")
def flagship(t):
    joined = r.timed_sales(t).join(r.restaurants(t).select("restaurant_id", "cuisine", "city"), "restaurant_id")
    brands = joined.groupBy("cuisine", "city").agg(
        F.count(F.lit(1)).alias("order_count"), F.countDistinct("user_id").alias("customers"),
        F.sum(c.money("amount")).alias("revenue_d"),
    )
    # One row per cuisine and city is left here, whatever the number of sales.
    top = win.top_ranked(brands, ["cuisine"], "revenue_d", 3, "dense_rank", out="sales_rank", bounded=True)
    return top.select("cuisine", "city", "order_count", "customers", F.col("revenue_d").cast("double").alias("revenue"), "sales_rank")


@query("j01_inner", BASE + """
SELECT order_id, restaurant_id, name, cuisine, amount FROM sales JOIN restaurants USING (restaurant_id)""")
def j01(t):
    return r.sales(t).join(r.restaurants(t), "restaurant_id").select("order_id", "restaurant_id", "name", "cuisine", "amount")


@query("j02_left_coalesce", """
SELECT c_custkey, c_mktsegment, count(event_id) AS order_count, coalesce(CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE), 0) AS revenue
FROM customer LEFT JOIN events ON c_custkey = user_id GROUP BY 1, 2""")
def j02(t):
    # Grouping the fact side by its foreign key first keeps one row per customer in the join. Most customers have no event.
    facts = t.events.select(F.col("user_id").alias("c_custkey"), F.col("value").alias("amount"))
    return t.customer.join(r.revenue_by(facts, "c_custkey"), "c_custkey", "left").select(
        "c_custkey", "c_mktsegment", F.coalesce("order_count", F.lit(0)).alias("order_count"),
        F.coalesce(F.col("revenue_d").cast("double"), F.lit(0.0)).alias("revenue"),
    )


@query("j03_right", """
SELECT event_id, event_type, c_custkey, c_name AS name FROM events RIGHT JOIN customer ON user_id = c_custkey""")
def j03(t):
    people = t.customer.select("c_custkey", F.col("c_name").alias("name"))
    return t.events.select("event_id", "event_type", "user_id").join(people, F.col("user_id") == F.col("c_custkey"), "right").drop("user_id")


@query("j04_full", """
SELECT s_suppkey, event_id, value FROM supplier FULL JOIN events ON s_suppkey * 2 = user_id""")
def j04(t):
    # Every other user is a supplier and some suppliers have no user, so both sides have rows without a partner.
    return t.supplier.select("s_suppkey").join(
        t.events.select("event_id", "user_id", "value"), F.col("s_suppkey") * 2 == F.col("user_id"), "full"
    ).drop("user_id")


@query("j05_star", BASE + """
SELECT order_id, name, cuisine, driver_name, vehicle, amount
FROM sales JOIN restaurants USING (restaurant_id) JOIN drivers USING (driver_id)""")
def j05(t):
    return (
        r.sales(t).join(r.restaurants(t), "restaurant_id").join(r.drivers(t).drop("city"), "driver_id")
        .select("order_id", "name", "cuisine", "driver_name", "vehicle", "amount")
    )


@query("j06_anti", """
SELECT c_custkey, c_name FROM customer c WHERE NOT EXISTS (SELECT 1 FROM events e WHERE e.user_id = c.c_custkey)""")
def j06(t):
    return t.customer.join(t.events, F.col("c_custkey") == F.col("user_id"), "left_anti").select("c_custkey", "c_name")


@query("j07_semi", """
SELECT c_custkey, c_name FROM customer c WHERE EXISTS (SELECT 1 FROM events e WHERE e.user_id = c.c_custkey)""")
def j07(t):
    return t.customer.join(t.events, F.col("c_custkey") == F.col("user_id"), "left_semi").select("c_custkey", "c_name")


# Delivery points of the distance report.
POINTS = [
    {"city": "Palmas", "lat": -10.1686, "lon": -48.3305},
    {"city": "São Paulo", "lat": -23.5505, "lon": -46.6333},
    {"city": "Rio de Janeiro", "lat": -22.9068, "lon": -43.1729},
]


@query("j08_fixed_points", """
WITH d(city, lat, lon) AS (VALUES ('Palmas', -10.1686, -48.3305), ('São Paulo', -23.5505, -46.6333), ('Rio de Janeiro', -22.9068, -43.1729))
SELECT s_suppkey, d.city, round(2 * 6371 * asin(sqrt(pow(sin((radians(lat) - radians(s_nationkey - 20.0)) / 2), 2)
  + cos(radians(s_nationkey - 20.0)) * cos(radians(lat)) * pow(sin((radians(lon) - radians(-50.0)) / 2), 2))), 3) AS km
FROM supplier CROSS JOIN d""")
def j08(t):
    beside = joins.with_points(t.supplier.select("s_suppkey", "s_nationkey"), POINTS, "city string, lat double, lon double")
    km = c.haversine_km(F.col("s_nationkey") - F.lit(20.0), F.lit(-50.0), F.col("lat"), F.col("lon"))
    return beside.select("s_suppkey", "city", F.round(km, 3).alias("km"))


@query("j09_partners_beyond", """
WITH v AS (SELECT p_type, p_brand, p_size, count(*) AS n FROM part GROUP BY ALL),
k AS (SELECT a.p_type, a.p_brand, a.p_size,
    CAST(coalesce(sum(CASE WHEN b.p_size < a.p_size - 10 THEN b.n END), 0) AS BIGINT) AS partners_below,
    CAST(coalesce(sum(CASE WHEN b.p_size > a.p_size + 10 THEN b.n END), 0) AS BIGINT) AS partners_above
  FROM v a JOIN v b ON a.p_type = b.p_type AND a.p_brand = b.p_brand GROUP BY 1, 2, 3)
SELECT p_partkey, p_type, p_brand, p_size, partners_below, partners_above FROM part JOIN k USING (p_type, p_brand, p_size)""")
def j09(t):
    rows = t.part.select("p_partkey", "p_type", "p_brand", "p_size")
    return joins.partners_beyond(rows, ["p_type", "p_brand"], "p_size", 10)


@query("j10_derived_table", BASE + f"""
SELECT cs.cuisine, cs.restaurant_count, cs.avg_rating, count(s.order_id) AS order_count, CAST(sum(s.amount_d) AS DOUBLE) AS revenue
FROM (SELECT cuisine, count(*) AS restaurant_count, {r.mean_sql('rating_d')} AS avg_rating FROM restaurants GROUP BY cuisine) cs
LEFT JOIN restaurants r ON r.cuisine = cs.cuisine LEFT JOIN sales s ON s.restaurant_id = r.restaurant_id GROUP BY 1, 2, 3""")
def j10(t):
    rest = r.restaurants(t)
    stats = rest.groupBy("cuisine").agg(F.count(F.lit(1)).alias("restaurant_count"), c.mean("rating").alias("avg_rating"))
    facts = (
        rest.select("restaurant_id", "cuisine")
        .join(r.revenue_by(r.sales(t), "restaurant_id"), "restaurant_id", "left")
        .groupBy("cuisine").agg(
            F.coalesce(F.sum("order_count"), F.lit(0)).alias("order_count"), F.sum("revenue_d").cast("double").alias("revenue")
        )
    )
    return stats.join(facts, "cuisine")


@query("j11_argmax_in", """
SELECT p_partkey, p_name, p_type, p_retailprice FROM part
WHERE (p_type, p_retailprice) IN (SELECT p_type, max(p_retailprice) FROM part GROUP BY p_type)""")
def j11(t):
    return joins.best_rows(t.part, ["p_type"], "p_retailprice").select("p_partkey", "p_name", "p_type", "p_retailprice")


@query("j12_scalar_subquery", """
SELECT o_orderkey, o_totalprice FROM orders
WHERE CAST(o_totalprice AS DECIMAL(18,2)) > (SELECT CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / count(*) FROM orders)""")
def j12(t):
    overall = t.orders.agg(F.sum(c.money("o_totalprice")).cast("double") / F.count(F.lit(1))).scalar()
    return t.orders.filter(F.col("o_totalprice") > overall).select("o_orderkey", "o_totalprice")


@query("j13_percent_of_total", f"""
SELECT o_orderpriority, count(*) AS orders, {r.pct_sql('count(*)', '(SELECT count(*) FROM orders)')} AS percentage
FROM orders GROUP BY o_orderpriority""")
def j13(t):
    counts = t.orders.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("orders"))
    return aggs.share_of_total(counts, "orders")


@query("j14_correlated_count", """
SELECT p.p_partkey, p.p_type, (SELECT count(*) FROM part q WHERE q.p_type = p.p_type) AS type_count
FROM part p""")
def j14(t):
    counts = t.part.groupBy("p_type").agg(F.count(F.lit(1)).alias("type_count"))
    return t.part.join(counts, "p_type").select("p_partkey", "p_type", "type_count")


@query("j14_window_count", """
SELECT p_partkey, p_type, count(*) OVER (PARTITION BY p_type) AS type_count FROM part""")
def j14_window(t):
    rows = t.part.select("p_partkey", "p_type")
    return win.beside(rows, ["p_type"], type_count=F.count(F.lit(1)))


@query("j15_correlated_rank", """
WITH x AS (SELECT c_custkey, CASE WHEN c_acctbal > 0 THEN c_acctbal END AS balance FROM customer)
SELECT c_custkey, balance, CASE WHEN balance IS NULL THEN 1 ELSE rank() OVER (ORDER BY balance DESC NULLS LAST) END AS balance_rank FROM x""")
def j15(t):
    rows = t.customer.select("c_custkey", F.when(F.col("c_acctbal") > 0, F.col("c_acctbal")).alias("balance"))
    ranked = win.ranks(rows, [], "balance", {"_rank": "rank"}, descending=True)
    # The count of greater rows is 0 for a NULL, so the correlated form ranks it first.
    return ranked.withColumn("balance_rank", F.when(F.col("balance").isNull(), 1).otherwise(F.col("_rank"))).drop("_rank")


FACT_SQL = BASE + """
SELECT cuisine, count(*) AS order_count, CAST(sum(amount_d) AS DOUBLE) AS revenue FROM sales JOIN restaurants USING (restaurant_id) GROUP BY cuisine"""


def by_cuisine(joined):
    return joined.groupBy("cuisine").agg(F.count(F.lit(1)).alias("order_count"), c.total("amount").alias("revenue"))


@query("j16_broadcast", """
SELECT s_suppkey, n_name, r_name FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")
def j16(t):
    # Nations and regions are fixed lists (25 and 5 rows); the order tables never get this hint.
    return (
        t.supplier.join(F.broadcast(t.nation), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(F.broadcast(t.region), F.col("n_regionkey") == F.col("r_regionkey"))
        .select("s_suppkey", "n_name", "r_name")
    )


@query("j17_shuffle_hash", FACT_SQL)
def j17(t):
    return by_cuisine(r.sales(t).join(r.restaurants(t).hint("shuffle_hash"), "restaurant_id"))


@query("j18_sort_merge", FACT_SQL)
def j18(t):
    return by_cuisine(r.sales(t).join(r.restaurants(t).hint("merge"), "restaurant_id"))


@query("j19_pre_partitioned", FACT_SQL)
def j19(t):
    # Grouping leaves the facts hash-partitioned by the key; the other side is brought to the same partitioning, and
    # the join needs no exchange of its own. Grouped first, a hot restaurant is one row here.
    n = int(t.spark.conf.get("spark.sql.shuffle.partitions"))
    facts = r.revenue_by(r.sales(t), "restaurant_id")
    names = r.restaurants(t).select("restaurant_id", "cuisine").repartition(n, "restaurant_id")
    joined = facts.join(names.hint("merge"), "restaurant_id").groupBy("cuisine")
    return joined.agg(F.sum("order_count").alias("order_count"), F.sum("revenue_d").cast("double").alias("revenue"))


@query("j20_salted", """
SELECT o_orderstatus, r.status_name, count(*) AS orders, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue
FROM orders JOIN (SELECT DISTINCT o_orderstatus, 'status ' || o_orderstatus AS status_name FROM orders) r USING (o_orderstatus) GROUP BY 1, 2""")
def j20(t):
    # Every status holds about a third of the orders, so all keys are hot.
    names = t.orders.select("o_orderstatus").distinct().withColumn("status_name", F.concat(F.lit("status "), "o_orderstatus"))
    facts = t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice")
    joined = joins.salted_join(facts, names, "o_orderstatus", salts=16, salt_by=["o_orderkey"])
    return joined.groupBy("o_orderstatus", "status_name").agg(
        F.count(F.lit(1)).alias("orders"), c.total("o_totalprice").alias("revenue")
    )


VIEWS = "SELECT event_id AS order_id, user_id, value AS amount, ts AS order_time FROM events WHERE event_type = 'view'"
BUYS = "SELECT event_id AS status_id, user_id AS status_user, ts AS status_time FROM events WHERE event_type = 'purchase'"


def views_and_buys(t):
    views = t.events.filter(F.col("event_type") == "view").select(
        F.col("event_id").alias("order_id"), "user_id", F.col("value").alias("amount"), F.col("ts").alias("order_time")
    )
    buys = t.events.filter(F.col("event_type") == "purchase").select(
        F.col("event_id").alias("status_id"), F.col("user_id").alias("status_user"), F.col("ts").alias("status_time")
    )
    return views, buys


@query("j22_interval_inner", f"""
SELECT order_id, user_id, status_id, order_time, status_time FROM ({VIEWS}) v JOIN ({BUYS}) b
ON user_id = status_user AND status_time >= order_time AND status_time <= order_time + INTERVAL 2 HOURS""")
def j22(t):
    views, buys = views_and_buys(t)
    return joins.interval_join(
        views, buys, ("user_id", "status_user"), ("order_time", "status_time"), 7200
    ).drop("status_user", "amount")


@query("j22_interval_left", f"""
SELECT order_id, user_id, status_id, order_time, status_time FROM ({VIEWS}) v LEFT JOIN ({BUYS}) b
ON user_id = status_user AND status_time >= order_time AND status_time <= order_time + INTERVAL 2 HOURS""")
def j22_left(t):
    views, buys = views_and_buys(t)
    return joins.interval_join(
        views, buys, ("user_id", "status_user"), ("order_time", "status_time"), 7200, "left"
    ).drop("status_user", "amount")


@query("j24_unify_sources", """
WITH a AS (SELECT c_custkey AS user_id, c_name AS name, c_mktsegment AS segment, CAST(c_nationkey AS VARCHAR) AS country,
    TIMESTAMP '1996-06-01' AS seen_at FROM customer),
b AS (SELECT * EXCLUDE rn FROM (SELECT o_custkey AS user_id, o_orderkey AS last_order, o_orderstatus AS status, o_orderpriority AS country,
    o_orderdate AS seen_at, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
    FROM orders) WHERE rn = 1)
SELECT coalesce(a.user_id, b.user_id) AS user_id, a.name, a.segment, coalesce(a.country, b.country) AS country,
  greatest(coalesce(a.seen_at, TIMESTAMP '1900-01-01'), coalesce(b.seen_at, TIMESTAMP '1900-01-01')) AS seen_at, b.last_order, b.status
FROM a FULL JOIN b ON a.user_id = b.user_id""")
def j24(t):
    profile = t.customer.select(
        F.col("c_custkey").alias("user_id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"),
        F.col("c_nationkey").cast("string").alias("country"), F.lit("1996-06-01").cast("timestamp").alias("seen_at"),
    )
    activity = t.orders.select(
        F.col("o_custkey").alias("user_id"), F.col("o_orderkey").alias("last_order"), F.col("o_orderstatus").alias("status"),
        F.col("o_orderpriority").alias("country"), F.col("o_orderdate").alias("seen_at"),
    )
    return joins.unify_sources(
        profile, activity, "user_id", ([F.col("seen_at")], [F.col("seen_at"), F.col("last_order")]),
        prefer_first=["country"], newest="seen_at",
    )


@query("j25_city_match", f"""
SELECT c_nationkey AS nation, count(DISTINCT c_custkey) AS users, count(DISTINCT s_suppkey) AS drivers,
  {r.rounded('count(DISTINCT s_suppkey)', 'count(DISTINCT c_custkey)')} AS drivers_per_user, avg_balance
FROM customer JOIN supplier ON c_nationkey = s_nationkey
JOIN (SELECT s_nationkey AS k, {r.mean_sql(r.cash('s_acctbal'))} AS avg_balance FROM supplier GROUP BY 1) ON k = c_nationkey
GROUP BY c_nationkey, avg_balance""")
def j25(t):
    matched = joins.city_match(
        t.customer.withColumnRenamed("c_nationkey", "nation"), t.supplier.withColumnRenamed("s_nationkey", "nation").withColumn("s_acctbal", c.money("s_acctbal")),
        "nation", "c_custkey", "s_suppkey", "s_acctbal",
    )
    return matched.withColumnsRenamed({
        "left_count": "users", "right_count": "drivers", "right_per_left": "drivers_per_user", "mean_value": "avg_balance"
    })


SNAPSHOTS = """old_s AS (SELECT c_custkey AS id, c_mktsegment AS segment, c_acctbal AS balance, c_nationkey AS nation FROM customer
  WHERE c_acctbal < 9000),
new_s AS (SELECT c_custkey AS id, CASE WHEN c_nationkey = 3 THEN 'MOVED' WHEN c_nationkey = 4 THEN NULL ELSE c_mktsegment END AS segment,
  CASE WHEN c_mktsegment = 'BUILDING' THEN c_acctbal + 10 ELSE c_acctbal END AS balance, c_nationkey AS nation FROM customer
  WHERE c_acctbal > -500)"""


def snapshots(t):
    """Two states of the customers: some left, some joined, some moved segment or balance."""
    base = t.customer.select(
        F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("segment"), F.col("c_acctbal").alias("balance"),
        F.col("c_nationkey").alias("nation"),
    )
    nation = F.col("nation")
    new = base.filter(F.col("balance") > -500).select(
        "id",
        F.when(nation == 3, "MOVED").when(nation == 4, F.lit(None)).otherwise(F.col("segment")).alias("segment"),
        F.when(F.col("segment") == "BUILDING", F.col("balance") + 10).otherwise(F.col("balance")).alias("balance"),
        "nation",
    )
    return base.filter(F.col("balance") < 9000), new


@query("j26_snapshot_compare", r.with_ctes(SNAPSHOTS) + """
SELECT n.id, CASE WHEN o.id IS NULL THEN 'NEW USER' WHEN n.segment IS DISTINCT FROM o.segment THEN 'SEGMENT CHANGED'
    ELSE 'BALANCE CHANGED' END AS change_type,
  o.segment AS old_segment, o.balance AS old_balance, n.segment AS new_segment, n.balance AS new_balance
FROM new_s n LEFT JOIN old_s o ON n.id = o.id
WHERE o.id IS NULL OR n.segment IS DISTINCT FROM o.segment OR n.balance IS DISTINCT FROM o.balance""")
def j26(t):
    old, new = snapshots(t)
    return joins.snapshot_changes(
        new, old, "id", {"segment": "SEGMENT CHANGED", "balance": "BALANCE CHANGED"}, "NEW USER", null_safe=True
    )


@query("j27_pandas_merge", """
SELECT coalesce(a.k, b.k) AS k, a.n AS n_x, b.n AS n_y FROM (SELECT user_id AS k, count(*) AS n FROM events GROUP BY 1) a
FULL JOIN (SELECT s_suppkey * 2 AS k, count(*) AS n FROM supplier GROUP BY 1) b ON a.k = b.k""")
def j27(t):
    a = t.events.groupBy(F.col("user_id").alias("k")).agg(F.count(F.lit(1)).alias("n"))
    b = t.supplier.groupBy((F.col("s_suppkey") * 2).alias("k")).agg(F.count(F.lit(1)).alias("n"))
    # pandas suffixes the columns both frames share
    return a.withColumnRenamed("n", "n_x").join(b.withColumnRenamed("n", "n_y"), on=["k"], how="outer")


@query("t01_union_all", """
SELECT 'customers' AS layer, count(*) AS row_count FROM customer UNION ALL SELECT 'orders', count(*) FROM orders
UNION ALL SELECT 'lines', count(*) FROM lineitem""")
def t01(t):
    return aggs.layer_counts({"customers": t.customer, "orders": t.orders, "lines": t.lineitem})


@query("t02_union_padded", """
SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment, CAST(NULL AS DOUBLE) AS earnings FROM customer
UNION ALL SELECT s_suppkey, s_name, NULL, s_acctbal FROM supplier""")
def t02(t):
    a = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    b = t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("earnings"))
    return a.unionByName(b, allowMissingColumns=True)


@query("t03_hot_and_cold", """
SELECT event_id, event_type, label FROM events JOIN (SELECT DISTINCT event_type, upper(event_type) AS label FROM events) USING (event_type)""")
def t03(t):
    labels = t.events.select("event_type").distinct().withColumn("label", F.upper("event_type"))
    rows = t.events.select("event_id", "event_type")
    return joins.salted_join(rows, labels, "event_type", salts=8, hot=["view", "click"], salt_by=["event_id"])

