"""Projection and filter queries (P*)."""

from pyspark.sql import functions as F

from tiffin.catalog import roles as r
from tiffin.catalog.registry import query
from tiffin.functions import columns as c
from tiffin.operators import aggs, joins
from tiffin.streaming.delivery import actionable_alerts, enrich_delivery

# Share tiers of the reports, scaled to the price range of the test tables.
PRICE_TIERS = [(975.0, "Excellent"), (950.0, "Very Good"), (925.0, "Good"), (910.0, "Average")]
REGION_OF_TYPE = {"ECONOMY": "Value", "STANDARD": "Value", "PROMO": "Campaign", "SMALL": "Size", "MEDIUM": "Size"}


@query("p01_select_alias", "SELECT p_partkey AS restaurant_id, p_name AS name, p_size AS reviews FROM part")
def p01(t):
    part = t.part
    return part.select(F.col("p_partkey").alias("restaurant_id"), part.p_name.alias("name"), F.expr("p_size AS reviews"))


@query("p02_rename", "SELECT s_suppkey AS driver_id, s_name AS driver_name, s_nationkey, s_acctbal AS earnings FROM supplier")
def p02(t):
    return t.supplier.withColumnRenamed("s_suppkey", "driver_id").withColumnsRenamed(
        {"s_name": "driver_name", "s_acctbal": "earnings"}
    )


@query("p03_add_drop", """
SELECT p_partkey, p_name, p_brand, p_type, p_size > 25 AS is_popular, p_brand || ', ' || p_type AS location,
  CAST(p_size * 2 AS BIGINT) AS doubled FROM part""")
def p03(t):
    return (
        t.part.withColumns({
            "is_popular": F.col("p_size") > 25,
            "location": F.concat("p_brand", F.lit(", "), "p_type"),
            "doubled": F.col("p_size").cast("bigint") * 2,
        }).drop("p_retailprice", "p_size")
    )


@query("p04_comparisons", """
SELECT o_orderkey, o_totalprice FROM orders
WHERE o_totalprice > 100000 AND o_totalprice < 400000 AND o_orderstatus = 'F' AND o_orderpriority != '5-LOW'""")
def p04(t):
    return (
        t.orders.filter((F.col("o_totalprice") > 100000) & (F.col("o_totalprice") < 400000))
        .filter(F.col("o_orderstatus") == "F")
        .filter(F.col("o_orderpriority") != "5-LOW")
        .select("o_orderkey", "o_totalprice")
    )


@query("p05_and_or_not", """
SELECT p_partkey, p_type, p_size FROM part
WHERE (p_type = 'PROMO' OR p_size >= 40) AND NOT (p_brand = 'Brand#1' AND p_size < 10)""")
def p05(t):
    wanted = (F.col("p_type") == "PROMO") | (F.col("p_size") >= 40)
    return t.part.filter(wanted & ~((F.col("p_brand") == "Brand#1") & (F.col("p_size") < 10))).select(
        "p_partkey", "p_type", "p_size"
    )


@query("p06_in_list", """
SELECT p_partkey, p_type, p_brand FROM part
WHERE p_type IN ('PROMO', 'SMALL', 'LARGE') AND p_brand NOT IN ('Brand#1', 'Brand#2')""")
def p06(t):
    return t.part.filter(
        F.col("p_type").isin("PROMO", "SMALL", "LARGE") & ~F.col("p_brand").isin("Brand#1", "Brand#2")
    ).select("p_partkey", "p_type", "p_brand")


@query("p07_between", """
SELECT o_orderkey, o_orderdate, o_totalprice FROM orders
WHERE o_totalprice BETWEEN 50000 AND 150000 AND o_orderdate BETWEEN TIMESTAMP '1997-01-01' AND TIMESTAMP '1998-12-31'""")
def p07(t):
    return t.orders.filter(
        F.col("o_totalprice").between(50000, 150000)
        & F.col("o_orderdate").between(F.lit("1997-01-01").cast("timestamp"), F.lit("1998-12-31").cast("timestamp"))
    ).select("o_orderkey", "o_orderdate", "o_totalprice")


@query("p08_like_rlike", """
SELECT p_partkey, p_name FROM part WHERE p_name LIKE '%ring%' OR regexp_matches(p_name, '^(red|blue) [a-m]')""")
def p08(t):
    return t.part.filter(F.col("p_name").like("%ring%") | F.col("p_name").rlike("^(red|blue) [a-m]")).select(
        "p_partkey", "p_name"
    )


@query("p08_keyword_groups", """
SELECT p_partkey, CASE WHEN p_name LIKE '%ring%' OR p_name LIKE '%gear%' THEN 'Round' WHEN p_name LIKE '%bolt%' THEN 'Fastener' ELSE 'Other' END AS word_group FROM part""")
def p08_groups(t):
    groups = [("Round", ["ring", "gear"]), ("Fastener", ["bolt"])]
    return t.part.select("p_partkey", c.keyword_group("p_name", groups, "Other", "Unknown").alias("word_group"))


@query("p09_is_null", """
SELECT c_custkey, event_id IS NULL AS without_order, count(event_id) AS orders
FROM customer LEFT JOIN events ON c_custkey = user_id
WHERE c_name IS NOT NULL GROUP BY 1, 2""")
def p09(t):
    people = t.customer.filter(F.col("c_name").isNotNull())
    return (
        people.join(t.events.select("event_id", "user_id"), F.col("c_custkey") == F.col("user_id"), "left")
        .groupBy("c_custkey", F.col("event_id").isNull().alias("without_order"))
        .agg(F.count("event_id").alias("orders"))
    )


@query("p10_tiers", """
SELECT p_partkey,
  CASE WHEN p_retailprice >= 975 THEN 'Excellent' WHEN p_retailprice >= 950 THEN 'Very Good'
       WHEN p_retailprice >= 925 THEN 'Good' WHEN p_retailprice >= 910 THEN 'Average' ELSE 'Below Average' END AS rating_tier,
  CASE WHEN p_size > 40 THEN 'Extremely Popular' WHEN p_size > 25 THEN 'Very Popular'
       WHEN p_size > 10 THEN 'Popular' ELSE 'Standard' END AS popularity_level,
  CASE WHEN p_size >= 0 AND p_size < 10 THEN 'low' WHEN p_size >= 10 AND p_size < 30 THEN 'mid'
       WHEN p_size >= 30 THEN 'high' END AS size_band
FROM part""")
def p10(t):
    return t.part.select(
        "p_partkey",
        c.tier("p_retailprice", PRICE_TIERS, "Below Average").alias("rating_tier"),
        c.above_tier(
            "p_size", [(40, "Extremely Popular"), (25, "Very Popular"), (10, "Popular")], "Standard"
        ).alias("popularity_level"),
        c.band("p_size", [0, 10, 30], ["low", "mid", "high"]).alias("size_band"),
    )


@query("p11_fee_eta", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity * 2.0 + 15.0 AS eta_minutes,
  CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST('0.10' AS DECIMAL(4,2)) AS DOUBLE) AS fee,
  CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST('1.10' AS DECIMAL(4,2)) AS DOUBLE) AS with_tax
FROM lineitem""")
def p11(t):
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        c.delivery_eta("l_quantity").alias("eta_minutes"),
        c.delivery_fee("l_extendedprice").cast("double").alias("fee"),
        c.delivery_fee("l_extendedprice", "1.10").cast("double").alias("with_tax"),
    )


ENRICHED_SQL = """deliveries AS (
  SELECT v.event_id AS order_id, v.user_id, v.value AS total_amount, v.ts AS order_event_time,
    p.event_type AS current_status, p.ts AS status_event_time, p.event_id AS status_id,
    CASE WHEN p.ts IS NOT NULL THEN abs(epoch(date_trunc('second', p.ts)) - epoch(date_trunc('second', v.ts))) / 60.0 END
      AS delivery_time_minutes
  FROM (SELECT * FROM events WHERE event_type = 'view') v
  LEFT JOIN (SELECT * FROM events WHERE event_type IN ('purchase', 'click')) p
    ON v.user_id = p.user_id AND p.ts >= v.ts AND p.ts <= v.ts + INTERVAL 2 HOURS)"""


def deliveries(t):
    """Views as orders, purchases and clicks as their status updates within two hours."""
    orders = t.events.filter(F.col("event_type") == "view").select(
        F.col("event_id").alias("order_id"), "user_id", F.col("value").alias("total_amount"), F.col("ts").alias("order_event_time")
    )
    status = t.events.filter(F.col("event_type").isin("purchase", "click")).select(
        F.col("user_id").alias("status_user"), F.col("event_type").alias("current_status"),
        F.col("ts").alias("status_event_time"), F.col("event_id").alias("status_id"),
    )
    joined = joins.interval_join(
        orders, status, ("user_id", "status_user"), ("order_event_time", "status_event_time"), 7200, "left"
    ).drop("status_user")
    return enrich_delivery(joined, delivered="purchase", threshold=15)


@query("p12_actionable_alerts", r.with_ctes(ENRICHED_SQL) + """
SELECT order_id, current_status, delivery_time_minutes, total_amount FROM deliveries
WHERE delivery_time_minutes > 45 AND current_status != 'purchase' AND total_amount >= 20
  AND delivery_time_minutes < 180 AND current_status IN ('click')""")
def p12(t):
    return actionable_alerts(
        deliveries(t), critical=45, least_value=20, longest=180, statuses=["click"]
    ).select("order_id", "current_status", "delivery_time_minutes", "total_amount")


@query("p13_scores", """
WITH tops AS (SELECT max(p_retailprice) AS mp, max(p_size) AS ms FROM part)
SELECT p_partkey, round(p_retailprice * sqrt(p_size / 1000), 6) AS popularity,
  round(pow(p_retailprice, 2) * ln(p_size + 1), 4) AS weighted,
  round(p_retailprice * log10(greatest(p_size, 10)), 6) AS floored,
  round(0.7 * (p_retailprice / mp) + 0.3 * (p_size / ms), 6) AS normalised
FROM part, tops""")
def p13(t):
    tops = t.part.agg(F.struct(F.max("p_retailprice").alias("mp"), F.max("p_size").alias("ms"))).scalar()
    both = t.part.withColumn("tops", tops)
    return both.select(
        "p_partkey",
        F.round(c.popularity("p_retailprice", "p_size"), 6).alias("popularity"),
        F.round(c.log_score("p_retailprice", "p_size"), 4).alias("weighted"),
        F.round(c.floored_log_score("p_retailprice", "p_size"), 6).alias("floored"),
        F.round(
            c.weighted_score([(0.7, F.col("p_retailprice"), F.col("tops.mp")), (0.3, F.col("p_size"), F.col("tops.ms"))]), 6
        ).alias("normalised"),
    )


@query("p14_point_lookup", "SELECT o_orderkey, o_custkey, o_totalprice, o_orderstatus FROM orders WHERE o_orderkey = 4")
def p14(t):
    return t.orders.filter(F.col("o_orderkey") == 4).select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")


@query("p15_query_string", "SELECT p_partkey, p_name, p_size FROM part WHERE p_type = 'PROMO' AND p_size > 20")
def p15(t):
    return t.part.filter("p_type = 'PROMO' and p_size > 20").select("p_partkey", "p_name", "p_size")


@query("p16_summary_builder", r.with_ctes(r.RESTAURANTS) + f"""
SELECT cuisine, count(*) AS restaurant_count, {r.mean_sql('rating_d')} AS avg_rating
FROM restaurants WHERE reviews > 10 GROUP BY cuisine ORDER BY restaurant_count DESC, cuisine LIMIT 5""")
def p16(t):
    return aggs.summarise(
        r.restaurants(t),
        {"restaurant_count": F.count(F.lit(1)), "avg_rating": c.mean("rating")},
        by=["cuisine"], where="reviews > 10",
        order=[F.col("restaurant_count").desc(), F.col("cuisine")], limit=5,
    )


@query("p17_valid_or_null", """
SELECT c_custkey, CASE WHEN c_acctbal >= 0 AND c_acctbal <= 5000 THEN c_acctbal END AS validated FROM customer""")
def p17(t):
    return t.customer.select("c_custkey", c.valid_or_null("c_acctbal", 0, 5000).alias("validated"))


@query("p18_lookup", """
SELECT p_partkey, p_type, CASE WHEN p_type IN ('ECONOMY','STANDARD') THEN 'Value' WHEN p_type = 'PROMO' THEN 'Campaign'
  WHEN p_type IN ('SMALL','MEDIUM') THEN 'Size' END AS type_group FROM part""")
def p18(t):
    return joins.lookup(t.part.select("p_partkey", "p_type"), "p_type", REGION_OF_TYPE, "type_group")
