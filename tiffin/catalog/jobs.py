"""Composed job queries (E*)."""

from pyspark.sql import functions as F

from tiffin.catalog import roles as r
from tiffin.catalog.aggregates import REST
from tiffin.catalog.functions import TIER_SQL
from tiffin.catalog.joining import BUYS, VIEWS, views_and_buys
from tiffin.catalog.projections import PRICE_TIERS
from tiffin.catalog.registry import SCHEMAS, query
from tiffin.functions import columns as c
from tiffin.operators import cdc, joins
from tiffin.operators.aggs import distinct_counts
from tiffin.plans import lake, orders as orders_plan, restaurants as rest_plan, users as users_plan
from tiffin.session import durable, scratch_path
from tiffin.sources.files import read_table, stream_files
from tiffin.streaming.history import versions
from tiffin.streaming.streams import current_state

BASE = r.with_ctes(r.RESTAURANTS, r.SALES, r.DRIVERS)
TIMED = r.with_ctes(r.RESTAURANTS, r.TIMED_SALES, r.DRIVERS)
DEC = "CAST({} AS DECIMAL(18,2))"

# ---------------------------------------------------------------- E1 orders ETL


@query("e01_orders_etl", """
SELECT event_id, CASE WHEN value > 50 THEN 'High' WHEN value > 25 THEN 'Medium' ELSE 'Low' END AS order_value_category,
  CAST(CAST(value AS DECIMAL(18,2)) * CAST('0.10' AS DECIMAL(4,2)) AS DOUBLE) AS delivery_fee, value / 10 * 2.0 + 15.0 AS estimated_delivery_minutes,
  CASE WHEN value > 75 THEN 'Premium' WHEN value > 40 AND CAST(json_extract(props, '$.k') AS INT) >= 50 THEN 'High Value'
    WHEN value > 25 THEN 'Regular' ELSE 'Basic' END AS customer_segment, CAST(ts AS DATE) AS day FROM events""")
def e01(t):
    rows = t.events.select(
        "event_id", "value", (F.col("value") / 10).alias("distance"), F.to_date("ts").alias("day"),
        F.from_json("props", "k INT")["k"].alias("items"),
    )
    path = orders_plan.orders_etl(rows, "value", "distance", "day", scratch_path(t.spark, "orders-etl"))
    return read_table(t.spark, path).select(
        "event_id", "order_value_category", "delivery_fee", "estimated_delivery_minutes",
        orders_plan.customer_segment("value", "items", many=50).alias("customer_segment"), "day",
    )


# ---------------------------------------------------------------- E2 dimensional model

MODEL_SQL = r.with_ctes(
    """rest AS (SELECT s_suppkey AS restaurant_id, s_name AS name, upper(n_name) AS city, r_name AS cuisine
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)""",
    "rat AS (SELECT l_suppkey AS restaurant_id, l_quantity AS rating, l_orderkey * 1000000 + l_suppkey AS rating_id FROM lineitem WHERE l_quantity BETWEEN 1 AND 45)",
    """inv AS (SELECT l_suppkey AS restaurant_id, l_partkey AS product_id, p_name AS product_name, p_type AS product_type, l_quantity AS quantity,
  CAST(l_quantity * p_retailprice AS DECIMAL(18,2)) AS inventory_value FROM lineitem JOIN part ON l_partkey = p_partkey)""",
)


def model(t):
    """Suppliers as restaurants, line quantities as ratings, parts as products, lines as stock."""
    bronze = r.drivers(t).select(
        F.col("driver_id").alias("restaurant_id"), F.col("driver_name").alias("name"), "city", F.col("vehicle").alias("cuisine")
    )
    rest = rest_plan.silver_restaurants(bronze)
    # Two lines of an order by one supplier count as one rating delivered twice.
    rated = t.lineitem.select(
        F.col("l_suppkey").alias("restaurant_id"), F.col("l_quantity").alias("rating"), (F.col("l_orderkey") * 1000000 + F.col("l_suppkey")).alias("rating_id")
    )
    products = rest_plan.silver_products(t.part.select(
        F.col("p_partkey").alias("product_id"), F.col("p_name").alias("product_name"), F.col("p_type").alias("product_type"),
        F.col("p_retailprice").alias("price"), (F.col("p_retailprice") / 2).alias("unit_cost"),
    ))
    stock = t.lineitem.select(
        F.col("l_suppkey").alias("restaurant_id"), F.col("l_partkey").alias("product_id"), F.col("l_quantity").alias("quantity")
    )
    dim = rest_plan.distinct_dimension(rest, "restaurant_id")
    ratings = rest_plan.rating_facts(rest_plan.silver_ratings(rated, 1, 45), rest)
    inventory = rest_plan.inventory_facts(rest_plan.silver_inventory(stock), products, rest, ["product_id"])
    return dim, ratings, inventory, rest_plan.distinct_dimension(products, "product_id")


SUMMARY_SQL = f"""count(DISTINCT restaurant_id) AS restaurant_count, count(rating) AS total_ratings, {r.mean_sql(DEC.format('rating'))} AS avg_rating,
  {r.n_if('rating >= 40')} AS high_ratings_count, {r.n_if('rating <= 5')} AS low_ratings_count,
  {r.pct_sql('sum(CASE WHEN rating >= 40 THEN 1 ELSE 0 END)', 'count(rating)')} AS high_ratings_pct,
  {r.pct_sql('sum(CASE WHEN rating <= 5 THEN 1 ELSE 0 END)', 'count(rating)')} AS low_ratings_pct"""


@query("e02_restaurant_summary", MODEL_SQL + f"SELECT restaurant_id, name, cuisine, city, {SUMMARY_SQL} FROM rat JOIN rest USING (restaurant_id) GROUP BY 1, 2, 3, 4")
def e02_restaurants(t):
    dim, ratings, _, _ = model(t)
    return rest_plan.restaurant_summary(ratings, dim, 40, 5, ["restaurant_id", "name", "cuisine", "city"])


@query("e02_cuisine_summary", MODEL_SQL + f"SELECT cuisine, {SUMMARY_SQL} FROM rat JOIN rest USING (restaurant_id) GROUP BY 1 HAVING count(rating) >= 10")
def e02_cuisines(t):
    dim, ratings, _, _ = model(t)
    return rest_plan.restaurant_summary(ratings, dim, 40, 5, ["cuisine"]).filter(F.col("total_ratings") >= 10)


@query("e02_product_summary", MODEL_SQL + f"""
SELECT product_id, product_name, product_type, count(DISTINCT restaurant_id) AS restaurants_offering, sum(quantity) AS total_quantity,
  CAST(sum(inventory_value) AS DOUBLE) AS total_inventory_value, {r.mean_sql(DEC.format('quantity'))} AS avg_quantity
FROM inv JOIN rest USING (restaurant_id) GROUP BY 1, 2, 3""")
def e02_products(t):
    _, _, inventory, products = model(t)
    return rest_plan.product_summary(inventory, products)


@query("e02_restaurant_inventory", MODEL_SQL + f"""
SELECT restaurant_id, name, city, count(DISTINCT product_id) AS unique_products, sum(quantity) AS total_items,
  CAST(sum(inventory_value) AS DOUBLE) AS total_inventory_value, {r.mean_sql('inventory_value')} AS avg_product_value
FROM inv JOIN rest USING (restaurant_id) GROUP BY 1, 2, 3""")
def e02_inventory(t):
    dim, _, inventory, _ = model(t)
    return rest_plan.restaurant_inventory(inventory, dim)


CITY_SQL = """
SELECT city, count(DISTINCT rest.restaurant_id) AS restaurant_count, count(DISTINCT rating_id) AS total_ratings, {mean} AS avg_rating, {stock} AS avg_inventory_value
FROM rest LEFT JOIN rat ON rest.restaurant_id = rat.restaurant_id
LEFT JOIN (SELECT restaurant_id, sum(inventory_value) AS v FROM inv GROUP BY 1) i ON rest.restaurant_id = i.restaurant_id GROUP BY city"""


@query("e02_city_summary", MODEL_SQL + CITY_SQL.format(mean=r.mean_sql(DEC.format("rating")), stock=r.mean_sql("v")))
def e02_cities(t):
    dim, ratings, inventory, _ = model(t)
    return rest_plan.city_summary(dim, ratings, inventory)


@query("e02_city_summary_once", MODEL_SQL + f"""
, once AS (SELECT city, {r.mean_sql('v')} AS avg_inventory_value FROM rest JOIN (SELECT restaurant_id, sum(inventory_value) AS v FROM inv GROUP BY 1) USING (restaurant_id) GROUP BY 1)
SELECT city, count(DISTINCT rest.restaurant_id) AS restaurant_count, count(DISTINCT rating_id) AS total_ratings, {r.mean_sql(DEC.format('rating'))} AS avg_rating,
  any_value(once.avg_inventory_value) AS avg_inventory_value
FROM rest LEFT JOIN rat ON rest.restaurant_id = rat.restaurant_id LEFT JOIN once USING (city) GROUP BY city""")
def e02_cities_once(t):
    dim, ratings, inventory, _ = model(t)
    return rest_plan.city_summary(dim, ratings, inventory, pre_aggregate=True)


# ---------------------------------------------------------------- E4 KPIs


@query("e04_kpis", f"""
SELECT CAST(order_time AS DATE) AS date, kind AS status, count(*) AS total_orders, CAST(sum(CAST(amount AS DECIMAL(18,2))) AS DOUBLE) AS revenue,
  {r.mean_sql(DEC.format('amount'))} AS avg_ticket
FROM ({VIEWS}) v JOIN (SELECT status_user, status_time, 'purchase' AS kind FROM ({BUYS})) b
ON user_id = status_user AND status_time >= order_time AND status_time <= order_time + INTERVAL 2 HOURS GROUP BY 1, 2""")
def e04(t):
    views, buys = views_and_buys(t)
    pairs = joins.interval_join(
        views, buys.withColumn("status", F.lit("purchase")), ("user_id", "status_user"), ("order_time", "status_time"), 7200
    )
    return orders_plan.kpis(pairs, "order_time", "status", "amount")


# ---------------------------------------------------------------- E5 unified users in batch

UNIFIED_SQL = """a AS (SELECT c_custkey AS user_id, c_name AS name, c_mktsegment AS segment, CAST(c_nationkey AS VARCHAR) AS country,
    TIMESTAMP '1996-06-01' AS seen_at FROM customer),
b AS (SELECT * EXCLUDE rn FROM (SELECT o_custkey AS user_id, o_orderkey AS last_order, o_orderstatus AS status, o_orderpriority AS country,
    o_orderdate AS seen_at, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
    FROM orders) WHERE rn = 1),
u AS (SELECT coalesce(a.user_id, b.user_id) AS user_id, a.name, a.segment, coalesce(a.country, b.country) AS country, b.last_order, b.status
  FROM a FULL JOIN b ON a.user_id = b.user_id),
hist AS (SELECT user_id, DATE '2024-01-01' AS d FROM u UNION ALL SELECT user_id, DATE '2024-01-08' FROM u WHERE status = 'F'
  UNION ALL SELECT user_id, DATE '2024-01-15' FROM u WHERE status = 'F' OR segment = 'BUILDING')"""


def unified(t):
    profile = t.customer.select(
        F.col("c_custkey").alias("user_id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"),
        F.col("c_nationkey").cast("string").alias("country"), F.lit("1996-06-01").cast("timestamp").alias("seen_at"),
    )
    activity = t.orders.select(
        F.col("o_custkey").alias("user_id"), F.col("o_orderkey").alias("last_order"), F.col("o_orderstatus").alias("status"),
        F.col("o_orderpriority").alias("country"), F.col("o_orderdate").alias("seen_at"),
    )
    return joins.unify_sources(
        profile, activity, "user_id", ([F.col("seen_at")], [F.col("seen_at"), F.col("last_order")]), ["country"], "seen_at"
    )


@query("e05_user_analytics", r.with_ctes(UNIFIED_SQL, "m AS (SELECT user_id, count(*) - 1 AS n, max(d) AS d FROM hist GROUP BY 1)",
    "top AS (SELECT country, status, count(*) AS k FROM u WHERE status IS NOT NULL GROUP BY 1, 2)",
    "best AS (SELECT country, min(status) AS top_category FROM top JOIN (SELECT country, max(k) AS k FROM top GROUP BY 1) USING (country, k) GROUP BY 1)",
    f"""g AS (SELECT country, count(DISTINCT user_id) AS members, count(name) AS with_name, count(segment) AS with_segment, count(status) AS with_status,
  {r.rounded('(100 * (count(name) + count(segment) + count(status)))', '(3 * count(*))', 1)} AS filled_pct,
  {r.n_if('name IS NOT NULL AND segment IS NOT NULL AND status IS NOT NULL')} AS complete_profiles,
  {r.rounded('CAST(sum(n) AS BIGINT)', 'count(*)', 1)} AS avg_changes_per_user, {r.n_if('n > 1')} AS high_activity_users, max(d) AS most_recent_change
  FROM u JOIN m USING (user_id) GROUP BY 1)""") + """
SELECT g.*, top_category, CASE WHEN filled_pct >= 90 THEN 'Excellent' WHEN filled_pct >= 75 THEN 'Good' WHEN filled_pct >= 50 THEN 'Fair' ELSE 'Poor' END AS grade
FROM g LEFT JOIN best USING (country)""")
def e05(t):
    users = durable(unified(t), "users")  # read by three history loads and the report
    day = lambda d: F.lit(d).cast("date")
    history = cdc.stamp_snapshot(users, day("2024-01-01"))
    history = cdc.append_snapshot(history, users.filter(F.col("status") == "F"), day("2024-01-08"))
    later = users.filter(F.coalesce(F.col("status") == "F", F.lit(False)) | F.coalesce(F.col("segment") == "BUILDING", F.lit(False)))
    history = cdc.append_snapshot(history, later, day("2024-01-15"))
    return users_plan.user_analytics(
        users, history, "user_id", ["country"], ["name", "segment", "status"], "status", "start_date", day("2024-02-01"), busy=1
    )


@query("e05_age_groups", """
WITH x AS (SELECT floor(date_diff('day', CAST(o_orderdate AS DATE), DATE '2031-06-01') / 365.25) AS age FROM orders)
SELECT CASE WHEN age BETWEEN 18 AND 25 THEN '18-25 (Young Adults)' WHEN age BETWEEN 26 AND 35 THEN '26-35 (Millennials)'
  WHEN age BETWEEN 36 AND 50 THEN '36-50 (Gen X)' WHEN age BETWEEN 51 AND 65 THEN '51-65 (Boomers)' WHEN age > 65 THEN '65+ (Seniors)' ELSE 'Unknown' END AS age_group,
  count(*) AS n FROM x GROUP BY 1""")
def e05_ages(t):
    born = t.orders.select(F.to_date("o_orderdate").alias("born"))
    return born.groupBy(users_plan.age_group("born", F.lit("2031-06-01").cast("date")).alias("age_group")).agg(F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------- E6 unified users from change feeds

FEEDS_SQL = """f AS (SELECT user_id, event_id AS seq, event_type = 'error' AS del, CASE WHEN event_type IN ('view', 'click') THEN event_type END AS city,
  CASE WHEN event_type IN ('view', 'click') THEN value END AS amount, CASE WHEN event_type IN ('purchase', 'signup') THEN props END AS props FROM events),
d AS (SELECT user_id, max(CASE WHEN del THEN seq ELSE -1 END) AS last_del, max(seq) AS last_seq FROM f GROUP BY 1),
cur AS (SELECT f.user_id, arg_max(city, seq) FILTER (city IS NOT NULL AND seq > last_del) AS city, arg_max(amount, seq) FILTER (amount IS NOT NULL AND seq > last_del) AS amount,
  arg_max(props, seq) FILTER (props IS NOT NULL AND seq > last_del) AS props FROM f JOIN d USING (user_id) WHERE last_seq != last_del GROUP BY 1)"""


def change_feeds(events):
    """Views and clicks from one system, purchases and sign-ups from the other; errors delete."""
    kind = F.col("event_type")
    operation = F.when(kind == "error", "DELETE").when(kind == "signup", "INSERT").otherwise("UPDATE").alias("operation")
    delivery = events.filter(kind.isin("view", "click", "error"))
    gone = kind == "error"
    first = delivery.select(
        "user_id", F.col("event_id").alias("seq"), operation, F.when(~gone, kind).alias("city"), F.when(~gone, F.col("value")).alias("amount")
    )
    second = events.filter(kind.isin("purchase", "signup")).select("user_id", F.col("event_id").alias("seq"), operation, "props")
    return first, second


def merged_feeds(t):
    return users_plan.merge_feeds(*change_feeds(t.events))


@query("e06_demographics", r.with_ctes(FEEDS_SQL) + """
SELECT city, count(DISTINCT user_id) AS total_users, count(DISTINCT CASE WHEN amount IS NOT NULL THEN user_id END) AS users_with_amount,
  count(DISTINCT CASE WHEN props IS NOT NULL THEN user_id END) AS users_with_props FROM cur GROUP BY city""")
def e06(t):
    current = users_plan.current_users(merged_feeds(t), "user_id", "seq", "operation", ignore_nulls=True)
    return users_plan.demographics(current, "city", "user_id", ["amount", "props"])


@query("e06_current_overwriting", r.with_ctes(FEEDS_SQL) + """
SELECT user_id, city, amount, props FROM f JOIN d USING (user_id) WHERE seq = last_seq AND NOT del""")
def e06_plain(t):
    # A later change of one source writes NULL over the columns of the other, as the plain union does.
    return users_plan.current_users(merged_feeds(t), "user_id", "seq", "operation")


@query("e06_stream_current", r.with_ctes(FEEDS_SQL) + "SELECT user_id, city, amount, props FROM f JOIN d USING (user_id) WHERE seq = last_seq AND NOT del")
def e06_stream(t):
    stream = stream_files(t.spark, t.folder, SCHEMAS["events"], pattern="events.parquet")
    paths = users_plan.run_feeds(*change_feeds(stream), scratch_path(t.spark, "feeds"), "user_id", "seq", "operation", ["city", "props"])
    return current_state(t.spark, paths["current"], ["user_id"], "seq").select("user_id", "city", "amount", "props")


def late_feeds(t):
    """The feeds run twice: the newer half of the events arrives first, the older half is late."""
    folder, base = scratch_path(t.spark, "arriving"), scratch_path(t.spark, "feeds")
    middle = t.events.agg(F.max("event_id") / 2).scalar()
    for rows in (t.events.filter(F.col("event_id") > middle), t.events.filter(F.col("event_id") <= middle)):
        rows.write.mode("append").parquet(folder)
        feeds = change_feeds(stream_files(t.spark, folder, SCHEMAS["events"]))
        paths = users_plan.run_feeds(*feeds, base, "user_id", "seq", "operation", ["city", "props"], settle_every=2)
    return paths


@query("e06_stream_demographics", r.with_ctes(FEEDS_SQL, "now AS (SELECT user_id, city, amount, props FROM f JOIN d USING (user_id) WHERE seq = last_seq AND NOT del)") + """
SELECT city, count(DISTINCT user_id) AS total_users, count(DISTINCT CASE WHEN amount IS NOT NULL THEN user_id END) AS users_with_amount,
  count(DISTINCT CASE WHEN props IS NOT NULL THEN user_id END) AS users_with_props FROM now GROUP BY city""")
def e06_stream_demographics(t):
    return users_plan.demographics(current_state(t.spark, late_feeds(t)["current"], ["user_id"], "seq"), "city", "user_id", ["amount", "props"])


FEED_HISTORY_SQL = r.with_ctes(FEEDS_SQL, """l AS (SELECT *, lag(seq) OVER w AS ps, lag(del) OVER w AS pd, lag(city) OVER w AS pc, lag(props) OVER w AS pp FROM f
  WINDOW w AS (PARTITION BY user_id ORDER BY seq))""", """v AS (SELECT *, sum(CASE WHEN NOT del AND (ps IS NULL OR pd OR city IS DISTINCT FROM pc OR props IS DISTINCT FROM pp) THEN 1 ELSE 0 END)
  OVER (PARTITION BY user_id ORDER BY seq) AS ver FROM l)""", """g AS (SELECT user_id, ver, min(seq) FILTER (NOT del) AS __START_AT, min(seq) FILTER (del) AS del_at, max(seq) FILTER (NOT del) AS last_at
  FROM v WHERE ver > 0 GROUP BY 1, 2)""") + """
SELECT g.user_id, f.city, f.amount, f.props, __START_AT, coalesce(del_at, lead(__START_AT) OVER (PARTITION BY g.user_id ORDER BY ver)) AS __END_AT
FROM g JOIN f ON f.user_id = g.user_id AND f.seq = last_at"""


@query("e06_history", FEED_HISTORY_SQL)
def e06_history(t):
    return users_plan.user_history(merged_feeds(t), "user_id", "seq", "operation", ["city", "props"])


@query("e06_stream_history", FEED_HISTORY_SQL)
def e06_stream_history(t):
    """The versions that the stream keeps, after late changes opened and split some of them."""
    return versions(t.spark, late_feeds(t)["history"], ["user_id"]).select("user_id", "city", "amount", "props", "__START_AT", "__END_AT")


# ---------------------------------------------------------------- E7 SQL script reports

AMOUNTS = "count(*) AS order_count, " + r.mean_sql(DEC.format("o_totalprice")) + " AS avg_order_amount"


@query("e07_monthly", f"""
SELECT CAST(year(o_orderdate) AS INT) AS year, CAST(month(o_orderdate) AS INT) AS month, {AMOUNTS}, {r.sum_sql(r.cash('o_totalprice'))} AS total_revenue,
  min(o_totalprice) AS min_order_amount, max(o_totalprice) AS max_order_amount FROM orders GROUP BY 1, 2""")
def e07_monthly(t):
    return orders_plan.time_report(t.orders, "o_orderdate", "o_totalprice")["monthly"]


@query("e07_hourly", f"""
SELECT CAST(hour(ts) AS INT) AS hour, count(*) AS order_count, {r.mean_sql(DEC.format('value'))} AS avg_order_amount,
  {r.pct_sql('count(*)', '(SELECT count(*) FROM events)')} AS percentage FROM events GROUP BY 1""")
def e07_hourly(t):
    return orders_plan.time_report(t.events, "ts", "value")["hourly"]


@query("e07_weekly", f"SELECT CAST(dayofweek(o_orderdate) + 1 AS INT) AS day_of_week, dayname(o_orderdate) AS day_name, {AMOUNTS} FROM orders GROUP BY 1, 2")
def e07_weekly(t):
    return orders_plan.time_report(t.orders, "o_orderdate", "o_totalprice")["weekly"]


@query("e07_user_cities", r.with_ctes(r.USERS) + f"""
SELECT city, count(*) AS user_count, {r.pct_sql('count(*)', '(SELECT count(*) FROM users)')} AS percentage FROM users WHERE city IS NOT NULL AND city != '' GROUP BY 1""")
def e07_cities(t):
    return users_plan.city_distribution(r.users(t), "city")


@query("e07_email_domains", f"""
SELECT lower(c_mktsegment) || '.com' AS email_domain, count(*) AS user_count, {r.pct_sql('count(*)', '(SELECT count(*) FROM customer)')} AS percentage FROM customer GROUP BY 1""")
def e07_domains(t):
    return users_plan.email_domains(t.customer, F.concat("c_name", F.lit("@"), "c_mktsegment", F.lit(".COM")))


@query("e07_drivers", TIMED + """
SELECT driver_id, driver_name, vehicle, city, count(order_id) AS delivery_count, min(order_date) AS first_delivery, max(order_date) AS last_delivery
FROM timed_sales JOIN drivers USING (driver_id) GROUP BY 1, 2, 3, 4""")
def e07_drivers(t):
    per_driver = r.timed_sales(t).groupBy("driver_id").agg(
        F.count("order_id").alias("delivery_count"), F.min("order_date").alias("first_delivery"), F.max("order_date").alias("last_delivery")
    )
    return per_driver.join(r.drivers(t), "driver_id")


@query("e07_city_deliveries", TIMED + f"""
SELECT r.city, count(order_id) AS order_count, count(DISTINCT driver_id) AS unique_drivers, count(DISTINCT restaurant_id) AS unique_restaurants,
  {r.mean_sql('amount_d')} AS avg_order_amount, CAST(sum(amount_d) AS DOUBLE) AS total_revenue
FROM timed_sales JOIN restaurants r USING (restaurant_id) GROUP BY 1""")
def e07_city_deliveries(t):
    joined = r.sales(t).join(r.restaurants(t).select("restaurant_id", "city"), "restaurant_id")
    rows = durable(joined.select("city", "order_id", "driver_id", "restaurant_id", "amount"), "city-sales")
    counts = distinct_counts(
        rows, ["city"], {"unique_drivers": "driver_id", "unique_restaurants": "restaurant_id"},
        {"order_count": ("count", F.col("order_id")), "_sum": ("sum", c.money("amount")), "_n": ("count", F.col("amount"))},
    )
    return counts.select(
        "city", "order_count", "unique_drivers", "unique_restaurants", c.ratio(F.col("_sum"), F.col("_n")).alias("avg_order_amount"),
        F.col("_sum").cast("double").alias("total_revenue"),
    )


# ---------------------------------------------------------------- E8 layered lake


EVENT_SALES = """event_sales AS (SELECT event_id AS order_id, user_id AS restaurant_id, user_id AS driver_id, ts AS order_date, value AS amount,
  CAST(value AS DECIMAL(18,2)) AS amount_d FROM events)"""
LAKE = r.with_ctes(r.RESTAURANTS, r.DRIVERS, EVENT_SALES)


def built_lake(t):
    """Events as sales, which have a time of day; most restaurants and some drivers have none."""
    base = scratch_path(t.spark, "lake")
    sales = t.events.select(
        F.col("event_id").alias("order_id"), F.col("user_id").alias("restaurant_id"), F.col("user_id").alias("driver_id"),
        F.col("ts").alias("order_date"), F.col("value").alias("amount"),
    )
    lake.build_lake(r.restaurants(t), r.drivers(t), sales, base, PRICE_TIERS)
    return base


@query("e08_lake_restaurants", LAKE + f"""
SELECT r.restaurant_id, name, cuisine, city, rating, {TIER_SQL.format('rating')} AS rating_category, count(order_id) AS order_count,
  CAST(sum(amount_d) AS DOUBLE) AS total_revenue, CASE WHEN count(order_id) > 0 THEN {r.mean_sql('amount_d')} END AS avg_order_value
FROM restaurants r LEFT JOIN event_sales USING (restaurant_id) GROUP BY 1, 2, 3, 4, 5, 6""")
def e08_restaurants(t):
    return read_table(t.spark, f"{built_lake(t)}/gold/restaurant_performance")


@query("e08_lake_cuisines", LAKE + f"""
SELECT cuisine, count(*) AS restaurant_count, {r.mean_sql('rating_d')} AS avg_rating, CAST(sum(n) AS BIGINT) AS total_orders, CAST(sum(s) AS DOUBLE) AS total_revenue
FROM (SELECT r.restaurant_id, cuisine, rating_d, count(order_id) AS n, sum(amount_d) AS s FROM restaurants r LEFT JOIN event_sales USING (restaurant_id) GROUP BY 1, 2, 3)
GROUP BY cuisine""")
def e08_cuisines(t):
    return read_table(t.spark, f"{built_lake(t)}/gold/cuisine_performance")


@query("e08_lake_drivers", LAKE + f"""
SELECT driver_id, driver_name, city, vehicle, count(order_id) AS delivery_count, CAST(sum(amount_d) AS DOUBLE) AS total_revenue,
  CASE WHEN count(order_id) > 0 THEN {r.mean_sql('amount_d')} END AS avg_revenue
FROM drivers LEFT JOIN event_sales USING (driver_id) GROUP BY 1, 2, 3, 4""")
def e08_drivers(t):
    return read_table(t.spark, f"{built_lake(t)}/gold/driver_performance")


@query("e08_lake_time", LAKE + f"""
SELECT CAST(year(order_date) AS INT) AS year, CAST(month(order_date) AS INT) AS month, substr(dayname(order_date), 1, 3) AS day_of_week,
  CAST(hour(order_date) AS INT) AS hour, count(*) AS order_count, CAST(sum(amount_d) AS DOUBLE) AS total_revenue, {r.mean_sql('amount_d')} AS avg_order_value
FROM event_sales GROUP BY 1, 2, 3, 4""")
def e08_time(t):
    return read_table(t.spark, f"{built_lake(t)}/gold/time_analytics")


# ---------------------------------------------------------------- E9 comprehensive analysis


@query("e09_restaurants", BASE + """, b AS (SELECT r.restaurant_id, name, cuisine, city, rating, reviews, count(order_id) AS order_count, sum(amount_d) AS rev
  FROM restaurants r LEFT JOIN sales USING (restaurant_id) GROUP BY ALL),
s AS (SELECT *, CAST(rev AS DOUBLE) / nullif(order_count, 0) * sqrt(reviews / 1000) AS performance_score FROM b)
SELECT restaurant_id, name, cuisine, city, rating, reviews, order_count, performance_score, coalesce(CAST(rev AS DOUBLE), 0) AS total_revenue,
  dense_rank() OVER (PARTITION BY cuisine ORDER BY performance_score DESC NULLS LAST) AS cuisine_rank,
  dense_rank() OVER (PARTITION BY city ORDER BY performance_score DESC NULLS LAST) AS city_rank,
  dense_rank() OVER (ORDER BY performance_score DESC NULLS LAST) AS overall_rank FROM s""")
def e09_restaurants(t):
    return rest_plan.comprehensive_performance(r.restaurants(t), r.sales(t))


@query("e09_cuisines", BASE + f""", o AS (SELECT cuisine, count(order_id) AS order_count, sum(amount_d) AS rev FROM restaurants LEFT JOIN sales USING (restaurant_id) GROUP BY 1)
SELECT cuisine, count(*) AS restaurant_count, {r.mean_sql('rating_d')} AS avg_rating, round(stddev_samp(rating), 4) AS rating_stddev, {r.n_if('rating >= 950')} AS high_rated_count,
  any_value(order_count) AS order_count, CAST(any_value(rev) AS DOUBLE) AS total_revenue,
  {r.rounded('CAST(any_value(rev) * 100 AS HUGEINT)', '(100 * count(*))')} AS revenue_per_restaurant, {r.rounded('any_value(order_count)', 'count(*)')} AS orders_per_restaurant,
  round(quantile_cont(rating, 0.5), 6) AS median_rating FROM restaurants JOIN o USING (cuisine) GROUP BY 1""")
def e09_cuisines(t):
    return rest_plan.cuisine_analysis(r.restaurants(t), r.sales(t), 950)


@query("e09_drivers", BASE + f""", v AS (SELECT driver_id, driver_name, vehicle, city, count(*) AS delivery_count, sum(amount_d) AS val, {r.mean_sql('amount_d')} AS avg_delivery_value
  FROM drivers JOIN sales USING (driver_id) GROUP BY 1, 2, 3, 4)
SELECT driver_id, driver_name, vehicle, city, delivery_count, CAST(val AS DOUBLE) AS total_delivery_value, avg_delivery_value, rank() OVER (ORDER BY val DESC) AS earnings_rank FROM v""")
def e09_drivers(t):
    return rest_plan.driver_ranking(r.drivers(t), r.sales(t))


@query("e09_cities", BASE + f""", m AS (SELECT r.city, count(DISTINCT r.restaurant_id) AS restaurant_count, {r.mean_sql('rating_d')} AS avg_rating, count(order_id) AS order_count,
  CAST(sum(amount_d) AS DOUBLE) AS total_revenue, count(DISTINCT driver_id) AS driver_count FROM restaurants r LEFT JOIN sales USING (restaurant_id) GROUP BY 1)
SELECT *, (rank() OVER (ORDER BY restaurant_count DESC) + rank() OVER (ORDER BY avg_rating DESC) + rank() OVER (ORDER BY total_revenue DESC NULLS LAST)
  + rank() OVER (ORDER BY driver_count DESC)) / 4.0 AS overall_performance_score FROM m""")
def e09_cities(t):
    return rest_plan.city_analysis(r.restaurants(t), r.sales(t))


# ---------------------------------------------------------------- E10 to E12, E15 dashboards and marts


@query("e10_dashboard", BASE + f""", b AS (SELECT r.restaurant_id, name, cuisine, city, rating, rating_d, reviews, count(order_id) AS order_count, sum(amount_d) AS rev,
  {r.mean_sql('amount_d')} AS avg_order_value FROM restaurants r LEFT JOIN sales USING (restaurant_id) GROUP BY ALL),
k AS (SELECT cuisine, CAST(sum(rating_d) AS DOUBLE) / count(*) AS avg_rating FROM b GROUP BY 1)
SELECT restaurant_id, name, cuisine, city, rating, (rating - avg_rating) / avg_rating * 100 AS rating_vs_cuisine_pct, order_count,
  CAST(rev AS DOUBLE) AS total_revenue, avg_order_value, rating * sqrt(reviews / 1000) AS popularity_score,
  rank() OVER (PARTITION BY cuisine ORDER BY rev DESC NULLS LAST) AS revenue_rank_in_cuisine, rank() OVER (PARTITION BY city ORDER BY rev DESC NULLS LAST) AS revenue_rank_in_city,
  {TIER_SQL.format('rating')} AS rating_category FROM b JOIN k USING (cuisine)""")
def e10(t):
    return rest_plan.performance_dashboard(r.restaurants(t), r.sales(t), PRICE_TIERS)


EFFICIENCY_SQL = """
SELECT *, rank() OVER (PARTITION BY vehicle ORDER BY revenue_per_hour DESC) AS efficiency_rank FROM (SELECT driver_id, driver_name, vehicle, city, order_count,
  CAST(rev AS DOUBLE) AS total_revenue, CAST(mins AS DOUBLE) AS total_minutes, CAST(km AS DOUBLE) AS total_km,
  order_count / (CAST(mins AS DOUBLE) / 60) AS orders_per_hour, CAST(rev AS DOUBLE) / (CAST(mins AS DOUBLE) / 60) AS revenue_per_hour,
  CAST(rev AS DOUBLE) / nullif(order_count, 0) AS revenue_per_order, CAST(km AS DOUBLE) / nullif(order_count, 0) AS km_per_order FROM x WHERE mins > 0)"""
WORK_SQL = """, s AS (SELECT l_suppkey AS driver_id, CAST(l_extendedprice AS DECIMAL(18,2)) AS amount_d FROM lineitem),
w AS (SELECT user_id AS driver_id, CAST(value AS DECIMAL(18,2)) AS mins, CAST(event_id % 50 AS DECIMAL(18,2)) AS km FROM events)"""


def work(t):
    """Lines as sales of the supplier, events as shifts: some have shifts without sales."""
    sold = t.lineitem.select(F.col("l_suppkey").alias("driver_id"), F.col("l_extendedprice").alias("amount"))
    shifts = t.events.select(F.col("user_id").alias("driver_id"), F.col("value").alias("shift_minutes"), (F.col("event_id") % 50).alias("distance_km"))
    return sold, shifts


@query("e11_driver_efficiency", BASE + WORK_SQL + """,
x AS (SELECT d.*, coalesce(n, 0) AS order_count, rev, mins, km FROM drivers d LEFT JOIN (SELECT driver_id, count(*) AS n, sum(amount_d) AS rev FROM s GROUP BY 1) USING (driver_id)
  LEFT JOIN (SELECT driver_id, sum(mins) AS mins, sum(km) AS km FROM w GROUP BY 1) USING (driver_id))""" + EFFICIENCY_SQL)
def e11(t):
    return rest_plan.driver_efficiency(r.drivers(t), *work(t))


@query("e11_driver_efficiency_fan_out", BASE + WORK_SQL + """,
x AS (SELECT d.driver_id, driver_name, vehicle, city, count(amount_d) AS order_count, sum(amount_d) AS rev, sum(mins) AS mins, sum(km) AS km
  FROM drivers d LEFT JOIN s USING (driver_id) LEFT JOIN w USING (driver_id) GROUP BY 1, 2, 3, 4)""" + EFFICIENCY_SQL)
def e11_fan_out(t):
    return rest_plan.driver_efficiency(r.drivers(t), *work(t), pre_aggregate=False)


MART_SQL = f"""WITH rest AS (SELECT c_custkey AS restaurant_id, c_mktsegment AS cuisine, n_name AS city, c_acctbal AS rating FROM customer JOIN nation ON c_nationkey = n_nationkey),
f AS (SELECT user_id AS restaurant_id, count(*) AS order_count, sum(CAST(value AS DECIMAL(18,2))) AS rev, {r.mean_sql(DEC.format('value'))} AS avg_order_value,
  count(DISTINCT strftime(ts, '%Y-%m')) AS active_months, {r.n_if("event_type IS NOT NULL AND year(ts) = 2024")} AS orders_year,
  CAST(sum(CASE WHEN year(ts) = 2024 THEN CAST(value AS DECIMAL(18,2)) ELSE 0 END) AS DOUBLE) AS revenue_year,
  {r.n_if('hour(ts) BETWEEN 11 AND 14')} AS lunch_orders, {r.n_if('hour(ts) BETWEEN 18 AND 21')} AS dinner_orders FROM events GROUP BY 1),
p AS (SELECT *, percent_rank() OVER (PARTITION BY cuisine ORDER BY rating) AS pr, dense_rank() OVER (PARTITION BY city ORDER BY rating DESC) AS rank_in_city FROM rest),
mart AS (SELECT restaurant_id, cuisine, city, rating, coalesce(order_count, 0) AS order_count, coalesce(active_months, 0) AS active_months, coalesce(orders_year, 0) AS orders_year,
  coalesce(lunch_orders, 0) AS lunch_orders, coalesce(dinner_orders, 0) AS dinner_orders, CAST(rev AS DOUBLE) AS total_revenue, coalesce(revenue_year, 0) AS revenue_year, avg_order_value,
  CASE WHEN pr >= 0.8 THEN 'Top 20%' WHEN pr >= 0.5 THEN 'Above Average' WHEN pr >= 0.2 THEN 'Below Average' ELSE 'Bottom 20%' END AS cuisine_percentile, rank_in_city
  FROM p LEFT JOIN f USING (restaurant_id))
"""


def mart(t):
    """Customers as restaurants, events as their orders: these have hours."""
    rest = r.users(t).select(
        F.col("user_id").alias("restaurant_id"), F.col("segment").alias("cuisine"), "city", F.col("balance").alias("rating")
    )
    sold = t.events.select(F.col("user_id").alias("restaurant_id"), F.col("value").alias("amount"), F.col("ts").alias("order_date"))
    return rest_plan.analytics_mart(rest, sold, 2024)


@query("e12_mart", MART_SQL + "SELECT * FROM mart")
def e12(t):
    return mart(t)


@query("e12_kpis", MART_SQL + """
SELECT restaurant_id, cuisine, city, order_count, total_revenue, total_revenue / nullif(order_count, 0) AS revenue_per_order,
  CASE WHEN rating >= 9000 THEN 'Excellent' WHEN rating >= 5000 THEN 'Good' ELSE 'Below Average' END AS rating_category,
  CASE WHEN total_revenue > 2000 THEN 'High Revenue' WHEN total_revenue > 1000 THEN 'Medium Revenue' ELSE 'Low Revenue' END AS revenue_category, rank_in_city FROM mart""")
def e12_kpis(t):
    return rest_plan.mart_kpis(mart(t), [(9000, "Excellent"), (5000, "Good")], 2000, 1000)


SCORE_SQL = BASE + """, b AS (SELECT r.restaurant_id, name, cuisine, city, rating, rating_d, reviews, count(order_id) AS order_count, coalesce(sum(amount_d), 0) AS rev
  FROM restaurants r LEFT JOIN sales USING (restaurant_id) GROUP BY ALL),
tops AS (SELECT CAST(max(rev) AS DOUBLE) AS mr, max(rating) AS mg, max(order_count) AS mo FROM b),
s AS (SELECT b.*, CAST(0.4 AS DOUBLE) * (CAST(rev AS DOUBLE) / mr) + CAST(0.3 AS DOUBLE) * (rating / mg) + CAST(0.3 AS DOUBLE) * (order_count / mo) AS performance_score FROM b, tops)
"""


def average_rank(by, out):
    return (
        f"rank() OVER (PARTITION BY cuisine ORDER BY {by} DESC) + (count(*) OVER (PARTITION BY cuisine, {by}) - 1) / 2.0 AS {out}"
    )


@query("e15_performance_score", SCORE_SQL + f"""
SELECT restaurant_id, name, cuisine, city, rating, reviews, order_count, CAST(rev AS DOUBLE) AS total_revenue, performance_score,
  {average_rank('rev', 'revenue_rank')}, {average_rank('rating', 'rating_rank')}, {average_rank('order_count', 'order_rank')} FROM s""")
def e15(t):
    return rest_plan.ranked_scores(rest_plan.performance_score(r.restaurants(t), r.sales(t)))


@query("e15_cuisine_score", SCORE_SQL + f"""
SELECT cuisine, count(*) AS restaurant_count, {r.mean_sql('rating_d')} AS avg_rating, CAST(sum(order_count) AS BIGINT) AS total_orders, CAST(sum(rev) AS DOUBLE) AS total_revenue,
  round(CAST(sum(CAST(performance_score AS DECIMAL(18,9))) AS DOUBLE) / count(*), 6) AS avg_performance FROM s GROUP BY 1""")
def e15_cuisine(t):
    return rest_plan.cuisine_scores(rest_plan.performance_score(r.restaurants(t), r.sales(t)))


# ---------------------------------------------------------------- E13, E14 order and rating reports

SOLD = f"count(*) AS order_count, {r.mean_sql('amount_d')} AS avg_order_value, CAST(sum(amount_d) AS DOUBLE) AS total_revenue"


@query("e13_cuisine", BASE + f"SELECT cuisine, {SOLD}, count(DISTINCT restaurant_id) AS restaurant_count FROM sales JOIN restaurants USING (restaurant_id) GROUP BY 1")
def e13_cuisine(t):
    return orders_plan.sales_report(r.sales(t), r.restaurants(t), r.drivers(t))["cuisine"]


@query("e13_driver", BASE + f"SELECT driver_name, vehicle, {SOLD} FROM sales JOIN restaurants USING (restaurant_id) JOIN drivers USING (driver_id) GROUP BY 1, 2")
def e13_driver(t):
    return orders_plan.sales_report(r.sales(t), r.restaurants(t), r.drivers(t))["driver"]


@query("e13_restaurant", BASE + f"SELECT name, cuisine, city, {SOLD} FROM sales JOIN restaurants USING (restaurant_id) GROUP BY 1, 2, 3")
def e13_restaurant(t):
    return orders_plan.sales_report(r.sales(t), r.restaurants(t), r.drivers(t))["restaurant"]


@query("e13_rating", BASE + "SELECT name, rating, count(*) AS order_count, CAST(sum(amount_d) AS DOUBLE) AS total_revenue FROM sales JOIN restaurants USING (restaurant_id) GROUP BY 1, 2")
def e13_rating(t):
    return orders_plan.sales_report(r.sales(t), r.restaurants(t), r.drivers(t))["rating"]


@query("e13_dashboard_city", REST + f"""
SELECT city, count(*) AS restaurant_count, {r.mean_sql('rating_d')} AS avg_rating, {r.mean_sql(DEC.format('reviews'), 0)} AS avg_reviews,
  CAST(sum(reviews) AS DOUBLE) AS total_reviews FROM restaurants GROUP BY 1 HAVING count(*) > 1""")
def e13_city(t):
    return rest_plan.rating_dashboard(r.restaurants(t))["city"]


@query("e13_dashboard_distribution", REST + "SELECT CAST(floor(rating / 10) * 10 AS BIGINT) AS rating_bucket, count(*) AS restaurant_count FROM restaurants GROUP BY 1")
def e13_distribution(t):
    return rest_plan.rating_dashboard(r.restaurants(t))["distribution"]


@query("e13_dashboard_cuisine", REST + f"""
SELECT cuisine, count(*) AS restaurant_count, {r.mean_sql('rating_d')} AS avg_rating, CAST(sum(reviews) AS BIGINT) AS total_reviews,
  round(sum(rating * reviews) / sum(reviews), 6) AS weighted_rating FROM restaurants GROUP BY 1 HAVING count(*) > 1""")
def e13_dashboard(t):
    return rest_plan.rating_dashboard(r.restaurants(t))["cuisine"]


@query("e13_dashboard_top", REST + """
SELECT restaurant_id, name, cuisine, city, rating, reviews, rating * sqrt(reviews / 1000) AS popularity_score FROM restaurants
ORDER BY popularity_score DESC, restaurant_id LIMIT 20""")
def e13_top(t):
    return rest_plan.rating_dashboard(r.restaurants(t))["top"]


@query("e14_ratings_by_time", """
SELECT CASE WHEN value >= 100 THEN 'High' WHEN value >= 20 THEN 'Medium' ELSE 'Low' END AS rating_category, dayname(ts) AS day_of_week, CAST(hour(ts) AS INT) AS hour_of_day,
  count(*) AS ratings FROM events GROUP BY 1, 2, 3""")
def e14(t):
    return orders_plan.ratings_report(t.events, "user_id", "value", "ts", 100, 20)["by_time"]


@query("e14_ratings_distribution", "SELECT l_quantity, count(*) AS ratings FROM lineitem GROUP BY 1")
def e14_distribution(t):
    return orders_plan.ratings_report(t.lineitem, "l_partkey", "l_quantity", "l_shipdate", 40, 20)["distribution"]


@query("e14_ratings_by_restaurant", f"""
SELECT l_partkey, {r.mean_sql(DEC.format('l_quantity'))} AS avg_rating, min(l_quantity) AS min_rating, max(l_quantity) AS max_rating FROM lineitem GROUP BY 1""")
def e14_restaurant(t):
    return orders_plan.ratings_report(t.lineitem, "l_partkey", "l_quantity", "l_shipdate", 40, 20)["restaurant"]


# ---------------------------------------------------------------- E16 two forms of one report

MATCH_SQL = r.with_ctes(
    r.USERS,
    """rest AS (SELECT s_suppkey AS restaurant_id, n_name AS city, r_name AS cuisine, CAST(s_acctbal AS DECIMAL(18,2)) AS rating_d
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)""",
    """o AS (SELECT l_orderkey AS order_id, o_custkey AS user_id, l_suppkey AS restaurant_id, CAST(l_extendedprice AS DECIMAL(18,2)) AS amount_d
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)""",
)


def local_orders(t):
    """Orders beside the city of their user and of their restaurant."""
    lines = r.timed_sales(t).select("order_id", "user_id", F.col("driver_id").alias("restaurant_id"), "amount")
    rest = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("s_suppkey").alias("restaurant_id"), F.col("n_name").alias("city"), F.col("r_name").alias("cuisine"), F.col("s_acctbal").alias("rating")
    )
    users = r.users(t).select("user_id", F.col("city").alias("user_city"))
    return lines, rest, users


@query("e16_orders_first", MATCH_SQL + f"""
SELECT cuisine, count(DISTINCT restaurant_id) AS restaurant_count, count(DISTINCT user_id) AS user_count, count(DISTINCT order_id) AS order_count,
  {r.mean_sql('amount_d')} AS avg_order_amount, {r.mean_sql('rating_d')} AS avg_restaurant_rating
FROM (SELECT o.*, m.cuisine, m.rating_d FROM o LEFT JOIN (SELECT user_id, restaurant_id, cuisine, rating_d FROM users JOIN rest USING (city)) m USING (user_id, restaurant_id))
GROUP BY cuisine""")
def e16_orders(t):
    # Whether user and restaurant share a city is decided per order; the list of all such pairs is not needed.
    lines, rest, users = local_orders(t)
    joined = lines.join(users, "user_id").join(rest, "restaurant_id")
    near = F.col("city") == F.col("user_city")
    rows = durable(joined.select(F.when(near, F.col("cuisine")).alias("cuisine"), "restaurant_id", "user_id", "order_id", "amount", F.when(near, F.col("rating")).alias("rating")), "local-orders")
    counts = distinct_counts(
        rows, ["cuisine"], {"restaurant_count": "restaurant_id", "user_count": "user_id", "order_count": "order_id"},
        {"_sum": ("sum", c.money("amount")), "_n": ("count", F.col("amount")), "_rated": ("sum", c.money("rating")), "_ratings": ("count", F.col("rating"))},
    )
    return counts.select(
        "cuisine", "restaurant_count", "user_count", "order_count", c.ratio(F.col("_sum"), F.col("_n")).alias("avg_order_amount"),
        c.ratio(F.col("_rated"), F.col("_ratings")).alias("avg_restaurant_rating"),
    )


@query("e16_cuisines_first", MATCH_SQL + f"""
SELECT cs.cuisine, cs.restaurant_count, cs.avg_rating, count(DISTINCT u.user_id) AS user_count, count(DISTINCT o.order_id) AS order_count, {r.mean_sql('o.amount_d')} AS avg_order_amount
FROM (SELECT cuisine, count(DISTINCT restaurant_id) AS restaurant_count, {r.mean_sql('rating_d')} AS avg_rating FROM rest GROUP BY 1) cs
JOIN rest x ON x.cuisine = cs.cuisine JOIN users u ON u.city = x.city LEFT JOIN o ON o.user_id = u.user_id AND o.restaurant_id = x.restaurant_id GROUP BY 1, 2, 3""")
def e16_cuisines(t):
    lines, rest, users = local_orders(t)
    stats = rest.groupBy("cuisine").agg(F.countDistinct("restaurant_id").alias("restaurant_count"), c.mean("rating").alias("avg_rating"))
    in_city = users.groupBy(F.col("user_city").alias("city")).agg(F.count(F.lit(1)).alias("n"))
    reached = rest.select("cuisine", "city").distinct().join(in_city, "city").groupBy("cuisine").agg(F.sum("n").alias("user_count"))
    sold = (
        lines.join(users, "user_id").join(rest, "restaurant_id").filter(F.col("city") == F.col("user_city")).groupBy("cuisine")
        .agg(F.countDistinct("order_id").alias("order_count"), c.mean("amount").alias("avg_order_amount"))
    )
    return stats.join(reached, "cuisine").join(sold, "cuisine", "left").fillna(0, ["order_count"])


# ---------------------------------------------------------------- E17 to E22


@query("e17_daily_rolling", """
WITH d AS (SELECT CAST(o_orderdate AS DATE) AS order_day, count(*) AS order_count, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS s FROM orders GROUP BY 1)
SELECT order_day, order_count, CAST(s AS DOUBLE) AS revenue, CAST(sum(s) OVER w AS DOUBLE) / count(*) OVER w AS rolling_avg FROM d
WINDOW w AS (ORDER BY order_day ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""")
def e17(t):
    return orders_plan.daily_rolling(t.orders, "o_orderdate", "o_totalprice")


@query("e18_api_parity", """
SELECT f AS form, p_type, count(*) AS n, CAST(max(p_size) AS BIGINT) AS top FROM part, (VALUES ('dataframe'), ('sql'), ('pandas')) x(f) GROUP BY 1, 2""")
def e18(t):
    import pyspark.pandas as ps

    api = t.part.groupBy("p_type").agg(F.count(F.lit(1)).alias("n"), F.max("p_size").alias("top"))
    t.part.createOrReplaceTempView("tiffin_part")
    sql = t.spark.sql("SELECT p_type, count(*) AS n, max(p_size) AS top FROM tiffin_part GROUP BY p_type")
    with ps.option_context("compute.default_index_type", "distributed"):
        frame = t.part.pandas_api()
        pandas = (
            frame.groupby("p_type").agg({"p_partkey": "count", "p_size": "max"}).reset_index()
            .rename(columns={"p_partkey": "n", "p_size": "top"}).to_spark()
        )
    forms = {"dataframe": api, "sql": sql, "pandas": pandas}
    shown = [
        df.select(F.lit(name).alias("form"), "p_type", F.col("n").cast("bigint").alias("n"), F.col("top").cast("bigint").alias("top"))
        for name, df in forms.items()
    ]
    return shown[0].unionByName(shown[1]).unionByName(shown[2])


@query("e19_relational_drivers", r.with_ctes(r.DRIVERS, """sold AS (SELECT l_suppkey AS driver_id, l_orderkey AS order_id,
  CAST(CASE WHEN l_quantity != 7 THEN l_extendedprice END AS DECIMAL(18,2)) AS amount_d FROM lineitem)""") + """
SELECT driver_id, driver_name, vehicle, city, count(order_id) AS delivery_count, CAST(sum(amount_d) AS DOUBLE) AS total_delivery_value
FROM drivers LEFT JOIN sold USING (driver_id) GROUP BY 1, 2, 3, 4""")
def e19(t):
    return relational(t)["driver_analytics"]


def relational(t):
    """The five tables of the relational job, with gaps: events as sales, no rating for one part type."""
    rated = r.restaurants(t).withColumn("rating", F.when(F.col("cuisine") != "PROMO", F.col("rating")))
    return lake.relational_tables(rated, r.drivers(t), r.sales(t).withColumn("amount", F.when(F.col("quantity") != 7, F.col("amount"))))


RELATIONAL = r.with_ctes(
    r.RESTAURANTS, r.DRIVERS, "kept AS (SELECT * EXCLUDE (rating_d) FROM restaurants WHERE cuisine != 'PROMO')",
    """sold AS (SELECT l_orderkey AS order_id, l_partkey AS restaurant_id, l_suppkey AS driver_id, CASE WHEN l_quantity != 7 THEN l_extendedprice END AS amount,
  CAST(CASE WHEN l_quantity != 7 THEN l_extendedprice END AS DECIMAL(18,2)) AS amount_d, l_quantity AS quantity FROM lineitem)""",
)


@query("e19_relational_restaurants", RELATIONAL + "SELECT * FROM kept")
def e19_restaurants(t):
    return relational(t)["restaurants_raw"]


@query("e19_relational_drivers_raw", RELATIONAL + "SELECT * FROM drivers")
def e19_drivers_raw(t):
    return relational(t)["drivers_raw"]


@query("e19_relational_orders", RELATIONAL + "SELECT * EXCLUDE (amount_d) FROM sold WHERE amount IS NOT NULL")
def e19_orders(t):
    return relational(t)["orders_raw"]


@query("e19_relational_analytics", RELATIONAL + """
SELECT k.*, count(order_id) AS order_count, CAST(sum(amount_d) AS DOUBLE) AS total_revenue
FROM kept k LEFT JOIN (SELECT * FROM sold WHERE amount IS NOT NULL) s ON k.restaurant_id = s.restaurant_id GROUP BY ALL""")
def e19_analytics(t):
    return relational(t)["restaurant_analytics"]


def people(t):
    """Users and restaurants with a nation as city; the restaurants are suppliers with a phone number."""
    shops = t.supplier.select(
        F.col("s_suppkey").alias("restaurant_id"), F.col("s_nationkey").alias("city"), F.nullif("s_name", F.lit("Supplier#000000007")).alias("cuisine"),
        F.col("s_acctbal").alias("rating"), F.col("s_nationkey").alias("reviews"),
        F.concat(F.lit("("), F.col("s_nationkey").cast("string"), F.lit(") "), F.substring("s_name", 10, 9)).alias("phone"),
    )
    users = t.customer.select(F.col("c_custkey").alias("user_id"), F.col("c_nationkey").alias("city"))
    return users, shops


@query("e20_cleaned", """
SELECT s_suppkey AS restaurant_id, s_nationkey AS city, coalesce(nullif(s_name, 'Supplier#000000007'), 'Unknown') AS cuisine, s_acctbal AS rating, s_nationkey AS reviews,
  s_nationkey || substr(s_name, 10) AS phone, CASE WHEN s_acctbal >= 5000 THEN 'Good' ELSE 'Below Average' END AS rating_category FROM supplier""")
def e20(t):
    users, shops = people(t)
    return lake.clean_and_match(users, shops, r.timed_sales(t), [(5000, "Good")], "phone", "city")["restaurants"]


@query("e20_city_match", f"""
SELECT c_nationkey AS city, count(DISTINCT c_custkey) AS left_count, count(DISTINCT s_suppkey) AS right_count,
  {r.rounded('count(DISTINCT s_suppkey)', 'count(DISTINCT c_custkey)')} AS right_per_left, round(avg(s_acctbal), 2) AS mean_value
FROM customer JOIN supplier ON c_nationkey = s_nationkey GROUP BY 1""")
def e20_match(t):
    users, shops = people(t)
    return lake.clean_and_match(users, shops, r.timed_sales(t), [(5000, "Good")], "phone", "city")["city"]


@query("e21_restaurants", BASE + f"""
SELECT restaurant_id, name, cuisine, city, {SOLD}, rating * CAST(0.3 AS DOUBLE) + count(*) / 10 * CAST(0.7 AS DOUBLE) AS performance_score FROM sales JOIN restaurants USING (restaurant_id)
GROUP BY restaurant_id, name, cuisine, city, rating""")
def e21(t):
    tables = lake.delivery_tables(r.restaurants(t), r.drivers(t), r.sales(t))
    paths = lake.write_delivery(tables, scratch_path(t.spark, "delivery"))
    return read_table(t.spark, paths["restaurant_performance"])


@query("e21_locations", BASE + f"SELECT city, {SOLD}, count(DISTINCT restaurant_id) AS restaurant_count FROM sales JOIN restaurants USING (restaurant_id) GROUP BY 1")
def e21_locations(t):
    return lake.delivery_tables(r.restaurants(t), r.drivers(t), r.sales(t))["location_analytics"]


@query("e22_city_counts", "SELECT c_nationkey AS city, count(DISTINCT c_custkey) AS user_count, count(DISTINCT s_suppkey) AS restaurant_count FROM customer JOIN supplier ON c_nationkey = s_nationkey GROUP BY 1")
def e22(t):
    users, shops = people(t)
    return lake.pandas_workflow(users, shops, r.timed_sales(t), "city")["city"]


@query("e22_monthly", TIMED + f"""
SELECT CAST(year(order_date) AS INT) AS year, CAST(month(order_date) AS INT) AS month, count(*) AS order_count, {r.mean_sql('amount_d')} AS avg_order_value FROM timed_sales GROUP BY 1, 2""")
def e22_monthly(t):
    users, shops = people(t)
    return lake.pandas_workflow(users, shops, r.timed_sales(t), "city")["monthly"]
