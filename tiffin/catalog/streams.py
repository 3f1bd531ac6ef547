"""Streaming queries (X*, and the stream forms of S11, S12, J21, J23, K17, C1).

Each runs a stream over the input files until they are used up and gives back the sink. Where only a later time stamp
closes a window, two sentinel rows one day after the last event are streamed along and left out of the result.
"""

from pyspark.sql import functions as F

from tiffin.catalog import roles as r
from tiffin.catalog.history import DELETES, SCD2_SQL, feed
from tiffin.catalog.joining import BUYS, VIEWS
from tiffin.catalog.projections import ENRICHED_SQL, deliveries
from tiffin.catalog.registry import SCHEMAS, query
from tiffin.functions import columns as c
from tiffin.operators.aggs import distinct_counts, share_of_total
from tiffin.plans import realtime
from tiffin.session import scratch_path
from tiffin.sources.files import add_lineage, stream_files
from tiffin.streaming import streams as st
from tiffin.streaming.delivery import actionable_alerts, delay_message, delivery_measures, enrich_delivery, time_bucket, to_messages
from tiffin.streaming.history import keep_versions, versions

SENTINEL_USER = -1


def event_stream(t, max_files=None):
    return stream_files(t.spark, t.folder, SCHEMAS["events"], pattern="events.parquet", max_files=max_files)


def sentinels(t):
    """Stream of one view and one purchase a day after the last event."""
    path = scratch_path(t.spark, "sentinels")
    later = t.events.agg((F.max("ts") + F.expr("INTERVAL 1 DAY")).alias("ts"))
    kinds = F.explode(F.array(F.lit("view"), F.lit("purchase")))
    later.select(
        F.lit(-1).cast("bigint").alias("event_id"), "ts", F.lit(SENTINEL_USER).cast("bigint").alias("user_id"),
        kinds.alias("event_type"), F.lit(0.0).alias("value"), F.lit("{}").alias("props"),
    ).write.parquet(path)
    return stream_files(t.spark, path, SCHEMAS["events"])


def closing_stream(t):
    return event_stream(t).union(sentinels(t))


def sink(t, label):
    return scratch_path(t.spark, label), scratch_path(t.spark, f"{label}-checkpoint")


def run_append(t, df, label):
    path, checkpoint = sink(t, label)
    st.append_files(df, path, checkpoint)
    return t.spark.read.schema(df.schema).parquet(path)


def views_and_buys(df):
    views = df.filter(F.col("event_type") == "view").select(
        F.col("event_id").alias("order_id"), "user_id", F.col("value").alias("total_amount"), F.col("ts").alias("order_event_time")
    )
    buys = df.filter(F.col("event_type").isin("purchase", "click")).select(
        F.col("event_id").alias("status_id"), F.col("user_id").alias("status_user"), F.col("event_type").alias("current_status"),
        F.col("ts").alias("status_event_time"),
    )
    return views, buys


def streamed_deliveries(t, how="left", orders=None, updates=None):
    """Stream join of views and their status updates, enriched, written and read back.

    Where an inner join is asked for rows that satisfy conditions on one side only (``orders``, ``updates``), these keep the others out of its state.
    """
    views, buys = views_and_buys(closing_stream(t))
    views, buys = views if orders is None else views.filter(orders), buys if updates is None else buys.filter(updates)
    joined = st.stream_interval_join(
        views, buys, ("user_id", "status_user"), ("order_event_time", "status_event_time"), 7200, "10 minutes", how
    ).drop("status_user")
    rows = run_append(t, enrich_delivery(joined, delivered="purchase"), "deliveries")
    return rows.filter(F.col("user_id") != SENTINEL_USER)


@query("s11_file_stream", "SELECT event_id, ts, user_id, event_type, value, props, true AS stamped FROM events")
def s11(t):
    bronze = add_lineage(event_stream(t, max_files=1))
    rows = run_append(t, bronze, "bronze")
    return rows.select(
        "event_id", "ts", "user_id", "event_type", "value", "props", F.col("source_file").endswith("events.parquet").alias("stamped")
    )


@query("s12_stream_extraction", "SELECT event_id, CAST(json_extract(props, '$.k') AS INT) AS k FROM events")
def s12(t):
    return run_append(t, event_stream(t).select("event_id", F.from_json("props", "k INT")["k"].alias("k")), "extracted")


@query("k17_stream_sink", "SELECT event_id, event_type FROM events")
def k17(t):
    return run_append(t, event_stream(t).select("event_id", "event_type"), "appended")


@query("j21_stream_left", f"""
SELECT order_id, user_id, status_id FROM ({VIEWS}) v LEFT JOIN (SELECT event_id AS status_id, user_id AS status_user, ts AS status_time
  FROM events WHERE event_type IN ('purchase', 'click')) b
ON user_id = status_user AND status_time >= order_time AND status_time <= order_time + INTERVAL 2 HOURS""")
def j21(t):
    return streamed_deliveries(t).select("order_id", "user_id", "status_id")


@query("j23_stream_inner", f"""
SELECT order_id, user_id, status_id FROM ({VIEWS}) v JOIN ({BUYS}) b
ON user_id = status_user AND status_time >= order_time AND status_time <= order_time + INTERVAL 2 HOURS""")
def j23(t):
    views, buys = views_and_buys(event_stream(t))
    joined = st.stream_interval_join(
        views, buys.filter(F.col("current_status") == "purchase"), ("user_id", "status_user"),
        ("order_event_time", "status_event_time"), 7200, parts=4,
    )
    return run_append(t, joined.select("order_id", "user_id", "status_id"), "inner")


@query("x01_watermark", "SELECT event_type, date_trunc('day', ts) AS day, count(*) AS n FROM events GROUP BY 1, 2")
def x01(t):
    rows = closing_stream(t).withWatermark("ts", "10 minutes")
    counted = st.windowed(rows, "ts", "1 day", {"n": F.count(F.lit(1))}, ["event_type"])
    return run_append(t, counted, "daily").select("event_type", F.col("window_start").alias("day"), "n").filter(
        F.col("day") <= t.events.agg(F.max("ts")).scalar()
    )


@query("x02_late_rows", """
SELECT date_trunc('day', ts) AS window_start, date_trunc('day', ts) + INTERVAL 1 DAY AS window_end, count(*) AS n FROM events
WHERE ts >= TIMESTAMP '2024-01-16' GROUP BY 1, 2 HAVING date_trunc('day', ts) + INTERVAL 1 DAY <= (SELECT max(ts) - INTERVAL 10 MINUTES FROM events)""")
def x02(t):
    """The events arrive in two files, the older half last: its closed windows take no more rows."""
    path, result = scratch_path(t.spark, "two-files"), scratch_path(t.spark, "late")
    checkpoint = scratch_path(t.spark, "late-checkpoint")
    turn = F.lit("2024-01-16").cast("timestamp")
    count = lambda: st.windowed(
        stream_files(t.spark, path, SCHEMAS["events"]).withWatermark("ts", "10 minutes"), "ts", "1 day", {"n": F.count(F.lit(1))}
    )
    for rows in (t.events.filter(F.col("ts") >= turn), t.events.filter(F.col("ts") < turn)):
        rows.write.mode("append").parquet(path)
        st.append_files(count(), result, checkpoint)
    return t.spark.read.parquet(result)


MEASURES_SQL = f"""count(*) AS order_count, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total_revenue,
  {r.mean_sql(r.cash('value'))} AS avg_order_value, min(value) AS min_value, max(value) AS max_value"""


def measures():
    return {
        "order_count": F.count(F.lit(1)), "total_revenue": c.total("value"), "avg_order_value": c.mean("value"),
        "min_value": F.min("value"), "max_value": F.max("value"),
    }


def streamed_windows(t, length, keys=(), slide=None):
    rows = closing_stream(t).withWatermark("ts", "10 minutes")
    out = run_append(t, st.windowed(rows, "ts", length, measures(), keys, slide), "windows")
    return out.filter(F.col("window_start") <= t.events.agg(F.max("ts")).scalar())


@query("x03_tumbling_by_key", f"""
SELECT user_id, time_bucket(INTERVAL '10 minutes', ts) AS window_start, time_bucket(INTERVAL '10 minutes', ts) + INTERVAL 10 MINUTES AS window_end, {MEASURES_SQL}
FROM events GROUP BY ALL""")
def x03(t):
    return streamed_windows(t, "10 minutes", ["user_id"])


@query("x04_tumbling_global", f"""
SELECT time_bucket(INTERVAL '10 minutes', ts) AS window_start, time_bucket(INTERVAL '10 minutes', ts) + INTERVAL 10 MINUTES AS window_end, {MEASURES_SQL}
FROM events GROUP BY ALL""")
def x04(t):
    return streamed_windows(t, "10 minutes")


@query("x05_sliding", f"""
SELECT event_type, s AS window_start, s + INTERVAL 1 HOUR AS window_end, {MEASURES_SQL}
FROM (SELECT *, unnest([time_bucket(INTERVAL '30 minutes', ts), time_bucket(INTERVAL '30 minutes', ts) - INTERVAL 30 MINUTES]) AS s FROM events)
GROUP BY event_type, s""")
def x05(t):
    return streamed_windows(t, "1 hour", ["event_type"], "30 minutes")


@query("x06_running_by_key", f"SELECT user_id, {MEASURES_SQL} FROM events GROUP BY user_id")
def x06(t):
    path, checkpoint = sink(t, "running")
    totals = event_stream(t).groupBy("user_id").agg(*[m.alias(n) for n, m in measures().items()])
    st.update_files(totals, path, checkpoint, ["user_id"], settle_every=1)
    return st.latest_groups(t.spark, path, ["user_id"])


@query("x07_stateless_filter", "SELECT event_id, upper(trim(event_type)) AS kind, value FROM events WHERE event_type != 'error' AND value BETWEEN 1 AND 100")
def x07(t):
    rows = event_stream(t).filter((F.col("event_type") != "error") & F.col("value").between(1, 100))
    return run_append(t, rows.select("event_id", F.upper(F.trim("event_type")).alias("kind"), "value"), "filtered")


ENRICH_SQL = r.with_ctes(ENRICHED_SQL) + """, enriched AS (SELECT *, coalesce(delivery_time_minutes > 15, false) AS is_delayed,
  current_status = 'purchase' AS is_delivered FROM deliveries)
"""


@query("x08_enrichment", ENRICH_SQL + """
SELECT order_id, status_id, delivery_time_minutes, is_delayed, is_delivered,
  CASE WHEN is_delayed THEN 'CRITICAL' WHEN is_delivered THEN 'INFO' ELSE 'NORMAL' END AS event_severity FROM enriched""")
def x08(t):
    return deliveries(t).select("order_id", "status_id", "delivery_time_minutes", "is_delayed", "is_delivered", "event_severity")


@query("x09_staged_messages", """
SELECT CAST(event_id AS VARCHAR) AS key, '{"event_id":' || event_id || ',"event_type":"' || event_type || '"}' AS value
FROM events WHERE event_type = 'purchase' AND value > 10""")
def x09(t):
    alerts = event_stream(t).filter((F.col("event_type") == "purchase") & (F.col("value") > 10))
    staged, checkpoint = sink(t, "staged-messages")
    st.append_files(to_messages(alerts, "event_id", ["event_id", "event_type"]), staged, checkpoint)
    return run_append(t, stream_files(t.spark, staged, "key STRING, value STRING"), "published")


@query("x10_restart", "SELECT event_id, event_type FROM events")
def x10(t):
    """Two runs with one checkpoint, a new file between them: every row arrives once."""
    source, (path, checkpoint) = scratch_path(t.spark, "arriving"), sink(t, "restart")
    turn = F.lit("2024-01-16").cast("timestamp")
    for rows in (t.events.filter(F.col("ts") < turn), t.events.filter(F.col("ts") >= turn)):
        rows.write.mode("append").parquet(source)
        st.append_files(stream_files(t.spark, source, SCHEMAS["events"]).select("event_id", "event_type"), path, checkpoint)
    return t.spark.read.parquet(path)


@query("x12_bucket_percentages", r.with_ctes(ENRICHED_SQL) + f""",
b AS (SELECT CASE WHEN delivery_time_minutes < 15 THEN 'Very Fast (<15min)' WHEN delivery_time_minutes < 30 THEN 'Fast (15-30min)'
  WHEN delivery_time_minutes < 45 THEN 'Normal (30-45min)' ELSE 'Slow (>45min)' END AS time_bucket, count(*) AS order_count
  FROM deliveries WHERE delivery_time_minutes IS NOT NULL GROUP BY 1)
SELECT time_bucket, order_count, {r.pct_sql('order_count', '(SELECT sum(order_count) FROM b)')} AS percentage FROM b""")
def x12(t):
    rows = streamed_deliveries(t, "inner")
    return share_of_total(rows.groupBy(time_bucket().alias("time_bucket")).agg(F.count(F.lit(1)).alias("order_count")), "order_count")


@query("c01_scd1_stream", """
SELECT user_id, seq, event_type, value FROM (SELECT user_id, event_id AS seq, event_type, value,
  row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM events) WHERE rn = 1 AND event_type != 'error'""")
def c01_stream(t):
    source, (path, checkpoint) = scratch_path(t.spark, "changes"), sink(t, "state")
    # Newer changes come first, so the second batch holds only late ones.
    middle = t.events.agg(F.max("event_id") / 2).scalar()
    ddl = "user_id BIGINT, seq BIGINT, event_type STRING, value DOUBLE"
    for rows in (feed(t).filter(F.col("seq") > middle), feed(t).filter(F.col("seq") <= middle)):
        rows.write.mode("append").parquet(source)
        changes = stream_files(t.spark, source, ddl)
        st.merge_state(changes, path, checkpoint, ["user_id"], "seq", F.col("event_type") == "error", settle_every=2)
    return st.current_state(t.spark, path, ["user_id"], "seq")


@query("c02_scd2_stream", r.with_ctes(SCD2_SQL) + "SELECT * FROM h")
def c02_stream(t):
    """Versions kept by a stream in three batches, the oldest changes last: closed versions open again and are split."""
    source, (path, checkpoint) = scratch_path(t.spark, "changes"), sink(t, "versions")
    third = t.events.agg(F.max("event_id") / 3).scalar()
    seq, ddl = F.col("seq"), "user_id BIGINT, seq BIGINT, event_type STRING, value DOUBLE"
    for part in ((seq > third) & (seq <= 2 * third), seq > 2 * third, seq <= third):
        feed(t).filter(part).write.mode("append").parquet(source)
        changes = stream_files(t.spark, source, ddl)
        keep_versions(changes, path, checkpoint, ["user_id"], "seq", ["event_type"], F.expr(DELETES), start="start_at", end="end_at", settle_every=2)
    return versions(t.spark, path, ["user_id"], "start_at")


GOLD_SQL = f"""count(*) AS order_count, CAST(sum(CAST(total_amount AS DECIMAL(18,2))) AS DOUBLE) AS total_revenue,
  {r.mean_sql(r.cash('total_amount'))} AS avg_order_value, {r.n_if('is_delayed')} AS delayed_orders, {r.n_if('is_delivered')} AS completed_orders,
  {r.n_if('NOT is_delivered')} AS pending_orders, round(min(delivery_time_minutes), 2) AS min_delivery_time, round(max(delivery_time_minutes), 2) AS max_delivery_time,
  {r.rounded('CAST(sum(60 * delivery_time_minutes) AS BIGINT)', '(60 * count(delivery_time_minutes))')} AS avg_delivery_time,
  {r.pct_sql('(count(*) - sum(CASE WHEN is_delayed THEN 1 ELSE 0 END))', 'count(*)')} AS on_time_rate_pct,
  {r.pct_sql('sum(CASE WHEN is_delivered THEN 1 ELSE 0 END)', 'count(*)')} AS completion_rate_pct"""


def gold(df, keys):
    return df.groupBy(*keys).agg(*[m.alias(n) for n, m in delivery_measures().items()])


@query("e03_restaurant_performance", ENRICH_SQL + f"""
SELECT user_id, time_bucket(INTERVAL '10 minutes', order_event_time) AS window_start, time_bucket(INTERVAL '10 minutes', order_event_time) + INTERVAL 10 MINUTES AS window_end,
  {GOLD_SQL} FROM enriched GROUP BY 1, 2, 3""")
def e03_restaurants(t):
    return st.windowed(deliveries(t), "order_event_time", "10 minutes", delivery_measures(), ["user_id"])


@query("e03_system_health", ENRICH_SQL + f"""
SELECT time_bucket(INTERVAL '10 minutes', order_event_time) AS window_start, time_bucket(INTERVAL '10 minutes', order_event_time) + INTERVAL 10 MINUTES AS window_end,
  count(DISTINCT user_id) > 0 AS has_users, {GOLD_SQL} FROM enriched GROUP BY 1, 2""")
def e03_health(t):
    measured = {**delivery_measures(), "users": F.approx_count_distinct("user_id", 0.02)}
    rows = st.windowed(deliveries(t), "order_event_time", "10 minutes", measured)
    return rows.withColumn("has_users", F.col("users") > 0).drop("users")


@query("e03_driver_performance", ENRICH_SQL + f"SELECT user_id, {GOLD_SQL} FROM enriched GROUP BY user_id")
def e03_drivers(t):
    return gold(streamed_deliveries(t), ["user_id"])


@query("e03_time_distribution", ENRICH_SQL + f"""
SELECT CASE WHEN delivery_time_minutes < 15 THEN 'Very Fast (<15min)' WHEN delivery_time_minutes < 30 THEN 'Fast (15-30min)'
  WHEN delivery_time_minutes < 45 THEN 'Normal (30-45min)' ELSE 'Slow (>45min)' END AS time_bucket, {GOLD_SQL}
FROM enriched WHERE delivery_time_minutes IS NOT NULL GROUP BY 1""")
def e03_distribution(t):
    return gold(deliveries(t).filter(F.col("delivery_time_minutes").isNotNull()).withColumn("time_bucket", time_bucket()), ["time_bucket"])


@query("e03_alert_messages", ENRICH_SQL + """
SELECT CAST(order_id AS VARCHAR) AS key, '{"order_id":' || order_id || ',"alert_type":"DELIVERY_DELAY","current_status":"' || current_status
  || '","message":"Order ' || order_id || ' is delayed (' || round(delivery_time_minutes, 2) || ' minutes). Driver: ' || user_id || '"}' AS value
FROM enriched WHERE delivery_time_minutes > 45 AND NOT is_delivered AND total_amount >= 20 AND delivery_time_minutes < 180 AND current_status = 'click'""")
def e03_alerts(t):
    least, statuses = 20, ["click"]
    rows = streamed_deliveries(t, "inner", F.col("total_amount") >= least, F.col("current_status").isin(*statuses))
    alerts = actionable_alerts(rows, 45, least, 180, statuses)
    return to_messages(alerts, "order_id", ["order_id", F.lit("DELIVERY_DELAY").alias("alert_type"), "current_status",
                                          delay_message(driver="user_id").alias("message")])


# ---------------------------------------------------------------- E3 the whole real-time job

STAMP = "yyyy-MM-dd HH:mm:ss.SSSSSS"
JOBS: dict[tuple[str, str], dict[str, str]] = {}  # by application and folder: the job's tables are read by several queries


def delivery_files(events):
    """Views as order messages, purchases and clicks as status messages; a user's number is the order's."""
    stamp, number = F.date_format("ts", STAMP), F.col("user_id").cast("string")
    orders = events.filter(F.col("event_type") == "view").select(
        number.alias("order_id"), number.alias("user_key"), F.concat(F.lit("r"), F.col("user_id") % 10).alias("restaurant_key"),
        F.concat(F.lit("d"), F.col("event_id") % 7).alias("driver_key"), stamp.alias("order_date"), F.col("value").alias("total_amount"), stamp.alias("dt_current_timestamp"),
    )
    name = F.when(F.col("event_type") == "purchase", "Delivered").otherwise("In Transit").alias("status_name")
    status = events.filter(F.col("event_type").isin("purchase", "click")).select(
        F.col("event_id").alias("status_id"), number.alias("order_identifier"),
        F.struct(name, (F.unix_micros("ts") / 1000).alias("timestamp")).alias("status"), stamp.alias("dt_current_timestamp"),
    )
    return orders, status


def realtime_job(t):
    """The tables of the job after three runs, with files added between them.

    The first two bring the halves of the events; the second and the third also an order without status each, days after the last event, whose
    times let the joins and the windows before them close.
    """
    mark = (t.spark.sparkContext.applicationId, t.folder)
    if mark not in JOBS:
        orders, status, base = (scratch_path(t.spark, n) for n in ("order-files", "status-files", "realtime"))
        turn = F.lit("2024-01-16").cast("timestamp")
        last = t.events.agg(F.max("ts").alias("ts"))

        def closing(days):
            kinds = F.explode(F.array(*[F.struct(F.lit(k).alias("event_type"), F.lit(-u * days).alias("user_id")) for k, u in (("view", 1), ("click", 10))]))
            rows = last.select((F.col("ts") + F.make_interval(days=F.lit(days))).alias("ts"), kinds.alias("k"))
            return rows.select(F.lit(-1).cast("bigint").alias("event_id"), "ts", F.col("k.user_id").cast("bigint").alias("user_id"), "k.event_type", F.lit(1.0).alias("value"), F.lit("{}").alias("props"))

        older, newer = (t.events.filter(c) for c in (F.col("ts") < turn, F.col("ts") >= turn))
        for rows in (older, newer.unionByName(closing(1)), closing(4)):
            for part, folder in zip(delivery_files(rows), (orders, status)):
                part.write.mode("append").json(folder)
            JOBS[mark] = realtime.run(t.spark, orders, status, base, settle_every=2)
    return JOBS[mark]


JOB_SQL = r.with_ctes(ENRICHED_SQL) + """, sold AS (SELECT *, 'r' || (user_id % 10) AS restaurant_key, 'd' || (order_id % 7) AS driver_key,
  coalesce(delivery_time_minutes > 15, false) AS is_delayed, current_status = 'purchase' AS is_delivered
  FROM deliveries WHERE CAST(total_amount AS DECIMAL(10,2)) > 0)
"""
JOB_WINDOW = "time_bucket(INTERVAL '10 minutes', order_event_time) AS window_start"


def close_to_exact(t, gold, keys, names):
    """Flags that the estimates of distinct counts lie within 8 % (five times the sketch's deviation) of the exact ones, or one off."""
    rows = t.spark.read.parquet(realtime_job(t)["order_status"]).withColumn("window_start", F.window("order_event_time", "10 minutes")["start"])
    exact = distinct_counts(rows, ["window_start", *keys], {f"exact_{n}": column for n, column in names.items()})
    near = [(F.abs(F.col(n) - F.col(f"exact_{n}")) <= F.greatest(0.08 * F.col(f"exact_{n}"), F.lit(1))).alias(f"{n}_close") for n in names]
    return gold.join(exact, ["window_start", *keys]).select(*keys, "window_start", *delivery_measures(), *near)


def of_the_events(t, gold):
    return gold.filter(F.col("window_start") <= t.events.agg(F.max("ts")).scalar())


@query("e03_job_restaurant_performance", JOB_SQL + f"""
SELECT restaurant_key, {JOB_WINDOW}, {GOLD_SQL}, true AS unique_customers_close, true AS unique_drivers_close FROM sold GROUP BY 1, 2""")
def e03_job_restaurants(t):
    gold = of_the_events(t, t.spark.read.parquet(realtime_job(t)["restaurant_performance"]))
    return close_to_exact(t, gold, ["restaurant_key"], {"unique_customers": "customer_key", "unique_drivers": "driver_key"})


@query("e03_job_system_health", JOB_SQL + f"""
SELECT {JOB_WINDOW}, {GOLD_SQL}, true AS active_restaurants_close, true AS active_drivers_close, true AS active_customers_close FROM sold GROUP BY 1""")
def e03_job_health(t):
    gold = of_the_events(t, t.spark.read.parquet(realtime_job(t)["system_health"]))
    return close_to_exact(t, gold, [], {"active_restaurants": "restaurant_key", "active_drivers": "driver_key", "active_customers": "customer_key"})


@query("e03_job_daily_customers", JOB_SQL + """
SELECT date_trunc('day', order_event_time) AS window_start, count(*) AS order_count, count(DISTINCT user_id) AS customers, true AS close FROM sold GROUP BY 1""")
def e03_job_daily(t):
    """Distinct customers per day from the windows' sketches; the orders are not read again for them."""
    days = realtime.rolled_gold(of_the_events(t, t.spark.read.parquet(realtime_job(t)["system_health"])), "day", ["active_customers"])
    rows = t.spark.read.parquet(realtime_job(t)["order_status"]).withColumn("window_start", F.date_trunc("day", "order_event_time"))
    exact = distinct_counts(rows, ["window_start"], {"customers": "customer_key"})
    near = F.abs(F.col("active_customers") - F.col("customers")) <= F.greatest(0.08 * F.col("customers"), F.lit(1))
    return days.join(exact, "window_start").select("window_start", "order_count", "customers", near.alias("close"))


@query("e03_job_driver_performance", JOB_SQL + f"""
SELECT driver_key, {GOLD_SQL}, count(DISTINCT restaurant_key) > 0 AS served FROM sold GROUP BY 1""")
def e03_job_drivers(t):
    gold = st.latest_groups(t.spark, realtime_job(t)["driver_performance"], ["driver_key"]).filter(F.col("driver_key") != "d-1")
    return gold.select("driver_key", *delivery_measures(), (F.col("restaurants_served") > 0).alias("served"))


@query("e03_job_time_distribution", JOB_SQL + f"""
SELECT CASE WHEN delivery_time_minutes < 15 THEN 'Very Fast (<15min)' WHEN delivery_time_minutes < 30 THEN 'Fast (15-30min)'
  WHEN delivery_time_minutes < 45 THEN 'Normal (30-45min)' ELSE 'Slow (>45min)' END AS time_bucket, {GOLD_SQL}
FROM sold WHERE delivery_time_minutes IS NOT NULL GROUP BY 1""")
def e03_job_distribution(t):
    return st.latest_groups(t.spark, realtime_job(t)["time_distribution"], ["time_bucket"])


@query("e03_job_published_alerts", JOB_SQL + """
SELECT CAST(user_id AS VARCHAR) AS key, 'DELIVERY_DELAY' AS alert_type, driver_key,
  'Order ' || user_id || ' is delayed (' || round(delivery_time_minutes, 2) || ' minutes). Driver: ' || driver_key AS message, count(*) AS n
FROM sold WHERE delivery_time_minutes > 45 AND NOT is_delivered AND total_amount >= 20 AND delivery_time_minutes < 180 AND current_status = 'click' GROUP BY ALL""")
def e03_job_alerts(t):
    sent = t.spark.read.parquet(realtime_job(t)["alerts_published"])
    value = F.from_json("value", "alert_type STRING, driver_key STRING, message STRING")
    return sent.select("key", value.alias("v")).groupBy("key", "v.alert_type", "v.driver_key", "v.message").agg(F.count(F.lit(1)).alias("n"))
