"""The real-time delivery job: order and status files in, alerts and gold tables out.

Each stage is a stream with its own folder and checkpoint that runs until its input is used up. Running the job again
takes up what arrived since.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from tiffin.operators.aggs import estimates
from tiffin.operators.quality import Rule, expect
from tiffin.sources.files import add_lineage, stream_files
from tiffin.streaming.delivery import actionable_alerts, delay_message, delivery_measures, enrich_delivery, time_bucket, to_messages
from tiffin.streaming.streams import append_files, stream_interval_join, update_files, windowed

# Fixed schemas of the two feeds. The status time is an epoch in milliseconds that comes as integer or as float.
ORDERS = (
    "order_id STRING, user_key STRING, restaurant_key STRING, driver_key STRING, order_date STRING, total_amount DECIMAL(10,2), "
    "payment_key STRING, rating_key STRING, dt_current_timestamp STRING"
)
STATUS = "status_id BIGINT, order_identifier STRING, status STRUCT<status_name: STRING, timestamp: DOUBLE>, dt_current_timestamp STRING"

RULES = [
    Rule("valid_order", "order_id IS NOT NULL"),
    Rule("valid_time", "order_event_time IS NOT NULL"),
    Rule("valid_amount", "total_amount > 0"),
]
WATERMARK, MATCH_SECONDS = "10 minutes", 7200
# An order without status leaves the join two hours and the watermark later; the windows stay open for it.
GOLD_WATERMARK = "140 minutes"
SKETCH_PRECISION = 12  # estimates within about 1.6 %


def bronze_orders(feed: DataFrame) -> DataFrame:
    return add_lineage(feed)


def bronze_status(feed: DataFrame) -> DataFrame:
    """Status name and time taken out of the nested field."""
    millis = F.col("status.timestamp").cast("bigint")
    return feed.select(
        "status_id", "order_identifier", F.col("status.status_name").alias("status_name"),
        F.timestamp_seconds(F.floor(millis / 1000)).alias("status_timestamp"), "dt_current_timestamp",
        F.current_timestamp().alias("ingestion_timestamp"), F.col("_metadata.file_path").alias("source_file"),
    )


def order_status(orders: DataFrame, status: DataFrame) -> DataFrame:
    """Orders with the status updates of the two hours after them, enriched and checked."""
    placed = orders.select(
        "order_id", "order_date", "restaurant_key", "driver_key", F.col("user_key").alias("customer_key"), "total_amount",
        F.col("dt_current_timestamp").cast("timestamp").alias("order_event_time"),
    )
    updates = status.select(
        "order_identifier", F.col("status_name").alias("current_status"), F.col("status_timestamp").alias("status_update_time"),
        F.col("dt_current_timestamp").cast("timestamp").alias("status_event_time"),
    )
    joined = stream_interval_join(
        placed, updates, ("order_id", "order_identifier"), ("order_event_time", "status_event_time"), MATCH_SECONDS, WATERMARK, "left"
    ).drop("order_identifier")
    return expect(enrich_delivery(joined).withColumn("processed_timestamp", F.current_timestamp()), RULES)


def alert_messages(delayed: DataFrame) -> DataFrame:
    fields = [
        F.expr("uuid()").alias("alert_id"), "order_id", F.lit("DELIVERY_DELAY").alias("alert_type"), F.lit("HIGH").alias("severity"),
        "restaurant_key", "driver_key", "customer_key", "delivery_time_minutes", "current_status",
        delay_message().alias("message"), F.col("processed_timestamp").alias("alert_timestamp"),
    ]
    return to_messages(delayed, "order_id", fields)


def distinct_measures(**columns: str) -> dict:
    """Distinct counts as mergeable sketches, which are the stream's state, and the estimates from them.

    A stream has no exact distinct counts. The sketches are kept in the tables, so that windows add up to hours and days (``rolled_gold``).
    """
    sketches = {f"{name}_sketch": F.hll_sketch_agg(column, SKETCH_PRECISION) for name, column in columns.items()}
    return {**{name: F.hll_sketch_estimate(sketches[f"{name}_sketch"]) for name in columns}, **sketches}


def rolled_gold(gold: DataFrame, length: str, names: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Orders and distinct counts per coarser window (a unit as of ``date_trunc``) and key, from the stored windows alone."""
    start = F.date_trunc(length, "window_start").alias("window_start")
    united = gold.groupBy(*keys, start).agg(F.sum("order_count").alias("order_count"), *[F.hll_union_agg(f"{n}_sketch").alias(n) for n in names])
    return estimates(united, names)


def run(spark: SparkSession, orders: str, status: str, base: str, settle_every: int | None = 10) -> dict[str, str]:
    """Run all stages once over what is there; returns the folder of each table."""
    paths = {
        name: f"{base}/{name}" for name in (
            "bronze_orders", "bronze_status", "order_status", "delayed_orders", "alerts_staged", "alerts_published",
            "restaurant_performance", "system_health", "driver_performance", "time_distribution",
        )
    }
    marks = {name: f"{base}/checkpoints/{name}" for name in paths}

    def append(name: str, df: DataFrame) -> None:
        append_files(df, paths[name], marks[name])
        schemas[name] = df.schema

    def stage(name: str) -> DataFrame:
        return stream_files(spark, paths[name], schemas[name])

    schemas: dict = {}
    append("bronze_orders", bronze_orders(stream_files(spark, orders, ORDERS, "json")))
    append("bronze_status", bronze_status(stream_files(spark, status, STATUS, "json")))
    append("order_status", order_status(stage("bronze_orders"), stage("bronze_status")))
    append("delayed_orders", actionable_alerts(stage("order_status")))
    append("alerts_staged", alert_messages(stage("delayed_orders")))
    append("alerts_published", stage("alerts_staged"))

    timed = stage("order_status").withWatermark("order_event_time", GOLD_WATERMARK)
    measures = delivery_measures()
    append("restaurant_performance", windowed(
        timed, "order_event_time", "10 minutes",
        {**measures, **distinct_measures(unique_customers="customer_key", unique_drivers="driver_key")}, ["restaurant_key"],
    ))
    append("system_health", windowed(
        timed, "order_event_time", "10 minutes",
        {**measures, **distinct_measures(active_restaurants="restaurant_key", active_drivers="driver_key", active_customers="customer_key")},
    ))
    named = [m.alias(n) for n, m in measures.items()]
    served = distinct_measures(restaurants_served="restaurant_key", customers_served="customer_key")
    drivers = stage("order_status").groupBy("driver_key").agg(*named, *[m.alias(n) for n, m in served.items()])
    update_files(drivers, paths["driver_performance"], marks["driver_performance"], ["driver_key"], settle_every)
    known = stage("order_status").filter(F.col("delivery_time_minutes").isNotNull()).withColumn("time_bucket", time_bucket())
    update_files(known.groupBy("time_bucket").agg(*named), paths["time_distribution"], marks["time_distribution"], ["time_bucket"], settle_every)
    return paths
