"""Delivery transforms. The same functions take a batch table or a stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tiffin.functions.columns import count_where, minutes_between, percent, ratio
from tiffin.operators.quality import WARN, Rule

# Buckets of the delivery-time report. The last label also covers exactly 45 minutes.
TIME_BUCKETS = [(15, "Very Fast (<15min)"), (30, "Fast (15-30min)"), (45, "Normal (30-45min)")]
SLOWEST = "Slow (>45min)"


def enrich_delivery(
    joined: DataFrame,
    delivered: str = "Delivered",
    threshold: float = 15,
    order_time: str = "order_event_time",
    status_time: str = "status_event_time",
    status: str = "current_status",
) -> DataFrame:
    """Minutes to the status, delay and delivery flags, severity.

    ``is_delivered`` stays NULL where no status matched; filters on true or false both skip such a row.
    """
    minutes = F.when(F.col(status_time).isNotNull(), minutes_between(status_time, order_time))
    return (
        joined.withColumn("delivery_time_minutes", minutes)
        .withColumn("is_delayed", F.coalesce(F.col("delivery_time_minutes") > threshold, F.lit(False)))
        .withColumn("is_delivered", F.col(status) == delivered)
        .withColumn(
            "event_severity",
            F.when(F.col("is_delayed"), "CRITICAL").when(F.col("is_delivered"), "INFO").otherwise("NORMAL"),
        )
    )


def actionable_alerts(
    enriched: DataFrame,
    critical: float = 45,
    least_value: float = 20,
    longest: float = 180,
    statuses: Sequence[str] = ("Preparing", "Out for Delivery", "In Transit"),
    amount: str = "total_amount",
) -> DataFrame:
    """Late, undelivered, valuable, plausible and still reachable orders."""
    return (
        enriched.filter(F.col("delivery_time_minutes") > critical)
        .filter(~F.col("is_delivered"))
        .filter(F.col(amount) >= least_value)
        .filter(F.col("delivery_time_minutes") < longest)
        .filter(F.col("current_status").isin(*statuses))
    )


def to_messages(df: DataFrame, key: str, fields: Sequence[Column | str]) -> DataFrame:
    """Two text columns, ``key`` and a JSON ``value``, ready for any message sink."""
    return df.select(F.col(key).cast("string").alias("key"), F.to_json(F.struct(*fields)).alias("value"))


def delay_message(order: str = "order_id", driver: str = "driver_key") -> Column:
    return F.concat(
        F.lit("Order "), F.col(order).cast("string"), F.lit(" is delayed ("),
        F.round("delivery_time_minutes", 2).cast("string"), F.lit(" minutes). Driver: "), F.col(driver).cast("string"),
    )


def time_bucket(
    minutes: str = "delivery_time_minutes", edges: Sequence[tuple[float, str]] = TIME_BUCKETS, slowest: str = SLOWEST
) -> Column:
    """Label of the first edge above the minutes. Rows without minutes have to be left out before."""
    value, result = F.col(minutes), None
    for edge, label in edges:
        result = F.when(value < edge, label) if result is None else result.when(value < edge, label)
    return result.otherwise(slowest)


def commission(amount: str = "total_amount", share: str = "0.15") -> Column:
    """Exact share of the summed amount."""
    return (F.sum(F.col(amount).cast("decimal(18,2)")) * F.lit(share).cast("decimal(4,2)")).cast("double")


# Status names the delivery feed is expected to hold.
KNOWN_STATUS = ("pending", "confirmed", "preparing", "out_for_delivery", "delivered", "cancelled")


def delivery_rules(
    latest: str, earliest: str = "2020-01-01", most: float = 10_000, statuses: Sequence[str] = KNOWN_STATUS
) -> list[Rule]:
    """Row rules of the delivery table. An unusual amount or status only warns."""
    day, amount, status = F.col("order_date"), F.col("total_amount"), F.col("status_name")
    return [
        Rule("valid_order_id", F.col("order_id").isNotNull()),
        Rule("valid_order_date", day.isNotNull()),
        Rule("reasonable_order_date", day.between(F.lit(earliest).cast("timestamp"), F.lit(latest).cast("timestamp"))),
        Rule("valid_restaurant_key", F.col("restaurant_key").isNotNull()),
        Rule("valid_driver_key", F.col("driver_key").isNotNull()),
        Rule("valid_total_amount", amount.isNotNull()),
        Rule("positive_amount", amount > 0),
        Rule("reasonable_amount", amount < most, WARN),
        Rule("valid_status", status.isNotNull()),
        Rule("known_status", status.isin(*statuses), WARN),
    ]


def delivery_measures(amount: str = "total_amount", order_time: str = "order_event_time",
                      status_time: str = "status_event_time") -> dict[str, Column]:
    """Order, revenue, delay and completion measures shared by the gold tables."""
    cents = F.col(amount).cast("decimal(18,2)")
    seconds = F.abs(F.unix_seconds(status_time) - F.unix_seconds(order_time))
    orders, delayed = F.count(F.lit(1)), count_where(F.col("is_delayed"))
    return {
        "order_count": orders,
        "total_revenue": F.sum(cents).cast("double"),
        "avg_order_value": ratio(F.sum(cents), F.count(cents)),
        "avg_delivery_time": ratio(F.sum(seconds), 60 * F.count(seconds)),
        "min_delivery_time": F.round(F.min("delivery_time_minutes"), 2),
        "max_delivery_time": F.round(F.max("delivery_time_minutes"), 2),
        "delayed_orders": delayed,
        "completed_orders": count_where(F.col("is_delivered")),
        "pending_orders": count_where(~F.col("is_delivered")),
        "on_time_rate_pct": percent(orders - delayed, orders),
        "completion_rate_pct": percent(count_where(F.col("is_delivered")), orders),
    }
