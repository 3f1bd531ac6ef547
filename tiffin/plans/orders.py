"""Order reports: ETL, sales by dimension, ratings, time series, KPIs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tiffin.functions.columns import above_tier, delivery_eta, delivery_fee, mean, money, ratio, tier, total
from tiffin.operators.aggs import share_of_total
from tiffin.operators.windows import framed, rolling_mean
from tiffin.sources.sinks import write_table

# Limits of the order categories.
VALUE_LIMITS = [(50, "High"), (25, "Medium")]


def enrich_orders(orders: DataFrame, amount: str, distance: str, limits: Sequence[tuple[float, str]] = VALUE_LIMITS) -> DataFrame:
    """Value category, delivery fee and estimated minutes."""
    return (
        orders.withColumn("order_value_category", above_tier(amount, limits, "Low"))
        .withColumn("delivery_fee", delivery_fee(amount).cast("double"))
        .withColumn("estimated_delivery_minutes", delivery_eta(distance))
    )


def customer_segment(
    amount: str, items: str, premium: float = 75, high: float = 40, many: int = 4, regular: float = 25
) -> Column:
    value = F.col(amount)
    return (
        F.when(value > premium, "Premium")
        .when((value > high) & (F.col(items) >= many), "High Value")
        .when(value > regular, "Regular")
        .otherwise("Basic")
    )


def orders_etl(orders: DataFrame, amount: str, distance: str, day: str, path: str, limits=VALUE_LIMITS) -> str:
    """One pass from the source to a dataset partitioned by day."""
    return write_table(enrich_orders(orders, amount, distance, limits), path, partition_by=[day])


def sales_report(sales: DataFrame, restaurants: DataFrame, drivers: DataFrame) -> dict[str, DataFrame]:
    """Sales by cuisine, driver, restaurant and rating.

    The facts are summed per restaurant and per driver first; the joins then see one row per key, whatever its size.
    """
    per_restaurant = sales.groupBy("restaurant_id").agg(F.count(F.lit(1)).alias("_n"), F.sum(money("amount")).alias("_sum"))
    joined = per_restaurant.join(restaurants, "restaurant_id")
    per_driver = (
        sales.join(restaurants.select("restaurant_id"), "restaurant_id", "left_semi")
        .groupBy("driver_id").agg(F.count(F.lit(1)).alias("_n"), F.sum(money("amount")).alias("_sum"))
    )

    def measures(df: DataFrame, *extra: Column) -> DataFrame:
        return df.agg(
            F.sum("_n").alias("order_count"), ratio(F.sum("_sum"), F.sum("_n")).alias("avg_order_value"),
            F.sum("_sum").cast("double").alias("total_revenue"), *extra,
        )

    return {
        "cuisine": measures(joined.groupBy("cuisine"), F.count("restaurant_id").alias("restaurant_count")),
        "driver": measures(per_driver.join(drivers, "driver_id").groupBy("driver_name", "vehicle")),
        "restaurant": measures(joined.groupBy("name", "cuisine", "city")),
        "rating": measures(joined.groupBy("name", "rating")).drop("avg_order_value"),
    }


def ratings_report(ratings: DataFrame, restaurant: str, rating: str, time: str, high: float, medium: float) -> dict[str, DataFrame]:
    """Ratings with category, weekday and hour, their distribution, and per-restaurant figures."""
    labelled = ratings.withColumns({
        "rating_category": tier(rating, [(high, "High"), (medium, "Medium")], "Low"),
        "day_of_week": F.date_format(time, "EEEE"),
        "hour_of_day": F.hour(time),
    })
    return {
        "labelled": labelled,
        "by_time": labelled.groupBy("rating_category", "day_of_week", "hour_of_day").agg(F.count(F.lit(1)).alias("ratings")),
        "distribution": ratings.groupBy(rating).agg(F.count(F.lit(1)).alias("ratings")),
        "restaurant": ratings.groupBy(restaurant).agg(
            mean(rating).alias("avg_rating"), F.min(rating).alias("min_rating"), F.max(rating).alias("max_rating")
        ),
    }


def kpis(deliveries: DataFrame, time: str, status: str, amount: str) -> DataFrame:
    """Orders, revenue and average ticket per day and status."""
    return deliveries.groupBy(F.to_date(time).alias("date"), status).agg(
        F.count(F.lit(1)).alias("total_orders"), total(amount).alias("revenue"), mean(amount).alias("avg_ticket")
    )


def time_report(orders: DataFrame, time: str, amount: str) -> dict[str, DataFrame]:
    """Orders per month, hour and weekday."""
    money_measures = [F.count(F.lit(1)).alias("order_count"), mean(amount).alias("avg_order_amount")]
    hourly = orders.groupBy(F.hour(time).alias("hour")).agg(*money_measures)
    return {
        "monthly": orders.groupBy(F.year(time).alias("year"), F.month(time).alias("month")).agg(
            *money_measures, total(amount).alias("total_revenue"), F.min(amount).alias("min_order_amount"), F.max(amount).alias("max_order_amount")
        ),
        "hourly": share_of_total(hourly, "order_count"),
        "weekly": orders.groupBy(F.dayofweek(time).alias("day_of_week"), F.date_format(time, "EEEE").alias("day_name")).agg(*money_measures),
    }


def daily_rolling(orders: DataFrame, time: str, amount: str, days: int = 7, min_periods: int = 1) -> DataFrame:
    """Revenue per day with the mean of the last ``days`` days that have orders."""
    daily = orders.groupBy(F.to_date(time).alias("order_day")).agg(
        F.count(F.lit(1)).alias("order_count"), F.sum(money(amount)).alias("_sum")
    )
    rolled = framed(
        daily, [], [F.col("order_day")], lambda w: {"rolling_avg": rolling_mean(F.col("_sum"), w, days, min_periods)}, before=days - 1
    )
    return rolled.select("order_day", "order_count", F.col("_sum").cast("double").alias("revenue"), "rolling_avg")
