"""Layered jobs that write one dataset per layer and read the next from it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tiffin.functions.columns import mean, money, ratio, strip_phone, tier
from tiffin.operators.joins import city_match
from tiffin.operators.quality import validate_rows, validate_schema
from tiffin.plans.restaurants import restaurant_sales
from tiffin.sources.files import read_table
from tiffin.sources.jdbc import write_jdbc
from tiffin.sources.sinks import write_table


def build_bronze(restaurants: DataFrame, drivers: DataFrame, sales: DataFrame, base: str) -> None:
    """Cleaned raw data; sales by year and month. The time stamp is kept beside its parts."""
    dated = sales.filter(F.col("amount").isNotNull()).withColumns({"year": F.year("order_date"), "month": F.month("order_date")})
    write_table(restaurants.filter(F.col("rating").isNotNull()), f"{base}/bronze/restaurants")
    write_table(drivers, f"{base}/bronze/drivers")
    write_table(dated, f"{base}/bronze/sales", partition_by=["year", "month"])


def build_silver(spark: SparkSession, base: str, tiers) -> None:
    restaurants = read_table(spark, f"{base}/bronze/restaurants")
    sales = read_table(spark, f"{base}/bronze/sales")
    write_table(restaurants.withColumn("rating_category", tier("rating", tiers, "Below Average")), f"{base}/silver/restaurants")
    write_table(read_table(spark, f"{base}/bronze/drivers"), f"{base}/silver/drivers")
    labelled = sales.withColumns({"day_of_week": F.date_format("order_date", "E"), "hour": F.hour("order_date")})
    write_table(labelled, f"{base}/silver/sales", partition_by=["year", "month", "day_of_week"])


def gold_tables(spark: SparkSession, base: str) -> dict[str, DataFrame]:
    """Gold tables from the silver layer."""
    restaurants, drivers, sales = (read_table(spark, f"{base}/silver/{name}") for name in ("restaurants", "drivers", "sales"))
    sold = restaurant_sales(restaurants, sales)
    carried = sales.groupBy("driver_id").agg(F.count(F.lit(1)).alias("delivery_count"), F.sum(money("amount")).alias("_sum"))
    return {
        "restaurant_performance": sold.select(
            "restaurant_id", "name", "cuisine", "city", "rating", "rating_category", "order_count",
            F.col("revenue_d").cast("double").alias("total_revenue"), ratio(F.col("revenue_d"), F.col("order_count")).alias("avg_order_value"),
        ),
        "cuisine_performance": sold.groupBy("cuisine").agg(
            F.count(F.lit(1)).alias("restaurant_count"), mean("rating").alias("avg_rating"), F.sum("order_count").alias("total_orders"),
            F.sum("revenue_d").cast("double").alias("total_revenue"),
        ),
        "driver_performance": drivers.join(carried, "driver_id", "left").select(
            "driver_id", "driver_name", "city", "vehicle", F.coalesce("delivery_count", F.lit(0)).alias("delivery_count"),
            F.col("_sum").cast("double").alias("total_revenue"), ratio(F.col("_sum"), F.col("delivery_count")).alias("avg_revenue"),
        ),
        "time_analytics": sales.groupBy("year", "month", "day_of_week", "hour").agg(
            F.count(F.lit(1)).alias("order_count"), F.sum(money("amount")).cast("double").alias("total_revenue"),
            mean("amount").alias("avg_order_value"),
        ),
    }


GOLD_LAYOUT = {"restaurant_performance": ["cuisine"], "driver_performance": ["vehicle"], "time_analytics": ["year"]}


def build_gold(spark: SparkSession, base: str) -> None:
    for name, df in gold_tables(spark, base).items():
        write_table(df, f"{base}/gold/{name}", partition_by=GOLD_LAYOUT.get(name, []))


def build_lake(restaurants: DataFrame, drivers: DataFrame, sales: DataFrame, base: str, tiers) -> None:
    spark = sales.sparkSession
    build_bronze(restaurants, drivers, sales, base)
    build_silver(spark, base, tiers)
    build_gold(spark, base)


def clean_and_match(users: DataFrame, restaurants: DataFrame, sales: DataFrame, tiers, phone: str, city: str) -> dict[str, DataFrame]:
    """Layered job with checks on its inputs: cleaned restaurants, figures by cuisine, users beside restaurants, months."""
    validate_rows(validate_schema(restaurants, restaurants.schema), 1)
    cleaned = restaurants.withColumn(phone, strip_phone(phone)).fillna({"cuisine": "Unknown", "rating": 0.0, "reviews": 0})
    cleaned = cleaned.withColumn("rating_category", tier("rating", tiers, "Below Average"))
    return {
        "restaurants": cleaned,
        "cuisine": cleaned.groupBy("cuisine").agg(
            F.count("restaurant_id").alias("restaurant_count"), mean("rating").alias("avg_rating"), mean("reviews").alias("avg_reviews")
        ),
        "city": city_match(users, cleaned, city, "user_id", "restaurant_id", "rating"),
        "monthly": sales.groupBy(F.year("order_date").alias("year"), F.month("order_date").alias("month")).agg(
            F.count("order_id").alias("order_count"), mean("amount").alias("avg_order_value")
        ),
    }


def delivery_tables(restaurants: DataFrame, drivers: DataFrame, sales: DataFrame) -> dict[str, DataFrame]:
    """Restaurant, driver and location tables of the delivery job."""
    sold = restaurants.join(
        sales.groupBy("restaurant_id").agg(F.count(F.lit(1)).alias("order_count"), F.sum(money("amount")).alias("_sum")), "restaurant_id"
    )
    carried = sales.join(restaurants.select("restaurant_id"), "restaurant_id", "left_semi").groupBy("driver_id").agg(
        F.count(F.lit(1)).alias("delivery_count"), F.sum(money("amount")).alias("_sum")
    )
    score = lambda rating, orders: rating * 0.3 + orders / 10 * 0.7
    return {
        "restaurant_performance": sold.select(
            "restaurant_id", "name", "cuisine", "city", "order_count", F.col("_sum").cast("double").alias("total_revenue"),
            ratio(F.col("_sum"), F.col("order_count")).alias("avg_order_value"),
            score(F.col("rating"), F.col("order_count")).alias("performance_score"),
        ),
        "driver_performance": drivers.join(carried, "driver_id").select(
            "driver_id", "driver_name", "vehicle", "city", "delivery_count", F.col("_sum").cast("double").alias("delivery_value"),
            ratio(F.col("_sum"), F.col("delivery_count")).alias("avg_delivery_value"),
        ),
        "location_analytics": sold.groupBy("city").agg(
            F.sum("order_count").alias("order_count"), F.countDistinct("restaurant_id").alias("restaurant_count"),
            F.sum("_sum").cast("double").alias("total_revenue"), ratio(F.sum("_sum"), F.sum("order_count")).alias("avg_order_value"),
        ),
    }


DELIVERY_LAYOUT = {"restaurant_performance": ["cuisine"], "driver_performance": ["vehicle"], "location_analytics": []}


def write_delivery(tables: dict[str, DataFrame], base: str) -> dict[str, str]:
    """Each table in its own layout, and a CSV report of the restaurants by cuisine."""
    paths = {name: write_table(df, f"{base}/{name}", partition_by=DELIVERY_LAYOUT[name], compression="snappy") for name, df in tables.items()}
    spark = next(iter(tables.values())).sparkSession
    report = read_table(spark, paths["restaurant_performance"]).groupBy("cuisine").agg(
        F.count(F.lit(1)).alias("restaurant_count"), mean("total_revenue").alias("avg_revenue")
    )
    paths["report"] = write_table(report, f"{base}/report", "csv", files=1)
    return paths


def relational_tables(restaurants: DataFrame, drivers: DataFrame, sales: DataFrame) -> dict[str, DataFrame]:
    """The five tables of the relational job."""
    gold = restaurant_sales(restaurants.filter(F.col("rating").isNotNull()), sales.filter(F.col("amount").isNotNull()))
    carried = sales.groupBy("driver_id").agg(F.count(F.lit(1)).alias("delivery_count"), F.sum(money("amount")).alias("_sum"))
    return {
        "restaurants_raw": restaurants.filter(F.col("rating").isNotNull()),
        "drivers_raw": drivers,
        "orders_raw": sales.filter(F.col("amount").isNotNull()),
        "restaurant_analytics": gold.withColumn("total_revenue", F.col("revenue_d").cast("double")).drop("revenue_d"),
        "driver_analytics": drivers.join(carried, "driver_id", "left").select(
            "driver_id", "driver_name", "vehicle", "city", F.coalesce("delivery_count", F.lit(0)).alias("delivery_count"),
            F.col("_sum").cast("double").alias("total_delivery_value"),
        ),
    }


def load_relational(tables: dict[str, DataFrame], url: str, properties: dict[str, str]) -> None:
    for name, df in tables.items():
        write_jdbc(df, url, name, mode="overwrite", properties=properties)


def pandas_workflow(users: DataFrame, restaurants: DataFrame, orders: DataFrame, city: str) -> dict[str, DataFrame]:
    """A pandas notebook's three tables as Spark jobs: by cuisine, by shared city, by month."""
    return {
        "cuisine": restaurants.groupBy("cuisine").agg(
            F.count("restaurant_id").alias("restaurant_count"), mean("rating").alias("avg_rating"), F.sum("reviews").alias("total_reviews")
        ),
        "city": city_match(users, restaurants, city, "user_id", "restaurant_id", "rating").select(
            city, F.col("left_count").alias("user_count"), F.col("right_count").alias("restaurant_count")
        ),
        "monthly": orders.groupBy(F.year("order_date").alias("year"), F.month("order_date").alias("month")).agg(
            F.count("order_id").alias("order_count"), mean("amount").alias("avg_order_value")
        ),
    }
