"""Seeded rows from Spark itself."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

def unit(seed: int, *columns: str) -> Column:
    """A number in [0, 1) that follows the given columns, not the place of the row: a repeated task gives the same."""
    return F.pmod(F.xxhash64(*[F.col(c) for c in columns], F.lit(seed)), F.lit(1_000_000)) / F.lit(1_000_000.0)


def number_sequence(df: DataFrame, first: str, last: str, out: str = "n") -> DataFrame:
    """Every row repeated with the numbers from one column to another."""
    return df.withColumn(out, F.explode(F.sequence(F.col(first).cast("bigint"), F.col(last).cast("bigint"))))


def recursive_numbers(spark: SparkSession, last: int) -> DataFrame:
    """Numbers 1..last by a recursive common table expression."""
    return spark.sql(
        f"WITH RECURSIVE seq(n) AS (SELECT 1 UNION ALL SELECT n + 1 FROM seq WHERE n < {int(last)}) SELECT n FROM seq"
    )


def rows_from(spark: SparkSession, rows: Sequence[tuple], ddl: str) -> DataFrame:
    """A short literal table."""
    return spark.createDataFrame(list(rows), ddl)


def skewed_orders(orders: DataFrame, number: str, copies: int, hot_tenths: int = 9, hot_keys: int = 3, keys: int = 500) -> DataFrame:
    """Given orders enlarged for tests of skew: each one ``copies`` times, ``hot_tenths`` of ten on the first ``hot_keys`` restaurants.

    New numbers and restaurants follow from the order's number alone, so a repeated task gives the same rows. Other columns stay.
    """
    each = orders.withColumn("order_id", F.explode(F.sequence(F.col(number) * copies, F.col(number) * copies + copies - 1)))
    cold = hot_keys + F.pmod(F.floor(F.col("order_id") / 10), F.lit(keys - hot_keys))
    place = F.when(F.pmod("order_id", F.lit(10)) < hot_tenths, F.pmod(F.floor(F.col("order_id") / 10), F.lit(hot_keys))).otherwise(cold)
    return each.withColumn("restaurant_key", F.concat(F.lit("REST"), place.cast("string")))


def gen_shifts(drivers: DataFrame, driver: str, last_day: Column, seed: int = 7) -> DataFrame:
    """One random shift per driver in the 30 days before ``last_day``."""
    chance = lambda k: unit(seed + k, driver)
    return drivers.select(
        driver,
        F.lit("Day").alias("shift_type"),
        F.date_sub(last_day, F.floor(chance(0) * 30).cast("int")).alias("start_date"),
        (chance(1) * 500).alias("earnings"),
        (chance(2) * 300).alias("shift_minutes"),
        (chance(3) * 100).alias("distance_km"),
    )
