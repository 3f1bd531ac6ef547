"""Delivery roles played by the input tables, as DataFrames and as the matching SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tiffin.functions.columns import money

# ------------------------------------------------------------------ SQL text


def with_ctes(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"


def rounded(above: str, below: str, digits: int = 2) -> str:
    """``above / below`` of two integers, rounded half up without floating point."""
    ten = 10**digits
    return (
        f"(sign({above}) * ((2 * abs(CAST({above} AS HUGEINT)) * {ten} + CAST({below} AS HUGEINT)) "
        f"// (2 * CAST({below} AS HUGEINT))) / {float(ten)})"
    )


def mean_sql(x: str, digits: int = 2) -> str:
    """Rounded mean of a DECIMAL(18,2) expression."""
    return rounded(f"CAST(sum({x}) * 100 AS HUGEINT)", f"(100 * count({x}))", digits)


def pct_sql(part: str, whole: str, digits: int = 2) -> str:
    return rounded(f"(100 * CAST({part} AS HUGEINT))", whole, digits)


def sum_sql(x: str) -> str:
    return f"CAST(sum({x}) AS DOUBLE)"


def cash(x: str) -> str:
    return f"CAST({x} AS DECIMAL(18,2))"


def n_if(condition: str) -> str:
    return f"CAST(sum(CASE WHEN {condition} THEN 1 ELSE 0 END) AS BIGINT)"


RESTAURANTS = """restaurants AS (SELECT p_partkey AS restaurant_id, p_name AS name, p_type AS cuisine, p_brand AS city,
  p_retailprice AS rating, CAST(p_retailprice AS DECIMAL(18,2)) AS rating_d, p_size AS reviews FROM part)"""

SALES = """sales AS (SELECT l_orderkey AS order_id, l_partkey AS restaurant_id, l_suppkey AS driver_id,
  l_extendedprice AS amount, CAST(l_extendedprice AS DECIMAL(18,2)) AS amount_d, l_quantity AS quantity FROM lineitem)"""

TIMED_SALES = """timed_sales AS (SELECT l_orderkey AS order_id, l_partkey AS restaurant_id, l_suppkey AS driver_id,
  o_custkey AS user_id, o_orderdate AS order_date, l_extendedprice AS amount,
  CAST(l_extendedprice AS DECIMAL(18,2)) AS amount_d FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

DRIVERS = """drivers AS (SELECT s_suppkey AS driver_id, s_name AS driver_name, n_name AS city, r_name AS vehicle
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""

USERS = """users AS (SELECT c_custkey AS user_id, c_name AS name, n_name AS city, c_mktsegment AS segment, c_acctbal AS balance
  FROM customer JOIN nation ON c_nationkey = n_nationkey)"""


# ------------------------------------------------------------------ DataFrames


def restaurants(t) -> DataFrame:
    return t.part.select(
        F.col("p_partkey").alias("restaurant_id"),
        F.col("p_name").alias("name"),
        F.col("p_type").alias("cuisine"),
        F.col("p_brand").alias("city"),
        F.col("p_retailprice").alias("rating"),
        F.col("p_size").alias("reviews"),
    )


def sales(t) -> DataFrame:
    return t.lineitem.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("restaurant_id"),
        F.col("l_suppkey").alias("driver_id"),
        F.col("l_extendedprice").alias("amount"),
        F.col("l_quantity").alias("quantity"),
    )


def timed_sales(t) -> DataFrame:
    orders = t.orders.select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("user_id"), F.col("o_orderdate").alias("order_date")
    )
    return sales(t).drop("quantity").join(orders, "order_id")


def drivers(t) -> DataFrame:
    return (
        t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("s_suppkey").alias("driver_id"),
            F.col("s_name").alias("driver_name"),
            F.col("n_name").alias("city"),
            F.col("r_name").alias("vehicle"),
        )
    )


def users(t) -> DataFrame:
    return t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("user_id"),
        F.col("c_name").alias("name"),
        F.col("n_name").alias("city"),
        F.col("c_mktsegment").alias("segment"),
        F.col("c_acctbal").alias("balance"),
    )


def revenue_by(df: DataFrame, *keys: str) -> DataFrame:
    """Orders and exact revenue per key, the pre-aggregate most reports start from."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("order_count"), F.sum(money("amount")).alias("revenue_d"))
