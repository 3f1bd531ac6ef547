"""User-defined function queries (U*)."""

from pyspark.sql import functions as F

from tiffin.catalog import roles as r
from tiffin.catalog.projections import PRICE_TIERS, REGION_OF_TYPE
from tiffin.catalog.registry import query
from tiffin.functions import columns as c, udfs
from tiffin.operators import joins, windows as win

TIER_SQL = """CASE WHEN {0} IS NULL THEN 'Unknown' WHEN {0} >= 975 THEN 'Excellent' WHEN {0} >= 950 THEN 'Very Good'
  WHEN {0} >= 925 THEN 'Good' WHEN {0} >= 910 THEN 'Average' ELSE 'Below Average' END"""
GAPS_SQL = "rated AS (SELECT p_partkey, CASE WHEN p_type != 'PROMO' THEN p_retailprice END AS rating FROM part)"


def rated(t):
    return t.part.select("p_partkey", F.when(F.col("p_type") != "PROMO", F.col("p_retailprice")).alias("rating"))


@query("u01_scalar_udf", r.with_ctes(GAPS_SQL) + f"SELECT p_partkey, {TIER_SQL.format('rating')} AS label FROM rated")
def u01(t):
    return rated(t).select("p_partkey", udfs.label_udf(PRICE_TIERS, "Below Average")("rating").alias("label"))


@query("u02_registered_udf", r.with_ctes(GAPS_SQL) + f"SELECT {TIER_SQL.format('rating')} AS label, count(*) AS n FROM rated GROUP BY 1")
def u02(t):
    udfs.register_label(t.spark, "tiffin_tier", PRICE_TIERS, "Below Average")
    return rated(t).select(F.expr("tiffin_tier(rating) AS label")).groupBy("label").agg(F.count(F.lit(1)).alias("n"))


@query("u03_pandas_udf", "SELECT p_partkey, round(pow(p_retailprice, 2) * ln(1 + p_size) / 10, 4) AS score FROM part")
def u03(t):
    return t.part.select("p_partkey", F.round(udfs.log_score_pandas("p_retailprice", "p_size"), 4).alias("score"))


@query("u04_map_in_pandas", """
SELECT p_partkey, p_name AS name, CAST(length(p_name) AS BIGINT) AS name_length, regexp_replace(p_name, ' \\S+$', '') AS name_clean FROM part""")
def u04(t):
    rows = t.part.select("p_partkey", F.col("p_name").alias("name"))
    return rows.mapInPandas(udfs.clean_names, "p_partkey bigint, name string, name_length bigint, name_clean string")


@query("u05_grouped_mean_pandas", """
SELECT p_type, round(CAST(sum(CAST(p_retailprice AS DECIMAL(18,2)) * p_size) AS DOUBLE) / sum(p_size), 6) AS weighted FROM part GROUP BY p_type""")
def u05(t):
    means = udfs.weighted_mean_pandas(t.part, "p_type", "p_retailprice", "p_size", "weighted")
    return means.select("p_type", F.round("weighted", 6).alias("weighted"))


@query("u06_group_transform", """
SELECT p_partkey, round((p_retailprice - m) / s, 6) AS z FROM part JOIN (SELECT p_type AS k,
  CAST(sum(CAST(p_retailprice AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS m, stddev_samp(p_retailprice) AS s FROM part GROUP BY 1) ON k = p_type""")
def u06(t):
    # The group statistics come from Spark; pandas then works on batches of rows, not on whole groups.
    rows = t.part.select("p_partkey", "p_type", "p_retailprice")
    stats = win.beside(
        rows, ["p_type"], m=F.sum(c.money("p_retailprice")).cast("double") / F.count(F.lit(1)), s=F.stddev_samp("p_retailprice")
    )
    return stats.select("p_partkey", F.round(udfs.scale_pandas("p_retailprice", "m", "s"), 6).alias("z"))


@query("u07_broadcast_lookup", """
SELECT p_partkey, coalesce(CASE WHEN p_type IN ('ECONOMY','STANDARD') THEN 'Value' WHEN p_type = 'PROMO' THEN 'Campaign'
  WHEN p_type IN ('SMALL','MEDIUM') THEN 'Size' END, 'Other') AS type_group FROM part""")
def u07(t):
    known = joins.lookup(t.part.select("p_partkey", "p_type"), "p_type", REGION_OF_TYPE, "g")
    return known.select("p_partkey", F.coalesce("g", F.lit("Other")).alias("type_group"))


@query("u08_row_wise", f"SELECT p_partkey, {TIER_SQL.format('p_retailprice')} AS category FROM part")
def u08(t):
    return t.part.select("p_partkey", c.tier("p_retailprice", PRICE_TIERS, "Below Average", missing="Unknown").alias("category"))


@query("u09_udf_equals_builtin", "SELECT true AS same, count(*) AS n FROM part")
def u09(t):
    agree = udfs.same_label("rating", PRICE_TIERS, "Below Average")
    return rated(t).select(agree.alias("same")).groupBy("same").agg(F.count(F.lit(1)).alias("n"))


@query("u10_explode", "SELECT p_partkey, unnest(string_split(p_name, ' ')) AS word FROM part")
def u10(t):
    return t.part.select("p_partkey", F.explode(F.split("p_name", " ")).alias("word"))
