"""Window and ordering queries (W*, O*)."""

from pyspark.sql import Window, functions as F

from tiffin.catalog import roles as r
from tiffin.catalog.registry import query
from tiffin.functions import columns as c
from tiffin.operators import aggs, windows as win
from tiffin.session import durable

LINE = "o_orderkey, o_custkey, o_totalprice"


def order_lines(t):
    return t.orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")


BY_DATE = ["o_orderdate", "o_orderkey"]


@query("w01_row_number", """
SELECT o_orderkey, o_custkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) AS recency
FROM orders""")
def w01(t):
    newest_first = [F.col("o_orderdate").desc(), F.col("o_orderkey")]
    return win.number_rows(order_lines(t).drop("o_totalprice"), ["o_custkey"], newest_first, "recency").drop("o_orderdate")


@query("w02_rank", """
SELECT p_partkey, p_type, p_retailprice, rank() OVER (PARTITION BY p_type ORDER BY p_retailprice DESC) AS type_rank FROM part""")
def w02(t):
    rows = t.part.select("p_partkey", "p_type", "p_retailprice")
    return win.ranks(rows, ["p_type"], "p_retailprice", {"type_rank": "rank"}, descending=True)


@query("w03_dense_rank", """
SELECT p_partkey, p_type, p_size, dense_rank() OVER (PARTITION BY p_type ORDER BY p_size DESC) AS size_rank FROM part""")
def w03(t):
    return win.ranks(t.part.select("p_partkey", "p_type", "p_size"), ["p_type"], "p_size", {"size_rank": "dense_rank"}, descending=True)


@query("w04_percent_rank", """
SELECT o_orderkey, percent_rank() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice) AS pr FROM orders""")
def w04(t):
    rows = t.orders.select("o_orderkey", "o_orderpriority", "o_totalprice")
    return win.ranks(rows, ["o_orderpriority"], "o_totalprice", {"pr": "percent_rank"}).select("o_orderkey", "pr")


@query("w05_cume_dist", "SELECT o_orderkey, cume_dist() OVER (ORDER BY o_totalprice) AS cd FROM orders")
def w05(t):
    return win.ranks(t.orders.select("o_orderkey", "o_totalprice"), [], "o_totalprice", {"cd": "cume_dist"}).select("o_orderkey", "cd")


@query("w05_cume_dist_grouped", f"""
WITH g AS (SELECT p_size, count(*) AS n FROM part GROUP BY p_size)
SELECT p_size, n, 100 * cume_dist() OVER (ORDER BY p_size) AS cumulative_pct, {r.pct_sql('n', '(SELECT count(*) FROM part)')} AS pct FROM g""")
def w05_grouped(t):
    counts = t.part.groupBy("p_size").agg(F.count(F.lit(1)).alias("n"))
    spread = win.ranks(counts, [], "p_size", {"cd": "cume_dist"})
    shared = aggs.share_of_total(spread, "n", "pct")
    return shared.select("p_size", "n", (100 * F.col("cd")).alias("cumulative_pct"), "pct")


@query("w06_row_percentile", """
SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice, o_orderkey) AS order_rank,
  row_number() OVER (ORDER BY o_totalprice, o_orderkey) / (SELECT count(*) FROM orders) * 100 AS percentile FROM orders""")
def w06(t):
    rows = t.orders.select("o_orderkey", "o_totalprice")
    numbered = win.number_rows(rows, [], [F.col("o_totalprice"), F.col("o_orderkey")], "order_rank")
    whole = t.orders.agg(F.count(F.lit(1))).scalar()
    return numbered.select("o_orderkey", "order_rank", (F.col("order_rank") / whole * 100).alias("percentile"))


@query("w07_lag", f"""
SELECT {LINE}, lag(o_totalprice, 1) OVER w AS prev_price, lag(o_totalprice, 2, 0) OVER w AS second_or_zero
FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)""")
def w07(t):
    return win.framed(
        order_lines(t), ["o_custkey"], BY_DATE,
        lambda w: {
            "prev_price": F.lag("o_totalprice", 1).over(w),
            "second_or_zero": F.lag("o_totalprice", 2, 0.0).over(w),
        },
        before=2,
    ).drop("o_orderdate")


@query("w08_lead", """
SELECT event_id, user_id, event_type, lead(event_type) OVER w AS next_type, lead(ts, 1) OVER w AS next_ts
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""")
def w08(t):
    return win.framed(
        t.events.select("event_id", "user_id", "event_type", "ts"), ["user_id"], [F.col("ts"), F.col("event_id")],
        lambda w: {"next_type": F.lead("event_type").over(w), "next_ts": F.lead("ts", 1).over(w)}, after=1,
    ).drop("ts")


@query("w09_running_total", """
SELECT o_orderkey, o_custkey, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) OVER w AS DOUBLE) AS running_total, count(*) OVER w AS running_count,
  max(o_totalprice) OVER w AS running_max
FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")
def w09(t):
    rows = order_lines(t).withColumn("cash", c.money("o_totalprice"))
    run = win.running(
        rows, ["o_custkey"], BY_DATE,
        {"total": ("sum", "cash"), "running_count": ("count", "cash"), "running_max": ("max", "o_totalprice")},
    )
    return run.select("o_orderkey", "o_custkey", F.col("total").cast("double").alias("running_total"), "running_count", "running_max")


@query("w10_running_range", """
SELECT o_orderkey, o_orderpriority, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) OVER (PARTITION BY o_orderpriority ORDER BY o_orderdate) AS DOUBLE) AS running_total
FROM orders""")
def w10(t):
    rows = t.orders.select("o_orderkey", "o_orderpriority", "o_orderdate", c.money("o_totalprice").alias("cash"))
    run = win.running_with_ties(rows, ["o_orderpriority"], "o_orderdate", "cash", "total")
    return run.select("o_orderkey", "o_orderpriority", F.col("total").cast("double").alias("running_total"))


@query("w11_moving_average", """
SELECT o_orderkey, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) OVER w AS DOUBLE) / count(*) OVER w AS avg_3 FROM orders
WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)""")
def w11(t):
    def columns(w):
        last3 = w.rowsBetween(-2, 0)
        return {"avg_3": F.sum(c.money("o_totalprice")).over(last3).cast("double") / F.count(F.lit(1)).over(last3)}

    return win.framed(order_lines(t), ["o_custkey"], BY_DATE, columns, before=2).select("o_orderkey", "avg_3")


@query("w12_rolling_min_periods", """
SELECT o_orderkey, CASE WHEN count(*) OVER w >= 5 THEN CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) OVER w AS DOUBLE) / 5 END AS rolling_5
FROM orders WINDOW w AS (ORDER BY o_orderdate, o_orderkey ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)""")
def w12(t):
    return win.framed(
        order_lines(t), [], BY_DATE, lambda w: {"rolling_5": win.rolling_mean(c.money("o_totalprice"), w, 5)}, before=4
    ).select("o_orderkey", "rolling_5")


@query("w13_beside", """
SELECT p_partkey, p_type, p_retailprice, s.type_avg, s.type_max, s.type_count, p_retailprice - s.type_avg AS diff
FROM part JOIN (SELECT p_type AS k, CAST(sum(CAST(p_retailprice AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS type_avg,
  max(p_retailprice) AS type_max, count(*) AS type_count FROM part GROUP BY p_type) s ON k = p_type""")
def w13(t):
    rows = t.part.select("p_partkey", "p_type", "p_retailprice")
    stats = win.beside(
        rows, ["p_type"],
        type_avg=F.sum(c.money("p_retailprice")).cast("double") / F.count(F.lit(1)),
        type_max=F.max("p_retailprice"), type_count=F.count(F.lit(1)),
    )
    return stats.withColumn("diff", F.col("p_retailprice") - F.col("type_avg"))


@query("w14_cumulative_share", f"""
WITH g AS (SELECT p_brand, count(*) AS n FROM part GROUP BY 1),
w AS (SELECT p_brand, n, CAST(sum(n) OVER (ORDER BY n DESC, p_brand ROWS UNBOUNDED PRECEDING) AS BIGINT) AS running_total FROM g)
SELECT *, {r.pct_sql('running_total', '(SELECT count(*) FROM part)')} AS cumulative_pct FROM w""")
def w14(t):
    return aggs.cumulative_share(t.part.groupBy("p_brand").agg(F.count(F.lit(1)).alias("n")), "n", "p_brand")


@query("w15_top_n_rank", """
SELECT * FROM (SELECT p_partkey, p_brand, p_size, rank() OVER (PARTITION BY p_brand ORDER BY p_size DESC) AS rank FROM part) WHERE rank <= 3""")
def w15(t):
    return win.top_ranked(t.part.select("p_partkey", "p_brand", "p_size"), ["p_brand"], "p_size", 3, "rank")


@query("w15_top_n_dense", """
SELECT * FROM (SELECT o_orderkey, o_orderpriority, o_totalprice, dense_rank() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice DESC) AS rank FROM orders) WHERE rank <= 3""")
def w15_dense(t):
    rows = t.orders.select("o_orderkey", "o_orderpriority", "o_totalprice")
    return win.top_ranked(rows, ["o_orderpriority"], "o_totalprice", 3, "dense_rank")


@query("w16_multi_rank", """
SELECT * FROM (SELECT p_partkey, p_type, p_brand, p_retailprice, rank() OVER (PARTITION BY p_type ORDER BY p_retailprice DESC) AS type_rank,
  rank() OVER (PARTITION BY p_brand ORDER BY p_retailprice DESC) AS brand_rank, rank() OVER (ORDER BY p_retailprice DESC) AS overall_rank FROM part)
WHERE type_rank <= 2 OR brand_rank <= 2 OR overall_rank <= 5""")
def w16(t):
    rows = t.part.select("p_partkey", "p_type", "p_brand", "p_retailprice")
    groups = ((["p_type"], "type_rank"), (["p_brand"], "brand_rank"), ([], "overall_rank"))
    ranked = win.ranks_many(rows, [(keys, "p_retailprice", {out: "rank"}) for keys, out in groups])
    return ranked.filter((F.col("type_rank") <= 2) | (F.col("brand_rank") <= 2) | (F.col("overall_rank") <= 5))


@query("w17_pandas_rank", """
SELECT p_partkey, p_type, p_size, rank() OVER w AS min_rank, dense_rank() OVER w AS dense,
  rank() OVER w + (count(*) OVER (PARTITION BY p_type, p_size) - 1) / 2.0 AS average_rank
FROM part WINDOW w AS (PARTITION BY p_type ORDER BY p_size DESC)""")
def w17(t):
    methods = {"min_rank": "min", "dense": "dense", "average_rank": "average"}
    return win.pandas_rank(t.part.select("p_partkey", "p_type", "p_size"), ["p_type"], "p_size", methods, ascending=False)


@query("w18_cumcount", "SELECT p_partkey, p_type, row_number() OVER (PARTITION BY p_type ORDER BY p_partkey) - 1 AS cumcount FROM part")
def w18(t):
    numbered = win.number_rows(t.part.select("p_partkey", "p_type"), ["p_type"], [F.col("p_partkey")])
    return numbered.select("p_partkey", "p_type", (F.col("row_number") - 1).alias("cumcount"))


@query("w19_shift", """
SELECT o_orderkey, lag(o_totalprice) OVER w AS prev_price, lead(o_totalprice) OVER w AS next_price, o_totalprice - lag(o_totalprice) OVER w AS step
FROM orders WINDOW w AS (ORDER BY o_totalprice, o_orderkey)""")
def w19(t):
    # The whole table is one sorted list; blocks with a copied border row replace the single-task window.
    return win.framed(
        t.orders.select("o_orderkey", "o_totalprice"), [], [F.col("o_totalprice"), F.col("o_orderkey")],
        lambda w: {
            "prev_price": F.lag("o_totalprice").over(w), "next_price": F.lead("o_totalprice").over(w),
            "step": F.col("o_totalprice") - F.lag("o_totalprice").over(w),
        },
        before=1, after=1,
    ).drop("o_totalprice")


@query("w20_zscore", """
SELECT p_partkey, p_type, round((p_retailprice - m) / s, 6) AS z FROM part JOIN (SELECT p_type AS k,
  CAST(sum(CAST(p_retailprice AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS m, stddev_samp(p_retailprice) AS s FROM part GROUP BY 1) ON k = p_type""")
def w20(t):
    rows = t.part.select("p_partkey", "p_type", "p_retailprice")
    stats = win.beside(
        rows, ["p_type"], m=F.sum(c.money("p_retailprice")).cast("double") / F.count(F.lit(1)), s=F.stddev_samp("p_retailprice")
    )
    return stats.select("p_partkey", "p_type", F.round((F.col("p_retailprice") - F.col("m")) / F.col("s"), 6).alias("z"))


@query("w21_latest_per_key", """
SELECT o_custkey, o_orderkey, o_orderstatus, o_orderdate FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC NULLS LAST, o_orderkey DESC) AS rn
FROM orders) WHERE rn = 1""")
def w21(t):
    rows = t.orders.select("o_custkey", "o_orderkey", "o_orderstatus", "o_orderdate")
    return win.latest_per_key(rows, ["o_custkey"], [F.col("o_orderdate"), F.col("o_orderkey")])


@query("w22_composite_rank", """
WITH g AS (SELECT p_brand, count(*) AS n, max(p_size) AS size, CAST(sum(CAST(p_retailprice AS DECIMAL(18,2))) AS DOUBLE) AS value, count(DISTINCT p_type) AS types FROM part GROUP BY 1)
SELECT p_brand, (rank() OVER (ORDER BY n DESC) + rank() OVER (ORDER BY size DESC) + rank() OVER (ORDER BY value DESC) + rank() OVER (ORDER BY types DESC)) / 4.0 AS score FROM g""")
def w22(t):
    ranked = t.part.groupBy("p_brand").agg(
        F.count(F.lit(1)).alias("n"), F.max("p_size").alias("size"), c.total("p_retailprice").alias("value"),
        F.countDistinct("p_type").alias("types"),
    )
    return win.composite_rank(ranked, ["n", "size", "value", "types"], "score").select("p_brand", "score")


@query("w23_first_n", """
SELECT p_type, p_partkey, rn FROM (SELECT *, row_number() OVER (PARTITION BY p_type ORDER BY p_partkey) AS rn FROM part) WHERE rn <= 5""")
def w23(t):
    return win.top_rows(t.part.select("p_type", "p_partkey"), ["p_type"], [F.col("p_partkey")], 5)


@query("o01_order_by", "SELECT p_partkey, p_type, p_size FROM part ORDER BY p_type ASC, p_size DESC, p_partkey")
def o01(t):
    return t.part.select("p_partkey", "p_type", "p_size").orderBy(F.col("p_type").asc(), F.col("p_size").desc(), "p_partkey")


@query("o02_order_by_case", """
SELECT p_type, count(*) AS n FROM part GROUP BY p_type ORDER BY CASE p_type WHEN 'PROMO' THEN 1 WHEN 'SMALL' THEN 2 ELSE 3 END, 2 DESC, p_type""")
def o02(t):
    place = F.when(F.col("p_type") == "PROMO", 1).when(F.col("p_type") == "SMALL", 2).otherwise(3)
    return t.part.groupBy("p_type").agg(F.count(F.lit(1)).alias("n")).orderBy(place, F.col("n").desc(), "p_type")


@query("o03_nulls_last", """
SELECT c_custkey, CASE WHEN c_acctbal > 0 THEN c_acctbal END AS balance FROM customer ORDER BY balance DESC NULLS LAST, c_custkey""")
def o03(t):
    rows = t.customer.select("c_custkey", F.when(F.col("c_acctbal") > 0, F.col("c_acctbal")).alias("balance"))
    return rows.orderBy(F.col("balance").desc_nulls_last(), "c_custkey")


@query("o04_top_k", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20")
def o04(t):
    return t.orders.select("o_orderkey", "o_totalprice").orderBy(F.col("o_totalprice").desc(), "o_orderkey").limit(20)


@query("o05_sort_within_partitions", "SELECT count(*) AS row_count, 0 AS out_of_order FROM lineitem")
def o05(t):
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")
    placed = rows.repartitionByRange("l_suppkey", "l_shipdate").sortWithinPartitions("l_suppkey", "l_shipdate")
    numbered = durable(placed.withColumn("at", F.monotonically_increasing_id()), "sorted")
    here = F.struct("l_suppkey", "l_shipdate")
    slice_no = F.shiftright("at", win.SLICE_BITS)
    follow = numbered.withColumn("before", F.lag(here).over(Window.partitionBy(slice_no).orderBy("at")))  # one slice of the sort at a time
    return follow.agg(F.count(F.lit(1)).alias("row_count"), F.count_if(F.col("before") > here).cast("int").alias("out_of_order"))


@query("o06_head", "SELECT least(count(*), 5) AS row_count, true AS all_in_table FROM orders")
def o06(t):
    head = t.orders.limit(5)
    known = head.join(t.orders.select("o_orderkey", F.lit(True).alias("known")), "o_orderkey", "left")
    return known.agg(F.count(F.lit(1)).alias("row_count"), F.min(F.coalesce("known", F.lit(False))).alias("all_in_table"))
