"""The split window functions against plain Spark windows on skewed rows with ties and NULL."""

import random

import pytest
from pyspark.sql import Window as W, functions as F

from tests.conftest import plan, rows
from tiffin.operators import aggs, windows as win


@pytest.fixture(scope="module")
def skewed(spark):
    rng = random.Random(5)
    data = []
    for i in range(300):
        key = "hot" if rng.random() < 0.6 else rng.choice(["a", "b", None])
        value = None if rng.random() < 0.1 else rng.randint(0, 12)
        data.append((i, key, value, rng.randint(1, 100)))
    return spark.createDataFrame(data, "id int, k string, v int, x int").repartition(5).cache()


ORDER = ["v", "id"]


@pytest.mark.parametrize("keys", [["k"], []])
@pytest.mark.parametrize("parts", [9, None])
def test_running_equals_rows_frame(skewed, keys, parts):
    kinds = {"s": ("sum", "x"), "n": ("count", "v"), "hi": ("max", "x"), "lo": ("min", "x")}
    got = win.running(skewed, keys, ORDER, kinds, parts=parts)
    w = W.partitionBy(*keys).orderBy(*ORDER).rowsBetween(W.unboundedPreceding, 0)
    want = skewed.select(
        "*", F.sum("x").over(w).alias("s"), F.count("v").over(w).alias("n"), F.max("x").over(w).alias("hi"), F.min("x").over(w).alias("lo")
    )
    assert rows(got) == rows(want)


@pytest.mark.parametrize("keys", [["k"], []])
@pytest.mark.parametrize("block", [7, 1000, None])
def test_framed_equals_lag_and_lead(skewed, keys, block):
    def columns(w):
        near = w.rowsBetween(-3, 2)
        return {"p": F.lag("x", 2, -1).over(w), "n": F.lead("x").over(w), "m": F.sum("x").over(near), "c": F.count("v").over(near)}

    got = win.framed(skewed, keys, ORDER, columns, before=3, after=2, block=block)
    want = skewed.select("*", *[c.alias(n) for n, c in columns(W.partitionBy(*keys).orderBy(*ORDER)).items()])
    assert rows(got) == rows(want)


def test_bounded_groups_take_the_plain_window(skewed):
    counts = {"n": ("count", "x")}
    assert rows(win.running(skewed, ["id"], ORDER, counts, bounded=True)) == rows(win.running(skewed, ["id"], ORDER, counts))


def test_a_hot_key_is_spread_over_slices(spark):
    df = spark.range(8000).select(F.when(F.col("id") % 10 < 9, "hot").otherwise("cold").alias("k"), "id")
    slices = win.ordered(df, ["k"], ["id"], parts=8).groupBy(F.shiftright("_pos", win.SLICE_BITS)).count()
    assert slices.agg(F.max("count")).first()[0] < 2500


def test_frame_longer_than_block_is_refused(skewed):
    with pytest.raises(ValueError):
        win.framed(skewed, [], ORDER, lambda w: {}, before=10, block=5)


@pytest.mark.parametrize("keys", [["k"], []])
@pytest.mark.parametrize("descending", [True, False])
def test_ranks(skewed, keys, descending):
    kinds = {"r": "rank", "d": "dense_rank", "p": "percent_rank", "c": "cume_dist"}
    by = F.col("v").desc() if descending else F.col("v").asc()
    w = W.partitionBy(*keys).orderBy(by)
    got = win.ranks(skewed, keys, "v", kinds, descending)
    want = skewed.select(
        "*", F.rank().over(w).cast("bigint").alias("r"), F.dense_rank().over(w).cast("bigint").alias("d"),
        F.percent_rank().over(w).alias("p"), F.cume_dist().over(w).alias("c"),
    )
    assert rows(got, "id", "r", "d", "p", "c") == rows(want, "id", "r", "d", "p", "c")


def test_average_rank_is_mean_of_positions(spark):
    df = spark.createDataFrame([(1, 10), (2, 20), (3, 20), (4, 30)], "id int, v int")
    got = win.ranks(df, [], "v", {"a": "average_rank", "m": "max_rank"})
    assert rows(got, "id", "a", "m") == [(1, 1.0, 1), (2, 2.5, 3), (3, 2.5, 3), (4, 4.0, 4)]


def test_pandas_rank_leaves_null_out(skewed):
    methods = ["average", "min", "max", "dense"]
    got = win.pandas_rank(skewed, ["k"], "v", {m: m for m in methods}, ascending=False)
    frame = skewed.toPandas()
    frame["k"] = frame["k"].fillna("null")
    ranked = {m: frame.groupby("k")["v"].rank(method=m, ascending=False) for m in methods}
    want = {int(i): tuple(None if ranked[m].isna()[at] else float(ranked[m][at]) for m in methods) for at, i in enumerate(frame["id"])}
    assert {r.id: tuple(None if r[m] is None else float(r[m]) for m in methods) for r in got.collect()} == want


def test_single_row_percent_rank_is_zero(spark):
    df = spark.createDataFrame([("a", 1)], "k string, v int")
    assert rows(win.ranks(df, ["k"], "v", {"p": "percent_rank"}), "p") == [(0.0,)]


def test_running_with_ties_shares_sums(skewed):
    known = skewed.filter("v IS NOT NULL")
    w = W.partitionBy("k").orderBy("v")
    got = win.running_with_ties(known, ["k"], "v", "x", "s")
    assert rows(got, "id", "s") == rows(known.withColumn("s", F.sum("x").over(w)), "id", "s")


@pytest.mark.parametrize("method", ["rank", "dense_rank"])
def test_top_ranked(skewed, method):
    function = F.rank() if method == "rank" else F.dense_rank()
    w = W.partitionBy("k").orderBy(F.col("v").desc_nulls_last())
    want = skewed.withColumn("rank", function.over(w).cast("bigint")).filter("rank <= 3")
    assert rows(win.top_ranked(skewed, ["k"], "v", 3, method), "id", "rank") == rows(want, "id", "rank")


def test_top_rows_limits_before_the_shuffle(skewed):
    df = win.top_rows(skewed, ["k"], ORDER, 2)
    text = plan(df)
    assert "WindowGroupLimit" in text and "Partial" in text
    assert df.groupBy("k").count().filter("count > 2").count() == 0


def test_latest_per_key_nulls_are_oldest(spark):
    df = spark.createDataFrame([("a", None, 1), ("a", 5, 2), ("b", None, 3)], "k string, at int, v int")
    assert rows(win.latest_per_key(df, ["k"], [F.col("at"), F.col("v")])) == [("a", 5, 2), ("b", None, 3)]


@pytest.mark.parametrize("keys", [["k"], []])
def test_percentiles(skewed, keys):
    shares = {"p0": 0.0, "p10": 0.1, "p50": 0.5, "p75": 0.75, "p100": 1.0}
    want = skewed.groupBy(*keys).agg(*[F.percentile("v", s).alias(n) for n, s in shares.items()])
    got = win.percentiles(skewed, keys, "v", shares)
    for a, b in zip(rows(got), rows(want), strict=True):
        assert a[: len(keys)] == b[: len(keys)]
        assert a[len(keys):] == pytest.approx(b[len(keys):])


def test_rolling_mean_waits_for_enough_rows(spark):
    df = spark.createDataFrame([(i, i * 10) for i in range(1, 7)], "id int, v int")
    strict = win.framed(df, [], [F.col("id")], lambda w: {"m": win.rolling_mean(F.col("v"), w, 3)}, before=2, block=4)
    loose = win.framed(df, [], [F.col("id")], lambda w: {"m": win.rolling_mean(F.col("v"), w, 3, 1)}, before=2, block=4)
    assert [r[0] for r in rows(strict, "id", "m")] == [1, 2, 3, 4, 5, 6]
    assert [r[1] for r in rows(strict, "id", "m")] == [None, None, 20.0, 30.0, 40.0, 50.0]
    assert [r[1] for r in rows(loose, "id", "m")] == [10.0, 15.0, 20.0, 30.0, 40.0, 50.0]


def test_collect_chunks_keeps_all_values_in_order(skewed):
    chunks = aggs.collect_chunks(skewed, ["k"], "id", ["id"], "ids", chunk=10)
    by_key = {}
    for key, number, ids in sorted(((r.k or "", r.chunk_no, r.ids) for r in chunks.collect())):
        assert len(ids) <= 10
        by_key.setdefault(key, []).extend(ids)
    want = {}
    for r in skewed.orderBy("id").collect():
        want.setdefault(r.k or "", []).append(r.id)
    assert by_key == want


def test_most_frequent_prefers_smallest_on_tie(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "y"), ("a", "y"), ("a", "x"), ("b", "z"), ("b", None)], "k string, v string")
    assert rows(aggs.most_frequent(df, ["k"], "v", "top")) == [("a", "x"), ("b", "z")]


def test_two_phase_equals_one_phase(skewed):
    got = aggs.two_phase(skewed, ["k"], {"total": "x"})
    want = skewed.groupBy("k").agg(F.count("*").alias("row_count"), F.sum("x").cast("double").alias("total"))
    assert rows(got, "k", "row_count", "total") == rows(want, "k", "row_count", "total")


@pytest.mark.parametrize("method", ["rank", "dense_rank"])
def test_top_ranked_of_bounded_groups(skewed, method):
    split, plain = (win.top_ranked(skewed, ["k"], "v", 3, method, out="place", bounded=b) for b in (False, True))
    assert rows(split, "id", "place") == rows(plain, "id", "place")
    assert "WindowGroupLimit" in plan(plain)


def test_pivot_leaves_empty_cells_null(spark):
    df = spark.createDataFrame([("a", "x"), ("b", "y")], "k string, v string")
    assert rows(aggs.pivot_counts(df, "k", "v", ["x", "y"])) == [("a", 1, None), ("b", None, 1)]


def test_null_profile_counts_nan(spark):
    df = spark.createDataFrame([(1.0, None), (float("nan"), "a")], "d double, s string")
    assert rows(aggs.null_profile(df)) == [("d", 2, 1, 50.0), ("s", 2, 1, 50.0)]


def test_no_task_holds_a_hot_key(spark):
    df = spark.range(4000).select(F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(F.lit(-1)).alias("k"), "id")
    held = win.ordered(df, ["k"], [F.col("id")], parts=8).filter("k = -1").groupBy(F.shiftright("_pos", win.SLICE_BITS)).count()
    assert held.agg(F.max("count")).first()[0] < 1000 and held.count() > 4
    assert rows(win.number_rows(df, ["k"], [F.col("id")]), "id", "row_number") == rows(
        df.withColumn("row_number", F.row_number().over(W.partitionBy("k").orderBy("id")).cast("bigint")), "id", "row_number"
    )


def test_ranks_many_equal_single_ranks(skewed):
    specs = [
        (["k"], "v", {"a": "rank", "b": "percent_rank"}, True), ([], "x", {"c": "dense_rank", "d": "cume_dist"}, False),
        (["k"], "v", {"e": "max_rank", "f": "average_rank"}, False),
    ]
    got, want = win.ranks_many(skewed, specs), skewed
    for keys, by, outputs, down in specs:
        want = win.ranks(want, keys, by, outputs, down)
    assert rows(got, "id", *"abcdef") == rows(want, "id", *"abcdef")
