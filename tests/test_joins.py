import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import plan, rows
from tiffin.operators import joins


def test_salted_join_equals_plain_join(spark):
    rng = random.Random(1)
    facts = spark.createDataFrame([(i, "hot" if i % 3 else rng.choice("abc")) for i in range(200)], "id int, k string")
    names = spark.createDataFrame([("hot", 1), ("hot", 2), ("a", 3), ("zz", 4)], "k string, n int")
    want = rows(facts.join(names, "k"), "id", "k", "n")
    for options in ({"hot": ["hot"]}, {"hot": []}, {"share": 0.3}, {"hot": ["hot", "a", "missing"]}):
        got = joins.salted_join(facts, names, "k", salts=5, salt_by=["id"], **options)
        assert rows(got, "id", "k", "n") == want


def test_salted_left_join_keeps_unmatched_and_null_keys(spark):
    facts = spark.createDataFrame([(1, "hot"), (2, "hot"), (3, "a"), (4, None), (5, "none")], "id int, k string")
    names = spark.createDataFrame([("a", 3), ("b", 4)], "k string, n int")
    want = rows(facts.join(names, "k", "left"), "id", "k", "n")
    for hot in (["hot"], ["a", "hot"], []):
        assert rows(joins.salted_join(facts, names, "k", salts=3, hot=hot, how="left"), "id", "k", "n") == want
    with pytest.raises(ValueError):
        joins.salted_join(facts, names, "k", how="full")


def test_hot_keys_are_found_by_share(spark):
    df = spark.createDataFrame([("h",)] * 8 + [("a",), ("b",)], "k string")
    assert joins.hot_keys(df, "k", 0.5) == ["h"]


@pytest.mark.parametrize("parts", [1, 4, 7])
@pytest.mark.parametrize("how", ["inner", "left"])
def test_interval_join_equals_brute_force(spark, how, parts):
    rng = random.Random(3)
    base = 1_700_000_000
    left = [(i, rng.randint(0, 2), base + rng.randint(-400, 400)) for i in range(40)]
    right = [(i, rng.randint(0, 2), base + rng.randint(-400, 400)) for i in range(60)] + [(99, 0, left[0][2])]
    a = spark.createDataFrame(left, "id int, k int, s bigint").select("id", "k", F.timestamp_seconds("s").alias("t"))
    b = spark.createDataFrame(right, "rid int, rk int, rs bigint").select("rid", "rk", F.timestamp_seconds("rs").alias("rt"))
    got = rows(joins.interval_join(a, b, ("k", "rk"), ("t", "rt"), 60, how, parts), "id", "rid")
    want = []
    for i, k, s in left:
        hits = [(i, j) for j, rk, rs in right if rk == k and s <= rs <= s + 60]
        want += hits or ([(i, None)] if how == "left" else [])
    assert got == sorted(want, key=lambda r: (r[0], r[1] is not None, r[1] or 0))


def test_sub_buckets_spread_a_hot_key(spark):
    """A key with a third of the rows, all within one interval: more parts cut its largest bucket."""
    times = F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") % 7000)
    rows_ = spark.range(30_000).select("id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), times.alias("t"))
    a, b = rows_, rows_.select(F.col("id").alias("rid"), F.col("k").alias("rk"), F.col("t").alias("rt")).where("rid % 10 = 0")
    largest, counts = [], set()
    for parts in (1, 4):
        joined = joins.interval_join(a, b, ("k", "rk"), ("t", "rt"), 7200, "left", parts)
        counts.add(joined.count())
        width = -(-7200 * 1_000_000 // parts)
        largest.append(a.groupBy("k", F.floor(F.unix_micros("t") / width)).count().agg(F.max("count")).first()[0])
    assert len(counts) == 1 and largest[1] < largest[0] / 2


def test_interval_join_before_the_epoch(spark):
    a = spark.createDataFrame([(1, 1, -90), (2, 1, -10)], "id int, k int, s bigint").select("id", "k", F.timestamp_seconds("s").alias("t"))
    b = spark.createDataFrame([(1, -30), (1, 20)], "rk int, rs bigint").select("rk", F.col("rs").alias("r"), F.timestamp_seconds("rs").alias("rt"))
    assert rows(joins.interval_join(a, b, ("k", "rk"), ("t", "rt"), 60), "id", "r") == [(1, -30), (2, 20)]


def test_partners_beyond_equals_self_join(spark):
    rng = random.Random(9)
    data = [(i, rng.choice("ab"), rng.choice([None, *range(0, 30, 3)])) for i in range(60)]
    df = spark.createDataFrame(data, "id int, k string, v int")
    got = {r.id: (r.partners_below, r.partners_above) for r in joins.partners_beyond(df, ["k"], "v", 6).collect()}
    for i, k, v in data:
        if v is None:
            assert i not in got
            continue
        others = [w for j, l, w in data if l == k and w is not None]
        assert got[i] == (sum(w < v - 6 for w in others), sum(w > v + 6 for w in others))


def test_unify_sources_precedence(spark):
    a = spark.createDataFrame(
        [("1", "old", "p1", 1, "x@a"), ("1", "new", None, 2, "y@a"), ("2", "only-a", "p2", 5, None), (None, "n", "n", 1, "n")],
        "cpf string, name string, phone string, at int, mail string",
    )
    b = spark.createDataFrame([("1", "p9", 7, "cook"), ("3", "p3", None, "chef")], "cpf string, phone string, at int, job string")
    got = joins.unify_sources(a, b, "cpf", ([F.col("at")], [F.col("at")]), prefer_first=["phone"], newest="at")
    assert rows(got, "cpf", "name", "phone", "at", "mail", "job") == [
        ("1", "new", "p9", 7, "y@a", "cook"), ("2", "only-a", "p2", 5, None, None), ("3", None, "p3", None, None, "chef"),
    ]


def test_unify_sources_wants_a_rule_for_shared_columns(spark):
    a = spark.createDataFrame([("1", 1)], "k string, x int")
    with pytest.raises(ValueError):
        joins.unify_sources(a, a, "k", ([F.col("x")], [F.col("x")]))


def test_best_rows_keeps_ties(spark):
    df = spark.createDataFrame([("a", 1, 5), ("a", 2, 5), ("a", 3, 4), ("b", 4, None)], "k string, id int, v int")
    assert rows(joins.best_rows(df, ["k"], "v"), "id") == [(1,), (2,)]


def test_snapshot_changes_and_null(spark):
    old = spark.createDataFrame([(1, "a"), (2, None), (3, "c"), (4, "d")], "id int, s string")
    new = spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (4, "x"), (5, "n")], "id int, s string")
    plain = joins.snapshot_changes(new, old, "id", {"s": "S"}, "NEW")
    safe = joins.snapshot_changes(new, old, "id", {"s": "S"}, "NEW", null_safe=True)
    assert rows(plain, "id", "change_type") == [(4, "S"), (5, "NEW")]
    assert rows(safe, "id", "change_type") == [(2, "S"), (3, "S"), (4, "S"), (5, "NEW")]


def test_lookup_without_entry_is_null(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    assert rows(joins.lookup(df, "k", {"a": "A"}, "o"), "k", "o") == [(None, None), ("a", "A"), ("b", None)]


def test_city_match_equals_pairs(spark):
    left = spark.createDataFrame([("x", 1), ("x", 2), ("y", 3)], "city string, u int")
    right = spark.createDataFrame([("x", 7, 4.0), ("x", 8, 5.0), ("z", 9, 1.0)], "city string, r int, v double")
    assert rows(joins.city_match(left, right, "city", "u", "r", "v")) == [("x", 2, 2, 1.0, 4.5)]


@pytest.mark.parametrize("how", ["inner", "left"])
def test_salted_join_reads_each_side_once(spark, how):
    left = spark.createDataFrame([(None if i % 10 == 9 else 1 if i % 3 else i, i) for i in range(300)], "k int, v int")
    right = spark.createDataFrame([(1, "a"), (1, "b"), (3, "c"), (None, "n")], "k int, w string")
    got = joins.salted_join(left, right, "k", salts=4, share=0.1, how=how)
    assert rows(got, "k", "v", "w") == rows(left.join(right, "k", how), "k", "v", "w")
    assert "Union" not in plan(got)
    with pytest.raises(ValueError):
        joins.salted_join(left, right, "k", hot=list(range(joins.MOST_HOT + 1)))
    with pytest.raises(ValueError):
        joins.hot_keys(left, "k", share=1e-6)
