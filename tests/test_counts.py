"""Distinct counts, and the comparison of two states."""

import random

from pyspark.sql import functions as F

from tests.conftest import plan, rows
from tiffin.operators import aggs, cdc, versions


def test_distinct_counts_without_a_copy_per_count(spark):
    rng = random.Random(2)
    data = [(rng.choice(["hot", "hot", "b", None]), rng.choice([None, *range(9)]), rng.choice("xyz"), rng.randint(0, 9)) for _ in range(400)]
    df = spark.createDataFrame(data, "k string, m int, s string, v int")
    counted = {"members": "m", "big": ("m", F.col("v") > 6), "signs": "s"}
    got = aggs.distinct_counts(df, ["k"], counted, {"n": ("count", F.col("m")), "total": ("sum", F.col("v")), "top": ("max", F.col("v"))})
    want = []
    for k in {r[0] for r in data}:
        own = [r for r in data if r[0] == k]
        want.append((
            k, len({r[1] for r in own} - {None}), len({r[1] for r in own if r[3] > 6} - {None}), len({r[2] for r in own}),
            sum(r[1] is not None for r in own), sum(r[3] for r in own), max(r[3] for r in own),
        ))
    assert rows(got) == sorted(want, key=lambda r: (r[0] is not None, r[0] or ""))
    assert "Expand" not in plan(got) and "SortAggregate" not in plan(got)
    assert aggs.distinct_counts(df.limit(0), ["k"], counted).count() == 0


def test_reports_with_several_distinct_counts_have_no_expand(spark):
    df = spark.createDataFrame([("a", 1, "x", None), ("a", 1, "y", 2), ("b", 2, None, 3)], "k string, id int, f string, g int")
    filled = aggs.completeness(df, ["k"], "id", ["f", "g"])
    assert rows(filled, "k", "members", "with_f", "with_g") == [("a", 1, 1, 1), ("b", 1, 0, 1)]
    flags = cdc.activity_flags(df, "k", ["f", "g"], limit=1)
    assert rows(flags, "k", "f_variations", "g_variations", "activity_flag") == [("a", 2, 1, "High f changes")]
    assert all("Expand" not in plan(d) for d in (filled, flags))


def test_states_compared_as_multisets(spark):
    old = spark.createDataFrame([(1, "a"), (1, "a"), (1, "a"), (2, None), (3, "c")], "id int, v string")
    new = spark.createDataFrame([(1, "a"), (2, None), (2, None), (4, "d")], "id int, v string")
    got = dict(rows(versions.compare_versions(old, new)))
    assert got == {"old": 5, "new": 4, "only in new": 2, "only in old": 3}
    text = plan(versions.compare_versions(old, new))
    assert "Except" not in text and dict(rows(versions.compare_versions(old.limit(0), new.limit(0)))) == {"old": 0, "new": 0, "only in new": 0, "only in old": 0}
