"""Column expressions, delivery transforms, row rules and Python functions."""

import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import Observation, functions as F

from tests.conftest import rows
from tiffin.functions import columns as c, udfs
from tiffin.operators import aggs, quality as q
from tiffin.plans import restaurants as plans, users
from tiffin.streaming.delivery import actionable_alerts, delivery_measures, enrich_delivery, time_bucket, to_messages


def one(spark, ddl, values, column):
    df = spark.createDataFrame([(x,) for x in values], f"v {ddl}")
    return [r[0] for r in df.select(column).collect()]


def test_tiers_and_bands(spark):
    floors = [(4.5, "Excellent"), (4.0, "Very Good")]
    assert one(spark, "double", [4.5, 4.0, 3.9, None], c.tier("v", floors, "rest")) == ["Excellent", "Very Good", "rest", "rest"]
    assert one(spark, "double", [None], c.tier("v", floors, "rest", missing="Unknown")) == ["Unknown"]
    assert one(spark, "double", [50.0, 50.01, 25.0], c.above_tier("v", [(50, "H"), (25, "M")], "L")) == ["M", "H", "L"]
    right = c.band("v", [0, 2, 3], ["a", "b"], right=True)
    assert one(spark, "double", [0.0, 2.0, 2.1, 3.0, 3.1, None], right) == [None, "a", "b", "b", None, None]
    assert one(spark, "double", [0.0, 2.0, 9.0, -1.0], c.band("v", [0, 2], ["a", "b"], otherwise="x")) == ["a", "b", "b", "x"]


def test_written_gaps_are_kept(spark):
    very_good, good = F.col("v").between(4.0, 4.4), F.col("v").between(3.5, 3.9)
    assert one(spark, "double", [4.45, 3.95], very_good | good) == [False, False]


def test_exact_ratios(spark):
    df = spark.createDataFrame([(10.11,), (10.12,)], "v double")
    assert df.agg(c.mean("v")).first()[0] == 10.12  # 10.115 rounds up
    assert one(spark, "int", [0, 8], c.percent(F.lit(1), F.col("v"))) == [None, 12.5]
    assert one(spark, "int", [8], c.ratio(F.lit(-1), F.col("v"), 2)) == [-0.13]


def test_scores_with_missing_input(spark):
    df = spark.createDataFrame([(4.0, 4000), (None, 10), (4.0, None)], "r double, n int")
    assert [x[0] for x in df.select(c.popularity("r", "n")).collect()] == [8.0, 0.0, 0.0]


def test_phone_forms(spark):
    phone = "+1 (234) 567-8901"
    assert one(spark, "string", [phone], c.strip_phone("v")) == ["+12345678901"]
    assert one(spark, "string", [phone], c.strip_phone_signs("v")) == ["1 234 5678901"]
    assert one(spark, "string", ["(12)345", None], c.hyphen_phone("v")) == ["12-345", None]


def test_text_helpers(spark):
    assert one(spark, "string", ["A@B.Com", None], c.email_domain("v")) == ["b.com", None]
    assert one(spark, "string", ["a", None], c.full_name("v", F.lit("z"))) == ["a z", None]
    groups = [("Lead", ["Diretor", "Gerente"]), ("Work", ["Analista"])]
    assert one(spark, "string", ["Gerente Jr", "Analista", "Chef", None], c.keyword_group("v", groups, "Other", "Unknown")) == [
        "Lead", "Work", "Other", "Unknown"
    ]


def test_row_hash_tells_null_from_text(spark):
    df = spark.createDataFrame([("a", None), ("a", ""), ("a", "n"), (None, "a")], "x string, y string")
    assert df.select(c.row_hash("x", "y")).distinct().count() == 4


def test_haversine(spark):
    place = lambda x: F.lit(float(x))
    km = one(spark, "int", [1], c.haversine_km(place(-23.5505), place(-46.6333), place(-22.9068), place(-43.1729)))[0]
    assert km == pytest.approx(360.75, abs=0.1)


def test_age_groups(spark):
    days = [None, dt.date(2004, 1, 1), dt.date(1950, 1, 1), dt.date(2015, 1, 1)]
    got = one(spark, "date", days, users.age_group("v", F.lit("2024-06-01").cast("date")))
    assert got == ["Unknown", "18-25 (Young Adults)", "65+ (Seniors)", "Unknown"]


@pytest.fixture
def joined(spark):
    ts = lambda m: dt.datetime(2024, 1, 1, 12, 0) + dt.timedelta(minutes=m)
    return spark.createDataFrame(
        [
            ("o1", 50.0, ts(0), "Preparing", ts(60), "d"), ("o2", 50.0, ts(0), "Delivered", ts(60), "d"), ("o3", 50.0, ts(0), None, None, "d"),
            ("o4", 5.0, ts(0), "Preparing", ts(60), "d"), ("o5", 50.0, ts(0), "Preparing", ts(200), "d"), ("o6", 50.0, ts(0), "Preparing", ts(45), "d"),
        ],
        "order_id string, total_amount double, order_event_time timestamp, current_status string, status_event_time timestamp, driver_key string",
    )


def test_unmatched_order_is_neither_delivered_nor_pending(joined):
    enriched = enrich_delivery(joined)
    alone = enriched.filter("order_id = 'o3'").first()
    assert (alone.is_delivered, alone.is_delayed, alone.event_severity, alone.delivery_time_minutes) == (None, False, "NORMAL", None)
    got = enriched.agg(*[m.alias(n) for n, m in delivery_measures().items()]).first()
    assert (got.order_count, got.completed_orders, got.pending_orders, got.delayed_orders) == (6, 1, 4, 5)


def test_alerts_need_all_conditions(joined):
    assert rows(actionable_alerts(enrich_delivery(joined)), "order_id") == [("o1",)]


def test_exactly_45_minutes_is_slow(joined):
    enriched = enrich_delivery(joined).filter("order_id = 'o6'")
    assert enriched.select(time_bucket()).first()[0] == "Slow (>45min)"


def test_messages(joined):
    got = to_messages(joined.filter("order_id = 'o1'"), "order_id", ["order_id", "total_amount"]).first()
    assert (got.key, got.value) == ("o1", '{"order_id":"o1","total_amount":50.0}')


def test_rules(spark):
    df = spark.createDataFrame([(1, 5), (2, None), (3, 50)], "id int, v int")
    rules = [q.Rule("small", "v < 10"), q.Rule("warned", "id < 3", q.WARN)]
    seen = Observation("rules")
    assert rows(q.expect(df, rules, seen), "id") == [(1,)]
    assert seen.get == {"rows": 3, "small": 2, "warned": 1}
    assert rows(q.expect(df, [q.Rule("small", "v < 10", null_passes=True)]), "id") == [(1,), (2,)]
    assert rows(q.rule_report(df, rules)) == [("small", "drop", 2, 3), ("warned", "warn", 1, 3)]
    assert rows(q.broken_rows(df, rules).select("id", F.array_join("broken_rules", ","))) == [(2, "small"), (3, "small,warned")]
    with pytest.raises(PySparkException, match="row breaks rule strict"):
        q.expect(df, [q.Rule("strict", "v < 10", q.FAIL)]).collect()


def test_validators(spark):
    df = spark.createDataFrame([(1, None)], "id int, v int")
    with pytest.raises(q.QualityError):
        q.validate_no_nulls(df, ["id", "v", "not there"])
    with pytest.raises(q.QualityError):
        q.validate_rows(df, 2)
    with pytest.raises(q.QualityError):
        q.validate_schema(df.drop("v"), df.schema)
    with pytest.raises(q.QualityError):
        q.validate_schema(df.withColumn("v", F.lit("x")), df.schema)
    assert q.validate_schema(df.withColumn("v", F.lit("x")), df.schema, types=False) is not None


def test_row_counts_come_with_the_action(spark):
    counted, seen = q.count_rows(spark.range(10), "ten")
    assert counted.filter("id > 7").count() == 2
    assert seen.get["rows"] == 10


def test_udf_equals_builtin(spark):
    df = spark.createDataFrame([(4.6,), (4.5,), (1.0,), (None,)], "v double")
    floors = [(4.5, "Excellent"), (4.0, "Very Good")]
    assert df.select(udfs.same_label("v", floors, "rest").alias("s")).filter("NOT s").count() == 0


def test_weighted_mean_forms_agree(spark):
    df = spark.createDataFrame([("a", 4.0, 10), ("a", 2.0, 30), ("b", 5.0, 0)], "k string, r double, w int")
    pandas = {r.k: r.m for r in udfs.weighted_mean_pandas(df, "k", "r", "w", "m").collect()}
    assert pandas == {"a": 2.5, "b": 0.0}
    assert df.filter("k = 'a'").agg(aggs.weighted_mean("r", "w")).first()[0] == 2.5


def test_city_summary_weighting(spark):
    dim = spark.createDataFrame([(1, "x"), (2, "x")], "restaurant_id int, city string")
    ratings = spark.createDataFrame([(1, 4.0, 7), (1, 2.0, 8), (1, 2.0, 8)], "restaurant_id int, rating double, rating_id int")
    stock = spark.createDataFrame([(1, 10.0), (2, 40.0)], "restaurant_id int, v double").withColumn("inventory_value", c.money("v"))
    written = plans.city_summary(dim, ratings, stock).first()
    once = plans.city_summary(dim, ratings, stock, pre_aggregate=True).first()
    assert (written.avg_inventory_value, once.avg_inventory_value) == (17.5, 25.0)  # (3 * 10 + 40) / 4, (10 + 40) / 2
    assert written.total_ratings == once.total_ratings == 2


def test_distinct_dimension_is_not_latest(spark):
    silver = spark.createDataFrame([(1, "old", 1), (1, "new", 2)], "restaurant_id int, name string, at int")
    assert plans.distinct_dimension(silver, "restaurant_id").count() == 2
    assert rows(plans.latest_dimension(silver, "restaurant_id", [F.col("at")]), "name") == [("new",)]


def test_general_figures_keep_all_digits(spark):
    fractions = spark.createDataFrame([(10.0, 0.4), (20.0, 0.6), (None, 5.0)], "v double, w double")
    assert abs(fractions.agg(aggs.weighted_mean("v", "w")).first()[0] - 16.0) < 1e-9
    fine = spark.createDataFrame([(1.0004,), (2.0046,), (3.0049,)], "v double")
    assert abs(aggs.describe(fine, ["v"]).first()["mean_value"] - 2.0033) < 1e-9
    huge = spark.createDataFrame([(1e17,), (3e17,)], "v double")
    assert aggs.describe(huge, ["v"]).first()["mean_value"] == 2e17
