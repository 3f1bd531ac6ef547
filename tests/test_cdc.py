"""Change feeds against a plain Python model, in any order and with duplicates."""

import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tiffin.operators import cdc

DDL = "k string, seq int, op string, city string, note string"


def feed(seed, n=120):
    rng = random.Random(seed)
    keys = ["hot"] * 6 + ["a", "b", "c"]
    return [
        (rng.choice(keys), i, rng.choice(["U", "U", "U", "D"]), rng.choice(["x", "y", None]), rng.choice(["p", "q", None])) for i in range(n)
    ]


def model_scd2(changes):
    out, by_key = [], {}
    for row in sorted(changes, key=lambda r: r[1]):
        by_key.setdefault(row[0], []).append(row)
    for key, items in by_key.items():
        open_version = None
        for _, seq, op, city, note in items:
            if op == "D":
                if open_version:
                    out.append((*open_version, seq))
                open_version = None
            elif open_version and open_version[1] == city:
                open_version = (key, city, note, open_version[3])
            else:
                if open_version:
                    out.append((*open_version, seq))
                open_version = (key, city, note, seq)
        if open_version:
            out.append((*open_version, None))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_scd2_in_any_order(spark, seed):
    changes = feed(seed)
    shuffled = changes + changes[::3]  # duplicated rows
    random.Random(seed + 10).shuffle(shuffled)
    got = cdc.scd2(spark.createDataFrame(shuffled, DDL), ["k"], "seq", ["city"], F.col("op") == "D", exclude=["op"])
    want = spark.createDataFrame(model_scd2(changes), "k string, city string, note string, s int, e int")
    assert rows(got, "k", "city", "note", "__START_AT", "__END_AT") == rows(want)


@pytest.mark.parametrize("seed", [3, 4])
def test_scd1_in_any_order(spark, seed):
    changes = feed(seed)
    shuffled = changes + changes[::2]
    random.Random(seed).shuffle(shuffled)
    df = spark.createDataFrame(shuffled, DDL)
    last, known = {}, {}
    for key, _, op, city, note in changes:
        last[key] = (op, city, note)
        state = known.get(key, (None, None))
        known[key] = None if op == "D" else tuple(n if n is not None else o for n, o in zip((city, note), state or (None, None)))
    plain = cdc.scd1(df, ["k"], "seq", F.col("op") == "D", exclude=["op"])
    keep = cdc.scd1(df, ["k"], "seq", F.col("op") == "D", exclude=["op"], ignore_nulls=True)
    assert {r.k: (r.city, r.note) for r in plain.collect()} == {k: v[1:] for k, v in last.items() if v[0] != "D"}
    assert {r.k: (r.city, r.note) for r in keep.collect()} == {k: v for k, v in known.items() if v is not None}


def test_delete_wins_at_equal_sequence(spark):
    df = spark.createDataFrame([("a", 1, "U", "x", "p"), ("a", 1, "D", "x", "p")], DDL)
    assert cdc.scd1(df, ["k"], "seq", F.col("op") == "D").count() == 0


def test_scd2_gap_after_delete_and_reinsert(spark):
    df = spark.createDataFrame([("a", 1, "U", "x", None), ("a", 3, "D", None, None), ("a", 7, "U", "x", None)], DDL)
    got = cdc.scd2(df, ["k"], "seq", ["city"], F.col("op") == "D", exclude=["op"])
    assert rows(got, "__START_AT", "__END_AT") == [(1, 3), (7, None)]
    at = lambda t: cdc.as_of(got, F.lit(t)).count()
    assert [at(0), at(1), at(2), at(3), at(6), at(7)] == [0, 1, 1, 0, 0, 1]


def test_scd2_apply_closes_and_inserts_in_one_pass(spark):
    target = spark.createDataFrame(
        [(1, "a", 5, True, "2024-01-01", None), (2, "b", 5, True, "2024-01-01", None), (1, "z", 5, False, "2023-01-01", "2024-01-01")],
        "id int, s string, extra int, is_current boolean, start_date string, end_date string",
    )
    updates = spark.createDataFrame([(1, "A"), (2, "b"), (3, None)], "id int, s string")
    got = cdc.scd2_apply(target, updates, ["id"], ["s"], F.lit("2024-02-01"))
    assert rows(got, "id", "s", "is_current", "start_date", "end_date") == sorted([
        (1, "z", False, "2023-01-01", "2024-01-01"), (1, "a", False, "2024-01-01", "2024-02-01"), (1, "A", True, "2024-02-01", None),
        (2, "b", True, "2024-01-01", None), (3, None, True, "2024-02-01", None),
    ], key=lambda r: (r[0], r[1] is not None, r[1] or ""))


def test_field_changes_plain_and_null_safe(spark):
    df = spark.createDataFrame(
        [(1, 1, "a", "p"), (1, 2, "b", "p"), (1, 3, None, "p"), (1, 4, "c", "p"), (2, 1, None, "p"), (2, 2, "d", "q")],
        "id int, at int, mail string, city string",
    )
    order = [F.col("at")]
    plain = cdc.field_changes(df, "id", order, {"mail": "Mail", "city": "City"}, keep=["at"])
    safe = cdc.field_changes(df, "id", order, {"mail": "Mail", "city": "City"}, keep=["at"], null_safe=True)
    assert rows(plain, "id", "at", "mail_change", "city_change") == [(1, 2, 'Mail: "a" → "b"', None)]
    assert [r[:2] for r in rows(safe, "id", "at")] == [(1, 2), (1, 3), (1, 4), (2, 2)]
    assert rows(safe.filter("at = 3"), "mail_change") == [('Mail: "b" → "NULL"',)]


def test_unwrap_envelope_uses_the_newer_image(spark):
    image = "struct<id:string,email:string>"
    df = spark.createDataFrame(
        [(1, "c", (None, ("1", "a@x"))), (2, "u", (("1", "a@x"), ("1", "b@x"))), (3, "d", (("1", "b@x"), None))],
        f"seq int, op string, payload struct<before:{image},after:{image}>",
    )
    assert rows(cdc.unwrap_cdc(df), "seq", "operation", "id", "email") == [
        (1, "INSERT", "1", "a@x"), (2, "UPDATE", "1", "b@x"), (3, "DELETE", "1", "b@x")
    ]


def test_append_snapshot_marks_only_the_newest_current(spark):
    state = spark.createDataFrame([(1, "a")], "id int, s string")
    history = cdc.stamp_snapshot(state, F.lit("2024-01-01").cast("date"))
    for day in ("2024-01-02", "2024-01-03"):
        history = cdc.append_snapshot(history, state, F.lit(day).cast("date"))
    assert history.count() == 3 and rows(history.filter("is_current").select(F.col("start_date").cast("string"))) == [("2024-01-03",)]


def test_audit_trail_kinds(spark):
    df = spark.createDataFrame([(1, 1, None), (1, 2, None), (1, 3, "x")], "id int, at int, s string")
    assert rows(cdc.audit_trail(df, "id", [F.col("at")], ["s"], ["at"]), "at", "change_kind") == [
        (1, "Initial"), (2, "Unchanged"), (3, "Changed")
    ]


def test_scd2_apply_with_several_updates_of_one_key(spark):
    target = spark.createDataFrame([(1, "a", True, "2024-01-01", None)], "id int, s string, is_current boolean, start_date string, end_date string")
    updates = spark.createDataFrame([(1, "b", 1), (1, "c", 2)], "id int, s string, seq int")
    got = cdc.scd2_apply(target, updates, ["id"], ["s"], F.lit("2024-02-01"), seq="seq")
    assert rows(got, "s", "is_current") == [("a", False), ("c", True)]
    with pytest.raises(Exception, match="more than one source row"):
        cdc.scd2_apply(target, updates.drop("seq"), ["id"], ["s"], F.lit("2024-02-01")).collect()
