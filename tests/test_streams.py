"""Streams over files that arrive in steps."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tiffin.operators.joins import interval_join
from tiffin.sources.files import stream_files
from tiffin.streaming import folders, streams as st

DDL = "id int, k string, ts timestamp"


def at(minutes):
    return dt.datetime(2024, 1, 1) + dt.timedelta(minutes=minutes)


def arrive(spark, folder, data, ddl=DDL):
    spark.createDataFrame(data, ddl).coalesce(1).write.mode("append").parquet(folder)


def test_late_rows_are_dropped_and_open_windows_wait(spark, tmp_path):
    source, sink, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))

    def run():
        stream = stream_files(spark, source, DDL).withWatermark("ts", "10 minutes")
        st.append_files(st.windowed(stream, "ts", "10 minutes", {"n": F.count("*")}, ["k"]), sink, checkpoint)
        return rows(spark.read.schema("k string, window_start timestamp, n bigint").parquet(sink), "k", "window_start", "n")

    arrive(spark, source, [(1, "a", at(1)), (2, "a", at(2)), (3, "a", at(50))])
    assert run() == [("a", at(0), 2)]  # the window of minute 50 is still open
    arrive(spark, source, [(4, "a", at(3)), (5, "a", at(55))])  # minute 3 comes too late
    assert run() == [("a", at(0), 2)]
    arrive(spark, source, [(6, "a", at(200))])
    assert run() == [("a", at(0), 2), ("a", at(50), 2)]


@pytest.mark.parametrize("how, parts", [("inner", 1), ("left", 1), ("left", 4)])
def test_stream_join_equals_batch_join(spark, tmp_path, how, parts):
    left, right, sink, checkpoint = (str(tmp_path / n) for n in ("l", "r", "out", "cp"))
    orders = [(i, "hot" if i % 2 else "b", at(i * 7)) for i in range(30)]
    status = [(100 + i, "hot" if i % 3 else "b", at(i * 11 + 5)) for i in range(30)]
    flush = at(3000)

    def run():
        a = stream_files(spark, left, DDL)
        b = stream_files(spark, right, DDL).select(F.col("id").alias("rid"), F.col("k").alias("rk"), F.col("ts").alias("rts"))
        st.append_files(st.stream_interval_join(a, b, ("k", "rk"), ("ts", "rts"), 1800, "10 minutes", how, parts), sink, checkpoint)

    for half in (slice(0, 15), slice(15, 30)):  # each step brings newer rows only
        arrive(spark, left, orders[half])
        arrive(spark, right, status[half])
        run()
    arrive(spark, left, [(-1, "flush", flush)])
    arrive(spark, right, [(-2, "flush", flush)])
    run()
    a = spark.createDataFrame(orders, DDL)
    b = spark.createDataFrame(status, "rid int, rk string, rts timestamp")
    want = rows(interval_join(a, b, ("k", "rk"), ("ts", "rts"), 1800, how), "id", "rid")
    assert rows(spark.read.parquet(sink).filter("id >= 0"), "id", "rid") == want


def test_restart_reads_only_new_files(spark, tmp_path):
    source, sink, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))
    for step in range(3):
        arrive(spark, source, [(step, "a", at(step))])
        st.append_files(stream_files(spark, source, DDL), sink, checkpoint)
        st.append_files(stream_files(spark, source, DDL), sink, checkpoint)  # nothing new
    assert rows(spark.read.parquet(sink), "id") == [(0,), (1,), (2,)]


def test_running_totals_over_batches(spark, tmp_path):
    source, sink, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))
    for data in ([(1, "a", at(0)), (2, "b", at(0))], [(3, "a", at(1))]):
        arrive(spark, source, data)
        totals = stream_files(spark, source, DDL).groupBy("k").agg(F.count("*").alias("n"))
        st.update_files(totals, sink, checkpoint)
    assert rows(st.latest_groups(spark, sink, ["k"])) == [("a", 2), ("b", 1)]
    arrive(spark, source, [(4, "b", at(2))])
    st.update_files(totals, sink, checkpoint, ["k"], settle_every=1)
    assert rows(st.latest_groups(spark, sink, ["k"])) == [("a", 2), ("b", 2)]


def test_state_ignores_late_older_changes(spark, tmp_path):
    source, sink, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))
    ddl = "k string, seq int, op string, v int"
    steps = [[("a", 5, "U", 50), ("b", 9, "D", None)], [("a", 3, "U", 30), ("b", 4, "U", 40)], [("c", 1, "U", 10), ("a", 6, "U", 60)]]
    for data in steps:
        arrive(spark, source, data, ddl)
        st.merge_state(stream_files(spark, source, ddl), sink, checkpoint, ["k"], "seq", F.col("op") == "D")
    want = [("a", 60), ("c", 10)]
    assert rows(st.current_state(spark, sink, ["k"], "seq"), "k", "v") == want


def test_folders_stay_few_and_a_kill_between_write_and_switch_changes_nothing(spark, tmp_path):
    """Twenty batches settled by threes; the generation of a killed run has no ``_SUCCESS`` yet."""
    import shutil

    sink, totals = str(tmp_path / "out"), {}
    newest = lambda r: st.newest_groups(r, ["k"])
    for batch in range(20):
        changed = {f"k{batch % 4}": batch, f"k{batch}": batch}
        totals.update(changed)
        data = spark.createDataFrame(list(changed.items()), "k string, n int")
        for _ in range(2 if batch % 5 == 0 else 1):  # some batches run again
            data.coalesce(1).write.mode("overwrite").parquet(folders.batch_folder(sink, batch))
        folders.settle_now_and_then(spark, sink, batch, 3, newest)
        assert rows(st.latest_groups(spark, sink, ["k"])) == sorted(totals.items())
        assert len(folders.numbered_folders(spark, sink, "batch_id")) <= 6 and len(folders.numbered_folders(spark, f"{sink}/_settled", "upto")) <= 2
    folders.settle(spark, sink, 19, newest)
    before = rows(st.latest_groups(spark, sink, ["k"]))
    # A run that ends before its job's last step leaves the folder without the mark; the same settling runs again later.
    (tmp_path / "out/_settled/upto=19/_SUCCESS").unlink()
    shutil.copytree(tmp_path / "out/batch_id=19", tmp_path / "out/batch_id=20")
    assert folders.numbered_folders(spark, f"{sink}/_settled", "upto", finished=True) == [17]
    assert rows(st.latest_groups(spark, sink, ["k"])) == before
    folders.settle(spark, sink, 20, newest)
    assert rows(st.latest_groups(spark, sink, ["k"])) == before
    assert folders.written(spark, str(tmp_path / "nothing")) is None


def test_late_changes_open_and_split_versions(spark, tmp_path):
    """Versions kept over batches in any order equal the batch form over all changes so far."""
    import random

    from tiffin.operators.cdc import scd2
    from tiffin.streaming.history import keep_versions, versions

    rng, ddl = random.Random(8), "k string, seq int, op string, v int, w int"
    source, sink, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))
    changes = [(rng.choice(["hot", "hot", "a", "b", None]), i, rng.choice(["U", "U", "U", "D"]), rng.choice([1, 2, None]), i) for i in range(60)]
    changes += [("gone", 100, "U", 1, 1), ("split", 10, "U", 1, 1), ("split", 30, "U", 1, 3)]
    rng.shuffle(changes)
    batches = [changes[:25], changes[25:60], [*changes[60:], ("gone", 100, "D", None, 2)], [("split", 20, "U", 2, 2), changes[0]]]
    seen = []
    for data in batches:
        arrive(spark, source, data, ddl)
        seen += data
        keep_versions(stream_files(spark, source, ddl), sink, checkpoint, ["k"], "seq", ["v"], F.col("op") == "D", ["op"], buckets=4, settle_every=2)
        want = scd2(spark.createDataFrame(seen, ddl), ["k"], "seq", ["v"], F.col("op") == "D", ["op"])
        columns = ["k", "v", "w", "__START_AT", "__END_AT"]
        assert rows(versions(spark, sink, ["k"]), *columns) == rows(want, *columns)
    final = rows(versions(spark, sink, ["k"]).where("k = 'split'"), "v", "__START_AT", "__END_AT")
    assert final == [(1, 10, 20), (1, 30, None), (2, 20, 30)]
    assert versions(spark, sink, ["k"]).where("k = 'gone'").count() == 0
    assert versions(spark, str(tmp_path / "empty"), ["k"]) is None


def test_sketches_of_windows_add_up(spark):
    from tiffin.operators.aggs import estimates, rolled_up, sketched

    data = spark.range(20_000).select((F.col("id") % 7).alias("k"), (F.col("id") % 5000).alias("v"), (F.col("id") % 48).alias("hour"))
    hours = sketched(data, ["k", "hour"], {"n": "v"})
    days = estimates(rolled_up(hours, ["k"], ["n"]), ["n"])
    direct = estimates(rolled_up(sketched(data, ["k"], {"n": "v"}), ["k"], ["n"]), ["n"])
    assert all(abs(a[1] - b[1]) <= 0.02 * b[1] for a, b in zip(rows(days), rows(direct), strict=True))
    exact = dict(rows(data.groupBy("k").agg(F.countDistinct("v"))))
    assert all(abs(n - exact[k]) <= 0.08 * exact[k] for k, n in rows(days))




def test_sliding_windows(spark):
    df = spark.createDataFrame([(1, "a", at(5)), (2, "a", at(12))], DDL)
    got = st.windowed(df, "ts", "10 minutes", {"n": F.count("*")}, slide="5 minutes")
    assert rows(got, "window_start", "n") == [(at(0), 1), (at(5), 2), (at(10), 1)]


def test_realtime_delivery_job(spark, tmp_path):
    """Two runs of the whole job; the second one brings the updates that close the first orders."""
    import json

    from tiffin.plans import realtime

    orders, status, base = tmp_path / "orders", tmp_path / "status", str(tmp_path / "job")
    orders.mkdir(), status.mkdir()

    def put(folder, name, items):
        (folder / name).write_text("\n".join(json.dumps(i) for i in items))

    def order(key, minute, amount=50.0, driver="d1"):
        return {"order_id": key, "user_key": "u", "restaurant_key": "r1", "driver_key": driver, "order_date": str(at(minute)),
                "total_amount": amount, "dt_current_timestamp": str(at(minute))}

    def update(number, key, name, minute, epoch=int):
        millis = epoch(at(minute).replace(tzinfo=dt.timezone.utc).timestamp() * 1000)
        return {"status_id": number, "order_identifier": key, "status": {"status_name": name, "timestamp": millis},
                "dt_current_timestamp": str(at(minute))}

    put(orders, "1.json", [order("late", 0), order("done", 1), order("alone", 2), order("cheap", 3, 5.0), order("bad", 3, -1.0)])
    put(status, "1.json", [
        update(1, "late", "Preparing", 60), update(2, "done", "Delivered", 20, float), update(3, "cheap", "Preparing", 70), update(4, "bad", "Preparing", 50),
    ])
    realtime.run(spark, str(orders), str(status), base)
    put(orders, "2.json", [order("flush", 1000, driver="d2")])
    put(status, "2.json", [update(5, "flush", "Delivered", 1001)])
    realtime.run(spark, str(orders), str(status), base)
    put(orders, "3.json", [order("end", 3000, driver="d2")])
    put(status, "3.json", [update(6, "end", "Delivered", 3001)])
    paths = realtime.run(spark, str(orders), str(status), base)

    silver = spark.read.parquet(paths["order_status"])
    assert rows(silver, "order_id", "current_status", "delivery_time_minutes", "is_delivered", "event_severity") == sorted([
        ("alone", None, None, None, "NORMAL"), ("cheap", "Preparing", 67.0, False, "CRITICAL"), ("done", "Delivered", 19.0, True, "CRITICAL"),
        ("end", "Delivered", 1.0, True, "INFO"), ("flush", "Delivered", 1.0, True, "INFO"), ("late", "Preparing", 60.0, False, "CRITICAL"),
    ])
    message = spark.read.parquet(paths["alerts_published"]).collect()
    assert [m.key for m in message] == ["late"]
    assert json.loads(message[0].value)["message"] == "Order late is delayed (60.0 minutes). Driver: d1"
    drivers = st.latest_groups(spark, paths["driver_performance"], ["driver_key"])
    assert rows(drivers, "driver_key", "order_count", "completed_orders", "pending_orders") == [("d1", 4, 1, 2), ("d2", 2, 2, 0)]
    buckets = st.latest_groups(spark, paths["time_distribution"], ["time_bucket"])
    assert rows(buckets, "time_bucket", "order_count") == [("Fast (15-30min)", 1), ("Slow (>45min)", 2), ("Very Fast (<15min)", 2)]
    health = spark.read.parquet(paths["system_health"])
    assert rows(health.filter(F.col("window_start") == at(0)), "order_count", "delayed_orders", "active_restaurants", "active_drivers") == [(4, 3, 1, 1)]
    daily = realtime.rolled_gold(health, "day", ["active_drivers"])
    assert rows(daily.filter(F.col("window_start") == at(0)), "order_count", "active_drivers") == [(5, 2)]


def test_silver_rules_work_on_a_stream(spark, tmp_path):
    from tiffin.plans.restaurants import silver_ratings

    source, sink, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))
    ddl = "restaurant_id int, rating int"
    arrive(spark, source, [(1, 5), (1, 9), (None, 3), (2, None)], ddl)
    st.append_files(silver_ratings(stream_files(spark, source, ddl), 0, 5), sink, checkpoint)
    assert rows(spark.read.parquet(sink)) == [(1, 5)]


def test_change_feeds_into_current_state_and_history(spark, tmp_path):
    from tiffin.plans import users

    one, two, base = (str(tmp_path / n) for n in ("one", "two", "job"))
    first, second = "cpf string, seq bigint, operation string, city string", "cpf string, seq bigint, operation string, job string"
    arrive(spark, one, [("a", 1, "INSERT", "x"), ("b", 2, "INSERT", "y")], first)
    arrive(spark, two, [("a", 3, "UPDATE", "cook")], second)
    run = lambda: users.run_feeds(
        stream_files(spark, one, first), stream_files(spark, two, second), base, "cpf", "seq", "operation", ["city", "job"], settle_every=2
    )
    paths = run()
    current = lambda: rows(st.current_state(spark, paths["current"], ["cpf"], "seq"), "cpf", "city", "job")
    assert current() == [("a", None, "cook"), ("b", "y", None)]  # the later source overwrites with NULL
    arrive(spark, one, [("b", 5, "DELETE", None), ("a", 4, "UPDATE", "z")], first)
    run()
    assert current() == [("a", "z", None)]
    staged = spark.read.parquet(paths["staging"])
    assert staged.count() == 5
    history = users.user_history(staged, "cpf", "seq", "operation", ["city", "job"])
    assert rows(history, "cpf", "__START_AT", "__END_AT") == [("a", 1, 3), ("a", 3, 4), ("a", 4, None), ("b", 2, 5)]
    from tiffin.streaming.history import versions

    assert rows(versions(spark, paths["history"], ["cpf"]), *history.columns) == rows(history)
