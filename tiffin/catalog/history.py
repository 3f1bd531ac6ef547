"""Change-data, history and quality queries (C*)."""

from pyspark.sql import functions as F

from tiffin.catalog import roles as r
from tiffin.catalog.joining import SNAPSHOTS, snapshots
from tiffin.catalog.registry import query
from tiffin.operators import cdc, joins, quality as q
from tiffin.session import scratch_path
from tiffin.sources import sinks
from tiffin.streaming.delivery import delivery_rules

STATE_SQL = r.with_ctes(SNAPSHOTS) + "SELECT * FROM new_s"
SEEN = ["ts", "event_id"]


def feed(t):
    """Events as a change feed per user: errors delete, everything else writes."""
    return t.events.select("user_id", F.col("event_id").alias("seq"), "event_type", "value")


DELETES = "event_type = 'error'"

SCD2_SQL = """ch AS (SELECT user_id, event_id AS seq, event_type, value, event_type = 'error' AS del FROM events),
l AS (SELECT *, lag(event_type) OVER w AS pt, lag(del) OVER w AS pd FROM ch WINDOW w AS (PARTITION BY user_id ORDER BY seq)),
s AS (SELECT *, CASE WHEN NOT del AND (pd IS NULL OR pd OR event_type <> pt) THEN 1 ELSE 0 END AS st FROM l),
v AS (SELECT *, sum(st) OVER (PARTITION BY user_id ORDER BY seq) AS ver FROM s),
g AS (SELECT user_id, ver, min(seq) FILTER (NOT del) AS start_at, min(seq) FILTER (del) AS del_at,
  arg_max(event_type, seq) FILTER (NOT del) AS event_type, arg_max(value, seq) FILTER (NOT del) AS value FROM v WHERE ver > 0 GROUP BY 1, 2),
h AS (SELECT user_id, event_type, value, start_at, coalesce(del_at, lead(start_at) OVER (PARTITION BY user_id ORDER BY ver)) AS end_at FROM g)"""


def history(t):
    return cdc.scd2(feed(t), ["user_id"], "seq", ["event_type"], F.expr(DELETES), start="start_at", end="end_at")


@query("c01_scd1", """
SELECT user_id, event_type, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM events)
WHERE rn = 1 AND event_type != 'error'""")
def c01(t):
    return cdc.scd1(feed(t), ["user_id"], "seq", F.expr(DELETES))


@query("c01_scd1_keep_known", """
WITH f AS (SELECT user_id, event_id, event_type, event_type = 'error' AS del, CASE WHEN event_type = 'purchase' THEN value END AS amount,
    CASE WHEN event_type = 'click' THEN props END AS props FROM events),
d AS (SELECT user_id, max(CASE WHEN del THEN event_id ELSE -1 END) AS last_del, max(event_id) AS last_id FROM f GROUP BY 1)
SELECT f.user_id, arg_max(amount, event_id) FILTER (amount IS NOT NULL AND event_id > last_del) AS amount,
  arg_max(props, event_id) FILTER (props IS NOT NULL AND event_id > last_del) AS props
FROM f JOIN d USING (user_id) WHERE last_id != last_del GROUP BY 1""")
def c01_keep(t):
    partial = t.events.select(
        "user_id", F.col("event_id").alias("seq"), "event_type",
        F.when(F.col("event_type") == "purchase", F.col("value")).alias("amount"),
        F.when(F.col("event_type") == "click", F.col("props")).alias("props"),
    )
    return cdc.scd1(partial, ["user_id"], "seq", F.expr(DELETES), exclude=["event_type"], ignore_nulls=True)


@query("c02_scd2", r.with_ctes(SCD2_SQL) + "SELECT * FROM h")
def c02(t):
    return history(t)


@query("c03_as_of", r.with_ctes(SCD2_SQL) + """
SELECT * FROM h WHERE start_at <= (SELECT max(event_id) / 2 FROM events) AND (end_at > (SELECT max(event_id) / 2 FROM events) OR end_at IS NULL)""")
def c03(t):
    middle = t.events.agg(F.max("event_id") / 2).scalar()
    return cdc.as_of(history(t), middle, "start_at", "end_at")


TIMED_SCD2 = SCD2_SQL.replace("event_id AS seq", "ts AS seq")


@query("c04_version_status", r.with_ctes(TIMED_SCD2) + """
SELECT user_id, event_type, start_at, end_at, CASE WHEN end_at IS NULL THEN 'CURRENT' ELSE 'HISTORICAL' END AS version_status,
  date_diff('day', CAST(start_at AS DATE), CAST(coalesce(end_at, TIMESTAMP '2024-02-15') AS DATE)) AS days_active FROM h""")
def c04(t):
    timed = t.events.select("user_id", F.col("ts").alias("seq"), "event_type", "value")
    rows = cdc.scd2(timed, ["user_id"], "seq", ["event_type"], F.expr(DELETES), start="start_at", end="end_at")
    return cdc.version_status(rows, F.lit("2024-02-15").cast("timestamp"), "start_at", "end_at").drop("value")


@query("c05_change_rate", r.with_ctes(SCD2_SQL) + f""",
cur AS (SELECT event_type, count(DISTINCT user_id) AS members FROM h WHERE end_at IS NULL GROUP BY 1),
rec AS (SELECT event_type, count(DISTINCT user_id) AS members_changed, count(*) AS changes FROM h
  WHERE start_at >= (SELECT max(event_id) * 0.9 FROM events) GROUP BY 1)
SELECT event_type, members, coalesce(members_changed, 0) AS members_changed, coalesce(changes, 0) AS changes,
  {r.pct_sql('coalesce(members_changed, 0)', 'members', 1)} AS change_rate_pct FROM cur LEFT JOIN rec USING (event_type)""")
def c05(t):
    rows = history(t)
    since = t.events.agg(F.max("event_id") * F.lit(0.9)).scalar()
    return cdc.change_rate_by_group(rows.filter(F.col("end_at").isNull()), rows, "event_type", "user_id", since, "start_at")


HISTORY3 = SNAPSHOTS + """,
hist AS (SELECT *, TIMESTAMP '2024-01-01' AS start_date FROM old_s UNION ALL SELECT *, TIMESTAMP '2024-01-08' FROM new_s
  UNION ALL SELECT id, segment, balance * 2, nation, TIMESTAMP '2024-01-15' FROM new_s WHERE nation < 20)"""


def three_snapshots(t):
    """Three snapshots of the customers, the last one with doubled balances and some customers gone."""
    old, new = snapshots(t)
    third = new.filter(F.col("nation") < 20).withColumn("balance", F.col("balance") * 2)
    stamp = lambda df, day: cdc.stamp_snapshot(df, F.lit(day).cast("timestamp"))
    return stamp(old, "2024-01-01").unionByName(stamp(new, "2024-01-08")).unionByName(stamp(third, "2024-01-15")).drop("is_current")


@query("c07_append_snapshot", r.with_ctes(SNAPSHOTS) + """
SELECT *, TIMESTAMP '2024-01-01' AS start_date, false AS is_current FROM old_s
UNION ALL SELECT *, TIMESTAMP '2024-01-08', true FROM new_s""")
def c07(t):
    old, new = snapshots(t)
    first = cdc.stamp_snapshot(old, F.lit("2024-01-01").cast("timestamp"))
    return cdc.append_snapshot(first, new, F.lit("2024-01-08").cast("timestamp"))


@query("c08_scd2_apply", r.with_ctes(SNAPSHOTS, """cmp AS (SELECT o.id AS oid, n.id AS nid, o.segment AS os, o.balance AS ob, o.nation AS onat,
  n.segment AS ns, n.balance AS nb, n.nation AS nn, (o.segment IS DISTINCT FROM n.segment OR o.balance IS DISTINCT FROM n.balance) AS diff
  FROM old_s o FULL JOIN new_s n ON o.id = n.id)""") + """
SELECT oid AS id, os AS segment, ob AS balance, onat AS nation, NOT (nid IS NOT NULL AND diff) AS is_current, DATE '2024-01-01' AS start_date,
  CASE WHEN nid IS NOT NULL AND diff THEN DATE '2024-02-01' END AS end_date FROM cmp WHERE oid IS NOT NULL
UNION ALL SELECT nid, ns, nb, nn, true, DATE '2024-02-01', NULL FROM cmp WHERE nid IS NOT NULL AND (oid IS NULL OR diff)""")
def c08(t):
    old, new = snapshots(t)
    target = old.withColumns({
        "is_current": F.lit(True), "start_date": F.lit("2024-01-01").cast("date"), "end_date": F.lit(None).cast("date")
    })
    return cdc.scd2_apply(target, new, ["id"], ["segment", "balance"], F.lit("2024-02-01").cast("date"))


@query("c09_field_changes", """
WITH l AS (SELECT user_id, event_id, event_type, props, lag(event_type) OVER w AS pe, lag(props) OVER w AS pp FROM events
  WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
SELECT user_id, event_id, CASE WHEN event_type <> pe THEN 'Type: "' || pe || '" → "' || event_type || '"' END AS event_type_change,
  CASE WHEN props <> pp THEN 'Props: "' || pp || '" → "' || props || '"' END AS props_change
FROM l WHERE pe IS NOT NULL AND (event_type <> pe OR props <> pp)""")
def c09(t):
    return cdc.field_changes(t.events, "user_id", SEEN, {"event_type": "Type", "props": "Props"}, keep=["event_id", "ts"]).drop("ts")


@query("c09_field_changes_null_safe", """
WITH x AS (SELECT user_id, event_id, ts, CASE WHEN event_type != 'error' THEN event_type END AS kind FROM events),
l AS (SELECT *, lag(kind) OVER w AS pk, row_number() OVER w AS rn FROM x WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
SELECT user_id, event_id, 'Kind: "' || coalesce(pk, 'NULL') || '" → "' || coalesce(kind, 'NULL') || '"' AS kind_change
FROM l WHERE rn > 1 AND kind IS DISTINCT FROM pk""")
def c09_null_safe(t):
    rows = t.events.select("user_id", "event_id", "ts", F.when(F.col("event_type") != "error", F.col("event_type")).alias("kind"))
    return cdc.field_changes(rows, "user_id", SEEN, {"kind": "Kind"}, keep=["event_id", "ts"], null_safe=True).drop("ts")


@query("c10_change_rates", f"""
WITH l AS (SELECT event_type <> lag(event_type) OVER w AS e, props <> lag(props) OVER w AS p, value <> lag(value) OVER w AS v FROM events
  WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
n AS (SELECT count(*) AS n, {r.n_if('e')} AS e, {r.n_if('p')} AS p, {r.n_if('v')} AS v FROM l)
SELECT f AS field_name, k AS total_changes, {r.pct_sql('k', 'n')} AS change_rate_pct FROM (
  SELECT 'event_type' AS f, e AS k, n FROM n UNION ALL SELECT 'props', p, n FROM n UNION ALL SELECT 'value', v, n FROM n)""")
def c10(t):
    return cdc.change_rates(t.events, "user_id", SEEN, ["event_type", "props", "value"], needed=["ts", "event_id"])


@query("c11_snapshot_diff", r.with_ctes(HISTORY3) + """
SELECT n.id, CASE WHEN o.id IS NULL THEN 'NEW USER' WHEN n.segment <> o.segment THEN 'SEGMENT CHANGED' ELSE 'BALANCE CHANGED' END AS change_type,
  o.segment AS old_segment, n.segment AS new_segment, o.balance AS old_balance, n.balance AS new_balance
FROM (SELECT * FROM hist WHERE start_date = TIMESTAMP '2024-01-15') n LEFT JOIN (SELECT * FROM hist WHERE start_date = TIMESTAMP '2024-01-08') o ON n.id = o.id
WHERE o.id IS NULL OR n.segment <> o.segment OR n.balance <> o.balance""")
def c11(t):
    current, previous = cdc.latest_two(three_snapshots(t))
    return joins.snapshot_changes(current, previous, "id", {"segment": "SEGMENT CHANGED", "balance": "BALANCE CHANGED"}, "NEW USER")


@query("c12_reconcile", r.with_ctes(HISTORY3) + """,
latest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY start_date DESC) AS rn FROM hist) WHERE rn = 1)
SELECT a.id, a.segment AS type1_segment, b.segment AS type2_segment, CASE WHEN a.segment = b.segment THEN 'match' ELSE 'MISMATCH' END AS segment_match,
  a.balance AS type1_balance, b.balance AS type2_balance, CASE WHEN a.balance = b.balance THEN 'match' ELSE 'MISMATCH' END AS balance_match
FROM new_s a JOIN latest b ON a.id = b.id WHERE a.segment <> b.segment OR a.balance <> b.balance""")
def c12(t):
    return cdc.reconcile(snapshots(t)[1], three_snapshots(t), "id", ["segment", "balance"], [F.col("start_date")])


@query("c12_reconcile_counts", r.with_ctes(HISTORY3) + """
SELECT 'type 1 current' AS table_name, count(DISTINCT id) AS user_count FROM new_s
UNION ALL SELECT 'type 2 latest snapshot', count(DISTINCT id) FROM hist WHERE start_date = (SELECT max(start_date) FROM hist)
UNION ALL SELECT 'type 2 all snapshots', count(*) FROM hist""")
def c12_counts(t):
    return cdc.reconcile_counts(snapshots(t)[1], three_snapshots(t), "id")


@query("c13_frequency", r.with_ctes(HISTORY3) + """
SELECT id, count(*) AS snapshot_count, min(start_date) AS first_seen, max(start_date) AS last_seen,
  date_diff('day', CAST(min(start_date) AS DATE), CAST(max(start_date) AS DATE)) AS days_tracked FROM hist GROUP BY id HAVING count(*) > 1""")
def c13(t):
    return cdc.snapshot_frequency(three_snapshots(t), "id")


@query("c13_timeline", """
SELECT CAST(ts AS DATE) AS snapshot_date, count(DISTINCT ts) AS snapshot_count, count(DISTINCT user_id) AS unique_users, count(*) AS total_records,
  min(ts) AS earliest, max(ts) AS latest FROM events GROUP BY 1""")
def c13_timeline(t):
    return cdc.snapshot_timeline(t.events, "user_id", "ts")


@query("c13_activity", r.with_ctes(HISTORY3) + """
SELECT id, count(*) AS appearances, count(DISTINCT segment) AS segment_variations, count(DISTINCT balance) AS balance_variations,
  CASE WHEN count(DISTINCT segment) > 1 THEN 'High segment changes' WHEN count(DISTINCT balance) > 1 THEN 'High balance changes' ELSE 'Normal' END AS activity_flag
FROM hist GROUP BY id HAVING count(*) > 1""")
def c13_activity(t):
    return cdc.activity_flags(three_snapshots(t), "id", ["segment", "balance"], limit=1)


@query("c14_audit_trail", """
SELECT event_id, user_id, event_type, lag(event_type) OVER w AS prev_event_type, CASE WHEN row_number() OVER w = 1 THEN 'Initial'
  WHEN event_type IS DISTINCT FROM lag(event_type) OVER w THEN 'Changed' ELSE 'Unchanged' END AS change_kind
FROM events WHERE user_id = 7 WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""")
def c14(t):
    one = t.events.filter(F.col("user_id") == 7)  # the report is about one key
    return cdc.audit_trail(one, "user_id", SEEN, ["event_type"], needed=["ts", "event_id"]).drop("ts")


@query("c15_unwrap_envelope", """
SELECT event_id AS seq, CASE event_type WHEN 'signup' THEN 'INSERT' WHEN 'error' THEN 'DELETE' ELSE 'UPDATE' END AS operation,
  user_id AS id, value FROM events""")
def c15(t):
    image = F.struct(F.col("user_id").alias("id"), "value")
    kind = F.col("event_type")
    envelope = t.events.select(
        F.col("event_id").alias("seq"), F.when(kind == "signup", "c").when(kind == "error", "d").otherwise("u").alias("op"),
        F.struct(F.when(kind != "signup", image).alias("before"), F.when(kind != "error", image).alias("after")).alias("payload"),
    )
    return cdc.unwrap_cdc(envelope)


RULES = [
    q.Rule("valid_key", "o_custkey IS NOT NULL"),
    q.Rule("positive_amount", "o_totalprice > 20000"),
    q.Rule("reasonable_amount", "o_totalprice < 400000", q.WARN),
    q.Rule("known_status", "nullif(o_orderstatus, 'P') IN ('F', 'O')"),
]


@query("c16_expect_drop", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_custkey IS NOT NULL AND o_totalprice > 20000 AND o_orderstatus IN ('F', 'O')")
def c16(t):
    return q.expect(t.orders, RULES).select("o_orderkey", "o_totalprice")


@query("c16_rule_report", f"""
SELECT rule, action, broken, (SELECT count(*) FROM orders) AS row_count FROM (
  SELECT 'valid_key' AS rule, 'drop' AS action, {r.n_if('o_custkey IS NULL')} AS broken FROM orders
  UNION ALL SELECT 'positive_amount', 'drop', {r.n_if('o_totalprice <= 20000')} FROM orders
  UNION ALL SELECT 'reasonable_amount', 'warn', {r.n_if('o_totalprice >= 400000')} FROM orders
  UNION ALL SELECT 'known_status', 'drop', {r.n_if("o_orderstatus = 'P'")} FROM orders)""")
def c16_report(t):
    return q.rule_report(t.orders, RULES)


DELIVERY_RULES_SQL = " UNION ALL ".join(
    f"SELECT '{name}' AS rule, '{action}' AS action, {r.n_if(broken)} AS broken, count(*) AS row_count FROM d"
    for name, action, broken in [
        ("valid_order_id", "drop", "o_orderkey IS NULL"), ("valid_order_date", "drop", "o_orderdate IS NULL"),
        ("reasonable_order_date", "drop", "NOT o_orderdate BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '2001-01-01'"),
        ("valid_restaurant_key", "drop", "o_custkey IS NULL"), ("valid_driver_key", "drop", "driver IS NULL"),
        ("valid_total_amount", "drop", "o_totalprice IS NULL"), ("positive_amount", "drop", "o_totalprice <= 0"),
        ("reasonable_amount", "warn", "o_totalprice >= 400000"), ("valid_status", "drop", "o_orderstatus IS NULL"),
        ("known_status", "warn", "o_orderstatus NOT IN ('F', 'O')"),
    ]
)


@query("c16_delivery_rules", "WITH d AS (SELECT *, nullif(o_orderpriority, '5-LOW') AS driver FROM orders) " + DELIVERY_RULES_SQL)
def c16_delivery(t):
    rows = t.orders.select(
        F.col("o_orderkey").alias("order_id"), F.col("o_orderdate").alias("order_date"), F.col("o_custkey").alias("restaurant_key"),
        F.nullif("o_orderpriority", F.lit("5-LOW")).alias("driver_key"), F.col("o_totalprice").alias("total_amount"),
        F.col("o_orderstatus").alias("status_name"),
    )
    return q.rule_report(rows, delivery_rules("2001-01-01", "1996-01-01", 400000, ["F", "O"]))


@query("c16_null_passes", "SELECT o_orderkey FROM orders")
def c16_null(t):
    # The same rule lets rows with a NULL answer pass when the policy says so.
    return q.expect(t.orders, [q.Rule("known_status", "nullif(o_orderstatus, 'P') IN ('F', 'O')", null_passes=True)]).select("o_orderkey")


@query("c17_validators", "SELECT o_orderkey, o_custkey FROM orders")
def c17(t):
    checked = q.validate_schema(t.orders, t.orders.schema)
    return q.validate_no_nulls(q.validate_rows(checked, 100), ["o_orderkey", "o_custkey"]).select("o_orderkey", "o_custkey")


@query("c06_full_replace", STATE_SQL)
def c06(t):
    path = scratch_path(t.spark, "current")
    old, new = snapshots(t)
    for state in (old, new):
        sinks.write_table(state, path, mode="overwrite")
    return t.spark.read.parquet(path)


@query("c18_outliers", """
WITH s AS (SELECT event_type AS k, avg(value) AS m, stddev_samp(value) AS s FROM events GROUP BY 1 HAVING count(*) > 2)
SELECT event_id, event_type, value, round((value - m) / s, 5) AS z_score FROM events JOIN s ON k = event_type WHERE abs((value - m) / s) > 2""")
def c18(t):
    rows = t.events.select("event_id", "event_type", "value")
    return q.outliers(rows, ["event_type"], "value").drop("group_mean").withColumn("z_score", F.round("z_score", 5))


@query("c19_transitions", """
WITH l AS (SELECT event_type, lead(event_type) OVER w AS next_status, epoch_us(lead(ts) OVER w) // 1000 - epoch_us(ts) // 1000 AS ms FROM events
  WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
SELECT event_type, next_status, count(*) AS transitions, CAST(sum(ms) AS DOUBLE) / count(*) / 60000 AS avg_minutes,
  min(ms) / 60000 AS min_minutes, max(ms) / 60000 AS max_minutes, quantile_cont(CAST(ms AS DOUBLE), 0.5) / 60000 AS median_minutes
FROM l WHERE next_status IS NOT NULL GROUP BY 1, 2""")
def c19(t):
    return q.transitions(t.events, "user_id", "event_type", "ts", "event_id")


@query("c20_referential_facts", """
SELECT l_orderkey, l_partkey, l_quantity * p_retailprice AS inventory_value FROM lineitem JOIN part ON l_partkey = p_partkey
JOIN supplier ON l_suppkey = s_suppkey WHERE l_quantity >= 0 AND p_retailprice IS NOT NULL""")
def c20(t):
    return (
        t.lineitem.filter(F.col("l_quantity") >= 0)
        .join(t.part.filter(F.col("p_retailprice").isNotNull()), F.col("l_partkey") == F.col("p_partkey"))
        .join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey"), "left_semi")
        .select("l_orderkey", "l_partkey", (F.col("l_quantity") * F.col("p_retailprice")).alias("inventory_value"))
    )


@query("c21_row_tracking", """
SELECT 'orders_in' AS step, count(*) AS rows FROM orders UNION ALL SELECT 'orders_finished', count(*) FROM orders WHERE o_orderstatus = 'F'
UNION ALL SELECT 'orders_large', count(*) FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 100000""")
def c21(t):
    first, came_in = q.count_rows(t.orders, "orders_in")
    finished, done = q.count_rows(first.filter(F.col("o_orderstatus") == "F"), "orders_finished")
    large, kept = q.count_rows(finished.filter(F.col("o_totalprice") > 100000), "orders_large")
    large.select("o_orderkey").write.parquet(scratch_path(t.spark, "tracked"))  # the one action that counts all three
    counts = [(name, seen.get["rows"]) for name, seen in (("orders_in", came_in), ("orders_finished", done), ("orders_large", kept))]
    return t.spark.createDataFrame(counts, "step string, rows bigint")


