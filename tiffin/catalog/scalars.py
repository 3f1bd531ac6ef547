"""Scalar function queries (F*)."""

from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tiffin.catalog.registry import query
from tiffin.functions import columns as c

PHONE_SQL = "'+' || c_nationkey || ' (' || (100 + c_nationkey) || ') ' || substr(c_name, 13, 3) || '-' || substr(c_name, 16)"
EMAIL_SQL = "replace(c_name, '#', '.') || '@' || c_mktsegment || '.COM'"


def phone():
    return F.concat(
        F.lit("+"), F.col("c_nationkey").cast("string"), F.lit(" ("), (F.col("c_nationkey") + 100).cast("string"),
        F.lit(") "), F.substring("c_name", 13, 3), F.lit("-"), F.substring("c_name", 16, 9),
    )


def email():
    return F.concat(F.replace("c_name", F.lit("#"), F.lit(".")), F.lit("@"), F.col("c_mktsegment"), F.lit(".COM"))


@query("f01_case_trim", """
SELECT p_partkey, upper(p_name) AS upper_name, lower(p_brand) AS lower_brand, trim('  ' || p_type || ' ') AS trimmed FROM part""")
def f01(t):
    return t.part.select(
        "p_partkey", F.upper("p_name").alias("upper_name"), F.lower("p_brand").alias("lower_brand"),
        F.trim(F.concat(F.lit("  "), "p_type", F.lit(" "))).alias("trimmed"),
    )


@query("f02_concat", """
SELECT p_partkey, p_name || ' ' || CASE WHEN p_type != 'PROMO' THEN p_brand END AS full_name FROM part""")
def f02(t):
    return t.part.select(
        "p_partkey", c.full_name("p_name", F.when(F.col("p_type") != "PROMO", F.col("p_brand"))).alias("full_name")
    )


@query("f03_regex", f"""
WITH p AS (SELECT c_custkey, {PHONE_SQL} AS phone, c_name FROM customer)
SELECT c_custkey, regexp_extract(c_name, '#0*([0-9]+)', 1) AS digits,
  regexp_replace(phone, '[()\\s-]', '', 'g') AS plain_phone, regexp_replace(phone, '[()+-]', '', 'g') AS spaced_phone
FROM p""")
def f03(t):
    return t.customer.withColumn("phone", phone()).select(
        "c_custkey", F.regexp_extract("c_name", "#0*([0-9]+)", 1).alias("digits"),
        c.strip_phone("phone").alias("plain_phone"), c.strip_phone_signs("phone").alias("spaced_phone"),
    )


@query("f04_split", """
SELECT p_partkey, split_part(p_name, ' ', 1) AS colour, split_part(p_name, ' ', 2) AS thing FROM part""")
def f04(t):
    parts = F.split("p_name", " ")
    return t.part.select("p_partkey", parts.getItem(0).alias("colour"), parts.getItem(1).alias("thing"))


@query("f05_substring_locate", f"""
WITH e AS (SELECT c_custkey, {EMAIL_SQL} AS email FROM customer)
SELECT c_custkey, lower(substr(email, strpos(email, '@') + 1)) AS email_domain, length(email) AS email_length,
  substr(email, 1, 8) AS head FROM e""")
def f05(t):
    return t.customer.withColumn("email", email()).select(
        "c_custkey", c.email_domain("email").alias("email_domain"), F.length("email").cast("bigint").alias("email_length"),
        F.substring("email", 1, 8).alias("head"),
    )


@query("f06_format_pad", f"""
WITH p AS (SELECT c_custkey, {PHONE_SQL} AS phone, c_acctbal FROM customer)
SELECT c_custkey, replace(replace(phone, '(', ''), ')', '-') AS formatted, lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS padded,
  CAST(CAST(c_acctbal AS DECIMAL(10,2)) AS VARCHAR) AS shown FROM p""")
def f06(t):
    return t.customer.withColumn("phone", phone()).select(
        "c_custkey", c.hyphen_phone("phone").alias("formatted"),
        F.lpad(F.col("c_custkey").cast("string"), 10, "0").alias("padded"),
        F.col("c_acctbal").cast("decimal(10,2)").cast("string").alias("shown"),
    )


@query("f07_parse_time", """
SELECT o_orderkey, strptime(strftime(o_orderdate, '%Y-%m-%d %H:%M:%S'), '%Y-%m-%d %H:%M:%S') AS parsed,
  CAST(strptime(strftime(o_orderdate, '%d/%m/%Y'), '%d/%m/%Y') AS DATE) AS parsed_date FROM orders""")
def f07(t):
    return t.orders.select(
        "o_orderkey",
        F.to_timestamp(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")).alias("parsed"),
        F.to_date(F.date_format("o_orderdate", "dd/MM/yyyy"), "dd/MM/yyyy").alias("parsed_date"),
    )


@query("f08_epoch_millis", """
SELECT event_id, make_timestamp((epoch_us(ts) // 1000000) * 1000000) AS whole_seconds, make_timestamp((epoch_us(ts) // 1000) * 1000) AS with_millis
FROM events""")
def f08(t):
    millis = F.unix_millis("ts").cast("double").cast("bigint")  # the feed mixes integer and float epochs
    return t.events.select(
        "event_id",
        F.timestamp_seconds(F.floor(millis / 1000)).alias("whole_seconds"),
        F.timestamp_millis(millis).alias("with_millis"),
    )


@query("f09_date_parts", """
SELECT event_id, CAST(year(ts) AS INT) AS y, CAST(month(ts) AS INT) AS m, CAST(day(ts) AS INT) AS d, CAST(hour(ts) AS INT) AS h,
  CAST(dayofweek(ts) + 1 AS INT) AS dow FROM events""")
def f09(t):
    return t.events.select(
        "event_id", F.year("ts").alias("y"), F.month("ts").alias("m"), F.dayofmonth("ts").alias("d"),
        F.hour("ts").alias("h"), F.dayofweek("ts").alias("dow"),
    )


@query("f10_date_format", """
SELECT o_orderkey, dayname(o_orderdate) AS long_name, substr(dayname(o_orderdate), 1, 3) AS short_name,
  strftime(o_orderdate, '%Y-%m') AS month_label FROM orders""")
def f10(t):
    return t.orders.select(
        "o_orderkey", c.weekday_name("o_orderdate").alias("long_name"), F.date_format("o_orderdate", "E").alias("short_name"),
        F.date_format("o_orderdate", "yyyy-MM").alias("month_label"),
    )


@query("f11_date_arithmetic", """
SELECT o_orderkey, date_diff('day', CAST(o_orderdate AS DATE), DATE '2002-01-01') AS days_ago,
  CAST(o_orderdate AS DATE) + 30 AS due, o_orderdate + INTERVAL 2 HOURS AS soon,
  CAST(floor(date_diff('day', CAST(o_orderdate AS DATE), DATE '2002-01-01') / 365.25) AS BIGINT) AS age FROM orders""")
def f11(t):
    as_of = F.lit("2002-01-01").cast("date")
    return t.orders.select(
        "o_orderkey", F.datediff(as_of, "o_orderdate").cast("bigint").alias("days_ago"),
        F.date_add(F.to_date("o_orderdate"), 30).alias("due"),
        (F.col("o_orderdate") + F.expr("INTERVAL 2 HOURS")).alias("soon"),
        c.age_years(F.to_date("o_orderdate"), as_of).alias("age"),
    )


@query("f12_duration", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, o_orderkey,
  abs(epoch(l_shipdate) - epoch(o_orderdate)) / 60.0 AS minutes
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")
def f12(t):
    return t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "o_orderkey",
        c.minutes_between("l_shipdate", "o_orderdate").alias("minutes"),
    )


@query("f13_math", """
SELECT p_partkey, round(sqrt(p_size), 6) AS root, round(pow(p_size, 2), 2) AS squared, round(ln(p_size), 6) AS nat,
  round(log10(p_size), 6) AS dec_log, round(ln(1 + p_size), 6) AS one_log, abs(25 - p_size) AS gap,
  CAST(floor(p_retailprice / 7) AS BIGINT) AS sevenths, greatest(p_size, 10) AS at_least_ten FROM part""")
def f13(t):
    s = F.col("p_size")
    return t.part.select(
        "p_partkey", F.round(F.sqrt(s), 6).alias("root"), F.round(F.pow(s, 2), 2).alias("squared"),
        F.round(F.log(s), 6).alias("nat"), F.round(F.log10(s), 6).alias("dec_log"), F.round(F.log1p(s), 6).alias("one_log"),
        F.abs(25 - s).alias("gap"), F.floor(F.col("p_retailprice") / 7).alias("sevenths"),
        F.greatest(s, F.lit(10)).alias("at_least_ten"),
    )


@query("f14_null_handling", """
WITH n AS (SELECT c_custkey, nullif(c_mktsegment, 'BUILDING') AS segment, CASE WHEN c_acctbal > 0 THEN c_acctbal END AS balance
  FROM customer)
SELECT c_custkey, coalesce(segment, 'Unknown') AS segment, coalesce(balance, 0) AS balance FROM n
WHERE NOT (segment IS NULL AND balance IS NULL)""")
def f14(t):
    gaps = t.customer.select(
        "c_custkey", F.nullif("c_mktsegment", F.lit("BUILDING")).alias("segment"),
        F.when(F.col("c_acctbal") > 0, F.col("c_acctbal")).alias("balance"),
    )
    return gaps.dropna(how="all", subset=["segment", "balance"]).fillna({"segment": "Unknown", "balance": 0.0})


@query("f15_casts", """
SELECT p_partkey, CAST(p_size AS DOUBLE) AS size_d, CAST(p_partkey AS VARCHAR) AS key_s, TRY_CAST(substr(p_brand, 7) AS INT) AS brand_no,
  TRY_CAST(p_name AS INT) AS no_number, CAST(p_size AS VARCHAR) || 'x' AS label FROM part""")
def f15(t):
    return t.part.select(
        "p_partkey", F.col("p_size").cast("double").alias("size_d"), F.col("p_partkey").cast("string").alias("key_s"),
        F.expr("substring(p_brand, 7)").try_cast("int").alias("brand_no"), F.col("p_name").try_cast("int").alias("no_number"),
        F.concat(F.col("p_size").cast("string"), F.lit("x")).alias("label"),
    )


@query("f16_conditional", """
SELECT o_orderkey, CASE WHEN o_totalprice > 300000 THEN 'High' WHEN o_totalprice > 150000 THEN 'Medium' ELSE 'Low' END AS category,
  CASE o_orderstatus WHEN 'F' THEN 'Finished' WHEN 'O' THEN 'Open' END AS state FROM orders""")
def f16(t):
    status = F.col("o_orderstatus")
    return t.orders.select(
        "o_orderkey", c.above_tier("o_totalprice", [(300000, "High"), (150000, "Medium")], "Low").alias("category"),
        F.when(status == "F", "Finished").when(status == "O", "Open").alias("state"),
    )


@query("f17_right_closed_bins", """
SELECT p_partkey, CASE WHEN p_size > 0 AND p_size <= 10 THEN 'Poor' WHEN p_size > 10 AND p_size <= 25 THEN 'Average'
  WHEN p_size > 25 AND p_size <= 40 THEN 'Good' END AS bin FROM part""")
def f17(t):
    return t.part.select("p_partkey", c.band("p_size", [0, 10, 25, 40], ["Poor", "Average", "Good"], right=True).alias("bin"))


@query("f18_arrays", """
SELECT p_partkey, unnest([p_name, p_brand, p_type]) AS detail, p_type AS last_item, 3 AS items,
  p_type = 'PROMO' AS has_promo FROM part""")
def f18(t):
    rows = t.part.withColumn("info", F.array("p_name", "p_brand", "p_type"))
    return rows.select(
        "p_partkey", F.explode("info").alias("detail"), F.col("info")[2].alias("last_item"), F.size("info").alias("items"),
        F.array_contains("info", "PROMO").alias("has_promo"),
    )


@query("f19_structs", "SELECT p_partkey, p_type AS cuisine, p_size AS reviews, p_brand AS city FROM part")
def f19(t):
    nested = t.part.select(
        "p_partkey",
        F.struct(F.col("p_type").alias("cuisine"), F.col("p_size").alias("reviews")).alias("metrics"),
        F.struct(F.col("p_brand").alias("city")).alias("location"),
    )
    return nested.select("p_partkey", "metrics.cuisine", "metrics.reviews", F.col("location").getField("city").alias("city"))


@query("f20_maps", "SELECT o_orderkey, o_orderpriority AS priority, CAST(NULL AS VARCHAR) AS missing, 2 AS entries FROM orders")
def f20(t):
    rows = t.orders.withColumn(
        "metadata", F.create_map(F.lit("status"), "o_orderstatus", F.lit("priority"), "o_orderpriority")
    )
    return rows.select(
        "o_orderkey", F.element_at("metadata", "priority").alias("priority"),
        F.try_element_at("metadata", F.lit("none")).alias("missing"), F.size("metadata").alias("entries"),
    )


@query("f21_json", """
SELECT event_id, CAST(json_extract(props, '$.k') AS INT) AS k, json_extract_string(props, '$.k') AS k_text,
  '{"id":' || event_id || ',"kind":"' || event_type || '"}' AS packed, event_type AS unpacked FROM events""")
def f21(t):
    packed = t.events.withColumn("packed", F.to_json(F.struct(F.col("event_id").alias("id"), F.col("event_type").alias("kind"))))
    shape = F.schema_of_json(F.lit('{"id":1,"kind":"x"}'))
    return packed.select(
        "event_id", F.from_json("props", "k INT")["k"].alias("k"), F.get_json_object("props", "$.k").alias("k_text"),
        "packed", F.from_json("packed", shape)["kind"].alias("unpacked"),
    )


@query("f22_ids_hashes", """
SELECT c_custkey, sha256('v' || c_name || chr(31) || 'v' || c_mktsegment) AS row_hash, 36 AS id_length FROM customer""")
def f22(t):
    return t.customer.select(
        "c_custkey", c.row_hash("c_name", "c_mktsegment").alias("row_hash"), F.length(F.uuid()).alias("id_length")
    )


# Two cities of the distance example, as latitude and longitude.
PALMAS, SAO_PAULO = (-10.1686, -48.3305), (-23.5505, -46.6333)


@query("f23_haversine", """
WITH p AS (SELECT c_custkey, c_nationkey * 1.5 - 20 AS lat, c_acctbal / 100 AS lon FROM customer)
SELECT c_custkey, round(2 * 6371 * asin(sqrt(pow(sin((radians(-23.5505) - radians(lat)) / 2), 2)
  + cos(radians(lat)) * cos(radians(-23.5505)) * pow(sin((radians(-46.6333) - radians(lon)) / 2), 2))), 3) AS distance_km
FROM p""")
def f23(t):
    lat = F.col("c_nationkey") * F.lit(1.5) - 20
    distance = c.haversine_km(lat, F.col("c_acctbal") / 100, F.lit(SAO_PAULO[0]), F.lit(SAO_PAULO[1]))
    return t.customer.select("c_custkey", F.round(distance, 3).alias("distance_km"))


@query("f24_safe_ratios", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice / nullif(l_discount * 100, 0) AS per_point,
  l_extendedprice / nullif(l_quantity / 60, 0) AS per_hour FROM lineitem""")
def f24(t):
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        (F.col("l_extendedprice") / F.nullif(F.col("l_discount") * 100, F.lit(0.0))).alias("per_point"),
        (F.col("l_extendedprice") / F.nullif(F.col("l_quantity") / 60, F.lit(0.0))).alias("per_hour"),
    )


@query("f25_feature_vectors", """
WITH x AS (SELECT p_partkey, p_retailprice AS a, p_size AS b, p_size / greatest(p_retailprice, 0.1) AS c FROM part),
  s AS (SELECT avg(a) AS ma, stddev_samp(a) AS sa, avg(b) AS mb, stddev_samp(b) AS sb, avg(c) AS mc, stddev_samp(c) AS sc FROM x)
SELECT p_partkey, a >= 950 AS highly_rated, b > 25 AS many_reviews, round((a - ma) / sa, 5) AS rating_z, round((b - mb) / sb, 5) AS reviews_z,
  round((c - mc) / sc, 5) AS ratio_z FROM x, s""")
def f25(t):
    rows = t.part.select(
        "p_partkey", F.col("p_retailprice").alias("a"), F.col("p_size").cast("double").alias("b"),
        (F.col("p_size") / F.greatest("p_retailprice", F.lit(0.1))).alias("c"),
    )
    vectors = VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(rows)
    scaler = StandardScaler(inputCol="features", outputCol="scaled", withMean=True, withStd=True)
    z = vector_to_array("scaled")
    return scaler.fit(vectors).transform(vectors).select(
        "p_partkey", (F.col("a") >= 950).alias("highly_rated"), (F.col("b") > 25).alias("many_reviews"),
        F.round(z[0], 5).alias("rating_z"), F.round(z[1], 5).alias("reviews_z"), F.round(z[2], 5).alias("ratio_z"),
    )
