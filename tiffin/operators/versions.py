"""Row changes, dated deliveries and file layout for ordinary partitioned tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window as W, functions as F, types as T

from tiffin.operators.keys import unique_source
from tiffin.operators.quality import FAIL, QualityError, Rule, broken_rows, expect
from tiffin.session import scratch_path


# ---------------------------------------------------------------- row changes


def update_where(df: DataFrame, condition: Column, values: dict[str, Column]) -> DataFrame:
    """UPDATE .. SET .. WHERE: rows without a true answer stay as they are."""
    return df.withColumns(
        {c: F.when(condition, v).otherwise(F.col(c)).cast(df.schema[c].dataType) for c, v in values.items()}
    )


def delete_where(df: DataFrame, condition: Column) -> DataFrame:
    """DELETE .. WHERE: rows without a true answer stay."""
    return df.filter(~F.coalesce(condition, F.lit(False)))


def insert_rows(df: DataFrame, rows: DataFrame) -> DataFrame:
    """INSERT: ``rows`` take the columns of ``df`` by name; columns they lack become NULL."""
    return df.unionByName(rows, allowMissingColumns=True)


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    when_matched: Column | None = None,
    update: dict[str, Column] | None = None,
    insert: bool = True,
) -> DataFrame:
    """MERGE: update matched rows, insert the others.

    Inside ``when_matched`` and ``update``, ``t.x`` and ``s.x`` name target and source columns. Without ``update`` all
    columns the source has are taken over. A source with duplicate keys fails the job.
    """
    t = target.withColumn("_in_t", F.lit(True)).alias("t")
    s = unique_source(source, keys).withColumn("_in_s", F.lit(True)).alias("s")
    joined = t.join(s, reduce(lambda a, b: a & b, [F.col(f"t.{k}") == F.col(f"s.{k}") for k in keys]), "full" if insert else "left")
    matched = F.col("t._in_t").isNotNull() & F.col("s._in_s").isNotNull()
    if when_matched is not None:
        matched = matched & F.coalesce(when_matched, F.lit(False))
    new = F.col("t._in_t").isNull()
    changes = update if update is not None else {c: F.col(f"s.{c}") for c in source.columns if c not in keys}
    columns = []
    for c in target.columns:
        inserted = F.col(f"s.{c}") if c in source.columns else F.lit(None)
        kept = F.col(f"t.{c}")
        value = F.when(new, inserted)
        if c in changes:
            value = value.when(matched, changes[c])
        columns.append(value.otherwise(kept).cast(target.schema[c].dataType).alias(c))
    return joined.select(*columns)


def change_feed(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Changes from one state to the next: insert, delete, update_preimage and update_postimage rows."""
    values = list(old.columns)
    o = old.withColumn("_here", F.lit(True)).alias("o")
    n = new.select(*values).withColumn("_here", F.lit(True)).alias("n")
    joined = o.join(n, reduce(lambda a, b: a & b, [F.col(f"o.{k}") == F.col(f"n.{k}") for k in keys]), "full")
    before = F.struct(*[F.col(f"o.{c}").alias(c) for c in values])
    after = F.struct(*[F.col(f"n.{c}").alias(c) for c in values])
    entry = lambda row, kind: F.struct(row.alias("row"), F.lit(kind).alias("kind"))
    had, has = F.col("o._here").isNotNull(), F.col("n._here").isNotNull()
    entries = (
        F.when(~had, F.array(entry(after, "insert")))
        .when(~has, F.array(entry(before, "delete")))
        .when(~before.eqNullSafe(after), F.array(entry(before, "update_preimage"), entry(after, "update_postimage")))
    )
    return joined.select(F.explode(entries).alias("_e")).select("_e.row.*", F.col("_e.kind").alias("change_type"))


def read_merged(base: DataFrame, deletes: DataFrame, inserts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Base rows without the deleted keys, plus the inserted rows: changes kept aside and merged when read."""
    return base.join(deletes.select(*keys), list(keys), "left_anti").select(*base.columns).unionByName(inserts)


# ---------------------------------------------------------------- schema changes


def evolve(
    df: DataFrame, add: dict[str, Column] | None = None, rename: dict[str, str] | None = None, drop: Sequence[str] = ()
) -> DataFrame:
    """Drop, rename, then add columns; a new column takes its default."""
    result = df.drop(*drop).withColumnsRenamed(rename or {})
    return result.withColumns(add or {})


def change_type(df: DataFrame, column: str, to: str) -> DataFrame:
    """Column in another type, in its old place; a value that does not fit becomes NULL."""
    return df.withColumn(column, F.col(column).try_cast(to))


def append_merged(df: DataFrame, rows: DataFrame) -> DataFrame:
    """Append with both sets of columns."""
    return df.unionByName(rows, allowMissingColumns=True)


def fit_schema(rows: DataFrame, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """Rows that fit a schema, cast to it, and the rows that do not, unchanged. Unknown columns are an error."""
    names = [f.name for f in schema.fields]
    unknown = [c for c in rows.columns if c not in names]
    if unknown:
        raise QualityError(f"columns not in the target: {unknown}")
    fields = [f for f in schema.fields if f.name in rows.columns]
    bad = reduce(
        lambda a, b: a | b,
        [F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull() for f in fields],
        F.lit(False),
    )
    cast = [
        F.col(f.name).try_cast(f.dataType).alias(f.name) if f.name in rows.columns else F.lit(None).cast(f.dataType).alias(f.name)
        for f in schema.fields
    ]
    return rows.filter(~bad).select(*cast), rows.filter(bad)


def business_view(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Physical columns under business names, and only those."""
    return df.select(*[F.col(old).alias(new) for old, new in names.items()])


# ---------------------------------------------------------------- deliveries dated by the data


def append_by_month(df: DataFrame, base: str, moment: str) -> str:
    """Append rows to a folder partitioned by the month of a time that they carry. Nothing older is touched; rows without the time are left out."""
    dated = df.filter(F.col(moment).isNotNull()).withColumn("delivery", F.date_format(moment, "yyyy-MM"))
    dated.hint("rebalance", "delivery").write.mode("append").partitionBy("delivery").parquet(base)
    return base


def read_deliveries(spark: SparkSession, base: str) -> DataFrame:
    return spark.read.option("partitionColumnTypeInference", "false").parquet(base).withColumn("delivery", F.col("delivery").cast("string"))


def delivered(rows: DataFrame, only: str | None = None, until: str | None = None) -> DataFrame:
    """Rows of one delivery, or of all up to one; only their partitions are read."""
    if only is not None:
        rows = rows.filter(F.col("delivery") == only)
    return rows if until is None else rows.filter(F.col("delivery") <= until)


def delivery_counts(rows: DataFrame, moment: str) -> DataFrame:
    """One row per delivery: its rows, first and last time."""
    return rows.groupBy("delivery").agg(F.count(F.lit(1)).alias("rows"), F.min(moment).alias("first_ts"), F.max(moment).alias("last_ts"))


def delivery_evolution(counts: DataFrame) -> DataFrame:
    """Rows of each delivery and the difference to the one before. One row per delivery comes in."""
    return counts.withColumn("row_change", F.col("rows") - F.lag("rows", 1, 0).over(W.orderBy("delivery")))


def beyond_retention(counts: DataFrame, keep: int, before: str) -> DataFrame:
    """Deliveries before a month that are not among the last ``keep``. One row per delivery comes in; deleting them is up to the caller."""
    place = F.row_number().over(W.orderBy(F.col("delivery").desc()))
    return counts.withColumn("_place", place).filter((F.col("_place") > keep) & (F.col("delivery") < before)).drop("_place")


def compare_versions(old: DataFrame, new: DataFrame) -> DataFrame:
    """Rows of both states and rows found in only one of them, counted with duplicates.

    One signed multiset: each row counts for its side, equal rows are grouped once, and what one side has more of is only there. Each state is read once.
    """
    both = old.withColumns({"_old": F.lit(1), "_new": F.lit(0)}).unionByName(new.withColumns({"_old": F.lit(0), "_new": F.lit(1)}))
    rows = both.groupBy(*old.columns).agg(F.sum("_old").alias("_old"), F.sum("_new").alias("_new"))
    more = F.col("_new") - F.col("_old")
    sums = {
        "old": F.sum("_old"), "new": F.sum("_new"), "only in new": F.sum(F.greatest(more, F.lit(0))), "only in old": F.sum(F.greatest(-more, F.lit(0))),
    }
    total = rows.agg(*[F.coalesce(s, F.lit(0)).alias(name) for name, s in sums.items()])
    return total.unpivot([], list(sums), "measure", "row_count")


def write_audit_publish(df: DataFrame, rules: Sequence[Rule], base: str, snapshot_id: int) -> str:
    """Stage rows, audit them, append only a clean stage to the published folder, as a partition of its own.

    FAIL rules stop the publication, DROP rules leave their rows out. What was published before is not written again.
    """
    spark = df.sparkSession
    stage = scratch_path(spark, "staged")
    df.write.parquet(stage)
    staged = spark.read.schema(df.schema).parquet(stage)
    failing = [rule for rule in rules if rule.action == FAIL]
    if failing and broken_rows(staged, failing).limit(1).count():
        raise QualityError(f"staged rows break one of {[rule.name for rule in failing]}")
    clean = expect(staged, [rule for rule in rules if rule.action != FAIL])
    clean.withColumn("snapshot_id", F.lit(snapshot_id).cast("bigint")).write.mode("append").partitionBy("snapshot_id").parquet(base)
    return base


# ---------------------------------------------------------------- layout


def compact(spark: SparkSession, source: str, target: str, files: int) -> str:
    """The rows of a folder in ``files`` files at a new place."""
    spark.read.parquet(source).repartition(files).write.parquet(target)
    return target


def quantile_buckets(df: DataFrame, columns: Sequence[str], bits: int) -> DataFrame:
    """``_bucket_<i>``: which of ``2 ** bits`` approximate quantile ranges each numeric column falls in.

    The bounds are found in one pass and used as a scalar; each row finds its bucket in ``bits`` comparisons. NULL goes
    to the lowest bucket.
    """
    parts = 1 << bits
    shares = [i / parts for i in range(1, parts)]
    bounds = df.agg(F.struct(*[F.percentile_approx(c, shares, 10_000).alias(f"c{i}") for i, c in enumerate(columns)])).scalar()
    result = df.withColumn("_bounds", bounds)
    for i, column in enumerate(columns):
        name, step = f"_bucket_{i}", parts >> 1
        result = result.withColumn(name, F.lit(0))
        while step:
            reached = F.col(f"_bounds.c{i}")[F.col(name) + (step - 1)] <= F.col(column)
            result = result.withColumn(name, F.col(name) + F.when(reached, step).otherwise(0))
            step >>= 1
    return result.drop("_bounds")


def zorder_key(df: DataFrame, columns: Sequence[str], bits: int = 5) -> DataFrame:
    """``_z``: the interleaved bits of each column's quantile bucket."""
    bucketed = quantile_buckets(df, columns, bits)
    key = F.lit(0).cast("bigint")
    for bit in range(bits):
        for i in range(len(columns)):
            one = F.shiftright(F.col(f"_bucket_{i}"), bit).bitwiseAND(F.lit(1)).cast("bigint")
            key = key + F.shiftleft(one, bit * len(columns) + i)
    return bucketed.withColumn("_z", key).drop(*[f"_bucket_{i}" for i in range(len(columns))])


def zorder(df: DataFrame, columns: Sequence[str], files: int, bits: int = 5) -> DataFrame:
    """Rows clustered on several columns at once, split by range of the interleaved key.

    The columns themselves follow the key, so that a bucket with very many rows is still split.
    """
    keyed = zorder_key(df, columns, bits)
    return keyed.repartitionByRange(files, "_z", *columns).sortWithinPartitions("_z", *columns).drop("_z")


def partition_transforms(ts: str | None = None, bucket: tuple[str, int] | None = None, truncate: tuple[str, int] | None = None) -> dict[str, Column]:
    """Derived partition columns: year, month, day and hour of a time, hash bucket, value or text truncated."""
    result: dict[str, Column] = {}
    if ts:
        result |= {
            "ts_year": F.year(ts), "ts_month": F.date_format(ts, "yyyy-MM"), "ts_day": F.to_date(ts),
            "ts_hour": F.date_trunc("hour", ts),
        }
    if bucket:
        result[f"{bucket[0]}_bucket"] = F.pmod(F.hash(bucket[0]), F.lit(bucket[1]))
    if truncate:
        result[f"{truncate[0]}_trunc"] = F.substring(truncate[0], 1, truncate[1])
    return result


def between_days(df: DataFrame, ts: str, first: str, last: str, day: str = "ts_day") -> DataFrame:
    """Time filter together with the one on the derived day, so that only matching partitions are read."""
    return df.filter(F.col(day).between(F.lit(first).cast("date"), F.lit(last).cast("date"))).filter(
        (F.col(ts) >= F.lit(first).cast("timestamp")) & (F.to_date(ts) <= F.lit(last).cast("date"))
    )


def distribute(df: DataFrame, mode: str, columns: Sequence[str], files: int) -> DataFrame:
    """Rows for the writer: as they are (none), by hash or by range of columns."""
    if mode == "none":
        return df
    if mode == "hash":
        return df.hint("rebalance", files, *columns)  # by hash, but a hot value is split over several files
    if mode == "range":
        return df.repartitionByRange(files, *columns)
    raise ValueError("mode is none, hash or range")


def sorted_write(df: DataFrame, path: str, columns: Sequence[str], files: int) -> str:
    df.repartitionByRange(files, *columns).sortWithinPartitions(*columns).write.parquet(path)
    return path


def file_metrics(df: DataFrame) -> DataFrame:
    """Rows and bytes per file of a file-backed table."""
    return df.groupBy(
        F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_size").alias("file_size")
    ).agg(F.count(F.lit(1)).alias("row_count"))


def table_metrics(df: DataFrame) -> DataFrame:
    files = file_metrics(df)
    return files.agg(
        F.count(F.lit(1)).alias("files"), F.sum("row_count").alias("row_count"), F.sum("file_size").alias("bytes"),
        F.avg("file_size").alias("avg_bytes"),
    )


def file_ranges(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Least and greatest value per file and column: how much a range filter can skip."""
    return df.groupBy(F.col("_metadata.file_path").alias("file_path")).agg(
        *[f(c).alias(f"{n}_{c}") for c in columns for n, f in (("min", F.min), ("max", F.max))]
    )


def write_with_bloom(df: DataFrame, path: str, column: str, distinct: int | None = None) -> str:
    """Parquet with a bloom filter on one column."""
    writer = df.write.option(f"parquet.bloom.filter.enabled#{column}", "true")
    if distinct:
        writer = writer.option(f"parquet.bloom.filter.expected.ndv#{column}", str(distinct))
    writer.parquet(path)
    return path


def rows_and_scanned(df: DataFrame) -> tuple[int, int]:
    """Rows of the result, and rows that the scans handed on after leaving out row groups, from the metrics of the plan that ran."""
    execution = df._jdf.queryExecution()
    rows = execution.toRdd().count()
    ran = execution.executedPlan()
    ran = ran.finalPhysicalPlan() if ran.nodeName() == "AdaptiveSparkPlan" else ran
    leaves = ran.collectLeaves()
    return rows, sum(leaves.apply(k).metrics().apply("numOutputRows").value() for k in range(leaves.size()))


def convert(spark: SparkSession, source: str, source_format: str, target: str, target_format: str, schema=None) -> int:
    """Copy a dataset into another format and compare the row counts; the source is read once."""
    reader = spark.read.format(source_format)
    df = reader.schema(schema).load(source) if schema else reader.load(source)
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.format(target_format).save(target)
    written = spark.read.format(target_format).schema(df.schema).load(target).count()
    if written != seen.get["rows"]:
        raise QualityError(f"{written} rows written, {seen.get['rows']} read")
    return written
