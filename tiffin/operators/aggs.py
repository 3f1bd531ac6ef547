"""Grouped summaries."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tiffin.functions.columns import percent
from tiffin.operators.windows import join_beside, number_rows, running


def summarise(
    df: DataFrame, measures: dict[str, Column], by: Sequence[str], where: Column | str | None = None,
    order: Sequence[Column] = (), limit: int | None = None,
) -> DataFrame:
    """Grouped summary with optional filter, order and limit."""
    rows = df.filter(where) if where is not None else df
    result = rows.groupBy(*by).agg(*[c.alias(n) for n, c in measures.items()])
    if order:
        result = result.orderBy(*order)
    return result.limit(limit) if limit else result


def weighted_mean(value: str, weight: str) -> Column:
    """``sum(value * weight) / sum(weight)`` over the rows that have both; NULL where the weights add up to zero."""
    both = F.when(F.col(value).isNotNull(), F.col(weight)).cast("double")
    return F.sum(F.col(value).cast("double") * both) / F.nullif(F.sum(both), F.lit(0.0))


def share_of_total(counts: DataFrame, count: str, out: str = "percentage", digits: int = 2) -> DataFrame:
    """Percent of the overall sum beside each group."""
    return counts.withColumn(out, percent(F.col(count), counts.agg(F.sum(count)).scalar(), digits))


def two_phase(df: DataFrame, keys: Sequence[str], sums: dict[str, str], salts: int = 16) -> DataFrame:
    """Count and sums in two steps, by key and salt and then by key. Sums are those of the columns as they are.

    Spark's own map-side step already covers plain sums; the explicit form also spreads aggregates without one.
    """
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*df.columns), F.lit(salts)))
    first = salted.groupBy(*keys, "_salt").agg(
        F.count(F.lit(1)).alias("_n"), *[F.sum(c).alias(f"_{o}") for o, c in sums.items()]
    )
    return first.groupBy(*keys).agg(
        F.sum("_n").alias("row_count"), *[F.sum(f"_{o}").cast("double").alias(o) for o in sums]
    )


def most_frequent(df: DataFrame, keys: Sequence[str], column: str, out: str) -> DataFrame:
    """Most frequent value per group; the smallest wins a tie. Only counts reach the group, not its rows."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(*keys, column).agg(F.count(F.lit(1)).alias("_n"))
    return counts.groupBy(*keys).agg(F.min_by(column, F.struct(-F.col("_n"), column)).alias(out))


def collect_chunks(
    df: DataFrame, keys: Sequence[str], column: str, order: Sequence[str], out: str, chunk: int = 1000
) -> DataFrame:
    """All values of a group as ordered arrays of at most ``chunk`` values, numbered by ``chunk_no``.

    ``collect_list`` puts a whole group in one row; a large group does not fit there.
    """
    rows = df.select(*keys, *dict.fromkeys([*order, column]))
    numbered = number_rows(rows, keys, [F.col(c) for c in order], "_at")
    placed = numbered.withColumn("chunk_no", F.floor((F.col("_at") - 1) / chunk))
    packed = placed.groupBy(*keys, "chunk_no").agg(
        F.sort_array(F.collect_list(F.struct("_at", F.col(column).alias("_v")))).alias("_rows")
    )
    return packed.select(*keys, "chunk_no", F.col("_rows._v").alias(out))


def null_profile(df: DataFrame) -> DataFrame:
    """One row per column: rows, NULL (or NaN) rows and their percentage, in one pass over the table."""

    def missing(field) -> Column:
        c = F.col(field.name)
        return c.isNull() | F.isnan(c) if field.dataType.typeName() in ("double", "float") else c.isNull()

    counts = df.agg(
        F.count(F.lit(1)).alias("_all"),
        *[F.count(F.when(missing(f), 1)).alias(f.name) for f in df.schema.fields],
    )
    pairs = [F.struct(F.lit(c).alias("column_name"), F.col(c).alias("null_count")) for c in df.columns]
    return (
        counts.select("_all", F.explode(F.array(*pairs)).alias("_p"))
        .select(F.col("_p.column_name"), F.col("_all").alias("row_count"), F.col("_p.null_count"))
        .withColumn("null_pct", percent(F.col("null_count"), F.col("row_count")))
    )


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per numeric column: count, mean, sample deviation, minimum, maximum. One pass."""
    stats = df.agg(
        *[
            F.struct(
                F.lit(c).alias("column_name"),
                F.count(c).alias("value_count"),
                F.round(F.avg(c).cast("double"), 6).alias("mean_value"),
                F.round(F.stddev_samp(c), 4).alias("stddev_value"),
                F.min(c).cast("double").alias("min_value"),
                F.max(c).cast("double").alias("max_value"),
            ).alias(f"_s_{c}")
            for c in columns
        ]
    )
    return stats.select(F.explode(F.array(*[f"_s_{c}" for c in columns])).alias("_s")).select("_s.*")


def pivot_counts(df: DataFrame, by: str, column: str, values: Sequence[str]) -> DataFrame:
    """Rows per ``by`` and listed value, one column each; NULL where there are none."""
    return df.groupBy(by).pivot(column, list(values)).agg(F.count(F.lit(1)))


def layer_counts(layers: dict[str, DataFrame]) -> DataFrame:
    """Row count of several tables as one table."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("layer"), "row_count")
        for name, df in layers.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def distinct_counts(
    df: DataFrame, keys: Sequence[str], counted: dict[str, str | tuple[str, Column]], measures: dict[str, tuple[str, Column]] | None = None
) -> DataFrame:
    """Several exact distinct counts per group, and further measures, without a copy of the rows per count.

    ``counted`` maps an output to a column, or to a column and a condition on its rows; ``measures`` to (sum | count | min | max, column).
    Rows are grouped by key and value first, with a flag per condition, and these groups are counted. So values are distinct before they meet their
    group, and a group with most rows stays spread over its values. Counts of one column share the steps; each further column reads its own two columns
    again, so ``df`` should be a table or written out. NULL is no value.
    """
    plain = {out: (spec, None) if isinstance(spec, str) else spec for out, spec in counted.items()}
    parts = []
    for member in dict.fromkeys(m for m, _ in plain.values()):
        flags = {out: condition for out, (m, condition) in plain.items() if m == member}
        carried = (measures or {}) if not parts else {}
        first = df.groupBy(*keys, F.col(member).alias("_member")).agg(
            F.count(F.lit(1)).alias("_rows"), *[F.max(F.when(c, 1)).alias(f"_f_{out}") for out, c in flags.items() if c is not None],
            *[STEPS[kind][0](column).alias(f"_m_{out}") for out, (kind, column) in carried.items()],
        )
        known = F.col("_member").isNotNull()
        parts.append(first.groupBy(*keys).agg(
            *[F.count(F.when(known if c is None else known & (F.col(f"_f_{out}") == 1), 1)).alias(out) for out, c in flags.items()],
            *[STEPS[kind][1](f"_m_{out}").alias(out) for out, (kind, _) in carried.items()],
        ))
    whole = reduce(lambda a, b: join_beside(a, b, keys), parts)
    return whole.select(*keys, *counted, *(measures or {}))


STEPS = {"sum": (F.sum, F.sum), "count": (F.count, F.sum), "min": (F.min, F.min), "max": (F.max, F.max)}


def sketched(df: DataFrame, keys: Sequence[str], columns: dict[str, str], precision: int = 12) -> DataFrame:
    """A mergeable sketch of the distinct values of each column per group (``output: column``), to be stored and rolled up later.

    The estimate from a sketch is within about ``1.04 / sqrt(2**precision)`` of the exact count in two of three cases.
    """
    return df.groupBy(*keys).agg(*[F.hll_sketch_agg(column, precision).alias(out) for out, column in columns.items()])


def rolled_up(sketches: DataFrame, keys: Sequence[str | Column], columns: Sequence[str]) -> DataFrame:
    """Stored sketches united per coarser group; the rows behind them are not read again."""
    return sketches.groupBy(*keys).agg(*[F.hll_union_agg(c).alias(c) for c in columns])


def estimates(sketches: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct counts in place of the sketches."""
    return sketches.withColumns({c: F.hll_sketch_estimate(c) for c in columns})


def completeness(df: DataFrame, keys: Sequence[str], member: str, fields: Sequence[str]) -> DataFrame:
    """Distinct members per group, those with each field, the percentage filled and a grade."""
    known = {f"with_{f}": (member, F.col(f).isNotNull()) for f in fields}
    counts = distinct_counts(df, keys, {"members": member, **known})
    filled = reduce(lambda a, b: a + b, [F.col(f"with_{f}") for f in fields])
    scored = counts.withColumn("filled_pct", percent(filled, F.col("members") * len(fields), 1))
    pct = F.col("filled_pct")
    grade = F.when(pct >= 90, "Excellent").when(pct >= 75, "Good").when(pct >= 50, "Fair").otherwise("Poor")
    return scored.withColumn("grade", grade)


def cumulative_share(counts: DataFrame, count: str, tie: str) -> DataFrame:
    """Pareto table over already grouped rows: running sum and cumulative percent, largest first."""
    run = running(counts, [], [F.col(count).desc(), F.col(tie)], {"running_total": ("sum", count)})
    return run.withColumn("cumulative_pct", percent(F.col("running_total"), counts.agg(F.sum(count)).scalar()))

