"""Row rules, validators, outliers and row counting."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, functions as F, types as T

from tiffin.operators.windows import beside, framed, join_beside, percentiles
from tiffin.session import durable

DROP, WARN, FAIL = "drop", "warn", "fail"


class QualityError(ValueError):
    """A validator found the data wrong."""


@dataclass(frozen=True)
class Rule:
    """A condition rows should meet. ``null_passes`` says what a condition without answer means."""

    name: str
    condition: str | Column
    action: str = DROP
    null_passes: bool = False

    def holds(self) -> Column:
        condition = F.expr(self.condition) if isinstance(self.condition, str) else self.condition
        return F.coalesce(condition, F.lit(self.null_passes))


def expect(df: DataFrame, rules: Sequence[Rule], observation: Observation | None = None) -> DataFrame:
    """Drop rows that break a DROP rule and stop the job at a row that breaks a FAIL rule; WARN rules only count.

    With ``observation`` the rows broken per rule are counted while the data passes, without a job of their own.
    """
    if observation is not None:
        df = df.observe(
            observation,
            F.count(F.lit(1)).alias("rows"),
            *[F.count(F.when(~rule.holds(), 1)).alias(rule.name) for rule in rules],
        )
    for rule in rules:
        if rule.action == FAIL:
            failed = F.raise_error(F.lit(f"row breaks rule {rule.name}")).cast("boolean")
            df = df.filter(F.when(rule.holds(), F.lit(True)).otherwise(failed))
    drops = [rule.holds() for rule in rules if rule.action == DROP]
    return df.filter(reduce(lambda a, b: a & b, drops)) if drops else df


def rule_report(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """One row per rule: rows and broken rows, in one pass."""
    counts = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count(F.when(~rule.holds(), 1)).alias(f"_{i}") for i, rule in enumerate(rules)],
    )
    entries = [
        F.struct(F.lit(rule.name).alias("rule"), F.lit(rule.action).alias("action"), F.col(f"_{i}").alias("broken"))
        for i, rule in enumerate(rules)
    ]
    return counts.select(F.col("_rows").alias("row_count"), F.explode(F.array(*entries)).alias("_e")).select("_e.*", "row_count")


def broken_rows(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows that break at least one rule, with the names of the broken rules."""
    names = F.array_compact(F.array(*[F.when(~rule.holds(), F.lit(rule.name)) for rule in rules]))
    return df.withColumn("broken_rules", names).filter(F.size("broken_rules") > 0)


def validate_schema(df: DataFrame, expected: T.StructType, types: bool = True) -> DataFrame:
    """Raise unless all expected columns are there, with the expected types unless ``types=False``."""
    have = {f.name: f.dataType for f in df.schema.fields}
    missing = [f.name for f in expected.fields if f.name not in have]
    if missing:
        raise QualityError(f"missing columns: {missing}")
    wrong = [f.name for f in expected.fields if types and have[f.name] != f.dataType]
    if wrong:
        raise QualityError(f"columns of another type: {wrong}")
    return df


def validate_rows(df: DataFrame, least: int) -> DataFrame:
    """Raise unless there are ``least`` rows. Reads no more rows than that."""
    found = df.limit(least).count()
    if found < least:
        raise QualityError(f"{found} rows, expected at least {least}")
    return df


def validate_no_nulls(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Raise when one of the columns holds NULL; one pass for all of them, columns that are not there are skipped."""
    present = [c for c in columns if c in df.columns]
    counts = df.agg(*[F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in present]).first()
    bad = {c: counts[c] for c in present if counts[c]}
    if bad:
        raise QualityError(f"NULL values: {bad}")
    return df


def outliers(df: DataFrame, keys: Sequence[str], value: str, limit: float = 2, least: int = 3) -> DataFrame:
    """Rows further than ``limit`` standard deviations from the mean of their group; small groups are left out."""
    stats = beside(
        df, keys,
        group_mean=F.avg(value),
        _sd=F.stddev_samp(value),
        _n=F.count(F.lit(1)),
    )
    z = (F.col(value) - F.col("group_mean")) / F.col("_sd")
    return stats.filter((F.col("_n") >= least) & (F.abs(z) > limit)).withColumn("z_score", z).drop("_sd", "_n")


def transitions(df: DataFrame, key: str, status: str, time: str, tie: str) -> DataFrame:
    """Status pairs that follow each other: how often, and average, least, greatest and median minutes between."""
    follow = framed(
        df.select(key, status, time, tie), [key], [F.col(time), F.col(tie)],
        lambda w: {"next_status": F.lead(status).over(w), "_next": F.lead(time).over(w)},
        after=1,
    ).filter(F.col("next_status").isNotNull())
    # Written once: the figures and the medians both read it.
    timed = durable(follow.select(status, "next_status", (F.unix_millis("_next") - F.unix_millis(time)).alias("_ms")), "transitions")
    group = [status, "next_status"]
    stats = timed.groupBy(*group).agg(
        F.count(F.lit(1)).alias("transitions"),
        (F.sum("_ms").cast("double") / F.count("_ms") / 60000).alias("avg_minutes"),
        (F.min("_ms") / 60000).alias("min_minutes"),
        (F.max("_ms") / 60000).alias("max_minutes"),
    )
    medians = percentiles(timed, group, "_ms", {"_median": 0.5})
    return join_beside(stats, medians, group).withColumn("median_minutes", F.col("_median") / 60000).drop("_median")


def count_rows(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Count the rows that pass this step as part of the next action; read ``observation.get["rows"]`` afterwards."""
    observation = Observation(name)
    return df.observe(observation, F.count(F.lit(1)).alias("rows")), observation
