"""Checks on keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def unique_source(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``source`` with a check inside the job that no key comes twice."""
    rest = [c for c in source.columns if c not in keys]
    grouped = source.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"), F.max_by(F.struct(*rest), F.lit(1)).alias("_row")
    )
    twice = F.raise_error(F.lit("a source key matches more than one source row")).cast("boolean")
    checked = grouped.filter(F.when(F.col("_n") == 1, F.lit(True)).otherwise(twice))
    return checked.select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in source.columns])
