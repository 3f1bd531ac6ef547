"""Python functions inside tasks, for logic a user wants to keep in Python or pandas.

Each has a counterpart built from Spark functions; those are faster and the ones the reports use.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tiffin.functions.columns import tier

# Workers get these functions by value and need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

Floors = Sequence[tuple[float, str]]


def label_by_floor(floors: Floors, otherwise: str, missing: str = "Unknown") -> Callable:
    """Plain Python form of ``columns.tier`` with a branch for NULL."""

    def label(value):
        if value is None:
            return missing
        return next((name for floor, name in floors if value >= floor), otherwise)

    return label


def label_udf(floors: Floors, otherwise: str):
    return F.udf(label_by_floor(floors, otherwise), T.StringType(), useArrow=True)


def register_label(spark: SparkSession, name: str, floors: Floors, otherwise: str) -> None:
    """The same function for SQL text."""
    spark.udf.register(name, label_udf(floors, otherwise))


@F.pandas_udf(T.DoubleType())
def log_score_pandas(rating: pd.Series, reviews: pd.Series) -> pd.Series:
    """``rating² · log(1 + reviews) / 10`` over Arrow batches."""
    return rating**2 * np.log1p(reviews) / 10


@F.pandas_udf(T.DoubleType())
def scale_pandas(value: pd.Series, mean: pd.Series, deviation: pd.Series) -> pd.Series:
    return (value - mean) / deviation


def clean_names(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Partition-wise step for ``mapInPandas``: text length and the name without its last word, batch by batch."""
    for rows in batches:
        yield rows.assign(
            name_length=rows["name"].str.len().astype("int64"),
            name_clean=rows["name"].str.replace(r" \S+$", "", regex=True),
        )


def weighted_parts(key: str, value: str, weight: str) -> Callable:
    """Partial sums per batch and key for ``weighted_mean_pandas``."""

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            parts = pd.DataFrame({key: rows[key], "xw": rows[value] * rows[weight], "w": rows[weight].astype("float64")})
            yield parts.groupby(key, as_index=False, dropna=False)[["xw", "w"]].sum()

    return sums


def weighted_mean_pandas(df: DataFrame, key: str, value: str, weight: str, out: str) -> DataFrame:
    """Weighted mean by group in pandas.

    A grouped-aggregate UDF gets all rows of a group at once. Here pandas sums each Arrow batch and Spark adds the parts.
    """
    kind = df.schema[key].dataType.simpleString()
    parts = df.select(key, value, weight).mapInPandas(weighted_parts(key, value, weight), f"{key} {kind}, xw double, w double")
    sums = parts.groupBy(key).agg(F.sum("xw").alias("xw"), F.sum("w").alias("w"))
    return sums.select(key, F.when(F.col("w") > 0, F.col("xw") / F.col("w")).otherwise(F.lit(0.0)).alias(out))


def same_label(value: str, floors: Floors, otherwise: str) -> Column:
    """Whether the Python function and the built-in expression agree on a row."""
    return label_udf(floors, otherwise)(F.col(value)).eqNullSafe(tier(value, floors, otherwise, missing="Unknown"))
