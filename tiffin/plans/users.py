"""User reports: unified users from two sources, in batch and from change feeds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tiffin.functions.columns import age_years, count_where, percent, ratio
from tiffin.operators.aggs import completeness, distinct_counts, most_frequent, share_of_total
from tiffin.operators.cdc import scd1, scd2
from tiffin.operators.windows import join_beside
from tiffin.sources.files import stream_files
from tiffin.streaming.history import keep_versions
from tiffin.streaming.streams import append_files, merge_state

# Age groups of the user report.
AGE_GROUPS = [
    (18, 25, "18-25 (Young Adults)"), (26, 35, "26-35 (Millennials)"), (36, 50, "36-50 (Gen X)"), (51, 65, "51-65 (Boomers)"),
]
SENIORS = "65+ (Seniors)"


def age_group(birthday: str, as_of: Column) -> Column:
    age = age_years(birthday, as_of)
    result = F.when(F.col(birthday).isNull(), "Unknown")
    for low, high, label in AGE_GROUPS:
        result = result.when(age.between(low, high), label)
    return result.when(age > 65, SENIORS).otherwise("Unknown")


def change_metrics(history: DataFrame, key: str, moment: str, as_of: Column) -> DataFrame:
    """Changes per user, the last one, and the days since."""
    return history.groupBy(key).agg(
        (F.count(F.lit(1)) - 1).alias("total_changes"), F.max(moment).alias("last_change_date"),
        F.datediff(as_of, F.max(moment)).alias("days_since_last_change"),
    )


def user_analytics(
    users: DataFrame, history: DataFrame, key: str, group: Sequence[str], fields: Sequence[str], category: str, moment: str, as_of: Column,
    busy: int = 5,
) -> DataFrame:
    """Members, completeness with grade, most frequent category and change activity per group."""
    metrics = change_metrics(history, key, moment, as_of)
    joined = users.join(metrics, key, "left").fillna(0, ["total_changes"])
    full = F.lit(True)
    for field in fields:
        full = full & F.col(field).isNotNull()
    activity = joined.groupBy(*group).agg(
        count_where(full).alias("complete_profiles"),
        ratio(F.sum("total_changes"), F.count(F.lit(1)), 1).alias("avg_changes_per_user"),
        count_where(F.col("total_changes") > busy).alias("high_activity_users"),
        F.max("last_change_date").alias("most_recent_change"),
    )
    filled = completeness(users, group, key, fields)
    top = most_frequent(users, group, category, "top_category")
    return join_beside(join_beside(filled, activity, list(group)), top, list(group), "left")


def merge_feeds(first: DataFrame, second: DataFrame) -> DataFrame:
    """Two partial change feeds as one, with NULL for what a feed does not know."""
    return first.unionByName(second, allowMissingColumns=True)


def current_users(changes: DataFrame, key: str, seq: str, operation: str, ignore_nulls: bool = False) -> DataFrame:
    return scd1(changes, [key], seq, F.col(operation) == "DELETE", exclude=[operation], ignore_nulls=ignore_nulls)


def user_history(changes: DataFrame, key: str, seq: str, operation: str, track: Sequence[str]) -> DataFrame:
    return scd2(changes, [key], seq, track, F.col(operation) == "DELETE", exclude=[operation])


def run_feeds(
    first: DataFrame, second: DataFrame, base: str, key: str, seq: str, operation: str, track: Sequence[str], settle_every: int | None = 10
) -> dict[str, str]:
    """Two change streams into one staging table and, from there, the current state and the versions per key, all as streams.

    Running it again takes up new changes, late ones too. ``current_state`` and ``versions`` read the tables.
    """
    paths = {name: f"{base}/{name}" for name in ("staging", "current", "history")}
    marks = {name: f"{base}/checkpoints/{name}" for name in paths}
    changes, gone = merge_feeds(first, second), F.col(operation) == "DELETE"
    append_files(changes, paths["staging"], marks["staging"])
    staged = stream_files(changes.sparkSession, paths["staging"], changes.schema)
    merge_state(staged, paths["current"], marks["current"], [key], seq, gone, settle_every)
    keep_versions(staged, paths["history"], marks["history"], [key], seq, track, gone, [operation], settle_every=settle_every)
    return paths


def demographics(current: DataFrame, group: str, key: str, fields: Sequence[str]) -> DataFrame:
    """Users per group and those with each field. Counted in two steps, by user and by group, so that each row is read once for all counts."""
    known = {f"users_with_{f}": (key, F.col(f).isNotNull()) for f in fields}
    return distinct_counts(current, [group], {"total_users": key, **known})


def city_distribution(users: DataFrame, city: str) -> DataFrame:
    named = users.filter(F.col(city).isNotNull() & (F.col(city) != ""))
    counts = named.groupBy(city).agg(F.count(F.lit(1)).alias("user_count"))
    whole = users.agg(F.count(F.lit(1))).scalar()
    return counts.withColumn("percentage", percent(F.col("user_count"), whole))


def email_domains(users: DataFrame, email: Column) -> DataFrame:
    """Users per e-mail domain."""
    domain = F.lower(F.expr("substring(_email, locate('@', _email) + 1)"))
    counted = users.select(email.alias("_email")).filter(F.col("_email").isNotNull()).groupBy(domain.alias("email_domain"))
    return share_of_total(counted.agg(F.count(F.lit(1)).alias("user_count")), "user_count")
