"""Column expressions. Everything is built from Spark functions and stays inside code generation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

EARTH_RADIUS_KM = 6371


def as_column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---------------------------------------------------------------- numbers


def money(c: Column | str) -> Column:
    """Exact decimal, so that sums do not depend on the order of the rows."""
    return as_column(c).cast("decimal(18,2)")


def total(c: Column | str) -> Column:
    """Exact sum of an amount, shown as double."""
    return F.sum(money(c)).cast("double")


def ratio(above: Column, below: Column, digits: int = 2, factor: int = 1) -> Column:
    """``factor * above / below`` in decimal arithmetic, rounded half up; NULL when ``below`` is zero."""
    exact = above.cast("decimal(28,2)") * F.lit(factor) / F.nullif(below.cast("decimal(20,0)"), F.lit(0))
    return F.round(exact, digits).cast("double")


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    return ratio(part, whole, digits, 100)


def mean(c: Column | str, digits: int = 2) -> Column:
    """Rounded average of an amount from its exact sum."""
    return ratio(F.sum(money(c)), F.count(as_column(c)), digits)


def count_where(condition: Column) -> Column:
    """Rows for which the condition is true, as the sum of a CASE gives it (0 when none)."""
    return F.sum(F.when(condition, 1).otherwise(0))


def band(
    c: Column | str,
    edges: Sequence[float],
    labels: Sequence[str],
    right: bool = False,
    otherwise: str | None = None,
) -> Column:
    """Label by ascending edges.

    ``labels[i]`` covers ``edges[i] <= c < edges[i+1]``; with ``right=True`` it covers
    ``edges[i] < c <= edges[i+1]``. Values outside all edges and NULL give ``otherwise``.
    One label more than gaps leaves the last band open to the top.
    """
    value, result = as_column(c), None
    for i, label in enumerate(labels):
        inside = value > edges[i] if right else value >= edges[i]
        if i + 1 < len(edges):
            inside = inside & (value <= edges[i + 1] if right else value < edges[i + 1])
        result = F.when(inside, label) if result is None else result.when(inside, label)
    return result if otherwise is None else result.otherwise(otherwise)


def tier(c: Column | str, floors: Sequence[tuple[float, str]], otherwise: str, missing: str | None = None) -> Column:
    """First label whose floor the value reaches. A NULL value gives ``missing`` when that is set."""
    value = as_column(c)
    result = F.when(value.isNull(), missing) if missing is not None else None
    for floor, label in floors:
        reached = value >= floor
        result = F.when(reached, label) if result is None else result.when(reached, label)
    return result.otherwise(otherwise)


def above_tier(c: Column | str, floors: Sequence[tuple[float, str]], otherwise: str) -> Column:
    """Like ``tier`` with strict comparison."""
    value, result = as_column(c), None
    for floor, label in floors:
        result = F.when(value > floor, label) if result is None else result.when(value > floor, label)
    return result.otherwise(otherwise)


def valid_or_null(c: Column | str, low: float, high: float) -> Column:
    value = as_column(c)
    return F.when(value.between(low, high), value)


def popularity(rating: Column | str, reviews: Column | str, scale: int = 1000) -> Column:
    """``rating * sqrt(reviews / scale)``; 0 when either is missing."""
    score = as_column(rating) * F.sqrt(as_column(reviews) / F.lit(scale))
    return F.coalesce(score, F.lit(0.0))


def log_score(rating: Column | str, reviews: Column | str) -> Column:
    return F.pow(as_column(rating), 2) * F.log(as_column(reviews) + 1)


def floored_log_score(rating: Column | str, reviews: Column | str, least: int = 10) -> Column:
    return as_column(rating) * F.log10(F.greatest(as_column(reviews), F.lit(least)))


def weighted_score(parts: Sequence[tuple[float, Column, Column]]) -> Column:
    """Sum of ``weight * value / maximum``; a maximum of zero or less counts as one."""
    result = F.lit(0.0)
    for weight, value, top in parts:
        result = result + F.lit(weight) * (value / F.when(top > 0, top).otherwise(F.lit(1.0)))
    return result


def delivery_fee(amount: Column | str, share: str = "0.10") -> Column:
    return money(amount) * F.lit(share).cast("decimal(4,2)")


def delivery_eta(distance_km: Column | str, per_km: float = 2, base: float = 15) -> Column:
    return as_column(distance_km) * F.lit(per_km) + F.lit(base)


# ---------------------------------------------------------------- text


def strip_phone(c: Column | str) -> Column:
    """Drop brackets, blanks and hyphens."""
    return F.regexp_replace(as_column(c), r"[()\s-]", "")


def strip_phone_signs(c: Column | str) -> Column:
    """Drop brackets, plus and hyphens but keep blanks."""
    return F.regexp_replace(as_column(c), r"[()+-]", "")


def hyphen_phone(c: Column | str) -> Column:
    """``(12)345`` becomes ``12-345``."""
    return F.replace(F.replace(as_column(c), F.lit("("), F.lit("")), F.lit(")"), F.lit("-"))


def email_domain(c: Column | str) -> Column:
    return F.lower(F.substring_index(as_column(c), "@", -1))


def full_name(*parts: Column | str) -> Column:
    """Parts with blanks between; NULL when a part is NULL."""
    joined: list[Column] = []
    for part in parts:
        joined += [F.lit(" "), as_column(part)] if joined else [as_column(part)]
    return F.concat(*joined)


def keyword_group(c: Column | str, groups: Sequence[tuple[str, Sequence[str]]], other: str, missing: str) -> Column:
    """First group with a keyword contained in the text."""
    value = as_column(c)
    result = F.when(value.isNull(), missing)
    for label, words in groups:
        hit = F.lit(False)
        for word in words:
            hit = hit | value.like(f"%{word}%")
        result = result.when(hit, label)
    return result.otherwise(other)


def row_hash(*columns: str) -> Column:
    """Hash of a row; NULL and the empty text differ."""
    shown = [F.coalesce(F.concat(F.lit("v"), F.col(c).cast("string")), F.lit("n")) for c in columns]
    return F.sha2(F.concat_ws("\x1f", *shown), 256)


# ---------------------------------------------------------------- time


def seconds_between(later: Column | str, earlier: Column | str) -> Column:
    """Whole seconds between two times, each cut to the second first."""
    return F.abs(F.unix_seconds(as_column(later)) - F.unix_seconds(as_column(earlier)))


def minutes_between(later: Column | str, earlier: Column | str) -> Column:
    return seconds_between(later, earlier) / F.lit(60)


def age_years(birthday: Column | str, as_of: Column) -> Column:
    return F.floor(F.datediff(as_of, as_column(birthday)) / F.lit(365.25))


def weekday_name(c: Column | str) -> Column:
    return F.date_format(as_column(c), "EEEE")


# ---------------------------------------------------------------- place


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance."""
    p1, p2 = F.radians(lat1), F.radians(lat2)
    half_lat, half_lon = (p2 - p1) / 2, (F.radians(lon2) - F.radians(lon1)) / 2
    chord = F.pow(F.sin(half_lat), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(half_lon), 2)
    return 2 * EARTH_RADIUS_KM * F.asin(F.sqrt(chord))
