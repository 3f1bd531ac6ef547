"""Joins beyond a plain equi-join."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, functions as F

from tiffin.functions.columns import ratio
from tiffin.operators.windows import join_beside, latest_per_key, running

MICROS = 1_000_000


MOST_HOT = 1000  # hot keys a salted join takes


def hot_keys(df: DataFrame, key: str, share: float = 0.01) -> list:
    """Keys that hold more than ``share`` of all rows: fewer than ``1 / share``, whatever the table. One pass over the key column."""
    if share * MOST_HOT < 1:
        raise ValueError(f"a share below {1 / MOST_HOT} allows more than {MOST_HOT} keys")
    seen = Observation()
    counts = df.select(key).observe(seen, F.count(F.lit(1)).alias("rows")).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    top = counts.orderBy(F.desc("_n")).limit(int(1 / share)).collect()
    return [r[key] for r in top if r["_n"] > share * seen.get["rows"] and r[key] is not None]


def salted_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    salts: int = 32,
    hot: Sequence | None = None,
    share: float = 0.01,
    salt_by: Sequence[str] | None = None,
    how: str = "inner",
) -> DataFrame:
    """Inner or left join on ``key`` with the hot keys of ``left`` spread over ``salts`` tasks.

    Hot keys are given (at most ``MOST_HOT``), or counted: those above ``share`` of the rows. One join on (key, salt): the salt of a hot row is a
    hash of its content, so a repeated task gives the same rows, and 0 for the others; ``right`` rows of hot keys are copied once per salt.
    """
    if how not in ("inner", "left"):
        raise ValueError("how is inner or left: only the left side is salted")
    hot = hot_keys(left, key, share) if hot is None else list(dict.fromkeys(hot))
    if len(hot) > MOST_HOT:
        raise ValueError(f"{len(hot)} hot keys; a salted join takes {MOST_HOT}")
    by = salt_by or [c for c in left.columns if c != key]
    is_hot = F.coalesce(F.col(key).isin(hot), F.lit(False)) if hot else F.lit(False)
    salt = F.when(is_hot, F.pmod(F.xxhash64(*by), F.lit(salts)).cast("int")).otherwise(F.lit(0))
    copies = F.when(is_hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    salted = right.withColumn("_salt", F.explode(copies))
    return left.withColumn("_salt", salt).join(salted, [key, "_salt"], how).drop("_salt")


def interval_join(
    left: DataFrame, right: DataFrame, keys: tuple[str, str], times: tuple[str, str], seconds: int, how: str = "inner", parts: int = 1
) -> DataFrame:
    """Join on equal keys and ``left time <= right time <= left time + seconds``; inner or left.

    Both sides also carry a time bucket, a ``parts``-th of the interval wide, so a hot key is spread over its buckets and a row meets
    ``parts + 1`` buckets instead of the whole history of its key. A left row lies in one bucket; a right row is copied to its own
    and the ``parts`` before. So every pair, and every left row without a pair, comes out once, whatever ``parts``: more of them cut a hot key's tasks and
    stream state finer, for as many copies of the right side. Works on watermarked streams.
    """
    width = -(-seconds * MICROS // parts)
    bucket = lambda c: F.floor(F.unix_micros(c) / F.lit(width))
    lefts = left.withColumn("_bucket", bucket(times[0]))
    rights = right.withColumn("_right_bucket", F.explode(F.array(*[bucket(times[1]) - k for k in range(parts + 1)])))
    condition = (
        (F.col(keys[0]) == F.col(keys[1]))
        & (F.col("_bucket") == F.col("_right_bucket"))
        & (F.col(times[1]) >= F.col(times[0]))
        & (F.col(times[1]) <= F.col(times[0]) + F.expr(f"INTERVAL {seconds} SECONDS"))
    )
    return lefts.join(rights, condition, {"inner": "inner", "left": "leftOuter"}[how]).drop("_bucket", "_right_bucket")


def unify_sources(
    first: DataFrame,
    second: DataFrame,
    key: str,
    order: tuple[Sequence[Column | str], Sequence[Column | str]],
    prefer_first: Sequence[str] = (),
    newest: str | None = None,
) -> DataFrame:
    """One row per key from two partial sources.

    The latest row per key of each source, full outer joined. Columns of one source are taken over; the shared ones
    named in ``prefer_first`` come from ``first`` unless NULL there; ``newest`` is the greater of both.
    """
    a = latest_per_key(first.filter(F.col(key).isNotNull()), [key], order[0]).alias("a")
    b = latest_per_key(second.filter(F.col(key).isNotNull()), [key], order[1]).alias("b")
    columns = [F.coalesce(F.col(f"a.{key}"), F.col(f"b.{key}")).alias(key)]
    for name in dict.fromkeys([*first.columns, *second.columns]):
        if name == key:
            continue
        if name == newest:
            columns.append(F.greatest(f"a.{name}", f"b.{name}").alias(name))  # skips NULL
        elif name in prefer_first:
            columns.append(F.coalesce(F.col(f"a.{name}"), F.col(f"b.{name}")).alias(name))
        elif name in first.columns and name in second.columns:
            raise ValueError(f"column {name} is in both sources: name it in prefer_first or newest")
        else:
            columns.append(F.col(f"a.{name}" if name in first.columns else f"b.{name}"))
    return a.join(b, F.col(f"a.{key}") == F.col(f"b.{key}"), "full").select(*columns)


def best_rows(df: DataFrame, keys: Sequence[str], by: str) -> DataFrame:
    """Rows that hold the maximum of their group, all of them on a tie: ``(keys, by) IN (SELECT keys, max(by) ..)``."""
    best = df.groupBy(*keys).agg(F.max(by).alias(by))
    return df.join(best, [*keys, by], "left_semi")


def lookup(df: DataFrame, column: str, mapping: dict[str, str], out: str) -> DataFrame:
    """Fixed mapping as a literal map: no shuffle, no UDF; a value not in it gives NULL."""
    pairs = [F.lit(x) for item in mapping.items() for x in item]
    return df.withColumn(out, F.create_map(*pairs)[F.col(column)])


def with_points(df: DataFrame, points: Sequence[dict], fields: str) -> DataFrame:
    """Every row beside each of a fixed list of points.

    The literal list is exploded, which keeps the rows where they are; ``fields`` is a DDL list.
    """
    names = [f.strip().split()[0] for f in fields.split(",")]
    types = [f.strip().split()[1] for f in fields.split(",")]
    literals = [F.struct(*[F.lit(p[n]).cast(ty).alias(n) for n, ty in zip(names, types)]) for p in points]
    return df.withColumn("_point", F.explode(F.array(*literals))).select(
        *df.columns, *[F.col(f"_point.{n}").alias(n) for n in names]
    )


def city_match(left: DataFrame, right: DataFrame, city: str, left_id: str, right_id: str, value: str) -> DataFrame:
    """Two populations per shared city: distinct members of both sides, their ratio and the mean of a right value.

    Both sides are grouped first. Joining the rows themselves gives the same numbers through every pair in the city.
    """
    a = left.groupBy(city).agg(F.countDistinct(left_id).alias("left_count"))
    b = right.groupBy(city).agg(
        F.countDistinct(right_id).alias("right_count"),
        F.avg(value).alias("_mean"),
    )
    return a.join(b, city).select(
        city,
        "left_count",
        "right_count",
        ratio(F.col("right_count"), F.col("left_count")).alias("right_per_left"),
        F.round("_mean", 2).cast("double").alias("mean_value"),
    )


def partners_beyond(df: DataFrame, keys: Sequence[str], by: str, gap: int) -> DataFrame:
    """How many rows of the same group lie more than ``gap`` above and below each row.

    Answers the question of a self join ``a.key = b.key AND abs(a.by - b.by) > gap`` without its pairs. ``by`` must be
    integer. Each distinct value is an event in a running count, together with two probes at ``by - gap`` and
    ``by + gap``.
    """
    counts = df.filter(F.col(by).isNotNull()).groupBy(*keys, by).agg(F.count(F.lit(1)).alias("_n"))
    event = lambda at, kind, n: F.struct(at.alias("at"), F.lit(kind).alias("kind"), n.alias("n"))
    value, zero = F.col(by).cast("bigint"), F.lit(0).cast("bigint")
    # At one position: the probe from above counts what lies strictly below, the probe from below what is not above.
    events = counts.select(
        *keys,
        value.alias("_value"),
        F.explode(
            F.array(
                event(value - gap, 0, zero), event(value, 1, F.col("_n")), event(value + gap, 2, zero)
            )
        ).alias("_e"),
    ).select(*keys, "_value", "_e.*")
    run = running(events, keys, [F.col("at"), F.col("kind"), F.col("_value")], {"_upto": ("sum", "n")})
    per_value = run.groupBy(*keys, "_value").agg(
        F.max(F.when(F.col("kind") == 0, F.col("_upto"))).alias("partners_below"),
        F.max(F.when(F.col("kind") == 2, F.col("_upto"))).alias("_not_above"),
    )
    totals = counts.groupBy(*keys).agg(F.sum("_n").alias("_total"))
    found = join_beside(per_value, totals, keys).select(
        *keys,
        F.col("_value").cast(df.schema[by].dataType).alias(by),
        "partners_below",
        (F.col("_total") - F.col("_not_above")).alias("partners_above"),
    )
    return join_beside(df, found, [*keys, by])


def snapshot_changes(
    current: DataFrame, previous: DataFrame, key: str, fields: dict[str, str], new_label: str, null_safe: bool = False
) -> DataFrame:
    """Rows of ``current`` that are new or differ from ``previous``, with the first differing field as ``change_type``.

    With ``null_safe=False`` a change from or to NULL is not seen, as with ``!=`` in SQL.
    """
    c, p = current.alias("c"), previous.alias("p")

    def differs(field: str) -> Column:
        now, before = F.col(f"c.{field}"), F.col(f"p.{field}")
        return ~now.eqNullSafe(before) if null_safe else F.coalesce(now != before, F.lit(False))

    missing = F.col(f"p.{key}").isNull()
    kind = F.when(missing, new_label)
    for field, label in fields.items():
        kind = kind.when(differs(field), label)
    changed = reduce(lambda a, b: a | b, [differs(f) for f in fields], missing)
    return (
        c.join(p, F.col(f"c.{key}") == F.col(f"p.{key}"), "left")
        .filter(changed)
        .select(
            F.col(f"c.{key}").alias(key),
            kind.alias("change_type"),
            *[F.col(f"p.{f}").alias(f"old_{f}") for f in fields],
            *[F.col(f"c.{f}").alias(f"new_{f}") for f in fields],
        )
    )
