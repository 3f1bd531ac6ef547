"""Window functions that do not gather a large key in one task.

A plain ``Window.partitionBy(key)`` sends all rows of a key to one task, and a window without key sends the whole
table there. The functions here split the sorted rows by range, work on each piece and pass on what crosses the borders, whatever the
sizes. ``bounded=True`` is for callers whose groups have a fixed bound by contract, such as n rows per key after a limit: it takes the plain
window. Nothing is measured to choose between the two.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tiffin.session import durable

SLICE_BITS = 33  # monotonically_increasing_id keeps the row within the partition in the low 33 bits
MERGE = {"sum": lambda a, b: a + b, "count": lambda a, b: a + b, "max": F.greatest, "min": F.least}
AGGREGATE = {"sum": F.sum, "count": F.count, "max": F.max, "min": F.min}
BLOCK_ROWS = 200_000
LAST_STEP = {"sum": F.sum, "count": F.sum, "max": F.max, "min": F.min}


def join_beside(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on ``keys`` null-safely and keep one copy of them.

    No hint: the adaptive plan broadcasts ``right`` when its measured size allows and splits hot keys of
    ``left`` otherwise.
    """
    renamed = right.select(*[F.col(c).alias(f"__r_{c}") if c in keys else F.col(c) for c in right.columns])
    condition = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__r_{k}")) for k in keys])
    return left.join(renamed, condition, how).drop(*[f"__r_{k}" for k in keys])


def ordered(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], parts: int | None = None) -> DataFrame:
    """Rows sorted by ``keys`` and ``order`` over many partitions, with ``_pos`` growing in that order.

    ``order`` should be total. A hot key simply covers several partitions. The result is written out, because its range
    bounds come from a sample and every consumer has to see the same ones. Pass only the columns that are needed. Given
    to ``running`` or ``framed``, the result is not sorted again.
    """
    if "_pos" in df.columns:
        return df  # comes from an ordered table already
    columns = [*[F.col(k) for k in keys], *order]
    # Without a number, adaptive execution joins small neighbouring ranges.
    split = (df.repartitionByRange(parts, *columns) if parts else df.repartitionByRange(*columns)).sortWithinPartitions(*columns)
    return durable(split.withColumn("_pos", F.monotonically_increasing_id()), "ordered")


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column | str],
    aggregates: dict[str, tuple[str, str]],
    parts: int | None = None,
    bounded: bool = False,
) -> DataFrame:
    """Running aggregates, ``ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW``.

    ``aggregates`` maps an output column to (sum | count | min | max, input column); sums want decimals or integers.
    ``bounded`` states that a key's rows fit one task by contract, whatever the table. ``order`` has to be total either way.
    """
    if bounded:
        frame = W.partitionBy(*keys).orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow)
        return df.select("*", *[AGGREGATE[kind](column).over(frame).alias(out) for out, (kind, column) in aggregates.items()])
    rows = ordered(df, keys, order, parts).withColumn("_slice", F.shiftright("_pos", SLICE_BITS))
    group = ["_slice", *keys]
    local = W.partitionBy(*group).orderBy("_pos").rowsBetween(W.unboundedPreceding, W.currentRow)
    before = W.partitionBy(*keys).orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)
    totals = rows.groupBy(*group).agg(
        *[AGGREGATE[kind](column).alias(f"_t_{out}") for out, (kind, column) in aggregates.items()],
        F.count(F.lit(1)).alias("_rows"),
    )
    # One border between slices is crossed by one key at most, so fewer rows than slices are left here.
    carry = totals.select(
        *[F.col(c).alias(f"_c_{c}") for c in group],
        *[LAST_STEP[kind](f"_t_{out}").over(before).alias(f"_b_{out}") for out, (kind, _) in aggregates.items()],
        F.sum("_rows").over(before).alias("_seen"),
    ).filter(F.col("_seen").isNotNull())
    condition = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_c_{c}")) for c in group])
    result = rows.select(
        "*",
        *[AGGREGATE[kind](column).over(local).alias(f"_l_{out}") for out, (kind, column) in aggregates.items()],
    ).join(F.broadcast(carry), condition, "left")
    merged = []
    for out, (kind, _) in aggregates.items():
        here, earlier = F.col(f"_l_{out}"), F.col(f"_b_{out}")
        if kind in ("max", "min"):
            merged.append(MERGE[kind](here, earlier).alias(out))  # both skip NULL
        else:
            merged.append(F.coalesce(MERGE[kind](here, earlier), here, earlier).alias(out))
    return result.select(*df.columns, *merged)


def number_rows(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], out: str = "row_number") -> DataFrame:
    """ROW_NUMBER over a total order."""
    return (
        running(df.withColumn("_one", F.lit(1).cast("bigint")), keys, order, {out: ("sum", "_one")}).drop("_one")
    )


def sorting(by: str, descending: bool) -> Column:
    """Spark's default place for NULL: first when ascending, last when descending."""
    return F.col(by).desc_nulls_last() if descending else F.col(by).asc_nulls_first()


def ranks(
    df: DataFrame,
    keys: Sequence[str],
    by: str,
    outputs: dict[str, str],
    descending: bool = False,
) -> DataFrame:
    """Rank functions over one value column.

    ``outputs`` maps an output column to rank, dense_rank, percent_rank, cume_dist, average_rank or max_rank.
    Ties are counted before the shuffle, so neither a hot key nor a hot value reaches one task. NULL sorts first when
    ascending and last when descending, as in Spark SQL; ``average_rank`` follows pandas and gives NULL for it.
    """
    values = value_ranks(df.groupBy(*keys, by).agg(F.count(F.lit(1)).alias("_n")), keys, by, outputs, descending)
    return join_beside(df, values.select(*keys, by, *outputs), [*keys, by])


def ranks_many(df: DataFrame, specs: Sequence[tuple], descending: bool = True) -> DataFrame:
    """Several ranks of one table: (keys, column, outputs) each, as in ``ranks``, with a direction of its own as a fourth entry where needed.

    The table is written once. The counts of all columns' values are then stacked, sorted and numbered together, in one sorted copy whatever the
    number of ranks; each rank joins back from there.
    """
    base = durable(df, "ranked")
    specs = [(*spec, descending)[:4] for spec in specs]
    keys = list(dict.fromkeys(k for spec in specs for k in spec[0]))
    values = list(dict.fromkeys((by, down) for _, by, _, down in specs))
    types = {f.name: f.dataType for f in df.schema.fields}
    name = {v: f"_v{n}" for n, v in enumerate(values)}
    parts = []
    for number, (own, by, _, down) in enumerate(specs):
        counts = base.groupBy(*own, by).agg(F.count(F.lit(1)).alias("_n"))
        parts.append(counts.select(
            F.lit(number).alias("_spec"), *[(F.col(k) if k in own else F.lit(None).cast(types[k])).alias(f"_k{n}") for n, k in enumerate(keys)],
            *[(F.col(by) if v == (by, down) else F.lit(None).cast(types[v[0]])).alias(name[v]) for v in values], "_n",
        ))
    stacked = reduce(DataFrame.unionByName, parts).withColumn("_one", F.lit(1).cast("bigint"))
    group, order = ["_spec", *[f"_k{n}" for n in range(len(keys))]], [sorting(name[v], v[1]) for v in values]
    placed = ordered(stacked, group, order)
    run = running(placed, group, order, {"_upto": ("sum", "_n"), "_dense": ("sum", "_one")})
    if {"percent_rank", "cume_dist"} & {kind for spec in specs for kind in spec[2].values()}:
        run = beside_total(run, placed, group)
    run = durable(run.drop("_pos"), "ranks")
    result = base
    for number, (own, by, outputs, down) in enumerate(specs):
        forms, mine = rank_forms(name[by, down]), run.filter(F.col("_spec") == number)
        found = mine.select(
            *[F.col(f"_k{n}").alias(k) for n, k in enumerate(keys) if k in own], F.col(name[by, down]).alias(by),
            *[forms[kind]().alias(out) for out, kind in outputs.items()],
        )
        result = join_beside(result, found, [*own, by])
    return result


def rank_forms(by: str) -> dict[str, Callable[[], Column]]:
    """Rank columns from the running count ``_upto`` of rows, ``_dense`` of values, the value's rows ``_n`` and the key's rows ``_total``."""
    rank = F.col("_upto") - F.col("_n") + 1
    return {
        "rank": lambda: rank,
        "dense_rank": lambda: F.col("_dense"),
        "max_rank": lambda: F.col("_upto"),
        "average_rank": lambda: F.when(F.col(by).isNotNull(), rank + (F.col("_n") - 1) / F.lit(2.0)),
        "percent_rank": lambda: F.when(F.col("_total") > 1, (rank - 1) / (F.col("_total") - 1)).otherwise(F.lit(0.0)),
        "cume_dist": lambda: F.col("_upto") / F.col("_total"),
    }


def pandas_rank(
    df: DataFrame, keys: Sequence[str], by: str, outputs: dict[str, str], ascending: bool = True
) -> DataFrame:
    """``groupby(keys)[by].rank(method)``; ``outputs`` maps an output column to average, min, max or dense.

    NULL takes no part and gets NULL.
    """
    kinds = {"average": "average_rank", "min": "rank", "max": "max_rank", "dense": "dense_rank"}
    known = df.filter(F.col(by).isNotNull())
    counts = known.groupBy(*keys, by).agg(F.count(F.lit(1)).alias("_n"))
    values = value_ranks(counts, keys, by, {out: kinds[method] for out, method in outputs.items()}, not ascending)
    return join_beside(df, values.select(*keys, by, *outputs), [*keys, by], "left")


def beside_total(rows: DataFrame, counts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Sum of ``_n`` per key as ``_total``; without keys a scalar subquery."""
    if not keys:
        return rows.withColumn("_total", counts.agg(F.sum("_n")).scalar())
    return join_beside(rows, counts.groupBy(*keys).agg(F.sum("_n").alias("_total")), keys)


def value_ranks(
    counts: DataFrame, keys: Sequence[str], by: str, outputs: dict[str, str], descending: bool = False
) -> DataFrame:
    """Rank columns for a table of distinct values with their row count ``_n``."""
    direction = sorting(by, descending)
    placed = ordered(counts.withColumn("_one", F.lit(1).cast("bigint")), keys, [direction])  # counted once, read twice
    run = running(placed, keys, [direction], {"_upto": ("sum", "_n"), "_dense": ("sum", "_one")})
    if {"percent_rank", "cume_dist"} & set(outputs.values()):
        run = beside_total(run, placed, keys)
    forms = rank_forms(by)
    return run.withColumns({out: forms[kind]() for out, kind in outputs.items()}).drop("_one", "_dense", "_pos")


def framed(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column | str],
    columns: Callable[[W], dict[str, Column]],
    before: int = 0,
    after: int = 0,
    block: int | None = None,
    bounded: bool = False,
) -> DataFrame:
    """Columns that look at most ``before`` rows back and ``after`` rows ahead: lag, lead, moving averages.

    Sorted rows are cut into blocks of ``block`` rows; the rows near a border are copied to the neighbour, so a window never holds more than ``block + before + after`` rows whatever the key.
    ``bounded`` states that a key's rows fit one task by contract. ``columns`` gets the window specification (partitioned and ordered) and
    returns the new columns.
    """
    if bounded:
        window = W.partitionBy(*keys).orderBy(*order)
        return df.select("*", *[c.alias(n) for n, c in columns(window).items()])
    block = block or BLOCK_ROWS
    if max(before, after) > block:
        raise ValueError("a frame may not be longer than a block")
    rows = ordered(df, keys, order).withColumn("_slice", F.shiftright("_pos", SLICE_BITS))
    earlier = W.orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)
    starts = (
        rows.groupBy("_slice")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select(F.col("_slice").alias("_s"), F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_start"))
    )  # one row per slice
    placed = rows.join(F.broadcast(starts), F.col("_slice") == F.col("_s")).withColumn(
        "_at", F.col("_start") + F.col("_pos").bitwiseAND(F.lit((1 << SLICE_BITS) - 1))
    )
    home = F.floor(F.col("_at") / block)
    inside = F.pmod(F.col("_at"), F.lit(block))
    targets = [home]
    if before:
        targets.append(F.when(inside >= block - before, home + 1))
    if after:
        targets.append(F.when(inside < after, home - 1))
    spread = placed.withColumn("_block", F.explode(F.array_compact(F.array(*targets))))
    window = W.partitionBy("_block", *keys).orderBy("_at")
    new = columns(window)
    return (
        spread.select("*", *[c.alias(n) for n, c in new.items()])
        .filter(F.col("_block") == home)
        .select(*df.columns, *new)
    )


def rolling_mean(value: Column, window: W, size: int, min_periods: int | None = None) -> Column:
    """Mean of the last ``size`` rows, NULL while fewer than ``min_periods`` (default: all) of them have a value."""
    frame = window.rowsBetween(1 - size, 0)
    seen = F.count(value).over(frame)
    least = size if min_periods is None else min_periods
    return F.when(seen >= least, F.sum(value).over(frame).cast("double") / seen)


def composite_rank(df: DataFrame, columns: Sequence[str], out: str) -> DataFrame:
    """Mean of the descending ranks by several columns over the whole table."""
    ranked = ranks_many(df, [([], column, {f"_rank_{column}": "rank"}) for column in columns])
    summed = reduce(lambda a, b: a + b, [F.col(f"_rank_{column}") for column in columns])
    return ranked.withColumn(out, summed / F.lit(float(len(columns)))).drop(*[f"_rank_{column}" for column in columns])


def running_with_ties(
    df: DataFrame, keys: Sequence[str], by: str, value: str, out: str, descending: bool = False
) -> DataFrame:
    """Running sum with the default RANGE frame: rows with an equal ``by`` share the sum."""
    sums = df.groupBy(*keys, by).agg(F.sum(value).alias("_v"))
    run = running(sums, keys, [sorting(by, descending)], {out: ("sum", "_v")}).drop("_v")
    return join_beside(df, run, [*keys, by])


def beside(df: DataFrame, keys: Sequence[str], **aggregates: Column) -> DataFrame:
    """Put group aggregates beside every row (an aggregate ``OVER (PARTITION BY keys)``)."""
    if not keys:
        return df.withColumns({n: df.agg(c).scalar() for n, c in aggregates.items()})
    return join_beside(df, df.groupBy(*keys).agg(*[c.alias(n) for n, c in aggregates.items()]), keys)


def top_rows(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], n: int, out: str = "rn") -> DataFrame:
    """First ``n`` rows per key. Spark limits each group before the shuffle (WindowGroupLimit)."""
    return df.withColumn(out, F.row_number().over(W.partitionBy(*keys).orderBy(*order)).cast("bigint")).filter(F.col(out) <= n)


def top_ranked(
    df: DataFrame, keys: Sequence[str], by: str, n: int, method: str = "rank", descending: bool = True, out: str = "rank", bounded: bool = False,
) -> DataFrame:
    """Rows whose rank or dense_rank by one column is at most ``n``.

    Ranks come from the first ``n`` distinct values per key, so a large tie does not reach one task. ``df`` is read twice: write the result of a
    costly step first. ``bounded`` states that the rows of one key and value fit one task by contract, as groups of a report do: then the plain window is
    taken, whose limit of ``n`` ranks per key comes before the shuffle.
    """
    order = sorting(by, descending)
    if bounded:
        place = {"rank": F.rank, "dense_rank": F.dense_rank}[method]().over(W.partitionBy(*keys).orderBy(order))
        return df.withColumn(out, place).filter(F.col(out) <= n).withColumn(out, F.col(out).cast("bigint"))
    counts = df.groupBy(*keys, by).agg(F.count(F.lit(1)).alias("_n"))
    first = top_rows(counts, keys, [order], n, "_dense")
    if method == "rank":
        earlier = W.partitionBy(*keys).orderBy("_dense").rowsBetween(W.unboundedPreceding, -1)  # n rows per key
        first = first.withColumn(out, F.coalesce(F.sum("_n").over(earlier), F.lit(0)) + 1).filter(F.col(out) <= n)
    else:
        first = first.withColumn(out, F.col("_dense").cast("bigint"))
    return join_beside(df, first.select(*keys, by, out), [*keys, by])


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """The row of each key with the highest ``order``; NULL counts as lowest.

    An aggregate with a map-side step instead of a ROW_NUMBER over all versions of a key.
    """
    rest = [c for c in df.columns if c not in keys]
    return (
        df.groupBy(*keys)
        .agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_row"))
        .select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns])
    )


def percentiles(df: DataFrame, keys: Sequence[str], by: str, outputs: dict[str, float]) -> DataFrame:
    """Exact interpolated percentiles per key, equal to Spark's ``percentile``.

    ``percentile`` keeps all distinct values of a group in one buffer. Here the values are counted, given positions
    with a running count, and only the two values around each wanted position are kept.
    """
    counts = df.filter(F.col(by).isNotNull()).groupBy(*keys, by).agg(F.count(F.lit(1)).alias("_n"))
    placed = ordered(counts, keys, [F.col(by).asc()])  # counted once, read twice
    run = running(placed, keys, [F.col(by).asc()], {"_upto": ("sum", "_n")})
    both = beside_total(run, placed, keys)
    picks = []
    for out, share in outputs.items():
        at = (F.col("_total") - 1) * F.lit(share)
        for side, place in (("lo", F.floor(at)), ("hi", F.ceil(at))):
            covers = (F.col("_upto") > place) & (F.col("_upto") - F.col("_n") <= place)
            picks.append(F.max(F.when(covers, F.col(by).cast("double"))).alias(f"_{side}_{out}"))
    grouped = both.groupBy(*keys).agg(F.max("_total").alias("_total"), *picks)
    finals = []
    for out, share in outputs.items():
        at = (F.col("_total") - 1) * F.lit(share)
        low, high = F.col(f"_lo_{out}"), F.col(f"_hi_{out}")
        weight = at - F.floor(at)
        finals.append(F.when(low == high, low).otherwise((1 - weight) * low + weight * high).alias(out))
    return grouped.select(*keys, *finals)
