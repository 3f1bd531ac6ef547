"""Change feeds, slowly changing dimensions and history reports."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tiffin.functions.columns import percent
from tiffin.operators.aggs import distinct_counts
from tiffin.operators.keys import unique_source
from tiffin.operators.windows import framed, latest_per_key, ordered, running

OPERATIONS = {"c": "INSERT", "r": "INSERT", "u": "UPDATE", "d": "DELETE"}  # fixed values of the envelope


def either(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def differs(now: Column, before: Column, null_safe: bool) -> Column:
    """Two values differ. Without ``null_safe`` a change to NULL is not seen, but one from NULL is."""
    if null_safe:
        return ~now.eqNullSafe(before)
    return F.coalesce(now != before, now.isNotNull() & before.isNull())


def unwrap_cdc(df: DataFrame, key: str = "id", payload: str = "payload", op: str = "op") -> DataFrame:
    """Flatten a before/after envelope: key, operation and the fields of the newer image."""
    image = F.coalesce(F.col(f"{payload}.after"), F.col(f"{payload}.before"))
    codes = [F.lit(x) for pair in OPERATIONS.items() for x in pair]
    return df.select(
        *[c for c in df.columns if c not in (payload, op)],
        F.create_map(*codes)[F.col(op)].alias("operation"),
        image.alias("_image"),
    ).select("*", "_image.*").drop("_image")


def scd1(
    changes: DataFrame,
    keys: Sequence[str],
    seq: str,
    delete_when: Column,
    exclude: Sequence[str] = (),
    ignore_nulls: bool = False,
) -> DataFrame:
    """Current state from a change feed in any order.

    The row with the highest ``seq`` wins; at an equal ``seq`` a delete wins, then the greater values in the order of their columns. Deleted keys
    disappear. With ``ignore_nulls`` a NULL does not overwrite an older value, unless a delete lies between.
    One aggregate with a map-side step.
    """
    values = [c for c in changes.columns if c not in {*keys, seq, *exclude}]
    gone = F.coalesce(delete_when, F.lit(False))
    marked = changes.withColumn("_gone", gone)
    order = F.struct(seq, "_gone", *values)
    if ignore_nulls:
        latest = [
            F.max_by(
                F.struct(F.when(~F.col("_gone"), F.col(c)).alias("v")),
                F.when(F.col("_gone") | F.col(c).isNotNull(), order),
            ).alias(c)
            for c in values
        ]
        state = marked.groupBy(*keys).agg(F.max_by("_gone", order).alias("_gone"), *latest)
        return state.filter(~F.col("_gone")).select(*keys, *[F.col(f"{c}.v").alias(c) for c in values])
    state = marked.groupBy(*keys).agg(F.max_by(F.struct("_gone", *values), order).alias("_row"))
    return state.filter(~F.col("_row._gone")).select(*keys, *[F.col(f"_row.{c}").alias(c) for c in values])


def scd2(
    changes: DataFrame,
    keys: Sequence[str],
    seq: str,
    track: Sequence[str],
    delete_when: Column,
    exclude: Sequence[str] = (),
    start: str = "__START_AT",
    end: str = "__END_AT",
) -> DataFrame:
    """History from a change feed in any order.

    A version starts where a tracked column changes, at the first row of a key and at the first row after a delete; a
    delete closes the version and leaves a gap. Columns that are not tracked show their last value within the version.
    Same-``seq`` duplicates are settled as in ``scd1``. A key with many changes is spread over tasks.
    """
    values = [c for c in changes.columns if c not in {*keys, seq, *exclude}]
    marked = changes.withColumn("_gone", F.coalesce(delete_when, F.lit(False)))
    single = latest_per_key(marked.select(*keys, seq, *values, "_gone"), [*keys, seq], [F.col(c) for c in ("_gone", *values)])
    single = single.withColumn("_tracked", F.struct(*track))
    rows = ordered(single, keys, [seq])
    lagged = framed(
        rows, keys, [seq], lambda w: {"_was_gone": F.lag("_gone").over(w), "_was": F.lag("_tracked").over(w)}, before=1
    )
    begins = ~F.col("_gone") & (F.coalesce(F.col("_was_gone"), F.lit(True)) | ~F.col("_was").eqNullSafe(F.col("_tracked")))
    numbered = running(
        lagged.withColumn("_begins", F.when(begins, 1).otherwise(0)), keys, [seq], {"_version": ("sum", "_begins")}
    )
    # The first row of a version also tells the version before it where it ends, so one grouping is enough.
    spread = numbered.select(
        "*",
        F.explode(
            F.array_compact(
                F.array(
                    F.struct(F.col("_version").alias("no"), F.lit(False).alias("is_next")),
                    F.when(
                        F.col("_begins") == 1,
                        F.struct((F.col("_version") - 1).alias("no"), F.lit(True).alias("is_next")),
                    ),
                )
            )
        ).alias("_to"),
    ).filter(F.col("_to.no") > 0)
    own, alive = ~F.col("_to.is_next"), ~F.col("_gone")
    versions = spread.groupBy(*keys, "_to.no").agg(
        F.min(F.when(own & alive, F.col(seq))).alias(start),
        F.min(F.when(own & ~alive, F.col(seq))).alias("_closed"),
        F.min(F.when(~own, F.col(seq))).alias("_next"),
        F.max_by(F.struct(*values), F.when(own & alive, F.col(seq))).alias("_row"),
    )
    return versions.select(
        *keys, *[F.col(f"_row.{c}").alias(c) for c in values], start, F.coalesce("_closed", "_next").alias(end)
    )


def as_of(history: DataFrame, moment: Column, start: str = "__START_AT", end: str = "__END_AT") -> DataFrame:
    """Versions valid at a moment: started at or before it and not ended by it."""
    return history.filter((F.col(start) <= moment) & (F.col(end).isNull() | (F.col(end) > moment)))


def version_status(history: DataFrame, as_of_time: Column, start: str = "__START_AT", end: str = "__END_AT") -> DataFrame:
    """CURRENT or HISTORICAL and the days each version was valid, open versions up to ``as_of_time``."""
    return history.withColumn(
        "version_status", F.when(F.col(end).isNull(), "CURRENT").otherwise("HISTORICAL")
    ).withColumn("days_active", F.datediff(F.coalesce(F.col(end), as_of_time), F.col(start)).cast("bigint"))


def change_rate_by_group(
    current: DataFrame, history: DataFrame, group: str, member: str, since: Column, start: str = "__START_AT"
) -> DataFrame:
    """Members per group now, members changed since a moment, and the rate in percent."""
    now = current.groupBy(group).agg(F.countDistinct(member).alias("members"))
    recent = history.filter(F.col(start) >= since).groupBy(group).agg(
        F.countDistinct(member).alias("members_changed"), F.count(F.lit(1)).alias("changes")
    )
    joined = now.join(recent, group, "left").fillna(0, ["members_changed", "changes"])
    return joined.withColumn("change_rate_pct", percent(F.col("members_changed"), F.col("members"), 1))


def stamp_snapshot(state: DataFrame, taken_at: Column) -> DataFrame:
    """A full state as one more snapshot of a history, with ``start_date`` and ``is_current``."""
    return state.withColumn("start_date", taken_at).withColumn("is_current", F.lit(True))


def append_snapshot(history: DataFrame, state: DataFrame, taken_at: Column) -> DataFrame:
    """History plus one snapshot, where only rows of the newest snapshot are current."""
    return history.withColumn("is_current", F.lit(False)).unionByName(stamp_snapshot(state, taken_at))


def scd2_apply(
    target: DataFrame,
    updates: DataFrame,
    keys: Sequence[str],
    track: Sequence[str],
    at: Column,
    current: str = "is_current",
    start: str = "start_date",
    end: str = "end_date",
    seq: str | None = None,
) -> DataFrame:
    """Apply one batch of updates to a type-2 table: close changed current rows, insert their new versions and new keys.

    One full join of the current rows and the updates; each pair gives the rows it leaves behind. Of several updates with one key the one with
    the highest ``seq`` counts; without ``seq`` they fail the job, as there may be one current version only.
    """
    updates = latest_per_key(updates, keys, [F.col(seq)]).drop(seq) if seq else unique_source(updates, keys)
    payload = [c for c in target.columns if c not in {*keys, current, start, end}]
    t, u = target.filter(F.col(current)).alias("t"), updates.alias("u")
    matched = t.join(u, reduce(lambda a, b: a & b, [F.col(f"t.{k}") == F.col(f"u.{k}") for k in keys]), "full")
    has_t, has_u = F.col(f"t.{current}").isNotNull(), F.col(f"u.{keys[0]}").isNotNull()
    changed = has_t & has_u & either([~F.col(f"t.{c}").eqNullSafe(F.col(f"u.{c}")) for c in track])

    def image(side: str, is_current: Column, begin: Column, finish: Column) -> Column:
        def value(c: str) -> Column:
            if side == "u" and c not in updates.columns:
                return F.col(f"t.{c}")
            return F.col(f"{side}.{c}")

        fields = {**{c: value(c) for c in [*keys, *payload]}, current: is_current, start: begin, end: finish}
        return F.struct(*[fields[c].cast(target.schema[c].dataType).alias(c) for c in target.columns])

    old = F.when(has_t, image("t", ~changed, F.col(f"t.{start}"), F.when(changed, at).otherwise(F.col(f"t.{end}"))))
    new = F.when(changed | ~has_t, image("u", F.lit(True), at, F.lit(None)))
    rows = matched.select(F.explode(F.array_compact(F.array(old, new))).alias("_row")).select("_row.*")
    return target.filter(~F.col(current)).unionByName(rows)


def with_previous(history: DataFrame, key: str, order: Sequence[Column | str], columns: Sequence[str]) -> DataFrame:
    """Each row beside the former values (``prev_*``) of its key; ``_first`` marks the first row."""
    return framed(
        history, [key], order,
        lambda w: {
            **{f"prev_{c}": F.lag(c).over(w) for c in columns},
            "_first": F.lag(F.lit(False), 1, True).over(w),
        },
        before=1,
    )


def field_changes(
    history: DataFrame, key: str, order: Sequence[Column | str], labels: dict[str, str], keep: Sequence[str] = (), null_safe: bool = False
) -> DataFrame:
    """One text per changed field, ``Label: "old" → "new"``, for rows with a change.

    The plain form follows the reported rule: the former value of the first labelled field must be known, and a change
    to NULL does not select a row. ``null_safe`` finds every change after the first row.
    """
    fields = list(labels)
    rows = with_previous(history.select(key, *dict.fromkeys([*keep, *fields])), key, order, fields)

    def text(field: str) -> Column:
        now, before = F.col(field), F.col(f"prev_{field}")
        shown = F.concat(
            F.lit(f'{labels[field]}: "'), F.coalesce(before.cast("string"), F.lit("NULL")), F.lit('" → "'),
            F.coalesce(now.cast("string"), F.lit("NULL")) if null_safe else now.cast("string"), F.lit('"'),
        )
        return F.when(differs(now, before, null_safe), shown)

    if null_safe:
        found = ~F.col("_first") & either([differs(F.col(f), F.col(f"prev_{f}"), True) for f in fields])
    else:
        found = F.col(f"prev_{fields[0]}").isNotNull() & either([F.col(f) != F.col(f"prev_{f}") for f in fields])
    return rows.filter(found).select(key, *keep, *[text(f).alias(f"{f}_change") for f in fields])


def change_rates(history: DataFrame, key: str, order: Sequence[Column | str], fields: Sequence[str], needed: Sequence[str] = ()) -> DataFrame:
    """How often each field changed from one row of a key to the next, and as percent of all rows."""
    rows = with_previous(history.select(key, *dict.fromkeys([*needed, *fields])), key, order, fields)
    counts = rows.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count(F.when(F.col(f) != F.col(f"prev_{f}"), 1)).alias(f"_{f}") for f in fields],
    )
    entries = [F.struct(F.lit(f).alias("field_name"), F.col(f"_{f}").alias("total_changes")) for f in fields]
    return counts.select("_rows", F.explode(F.array(*entries)).alias("_e")).select(
        "_e.*", percent(F.col("_e.total_changes"), F.col("_rows")).alias("change_rate_pct")
    )


def latest_two(history: DataFrame, moment: str = "start_date") -> tuple[DataFrame, DataFrame]:
    """The newest snapshot of a history and the one before."""
    newest = history.agg(F.max(moment)).scalar()
    current = history.filter(F.col(moment) == newest)
    before = history.filter(F.col(moment) < newest).agg(F.max(moment)).scalar()
    return current, history.filter(F.col(moment) == before)


def reconcile(type1: DataFrame, type2: DataFrame, key: str, fields: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """Keys whose current state differs from the latest history row, field by field."""
    latest = latest_per_key(type2.select(key, *fields, *[c for c in type2.columns if c not in {key, *fields}]), [key], order)
    a, b = type1.alias("a"), latest.alias("b")
    different = either([F.coalesce(F.col(f"a.{f}") != F.col(f"b.{f}"), F.lit(False)) for f in fields])
    columns = [F.col(f"a.{key}").alias(key)]
    for f in fields:
        columns += [
            F.col(f"a.{f}").alias(f"type1_{f}"), F.col(f"b.{f}").alias(f"type2_{f}"),
            F.when(F.col(f"a.{f}") == F.col(f"b.{f}"), "match").otherwise("MISMATCH").alias(f"{f}_match"),
        ]
    return a.join(b, F.col(f"a.{key}") == F.col(f"b.{key}")).filter(different).select(*columns)


def reconcile_counts(type1: DataFrame, type2: DataFrame, key: str, moment: str = "start_date") -> DataFrame:
    """Members in the current table, in the latest snapshot and over all snapshots. Each table is read once."""
    members = type2.groupBy(moment, key).agg(F.count(F.lit(1)).alias("_rows"))
    dated = members.groupBy(moment).agg(F.count(key).alias("_members"), F.sum("_rows").alias("_rows"))  # one row per snapshot
    name = lambda label, column: F.struct(F.lit(label).alias("table_name"), F.coalesce(column, F.lit(0)).alias("user_count"))
    later = dated.agg(F.max_by("_members", moment).alias("newest"), F.sum("_rows").alias("every")).select(
        F.inline(F.array(name("type 2 latest snapshot", F.col("newest")), name("type 2 all snapshots", F.col("every"))))
    )
    current = type1.agg(F.countDistinct(key).alias("user_count")).select(F.lit("type 1 current").alias("table_name"), "user_count")
    return current.unionByName(later)


def snapshot_frequency(history: DataFrame, key: str, moment: str = "start_date", least: int = 2) -> DataFrame:
    """Snapshots per key with first and last appearance and the days between."""
    counts = history.groupBy(key).agg(
        F.count(F.lit(1)).alias("snapshot_count"), F.min(moment).alias("first_seen"), F.max(moment).alias("last_seen")
    )
    return counts.filter(F.col("snapshot_count") >= least).withColumn(
        "days_tracked", F.datediff("last_seen", "first_seen").cast("bigint")
    )


def snapshot_timeline(history: DataFrame, key: str, moment: str = "start_date", since: Column | None = None) -> DataFrame:
    """Records, keys and snapshots per day."""
    rows = history if since is None else history.filter(F.col(moment) >= since)
    return distinct_counts(
        rows.withColumn("snapshot_date", F.to_date(moment)), ["snapshot_date"], {"snapshot_count": moment, "unique_users": key},
        {"total_records": ("count", F.lit(1)), "earliest": ("min", F.col(moment)), "latest": ("max", F.col(moment))},
    )


def activity_flags(
    history: DataFrame, key: str, fields: Sequence[str], moment: str = "start_date", limit: int = 3, least: int = 2
) -> DataFrame:
    """Distinct values per key and field, and the first field above ``limit`` as a flag."""
    counts = distinct_counts(history, [key], {f"{f}_variations": f for f in fields}, {"appearances": ("count", F.lit(1))})
    counts = counts.select(key, "appearances", *[f"{f}_variations" for f in fields])
    flag = reduce(lambda acc, f: acc.when(F.col(f"{f}_variations") > limit, f"High {f} changes"), fields, F)
    return counts.filter(F.col("appearances") >= least).withColumn("activity_flag", flag.otherwise("Normal"))


def audit_trail(history: DataFrame, key: str, order: Sequence[Column | str], fields: Sequence[str], needed: Sequence[str] = ()) -> DataFrame:
    """Each row of a key as Initial, Changed or Unchanged against the row before."""
    rows = with_previous(history.select(key, *dict.fromkeys([*needed, *fields])), key, order, fields)
    changed = either([differs(F.col(f), F.col(f"prev_{f}"), True) for f in fields])
    kind = F.when(F.col("_first"), "Initial").when(changed, "Changed").otherwise("Unchanged")
    return rows.withColumn("change_kind", kind).drop("_first")
