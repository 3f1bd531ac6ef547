"""Quality rules with adaptive thresholds, in DataFrame functions only.

Each text is measured once, in its own task; only the figures are written and go on. Shares of symbols, capitals and repeated lines and the mean word
length are summed up in quantile sketches (KLL) per language and source. Sketches merge: sources into languages, languages into one. A group with
enough texts has limits of its own, a smaller one those of its language, a small language those of all. A limit lies beyond the upper decile by a
multiple of the distance between the deciles, as the sketches give them; only where both deciles are equal does a fixed distance take its place. The
limits are joined to the figures.

Fixed rules stay beside them: too few words, and too many words in repeated five-word windows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tiffin.session import durable

BLANK = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
WINDOW = 5
# Share, distance of the limit from the decile where the deciles are equal; the mean word length has a lower limit too.
SHARES = {"symbol_share": 0.05, "capital_share": 0.3, "dup_line_share": 0.6, "mean_word": 4.0}
LOW, HIGH = 0.1, 0.9
SPREAD = 5.0  # times the distance between the deciles above the upper one
BELOW = 2.0  # times below the lower one: word lengths are skewed
ENOUGH = 100  # texts a group needs for limits of its own
KEPT = 4096  # of the sketch; its rank error is below 0.1 %


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def without(column: Column, letters: str) -> Column:
    return F.length(F.translate(column, letters, ""))


def repeated(hashes: Column) -> Column:
    """Number of words in windows that occur twice or more, from the hashes of all windows."""

    def places(ordered: Column) -> Column:
        twice = lambda x, i: F.when((x["h"] == F.get(ordered, i - 1)["h"]) | (x["h"] == F.get(ordered, i + 1)["h"]), x["i"])
        return F.sort_array(F.filter(F.transform(ordered, twice), lambda p: p.isNotNull()))

    def covered(at: Column) -> Column:
        steps = F.transform(at, lambda p, i: F.least(F.lit(WINDOW), F.coalesce(F.get(at, i + 1) - p, F.lit(WINDOW))))
        return F.aggregate(steps, F.lit(0).cast("bigint"), lambda total, step: total + step)

    ordered = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return let(let(ordered, places), covered)


def measured(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", lang_column: str = "lang", source_column: str = "source") -> DataFrame:
    """The figures of each text, with its id, language and source."""
    source = docs.select(
        F.col(f"`{id_column}`").alias("id"), F.coalesce(F.col(f"`{text_column}`"), F.lit("")).alias("body"),
        F.col(f"`{lang_column}`").alias("lang"), F.col(f"`{source_column}`").alias("source"),
    )
    trimmed = F.btrim("body", F.lit(BLANK))
    split = source.withColumn("words", F.when(trimmed != "", F.split(trimmed, r"[\x20\x09-\x0D]+")).otherwise(F.array().cast("array<string>")))
    lines = F.filter(F.split("body", "\n"), lambda line: F.btrim(line, F.lit(BLANK)) != "")
    hashed = F.transform(
        F.sequence(F.lit(0), F.size("words") - WINDOW), lambda i: F.xxhash64(*(F.get("words", i + k) for k in range(WINDOW)))
    )
    counted = split.select(
        "id", "lang", "source", F.size("words").cast("bigint").alias("n_words"), without(F.col("body"), BLANK).cast("bigint").alias("word_chars"),
        (F.length("body") - without(F.col("body"), SYMBOLS)).cast("bigint").alias("n_symbols"),
        (F.length("body") - without(F.col("body"), CAPITALS)).cast("bigint").alias("n_capitals"),
        lines.alias("lines"), F.when(F.size("words") >= WINDOW, hashed).otherwise(F.array().cast("array<bigint>")).alias("hashes"),
    )
    several = F.size(F.array_distinct("hashes")) < F.size("hashes")
    return counted.select(
        "id", "lang", "source", "n_words", "word_chars", "n_symbols", "n_capitals", F.size("lines").cast("bigint").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        F.when(several, repeated(F.col("hashes"))).otherwise(F.lit(0).cast("bigint")).alias("n_repeat_words"),
    )


def shares() -> dict[str, Column]:
    def part(a: str, b: str) -> Column:
        return F.coalesce(F.col(a) / F.nullif(F.col(b), F.lit(0)), F.lit(0.0))

    return {
        "symbol_share": part("n_symbols", "word_chars"), "capital_share": part("n_capitals", "word_chars"),
        "dup_line_share": part("n_dup_lines", "n_lines"), "mean_word": part("word_chars", "n_words"),
    }


def limits(rows: DataFrame) -> DataFrame:
    """``lang, source`` and, per share, ``low_`` and ``high_`` limits, from the sketches of the rows that passed the fixed rules."""
    good = rows.where("NOT base_failed")
    own = good.groupBy("lang", "source").agg(F.count("*").alias("n"), *(F.kll_sketch_agg_double(s, F.lit(KEPT)).alias(s) for s in SHARES))
    own = durable(own, "quantiles")
    lang = own.groupBy("lang").agg(F.sum("n").alias("n"), *(F.kll_merge_agg_double(s, F.lit(KEPT)).alias(s) for s in SHARES))
    every = own.agg(F.sum("n").alias("n"), *(F.kll_merge_agg_double(s, F.lit(KEPT)).alias(s) for s in SHARES))

    def fences(sketches: DataFrame, *keys: str) -> DataFrame:
        found = []
        for share, fixed in SHARES.items():
            low, high = (F.kll_sketch_get_quantile_double(share, F.lit(q)) for q in (LOW, HIGH))
            reach = lambda times: F.when(high > low, times * (high - low)).otherwise(F.lit(fixed))  # noqa: B023, E731
            found.append(F.struct((low - reach(BELOW)).alias("low"), (high + reach(SPREAD)).alias("high")).alias(share))
        return sketches.where("n > 0").select(*keys, "n", F.struct(*found).alias("fence"))

    groups, langs = fences(own, "lang", "source"), fences(lang, "lang").withColumnRenamed("n", "n_lang").withColumnRenamed("fence", "fence_lang")
    general = fences(every).select("fence").scalar()
    both = groups.alias("g").join(langs.alias("l"), F.col("g.lang").eqNullSafe(F.col("l.lang")), "left").select("g.*", "n_lang", "fence_lang")
    whole = both.withColumn("fence_all", general)
    chosen = F.when(F.col("n") >= ENOUGH, F.col("fence")).when(F.col("n_lang") >= ENOUGH, F.col("fence_lang")).otherwise(F.col("fence_all"))
    return whole.select("lang", "source", chosen.alias("fence"))


def quality_rules(
    docs: DataFrame, least_words: int = 10, repeat_percent: int = 20,
    id_column: str = "doc_id", text_column: str = "text", lang_column: str = "lang", source_column: str = "source",
) -> DataFrame:
    """``doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, failed_shares`` of every row.

    Words are ``[^\\x20\\x09-\\x0D]+``. A null or empty text has no words and fails the fixed rules. Null languages and sources are groups of
    their own. Null ids and equal rows stay as they are. A group none of whose texts passed the fixed rules has no limits, and needs none.
    Other columns are left out, whatever their names. An empty table gives an empty result.
    """
    failed = (F.col("n_words") < least_words) | (100 * F.col("n_repeat_words") > repeat_percent * F.col("n_words"))
    rows = measured(docs, id_column, text_column, lang_column, source_column).withColumn("base_failed", failed).withColumns(shares())
    rows = durable(rows, "figures")
    known = limits(rows)
    same = F.col("r.lang").eqNullSafe(F.col("k.lang")) & F.col("r.source").eqNullSafe(F.col("k.source"))
    joined = rows.alias("r").join(known.alias("k"), same, "left").select("r.*", "fence")
    outside = {
        s: (F.col(s) > F.col("fence")[s]["high"]) | ((F.col(s) < F.col("fence")[s]["low"]) if s == "mean_word" else F.lit(False)) for s in SHARES
    }
    broken = F.filter(F.array(*(F.when(bad, F.lit(s)) for s, bad in outside.items())), lambda s: s.isNotNull())
    return joined.select(
        F.col("id").alias(id_column), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & (F.size(broken) == 0)).alias("kept"), broken.alias("failed_shares"),
    )
