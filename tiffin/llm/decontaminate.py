"""Benchmark decontamination by spaced seeds.

A passage leaks if, laid along a benchmark item, it has at least ``least`` equal words and a share of equal words of ``share`` or more; an item
of fewer than ``least`` words has to be laid along whole, with the same share. Words are hashed under masks that take some words of a window and
ignore the others; equal hashes are hits. The masks miss nothing: each way to replace words that the rule with 12 words and 80 % (or a stricter one)
accepts leaves all words of some mask of ``MASKS`` equal. A passage need only be followed until it cannot be cut into two that pass, so
this is a finite number of ways, and a test goes through all of them. A looser rule is searched by the run of equal words that it cannot do without. A
short item is searched by masks over its whole length that leave out as many of its parts as words may differ. Around a hit the item is laid
along the document, and of all stretches that meet the rule the one with the most equal words is given.

Masked hashes of the benchmark are a table, as are those of the documents, and the two are joined. Before they are shuffled, the documents' hashes pass a Bloom
filter of the benchmark's, which has at most ``1 << FILTER_BITS`` bits whatever the benchmark; where a benchmark fills it, more hashes go to the join, with
the same result. Hits are counted once per document, item and offset; only the stretch of the document that an item covers meets the item's words.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction
from functools import reduce
from itertools import combinations
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiffin.llm import text

MASKS = ["11111011", "10101001111", "111000000100111", "11100101011", "1001101000111", "11011111"]
COVERED = 12, 0.8  # least and share of the loosest rule that the masks cover
FILTER_BITS = 26  # eight megabytes
BITS_OF_A_ROW = 1 << 15  # of Spark's bitmaps
PARTS = 64  # a document's items are handled in so many parts at most
KEYS = text.mixed(np.arange(7, 7 + 64, dtype=np.uint64)) | np.uint64(1)


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z in lower case."""
    return np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)


def seeds(least: int, share: float) -> list[str]:
    """Masks of which one at least is equal in every passage that meets the rule: ``1`` for a word that counts, other places are ignored."""
    if least >= COVERED[0] and share >= COVERED[1]:
        return MASKS
    if share <= 0:
        return ["1"]
    # A passage of 2 x least equal words or more can be cut into two, one of which meets the rule; e equal words with d others leave a run of e / (d + 1).
    part = Fraction(str(share))
    others = lambda e: e * (part.denominator - part.numerator) // part.numerator
    return ["1" * min(-(-e // (others(e) + 1)) for e in range(max(1, least), 2 * max(1, least)))]


def needed(words: int, share: float) -> int:
    """Equal words that an item of so many words needs when it is laid along whole."""
    part = Fraction(str(share))
    return -(-words * part.numerator // part.denominator)


def short_seeds(words: int, share: float) -> list[str]:
    """Masks for items of so many words that are laid along whole: one at least is equal wherever the share is reached."""
    equal = max(1, needed(words, share))
    others = words - equal
    if others > 2:
        return ["1" * -(-equal // (others + 1))]  # the run that is left at least
    # Words that differ touch as many parts at most, so some choice of that many parts to ignore leaves equal words only.
    parts = min(words, others + 2)
    edges = [words * k // parts for k in range(parts + 1)]
    masks = []
    for ignored in combinations(range(parts), others):
        masks.append("".join(("0" if k in ignored else "1") * (edges[k + 1] - edges[k]) for k in range(parts)))
    return sorted({m for m in masks if "1" in m})


def masked(words: np.ndarray, masks: list[str]) -> Iterator[tuple[str, np.ndarray]]:
    """Per mask the hash of the window at each position."""
    longest = max(map(len, masks), default=0)
    keys = KEYS if longest <= len(KEYS) else text.mixed(np.arange(7, 7 + longest, dtype=np.uint64)) | np.uint64(1)
    for mask in masks:
        n = len(words) - len(mask) + 1
        if n > 0:
            yield mask, text.mixed(reduce(np.add, [words[k : k + n] * keys[k] for k, x in enumerate(mask) if x == "1"]) + np.uint64(crc32(mask.encode())))


def overlap(mine: np.ndarray, item: np.ndarray, diagonal: int, share: float) -> tuple[int, int, int]:
    """Best stretch of an item laid along a text from ``diagonal`` on: start in the text, length, equal words.

    Of all stretches with a share of equal words of ``share`` or more the one with the most equal words, the first one of equals. It begins and
    ends with an equal word.
    """
    first, last = max(0, -diagonal), min(len(item), len(mine) - diagonal)
    if last <= first:
        return diagonal + first, 0, 0
    at = np.flatnonzero(mine[diagonal + first : diagonal + last] == item[first:last])
    if not len(at):
        return diagonal + first, 0, 0
    part = Fraction(str(share))
    # From equal word i to j the share is reached where balance[j] >= balance[i] - (denominator - numerator).
    balance = part.denominator * np.arange(len(at)) - part.numerator * at
    later = np.maximum.accumulate(balance[::-1])[::-1]
    ends = np.searchsorted(-later, part.denominator - part.numerator - balance, side="right") - 1
    begin = int(np.argmax(ends - np.arange(len(at))))
    end = int(ends[begin])
    return int(diagonal + first + at[begin]), int(at[end] - at[begin] + 1), end - begin + 1


def words_of(benchmark: DataFrame, item_column: str, text_column: str) -> DataFrame:
    """``item, item_id, words, n``: the word hashes of every item, numbered, written once."""
    source = benchmark.select(F.col(f"`{item_column}`").alias("item_id"), text.utf8(text_column).alias("body"))

    def hash_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text.slices(batches, "body"):
            data, offsets = text.raw(part.column("body"))
            words = text.Words(lowered(data), offsets)
            yield pa.RecordBatch.from_arrays([part.column("item_id"), text.binary(words.hashes(), words.docs * 8), pa.array(words.counts, pa.int64())], ["item_id", "words", "n"])

    kind = source.schema["item_id"].dataType.simpleString()
    items = source.mapInArrow(text.tidy(hash_words), f"item_id {kind}, words binary, n bigint")
    return text.durable(items.where("n > 0").withColumn("item", F.monotonically_increasing_id()), "items")


def seeds_of(items: DataFrame, least: int, share: float) -> tuple[DataFrame, list[str]]:
    """``hash, item, at, n``: the masked hashes of all items, and the masks in use."""
    usual = seeds(least, share)
    sizes = sorted(r.n for r in items.where(F.col("n") < least).select("n").distinct().collect())  # fewer than least
    short = {n: short_seeds(n, share) for n in sizes}

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, words, n in zip(batch.column("item").to_pylist(), batch.column("words"), batch.column("n").to_pylist()):
                own = np.frombuffer(words.as_buffer(), "<u8")
                for _, found in masked(own, usual if n >= least else short[n]):
                    size = len(found)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(found.view(np.int64)), pa.array(np.full(size, item)), pa.array(np.arange(size, dtype=np.int64)), pa.array(np.full(size, n))],
                        ["hash", "item", "at", "n"],
                    )

    found = items.select("item", "words", "n").mapInArrow(text.tidy(cut), "hash bigint, item bigint, at bigint, n bigint")
    masks = list(dict.fromkeys([*usual, *(m for n in sizes for m in short[n])]))
    return text.durable(found, "seeds"), masks


def bitmap_of(found: DataFrame, bits: int) -> np.ndarray:
    """A Bloom filter of the column ``hash`` with three places each, packed in bytes; ``passing`` reads it.

    The rows that come to the driver are as many as fill it, one per 32,768 bits.
    """
    hashed, low = F.col("hash"), F.lit((1 << bits) - 1)
    places = F.array(
        F.shiftrightunsigned(hashed, 64 - bits), F.shiftrightunsigned(hashed, 64 - 2 * bits).bitwiseAND(low),
        hashed.bitwiseXOR(F.shiftrightunsigned(hashed, bits)).bitwiseAND(low),
    )
    place = F.col("place") + 1  # Spark's bitmaps count from 1
    rows = found.select(F.explode(places).alias("place")).select(F.bitmap_bucket_number(place).alias("bucket"), F.bitmap_bit_position(place).alias("bit"))
    maps = rows.groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("flags")).collect()
    table = np.zeros((1 << bits) // 8 + BITS_OF_A_ROW // 8, np.uint8)
    for r in maps:
        at = (r.bucket - 1) * (BITS_OF_A_ROW // 8)
        table[at : at + len(r.flags)] = np.frombuffer(bytes(r.flags), np.uint8)
    return table


def passing(hashes: np.ndarray, table: np.ndarray, bits: int) -> np.ndarray:
    """Places of the hashes that the Bloom filter may hold."""
    low, at = np.uint64((1 << bits) - 1), np.arange(len(hashes))
    for probe in (
        lambda h: h >> np.uint64(64 - bits), lambda h: (h >> np.uint64(64 - 2 * bits)) & low, lambda h: (h ^ (h >> np.uint64(bits))) & low,
    ):
        place = probe(hashes[at])
        at = at[(table[(place >> np.uint64(3)).astype(np.int64)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1]
    return at


def met(docs: DataFrame, masks: list[str], table: np.ndarray, bits: int) -> DataFrame:
    """``id, print, words, hashes, places`` of the rows of ``id, body`` with a hash that the bitmap knows, written once with a row number."""
    shared = docs.sparkSession.sparkContext.broadcast(table)  # 1 << bits bits

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text.slices(batches, "body"):
            data, offsets = text.raw(part.column("body"))
            words = text.Words(lowered(data), offsets)
            own, places, found = words.hashes(), [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
            for mask, hashes in masked(own, masks):
                at = passing(hashes, shared.value, bits)
                owner = np.searchsorted(words.docs, at, side="right") - 1
                at = at[at + len(mask) <= words.docs[owner + 1]]
                places.append(at)
                found.append(hashes[at])
            at, hashes = np.concatenate(places), np.concatenate(found)
            order = np.argsort(at, kind="stable")
            at, hashes = at[order], hashes[order]
            ends = np.searchsorted(at, words.docs)
            rows = np.flatnonzero(np.diff(ends))
            owner = np.searchsorted(words.docs, at, side="right") - 1
            within = (at - words.docs[owner]).astype("<i4")
            kept = pa.array(rows)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("id").take(kept), part.column("print").take(kept),
                    pa.array([own[words.docs[k] : words.docs[k + 1]].tobytes() for k in rows], pa.binary()),
                    pa.array([hashes[ends[k] : ends[k + 1]].tobytes() for k in rows], pa.binary()), pa.array([within[ends[k] : ends[k + 1]].tobytes() for k in rows], pa.binary()),
                ],
                ["id", "print", "words", "hashes", "places"],
            )

    kind = docs.schema["id"].dataType.simpleString()
    found = docs.mapInArrow(text.tidy(search), f"id {kind}, print bigint, words binary, hashes binary, places binary")
    return text.durable(found.withColumn("row", F.monotonically_increasing_id()), "met")


def hits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``row, place, hash`` of every hash that passed the bitmap."""
    for batch in batches:
        for row, hashes, places in zip(batch.column("row").to_pylist(), batch.column("hashes"), batch.column("places")):
            own = np.frombuffer(hashes.as_buffer(), "<i8")
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(own), row)), pa.array(np.frombuffer(places.as_buffer(), "<i4").astype(np.int64)), pa.array(own)], ["row", "place", "hash"])


STRETCH = "row bigint, item bigint, begin bigint, diagonal bigint, stretch binary"


def stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The words of a document that each item covers, laid along from each diagonal."""
    for batch in batches:
        for row, words, pairs in zip(batch.column("row").to_pylist(), batch.column("words"), batch.column("pairs").to_pylist()):
            own, out = np.frombuffer(words.as_buffer(), "<u8"), []
            for p in pairs:
                begin = max(0, p["diagonal"])
                out.append((p["item"], begin, p["diagonal"], own[begin : max(begin, p["diagonal"] + p["n"])].tobytes()))
            columns = [pa.array(c, k) for c, k in zip(zip(*out), (pa.int64(), pa.int64(), pa.int64(), pa.binary()))]
            yield pa.RecordBatch.from_arrays([pa.array([row] * len(out), pa.int64()), *columns], ["row", "item", "begin", "diagonal", "stretch"])


def passages(docs: DataFrame, items: DataFrame, least: int, share: float) -> tuple[DataFrame, DataFrame]:
    """``row, item, start, length, equal``: the best passage of each document row and item, and the rows (``row, id, print``)."""
    found, masks = seeds_of(items, least, share)
    size = found.count()
    bits = min(FILTER_BITS, max(16, int(512 * size).bit_length()))
    rows = met(docs, masks, bitmap_of(found, bits), bits)
    met_hashes = rows.select("row", "hashes", "places").mapInArrow(hits, "row bigint, place bigint, hash bigint")
    lines = met_hashes.join(found, "hash").select("row", "item", "n", (F.col("place") - F.col("at")).alias("diagonal")).distinct()
    pairs = lines.groupBy("row", F.pmod(F.xxhash64("item"), F.lit(PARTS)).alias("part")).agg(F.collect_list(F.struct("item", "n", "diagonal")).alias("pairs"))
    laid = rows.select("row", "words").join(pairs, "row").select("row", "words", "pairs").mapInArrow(stretches, STRETCH)
    both = laid.join(items.select("item", F.col("words").alias("wanted")), "item").select("row", "item", "begin", "diagonal", "stretch", "wanted")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row, item, begin, diagonal, stretch, wanted in zip(*(batch.column(c).to_pylist() for c in batch.schema.names)):
                mine, words = np.frombuffer(stretch, "<u8"), np.frombuffer(wanted, "<u8")
                if len(words) >= least:
                    start, length, equal = overlap(mine, words, diagonal - begin, share)
                    good = equal >= least
                else:
                    start, length = 0, len(words)
                    equal = int((mine == words).sum()) if len(mine) == len(words) and diagonal >= 0 else 0
                    good = equal >= max(1, needed(len(words), share))
                if good:
                    out.append((row, item, begin + start, length, equal))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (list(zip(*out)) or [[]] * 5)], ["row", "item", "start", "length", "equal"])

    good = both.mapInArrow(verify, "row bigint, item bigint, start bigint, length bigint, equal bigint")
    best = good.groupBy("row", "item").agg(F.min(F.struct((-F.col("equal")).alias("less"), "start", "length")).alias("best"))
    return best.select("row", "item", "best.start", "best.length", (-F.col("best.less")).alias("equal")), rows.select("row", "id", "print")


def keyed(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """``id, print, body`` of documents; the print tells rows of one id apart."""
    body = text.utf8(text_column)
    return docs.select(F.col(f"`{id_column}`").alias("id"), F.xxhash64(body).alias("print"), body.alias("body"))


def leaks(
    docs: DataFrame, benchmark: DataFrame, least: int = 12, share: float = 0.8,
    id_column: str = "doc_id", text_column: str = "text", item_column: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """``doc_id, item_id, start_word, n_words, n_equal``: one row for each document and item it holds a passage of, the best passage.

    Items of any length are searched; one without words leaks nowhere. Null and empty texts, on either side, have no leaks. Equal rows of documents or
    items give rows of their own, null ids too. Other columns are left out, whatever their names. An empty table on either side gives an empty result.
    """
    text.prepared(docs.sparkSession)
    items = words_of(benchmark, item_column, item_text)
    found, rows = passages(keyed(docs, id_column, text_column), items, least, share)
    named = found.join(rows.select("row", "id"), "row").join(items.select("item", "item_id"), "item")
    return named.select(F.col("id").alias("doc_id"), "item_id", F.col("start").alias("start_word"), F.col("length").alias("n_words"), F.col("equal").alias("n_equal"))


def clean(
    docs: DataFrame, benchmark: DataFrame, least: int = 12, share: float = 0.8, id_column: str = "doc_id", text_column: str = "text",
    item_column: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """The rows of ``docs``, with all their columns, that hold no passage of the benchmark, as ``leaks`` finds them.

    Rows of one id are judged each by its own text; null and empty texts stay, as do null ids without a leak. An empty benchmark changes nothing, an empty
    table gives an empty result.
    """
    text.prepared(docs.sparkSession)
    items = words_of(benchmark, item_column, item_text)
    found, rows = passages(keyed(docs, id_column, text_column), items, least, share)
    own, key, mark = text.new_name(docs, stem="own"), text.new_name(docs, stem="key"), text.new_name(docs, stem="print")
    bad = text.durable(found.select("row").distinct().join(rows, "row").select(F.col("id").alias(key), F.col("print").alias(mark)).distinct(), "leaks")
    marked = docs.withColumn(own, F.xxhash64(text.utf8(text_column)))
    return marked.join(bad, F.col(own).eqNullSafe(F.col(mark)) & F.col(f"`{id_column}`").eqNullSafe(F.col(key)), "left_anti").drop(own)
