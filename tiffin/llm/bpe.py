"""Byte-level BPE encoding and decoding.

A word (one match of the pattern) is encoded by a fold over its bytes: in each step the neighbours whose union has the lowest rank merge, the
first of equals, until no union has a rank. Words are counted over all documents, and the ``known`` most frequent ones of up to ``LONGEST``
bytes (a fixed bound, whatever the input; all but some hundredths of the occurrences) are folded as a table of distinct words in Spark's
higher-order functions: bytes as two hex digits each, ranks as a literal array of small maps addressed by hash. The table goes to all tasks,
which look up the words of their documents and fold the remaining distinct words by the same rule in numpy, many words in step. Higher-order functions alone
give the same ids, but cost 50 to 90 microseconds of CPU a word. Only words and their counts are shuffled, never texts.

Decoding looks up the bytes of each id and concatenates them.
"""

from __future__ import annotations

import base64
import heapq
import itertools
import json
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tiffin.llm import pieces as splitting
from tiffin.llm import text
from tiffin.session import durable

KNOWN = 1 << 17
SHORT = 64  # bytes of a word folded in step with others
LONGEST = 24


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def read_ranks(path: str) -> dict[bytes, int]:
    """Rank file: base64 bytes and rank per line."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


class Lookup:
    """A fixed map from strings to values as a literal: an array of maps of some eight entries, one per value of the hash's last bits."""

    def __init__(self, items: dict, kind: str):
        self.kind, self.slots = kind, 1 << max(1, (len(items) - 1).bit_length() - 3)
        self.maps: list[dict] = [{} for _ in range(self.slots)]
        for key, value in items.items():
            self.maps[xxhash.xxh64_intdigest(key.encode(), seed=42) & (self.slots - 1)][key] = value

    def literal(self) -> Column:
        """Constant text that the optimizer reads once."""
        return F.from_json(F.lit(json.dumps(self.maps, separators=(",", ":"))), f"array<map<string,{self.kind}>>")

    def find(self, table: Column, key: Column) -> Column:
        """Value of a key, null if it is not in the map."""
        return F.try_element_at(F.get(table, F.xxhash64(key).bitwiseAND(F.lit(self.slots - 1)).cast("int")), key)


def rank_lookup(path: str) -> Lookup:
    return Lookup({k.hex().upper(): v for k, v in read_ranks(path).items()}, "int")


def folded(word: Column, ranks: Lookup, table: Column) -> Column:
    """Ids of a word (hex, not empty), as text with commas."""
    rank = lambda a, b: ranks.find(table, F.concat(a, b))

    def step(state: Column, _: Column) -> Column:
        parts, pairs = state["parts"], state["pairs"]

        def merge(at: Column) -> Column:
            joined = F.concat(F.get(parts, at), F.get(parts, at + 1))

            def put(new: Column) -> Column:
                before = F.when(at > 0, F.array(rank(F.get(parts, at - 1), new))).otherwise(none)
                after = F.when(at + 2 < F.size(parts), F.array(rank(new, F.get(parts, at + 2)))).otherwise(none)
                return F.struct(
                    F.concat(F.slice(parts, F.lit(1), at), F.array(new), F.slice(parts, at + 3, F.size(parts))).alias("parts"),
                    F.concat(F.slice(pairs, F.lit(1), F.greatest(at - 1, F.lit(0))), before, after, F.slice(pairs, at + 3, F.size(pairs))).alias("pairs"),
                )

            return let(joined, put)

        lowest = F.array_min(pairs)
        return F.when(lowest.isNull(), state).otherwise(let((F.array_position(pairs, lowest) - 1).cast("int"), merge))

    none = F.array().cast("array<int>")
    places = F.sequence(F.lit(1), F.length(word) - 1, F.lit(2))
    single = F.transform(places, lambda k: F.substring(word, k, F.lit(2)))
    first = let(single, lambda s: F.struct(s.alias("parts"), F.transform(F.slice(s, F.lit(2), F.size(s)), lambda p, k: rank(F.get(s, k), p)).alias("pairs")))
    merged = F.aggregate(F.slice(places, F.lit(2), F.length(word)), first, step)
    each = let(merged, lambda state: F.array_join(F.transform(state["parts"], lambda p: ranks.find(table, p).cast("string")), ","))
    return F.coalesce(ranks.find(table, word).cast("string"), each)


def word_counts(docs: DataFrame, text_column: str) -> DataFrame:
    """``word, n``: how often each word of at most ``LONGEST`` bytes occurs, summed up per slice of input before the shuffle."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        LOADED.clear()  # what an earlier encoding left in this worker
        for part in text.slices(batches, "body", text.LARGE_SLICE // 2):
            data, offsets = text.raw(part.column("body"))
            bounds, _ = splitting.split(data, offsets, splitting.by_rule, None)
            coded = text.binary(data, bounds).dictionary_encode()
            often = np.bincount(coded.indices.to_numpy(), minlength=len(coded.dictionary))
            short = pa.array(np.diff(np.frombuffer(coded.dictionary.buffers()[1], np.int32)[: len(coded.dictionary) + 1]) <= LONGEST)
            yield pa.RecordBatch.from_arrays([coded.dictionary.filter(short).cast(pa.string()), pa.array(often).filter(short)], ["word", "n"])

    text.prepared(docs.sparkSession)
    each = docs.select(text.utf8(text_column).alias("body")).mapInArrow(text.tidy(count), "word string, n bigint")
    return each.groupBy("word").agg(F.sum("n").alias("n"))


def known_words(docs: DataFrame, ranks: Lookup, known: int, text_column: str) -> pa.Table:
    """``word, ids`` of the most frequent words. At most ``known`` rows of bounded words come to the driver.

    The words that are more frequent than the one behind the bound, so that no ties have to be settled: how many words have each count tells which. A count is
    one row then, so what one task gets for it does not grow with the number of words or tasks.
    """
    spark = docs.sparkSession
    counts = durable(word_counts(docs, text_column), "words")
    often = counts.groupBy("n").agg(F.count(F.lit(1)).alias("words")).orderBy(F.desc("n")).limit(known + 1).collect()  # each count has a word at least
    upto = list(itertools.accumulate(r.words for r in often))
    beyond = next((r.n for r, words in zip(often, upto) if words > known), 0)
    # Spread and written first: a plan with an exchange is printed, logged and kept at each of its stages, every time with the constant table of a megabyte.
    spread = durable(counts.where(F.col("n") > beyond).select("word").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "word"), "known")
    return spread.select(F.col("word").cast("binary").alias("word"), let(ranks.literal(), lambda table: folded(F.hex("word"), ranks, table)).alias("ids")).toArrow()


class Merges:
    """The ranked unions of a vocabulary as sorted pairs of ids, and folds over them in numpy."""

    def __init__(self, ranks: dict[bytes, int]):
        pairs = {(ranks[w[:k]], ranks[w[k:]]): r for w, r in ranks.items() for k in range(1, len(w)) if w[:k] in ranks and w[k:] in ranks}
        keys = np.array([a << 32 | b for a, b in pairs], dtype=np.int64)
        order = np.argsort(keys)
        self.keys, self.values = np.append(keys[order], np.iinfo(np.int64).max), np.append(np.fromiter(pairs.values(), np.int64, len(pairs))[order], -1)
        self.whole = ranks
        self.none = np.iinfo(np.int64).max
        self.bytes = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int64)

    def ranks_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of the union of neighbours; ``none`` where it has no rank or a neighbour is missing (-1)."""
        wanted = left << 32 | right
        at = np.searchsorted(self.keys, wanted)
        return np.where((self.keys[at] == wanted) & (left >= 0) & (right >= 0), self.values[at], self.none)

    def rank(self, left: int, right: int) -> int | None:
        """Rank of the union of two ids."""
        at = int(np.searchsorted(self.keys, left << 32 | right))
        return int(self.values[at]) if self.keys[at] == left << 32 | right else None

    def in_step(self, words: list[bytes]) -> list[str]:
        """Ids of short words as text: one row per word, one merge in every row per step."""
        sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        parts = np.full((len(words), int(sizes.max())), -1, dtype=np.int64)
        inside = np.arange(parts.shape[1]) < sizes[:, None]
        parts[inside] = self.bytes[np.frombuffer(b"".join(words), np.uint8)]
        open_ = np.arange(len(words))
        while len(open_):
            own = parts[open_]
            found = self.ranks_of(own[:, :-1], own[:, 1:])
            at = found.argmin(axis=1) if found.shape[1] else np.zeros(len(own), np.int64)
            best = found[np.arange(len(own)), at] if found.shape[1] else np.full(len(own), self.none)
            going = best < self.none
            open_, own, at, best = open_[going], own[going], at[going], best[going]
            columns = np.arange(own.shape[1])
            moved = own[np.arange(len(own))[:, None], np.minimum(columns + (columns > at[:, None]), own.shape[1] - 1)]
            moved[:, -1] = -1
            moved[np.arange(len(own)), at] = best
            parts[open_] = moved
        return [",".join(map(str, row[: row.index(-1)] if -1 in row else row)) for row in parts.tolist()]

    def one(self, word: bytes) -> str:
        """Ids of a word of any length as text: a heap of the unions, ordered by rank and place."""
        ids, after, before = [int(self.bytes[b]) for b in word], [*range(1, len(word)), -1], [*range(-1, len(word) - 1)]
        heap = [(r, k) for k in range(len(ids) - 1) if (r := self.rank(ids[k], ids[k + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            rank, k = heapq.heappop(heap)
            right = after[k]
            if ids[k] < 0 or right < 0 or self.rank(ids[k], ids[right]) != rank:
                continue  # one of the two has merged since
            ids[k], ids[right], after[k] = rank, -1, after[right]
            if after[k] >= 0:
                before[after[k]] = k
            for a, b in ((before[k], k), (k, after[k])):
                if a >= 0 and b >= 0 and (r := self.rank(ids[a], ids[b])) is not None:
                    heapq.heappush(heap, (r, a))
        return ",".join(str(i) for i in ids if i >= 0)

    def fold(self, words: list[bytes]) -> list[str]:
        """Ids of each word as text."""
        out: list[str | None] = [str(r) if (r := self.whole.get(w)) is not None else self.one(w) if len(w) > SHORT else None for w in words]
        short = [k for k, ids in enumerate(out) if ids is None]
        if short:
            for k, ids in zip(short, self.in_step([words[k] for k in short])):
                out[k] = ids
        return out


class Known:
    """What one Python worker knows: the folded words and the merges for the others."""

    def __init__(self, table: pa.Table, path: str):
        self.numbers = dict(zip(table.column("word").to_pylist(), range(table.num_rows)))
        self.ids = table.column("ids").combine_chunks()
        self.merges = Merges(read_ranks(path))

    def shown(self, words: list[bytes]) -> np.ndarray:
        """Ids of each word as text."""
        at = np.fromiter(map(self.numbers.get, words, itertools.repeat(-1)), dtype=np.int64, count=len(words))
        out, found = np.empty(len(words), dtype=object), at >= 0
        out[found] = self.ids.take(pa.array(at[found])).to_pylist()
        out[~found] = self.merges.fold([words[k] for k in np.flatnonzero(~found).tolist()])
        return out


LOADED: dict[str, Known] = {}  # of this Python worker


def known_here(name: str, table: pa.Table, path: str) -> Known:
    """Unpacked once per Python worker, one table at a time."""
    if name not in LOADED:
        LOADED.clear()
        LOADED[name] = Known(table, path)
    return LOADED[name]


def encode(docs: DataFrame, path: str, known: int = KNOWN, output: str = "ids", text_column: str = "text") -> DataFrame:
    """All columns of ``docs`` and the ids of each whole text, as text with commas; empty for a null or empty text.

    The pattern is that of ``pieces``. Special tokens are not looked for. Null ids, equal rows and any other columns stay as they are; a column
    named like ``output`` is replaced. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    docs = docs.drop(output)
    shared = spark.sparkContext.broadcast(known_words(docs, rank_lookup(path), known, text_column))
    text.released()
    names, name = docs.columns, uuid.uuid4().hex

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = known_here(name, shared.value, path)
        for part in text.slices(batches, text_column, text.LARGE_SLICE // 2):
            data, offsets = text.raw(part.column(text_column))
            bounds, first = splitting.split(data, offsets, splitting.by_rule, None)
            coded = text.binary(data, bounds).dictionary_encode()
            every = words.shown(coded.dictionary.to_pylist())[coded.indices.to_numpy()].tolist() if len(data) else []
            ids = [",".join(every[a:b]) for a, b in zip(first[:-1].tolist(), first[1:].tolist())]
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in names), pa.array(ids, pa.string())], [*names, output])

    schema = T.StructType([*docs.schema.fields, T.StructField(output, T.StringType())])
    return docs.mapInArrow(text.tidy(cut), schema)


def decode(coded: DataFrame, path: str, ids: str = "ids", output: str = "decoded") -> DataFrame:
    """All columns and the bytes of the ids (text with commas, of any length; null and empty give no bytes).

    Equal rows stay; a column named like ``output`` is replaced. An empty table gives an empty result.
    """
    ranks = read_ranks(path)
    size = max(ranks.values(), default=-1) + 1
    words: list[bytes] = [b""] * size
    for word, number in ranks.items():
        words[number] = word
    ends = np.concatenate([[0], np.cumsum([len(w) for w in words])]).astype(np.int64)
    shared = coded.sparkSession.sparkContext.broadcast((np.frombuffer(b"".join(words), np.uint8), ends))
    coded = coded.drop(output)
    names = coded.columns

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flat, limits = shared.value
        for part in batches:
            out = []
            for value in part.column(ids).to_pylist():
                own = np.fromstring(value or "", dtype=np.int64, sep=",")
                sizes = limits[own + 1] - limits[own]
                total = np.cumsum(sizes)
                out.append(flat[np.arange(total[-1]) + np.repeat(limits[own] - total + sizes, sizes)].tobytes() if len(own) else b"")
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(out, pa.binary())], [*names, output])

    return coded.mapInArrow(join, T.StructType([*coded.schema.fields, T.StructField(output, T.BinaryType())]))


def round_trip(docs: DataFrame, path: str, known: int = KNOWN) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of every row.

    A null or empty text has no ids; null ids and equal rows stay; a text of any length is encoded whole. Other columns are left out, whatever their names. An
    empty table gives an empty result.
    """
    back = decode(encode(docs.select("doc_id", "text"), path, known).drop("text"), path)
    count = F.when(F.col("ids") == "", F.lit(0)).otherwise(F.length("ids") - F.length(F.replace("ids", F.lit(","), F.lit(""))) + 1)
    return back.select("doc_id", count.cast("bigint").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
