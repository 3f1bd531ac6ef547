"""Token ids in binary files with an index by document key.

Files (Parquet, below one folder): ``blocks`` holds the raw little-endian ids of consecutive documents, about four megabytes of text each, in
ascending order of shard, block and key; ``index`` holds, for each hash bucket of keys, a minimal perfect hash function, one fingerprint per
key, and where the key's documents lie. A lookup hashes the key to its bucket, runs through the levels of the function (1.6 on average),
compares the fingerprint and reads one range of one block, however many documents there are. Documents without a key lie behind all others;
``keyless`` lists their places.

The function is built in levels: keys that are alone on their bit of a level keep it, the others go on to the next. A key's slot is the number
of set bits before its own.
"""

from __future__ import annotations

import functools
import itertools
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tiffin.llm import pieces, text
from tiffin.llm.token_counts import byte_letters
from tiffin.session import scratch_path

CACHED_PIECES = 600_000
SLICE_BYTES = 4 << 20  # of text in a block
KEYS_PER_BUCKET = 50_000
SPREAD = 2  # bits of a level for each key that comes to it
ENTRY = np.dtype([("shard", "<i4"), ("block", "<i4"), ("at", "<i8"), ("tokens", "<i8"), ("start", "<i8")])


class Encoder:
    """Ids of whole texts; the tokenizers library encodes each distinct piece once, and its ids are kept within a bound."""

    def __init__(self, path: str, special: str | None):
        from tokenizers import Tokenizer

        library = Tokenizer.from_file(path)
        self.model, self.special = library.model, (special.encode(), library.token_to_id(special)) if special else (None, None)
        self.letters = dict(enumerate(byte_letters()))
        self.forget()

    def forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.flat, self.ends = np.zeros(0, np.uint32), np.zeros(1, np.int64)

    def learn(self, words: list[bytes]) -> None:
        special, number = self.special
        found = [[number] if w == special else [t.id for t in self.model.tokenize(w.decode("latin-1").translate(self.letters))] for w in words]
        first = len(self.known)
        self.known.update(zip(words, range(first, first + len(words))))
        sizes = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
        self.flat = np.concatenate([self.flat, np.fromiter(itertools.chain.from_iterable(found), dtype=np.uint32, count=int(sizes.sum()))])
        self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(sizes)])

    def numbers(self, words: list[bytes]) -> np.ndarray:
        """Where each piece's ids are kept; -1 for those not known yet."""
        return np.fromiter(map(self.known.get, words, itertools.repeat(-1)), dtype=np.int64, count=len(words))

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of a batch of texts and their offsets."""
        bounds, first = pieces.split(data, offsets, pieces.by_rule, self.special[0])
        coded = text.binary(data, bounds).dictionary_encode()
        words = coded.dictionary.to_pylist()
        at = self.numbers(words)
        if (at < 0).any():
            if len(self.known) > CACHED_PIECES:
                self.forget()
                at[:] = -1
            self.learn([words[k] for k in np.flatnonzero(at < 0).tolist()])
            at = self.numbers(words)
        at = at[coded.indices.to_numpy()] if len(words) else at
        begins, sizes = self.ends[at], self.ends[at + 1] - self.ends[at]
        ends = np.concatenate([np.zeros(1, np.int64), np.cumsum(sizes)])
        return self.flat[np.arange(ends[-1]) + np.repeat(begins - ends[:-1], sizes)], ends[first]


@functools.cache
def encoder(path: str, special: str | None) -> Encoder:
    """One per Python worker."""
    return Encoder(path, special)


def hashed(keys: np.ndarray, level: int) -> np.ndarray:
    return text.mixed(keys.astype(np.int64).view(np.uint64) + np.uint64(0x9E3779B97F4A7C15 * (level + 1) % (1 << 64)))


def build_function(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Minimal perfect hash function of distinct keys: words of each level's bits, set bits before each word, sizes of the levels in bits."""
    words, sizes, level = [], [], 0
    while len(keys):
        bits = -(-SPREAD * len(keys) // 64) * 64
        place = (hashed(keys, level) % np.uint64(bits)).astype(np.int64)
        alone = np.bincount(place, minlength=bits) == 1
        words.append(np.packbits(alone, bitorder="little").view("<u8"))
        sizes.append(bits)
        keys = keys[~alone[place]]
        level += 1
    all_words = np.concatenate([*words, np.zeros(0, "<u8")]).astype("<u8")
    counts = np.bitwise_count(all_words).astype("<u4")
    return all_words, (np.cumsum(counts) - counts).astype("<u4"), np.array(sizes, dtype=np.int64)


def slots(keys: np.ndarray, words: np.ndarray, before: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Slot of each key; -1 where no level has its bit set. A key that was not built in may get any slot."""
    out, open_, base = np.full(len(keys), -1, np.int64), np.arange(len(keys)), 0
    for level, bits in enumerate(sizes.tolist()):
        place = hashed(keys[open_], level) % np.uint64(bits)
        word, bit = base + (place >> np.uint64(6)).astype(np.int64), place & np.uint64(63)
        hit = (words[word] >> bit) & np.uint64(1) == 1
        rank = before[word] + np.bitwise_count(words[word] & ((np.uint64(1) << bit) - np.uint64(1)))
        out[open_[hit]] = rank[hit]
        open_ = open_[~hit]
        base += bits // 64
    return out


def fingerprints(keys: np.ndarray) -> np.ndarray:
    return (hashed(keys, 1 << 20) >> np.uint64(32)).astype("<u4")


INDEX_SCHEMA = "bucket bigint, n_keys bigint, words binary, before binary, sizes binary, prints binary, firsts binary, entries binary"


def build_bucket(rows: pd.DataFrame) -> pd.DataFrame:
    """Index row of one bucket; documents with one key are kept together, in file order."""
    rows = rows.sort_values(["doc_key", "start"], kind="stable")
    keys, firsts = np.unique(rows["doc_key"].to_numpy(), return_index=True)
    words, before, sizes = build_function(keys)
    slot = slots(keys, words, before, sizes)
    order = np.argsort(slot)
    ends = np.append(firsts, len(rows))
    sizes_of = np.diff(ends)[order]
    entries = np.empty(len(rows), dtype=ENTRY)
    for name in ENTRY.names:
        entries[name] = rows[name].to_numpy()
    taken = np.concatenate([np.arange(ends[k], ends[k + 1]) for k in order])
    return pd.DataFrame({
        "bucket": [int(rows["bucket"].iloc[0])], "n_keys": [len(keys)], "words": [words.tobytes()], "before": [before.tobytes()],
        "sizes": [sizes.astype("<i8").tobytes()], "prints": [fingerprints(keys[order]).tobytes()],
        "firsts": [np.concatenate([[0], np.cumsum(sizes_of)]).astype("<i8").tobytes()], "entries": [entries[taken].tobytes()],
    })


def find(keys: np.ndarray, row) -> tuple[np.ndarray, np.ndarray]:
    """Entries of the keys that an index row has, and which of the keys each belongs to."""
    words, before = np.frombuffer(row.words, "<u8"), np.frombuffer(row.before, "<u4")
    slot = slots(keys, words, before, np.frombuffer(row.sizes, "<i8"))
    known = (slot >= 0) & (np.frombuffer(row.prints, "<u4")[np.maximum(slot, 0)] == fingerprints(keys))
    firsts, entries = np.frombuffer(row.firsts, "<i8"), np.frombuffer(row.entries, ENTRY)
    at = np.flatnonzero(known)
    sizes = firsts[slot[at] + 1] - firsts[slot[at]]
    owner = np.repeat(at, sizes)
    place = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(firsts[slot[at]], sizes)
    return entries[place], owner


def bucket_of(column: str, buckets: int):
    return F.pmod(F.xxhash64(F.col(column)), F.lit(buckets))


def write_ids(
    docs: DataFrame, folder: str, path: str, end_id: int = 2, id_column: str = "doc_id", text_column: str = "text",
    special: str | None = "<|endoftext|>", width: int = 4, shards: int | None = None,
) -> None:
    """Encode whole texts and write ``folder/blocks``, ``folder/index`` and ``folder/keyless``.

    ``width`` is the number of bytes of an id in the files, 2 or 4 (2 needs a vocabulary below 65,536). Documents lie in ascending order of key;
    equal keys in an order set by their text, null keys last; equal rows are all kept. A null text is a document of the end id only. Keys are whole
    numbers. Other columns are left out, whatever their names. An empty table gives empty files. Shards are sized by the input. Texts are shuffled once, by ranges of (key, hash of the text), so that even one repeated key spreads.
    """
    spark = docs.sparkSession
    text.prepared(spark)
    shards = shards or text.parts_for(docs)
    kind = np.dtype(f"<u{width}")

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine, shard = encoder(path, special), TaskContext.get().partitionId()
        for number, part in enumerate(text.slices(batches, "body", SLICE_BYTES)):
            ids, ends = machine.encode(*text.raw(part.column("body")))
            sizes = np.diff(ends) + 1
            out = np.full(int(sizes.sum()), end_id, dtype=kind)
            owner = np.repeat(np.arange(len(sizes)), sizes - 1)
            out[np.arange(len(ids)) + owner] = ids
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([shard], pa.int32()), pa.array([number], pa.int32()), pa.array([len(out)], pa.int64()),
                    pa.ListArray.from_arrays(pa.array([0, part.num_rows], pa.int32()), part.column("id")), text.lists(sizes, np.array([0, len(sizes)])),
                    pa.array([out.tobytes()], pa.binary()),
                ],
                ["shard", "block", "tokens", "keys", "counts", "ids"],
            )

    source = docs.select(F.col(f"`{id_column}`").cast("bigint").alias("id"), text.utf8(text_column).alias("body"))
    order = [F.col("id").asc_nulls_last(), F.xxhash64("body")]
    ranged = source.repartitionByRange(shards, *order).sortWithinPartitions(*order)
    schema = "shard int, block int, tokens bigint, keys array<bigint>, counts array<bigint>, ids binary"
    ranged.mapInArrow(text.tidy(blocks), schema).write.option("compression", "zstd").parquet(f"{folder}/blocks")

    written = spark.read.schema(schema).parquet(f"{folder}/blocks")
    # One row per shard comes back, as many as the shuffle has partitions.
    sums = written.groupBy("shard").agg(F.sum("tokens").alias("tokens"), F.sum(F.size("keys")).alias("n")).orderBy("shard").collect()
    bases = [0, *itertools.accumulate(r.tokens for r in sums)]
    base = spark.createDataFrame([(r.shard, b) for r, b in zip(sums, bases)], "shard int, base bigint")
    buckets = max(shards, -(-sum(r.n for r in sums) // KEYS_PER_BUCKET))
    inside = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)  # the blocks of one shard
    placed = written.select("shard", "block", "tokens").withColumn("lead", F.coalesce(F.sum("tokens").over(inside), F.lit(0)))
    starts = placed.join(F.broadcast(base), "shard").select("shard", "block", (F.col("base") + F.col("lead")).alias("first"))

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in ("shard", "block", "first")), batch.column("keys"), batch.column("counts"))
            for shard, block, first, keys, counts in rows:
                sizes = np.asarray(counts.values)
                ends = np.cumsum(sizes)
                n = len(sizes)
                yield pa.RecordBatch.from_arrays(
                    [
                        keys.values, pa.array(np.full(n, shard, np.int32)), pa.array(np.full(n, block, np.int32)),
                        pa.array(ends - sizes), pa.array(sizes), pa.array(ends - sizes + first),
                    ],
                    ["doc_key", "shard", "block", "at", "tokens", "start"],
                )

    places = (
        written.select("shard", "block", "keys", "counts").join(starts, ["shard", "block"])
        .mapInArrow(entries, "doc_key bigint, shard int, block int, at bigint, tokens bigint, start bigint")
    )
    places.where("doc_key IS NULL").write.parquet(f"{folder}/keyless")
    located = places.where("doc_key IS NOT NULL").withColumn("bucket", bucket_of("doc_key", buckets))
    located.groupBy("bucket").applyInPandas(build_bucket, INDEX_SCHEMA).withColumn("buckets", F.lit(buckets)).write.parquet(f"{folder}/index")


def read_ids(spark: SparkSession, folder: str, keys: DataFrame, width: int = 4) -> DataFrame:
    """``doc_key, start, ids`` (binary) of the documents with the given keys (one column), found by the index; unknown keys give no row.

    Each key's bucket of the index is read once; the ranges then meet their blocks by one join on (shard, block). A null among the keys asks for
    the documents without a key, which come from their list. No keys give no rows.
    """
    index = spark.read.parquet(f"{folder}/index")
    some = index.select("buckets").limit(1).collect()
    buckets = some[0].buckets if some else 1
    asked = keys.toDF("doc_key")
    wanted = asked.where("doc_key IS NOT NULL").distinct().withColumn("bucket", bucket_of("doc_key", buckets))

    def look(asked: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        if asked.empty or rows.empty:
            return pd.DataFrame({c: [] for c in ("doc_key", *ENTRY.names)})
        keys = asked["doc_key"].to_numpy()
        found, owner = find(keys, next(rows.itertuples()))
        return pd.DataFrame({"doc_key": keys[owner]} | {n: found[n] for n in ENTRY.names})

    places = wanted.groupBy("bucket").cogroup(index.drop("buckets").groupBy("bucket")).applyInPandas(
        look, "doc_key bigint, shard int, block int, at bigint, tokens bigint, start bigint"
    )
    null_asked = asked.where("doc_key IS NULL").limit(1).agg(F.count(F.lit(1)) > 0).scalar()
    keyless = spark.read.schema("doc_key bigint, shard int, block int, at bigint, tokens bigint, start bigint").parquet(f"{folder}/keyless")
    places = places.unionByName(keyless.where(null_asked))
    # One list per block: as many entries as the block has documents.
    ranges = places.groupBy("shard", "block").agg(F.collect_list(F.struct("doc_key", "at", "tokens", "start")).alias("ranges"))
    # A few blocks a task: blocks are some megabytes each, and hashing deals them unevenly.
    payload = spark.read.parquet(f"{folder}/blocks").select("shard", "block", "ids").repartition(4 * text.parts_for(keys), "shard", "block")
    both = payload.join(ranges, ["shard", "block"]).select("ids", "ranges")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                ids, own = batch.column("ids")[k].as_buffer(), batch.column("ranges")[k].values
                at, tokens = (own.field(c).to_numpy() * width for c in ("at", "tokens"))
                parts = [bytes(ids.slice(a, n)) for a, n in zip(at.tolist(), tokens.tolist())]
                yield pa.RecordBatch.from_arrays([own.field("doc_key"), own.field("start"), pa.array(parts, pa.binary())], ["doc_key", "start", "ids"])

    return both.mapInArrow(cut, "doc_key bigint, start bigint, ids binary")


def digests(found: DataFrame, width: int = 4) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32``: checksum of the ids as unsigned 32-bit little-endian numbers. No rows give no rows."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [x.as_buffer() for x in batch.column("ids")]
            crc = [zlib.crc32(np.frombuffer(x, f"<u{width}").astype("<u4").tobytes()) for x in ids]
            counts = [x.size // width for x in ids]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_key"), batch.column("start"), pa.array(counts, pa.int64()), pa.array(crc, pa.int64())],
                ["doc_id", "start", "n_tokens", "ids_crc32"],
            )

    return found.mapInArrow(check, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def token_files(docs: DataFrame, path: str, end_id: int = 2, width: int = 2) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every row: its ids written to a new folder and read back by its key, null keys included.

    A null or empty text has the end id only; equal rows and rows of one key are documents of their own, of any length. Other columns are left out,
    whatever their names. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    folder = scratch_path(spark, "token-files")
    write_ids(docs, folder, path, end_id, width=width)
    return digests(read_ids(spark, folder, docs.select("doc_id"), width), width)
