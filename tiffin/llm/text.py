"""Numpy helpers on batches of texts: Arrow slices, words, word hashes and rolling window hashes.

A batch of texts is one byte array plus offsets, as Arrow holds it, so that no Python object is made per word. Words are
``[^\\x20\\x09-\\x0D]+``. Equal word sequences have equal 64-bit hashes; different ones differ but for a chance near 2**-56 per pair.
"""

from __future__ import annotations

import ctypes
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from functools import wraps
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tiffin.session import durable, shared_dir

__all__ = ["Words", "durable", "prepared", "shared_dir", "slices", "raw", "binary", "lists", "mixed", "window_hashes", "new_name"]

SPACES = np.zeros(256, dtype=bool)
SPACES[[0x20, 9, 10, 11, 12, 13]] = True
SLICE_BYTES = 1 << 20  # of text worked on at a time; a longer text is a slice of its own
BATCH_BYTES = 2 << 20  # of an Arrow batch; a longer row is a batch of its own
HASHED_BYTES = 1 << 16  # hashed at a time; no more than there are place keys
LARGE_SLICE = 4 << 20  # where equal words or passages of one slice are brought together


UNKNOWN_SIZE = 1 << 52  # what Spark takes for a plan without statistics is beyond this
SHIPPED: set[str] = set()  # applications whose executors have the package


def prepared(spark: SparkSession) -> None:
    """Arrow batches of few bytes, so that a batch with long texts stays small in the JVM and the worker; the package for the workers.

    The bounds are the same for every operator, so a frame returned earlier keeps them whatever is called next. The package goes along as ``--py-files`` would send it, once per application, as the executors may not have it installed.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    context = spark.sparkContext
    if context.applicationId not in SHIPPED:
        SHIPPED.add(context.applicationId)
        folder = tempfile.mkdtemp(dir=SparkFiles.getRootDirectory())
        context.addPyFile(shutil.make_archive(f"{folder}/tiffin-code", "zip", Path(__file__).resolve().parents[2], "tiffin"))


def tidy(work):
    """A function for ``mapInArrow`` that hands freed memory back at the end of a partition, as workers are used again."""

    @wraps(work)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from work(batches)
        released()

    return run


def released() -> None:
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim:
        trim(0)


def parts_for(df: DataFrame, megabytes: int = 64) -> int:
    """Number of partitions for work on the data of ``df``: at least the shuffle partitions, more where the input is so large that a part would pass
    the given size. The size is that of the files that the plan reads; where Spark does not know it, the setting alone counts."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    size = sum(int(str(leaves.apply(k).stats().sizeInBytes())) for k in range(leaves.size()))
    return max(parts, -(-(size >> 20) // megabytes)) if size < UNKNOWN_SIZE else parts


def new_name(*taken: DataFrame, stem: str = "tmp") -> str:
    """A column name that none of the given tables has."""
    name, used = stem, {c.lower() for df in taken for c in df.columns}
    while name.lower() in used:
        name = f"{stem}_{uuid.uuid4().hex[:8]}"
    return name


def utf8(column: str | Column) -> Column:
    """Text as bytes; null counts as empty."""
    column = F.col(f"`{column}`") if isinstance(column, str) else column
    return F.coalesce(column, F.lit("")).cast("binary")


def raw(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a binary or text array; the offsets start at 0. A null, as Spark hands it over, has no bytes."""
    offsets = np.frombuffer(array.buffers()[1], dtype=np.int32)[array.offset : array.offset + len(array) + 1].astype(np.int64)
    data = array.buffers()[2]
    whole = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(batches: Iterator[pa.RecordBatch], column: str, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches between rows so that the texts of one slice have about ``size`` bytes."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, offsets = raw(batch.column(column))
        at = 0
        while at < batch.num_rows:
            end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + size, side="right")) - 1)
            yield batch.slice(at, end - at)
            at = end


def binary(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """Binary array of the byte ranges between offsets."""
    data = np.ascontiguousarray(data).view(np.uint8)
    return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data)])


def lists(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """List array of the value ranges between offsets."""
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values))


def mixed(x: np.ndarray) -> np.ndarray:
    """Mixing of 64-bit values (xor-shift and multiply, one to one)."""
    x = x.astype(np.uint64, copy=True)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x ^= x >> np.uint64(shift)
        x *= np.uint64(factor)
    return x ^ (x >> np.uint64(31))


BYTE_KEYS = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
PLACE_KEYS = mixed(np.arange(1000, 1000 + (1 << 16), dtype=np.uint64)) | np.uint64(1)
BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def long_sum(letters: np.ndarray) -> np.uint64:
    """Sum of byte keys times place keys of one word of any length."""
    sums = [np.uint64(0)]
    for block, at in enumerate(range(0, len(letters), len(PLACE_KEYS))):
        own = letters[at : at + len(PLACE_KEYS)]
        values = BYTE_KEYS[own] * PLACE_KEYS[: len(own)]
        if len(letters) > len(PLACE_KEYS):
            values *= mixed(np.array([block])) | np.uint64(1)
        sums.append(values.sum(dtype=np.uint64))
    return np.array(sums).sum(dtype=np.uint64)


class Words:
    """The words of a batch of texts: byte ranges ``starts``/``ends`` and ``docs``, the offsets of each text's words."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data = data
        inside = ~SPACES[data]
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        last = inside.copy()
        last[:-1] &= ~inside[1:]
        begins = offsets[:-1][offsets[:-1] < offsets[1:]]
        first[begins] = inside[begins]
        finals = offsets[1:][offsets[:-1] < offsets[1:]] - 1
        last[finals] = inside[finals]
        self.starts = np.flatnonzero(first)
        self.ends = np.flatnonzero(last) + 1
        self.docs = np.searchsorted(self.starts, offsets)
        self.inside = inside

    def __len__(self) -> int:
        return len(self.starts)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.docs)

    def hashes(self) -> np.ndarray:
        """64-bit hash of each word: sum of byte keys times place keys, mixed. Some words at a time, as every byte takes several numbers."""
        out = np.zeros(len(self), np.uint64)
        sizes = self.ends - self.starts
        letters = self.data[self.inside]
        ends = np.cumsum(sizes)
        at = 0
        while at < len(self):
            begin = int(ends[at] - sizes[at])
            upto = max(at + 1, int(np.searchsorted(ends, begin + HASHED_BYTES, side="right")))
            if upto == at + 1:
                out[at] = long_sum(letters[begin : ends[at]])
            else:
                own = sizes[at:upto]
                firsts = ends[at:upto] - own - begin
                places = np.arange(int(own.sum()), dtype=np.int32) - np.repeat(firsts.astype(np.int32), own)
                out[at:upto] = np.add.reduceat(BYTE_KEYS[letters[begin : ends[upto - 1]]] * PLACE_KEYS[places], firsts)
            at = upto
        return mixed(out + sizes.astype(np.uint64) * BASE)

    def texts(self, keep: np.ndarray) -> list[bytes]:
        """Of each text the kept words, joined by one space."""
        out, data = [], self.data.tobytes()
        for begin, end in zip(self.docs[:-1], self.docs[1:]):
            kept = np.flatnonzero(keep[begin:end]) + begin
            out.append(b" ".join([data[a:b] for a, b in zip(self.starts[kept].tolist(), self.ends[kept].tolist())]))
        return out


def window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` words from each position on, as a rolling polynomial modulo 2**64; windows across texts are included."""
    n = len(words)
    if n < size:
        return np.zeros(0, np.uint64)
    up, down = np.full(n, BASE), np.full(n, INVERSE)
    up[0] = down[0] = 1
    up, down = np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words * up, dtype=np.uint64)])
    return mixed((total[size:] - total[:-size]) * down[: n - size + 1])


def window_starts(docs: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions at which a window within one text starts, and the number of the text."""
    counts = np.maximum(0, np.diff(docs) - size + 1)
    owner = np.repeat(np.arange(len(counts)), counts)
    begins = np.cumsum(counts) - counts
    return np.arange(int(counts.sum())) - begins[owner] + docs[:-1][owner], owner
