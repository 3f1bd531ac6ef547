"""Near duplicates by bottom-k sketches.

A document's set is the hashes of its word shingles. Documents with equal sets form a class and go on as one. From the sorted set the smallest
``k`` values are retained: one hash function gives the sketch. Inverted lists of the retained values, three neighbouring ones at a time, bring
documents together: when 80 % of a union's values are shared, three neighbours are shared among 64 with a chance of failure below 1e-10, and
always among sets of 6 to k values (pairs of neighbours do for still smaller ones). A list of any length is paired with its smallest document
only, never with itself, and the sketch of the union has to estimate a similarity of 0.5 or more, which a true link misses with a chance
near 1e-8. What remains is verified on the full sets.

Links that a list's smallest document does not show (two documents alike to each other but not to it) are looked for afterwards, among
documents that met the same smallest document and are not connected yet, if their lists were shared often enough for a link (five times,
which a true link misses with a chance near 1e-6; once, for whole sets). They are compared in blocks of bounded size, first by sketches, which
leave the documents that may have such a link, then these by their full sets. Only links come out, no pairs. The rows that are compared grow
with the number of such documents times the blocks of their group, so a group of copies that are mostly not alike is the costly case.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiffin.llm import text
from tiffin.llm.components import components
from tiffin.llm.decontaminate import lowered
from tiffin.session import durable

KEPT = 64
RUN = 3
ESTIMATE = 0.5
OFTEN = 5
BLOCK = 1500
COLUMNS = 4096  # shared values compared at a time


def shingle_sets(words: text.Words, size: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; a text with fewer words is one shingle, one without words has none."""
    own, docs = words.hashes(), words.docs
    windows = text.window_hashes(own, size)
    out = []
    for begin, end in zip(docs[:-1].tolist(), docs[1:].tolist()):
        n = end - begin
        if n >= size:
            out.append(np.unique(windows[begin : end - size + 1]))
        else:
            out.append(text.window_hashes(own[begin:end], n) if n else np.zeros(0, np.uint64))
    return out


def joined(parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    ends = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)
    return np.concatenate([*parts, np.zeros(0, np.uint64)]).astype(np.uint64), ends


def estimated(a: np.ndarray, b: np.ndarray, k: int) -> float:
    """Similarity by the k smallest values of the union of two sketches."""
    union = np.union1d(a, b)[:k]
    return np.isin(union, np.intersect1d(a, b, assume_unique=True), assume_unique=True).sum() / max(1, len(union))


def similar(shared: int, a: int, b: int, percent: int) -> bool:
    return 100 * shared >= percent * (a + b - shared)


def sketches(docs: DataFrame, size: int, k: int) -> DataFrame:
    """``id, n_shingles, digest, sketch`` of every row; the digest names the set."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text.slices(batches, "body"):
            data, offsets = text.raw(part.column("body"))
            sets = shingle_sets(text.Words(lowered(data), offsets), size)
            values, ends = joined([s[:k] for s in sets])
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("id"), pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary()), text.binary(values, ends * 8),
                ],
                ["id", "n_shingles", "digest", "sketch"],
            )

    return docs.mapInArrow(text.tidy(cut), "id bigint, n_shingles bigint, digest binary, sketch binary")


def list_entries(classes: DataFrame) -> DataFrame:
    """``key, rep``: the runs of neighbouring retained values of each class."""

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text.raw(batch.column("sketch"))
            values, ends = data.view("<u8"), offsets // 8
            reps, sizes = batch.column("rep").to_numpy(), batch.column("n").to_numpy()
            for length in (RUN, RUN - 1):
                bounds = ends if length == RUN else np.concatenate([[0], np.cumsum(np.where(sizes <= 5, np.diff(ends), 0))])
                own = values if length == RUN else values[np.repeat(sizes <= 5, np.diff(ends))]
                if len(own) < length:
                    continue
                at, owner = text.window_starts(bounds, length)
                keys = text.window_hashes(own, length)[at] + np.uint64(length)
                yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(reps[owner])], ["key", "rep"])

    return classes.where("n > 3").select("rep", "n", "sketch").mapInArrow(text.tidy(runs), "key bigint, rep bigint")


def with_sketches(pairs: DataFrame, classes: DataFrame, *keep: str) -> DataFrame:
    """Pairs (a, b) with both classes' sizes and sketches; pairs whose sizes rule a link out should be gone already."""
    own = classes.select("rep", "n", "sketch")
    return pairs.join(own.toDF("a", "n_a", "sketch_a"), "a").join(own.toDF("b", "n_b", "sketch_b"), "b").select("a", "b", "n_a", "n_b", "sketch_a", "sketch_b", *keep)


def likely(pairs: DataFrame, classes: DataFrame, percent: int, k: int) -> DataFrame:
    """The pairs that sizes and the sketch of the union leave."""

    def estimate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = zip(batch.column("sketch_a"), batch.column("sketch_b"))
            good = [estimated(np.frombuffer(x.as_buffer(), "<u8"), np.frombuffer(y.as_buffer(), "<u8"), k) >= ESTIMATE for x, y in both]
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    sized = with_sketches(pairs, classes).where(100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b"))
    return sized.select("a", "b", "sketch_a", "sketch_b").mapInArrow(estimate, "a bigint, b bigint")


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets are similar. A hot side's join is left to be split by its size."""

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for x, y in zip(batch.column("set_a"), batch.column("set_b")):
                a, b = np.frombuffer(x.as_buffer(), "<u8"), np.frombuffer(y.as_buffer(), "<u8")
                good.append(similar(len(np.intersect1d(a, b, assume_unique=True)), len(a), len(b), percent))
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    both = pairs.join(sets.toDF("b", "set_b"), "b").join(sets.toDF("a", "set_a"), "a")
    return both.select("a", "b", "set_a", "set_b").mapInArrow(verify, "a bigint, b bigint")


def full_sets(docs: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """``rep, set`` of the documents with the wanted ids, whose number grows with the input: the texts are shuffled for it at every size."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text.slices(batches, "body"):
            data, offsets = text.raw(part.column("body"))
            values, ends = joined(shingle_sets(text.Words(lowered(data), offsets), size))
            yield pa.RecordBatch.from_arrays([part.column("id"), text.binary(values, ends * 8)], ["rep", "set"])

    return docs.join(wanted.toDF("id").hint("merge"), "id", "left_semi").mapInArrow(text.tidy(cut), "rep bigint, set binary")


def shared_counts(values: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Number of common values of each left and each right set, by products of incidence tables of a bounded number of columns."""
    _, place, often = np.unique(np.concatenate(values), return_inverse=True, return_counts=True)
    useful = np.cumsum(often > 1) - 1  # a value of one set only is shared with none
    owner = np.repeat(np.arange(len(values)), [len(v) for v in values])
    both = often[place] > 1
    owner, column = owner[both], useful[place[both]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    total = np.zeros((len(left), len(right)), np.float32)
    for begin in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS):
        a, b = np.searchsorted(column, [begin, begin + COLUMNS])
        table = np.zeros((len(values), COLUMNS), np.float32)
        table[owner[a:b], column[a:b] - begin] = 1
        total += table[left] @ table[right].T
    return total


GROUP = ["hub", "i", "j"]


def in_blocks(members: DataFrame, values: str, schema: str, work) -> DataFrame:
    """``work`` on the rows of each pair of blocks, one pair in memory at a time. ``members``: hub, i, j, block, rep, component, n and the values."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for batch in batches for r in zip(*(c.to_pylist() for c in batch.columns)))
        for _, own in groupby(rows, key=lambda r: r[:3]):
            own = list(own)
            block, component, n = (np.array([r[k] for r in own]) for k in (3, 5, 6))
            left, right = np.flatnonzero(block == own[0][1]), np.flatnonzero(block == own[0][2])
            if len(left) and len(right):
                open_ = component[left][:, None] != component[right][None, :]
                shared = shared_counts([np.frombuffer(r[7], "<u8") for r in own], left, right)
                yield from work(own, n, left, right, open_, shared)

    n = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = members.select(*GROUP, "block", "rep", "component", "n", values).repartition(n, *GROUP).sortWithinPartitions(*GROUP)
    return dealt.mapInArrow(text.tidy(each), schema)


def promising(members: DataFrame, percent: int) -> DataFrame:
    """The members that share half a sketch with one of another component, whose size does not rule a link out."""

    def work(own, n, left, right, open_, shared):
        kept = np.array([len(r[7]) // 8 for r in own])
        open_ &= shared >= ESTIMATE * np.minimum(kept[left][:, None], kept[right][None, :])
        open_ &= 100 * np.minimum(n[left][:, None], n[right][None, :]) >= percent * np.maximum(n[left][:, None], n[right][None, :])
        found = np.union1d(left[open_.any(axis=1)], right[open_.any(axis=0)])
        columns = [pa.array([own[k][c] for k in found], t) for c, t in zip(range(7), (pa.int64(), *[pa.int32()] * 3, *[pa.int64()] * 3))]
        yield pa.RecordBatch.from_arrays(columns, [*GROUP, "block", "rep", "component", "n"])

    return in_blocks(members, "sketch", "hub bigint, i int, j int, block int, rep bigint, component bigint, n bigint", work)


def late_links(members: DataFrame, percent: int) -> DataFrame:
    """Links between the components of a block pair, on full sets."""

    def work(own, n, left, right, open_, shared):
        total = n[left][:, None] + n[right][None, :]
        x, y = np.nonzero(open_ & (100 * shared.astype(np.float64) >= percent * (total - shared)))
        reps = np.array([r[4] for r in own])
        yield pa.RecordBatch.from_arrays([pa.array(reps[left[x]]), pa.array(reps[right[y]])], ["a", "b"])

    return in_blocks(members, "set", "a bigint, b bigint", work).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def unresolved(met: DataFrame, chances: DataFrame, linked: DataFrame, classes: DataFrame, block: int = BLOCK) -> DataFrame:
    """Members of the hubs that hold several components, in pairs of blocks."""
    own = met.select("a", F.col("b").alias("rep")).union(met.select("a", F.col("a").alias("rep"))).distinct()
    enough = chances.join(classes.select("rep", "n", (F.length("sketch") / 8).alias("kept")), "rep").where((F.col("shared") >= OFTEN) | (F.col("kept") == F.col("n")))
    labelled = (
        own.join(enough.select("rep"), "rep").join(linked.toDF("rep", "component"), "rep", "left")
        .select(F.col("a").alias("hub"), "rep", F.coalesce("component", "rep").alias("component"))
    )
    labelled = durable(labelled, "met")
    split = labelled.groupBy("hub").agg(F.count("*").alias("members"), F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high")
    blocks = split.select("hub", F.ceil(F.col("members") / block).cast("int").alias("blocks"))
    placed = labelled.join(blocks, "hub").withColumn("block", F.pmod(F.xxhash64("rep"), "blocks").cast("int"))
    each = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    each = each.select("hub", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "rep", "component")
    return each.join(classes.select("rep", "n", "sketch"), "rep")


def near_duplicates(
    docs: DataFrame, size: int = 5, percent: int = 80, k: int = KEPT, id_column: str = "doc_id", text_column: str = "text", block: int = BLOCK
) -> DataFrame:
    """``id, n_shingles, component_id, kept`` of every row: components of documents whose sets have 100 * intersection >= percent * union.

    A-Z are lower-cased; words are ``[^\\x20\\x09-\\x0D]+``. A null or empty text has no shingles and is its own component. A row whose id
    is null links with nothing, has a null component and is kept. Rows with one id are one document: linked if any of their texts is; all its
    rows carry the same verdict. Other columns are left out, whatever their names. An empty table gives an empty result. ``percent`` is
    meant for 80 and more: the chances above are for that.
    """
    spark = docs.sparkSession
    text.prepared(spark)
    source = docs.select(F.col(f"`{id_column}`").cast("bigint").alias("id"), text.utf8(text_column).alias("body"))
    rows = durable(sketches(source, size, k), "sketches")
    filled = rows.where("n_shingles > 0 AND id IS NOT NULL")
    classes = durable(filled.groupBy("digest").agg(F.min("id").alias("rep"), F.max("n_shingles").alias("n"), F.max("sketch").alias("sketch")), "classes")

    entries = list_entries(classes)
    lists = entries.groupBy("key").agg(F.min("rep").alias("hub"), F.max("rep").alias("last")).where("hub <> last").select("key", "hub")
    shared = entries.join(lists, "key").groupBy("hub", "rep").agg(F.count("*").alias("shared"))
    met_all = durable(shared, "lists")
    met = met_all.where("hub <> rep").select(F.col("hub").alias("a"), F.col("rep").alias("b"))
    chances = met_all.groupBy("rep").agg(F.sum("shared").alias("shared"))

    candidates = durable(likely(met, classes, percent, k), "candidates")
    compared = candidates.select("a").union(candidates.select("b")).distinct()
    sets = durable(full_sets(source, compared, size), "sets")
    links = durable(verified(candidates, sets, percent), "links")
    found = components(links)

    members = durable(promising(unresolved(met, chances, found, classes, block), percent), "members")
    missing = members.select("rep").distinct().join(compared.toDF("rep"), "rep", "left_anti")
    more = sets.union(full_sets(source, missing, size))
    extra = durable(late_links(members.join(more, "rep"), percent), "links")
    if not extra.isEmpty():
        found = components(links.union(extra))

    # One document may hold several sets, and copies of one set several documents: both are links of their own.
    several = filled.select("id", "digest").distinct().groupBy("id").agg(F.count("*").alias("sets")).where("sets > 1")
    named = classes.select("digest", "rep").join(found.toDF("rep", "component"), "rep", "left").select("digest", F.coalesce("component", "rep").alias("component"))
    if not several.isEmpty():
        bound = filled.join(several, "id", "left_semi").join(named, "digest").select("id", "component")
        found = components(found.toDF("a", "b").union(bound.toDF("a", "b")))
        named = classes.select("digest", "rep").join(found.toDF("rep", "component"), "rep", "left").select("digest", F.coalesce("component", "rep").alias("component"))
    named = durable(named, "named")
    out = rows.select("id", "n_shingles", "digest").join(named, "digest", "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component", "id"))
    return out.select(F.col("id").alias(id_column), "n_shingles", component.alias("component_id"), F.coalesce(component == F.col("id"), F.lit(True)).alias("kept"))
