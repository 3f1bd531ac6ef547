"""Removal of passages that an earlier document has, by fixed-block anchors.

A passage counts from ``size`` words on (a window). Every document is cut into non-overlapping reference blocks of half a window, so that any
window holds a whole block of the document it lies in. The blocks are indexed by hash; every rolling window of block length of every document
probes the index. A hit marks the place of a possible repeat in both documents. Around the hits, whole windows are hashed and compared by the
smallest document they start in; overlapping windows that an earlier document has join up to the maximal repeats, whose words go.

What is shuffled: per probe five bytes, packed into one row per slice of input and bucket of hashes; texts once, by id; and windows around hits.
Buckets are sized by the input, have a partition each, and are brought together a part of the hashes at a time.
A slice settles what it can itself: a block that eight of its documents share is a hit without asking, and goes on as one probe; of a window
that several of its documents have, only the smallest one's goes on. So a passage that a third of all documents share stays spread.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tiffin.llm import text

SHARED = 8  # documents of one slice that make a block a hit at once
LOW = np.uint64((1 << 40) - 1)
NAME_BITS = np.uint64((1 << 31) - 1)
PARTS = 8  # of a bucket's hashes, one in memory at a time
BUCKET_MB = 32  # of input
PACKED = "bucket int, ids binary, counts binary, low binary, high binary, refs binary"


def runs(values: np.ndarray) -> np.ndarray:
    """First places of the runs of equal neighbours."""
    return np.flatnonzero(np.concatenate([np.ones(min(1, len(values)), bool), values[1:] != values[:-1]]))


def packed(bucket: np.ndarray, ids: np.ndarray, hashes: np.ndarray, refs: np.ndarray | None) -> Iterator[pa.RecordBatch]:
    """One row per bucket: ids with their numbers of hashes, the hashes' lower 40 bits, and which are reference blocks."""
    order = np.lexsort((ids, bucket))
    bucket, ids, hashes = bucket[order], ids[order], hashes[order]
    refs = refs[order] if refs is not None else None
    firsts = runs(bucket)
    rows = []
    for begin, end in zip(firsts.tolist(), [*firsts[1:].tolist(), len(bucket)]):
        own = ids[begin:end]
        each = runs(own)
        rows.append((
            int(bucket[begin]), own[each].tobytes(), np.diff(np.append(each, end - begin)).astype("<i4").tobytes(), hashes[begin:end].astype("<u4").tobytes(),
            (hashes[begin:end] >> np.uint64(32)).astype(np.uint8).tobytes(), np.packbits(refs[begin:end]).tobytes() if refs is not None else None,
        ))
    kinds = (pa.int32(), *(pa.binary() for _ in range(5)))
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["bucket", "ids", "counts", "low", "high", "refs"])


def unpacked(table: pa.Table, part: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray | None]]:
    """Ids, hashes and reference flags of the hashes of one part, row by row."""
    for ids, counts, low, high, refs in zip(*(table.column(c) for c in ("ids", "counts", "low", "high", "refs"))):
        top = np.frombuffer(high.as_buffer(), np.uint8)
        mine = np.flatnonzero(top % PARTS == part)
        hashes = np.frombuffer(low.as_buffer(), "<u4")[mine] | (top[mine].astype(np.uint64) << np.uint64(32))
        ends = np.cumsum(np.frombuffer(counts.as_buffer(), "<i4"))
        owner = np.frombuffer(ids.as_buffer(), "<i8")[np.searchsorted(ends, mine, side="right")]
        yield owner, hashes, np.unpackbits(np.frombuffer(refs.as_buffer(), np.uint8), count=len(top))[mine].astype(bool) if refs.is_valid else None


def by_id(ids: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct ids, their values one after the other, and where each id's begin (with the end)."""
    order = np.argsort(ids, kind="stable")
    ids, values = ids[order], np.ascontiguousarray(values[order])
    firsts = runs(ids)
    return ids[firsts], values, np.append(firsts, len(ids))


FOUND = "part int, ids binary, counts binary, found binary"


def handed_on(ids: np.ndarray, values: np.ndarray, parts: int) -> pa.Table:
    """What was found for ids, one row per part of the ids, so that rows do not multiply with buckets."""
    part = (ids % parts).astype(np.int32)
    order = np.lexsort((ids, part))
    part, ids, values = part[order], ids[order], values[order]
    firsts = runs(part)
    rows = []
    for begin, end in zip(firsts.tolist(), [*firsts[1:].tolist(), len(part)]):
        own, ordered, ends = by_id(ids[begin:end], values[begin:end])
        rows.append((int(part[begin]), own.astype("<i8").tobytes(), np.diff(ends).astype("<i4").tobytes(), ordered.tobytes()))
    kinds = (pa.int32(), pa.binary(), pa.binary(), pa.binary())
    columns = list(zip(*rows)) or [[]] * 4
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], ["part", "ids", "counts", "found"])


def gathered(found: DataFrame, name: str, kind: str, parts: int) -> DataFrame:
    """``id`` and all that was found for it, as bytes: one row per id."""

    def gather(table: pa.Table) -> pa.Table:
        ids = [np.repeat(np.frombuffer(i.as_buffer(), "<i8"), np.frombuffer(c.as_buffer(), "<i4")) for i, c in zip(table.column("ids"), table.column("counts"))]
        own, values, ends = by_id(np.concatenate(ids), np.concatenate([np.frombuffer(f.as_buffer(), kind) for f in table.column("found")]))
        return pa.table({"id": pa.array(own), name: text.binary(values, ends * values.dtype.itemsize)})

    return found.repartitionById(parts, "part").groupBy("part").applyInArrow(gather, f"id bigint, {name} binary")


def probes(source: DataFrame, size: int, buckets: int) -> DataFrame:
    """Rolling windows of block length of all documents, those at block places marked as references, packed by bucket."""
    block = (size + 1) // 2

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text.slices(batches, "body", text.LARGE_SLICE):
            words = text.Words(*text.raw(part.column("body")))
            at, owner = text.window_starts(words.docs, block)
            long_enough = words.counts[owner] >= size
            at, owner = at[long_enough], owner[long_enough]
            if not len(at):
                continue
            hashes = text.window_hashes(words.hashes(), block)[at]
            ids = part.column("id").to_numpy()[owner]
            order = np.lexsort((ids, hashes))
            hashes, ids, ref = hashes[order], ids[order], ((at - words.docs[owner]) % block == 0)[order]
            new_hash = np.concatenate([[True], hashes[1:] != hashes[:-1]])
            firsts = np.flatnonzero(new_hash | np.concatenate([[True], ids[1:] != ids[:-1]]))  # each document's once
            ref = np.logical_or.reduceat(ref, firsts)
            hashes, ids, new_hash = hashes[firsts], ids[firsts], new_hash[firsts]
            groups = np.flatnonzero(new_hash)
            members = np.diff(np.append(groups, len(hashes)))
            common = np.repeat(members >= SHARED, members)
            ref[groups] |= np.logical_or.reduceat(ref, groups) & (members >= SHARED)
            bucket = ((hashes >> np.uint64(40)) % np.uint64(buckets)).astype(np.int32)
            asked = ~common | new_hash
            yield from packed(bucket[asked], ids[asked], hashes[asked], ref[asked])
            if common.any():
                yield from packed((ids[common] % buckets).astype(np.int32), ids[common], hashes[common], None)

    return source.mapInArrow(text.tidy(cut), PACKED)


def anchors(probed: DataFrame, parts: int) -> DataFrame:
    """``id, hits``: the blocks (lower 40 bits of the hash) of each document that are reference blocks somewhere and lie in another document too."""

    def meet(table: pa.Table) -> pa.Table:
        sure_ids, sure = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
        for part in range(PARTS):
            ids, hashes, refs = [], [], []
            for owner, own, ref in unpacked(table, part):
                if ref is None:
                    sure_ids.append(owner)
                    sure.append(own)
                else:
                    ids.append(owner)
                    hashes.append(own)
                    refs.append(ref)
            if not sum(map(len, ids)):
                continue
            ids, hashes, refs = np.concatenate(ids), np.concatenate(hashes), np.concatenate(refs)
            order = np.argsort(hashes, kind="stable")
            ids, hashes, refs = ids[order], hashes[order], refs[order]
            firsts = runs(hashes)
            repeated = np.logical_or.reduceat(refs, firsts) & (np.minimum.reduceat(ids, firsts) < np.maximum.reduceat(ids, firsts))
            hit = np.repeat(repeated, np.diff(np.append(firsts, len(hashes))))
            sure_ids.append(ids[hit])
            sure.append(hashes[hit])
        return handed_on(np.concatenate(sure_ids), np.concatenate(sure).astype("<u8"), parts)

    return gathered(probed.repartitionById(parts, "bucket").groupBy("bucket").applyInArrow(meet, FOUND), "hits", "<u8", parts)


def named(places: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Places with 31 bits of the windows' hashes, by which a row sees whether a place is its own or that of another row with its id."""
    return (places.astype(np.int64) | ((hashes & NAME_BITS).astype(np.int64) << 32)).astype("<i8")


WINDOWS = "bucket int, ids binary, hashes binary, places binary"


def windows(marked: DataFrame, size: int, buckets: int) -> DataFrame:
    """Windows around the hits, packed by bucket; those that a document of the same slice settles have no hashes any more."""
    block = (size + 1) // 2

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text.slices(batches, "body", text.LARGE_SLICE):
            words = text.Words(*text.raw(part.column("body")))
            own = words.hashes()
            low = text.window_hashes(own, block) & LOW
            hit = np.zeros(len(own) + 1, bool)
            for k, hits in enumerate(part.column("hits")):
                begin, end = words.docs[k], words.docs[k + 1] - block + 1
                if end > begin:
                    hit[begin:end] = np.isin(low[begin:end], np.frombuffer(hits.as_buffer(), "<u8"))
            total = np.concatenate([[0], np.cumsum(hit)])
            at, owner = text.window_starts(words.docs, size)
            near = total[at + size - block + 1] > total[at]
            at, owner = at[near], owner[near]
            if not len(at):
                continue
            hashes = text.window_hashes(own, size)[at]
            ids, places = part.column("id").to_numpy()[owner], at - words.docs[owner]
            order = np.argsort(hashes, kind="stable")
            hashes, ids, places = hashes[order], ids[order], places[order]
            firsts = runs(hashes)
            smallest = np.repeat(np.minimum.reduceat(ids, firsts), np.diff(np.append(firsts, len(hashes))))
            later = ids > smallest
            own, sure, ends = by_id(ids[later], named(places[later], hashes[later]))
            rows = [(int(i) % buckets, np.array([i]).tobytes(), None, sure[a:b].tobytes()) for i, a, b in zip(own.tolist(), ends[:-1], ends[1:])]
            bucket = ((hashes >> np.uint64(40)) % np.uint64(buckets)).astype(np.int32)
            asked = np.flatnonzero(~later)
            asked = asked[np.argsort(bucket[asked], kind="stable")]
            begins = runs(bucket[asked])
            for a, b in zip(begins.tolist(), [*begins[1:].tolist(), len(asked)]):
                mine = asked[a:b]
                rows.append((int(bucket[mine[0]]), ids[mine].tobytes(), hashes[mine].tobytes(), places[mine].astype("<i4").tobytes()))
            kinds = (pa.int32(), pa.binary(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["bucket", "ids", "hashes", "places"])

    return marked.mapInArrow(text.tidy(cut), WINDOWS)


def repeats(found: DataFrame, parts: int) -> DataFrame:
    """``id, places``: where windows start that a smaller id has too."""

    def meet(table: pa.Table) -> pa.Table:
        ids, hashes, places, sure_ids, sure = [], [], [], [np.zeros(0, np.int64)], [np.zeros(0, "<i8")]
        for own, own_hashes, own_places in zip(*(table.column(c) for c in ("ids", "hashes", "places"))):
            who = np.frombuffer(own.as_buffer(), "<i8")
            if own_hashes.is_valid:
                ids.append(who)
                hashes.append(np.frombuffer(own_hashes.as_buffer(), "<u8"))
                places.append(np.frombuffer(own_places.as_buffer(), "<i4"))
            else:
                sure.append(np.frombuffer(own_places.as_buffer(), "<i8"))
                sure_ids.append(np.repeat(who, len(sure[-1])))
        if ids:
            ids, hashes, places = np.concatenate(ids), np.concatenate(hashes), np.concatenate(places)
            order = np.argsort(hashes, kind="stable")
            ids, hashes, places = ids[order], hashes[order], places[order]
            firsts = runs(hashes)
            later = ids > np.repeat(np.minimum.reduceat(ids, firsts), np.diff(np.append(firsts, len(hashes))))
            sure_ids.append(ids[later])
            sure.append(named(places[later], hashes[later]))
        return handed_on(np.concatenate(sure_ids), np.concatenate(sure), parts)

    return gathered(found.repartitionById(parts, "bucket").groupBy("bucket").applyInArrow(meet, FOUND), "places", "<i8", parts)


def own_starts(body: bytes, found: np.ndarray, size: int) -> np.ndarray:
    """The places at which this text has the windows they were found for."""
    words = text.Words(np.frombuffer(body, np.uint8), np.array([0, len(body)]))
    hashes = text.window_hashes(words.hashes(), size)
    places = found & ((1 << 32) - 1)
    inside = places < len(hashes)
    return np.unique(places[inside][(hashes[places[inside]] & NAME_BITS).astype(np.int64) == found[inside] >> 32])


def without_repeats(docs: DataFrame, size: int = 50, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """All columns of ``docs``, with ``kept`` (bytes: the words that stay, joined by one space), ``n_words`` and ``n_removed``.

    Words are ``[^\\x20\\x09-\\x0D]+``, unchanged. A word goes if a window of ``size`` words that covers it also starts in a document
    with a smaller id; windows are judged on the input. A null or empty text has no words. A row whose id is null is neither searched nor
    changed; rows with one id never take words from each other, and each loses what a smaller id has of its own text. An empty
    table gives an empty result. New columns that clash with columns of ``docs`` take their place.
    """
    spark = docs.sparkSession
    text.prepared(spark)
    docs = docs.drop("kept", "n_words", "n_removed")
    body, key, places, hits = (text.new_name(docs, stem=s) for s in ("body", "key", "places", "hits"))
    buckets = text.parts_for(docs, BUCKET_MB)
    own_id, others = F.col(f"`{id_column}`").cast("bigint"), [c for c in docs.columns if c not in (id_column, text_column)]
    # Both joins take all columns of these rows, so that one shuffle of the texts serves both.
    known = docs.where(own_id.isNotNull())
    source = known.select(own_id.alias("id"), text.utf8(text_column).alias("body"))
    found = anchors(probes(source, size, buckets), buckets).toDF(key, hits)
    marked = known.join(found, own_id == F.col(key)).select(F.col(key).alias("id"), text.utf8(text_column).alias("body"), F.col(hits).alias("hits"), *(F.col(f"`{c}`") for c in others))
    marked = marked.toDF("id", "body", "hits", *(f"unused_{k}" for k in range(len(others))))
    gone = repeats(windows(marked, size, buckets), buckets).toDF(key, places)
    rest = docs.where(own_id.isNull()).withColumn(places, F.lit(None).cast("binary"))
    every = known.join(gone, own_id == F.col(key), "left").drop(key).unionByName(rest)
    kept_names = docs.columns
    every = every.withColumn(body, text.utf8(text_column))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text.slices(batches, body):
            bodies = part.column(body).to_pylist()
            counts, removed, kept = [], [], []
            for own, lost in zip(bodies, part.column(places)):
                words = own.split()
                counts.append(len(words))
                if lost.is_valid:
                    starts = own_starts(own, np.frombuffer(lost.as_buffer(), "<i8"), size)
                    change = np.zeros(len(words) + 1, np.int64)
                    np.add.at(change, starts, 1)
                    np.add.at(change, starts + size, -1)
                    stays = np.cumsum(change[:-1]) == 0
                    words = [w for w, s in zip(words, stays.tolist()) if s]
                removed.append(counts[-1] - len(words))
                kept.append(b" ".join(words))
            new = [pa.array(kept, pa.binary()), pa.array(counts, pa.int64()), pa.array(removed, pa.int64())]
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in kept_names), *new], [*kept_names, "kept", "n_words", "n_removed"])

    schema = T.StructType([*docs.schema.fields, T.StructField("kept", T.BinaryType()), T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType())])
    return every.select(*(F.col(f"`{c}`") for c in kept_names), body, places).mapInArrow(text.tidy(cut), schema)
