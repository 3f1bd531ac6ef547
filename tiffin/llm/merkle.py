"""Merkle manifest of a dataset: a digest per row, a tree per key, and a tree over the keys' roots.

A parent is the SHA-256 of its children's digests. While it takes them in, it copies the hash state before each child: a fold that replaces one
child resumes the copy at that place and takes in the replacement and the siblings to its right, nothing else.

Rows are numbered per key over sorted slices, and ``BLOCK`` consecutive ones are one row of a table, so no task holds more than blocks, however
many rows a key has. A block's root is a leaf of the next round, which makes log_512(rows) rounds. On the way down each block gets the runs of
siblings above it, once for all its rows. Only ids and digests move; texts are read where they lie.
"""

from __future__ import annotations

import string
from collections.abc import Iterator, Sequence
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tiffin.llm import text
from tiffin.operators import windows

FAN = 8
LEVELS = 3
BLOCK = FAN**LEVELS
RUN = "array<struct<slot: int, digests: array<string>>>"


class Parent:
    """A node with the hash states before its children, and what stands to the right of each."""

    __slots__ = ("children", "before", "after", "digest")

    def __init__(self, children: Sequence[bytes]):
        state, self.children, self.before, self.after = sha256(), children, [], []
        for k, child in enumerate(children):
            self.before.append(state.copy())
            self.after.append(b"".join(children[k + 1 :]))
            state.update(child)
        self.digest = state.hexdigest().encode()

    def fold(self, slot: int, child: bytes) -> bytes:
        """The digest this node has with another child at ``slot``."""
        state = self.before[slot].copy()
        state.update(child)
        state.update(self.after[slot])
        return state.hexdigest().encode()

    def siblings(self, slot: int) -> bytes:
        return b"".join(self.children[:slot]) + self.after[slot]


def height(total: int) -> int:
    """Levels above the nodes of a block, when its key has ``total`` nodes: all of a block's if there are more blocks."""
    levels = 0
    while levels < LEVELS and FAN**levels < total:
        levels += 1
    return levels


def grown(digests: Sequence[bytes], total: int) -> tuple[list[list[Parent]], bytes]:
    """The parents above a block's nodes, level by level, and its root."""
    levels, nodes = [], list(digests)
    for _ in range(height(total)):
        levels.append([Parent(nodes[k : k + FAN]) for k in range(0, len(nodes), FAN)])
        nodes = [p.digest for p in levels[-1]]
    return levels, nodes[0]


def numbered(nodes: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Adds ``place`` from 0 and ``total`` within the key; nulls come first. The order goes over slices, so a key may have any number of rows."""
    rows = windows.ordered(nodes, key, [F.col(c) for c in order]).withColumn("_slice", F.shiftright("_pos", windows.SLICE_BITS))
    counts = rows.groupBy("_slice", *key).agg(F.count(F.lit(1)).alias("_n"), F.min("_pos").alias("_first"))
    own = Window.partitionBy(*key)  # a key has at most one row per slice here
    earlier = own.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("_slice", *key, "_first", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"), F.sum("_n").over(own).alias("total"))
    placed = windows.join_beside(rows, counts, ["_slice", *key])
    return placed.withColumn("place", F.col("_before") + F.col("_pos") - F.col("_first")).drop("_slice", "_pos", "_first", "_before")


def in_blocks(nodes: DataFrame, key: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """``key, block, total, members``, with the root of each block: at most ``BLOCK`` members in order of their place. Written once."""
    block = F.floor(F.col("place") / BLOCK).cast("bigint").alias("block")
    packed = nodes.groupBy(*key, block).agg(F.max("total").alias("total"), F.sort_array(F.collect_list(F.struct("place", *columns))).alias("members"))

    def root(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests, totals = batch.column("digests").to_pylist(), batch.column("total").to_pylist()
            tops = [grown([d.encode() for d in own], total)[1].decode() for own, total in zip(digests, totals)]
            yield batch.append_column("digest", pa.array(tops, pa.string()))

    wide = packed.withColumn("digests", F.transform("members", lambda m: m["digest"]))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in wide.schema.fields)
    return text.durable(wide.mapInArrow(root, f"{kinds}, digest string").drop("digests"), "blocks")


def paths(nodes: DataFrame, key: Sequence[str]) -> DataFrame:
    """``key, place, path, top`` of each node: the runs above it from low to high with its slot in each, and the root of its key's tree.

    ``nodes`` has ``key, place, total, digest``.
    """
    rounds, rest = [], nodes
    while (rest.agg(F.max("total")).first()[0] or 0) > 1:
        rounds.append(in_blocks(rest, key, ["digest"]))
        rest = rounds[-1].select(*key, F.col("block").alias("place"), F.ceil(F.col("total") / BLOCK).cast("bigint").alias("total"), "digest")

    def down(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for digests, total, path in zip(*(batch.column(c).to_pylist() for c in ("digests", "total", "path"))):
                levels, _ = grown([d.encode() for d in digests], total)
                own = []
                for k in range(len(digests)):
                    steps = [((k // FAN**n) % FAN, parents[k // FAN ** (n + 1)]) for n, parents in enumerate(levels)]
                    own.append([{"slot": slot, "digests": [c.decode() for c in parent.children]} for slot, parent in steps] + path)
                out.append(own)
            yield batch.append_column("paths", pa.array(out, pa.list_(pa.list_(pa.struct([("slot", pa.int32()), ("digests", pa.list_(pa.string()))])))))

    found = rest.select(*key, "place", F.array().cast(RUN).alias("path"), F.col("digest").alias("top"))
    for blocks in reversed(rounds):
        above = windows.join_beside(blocks.drop("digest"), found.withColumnRenamed("place", "block"), [*key, "block"])
        wide = above.select(*key, "total", "path", "top", F.transform("members", lambda m: m["place"]).alias("places"), F.transform("members", lambda m: m["digest"]).alias("digests"))
        kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in wide.schema.fields)
        each = wide.mapInArrow(down, f"{kinds}, paths array<{RUN}>").select(*key, "top", F.explode(F.arrays_zip("places", "paths")).alias("own"))
        found = text.durable(each.select(*key, F.col("own.places").alias("place"), F.col("own.paths").alias("path"), "top"), "paths")
    return found


def written(value: Column) -> Column:
    """A field as it enters a leaf: its length in bytes, a colon and the value; ``-`` if null."""
    plain = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(plain).cast("string"), F.lit(":"), plain), F.lit("-"))


def leaf(fields: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*[written(f) for f in fields]), 256)


def proofs(leaves: DataFrame) -> DataFrame:
    """``key, id, leaf, subroot, root, proof_sha256, folded_root, verified`` of a table ``key, id, leaf, replaced``.

    ``replaced`` is a leaf found later for the same row, null if it is the same. Leaves of a key ascend by id (nulls first), then digest; equal rows are
    leaves of their own. Keys ascend, null first; null is a key. The folded root starts from the replacement and uses the original siblings only.
    No rows give no rows.
    """
    placed = numbered(leaves, ["key"], ["id", "leaf"]).withColumnRenamed("leaf", "digest")
    blocks = in_blocks(placed, ["key"], ["id", "digest", "replaced"])
    up = blocks.select("key", F.col("block").alias("place"), F.ceil(F.col("total") / BLOCK).cast("bigint").alias("total"), "digest")
    of_block = paths(up, ["key"])
    subroots = of_block.where("place = 0").select(F.col("key").alias("name"), F.col("top").alias("digest"))  # one row per key
    forest = numbered(subroots, [], ["name"])
    named = forest.select("name", "place", "total", "digest")
    to_root = windows.join_beside(named.select("name", "place"), paths(named.select("place", "total", "digest"), []), ["place"])
    above = windows.join_beside(
        of_block.withColumnsRenamed({"place": "block", "top": "subroot"}),
        to_root.select(F.col("name").alias("key"), F.col("path").alias("last"), F.col("top").alias("root")), ["key"],
    )
    whole = windows.join_beside(blocks.drop("digest"), above, ["key", "block"])
    wide = whole.select("key", "subroot", "root", "total", F.concat("path", "last").alias("path"), "members")

    def prove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n, (members, total, path) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("members", "total", "path")))):
                levels, _ = grown([m["digest"].encode() for m in members], total)
                higher = [(step["slot"], Parent([d.encode() for d in step["digests"]])) for step in path]
                beside = b"".join(parent.siblings(slot) for slot, parent in higher)
                proof, folded = [], []
                for k, member in enumerate(members):
                    node, seen = (member["replaced"] or member["digest"]).encode(), []
                    for parents in levels:
                        parent, slot = parents[k // FAN], k % FAN
                        seen.append(parent.siblings(slot))
                        node, k = parent.fold(slot, node), k // FAN
                    for slot, parent in higher:
                        node = parent.fold(slot, node)
                    proof.append(sha256(b"".join(seen) + beside).hexdigest())
                    folded.append(node.decode())
                one = batch.slice(n, 1)
                same = {c: pa.repeat(one.column(c)[0], len(members)) for c in ("key", "subroot", "root")}
                own = one.column("members").flatten()
                yield pa.RecordBatch.from_arrays(
                    [*same.values(), own.field("id"), own.field("digest"), pa.array(proof, pa.string()), pa.array(folded, pa.string())],
                    [*same, "id", "leaf", "proof_sha256", "folded_root"],
                )

    kinds = {f.name: f.dataType.simpleString() for f in leaves.schema.fields}
    schema = f"key {kinds['key']}, subroot string, root string, id {kinds['id']}, leaf string, proof_sha256 string, folded_root string"
    return wide.mapInArrow(prove, schema).withColumn("verified", F.col("folded_root") == F.col("root"))


def lower_ascii(value: Column) -> Column:
    return F.translate(value, string.ascii_uppercase, string.ascii_lowercase)


def tampered(id_column: str = "doc_id", every: int = 3) -> Column:
    """Rows whose id's crc32 is a multiple of ``every``; never those without an id."""
    return F.coalesce(F.crc32(F.col(f"`{id_column}`").cast("string").cast("binary")) % every == 0, F.lit(False))


def manifest(docs: DataFrame) -> DataFrame:
    """``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified`` of documents, with some texts lower-cased after the manifest was made.

    Leaves hold doc_id, source, lang, n_chars and text, ``-`` for a null and ``0:`` for an empty text; a text of any length is hashed whole where it
    lies. Trees are per lang. Other columns are left out, whatever their names. No rows give no rows.
    """
    text.prepared(docs.sparkSession)

    def fields(body: Column) -> list[Column]:
        return [F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), body]

    later = F.when(tampered(), leaf(fields(lower_ascii(F.col("text")))))
    leaves = docs.select(F.col("lang").alias("key"), F.col("doc_id").alias("id"), leaf(fields(F.col("text"))).alias("leaf"), later.alias("replaced"))
    found = proofs(text.durable(leaves, "leaves"))  # finding the ranges to sort by reads the table once more: digests, not texts
    return found.select(F.col("id").alias("doc_id"), "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
