"""Merkle manifest against a plain tree."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F
from tests.llm import models
from tiffin.llm import merkle, queries


def h(value):
    return hashlib.sha256(value.encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf_of(row, text):
    return h("".join(map(field, (row["doc_id"], row["source"], row["lang"], row["n_chars"], text))))


def tree(leaves):
    levels = [list(leaves)]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([h("".join(below[k : k + 8])) for k in range(0, len(below), 8)])
    return levels


def above(levels, k, node):
    """Siblings from the leaf to the top, and the top with ``node`` in place."""
    seen = []
    for level in levels[:-1]:
        first = k - k % 8
        run = level[first : first + 8]
        seen += [d for j, d in enumerate(run) if j != k % 8]
        run[k % 8] = node
        node, k = h("".join(run)), k // 8
    return seen, node


def manifest(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r["lang"], []).append(r)
    trees, names = {}, sorted(groups, key=lambda n: (n is not None, (n or "").encode()))
    for name, own in groups.items():
        own.sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf_of(r, r["text"])))
        trees[name] = tree([leaf_of(r, r["text"]) for r in own])
    top = tree([trees[n][-1][0] for n in names])
    out = []
    for n, name in enumerate(names):
        for k, r in enumerate(groups[name]):
            hit = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 0 and r["text"] is not None
            text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in r["text"]) if hit else r["text"]
            seen, node = above(trees[name], k, leaf_of(r, text))
            more, root = above(top, n, node)
            out.append((r["doc_id"], trees[name][0][k], trees[name][-1][0], top[-1][0], h("".join(seen + more)), root, root == top[-1][0]))
    return out


def key(row):
    return tuple((x is not None, x) for x in row)


def check(spark, df):
    got = [tuple(r) for r in merkle.manifest(df).collect()]
    assert sorted(got, key=key) == sorted(manifest([r.asDict() for r in df.collect()]), key=key)
    return got


def test_registered(spark):
    folder = "/root/testdata/sf0.01"
    got = [tuple(r) for r in queries.QUERIES["op11_merkle_manifest"](spark, folder).collect()]
    want = manifest([r.asDict() for r in spark.read.parquet(f"{folder}/documents.parquet").collect()])
    assert sorted(got) == sorted(want) and {r[6] for r in got} == {True, False}


@pytest.mark.parametrize("n", [1, 8, 65, 513, 4097])
def test_sizes(spark, n):
    rows = [(i * 3, "T" * (i % 3), "en", "s", i) for i in range(n)]
    check(spark, spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"))


def test_many_languages_and_a_long_text(spark):
    rows = [(i, "Ab", f"l{i % 1000:03}", "s", 2) for i in range(1500)] + [(3, "Long é " * 900_000, "l000", None, None)]
    check(spark, spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"))


def test_awkward_rows(spark):
    docs = [*models.awkward(60), (None, "No id"), (None, None), (20, "Same"), (20, "Same"), (20, "Other"), (21, "")]
    df = models.table(spark, docs).withColumns({"leaf": F.lit("x"), "place": F.lit(1), "key": F.lit("k"), "total": F.lit(2), "root": F.lit(None).cast("string")})
    got = check(spark, df)
    assert len(got) == len(docs) and len({r[3] for r in got}) == 1
    assert check(spark, df.limit(0)) == []


def test_states_resume():
    children = [h(str(k)).encode() for k in range(8)]
    parent = merkle.Parent(children)
    for k in range(8):
        assert parent.fold(k, children[k]) == parent.digest
        assert parent.fold(k, b"x" * 64) == h((b"".join(children[:k]) + b"x" * 64 + b"".join(children[k + 1 :])).decode()).encode()
