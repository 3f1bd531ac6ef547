"""Registered queries on the smallest tables against plain Python, and the pipeline stage by stage."""

import hashlib
import zlib

import corpus_pipeline
import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tests.conftest import SMALL
from tests.llm import models
from tiffin.llm import bpe, queries
from tokenizers import Tokenizer

NAMES = [
    "op1_token_counts", "op2_quality_rules", "op3_token_files", "op4_near_duplicates", "op5_byte_bpe", "op6_chat_format", "op7_url_filter",
    "op8_quality_classifier", "op9_decontaminate", "op10_substring_dedup", "op11_merkle_manifest", "op12_conversation_repair", "op13_language_id",
]


@pytest.fixture(scope="module")
def docs(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").orderBy("doc_id").collect()]


def run(spark, name):
    return queries.QUERIES[name](spark, SMALL).collect()


def test_names():
    assert sorted(queries.QUERIES) == sorted(NAMES) and set(queries.ORACLES) == {"op6_chat_format", "op7_url_filter"}


def test_tokens(spark, docs):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = {i: library.encode(t or "", add_special_tokens=False).ids for i, t in docs}
    assert {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in run(spark, "op1_token_counts")} == {
        i: (len((t or "").encode()), len(ids[i]), len(ids[i]) > 1024) for i, t in docs
    }
    want, start = {}, 0
    for i, _ in docs:
        own = [*ids[i], 2]
        want[i] = (start, len(own), zlib.crc32(np.array(own, "<u4").tobytes()))
        start += len(own)
    assert {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in run(spark, "op3_token_files")} == want


def test_bpe(spark, docs):
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")), special_tokens={})
    ids = {i: own.encode_ordinary(t or "") for i, t in docs}
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in run(spark, "op5_byte_bpe")} == {
        i: (len(ids[i]), models.sha(",".join(map(str, ids[i]))), models.sha(t or "")) for i, t in docs
    }


def test_duplicates_and_passages(spark, docs):
    want = models.linked(docs, 4)
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in run(spark, "op4_near_duplicates")} == {i: (*w, i == w[1]) for i, w in want.items()}
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in run(spark, "op10_substring_dedup")} == {
        i: (n, gone, hashlib.sha256(kept).hexdigest()) for i, (n, gone, kept) in models.without_repeats(docs, 50).items()
    }


def test_leaks(spark, docs):
    items = [tuple(r) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    assert {(r.doc_id, r.item_id) for r in run(spark, "op9_decontaminate")} == set(models.leaking(docs, items))


def test_quality(spark, docs):
    got = run(spark, "op8_quality_classifier")
    assert {r.doc_id: r.held_out for r in got} == {i: zlib.crc32(str(i).encode()) % 5 == 0 for i, _ in docs}
    larger = "/root/testdata/sf0.01"  # the smallest tables have under twenty held-out labels
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{larger}/labels.parquet").collect()}
    scored = queries.QUERIES["op8_quality_classifier"](spark, larger).collect()
    assert np.mean([r.predicted == labels[r.doc_id] for r in scored if r.doc_id in labels and r.held_out]) > 0.97
    assert {r.doc_id: (r.n_words, r.n_repeat_words) for r in run(spark, "op2_quality_rules")} == {i: models.figures(t)[::4] for i, t in docs}


def test_pipeline_stage_by_stage(spark, docs, tmp_path):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_classifier", "near_duplicates", "substring_dedup", "decontamination", "byte_bpe"]
    now = spark.read.parquet(f"{SMALL}/documents.parquet")
    first, texts = now.columns, dict(docs)
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, now, SMALL).write.parquet(str(tmp_path / str(k)))
        now = spark.read.parquet(str(tmp_path / str(k)))
        assert now.columns[: len(first)] == first
        got = {r.doc_id: r.text for r in now.collect()}
        if name == "quality_classifier":
            wanted = {r.doc_id: texts[r.doc_id] for r in queries.QUERIES["op8_quality_classifier"](spark, SMALL).collect() if r.predicted}
        elif name == "near_duplicates":
            linked = models.linked(list(texts.items()), 5)
            wanted = {i: t for i, t in texts.items() if linked[i][1] == i}
        elif name == "substring_dedup":
            cut = models.without_repeats(list(texts.items()), 50)
            wanted = {i: cut[i][2].decode() if cut[i][1] else t for i, t in texts.items()}
        elif name == "decontamination":
            items = [tuple(r) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").select("item_id", "text").collect()]
            bad = {i for i, _ in models.leaking(list(texts.items()), items)}
            wanted = {i: t for i, t in texts.items() if i not in bad}
        else:
            wanted = texts
            assert all(r.decoded_sha256 == models.sha(r.text or "") and r.n_tokens == (r.ids.count(",") + 1 if r.ids else 0) for r in now.collect())
        assert got == wanted, name
        texts = got
    assert {r.doc_id for r in corpus_pipeline.run(spark, SMALL).select("doc_id").collect()} == set(texts)


def test_pipeline_of_awkward_rows(spark, tmp_path):
    docs = models.table(spark, [*models.awkward(40), (None, "no id"), (None, None), (20, "same id"), (20, "same id")])
    rows = models.awkward(40)
    labels = spark.createDataFrame([(i, int(i % 5 > 0), 0) for i, _ in rows], "doc_id long, quality int, toxic int")
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, None), (2, "no such words")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    for name, stage in corpus_pipeline.STAGES:
        for source in (docs, docs.limit(0)):
            out = stage(spark, source, str(tmp_path))
            assert out.columns[:5] == docs.columns, name
            assert out.count() <= source.count() and (name in ("quality_classifier", "near_duplicates") or out.count() == source.count())
    kept = corpus_pipeline.one_of_a_kind(spark, docs, str(tmp_path)).collect()
    assert len([r for r in kept if r.doc_id is None]) == 2
    named = [(r.doc_id, r.text) for r in kept if r.doc_id is not None]
    assert len(set(named)) == len(named) and [t for i, t in named if i == 20 and t == "same id"] == ["same id"] and len([i for i, _ in named if i == 20]) == 2


def test_rows_of_one_id_with_different_texts_stay(spark, tmp_path):
    """(1, A), (2, A), (2, B): the copy links both rows of id 2 to id 1; of two rows equal in id and text one stays, whatever the task."""
    a, b = (" ".join(f"{x}{k}" for k in range(60)) for x in "ab")
    rows = [(1, a, "en", "s", 1), (3, b, "en", "t", 1), (3, b, "de", "s", 1), (3, "other words entirely of the same id", "en", "s", 1)]
    for order in (rows, rows[::-1]):
        kept = corpus_pipeline.one_of_a_kind(spark, spark.createDataFrame(order, models.DOCS).repartition(3), str(tmp_path)).collect()
        assert sorted((r.doc_id, r.text, r.lang) for r in kept) == sorted([(1, a, "en"), (3, b, "de"), (3, rows[3][1], "en")])
