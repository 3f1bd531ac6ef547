"""Token counts, token files and BPE against the libraries."""

import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import regex
import tiktoken
from tests.conftest import rows
from tests.llm import models
from tiffin.llm import bpe, pieces, text, token_counts, token_files
from tokenizers import Tokenizer

JSON = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
ROWS = [*models.awkward(40), (None, "no id"), (50, "twice"), (50, "twice")]


def library(value):
    return Tokenizer.from_file(JSON).encode(value or "", add_special_tokens=False).ids


def random_texts(n, seed=3):
    rng = random.Random(seed)
    parts = [*" '\nstmdrevl1!X=\t", "é", "٣", "…", "  ", "'s", "'re", "'ll", "日", "<|endoftext|>", "<|endof", "ÃÂ", "the ", "ing"]
    return ["".join(rng.choice(parts) for _ in range(rng.randint(0, 30))) for _ in range(n)] + ["'r", "'l", "x'", " " * 200 + "x", "a" * 700]


def batch(texts):
    return text.raw(pa.array([t.encode() for t in texts], pa.binary()))


@pytest.mark.parametrize("split", [pieces.by_rule, pieces.by_transducer, lambda c: pieces.by_transducer(c, 5)])
def test_pieces_are_those_of_the_pattern(split):
    texts, pattern = random_texts(3000), regex.compile(public_tokenizers.PATTERN)
    data, offsets = batch(texts)
    bounds, first = pieces.split(data, offsets, split, None)
    whole = data.tobytes()
    got = [[whole[bounds[k] : bounds[k + 1]].decode() for k in range(a, b)] for a, b in zip(first[:-1], first[1:])]
    assert got == [pattern.findall(t) for t in texts]


def test_maps_of_chunks_compose_in_any_grouping():
    rng = np.random.default_rng(1)
    maps = rng.integers(0, pieces.STATES, (37, pieces.STATES)).astype(np.uint8)
    want, now = [], np.arange(pieces.STATES)
    for row in maps:
        now = row[now]
        want.append(now)
    assert (pieces.scan(maps) == np.array(want)).all()


def test_transducer_counts_and_starts_anew_when_full():
    texts = random_texts(400)
    want = [len(library(t)) for t in texts]
    for machine in (token_counts.CountTransducer(JSON), token_counts.CountTransducer(JSON, max_states=50)):
        assert token_counts.piece_counts(*batch(texts), machine, b"<|endoftext|>").tolist() == want


def test_token_counts(spark):
    want = sorted([(i if i is not None else -1, len((t or "").encode()), len(library(t)), len(library(t)) > 1024) for i, t in ROWS])
    for made in (models.table, models.clashing):
        got = token_counts.token_counts(made(spark, ROWS), JSON).collect()
        assert sorted((r.doc_id if r.doc_id is not None else -1, r.n_bytes, r.n_tokens, r.over_limit) for r in got) == want
    assert token_counts.token_counts(models.table(spark, []), JSON).count() == 0


@pytest.mark.parametrize("width", [2, 4])
def test_token_files_read_back_by_key(spark, width):
    want, start = [], 0
    for i, t in sorted(ROWS, key=lambda r: (r[0] is None, r[0] or 0, r[1] or "")):
        ids = [*library(t), 2]
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    got = token_files.token_files(models.clashing(spark, ROWS), JSON, width=width)
    assert sorted((tuple(r) for r in got.select("doc_id", "start", "n_tokens", "ids_crc32").collect()), key=lambda r: r[1]) == want
    assert token_files.token_files(models.table(spark, []), JSON).count() == 0


def test_lookup_finds_only_what_is_there(spark, tmp_path):
    folder = str(tmp_path / "files")
    token_files.write_ids(models.table(spark, ROWS), folder, JSON)
    asked = spark.createDataFrame([(3,), (999,), (None,), (50,)], "k long")
    got = token_files.read_ids(spark, folder, asked).collect()
    assert sorted(r.doc_key for r in got if r.doc_key is not None) == [3, 50, 50] and sum(r.doc_key is None for r in got) == 1
    assert [r.doc_key for r in token_files.read_ids(spark, folder, asked.where("k = 999")).collect()] == []
    assert np.frombuffer([r.ids for r in got if r.doc_key == 3][0], "<u4").tolist() == [*library("one"), 2]


def test_perfect_hash_function_is_minimal():
    keys = np.unique(np.random.default_rng(2).integers(-(1 << 62), 1 << 62, 5000))
    words, before, sizes = token_files.build_function(keys)
    assert sorted(token_files.slots(keys, words, before, sizes).tolist()) == list(range(len(keys)))


@pytest.mark.parametrize("known", [0, 30, 10_000])
def test_bpe_equals_the_library_and_decodes(spark, known):
    ranks = bpe.read_ranks(RANKS)
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = [*ROWS, *enumerate(random_texts(150), 100)]
    want = []
    for i, t in texts:
        ids = own.encode_ordinary(t or "")
        want.append((i, len(ids), models.sha(",".join(map(str, ids))), models.sha(t or "")))
    got = bpe.round_trip(models.clashing(spark, texts), RANKS, known)
    key = lambda r: (r[0] is None, r[0] or 0, r[1:])
    assert sorted(map(tuple, got.collect()), key=key) == sorted(want, key=key)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]


def test_bpe_keeps_columns_and_empty_tables(spark):
    coded = bpe.encode(models.clashing(spark, [(1, "ab cd")]), RANKS, 10)
    assert coded.columns == [*[c for c in models.clashing(spark, []).columns if c != "ids"], "ids"]
    assert bpe.decode(coded, RANKS).first()["decoded"] == b"ab cd"
    assert bpe.round_trip(models.table(spark, []), RANKS, 10).count() == 0


def test_a_text_longer_than_a_slice(spark):
    """One text beyond five megabytes beside short ones, counted, written and read back, encoded and decoded whole."""
    rng = random.Random(12)
    long = " ".join(f"w{rng.randrange(10**6)}" for _ in range(700_000))
    docs = [(1, "short"), (2, long), (3, long[-50:])]
    df = models.table(spark, docs)
    ids = {i: library(t) for i, t in docs}
    counted = token_counts.token_counts(df, JSON).collect()
    assert {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in counted} == {i: (len(t), len(ids[i]), len(ids[i]) > 1024) for i, t in docs}
    read = token_files.token_files(df, JSON).collect()
    assert {r.doc_id: (r.n_tokens, r.ids_crc32) for r in read} == {i: (len(ids[i]) + 1, zlib.crc32(np.array([*ids[i], 2], "<u4").tobytes())) for i, _ in docs}
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})
    got = {r.doc_id: tuple(r)[1:] for r in bpe.round_trip(df, RANKS, known=1000).collect()}
    for i, t in docs:
        want = own.encode_ordinary(t)
        assert got[i] == (len(want), models.sha(",".join(map(str, want))), models.sha(t))


def test_known_words_are_those_before_the_tie_at_the_bound(spark):
    """The bound cuts among words of one count: none of them is taken, and the result does not change."""
    docs = models.table(spark, [(1, "a a a b b c c d"), (2, "a b e f")])
    found = bpe.known_words(docs, bpe.rank_lookup(RANKS), 3, "text")
    assert found.column("word").to_pylist() == [b" b"]  # three times; "a", " a" and " c" come twice each
    results = [sorted(map(tuple, bpe.round_trip(docs, RANKS, known=k).collect())) for k in (0, 1, 3, 100)]
    assert all(r == results[0] for r in results)


def test_rank_table_is_printed_once_by_one_plan(spark):
    docs = models.table(spark, [(k, f"word{k % 7} other{k % 3}") for k in range(60)])
    bus, store = spark.sparkContext._jsc.sc().listenerBus(), spark._jsparkSession.sharedState().statusStore()
    bus.waitUntilEmpty()
    before = store.executionsCount()
    assert bpe.known_words(docs, ranks := bpe.rank_lookup(RANKS), 1000, "text").num_rows == 9
    bus.waitUntilEmpty()
    runs = store.executionsList()
    plans = [runs.apply(k).physicalPlanDescription() for k in range(before, runs.size())]
    large = [p for p in plans if len(p) > 100_000]
    assert len(large) == 1 and "AdaptiveSparkPlan" not in large[0]
    assert len(large[0]) < 1.5 * sum(len(str(m)) for m in ranks.maps)
