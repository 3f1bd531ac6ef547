"""Language identification: gradients, the fast reader against the plain one, held-out accuracy and awkward rows."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tests.llm import models
from tiffin.llm import language_id, queries


def test_gradients_through_time():
    rng = np.random.default_rng(0)
    codes = rng.integers(97, 100, (7, 3)).astype(np.intp)
    codes[5:, 2] = language_id.PAD
    n, states = 4, rng.normal(0, 0.5, (4, 12))
    inputs = language_id.held_still(rng.normal(0, 0.5, (257, 12)), n)
    weight = rng.normal(size=(7, 3, n)) * (codes != language_id.PAD)[:, :, None]

    def loss(a, b):
        return float((read64(codes, a, b) * weight).sum())

    def read64(codes, a, b):
        now, out = np.zeros((codes.shape[1], n)), []
        for step in codes:
            into, own = a[step], now @ b
            update, reset = (1 / (1 + np.exp(-into[:, k * n : (k + 1) * n] - own[:, k * n : (k + 1) * n])) for k in range(2))
            fresh = np.tanh(into[:, 2 * n :] + reset * own[:, 2 * n :])
            now = (1 - update) * fresh + update * now
            out.append(now)
        return np.array(out)

    out, kept = language_id.read(codes, inputs, states)
    assert np.allclose(out, read64(codes, inputs, states), atol=1e-6)
    to_inputs, to_states = language_id.read_back(codes, kept, states, weight)
    for grown, at in ((to_inputs, 0), (to_states, 1)):
        places = [(98, 1), (97, 5), (99, 11)] if at == 0 else [(0, 0), (3, 6), (2, 10)]
        for place in places:
            step = np.zeros_like((inputs, states)[at])
            step[place] = 1e-5
            high, low = (loss(inputs + s * step, states) if at == 0 else loss(inputs, states + s * step) for s in (1, -1))
            assert abs((high - low) / 2e-5 - grown[place]) < 1e-3


@pytest.fixture(scope="module")
def model():
    rng = np.random.default_rng(3)
    words = {"aa": ["tha", "ing", "hen"], "bb": ["zeu", "ouk", "lev"], "cc": ["ññ", "qé", "üx"]}
    segments, labels = [], []
    for k, own in enumerate(words.values()):
        for _ in range(60):
            segments.append(" ".join(rng.choice(own, 30)).encode()[: language_id.LENGTH])
            labels.append(k)
    return language_id.train(segments, np.array(labels), list(words), steps=60)


def plain(model, body):
    """Mean probabilities by one text at a time."""
    total = np.zeros(len(model.languages))
    for at in range(0, len(body), language_id.LENGTH):
        codes = np.frombuffer(body[at : at + language_id.LENGTH], np.uint8).astype(np.intp)[:, None]
        ahead, _ = language_id.read(codes, model.inputs[0], model.states[0])
        behind, _ = language_id.read(codes[::-1], model.inputs[1], model.states[1])
        logits = np.concatenate([ahead, behind[::-1]], axis=2)[:, 0] @ model.output + model.bias
        odds = np.exp(logits - logits.max(axis=1, keepdims=True))
        total += (odds / odds.sum(axis=1, keepdims=True)).sum(axis=0)
    return total / max(1, len(body))


def test_reader_equals_plain(model):
    rng = np.random.default_rng(4)
    bodies = [rng.integers(32, 127, size).astype(np.uint8).tobytes() for size in (0, 1, 5, 95, 96, 97, 400, 192, 0, 3)] + ["ññ qé".encode() * 50_000]
    got = language_id.Reader(model).pooled(np.frombuffer(b"".join(bodies), np.uint8), np.cumsum([0, *map(len, bodies)]))
    for own, body in zip(got, bodies[:-1]):
        assert np.allclose(own, plain(model, body), atol=1e-4)
    assert abs(got[-1].sum() - 1) < 1e-6 and got[-1].argmax() == 2


def test_every_position_is_labelled(model):
    body = b"tha ing hen tha ing hen tha ing" + b"zeu ouk lev zeu ouk lev zeu ouk"
    got = language_id.labels_of(model, body)
    assert len(got) == len(body) and got[3:24] == ["aa"] * 21 and got[-24:] == ["bb"] * 24


def test_registered(spark):
    folder = "/root/testdata/sf0.01"
    langs = {r.doc_id: r.lang for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    got = queries.QUERIES["op13_language_id"](spark, folder).collect()
    assert {r.doc_id: r.held_out for r in got} == {i: zlib.crc32(str(i).encode()) % 4 == 2 for i in langs} and len(got) == len(langs)
    assert np.mean([r.lang_pred == langs[r.doc_id] for r in got if r.held_out]) > 0.97
    assert all(0 <= r.score <= 1 for r in got)


def test_awkward_rows(spark):
    docs = [*models.awkward(60), (None, "no id"), (None, None), (20, "same"), (20, "same"), (21, "12 34 !?"), (22, "long é " * 700_000)]
    df = models.table(spark, docs).withColumns({"lang_pred": F.lit(1), "score": F.lit("s"), "label": F.lit("x"), "size": F.lit(0), "body": F.lit(b"b"), "number": F.lit(3)})
    got = language_id.identify(df)
    assert got.columns == ["doc_id", "held_out", "lang_pred", "score"] and got.count() == len(docs)
    lettered = {i: any(c.isalpha() for c in t or "") for i, t in docs if i != 20}
    assert {r.doc_id: r.lang_pred != "und" for r in got.collect() if r.doc_id not in (None, 20)} == {i: v for i, v in lettered.items() if i is not None}
    model = language_id.Model(["en"], *((lambda m: (m.inputs, m.states, m.output, m.bias))(language_id.train([], np.zeros(0, int), ["en"]))))
    wide = language_id.label(df, model)
    assert wide.columns[:5] == df.columns[:5] and {r.lang_pred for r in wide.collect()} == {"en", "und"}
    assert language_id.identify(df.limit(0)).collect() == []
    unlabelled = language_id.identify(df.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {(r.lang_pred, r.score) for r in unlabelled} == {("und", 0.0)}
