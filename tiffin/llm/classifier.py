"""Quality classifier on learned subword embeddings.

A document is the sum of two averages of learned vectors: over its words (with marks for a word that repeats one of the four before it) and over
its character n-grams (of code points), all hashed into fixed tables. A softmax layer on top gives the classes. Vectors and layer are trained together by stochastic
gradient descent in numpy, on a sample of labelled rows of at most ``sample`` per class, chosen by a hash of the id: that is the only bound, and
it concerns the training only. Every document is scored over its whole text, in its own task, without a shuffle.

The layer is linear, so scoring folds it into the tables: one number per bucket and class, averaged over the text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tiffin.llm import text

BITS = 16
GRAMS = (3, 4)
LOOK_BACK = 4
SIZE = 8
MODEL_PARTS = ("vectors", "weights", "bias")


@dataclass
class Model:
    """Vectors of word buckets, then of n-gram buckets; softmax weights and bias."""

    vectors: np.ndarray
    weights: np.ndarray
    bias: np.ndarray

    def folded(self) -> np.ndarray:
        """Logit of class 1 against class 0 per bucket."""
        return (self.vectors @ (self.weights[:, 1] - self.weights[:, 0])).astype(np.float32)


def buckets(data: np.ndarray, offsets: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, int]]:
    """Per kind of feature: bucket of each place, first and last place of each text, and 0 for words or 1 for n-grams.

    Places between the texts' ranges belong to no text.
    """
    words = text.Words(data, offsets)
    own = words.hashes()
    out = [((own >> np.uint64(64 - BITS)).astype(np.int32), words.docs[:-1], words.docs[1:], 0)]
    for back in range(1, LOOK_BACK + 1):
        same = np.zeros(len(own), np.int32)  # bucket 0: no repetition
        same[back:] = np.where(own[back:] == own[:-back], back, 0)
        out.append((same, np.minimum(words.docs[:-1] + back, words.docs[1:]), words.docs[1:], 0))
    letters, ends = code_points(np.where(text.SPACES[data], np.uint8(0x20), data), offsets)
    for size in GRAMS:
        n = max(0, len(letters) - size + 1)
        key = np.full(n, size, dtype=np.uint32)
        for k in range(size):
            key = (key ^ letters[k : k + n]) * np.uint32(0x9E3779B1)
            key ^= key >> np.uint32(15)
        key >>= np.uint32(32 - BITS)
        out.append((key.astype(np.int32) + (1 << BITS), np.minimum(ends[:-1], n), np.minimum(np.maximum(ends[:-1], ends[1:] - size + 1), n), 1))
    return out


def code_points(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The code points of UTF-8 bytes, and the texts' offsets in them."""
    starts = np.flatnonzero((data & 0xC0) != 0x80)
    points = data[starts].astype(np.uint32)
    ends = np.searchsorted(starts, offsets)
    several = np.flatnonzero(points >= 0x80)
    if len(several):
        at, lead = starts[several], points[several]
        tail = [(data[np.minimum(at + k, len(data) - 1)] & 0x3F).astype(np.uint32) for k in (1, 2, 3)]
        two = (lead & 0x1F) << 6 | tail[0]
        three = (lead & 0x0F) << 12 | tail[0] << 6 | tail[1]
        four = (lead & 0x07) << 18 | tail[0] << 12 | tail[1] << 6 | tail[2]
        points[several] = np.where(lead < 0xE0, two, np.where(lead < 0xF0, three, four))
    return points, ends


def counts(parts, k: int) -> list[int]:
    """Places of the words and of the n-grams of text ``k``."""
    total = [0, 0]
    for _, first, last, side in parts:
        total[side] += int(last[k] - first[k])
    return total


def log_odds(data: np.ndarray, offsets: np.ndarray, table: np.ndarray, bias: float) -> np.ndarray:
    """Log-odds of class 1 of each text of a batch."""
    sums, places = np.zeros((2, len(offsets) - 1)), np.zeros((2, len(offsets) - 1))
    for bucket, first, last, side in buckets(data, offsets):
        total = np.concatenate([np.zeros(1), np.cumsum(table[bucket], dtype=np.float64)])
        sums[side] += total[last] - total[first]
        places[side] += last - first
    return (sums / np.maximum(places, 1)).sum(axis=0) + bias


def train(features: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, steps: int = 500, batch: int = 64, rate: float = 0.1, seed: int = 7) -> Model:
    """Stochastic gradient descent over (buckets, weights) of each row; classes are drawn equally often.

    Each bucket's step is divided by the root of its squared gradients so far: buckets differ in frequency by orders of magnitude.
    """
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / SIZE, 1 / SIZE, (2 << BITS, SIZE)).astype(np.float32)
    weights, bias = np.zeros((SIZE, 2), np.float32), np.zeros(2, np.float32)
    weights[:, 1] = rng.uniform(-0.5, 0.5, SIZE)
    weights[:, 0] = -weights[:, 1]
    seen = np.full(len(vectors), 1e-10, np.float32)
    layer = 1e-10
    sides = [np.flatnonzero(labels == c) for c in (0, 1)]
    if not all(len(s) for s in sides):  # one class only: its share is all there is to learn
        bias[int(len(sides[1]) > 0)] = 2.0 if len(labels) else 0.0
        return Model(np.zeros_like(vectors), weights, bias)
    for step in range(steps):
        rows = np.concatenate([rng.choice(s, batch // 2) for s in sides])
        sizes = np.array([len(features[r][0]) for r in rows])
        index = np.concatenate([features[r][0] for r in rows])
        share = np.concatenate([features[r][1] for r in rows])
        owner = np.repeat(np.arange(len(rows)), sizes)
        looked = vectors[index] * share[:, None]
        docs = np.stack([np.bincount(owner, looked[:, d], len(rows)) for d in range(SIZE)], axis=1).astype(np.float32)
        logits = docs @ weights + bias
        odds = np.exp(logits - logits.max(axis=1, keepdims=True))
        odds /= odds.sum(axis=1, keepdims=True)
        odds[np.arange(len(rows)), labels[rows]] -= 1
        odds /= len(rows)
        pace = rate * (1 - step / steps)
        back = odds @ weights.T
        slope, tilt = docs.T @ odds, odds.sum(axis=0)
        layer += float((slope**2).sum() + (tilt**2).sum())
        weights -= pace * slope / np.sqrt(layer)
        bias -= pace * tilt / np.sqrt(layer)
        used, place = np.unique(index, return_inverse=True)
        turn = np.stack([np.bincount(place, share * back[owner, d], len(used)) for d in range(SIZE)], axis=1).astype(np.float32)
        seen[used] += (turn**2).mean(axis=1)
        vectors[used] -= pace * turn / np.sqrt(seen[used])[:, None]
    return Model(vectors, weights, bias)


def fit(docs: DataFrame, labels: DataFrame, training: Column, sample: int = 2000, id_column: str = "doc_id", text_column: str = "text", label_column: str = "quality") -> Model:
    """Train on rows of ``labels`` that satisfy ``training``, at most ``sample`` of each class.

    Several labels of one id count by their mean, an even split as 1; null ids and labels are left out. One task learns from the sampled rows' bucket
    counts; only the model comes to the driver.
    """
    spark = docs.sparkSession
    text.prepared(spark)
    one = labels.where(training).select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{label_column}`").alias("label")).where("id IS NOT NULL AND label IS NOT NULL")
    voted = one.groupBy("id").agg((F.avg("label") >= 0.5).cast("int").alias("label"))
    drawn = None
    for c in (0, 1):
        side = voted.where(F.col("label") == c).orderBy(F.xxhash64("id"), "id").limit(sample)
        drawn = side if drawn is None else drawn.unionAll(side)
    # at most 2 * sample rows; of equal ids in docs one text is enough, the first by its hash
    source = docs.select(F.col(f"`{id_column}`").alias("id"), text.utf8(text_column).alias("body")).join(F.broadcast(drawn), "id")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text.slices(batches, "body"):
            parts = buckets(*text.raw(part.column("body")))
            index, share, ends = [], [], [0]
            for k in range(part.num_rows):
                total = counts(parts, k)
                for side in (0, 1):
                    own = [b[f[k] : z[k]] for b, f, z, s in parts if s == side]
                    used, times = np.unique(np.concatenate(own), return_counts=True)
                    index.append(used)
                    share.append((times / max(total[side], 1)).astype(np.float32))
                ends.append(ends[-1] + len(index[-1]) + len(index[-2]))
            ends = np.array(ends)
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), part.column("label"), text.binary(np.concatenate(index).astype("<i4"), ends * 4), text.binary(np.concatenate(share), ends * 4)],
                ["id", "label", "grams", "share"],
            )

    kind = source.schema["id"].dataType.simpleString()

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [part for part in batches if part.num_rows]
        ids, classes = ([x for part in rows for x in part.column(c).to_pylist()] for c in ("id", "label"))
        grams, weights = ([x.as_buffer() for part in rows for x in part.column(c)] for c in ("grams", "share"))  # no copies
        chosen: dict = {}
        for k, key in enumerate(ids):
            if key not in chosen or grams[k].to_pybytes() < grams[chosen[key]].to_pybytes():
                chosen[key] = k
        order = [chosen[key] for key in sorted(chosen, key=str)]
        features = [(np.frombuffer(grams[k], "<i4"), np.frombuffer(weights[k], "<f4")) for k in order]
        model = train(features, np.array([classes[k] for k in order], dtype=int))
        yield pa.RecordBatch.from_pydict({name: pa.array([getattr(model, name).tobytes()], pa.binary()) for name in MODEL_PARTS})

    # The sample, bounded whatever the input, meets in one task: only the model comes to the driver.
    found = source.mapInArrow(text.tidy(count), f"id {kind}, label int, grams binary, share binary").repartition(1)
    learned = found.mapInArrow(text.tidy(learn), ", ".join(f"{name} binary" for name in MODEL_PARTS)).collect()
    if not learned:  # no rows, no task
        return train([], np.array([], dtype=int))
    vectors, weights, bias = (np.frombuffer(learned[0][name], np.float32) for name in MODEL_PARTS)
    return Model(vectors.reshape(-1, SIZE), weights.reshape(SIZE, 2), bias)


def score(docs: DataFrame, model: Model, output: str = "score", text_column: str = "text") -> DataFrame:
    """All columns of ``docs`` and the probability of class 1. A null or empty text, having no features, gets that of the bias."""
    spark = docs.sparkSession
    text.prepared(spark)
    shared = spark.sparkContext.broadcast((model.folded(), float(model.bias[1] - model.bias[0])))  # 2 << BITS numbers, whatever the input

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, bias = shared.value
        for part in text.slices(batches, text_column):
            odds = log_odds(*text.raw(part.column(text_column)), table, bias)
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(1 / (1 + np.exp(-odds)))], [*part.schema.names, output])

    schema = T.StructType([*docs.schema.fields, T.StructField(output, T.DoubleType())])
    return docs.mapInArrow(text.tidy(rate), schema)


def held_out(id_column: str = "doc_id", folds: int = 5) -> Column:
    """Whether an id belongs to the fold that is kept out of training."""
    return F.coalesce(F.crc32(F.col(f"`{id_column}`").cast("string").cast("binary")) % folds == 0, F.lit(False))


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, sample: int = 2000) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row.

    Null and empty texts get the score of the bias, texts of any length are scored whole; null ids and equal rows stay, each scored by its own text. Other columns
    are left out, whatever their names. An empty table gives an empty result.
    """
    model = fit(docs, labels, ~held_out(), sample)
    scored = score(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
