"""Language identification by a bidirectional gated recurrent network over bytes.

A text is cut in segments of ``LENGTH`` bytes. Over each, one gated recurrent unit reads forwards and one backwards, and a softmax over both
states labels every byte. A text's probabilities are the means over all its bytes, so whole texts count, however long. The network is trained in numpy
by backpropagation through time, on segments of a bounded sample of labelled documents: at most ``sample`` documents per language and ``pieces``
segments of each. That is the only bound, and it concerns the training only. Documents are labelled where they lie, without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tiffin.llm import text

LENGTH = 96  # bytes of a segment
PAD = 256  # behind the end of a text: leaves the state as it is
STATES = 12  # of each direction
SHORTEST = 6  # bytes; half of the training segments are cut to some length from here, so that short texts are learned, too
SEGMENTS = 2048  # worked on at a time
UNDETERMINED = "und"


@dataclass
class Model:
    """Languages, and for each direction the inputs' (257 x 3 states) and the states' weights, for gates update, reset and candidate; output layer and bias."""

    languages: list
    inputs: list[np.ndarray]
    states: list[np.ndarray]
    output: np.ndarray
    bias: np.ndarray


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 + 0.5 * np.tanh(0.5 * x)


def read(codes: np.ndarray, inputs: np.ndarray, states: np.ndarray) -> tuple[np.ndarray, list[tuple]]:
    """States after each of the given bytes (steps x segments), and what the way back needs."""
    n = states.shape[0]
    now, out, kept = np.zeros((codes.shape[1], n), np.float32), [], []
    for step in codes:
        into, own = inputs[step], now @ states
        update, reset = sigmoid(into[:, :n] + own[:, :n]), sigmoid(into[:, n : 2 * n] + own[:, n : 2 * n])
        fresh = np.tanh(into[:, 2 * n :] + reset * own[:, 2 * n :])
        kept.append((now, update, reset, fresh, own[:, 2 * n :]))
        now = fresh + update * (now - fresh)
        out.append(now)
    return np.array(out), kept


def read_back(codes: np.ndarray, kept: list[tuple], states: np.ndarray, slopes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradients of the inputs' and the states' weights through time, from those of the states after each step."""
    n = states.shape[0]
    to_states, to_inputs, back = np.zeros_like(states), np.empty((*codes.shape, 3 * n), np.float32), 0
    for t in range(len(codes) - 1, -1, -1):
        before, update, reset, fresh, own = kept[t]
        slope = slopes[t] + back
        candidate = slope * (1 - update) * (1 - fresh * fresh)
        gates = np.concatenate([slope * (before - fresh) * update * (1 - update), candidate * own * reset * (1 - reset), candidate], axis=1)
        to_inputs[t] = gates
        gates[:, 2 * n :] *= reset
        to_states += before.T @ gates
        back = slope * update + gates @ states.T
    flat = codes.ravel()
    order = np.argsort(flat, kind="stable")
    firsts = np.flatnonzero(np.diff(flat[order], prepend=-1))
    grown = np.zeros((PAD + 1, 3 * n), np.float32)
    grown[flat[order][firsts]] = np.add.reduceat(to_inputs.reshape(-1, 3 * n)[order], firsts)
    grown[PAD] = 0
    return grown, to_states


def held_still(inputs: np.ndarray, n: int) -> np.ndarray:
    """The padding's row: its update gate keeps the state."""
    inputs[PAD] = 0
    inputs[PAD, :n] = 40
    return inputs


def train(segments: list[bytes], labels: np.ndarray, languages: list, steps: int = 400, batch: int = 64, rate: float = 0.02, seed: int = 7) -> Model:
    """Stochastic gradient descent with adaptive steps; languages are drawn equally often. Every byte of a segment has its document's label."""
    rng, n, kinds = np.random.default_rng(seed), STATES, len(languages)
    weights = [
        *(held_still(rng.normal(0, 0.3, (PAD + 1, 3 * n)).astype(np.float32), n) for _ in range(2)),
        *(np.concatenate([np.linalg.qr(rng.normal(size=(n, n)))[0] for _ in range(3)], axis=1).astype(np.float32) for _ in range(2)),
        rng.normal(0, 0.3, (2 * n, kinds)).astype(np.float32), np.zeros(kinds, np.float32),
    ]
    if not segments or kinds < 2:
        return Model(languages, weights[:2], weights[2:4], weights[4], weights[5])
    codes = np.full((len(segments), LENGTH), PAD, dtype=np.intp)
    for k, segment in enumerate(segments):
        codes[k, : len(segment)] = np.frombuffer(segment, np.uint8)
    sides = [np.flatnonzero(labels == c) for c in range(kinds)]
    sides = [s for s in sides if len(s)]
    means, squares = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    for step in range(1, steps + 1):
        rows = np.array([rng.choice(sides[k % len(sides)]) for k in range(batch)])
        own = np.ascontiguousarray(codes[rows].T)
        own[:, : batch // 2][np.arange(LENGTH)[:, None] >= rng.integers(SHORTEST, LENGTH, batch // 2)] = PAD
        own = own[: max(1, int((own != PAD).any(axis=1).sum()))]
        ahead, kept_ahead = read(own, weights[0], weights[2])
        behind, kept_behind = read(own[::-1], weights[1], weights[3])
        both = np.concatenate([ahead, behind[::-1]], axis=2)
        logits = both @ weights[4] + weights[5]
        odds = np.exp(logits - logits.max(axis=2, keepdims=True))
        odds /= odds.sum(axis=2, keepdims=True)
        odds[:, np.arange(batch), labels[rows]] -= 1
        odds *= (own != PAD)[:, :, None] / max(1, int((own != PAD).sum()))
        slopes = odds @ weights[4].T
        ahead_in, ahead_own = read_back(own, kept_ahead, weights[2], slopes[:, :, :n])
        behind_in, behind_own = read_back(own[::-1], kept_behind, weights[3], slopes[::-1, :, n:])
        grown = [ahead_in, behind_in, ahead_own, behind_own, np.tensordot(both, odds, axes=([0, 1], [0, 1])), odds.sum(axis=(0, 1))]
        size = np.sqrt(sum(float((g * g).sum()) for g in grown))
        pace = rate * (1 - step / (steps + 1))
        for k, slope in enumerate(grown):
            slope = slope * min(1.0, 1.0 / max(size, 1e-9))
            means[k] = 0.9 * means[k] + 0.1 * slope
            squares[k] = 0.99 * squares[k] + 0.01 * slope * slope
            weights[k] = (weights[k] - pace * (means[k] / (1 - 0.9**step)) / (np.sqrt(squares[k] / (1 - 0.99**step)) + 1e-6)).astype(np.float32)
    return Model(languages, weights[:2], weights[2:4], weights[4], weights[5])


class Reader:
    """The trained network, laid out for labelling: one contiguous table per gate, scaled so that every gate is one tanh."""

    def __init__(self, model: Model):
        n = STATES
        self.kinds, self.bias, self.sides = len(model.languages), model.bias, []
        for side in range(2):
            inputs, states = model.inputs[side], model.states[side]
            half = [np.ascontiguousarray(inputs[:, k * n : (k + 1) * n] * scale) for k, scale in enumerate((0.5, 0.5, 1))]
            own = [np.ascontiguousarray(states[:, k * n : (k + 1) * n] * 0.5) for k in range(3)]
            self.sides.append((half, own, np.ascontiguousarray(model.output[side * n : (side + 1) * n])))

    def logits(self, codes: np.ndarray, side: int) -> Iterator[np.ndarray]:
        """What one direction adds to the logits of each step."""
        (to_update, to_reset, to_fresh), (own_update, own_reset, own_fresh), output = self.sides[side]
        shape = (codes.shape[1], STATES)
        now, update, reset, fresh, spare = (np.zeros(shape, np.float32) for _ in range(5))
        for step in codes:
            np.take(to_update, step, axis=0, out=update, mode="clip")
            np.take(to_reset, step, axis=0, out=reset, mode="clip")
            np.take(to_fresh, step, axis=0, out=fresh, mode="clip")
            update += np.matmul(now, own_update, out=spare)
            np.tanh(update, out=update)
            reset += np.matmul(now, own_reset, out=spare)
            np.tanh(reset, out=reset)
            reset += 1
            reset *= np.matmul(now, own_fresh, out=spare)  # own weights are halved
            fresh += reset
            np.tanh(fresh, out=fresh)
            now -= fresh
            update += 1
            update *= 0.5
            now *= update
            now += fresh
            yield now @ output

    def positions(self, codes: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """Probabilities of the languages at each step (from the last to the first) of segments (steps x segments)."""
        ahead = list(self.logits(codes, 0))
        for back, behind in enumerate(self.logits(codes[::-1], 1)):
            at = len(codes) - 1 - back
            behind += ahead[at]
            behind += self.bias
            behind -= behind.max(axis=1, keepdims=True)
            np.exp(behind, out=behind)
            behind /= behind.sum(axis=1, keepdims=True)
            yield at, behind

    def pooled(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Mean probabilities of each text of a batch; zeros for one without bytes."""
        sizes = np.diff(offsets)
        counts = -(-sizes // LENGTH)
        owner = np.repeat(np.arange(len(sizes)), counts)
        starts = offsets[:-1][owner] + (np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)) * LENGTH
        left = np.minimum(offsets[1:][owner] - starts, LENGTH)
        order = np.argsort(-left, kind="stable")  # short ends come together
        total = np.zeros((len(sizes), self.kinds))
        for at in range(0, len(order), SEGMENTS):
            mine = order[at : at + SEGMENTS]
            steps = np.arange(int(left[mine].max()))[:, None]
            inside = steps < left[mine]
            codes = np.where(inside, data[np.minimum(starts[mine] + steps, len(data) - 1)].astype(np.intp), PAD)
            sums = np.zeros((len(mine), self.kinds))
            for step, odds in self.positions(codes):
                sums += odds if inside[step, -1] else odds * inside[step][:, None]
            for k in range(self.kinds):
                total[:, k] += np.bincount(owner[mine], sums[:, k], len(sizes))
        return total / np.maximum(sizes, 1)[:, None]


def labels_of(model: Model, body: bytes) -> list:
    """The most probable language at each byte of a text."""
    reader, out = Reader(model), []
    for at in range(0, len(body), LENGTH):
        codes = np.frombuffer(body[at : at + LENGTH], np.uint8).astype(np.intp)[:, None]
        own = dict(reader.positions(codes))
        out += [model.languages[int(own[k][0].argmax())] for k in range(len(codes))]
    return out


def has_letter(column: str) -> Column:
    return F.coalesce(F.col(f"`{column}`").rlike("\\p{L}"), F.lit(False))


def fit(
    docs: DataFrame, training: Column, sample: int = 400, pieces: int = 4, id_column: str = "doc_id", text_column: str = "text", label_column: str = "lang"
) -> Model:
    """Train on documents that satisfy ``training`` and have an id, a label and a letter, at most ``sample`` per language, chosen by a hash of the id.

    The languages learned are all that such documents have. Of each sampled document ``pieces`` segments come to the driver, from places all over the
    text, never whole texts.
    """
    text.prepared(docs.sparkSession)
    known = docs.where(training & has_letter(text_column)).select(
        F.col(f"`{id_column}`").alias("id"), F.col(f"`{label_column}`").alias("label"), F.col(f"`{text_column}`").alias("body")
    ).where("id IS NOT NULL AND label IS NOT NULL")
    sizes = known.groupBy("label").agg(F.count(F.lit(1)).alias("size"))
    # Twice the sample by the hash alone, so that the exact choice sees few rows whatever the number of partitions.
    draw = F.pmod(F.xxhash64("id"), F.lit(1 << 30)) / F.lit(1 << 30)
    # One row per language, as many as the network gets outputs.
    drawn = known.join(F.broadcast(sizes), "label").where(draw * F.col("size") < 2 * sample).select("id", "label", F.col("body").cast("binary").alias("body"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text.slices(batches, "body"):
            data, offsets = text.raw(part.column("body"))
            found = []
            for key, begin, end in zip(part.column("id").to_pylist(), offsets[:-1].tolist(), offsets[1:].tolist()):
                last = max(0, end - begin - LENGTH)
                places = sorted({crc32(f"{key}/{k}".encode()) % (last + 1) for k in range(pieces)})
                found.append([data[begin + p : min(end, begin + p + LENGTH)].tobytes() for p in places])
            yield pa.RecordBatch.from_arrays([part.column("id"), part.column("label"), pa.array(found, pa.list_(pa.binary()))], ["id", "label", "segments"])

    kinds = {f.name: f.dataType.simpleString() for f in drawn.schema.fields}
    rows = drawn.mapInArrow(text.tidy(cut), f"id {kinds['id']}, label {kinds['label']}, segments array<binary>")
    first = Window.partitionBy("label").orderBy(F.xxhash64("id"), "id", "segments")
    chosen = rows.withColumn("number", F.row_number().over(first)).where(F.col("number") <= sample).select("label", F.explode("segments").alias("segment"))
    found = sorted((r.label, bytes(r.segment)) for r in chosen.toLocalIterator())
    languages = sorted({label for label, _ in found})
    numbers = {label: k for k, label in enumerate(languages)}
    model = train([s for _, s in found], np.array([numbers[label] for label, _ in found], dtype=int), languages)
    text.released()
    return model


def label(docs: DataFrame, model: Model, text_column: str = "text", language: str = "lang_pred", score: str = "score") -> DataFrame:
    """All columns of ``docs``, the most probable language and its mean probability over all bytes.

    A text that is null or has no letter gets ``und`` and 0, as does every text when no language was learned. New columns that clash with
    columns of ``docs`` take their place. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    text.prepared(spark)
    docs = docs.drop(language, score)
    shared = spark.sparkContext.broadcast(model)  # 2 * 257 * 3 * STATES numbers and a few per language
    kind = docs.schema[text_column].dataType

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, names = Reader(shared.value), pa.array(shared.value.languages, pa.string())
        for part in text.slices(batches, text_column):
            odds = reader.pooled(*text.raw(part.column(text_column)))
            best = odds.argmax(axis=1)
            new = [names.take(pa.array(best)), pa.array(odds[np.arange(len(best)), best])]
            yield pa.RecordBatch.from_arrays([*part.columns, *new], [*part.schema.names, language, score])

    if not model.languages:
        return docs.withColumns({language: F.lit(UNDETERMINED), score: F.lit(0.0)})
    assert isinstance(kind, T.StringType)
    schema = T.StructType([*docs.schema.fields, T.StructField(language, T.StringType()), T.StructField(score, T.DoubleType())])
    told = has_letter(text_column)
    return docs.mapInArrow(text.tidy(rate), schema).withColumns({
        language: F.when(told, F.col(language)).otherwise(F.lit(UNDETERMINED)), score: F.when(told, F.col(score)).otherwise(F.lit(0.0)),
    })


def held_out(id_column: str = "doc_id", folds: int = 4, fold: int = 2) -> Column:
    """Whether an id belongs to the fold that is kept out of training."""
    return F.coalesce(F.crc32(F.col(f"`{id_column}`").cast("string").cast("binary")) % folds == fold, F.lit(False))


def identify(docs: DataFrame, sample: int = 400) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of every document, learned from the documents that are not held out."""
    model = fit(docs, ~held_out(), sample)
    return label(docs.select("doc_id", "text"), model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
