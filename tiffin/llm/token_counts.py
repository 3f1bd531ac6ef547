"""Token counts by a compiled finite-state tokenizer.

Two deterministic transducers do the work. The first (``pieces``) splits text; the maps of its chunks are composed by a parallel prefix
scan. The second runs over the bytes of a piece; each transition carries how many tokens it adds or takes back, and the count of a piece
is the sum along its path. It is compiled from the tokenizer's own merges, transition by transition as texts ask for them, within a fixed
number of states; when they are used up the compilation starts anew, as lazily built automata do.

A state of the second transducer holds what later bytes can depend on: for every suffix of the input read so far that may still grow into a
vocabulary entry, the last token before that suffix and the token count there, relative to now. The last token of a prefix is the longest
vocabulary entry that ends it and stands with the last token before it, that is, the library splits the two in the same place.
"""

from __future__ import annotations

import functools
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiffin.llm import pieces, text

MAX_STATES = 250_000
SHIFT = 512  # keeps the tokens a transition adds (at most 1, at least minus the longest entry) positive


def byte_letters() -> list[str]:
    """The letter by which byte-level vocabularies write each byte: printable bytes themselves, the others from code point 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(rest)) for b in range(256)]


class CountTransducer:
    """Lazily compiled transducer from the bytes of one piece to its number of tokens."""

    def __init__(self, path: str, max_states: int = MAX_STATES):
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path).model
        with open(path, encoding="utf-8") as f:
            vocabulary = json.load(f)["model"]["vocab"]
        self.letters = byte_letters()
        back = {c: bytes([b]) for b, c in enumerate(self.letters)}
        self.tokens = {b"".join(back[c] for c in word): i for word, i in vocabulary.items() if all(c in back for c in word)}
        self.prefixes = {word[:k] for word in self.tokens for k in range(1, len(word) + 1)}
        self.max_states = max_states
        self.stands = functools.lru_cache(1 << 17)(self._stands)
        self.restart()

    def restart(self) -> None:
        # A state is (suffix bytes, for every suffix that may grow, longest first, down to the empty one: length, last token before it, count)
        start = ((0, b"", 0),)
        self.keys: list[tuple] = [(b"", start)]
        self.numbers = {(b"", start): 0}
        self.next: dict[int, int] = {}  # state and byte: next state and added tokens, in one number

    def _stands(self, before: bytes, token: bytes) -> bool:
        """Whether the library leaves a boundary between the two, and nothing else."""
        got = self.model.tokenize("".join(self.letters[b] for b in before + token))
        want = [self.tokens[before], self.tokens[token]] if before else [self.tokens[token]]
        return [t.id for t in got] == want

    def compile(self, state: int, byte: int) -> int:
        """Transition from a state by a byte."""
        suffix, before = self.keys[state]
        grown = suffix + bytes([byte])
        for size, last, count in before:  # longest suffix first
            token = grown[len(grown) - size - 1 :]
            if token in self.tokens and self.stands(last, token):
                break
        else:
            raise ValueError("the vocabulary lacks a single byte")
        added = count + 1
        kept = [(size + 1, last, count - added) for size, last, count in before if grown[len(grown) - size - 1 :] in self.prefixes]
        kept.append((0, token, 0))
        longest = kept[0][0]
        key = (grown[len(grown) - longest :], tuple(kept))
        number = self.numbers.get(key)
        if number is None:
            number = self.numbers[key] = len(self.keys)
            self.keys.append(key)
        self.next[state << 8 | byte] = move = number * 2 * SHIFT + added + SHIFT
        return move

    def count(self, piece: bytes) -> int:
        if len(self.keys) > self.max_states:
            self.restart()
        moves, state, total = self.next, 0, 0
        for byte in piece:
            move = moves.get(state << 8 | byte) or self.compile(state, byte)
            state, added = divmod(move, 2 * SHIFT)
            total += added
        return total - SHIFT * len(piece)


@functools.cache
def transducer(path: str) -> CountTransducer:
    """One per Python worker."""
    return CountTransducer(path)


def piece_counts(data: np.ndarray, offsets: np.ndarray, machine: CountTransducer, special: bytes | None) -> np.ndarray:
    """Tokens of each text of a batch."""
    bounds, first = pieces.split(data, offsets, pieces.by_transducer, special)
    coded = text.binary(data, bounds).dictionary_encode()
    words = coded.dictionary.to_pylist()
    counts = np.fromiter((1 if w == special else machine.count(w) for w in words), dtype=np.int64, count=len(words))
    total = np.concatenate([np.zeros(1, np.int64), np.cumsum(counts[coded.indices.to_numpy()])]) if len(words) else np.zeros(1, np.int64)
    return total[first[1:]] - total[first[:-1]]


def token_counts(
    docs: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text", limit: int = 1024, special: str | None = "<|endoftext|>"
) -> DataFrame:
    """``id, n_bytes, n_tokens, over_limit`` of every row, for a byte-level tokenizer file with the pattern of ``pieces``.

    ``special`` inside a text is one token. A null text counts as empty: 0 bytes, 0 tokens, not over the limit. Null ids, equal rows and equal
    ids stay as they are, one row out for each row in; other columns are left out, whatever their names. No shuffle: a text is read once, in its
    own task, and only numbers go on.
    """
    text.prepared(docs.sparkSession)
    marker = special.encode() if special else None

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = transducer(path)
        for part in text.slices(batches, "body", text.LARGE_SLICE):
            data, offsets = text.raw(part.column("body"))
            tokens = piece_counts(data, offsets, machine, marker)
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), pa.array(np.diff(offsets)), pa.array(tokens), pa.array(tokens > limit)], ["id", "n_bytes", "n_tokens", "over_limit"]
            )

    source = docs.select(F.col(f"`{id_column}`").alias("id"), text.utf8(text_column).alias("body"))
    kind = source.schema["id"].dataType.simpleString()
    return source.mapInArrow(count, f"id {kind}, n_bytes bigint, n_tokens bigint, over_limit boolean").withColumnRenamed("id", id_column)
