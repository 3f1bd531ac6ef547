"""Splitting of text before byte-level merges, as a deterministic transducer and as a rule on neighbouring characters.

Both give the pieces of ``'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+``.

The transducer reads classes of characters. A transition says with two bits whether a piece starts at this character and whether one
started at the character before: that is all the look-ahead the pattern needs. A text is cut in chunks of equal length; the map of a
chunk (entry state to exit state) is composed with the maps before it by a parallel prefix scan, which gives every chunk its entry state.
"""

from __future__ import annotations

import functools
import sys
import unicodedata

import numpy as np

# Classes of characters; a class plus RESET is the first character of a text.
CONTRACT, RE_VE, ELL, E_LETTER, LETTER, NUMBER, SPACE, OTHER_SPACE, QUOTE, OTHER = range(10)
RESET = 10
# States: start, in letters, numbers or others, after a leading quote, after 'r or 'v, after 'l, after a contraction, one or more spaces.
START, IN_LETTERS, IN_NUMBERS, IN_OTHERS, QUOTED, QUOTED_RV, QUOTED_L, CLOSED, ONE_SPACE, ONE_OTHER, RUN_SPACE, RUN_OTHER = range(12)
STATES = 12
CHUNK = 128
WHITE = [*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
SPECIAL = b"<|endoftext|>"


@functools.cache
def character_classes() -> np.ndarray:
    """Class of every code point."""
    out = np.full(sys.maxunicode + 1, OTHER, dtype=np.uint8)
    kinds = np.array([unicodedata.category(chr(c))[0] for c in range(sys.maxunicode + 1)])
    out[kinds == "L"] = LETTER
    out[kinds == "N"] = NUMBER
    out[WHITE] = OTHER_SPACE
    out[0x20] = SPACE
    out[ord("'")] = QUOTE
    out[[ord(c) for c in "stmd"]] = CONTRACT
    out[[ord(c) for c in "rv"]] = RE_VE
    out[ord("l")], out[ord("e")] = ELL, E_LETTER
    return out


def step(state: int, cls: int) -> tuple[int, int]:
    """Next state and output bits: 1 a piece starts here, 2 a piece started one character earlier."""
    if cls >= RESET:
        return step(START, cls - RESET)[0], 1 | (2 if state in (QUOTED_RV, QUOTED_L) else 0)
    letter, white = cls <= LETTER, cls in (SPACE, OTHER_SPACE)
    fresh = IN_LETTERS if letter else IN_NUMBERS if cls == NUMBER else QUOTED if cls == QUOTE else IN_OTHERS
    if state in (ONE_SPACE, ONE_OTHER, RUN_SPACE, RUN_OTHER):
        if white:
            return (RUN_SPACE if cls == SPACE else RUN_OTHER), 0
        earlier = 2 if state in (RUN_SPACE, RUN_OTHER) else 0
        if state in (ONE_SPACE, RUN_SPACE):  # the space leads this piece; a quote behind it begins no contraction
            return (IN_OTHERS if cls == QUOTE else fresh), earlier
        return fresh, earlier | 1
    if white:
        return (ONE_SPACE if cls == SPACE else ONE_OTHER), 1 | (2 if state in (QUOTED_RV, QUOTED_L) else 0)
    if state in (START, CLOSED):
        return fresh, 1
    if state == QUOTED:
        if cls == CONTRACT:
            return CLOSED, 0
        if cls in (RE_VE, ELL):
            return (QUOTED_RV if cls == RE_VE else QUOTED_L), 0
        return (IN_OTHERS, 0) if cls in (QUOTE, OTHER) else (fresh, 1)
    if state in (QUOTED_RV, QUOTED_L):
        if cls == (E_LETTER if state == QUOTED_RV else ELL):
            return CLOSED, 0
        return (IN_LETTERS, 2) if letter else (fresh, 3)
    same = letter if state == IN_LETTERS else cls == NUMBER if state == IN_NUMBERS else cls in (QUOTE, OTHER)
    return (state, 0) if same else (fresh, 1)


@functools.cache
def tables() -> tuple[np.ndarray, np.ndarray]:
    """Next state and output by ``class * STATES + state``."""
    cells = [step(s, c) for c in range(2 * RESET) for s in range(STATES)]
    return np.array([x for x, _ in cells], dtype=np.uint8), np.array([x for _, x in cells], dtype=np.uint8)


def scan(maps: np.ndarray) -> np.ndarray:
    """Inclusive prefix composition of state maps (one row per chunk), in log2(rows) rounds."""
    out, reach = maps, 1
    while reach < len(out):
        later = np.take_along_axis(out[reach:], out[:-reach].astype(np.intp), axis=1)
        out = np.concatenate([out[:reach], later])
        reach *= 2
    return out


def by_transducer(classes: np.ndarray, chunk: int = CHUNK) -> np.ndarray:
    """Flags of the characters at which a piece starts. ``classes`` has RESET added where a text starts."""
    n = len(classes)
    if not n:
        return np.zeros(0, bool)
    following, output = tables()
    lanes = -(-n // chunk)
    grid = np.full(lanes * chunk, OTHER + RESET, dtype=np.int16)
    grid[:n] = classes
    grid = np.ascontiguousarray(grid.reshape(lanes, chunk).T) * np.int16(STATES)
    state = np.broadcast_to(np.arange(STATES, dtype=np.int16)[:, None], (STATES, lanes))
    for row in grid:
        state = following[state + row]
    entry = np.full(lanes, START, dtype=np.uint8)
    entry[1:] = scan(np.ascontiguousarray(state.T))[:-1, START]
    out = np.empty((chunk, lanes), dtype=np.uint8)
    for k, row in enumerate(grid):
        at = entry + row
        out[k] = output[at]
        entry = following[at]
    out = np.ascontiguousarray(out.T).reshape(-1)
    flags = (out[:n] & 1).astype(bool)
    flags[:-1] |= (out[1:n] & 2).astype(bool)
    if lanes * chunk > n and n:
        flags[-1] |= bool(out[n] & 2)
    elif int(entry[-1]) in (QUOTED_RV, QUOTED_L):
        flags[-1] = True
    return flags


def by_rule(classes: np.ndarray) -> np.ndarray:
    """The same flags from comparisons of neighbours."""
    n = len(classes)
    if not n:
        return np.zeros(0, bool)
    begin, cls = classes >= RESET, classes % RESET
    kind = np.array([0, 0, 0, 0, 0, 1, 3, 3, 2, 2], dtype=np.uint8)[cls]  # letters, numbers, others, white
    white = kind == 3
    before = np.concatenate([np.zeros(1, np.uint8), kind[:-1]])
    white_before = np.concatenate([np.zeros(1, bool), white[:-1]]) & ~begin
    led = np.concatenate([np.zeros(1, bool), cls[:-1] == SPACE]) & ~begin & ~white
    flags = begin | ((kind != before) & ~(led | white & white_before))
    run = ~white & white_before  # its last white character is a piece of its own, or leads
    flags[:-1] |= run[1:]
    quotes = np.flatnonzero((cls == QUOTE) & flags & ~led)
    ahead = np.concatenate([classes, np.full(3, OTHER + RESET, dtype=classes.dtype)])
    two = ahead[quotes + 1] == CONTRACT
    three = ((ahead[quotes + 1] == RE_VE) & (ahead[quotes + 2] == E_LETTER)) | ((ahead[quotes + 1] == ELL) & (ahead[quotes + 2] == ELL))
    flags[quotes[two | three] + 1] = False
    for at in (quotes[two] + 2, quotes[three] + 3):
        at = at[at < n]
        # what follows a contraction starts a piece, but for the inside of a run of white characters, which cannot begin there
        flags[at] = True
    return flags


def split(data: np.ndarray, offsets: np.ndarray, flags_of=by_rule, special: bytes | None = SPECIAL) -> tuple[np.ndarray, np.ndarray]:
    """Byte offsets of all pieces of a batch (with the end), and the index of the first piece of each text (with the end).

    ``special`` is cut out of the texts first and is a piece of its own.
    """
    cuts = offsets[:-1]
    if special and (whole := data.tobytes()).find(special) >= 0:
        found, at = [], whole.find(special)
        while at >= 0:
            if np.searchsorted(offsets, at, side="right") == np.searchsorted(offsets, at + len(special) - 1, side="right"):
                found.append(at)
                at = whole.find(special, at + len(special))
            else:  # reaches over the end of a text
                at = whole.find(special, at + 1)
        inner = np.array(found, dtype=np.int64)
        marks = np.concatenate([inner, inner + len(special)])
        cuts = np.unique(np.concatenate([cuts, marks]))
    else:
        inner = np.zeros(0, np.int64)
    if not len(data):
        return np.zeros(1, np.int64), np.zeros(len(offsets), np.int64)
    lead = np.flatnonzero((data & 0xC0) != 0x80)
    points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), dtype=np.uint32)
    classes = character_classes()[points]
    heads = np.searchsorted(lead, cuts[cuts < len(data)])
    classes[heads] += RESET
    flags = flags_of(classes)
    if len(inner):
        firsts = np.searchsorted(lead, inner)
        for k in range(1, len(special)):
            flags[firsts + k] = False
    begins = lead[flags]
    return np.append(begins, len(data)), np.searchsorted(begins, offsets)
