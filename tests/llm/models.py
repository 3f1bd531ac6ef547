"""Plain Python versions of the operators, and small awkward tables."""

import hashlib
import itertools
import random
import re
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
# Column names that operators use inside.
CLASHING = "doc_id long, text string, body string, id long, bucket int, hits int, places int, key string, parts string, kept string, score string, pieces int, ids int"


def words_of(text):
    return (text or "").encode().split()


def awkward(n=60, seed=1):
    """Rows with nulls, empty and long texts, equal rows and copies with changes."""
    rng = random.Random(seed)
    pool = [f"w{k}" for k in range(40)] + ["é", "日本語", "<|endoftext|>", "It's", "''s", "12,5", "\x1c", "THE"]
    out = [(0, None), (1, ""), (2, " \n\t "), (3, "one"), (4, "a b c"), (5, "x" * 3000), (6, "ab " * 400), (7, "  \n lead and trail \r\n")]
    for i in range(len(out), n):
        if i > 12 and rng.random() < 0.5:
            own = (out[rng.randrange(8, i)][1] or "").split(" ")
            own[rng.randrange(len(own))] = rng.choice(pool)
        else:
            own = [rng.choice(pool) for _ in range(rng.randint(1, 120))]
        out.append((i, rng.choice([" ", " ", "  ", "\n"]).join(own) if rng.random() < 0.1 else " ".join(own)))
    return out


def table(spark, rows):
    return spark.createDataFrame([(i, t, "en" if (i or 0) % 3 else None, f"s{(i or 0) % 2}", len(t or "")) for i, t in rows], DOCS)


def clashing(spark, rows):
    return spark.createDataFrame([(i, t, "b", 7, 1, 2, 3, "k", "p", "q", "s", 4, 5) for i, t in rows], CLASHING)


def shingles(text, size):
    own = words_of("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not own:
        return frozenset()
    return frozenset(tuple(own[k : k + size]) for k in range(len(own) - size + 1)) or frozenset([tuple(own)])


def linked(docs, size, percent=80):
    """Number of shingles and component of each document, by comparing all pairs."""
    sets = {i: shingles(t, size) for i, t in docs}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    return {i: (len(s), root(i)) for i, s in sets.items()}


def without_repeats(docs, size):
    """Words, removed words and kept words of each document."""
    own, first = {i: words_of(t) for i, t in docs}, {}
    for i in sorted(own):
        for k in range(len(own[i]) - size + 1):
            first.setdefault(tuple(own[i][k : k + size]), i)
    out = {}
    for i, words in own.items():
        gone = set()
        for k in range(len(words) - size + 1):
            if first[tuple(words[k : k + size])] < i:
                gone.update(range(k, k + size))
        out[i] = (len(words), len(gone), b" ".join(w for k, w in enumerate(words) if k not in gone))
    return out


def most_equal(same, share):
    """Most equal words of any stretch with the share, trying all."""
    sums, up, down = [0, *itertools.accumulate(same)], *Fraction(share).as_integer_ratio()
    return max((sums[b] - sums[a] for a in range(len(same)) for b in range(a + 1, len(same) + 1) if down * (sums[b] - sums[a]) >= up * (b - a)), default=0)


def leaking(docs, items, least=12, share="0.8"):
    """Documents and items that share a passage, and its equal words, by laying every item along every document everywhere."""
    numbers, part = {}, Fraction(share)

    def coded(text):
        return np.array([numbers.setdefault(w, len(numbers)) for w in words_of("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))], dtype=int)

    texts, out = [(i, coded(t)) for i, t in docs], {}
    for item, words in ((i, coded(t)) for i, t in items):
        n = len(words)
        wanted = least if n >= least else max(1, part * n)
        for i, own in texts if n else ():
            equal = np.zeros(len(own) + n, int)  # by diagonal + n
            for k, word in enumerate(words):
                equal[n - k : n - k + len(own)] += own == word
            best = 0
            for d in np.flatnonzero(equal >= wanted) - n:
                first, last = max(0, -d), min(n, len(own) - d)
                same = (own[d + first : d + last] == words[first:last]).tolist()
                if n >= least:
                    best = max(best, most_equal(same, share))
                elif len(same) == n and sum(same) >= part * n:
                    best = max(best, sum(same))
            if best >= wanted:
                out[i, item] = best
    return out


def figures(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    often = Counter(tuple(words[k : k + 5]) for k in range(len(words) - 4))
    covered = {j for k in range(len(words) - 4) if often[tuple(words[k : k + 5])] > 1 for j in range(k, k + 5)}
    return len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered)


def kept_by_rules(rows):
    """Whether each (text, lang, source) is kept: fixed rules, then limits from the exact deciles of its group."""
    measured = []
    for text, *_ in rows:
        n, chars, symbols, lines, repeats = figures(text)
        all_lines = sum(bool(re.search(r"[^\x20\x09-\x0D]", x)) for x in (text or "").split("\n"))
        capitals = len(re.findall("[A-Z]", text or ""))
        failed = n < 10 or 100 * repeats > 20 * n
        measured.append((failed, symbols / chars if chars else 0, capitals / chars if chars else 0, lines / all_lines if all_lines else 0, chars / n if n else 0))
    good = [(*row[1:], m[1:]) for row, m in zip(rows, measured) if not m[0]]
    out = []
    for (_, lang, source), m in zip(rows, measured):
        groups = ([g for *key, g in good if key == [lang, source]], [g for key, _, g in good if key == lang], [g for *_, g in good])
        own = next((g for g in groups[:2] if len(g) >= 100), groups[2])
        ok = not m[0]
        for k, fixed in enumerate((0.05, 0.3, 0.6, 4.0)) if ok else ():
            low, high = np.quantile([g[k] for g in own], [0.1, 0.9], method="inverted_cdf")
            above, below = (5.0 * (high - low), 2.0 * (high - low)) if high > low else (fixed, fixed)
            ok = ok and m[k + 1] <= high + above and (k < 3 or m[k + 1] >= low - below)
        out.append(ok)
    return out


def sha(value):
    return hashlib.sha256(value if isinstance(value, bytes) else value.encode()).hexdigest()


def conversations(rows):
    """Per conversation: turns, digest of all, loss text."""
    grouped = defaultdict(list)
    for conv, turn, role, text in rows:
        grouped[conv].append((turn is not None, turn or 0, role or "", text or ""))
    out = {}
    for conv, turns in grouped.items():
        turns.sort()
        loss = "".join(t for *_, r, t in turns if r == "assistant")
        out[conv] = (len(turns), sha("".join(f"{r}\n{t}\n" for *_, r, t in turns)), len(loss), sha(loss))
    return out
