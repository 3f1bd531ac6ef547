"""Near duplicates, repeated passages and benchmark leaks against plain Python."""

import itertools
import random
from fractions import Fraction

import numpy as np
import pytest
from tests.llm import models
from tiffin.llm import components, decontaminate, near_dup, substring_dedup


def small_sets(n=500, seed=3):
    """Short documents and chains of changed copies."""
    rng, pool = random.Random(seed), [f"w{k}" for k in range(25)]
    docs = [(i, " ".join(rng.choice(pool) for _ in range(rng.choice([0, 1, 2, 3, 4, 5, 6, 8, 10, 15, 30, 70])))) for i in range(n // 3)]
    for i in range(len(docs), n):
        words = docs[rng.randrange(len(docs))][1].split()
        for _ in range(rng.choice([0, 1, 1, 2])):
            if words:
                at, how = rng.choice([0, -1, rng.randrange(len(words))]), rng.random()
                if how < 0.6:
                    words[at] = rng.choice(pool)
                elif how < 0.8:
                    words.insert(at, rng.choice(pool))
                else:
                    del words[at]
        docs.append((i, " ".join(words).upper() if rng.random() < 0.2 else " ".join(words)))
    return docs


@pytest.mark.parametrize("size, block", [(2, 1500), (4, 3), (5, 1500)])
def test_near_duplicates(spark, size, block):
    docs = small_sets()
    want = models.linked(docs, size)
    got = near_dup.near_duplicates(models.table(spark, docs), size, block=block).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want and len(got) == len(docs)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_near_duplicates_of_awkward_rows(spark):
    docs = models.awkward(60)
    more = [*docs, (None, docs[20][1]), (20, docs[20][1]), (70, "p q r s t u v"), (70, "other words of one id entirely different"), (71, "p q r s t u v")]
    got = near_dup.near_duplicates(models.clashing(spark, more), 4).collect()
    assert len(got) == len(more)
    want = models.linked(docs, 4)
    assert {r.doc_id: r.component_id for r in got if r.doc_id is not None and r.doc_id < 60} == {i: c for i, (_, c) in want.items()}
    assert [(r.component_id, r.kept) for r in got if r.doc_id is None] == [(None, True)]
    assert [(r.component_id, r.kept) for r in got if r.doc_id == 71] == [(70, False)]
    assert near_dup.near_duplicates(models.table(spark, [])).count() == 0


def test_one_text_for_many_ids(spark):
    got = near_dup.near_duplicates(models.table(spark, [(i, "the same five words here again") for i in range(40, 0, -1)])).collect()
    assert {r.component_id for r in got} == {1} and sum(r.kept for r in got) == 1


def test_components(spark):
    rng = random.Random(4)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(1000, 1060)] + [(2000, k) for k in range(2001, 2100)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        x, y = root(a), root(b)
        parent[max(x, y)] = min(x, y)
    real = {x for a, b in links if a != b for x in (a, b)}
    got = components.components(spark.createDataFrame([*links, (None, 5), (7, 7)], "a long, b long")).collect()
    assert {r.vertex: r.component for r in got} == {x: root(x) for x in real}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("size", [2, 5, 10, 11])
def test_repeated_passages(spark, size):
    rng, pool, docs = random.Random(5), [f"a{k}" for k in range(12)], []
    for i in range(150):
        words = []
        for _ in range(rng.randint(0, 6)):
            words += rng.choice([[rng.choice(pool)] * rng.randint(1, 30), [rng.choice(pool) for _ in range(rng.randint(1, 20))]])
        if docs and rng.random() < 0.6:
            earlier = docs[rng.randrange(len(docs))][1].split()
            at = rng.randint(0, max(0, len(earlier) - 1))
            words += earlier[at : at + rng.randint(1, 40)]
        docs.append((i, " ".join(words)))
    rng.shuffle(docs)
    got = substring_dedup.without_repeats(models.table(spark, docs), size).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, bytes(r.kept)) for r in got} == models.without_repeats(docs, size)


def test_repeated_passages_of_awkward_rows(spark):
    docs = models.awkward(60)
    more = [*docs, (None, docs[20][1]), (None, None)]
    df = models.clashing(spark, more)
    got = substring_dedup.without_repeats(df, 10)
    assert got.columns == [*[c for c in df.columns if c != "kept"], "kept", "n_words", "n_removed"]
    found = got.collect()
    assert {r.doc_id: (r.n_words, r.n_removed, bytes(r.kept)) for r in found if r.doc_id is not None} == models.without_repeats(docs, 10)
    assert [r.n_removed for r in found if r.doc_id is None] == [0, 0]
    twice = substring_dedup.without_repeats(models.table(spark, [(1, "a b c d e")] * 2 + [(2, "a b c d e")] * 2), 3).collect()
    assert sorted((r.doc_id, r.n_removed) for r in twice) == [(1, 0), (1, 0), (2, 5), (2, 5)]
    assert substring_dedup.without_repeats(models.table(spark, [])).count() == 0


def test_rows_of_one_id_lose_only_their_own_passages(spark):
    a, b = (" ".join(f"{x}{k}" for k in range(80)) for x in "ab")
    got = substring_dedup.without_repeats(models.table(spark, [(1, a), (2, a), (2, b), (3, b), (3, "none of it")])).collect()
    assert sorted((r.doc_id, r.n_words, r.n_removed) for r in got) == [(1, 80, 0), (2, 80, 0), (2, 80, 80), (3, 3, 0), (3, 80, 80)]


def test_passages_of_a_text_longer_than_a_slice(spark):
    rng = random.Random(8)
    long = " ".join(f"w{rng.randrange(10**7)}" for _ in range(600_000))  # beyond five megabytes
    words = long.split()
    docs = [(1, " ".join(words[1000:1080])), (2, long), (3, " ".join(words[-70:] + ["end"] * 20)), (4, " ".join(words[300_000:300_049]))]
    got = substring_dedup.without_repeats(models.table(spark, docs)).collect()
    assert sorted((r.doc_id, r.n_words, r.n_removed) for r in got) == [(1, 80, 0), (2, 600_000, 80), (3, 90, 70), (4, 49, 0)]
    near = near_dup.near_duplicates(models.table(spark, [(1, long), (2, " ".join(words[30_000:])), (3, "short")])).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in near) == [(1, 599_996, 1), (2, 569_996, 1), (3, 1, 3)]


def passage(n, seed):
    rng = random.Random(seed)
    return [f"v{rng.randrange(5000)}" for _ in range(n)]


def test_leaks_survive_substitutions(spark):
    items = {k: passage(30, k) for k in range(6)} | {6: passage(9, 6), 7: passage(5, 7)}
    benchmark = spark.createDataFrame([*((k, " ".join(w)) for k, w in items.items()), (8, None), (9, "")], "item_id long, text string")
    changed, neighbours, half = list(items[1]), list(items[2]), items[3][:15]
    for at in (4, 11, 20):
        changed[at] = "other"
    neighbours[14] = neighbours[15] = "other"
    docs = [
        (0, " ".join(passage(80, 90) + items[0] + passage(20, 91))), (1, " ".join(passage(7, 92) + changed)), (2, " ".join(neighbours + passage(30, 93))),
        (3, " ".join(half)), (4, " ".join(passage(200, 94))), (5, " ".join(items[4][:9] + passage(40, 95))), (6, " ".join(passage(9, 96) + items[6])),
        (7, " ".join(items[7])), (8, None), (9, ""), (10, " ".join(items[5]).upper()), (None, " ".join(items[0])), (11, " ".join(items[0][::2])),
        (12, " ".join(items[0][:20])), (13, " ".join(items[0][20:])),
    ]
    found = decontaminate.leaks(models.clashing(spark, docs), benchmark).collect()
    assert sorted(((r.doc_id, r.item_id) for r in found), key=str) == sorted([(0, 0), (1, 1), (2, 2), (3, 3), (6, 6), (7, 7), (10, 5), (None, 0), (12, 0)], key=str)
    assert [(r.start_word, r.n_words, r.n_equal) for r in found if r.doc_id == 0] == [(80, 30, 30)]
    assert [(r.n_words, r.n_equal) for r in found if r.doc_id == 1] == [(30, 27)]
    kept = decontaminate.clean(models.clashing(spark, docs), benchmark)
    assert kept.columns == models.clashing(spark, []).columns
    assert sorted(r.doc_id for r in kept.collect()) == [4, 5, 8, 9, 11, 13]


def test_any_stretch_that_meets_the_rule_counts(spark):
    for size in range(15, 21):
        for gone in itertools.chain.from_iterable(itertools.combinations(range(size), n) for n in (0, 1, 2, 3)):
            same = np.ones(size, bool)
            same[list(gone)] = False
            text = np.where(same, np.arange(size), 99)
            start, length, equal = decontaminate.overlap(text, np.arange(size), 0, 0.8)
            assert equal == models.most_equal(same.tolist(), "0.8") == same[start : start + length].sum() and 5 * equal >= 4 * length, (size, gone)
    items = {1: passage(15, 1), 2: passage(20, 2)}
    fifteen, twenty = list(items[1]), list(items[2])
    fifteen[11] = "other"
    twenty[9] = twenty[10] = twenty[11] = "other"
    benchmark = spark.createDataFrame([(k, " ".join(w)) for k, w in items.items()], "item_id long, text string")
    docs = models.table(spark, [(1, " ".join(passage(6, 97) + fifteen)), (2, " ".join(twenty + passage(6, 98)))])
    assert sorted(tuple(r) for r in decontaminate.leaks(docs, benchmark).collect()) == [(1, 1, 6, 15, 14), (2, 2, 0, 20, 17)]
    assert decontaminate.clean(docs, benchmark).count() == 0


def smallest_patterns(least, share):
    """Ways to replace words within passages that meet the rule and cannot be made shorter; ends are equal words."""
    for equal in range(least, 2 * least):
        for others in range(int(equal * (1 - Fraction(share)) / Fraction(share)) + 1):
            if equal > least and equal - 1 >= Fraction(share) * (equal - 1 + others):
                continue  # without its last word it meets the rule
            for gone in itertools.combinations(range(1, equal + others - 1), others):
                same = [k not in gone for k in range(equal + others)]
                if max(models.most_equal(same[1:], share), models.most_equal(same[:-1], share)) < least:
                    yield same


@pytest.mark.parametrize("least, share", [(12, "0.8"), (12, "0.9"), (6, "0.7")])
def test_seeds_meet_every_passage(least, share):
    masks, seen = decontaminate.seeds(least, float(share)), 0
    for same in smallest_patterns(least, share):
        assert any(all(same[at + k] for k, x in enumerate(m) if x == "1") for m in masks for at in range(len(same) - len(m) + 1)), same
        seen += 1
    assert seen > 4


def test_leaks_with_many_substitutions_and_at_borders(spark):
    items = {k: passage(n, 200 + k) for k, n in enumerate((20, 25, 30, 50, 100, 15, 15, 12, 30, 10, 12))}
    changed = {k: [w if n % 5 != 4 else "other" for n, w in enumerate(items[k])] for k in range(5)}
    changed |= {k: [w if n not in gone else "other" for n, w in enumerate(items[k])] for k, gone in ((5, (3, 7, 11)), (6, (4, 9)))}
    docs = [(k, " ".join(passage(9, 300 + k) + own + passage(9, 400 + k))) for k, own in changed.items()]
    docs += [(7, " ".join(items[7])), (8, " ".join(passage(20, 308) + items[8][:12])), (9, " ".join(items[9])), (10, " ".join(items[10][:11] + ["other"]))]
    benchmark = spark.createDataFrame([(k, " ".join(w)) for k, w in items.items()], "item_id long, text string")
    found = decontaminate.leaks(models.table(spark, docs), benchmark).collect()
    assert sorted((r.doc_id, r.item_id) for r in found) == [(k, k) for k in range(10)]
    assert {r.doc_id: r.n_equal for r in found} == {0: 16, 1: 20, 2: 24, 3: 40, 4: 80, 5: 12, 6: 13, 7: 12, 8: 12, 9: 10}
    assert [r.doc_id for r in decontaminate.clean(models.table(spark, docs), benchmark).collect()] == [10]


def test_leaks_of_empty_tables_and_large_benchmarks(spark, monkeypatch):
    empty = spark.createDataFrame([], "item_id long, text string")
    docs = models.table(spark, [(1, " ".join(passage(30, 1))), (2, " ".join(passage(30, 2)))])
    assert decontaminate.leaks(docs, empty).count() == 0 and decontaminate.clean(docs, empty).count() == 2
    many = spark.createDataFrame([(k, " ".join(passage(30, k))) for k in range(5)], "item_id long, text string")
    assert decontaminate.leaks(models.table(spark, []), many).count() == 0
    monkeypatch.setattr(decontaminate, "FILTER_BITS", 4)  # a benchmark that fills the bitmap
    assert sorted((r.doc_id, r.item_id) for r in decontaminate.leaks(docs, many).collect()) == [(1, 1), (2, 2)]
    assert decontaminate.clean(docs, many).count() == 0


@pytest.mark.parametrize("share", ["0.8", "0.7", "1.0"])
def test_items_of_every_length(spark, share):
    rng, items, docs = random.Random(11), [], [(900, None), (901, ""), (902, "w1")]
    for n in range(1, 15):
        for k in range(3):
            items.append((100 * n + k, [f"{rng.choice('xyz')}{rng.randrange(30)}" for _ in range(n)]))
    for item, words in items:
        for copy in range(2):
            own = list(words)
            for _ in range(rng.randint(0, 3)):
                own[rng.randrange(len(own))] = "other"
            lead = [f"l{rng.randrange(9)}" for _ in range(rng.randint(0, 3))]
            docs.append((10 * item + copy, " ".join([*lead, *own, *lead[::-1]])))
    texts = [(i, " ".join(w)) for i, w in items] + [(1, None), (2, " ")]
    benchmark = spark.createDataFrame(texts, "item_id long, text string")
    df = models.table(spark, docs)
    found = decontaminate.leaks(df, benchmark, share=float(share)).collect()
    want = models.leaking(docs, texts, share=share)
    assert {(r.doc_id, r.item_id): r.n_equal for r in found} == want and len(found) == len(want) > 30
    left = {r.doc_id for r in decontaminate.clean(df, benchmark, share=float(share)).collect()}
    assert left == {i for i, _ in docs} - {i for i, _ in want}


def test_a_passage_in_a_text_longer_than_a_slice(spark):
    long = " ".join(f"w{k}" for k in range(700_000))  # beyond five megabytes
    benchmark = spark.createDataFrame([(1, " ".join(f"w{k}" for k in range(650_000, 650_030)))], "item_id long, text string")
    docs = models.table(spark, [(1, long), (1, "w650000 another text of one id"), (2, "clean")])
    assert [tuple(r) for r in decontaminate.leaks(docs, benchmark).collect()] == [(1, 1, 650_000, 30, 30)]
    assert sorted(r.text[:9] for r in decontaminate.clean(docs, benchmark).collect()) == ["clean", "w650000 a"]
