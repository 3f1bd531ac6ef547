"""Quality rules, chat formatting, URL filter and quality classifier."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from tests.conftest import plan
from tests.llm import models
from tiffin.llm import chat, classifier, quality_rules, url_filter


def test_quality_figures(spark):
    docs = [*models.awkward(60), (None, "no id " * 9), (5, "again a b c d e f g h i j k l")]
    got = quality_rules.quality_rules(models.table(spark, docs))
    want = []
    for i, t in docs:
        n, chars, symbols, lines, repeats = models.figures(t)
        want.append((i, n, chars, symbols, lines, repeats, n < 10 or 100 * repeats > 20 * n))
    key = lambda r: (r[0] is None, r[0] or 0, r[1:])
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    assert sorted((tuple(r) for r in got.select(names).collect()), key=key) == sorted(want, key=key)
    assert got.where("base_failed AND kept").count() == 0
    assert "Python" not in plan(got) and "Arrow" not in plan(got)
    assert quality_rules.quality_rules(models.table(spark, [])).count() == 0


def test_kept_by_exact_deciles(spark):
    """All texts of a table against the rules by plain Python: sketches of few texts are exact."""
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = docs.select("doc_id", "text", "lang", "source").collect()
    got = {r.doc_id: r.kept for r in quality_rules.quality_rules(docs).collect()}
    want = models.kept_by_rules([(r.text, r.lang, r.source) for r in rows])
    assert {r.doc_id for r, k in zip(rows, want) if k != got[r.doc_id]} == set()


def test_limits_move_with_the_spread(spark):
    """Of two sources with word lengths apart by a factor of two, the wider one's limits are wider; so are most limits those of the sketches."""
    rng = random.Random(4)

    def prose(width, n=80):
        return " ".join("".join(rng.choice("abcdefgh") for _ in range(5 + rng.randint(-1, 1) * (1 + rng.randrange(width)))) + rng.choice(["", "", "X"]) for _ in range(n))

    docs = [(i, prose(1), "en", "narrow") for i in range(200)] + [(1000 + i, prose(3), "en", "wide") for i in range(200)]
    docs += [(5000, " ".join(rng.choice("abcdefgh") for _ in range(200)), "en", "narrow"), (5001, " ".join(rng.choice("abcdefgh") for _ in range(200)), "en", None)]
    docs += [(i, "long " * 3 + " ".join("abcdefghijkl"[: rng.randint(8, 12)] + str(k) for k in range(60)), "en", s) for i, s in ((5002, "narrow"),)]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string")
    kept = {r.doc_id: r.kept for r in quality_rules.quality_rules(df).collect()}
    assert [kept[i] for i in (5000, 5001, 5002)] == [False] * 3 and sum(kept[i] for i in range(200)) > 195 and sum(kept[1000 + i] for i in range(200)) > 195
    figures = quality_rules.measured(df).withColumn("base_failed", F.lit(False)).withColumns(quality_rules.shares())
    fences = {r.source: r.fence for r in quality_rules.limits(figures).collect()}
    wide, narrow = ({s: f[s]["high"] - f[s]["low"] for s in quality_rules.SHARES} for f in (fences["wide"], fences["narrow"]))
    assert wide["mean_word"] > 1.5 * narrow["mean_word"]
    moved = [abs(fences[k][s]["high"] - fences[k][s]["low"] - 2 * fixed) > 1e-9 for k in ("wide", "narrow") for s, fixed in quality_rules.SHARES.items()]
    assert sum(moved) >= len(moved) / 2


def test_domains_under_suffixes_of_two_labels(spark):
    hosts = ["a.shop.co.uk", "shop.co.uk", "co.uk", "x.example.com", "localhost", "", "me.github.io", "deep.me.github.io"]
    df = spark.createDataFrame([(h,) for h in hosts], "host string")
    got = df.select(url_filter.domain_of(F.col("host")), url_filter.suffix_of(F.col("host"))).collect()
    assert [tuple(r) for r in got] == [
        ("shop.co.uk", "co.uk"), ("shop.co.uk", "co.uk"), ("co.uk", "co.uk"), ("example.com", "com"), ("localhost", "localhost"), ("", ""),
        ("me.github.io", "github.io"), ("me.github.io", "github.io"),
    ]
    # Sites under one suffix of two labels do not share a domain's prior: a bad site leaves its neighbour alone.
    pages = [(i, f"http://bad.co.uk/{i}") for i in range(40)] + [(100 + i, f"http://good.co.uk/{i}") for i in range(40)] + [(200, "http://new.bad.co.uk/x")]
    outcomes = [(i, 1) for i in range(40)] + [(100 + i, 0) for i in range(40)]
    judged = url_filter.judge(spark.createDataFrame(pages, "page_id long, url string"), spark.createDataFrame(outcomes, "page_id long, bad int"), rules=[])
    shares = {r.host: r.bad_share for r in judged.collect()}
    assert shares["bad.co.uk"] > 0.9 and shares["good.co.uk"] < 0.1 and shares["new.bad.co.uk"] > 0.5


def test_ngrams_are_of_code_points():
    body = "aé日𝄞 b".encode()
    data, offsets = np.frombuffer(body + "zß".encode(), np.uint8), np.array([0, len(body), len(body) + 3])
    points, ends = classifier.code_points(data, offsets)
    assert points.tolist() == [ord(c) for c in "aé日𝄞 bzß"] and ends.tolist() == [0, 6, 8]
    same = [b[0][: 2].tolist() for b in classifier.buckets(data, offsets) if b[3] == 1]
    assert len(same) == len(classifier.GRAMS)


def test_limits_follow_the_group(spark):
    rng = random.Random(2)

    def prose(k):
        return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 9))) + ("*" if rng.random() < k else "") for _ in range(60))

    # Symbols are usual in source "code" and not in "news"; a small source takes the limits of its language.
    docs = [(i, prose(0), "en", "news") for i in range(300)] + [(1000 + i, prose(0.5 * rng.random()), "en", "code") for i in range(300)]
    docs += [(5000, prose(0.6), "en", "news"), (5001, prose(0.4), "en", "code"), (5002, prose(0), "en", "rare"), (5003, prose(0).replace(" ", "***** "), "en", "rare"), (5004, prose(0), None, None)]
    got = quality_rules.quality_rules(spark.createDataFrame(docs, "doc_id long, text string, lang string, source string")).collect()
    kept = {r.doc_id: r.kept for r in got}
    assert [kept[k] for k in range(5000, 5005)] == [False, True, True, False, True]
    assert all(kept[i] for i in range(300)) and sum(kept[1000 + i] for i in range(300)) > 290
    assert [r.failed_shares for r in got if r.doc_id == 5000] == [["symbol_share"]]


TURNS = [
    (1, 0, "user", "hi"), (1, 1, "assistant", "a & b <| c"), (1, 2, "assistant", "<|im_end|>"), (1, 3, "user", None), (2, 5, None, "x\n\ny"), (2, None, "system", "first"),
    (3, 1, "assistant", ""), (3, 1, "assistant", ""), (4, 0, "tool\nrole <|turn|>", "&lt;| &amp; <"), (4, 1, "user", "|end<"), (None, 0, "user", "no id"), (5, 0, "user", " \t "),
]


def test_chat_reads_back_exactly(spark):
    df = spark.createDataFrame([(*r, "extra", 1) for r in TURNS], "conv_id long, turn long, role string, text string, formatted string, id int")
    formatted = chat.format_conversations(df)
    got = chat.digests(df)
    want = models.conversations([*TURNS, (-1, 0, "user", chat.PLANTED), (-1, 1, "assistant", chat.PLANTED)])
    assert {r.conv_id: tuple(r)[1:5] for r in got.collect()} == want
    assert {r.conv_id: r.n_messages for r in formatted.collect()}[1] == 3
    one = {r.conv_id: r.formatted for r in formatted.collect()}
    assert one[1] == "<|im_start|>user\nhi<|im_end|>\n<|im_start|>assistant\na &amp; b &lt;| c<|turn|>&lt;|im_end|><|im_end|>\n<|im_start|>user\n<|im_end|>\n"
    assert chat.digests(df.limit(0)).count() == 1  # the planted conversation


URLS = {
    None: ("", ""), "no scheme/x": ("", ""), "http://A.Example.NET/EN/x?y#z": ("a.example.net", "/EN/x"), "x://h": ("h", ""), "http://h?q=/a://b": ("h", ""),
    "https://É.org/fr/1": ("É.org", "/fr/1"), "http:///p": ("", "/p"), "a://b://c/d": ("b:", "//c/d"), "": ("", ""), "http://h#f/x": ("h", ""), "u://h/a\nb?c": ("h", "/a\nb"),
}


def test_hosts_paths_and_rules(spark):
    df = spark.createDataFrame([(i, u) for i, u in enumerate(URLS)], "page_id long, url string")
    got = df.select("page_id", url_filter.host_of(F.col("url")), url_filter.path_of(F.col("url"))).orderBy("page_id").collect()
    assert [tuple(r)[1:] for r in got] == list(URLS.values())
    cases = [
        ("net", "/", "net/", "block"), ("x.net", "/a", "net/", "block"), ("planet", "/", None, None), ("a.example.net", "/en/x", "example.net/en/", "allow"),
        ("example.net", "/en", "net/", "block"), ("example.com", "/de/", "example.com/de/", "block"), ("b.org", "/fr/x", "org/fr/", "allow"), ("x.net", "", None, None),
    ]
    hosts = spark.createDataFrame([(c[0], c[1]) for c in cases], "host string, path string")
    rule, verdict = url_filter.rule_of(F.col("host"), F.col("path"), url_filter.RULES)
    assert {tuple(r) for r in hosts.select("host", "path", rule.alias("r"), verdict.alias("v")).collect()} == set(cases)


def test_reputation_shrinks_and_blocks(spark):
    pages = [(i, f"http://bad.spam.com/{i}") for i in range(60)] + [(100 + i, f"http://good.fine.com/{i}") for i in range(60)]
    pages += [(200, "http://new.spam.com/x"), (201, "http://new.fine.com/x"), (202, "http://other.info/x"), (203, None), (None, "http://good.fine.com/n")]
    outcomes = [(i, 1) for i in range(55)] + [(55 + i, 0) for i in range(5)] + [(100 + i, 0) for i in range(60)] + [(0, 1), (999, 1)]
    df = spark.createDataFrame([(*p, "e", 1) for p in pages], "page_id long, url string, host string, bad int")
    got = {(r.page_id, r.host): r for r in url_filter.judge(df, spark.createDataFrame(outcomes, "page_id long, bad int"), rules=[]).collect()}
    assert len(got) == len(pages)
    assert got[1, "bad.spam.com"].verdict == "block" and got[100, "good.fine.com"].verdict == "allow" and got[203, ""].verdict == "allow"
    assert got[200, "new.spam.com"].bad_share > got[202, "other.info"].bad_share > got[201, "new.fine.com"].bad_share
    assert 0.8 < got[1, "bad.spam.com"].bad_share < 55 / 60 and got[200, "new.spam.com"].bound < got[200, "new.spam.com"].bad_share
    none = url_filter.judge(df, spark.createDataFrame([], "page_id long, bad int"))
    assert none.count() == len(pages) and none.where("rule IS NULL AND verdict = 'block'").count() == 0
    assert url_filter.judge(df.limit(0), spark.createDataFrame(outcomes, "page_id long, bad int")).count() == 0


def labelled(n, seed):
    rng = random.Random(seed)
    pool = ["".join(rng.choice("aeiourstln") for _ in range(rng.randint(2, 8))) for _ in range(400)]
    docs, labels = [], []
    for i in range(n):
        words = [rng.choice(pool) for _ in range(rng.randint(20, 200))]
        kind = i % 4
        if kind == 1:
            words = [w + "$$$" for w in words]
        elif kind == 3:
            words = [w for w in words[:10] for _ in range(12)]
        docs.append((i, " ".join(words)))
        labels.append((i, 0 if kind in (1, 3) else 1))
    return docs, labels


def test_classifier_on_held_out_rows(spark):
    docs, labels = labelled(600, 1)
    more = [*docs, (None, "words"), (9000, None), (9001, ""), (9002, "long " * 30_000)]
    table = models.table(spark, more)
    marks = spark.createDataFrame([*labels, (None, 1), (5, None), (7, 1), (7, 0)], "doc_id long, quality int")
    got = classifier.classify(table, marks).collect()
    assert len(got) == len(more) and all(0 <= r.score <= 1 for r in got) and all(r.predicted == (r.score >= 0.3) for r in got)
    wanted = dict(labels)
    held = [r.predicted == wanted[r.doc_id] for r in got if r.held_out and r.doc_id in wanted]
    assert len(held) > 80 and np.mean(held) > 0.97
    assert {r.score for r in got if r.doc_id in (9000, 9001)} == {[r.score for r in got if r.doc_id == 9000][0]}
    assert classifier.classify(models.table(spark, []), marks).count() == 0


def test_classifier_ignores_what_it_must(spark):
    docs, labels = labelled(200, 2)
    marks = spark.createDataFrame(labels, "doc_id long, quality int")
    model = classifier.fit(models.table(spark, docs), marks, ~classifier.held_out())
    # Other labels for the held-out rows, another order and other columns change nothing.
    turned = marks.withColumn("quality", F.when(classifier.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    again = classifier.fit(models.clashing(spark, docs[::-1]), turned, ~classifier.held_out())
    assert np.array_equal(model.vectors, again.vectors) and np.array_equal(model.bias, again.bias)
    scored = classifier.score(models.clashing(spark, docs[:5]), model, "score2")
    assert scored.columns == [*models.clashing(spark, []).columns, "score2"]
    odds = np.log(1 / (1 / np.array([r.score2 for r in scored.collect()]) - 1))
    assert len(odds) == 5 and np.isfinite(odds).all()


@pytest.mark.parametrize("kind", [0, 1])
def test_classifier_with_one_class(spark, kind):
    docs, _ = labelled(20, 3)
    marks = spark.createDataFrame([(i, kind) for i in range(20)], "doc_id long, quality int")
    got = classifier.classify(models.table(spark, docs), marks).collect()
    assert {r.predicted for r in got} == {kind}
