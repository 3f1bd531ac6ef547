"""Conversation repair against an exhaustive search and a plain dynamic program."""

import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F
from tiffin.llm import conversation_repair, queries

SCHEMA = "conv_id long, turn long, role string, text string"
FORM = re.compile(r"(s?(ua)+)?")


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        draw = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if draw == 1 else re.sub("[.!?]", "", text) if draw == 2 else text
        out += [(conv, turn, "user" if draw == 4 else role, text)] * (0 if draw == 0 else 2 if draw == 3 else 1)
    return out


def faults(rows):
    seen, out = set(), []
    for _, _, role, text in rows:
        end = re.sub(r"[\x20\x09-\x0D]+$", "", text)
        out.append("blank" if not end else "duplicate" if (role, text) in seen else "truncated" if end[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def search(rows, found):
    """Least (cost, audit, messages): per row, messages so far are kept by their form only."""
    follow = {"": "su", "s": "u", "u": "a", "a": "u"}

    def insertions(states):
        for _ in range(2):
            for state, (cost, audit, told) in list(states.items()):
                for role in set(follow[state]) & set("ua"):
                    more = (cost + 5, audit + "I", (told, {"u": "user:", "a": "assistant:"}[role]))
                    if role not in states or more[:2] < states[role][:2]:
                        states[role] = more
        return states

    states = insertions({"": (0, "", None)})
    for (_, _, role, text), fault in zip(rows, found):
        after = {}
        for state, (cost, audit, told) in states.items():
            choices = [(2, "D", state, told)]
            if fault not in ("blank", "duplicate"):
                late = 5 if fault == "truncated" else 0
                choices += [(late, "K", i, (told, f"{role}:{text}")) for i in follow[state] if role[:1] == i]
                choices += [(late + 1, "R", i, (told, f"{n}:{text}")) for i, n in (("u", "user"), ("a", "assistant")) if i in follow[state]]
            for more, edit, new, way in choices:
                own = (cost + more, audit + edit, way)
                if new not in after or own[:2] < after[new][:2]:
                    after[new] = own
        states = insertions(after)
    cost, audit, told = min((states[s] for s in ("", "a") if s in states), key=lambda x: x[:2])
    lines = []
    while told:
        told, line = told
        lines.append(line)
    return cost, audit, "\n".join(reversed(lines))


def order(row):
    conv, turn, role, text = row
    return turn is not None, turn or 0, role, text[:64], hashlib.sha256(text.encode()).hexdigest()


def model(rows, plant=True):
    groups = {r[0]: [] for r in rows}
    for r in damaged(rows) if plant else [(c, t, " " if a is None else a, " " if b is None else b) for c, t, a, b in rows]:
        groups[r[0]].append(r)
    out = {}
    for conv, own in groups.items():
        own.sort(key=order)
        found, turns = faults(own), {t for _, t, _, _ in own if t is not None}
        initials = [r[:1] for _, _, r, _ in own]
        cost, audit, told = search(own, found)
        out[conv] = (
            max(turns) - min(turns) + 1 - len(turns) if turns else 0, *(found.count(k) for k in ("blank", "duplicate", "truncated")),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit, hashlib.sha256(told.encode()).hexdigest(),
        )
    return out


def result(df):
    return {r.conv_id: tuple(r)[1:] for r in conversation_repair.repaired(df).collect()}


def test_model_is_exhaustive():
    """The plain program against all edit sequences of up to three rows with at most two inserts at a place."""
    rng = random.Random(5)
    for _ in range(150):
        rows = [(0, k, rng.choice(["system", "user", "assistant", "tool"]), rng.choice(["a.", "b", "", f"c{k}!"])) for k in range(rng.randint(0, 3))]
        found, best = faults(rows), None
        gaps = ["", "u", "a", "ua", "au"]
        per_row = [["D"] + (["K", "Ru", "Ra"] if f not in ("blank", "duplicate") else []) for f in found]
        for inserts in itertools.product(gaps, repeat=len(rows) + 1):
            for edits in itertools.product(*per_row):
                initials, audit, cost = inserts[0], "I" * len(inserts[0]), 5 * sum(map(len, inserts))
                for (_, _, role, _), fault, edit, more in zip(rows, found, edits, inserts[1:]):
                    initials += {"D": "", "K": role[:1], "Ru": "u", "Ra": "a"}[edit] + more
                    audit += edit[0] + "I" * len(more)
                    cost += {"D": 2, "K": 0, "R": 1}[edit[0]] + (5 if fault == "truncated" and edit != "D" else 0)
                if FORM.fullmatch(initials) and (best is None or (cost, audit) < best):
                    best = (cost, audit)
        assert search(rows, found)[:2] == best


def test_registered(spark):
    folder = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = {r.conv_id: tuple(r)[1:] for r in queries.QUERIES["op12_conversation_repair"](spark, folder).collect()}
    assert got == model(rows)


def conversations(rng, n, longest):
    texts = ["Yes.", "no", "What?", "", " \n", None, "A longer one!\n", "x" * 70 + ".", "x" * 70 + "!"]
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "", None, "unknown"]
    rows = []
    for conv in range(n):
        for turn in range(rng.randint(1, longest)):
            text = rng.choice(texts) if rng.random() < 0.3 else f"{turn} said{rng.choice(['.', '', '!'])}"
            role = rng.choice(roles) if rng.random() < 0.3 else ("assistant" if turn % 2 else "user")
            rows.append((conv or None, rng.choice([turn, None, 3]) if rng.random() < 0.1 else turn, role, text))
    return rows


def test_awkward_rows(spark):
    rows = conversations(random.Random(3), 60, 12)
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"conv": F.lit(1), "place": F.lit(2), "edit": F.lit("x"), "cell": F.lit(None).cast("int"), "pos": F.lit(4)})
    assert result(df) == model(rows)
    assert conversation_repair.repaired(df.limit(0)).collect() == []


def test_chunks_and_groups(spark, monkeypatch):
    """Conversations of many chunks, over several slices: as if the agenda had seen them whole."""
    monkeypatch.setattr(conversation_repair, "CHUNK_BITS", 2)
    monkeypatch.setattr(conversation_repair, "GROUP", 3)
    rows = conversations(random.Random(4), 5, 300)
    assert result(spark.createDataFrame(rows, SCHEMA).repartition(3)) == model(rows)


def test_one_conversation_with_most_rows(spark):
    rng = random.Random(6)
    rows = [(1, k, rng.choice(["user", "assistant"]), f"{rng.randint(0, 4000)}{rng.choice('.!?x')}") for k in range(3000)] + [(2, 0, "user", "Long é. " * 300_000)]
    assert result(spark.createDataFrame(rows, SCHEMA)) == model(rows)


def test_messages_and_report(spark):
    rows = [(1, 0, "user", "Hi."), (1, 1, "user", "Hi."), (1, 2, "user", "Well?"), (1, 5, "bot", "So it is.")]
    messages, report = conversation_repair.repair(spark.createDataFrame(rows, SCHEMA))
    told = [(r.role, r.text, r.edit) for r in messages.orderBy("place", "step").collect()]
    cost, audit, lines = search(rows, faults(rows))
    assert audit == report.first().audit and "\n".join(f"{r}:{t}" for r, t, _ in told) == lines and report.first().gaps == 2
    assert [e for *_, e in told] == [e for e in audit if e != "D"] and cost == report.first().cost


@pytest.mark.parametrize("audit, initials, state, want", [
    ("KIK", "sa", 0, [("K", None, [], []), ("K", None, ["user"], [])]),
    ("DRI", "uu", 3, [("D", None, [], []), ("R", "user", [], ["assistant"])]),
])
def test_edits_of_an_audit(audit, initials, state, want):
    assert conversation_repair.applied(audit, list(initials), state) == want
