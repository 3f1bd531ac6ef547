"""Repair of conversations to the form ``(s?(ua)+)?`` of role initials, by Knuth's lightest derivation.

Items are deduced from items: (row, state) says that the rows so far are repaired and the messages so far end in a state of the form; one
more edit deduces the next item. An item weighs (cost, audit): the audit is the edits' initials in order, and an edit adds its cost and appends its
initial. That is monotone and superior (the sum never falls, a longer audit is greater), so the agenda may finalise the least item it holds, until
the goals are final. Two audits over the same rows and of one cost are never the beginning of each other (the longer one would have more inserts
and so a greater cost), therefore the order also survives when spans of rows are joined.

A conversation may have any number of rows: rows are sorted over slices and cut in chunks of at most 256, the agenda runs per chunk from every state
the chunk may start in, and again over 64 spans of chunks at a time until one span is left. The way back gives each chunk its
two states and with them its edits. Only initials, flags and audits move on this way; texts are joined to the edits by row at the end.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from hashlib import sha256
from heapq import heappop, heappush

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tiffin.llm import text
from tiffin.llm.merkle import numbered
from tiffin.operators import windows

CHUNK_BITS = 8  # 256 rows
GROUP = 64  # spans composed at a time
SPACES = " \t\n\x0b\x0c\r"

START, SYSTEM, USER, ASSISTANT = range(4)  # nothing yet, or the last message's role
NEXT = {START: {"s": SYSTEM, "u": USER}, SYSTEM: {"u": USER}, USER: {"a": ASSISTANT}, ASSISTANT: {"u": USER}}
GOALS = (START, ASSISTANT)
ROLES = {USER: "user", ASSISTANT: "assistant"}
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5  # costs; the last for a truncated row that stays
SOUND, LOST, OPEN = range(3)  # a row without fault, one that has to go (blank or duplicate), a truncated one

Weight = tuple[int, str]


def row_edits(initial: str, fault: int, state: int) -> list[tuple[int, int, str]]:
    """State after the row, cost and initial of the edits of one row."""
    edits = [(state, DELETE, "D")]
    if fault != LOST:
        more = TRUNCATED if fault == OPEN else 0
        edits += [(after, KEEP + more, "K") for i, after in NEXT[state].items() if i == initial]
        edits += [(after, REROLE + more, "R") for after in NEXT[state].values() if after in ROLES]
    return edits


EDITS = {(i, f, s): row_edits(i, f, s) for i in ("s", "u", "a", "") for f in (SOUND, LOST, OPEN) for s in NEXT}
INSERTS = {s: [(after, INSERT, "I") for after in NEXT[s].values() if after in ROLES] for s in NEXT}


def lightest(axiom: tuple[int, int], rules: Callable[[int, int], Iterable[tuple[int, int, int, str]]], goals: set) -> dict:
    """Final weight of the items that the agenda pops until all goals are final, each with the item it came from.

    Items are (place, state). ``rules`` gives, for an item, the deductions it takes part in: place and state of what follows, with
    the cost and the audit that the other premise (an edit or a span) adds.
    """
    agenda, final, left = [(0, "", *axiom, -1)], {}, set(goals)
    while agenda and left:
        cost, audit, place, state, source = heappop(agenda)
        if (place, state) in final:
            continue
        final[place, state] = (cost, audit, source)
        left.discard((place, state))
        for further, after, more, appended in rules(place, state):
            if (further, after) not in final:
                heappush(agenda, (cost + more, audit + appended, further, after, 4 * place + state))
    return final


def spans_of_rows(rows: Sequence[tuple[str, int]], starts: Iterable[int]) -> dict[tuple[int, int], Weight]:
    """Lightest (cost, audit) from each start state to each end state over rows of (initial, fault)."""
    kinds = [(i if i in ("s", "u", "a") else "", f) for i, f in rows]
    n, spans = len(kinds), {}

    def rules(place: int, state: int):
        for after, cost, initial in INSERTS[state]:
            yield place, after, cost, initial
        if place < n:
            for after, cost, initial in EDITS[*kinds[place], state]:
                yield place + 1, after, cost, initial

    for start in starts:
        final = lightest((0, start), rules, {(n, s) for s in NEXT if s >= min(start, 1)})
        spans.update({(start, s): final[n, s][:2] for s in NEXT if (n, s) in final})
    return spans


def composed(members: Sequence[dict[tuple[int, int], Weight]], start: int) -> dict:
    """Final items over consecutive spans from a start state."""
    n = len(members)

    def rules(place: int, state: int):
        if place < n:
            for (before, after), (cost, audit) in members[place].items():
                if before == state:
                    yield place + 1, after, cost, audit

    return lightest((0, start), rules, {(n, s) for s in NEXT})


def steps(members: Sequence[dict[tuple[int, int], Weight]], start: int, end: int) -> list[tuple[int, int]]:
    """The two states of each member on the lightest way from start to end."""
    final, at, out = composed(members, start), (len(members), end), []
    while at[0]:
        before = divmod(final[at][2], 4)
        out.append((before[1], at[1]))
        at = before
    return out[::-1]


def applied(audit: str, initials: Sequence[str], state: int) -> list[tuple[str, str | None, list[str], list[str]]]:
    """Per row: its edit, the role it gets (None: as it is), and the roles inserted before and, behind the last row, after it."""
    out, waiting, row = [], [], 0
    for edit in audit:
        if edit != "D":
            state = SYSTEM if edit == "K" and initials[row] == "s" else ASSISTANT if state == USER else USER
        if edit == "I":
            waiting.append(ROLES[state])
            continue
        out.append((edit, ROLES[state] if edit == "R" else None, waiting, []))
        waiting, row = [], row + 1
    if out:
        out[-1][3].extend(waiting)
    return out


def illegal(initials: Sequence[str]) -> int:
    return sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))


SPAN = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))
SPANS = "array<struct<start: int, end: int, cost: bigint, audit: string>>"


def packed(spans: dict[tuple[int, int], Weight]) -> list[dict]:
    return [{"start": p, "end": q, "cost": cost, "audit": audit} for (p, q), (cost, audit) in spans.items()]


def unpacked(spans: list[dict]) -> dict[tuple[int, int], Weight]:
    return {(s["start"], s["end"]): (s["cost"], s["audit"]) for s in spans}


def with_columns(df: DataFrame, function: Callable[[pa.RecordBatch], dict[str, pa.Array]], added: str) -> DataFrame:
    """``df`` with the columns that a function makes of each Arrow batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            new = function(batch)
            yield pa.RecordBatch.from_arrays([*batch.columns, *new.values()], [*batch.schema.names, *new])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    return df.mapInArrow(run, f"{kinds}, {added}")


SOLVED = f"spans {SPANS}, first string, last string, illegal bigint"


def solved(batch: pa.RecordBatch) -> dict[str, pa.Array]:
    """Spans of each chunk; the first chunk of a conversation only starts with nothing."""
    spans, ends, wrong = [], [], []
    for rows, place in zip(batch.column("rows").to_pylist(), batch.column("place").to_pylist()):
        own = [(r["initial"], r["fault"]) for r in rows]
        initials = [i for i, _ in own]
        spans.append(packed(spans_of_rows(own, NEXT if place else (START,))))
        ends.append((initials[0], initials[-1]))
        wrong.append(illegal(initials))
    return {
        "spans": pa.array(spans, SPAN), "first": pa.array([a for a, _ in ends], pa.string()), "last": pa.array([b for _, b in ends], pa.string()),
        "illegal": pa.array(wrong, pa.int64()),
    }


def joined(batch: pa.RecordBatch) -> dict[str, pa.Array]:
    """Spans of each group of spans."""
    spans, ends, wrong = [], [], []
    for members, block in zip(batch.column("members").to_pylist(), batch.column("block").to_pylist()):
        own, out = [unpacked(m["spans"]) for m in members], {}
        for start in NEXT if block else (START,):
            final = composed(own, start)
            out.update({(start, s): final[len(own), s][:2] for s in NEXT if (len(own), s) in final})
        spans.append(packed(out))
        ends.append((members[0]["first"], members[-1]["last"]))
        wrong.append(sum(m["illegal"] for m in members) + sum(illegal((a["last"], b["first"])) for a, b in zip(members, members[1:])))
    return {
        "spans": pa.array(spans, SPAN), "first": pa.array([a for a, _ in ends], pa.string()), "last": pa.array([b for _, b in ends], pa.string()),
        "illegal": pa.array(wrong, pa.int64()),
    }


def traced(batch: pa.RecordBatch) -> dict[str, pa.Array]:
    """States of each member, given those of the group."""
    out = []
    for members, start, end in zip(*(batch.column(c).to_pylist() for c in ("members", "start", "end"))):
        ways = steps([unpacked(m["spans"]) for m in members], start, end)
        out.append([{"place": m["place"], "start": p, "end": q} for m, (p, q) in zip(members, ways)])
    return {"ways": pa.array(out, pa.list_(pa.struct([("place", pa.int64()), ("start", pa.int32()), ("end", pa.int32())])))}


EDITED = "pos bigint, edit string, new_role string, before array<string>, after array<string>"


def edited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The edit of each row, by its position."""
    for batch in batches:
        out = []
        for rows, spans, start, end in zip(*(batch.column(c).to_pylist() for c in ("rows", "spans", "start", "end"))):
            edits = applied(unpacked(spans)[start, end][1], [r["initial"] for r in rows], start)
            out += [(r["_pos"], *edit) for r, edit in zip(rows, edits)]
        kinds = (pa.int64(), pa.string(), pa.string(), pa.list_(pa.string()), pa.list_(pa.string()))
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(list(zip(*out)) or [[]] * 5, kinds)], ["pos", "edit", "new_role", "before", "after"])


def judged(rows: DataFrame) -> DataFrame:
    """``conv, _pos, turn, initial, blank, duplicate, truncated`` of sorted rows: each row's first fault.

    A row's fault needs the first row of its role and text only, so repeated texts are counted before they move.
    """
    digest = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256)
    end = F.rtrim("text", F.lit(SPACES))
    own = rows.select("conv", "_pos", "turn", F.substring("role", 1, 1).alias("initial"), digest.alias("digest"), (end == "").alias("blank"), F.right(end, F.lit(1)).isin(".", "!", "?").alias("closed"))
    own = text.durable(own, "faults")
    firsts = own.groupBy("conv", "digest").agg(F.min("_pos").alias("_first")).select("_first")
    seen = own.join(firsts, F.col("_pos") == F.col("_first"), "left").withColumn("duplicate", ~F.col("blank") & F.col("_first").isNull())
    return seen.withColumn("truncated", ~F.col("blank") & ~F.col("duplicate") & ~F.col("closed")).drop("_first", "digest", "closed")


def repair(
    rows: DataFrame, conversation: str = "conv_id", order: str = "turn", role: str = "role", text_column: str = "text"
) -> tuple[DataFrame, DataFrame]:
    """The repaired messages and a report per conversation.

    Messages are ``conversation, place, step, role, text, edit`` (place and step give the order; edit is K, R or I). The report is ``conversation, gaps, blank,
    duplicate, truncated, illegal, cost, audit``. Rows are taken by order (nulls first), then role, the first 64 characters of the text, and its digest; equal rows are
    rows of their own, the later ones duplicates. A null role or text is one space, so a null text is blank; a role without a legal
    initial is rerolled or deleted. A null conversation is one, too. Other columns are left out, whatever their names. No rows give no rows.
    """
    spark = rows.sparkSession
    text.prepared(spark)
    plain = rows.select(
        F.col(f"`{conversation}`").alias("conv"), F.col(f"`{order}`").alias("turn"),
        F.coalesce(F.col(f"`{role}`"), F.lit(" ")).alias("role"), F.coalesce(F.col(f"`{text_column}`"), F.lit(" ")).alias("text"),
    )
    placed = windows.ordered(plain, ["conv"], [F.col("turn"), F.col("role"), F.substring("text", 1, 64), F.sha2("text", 256)])
    faults = text.durable(judged(placed), "judged")
    kind = F.when(F.col("blank") | F.col("duplicate"), LOST).when(F.col("truncated"), OPEN).otherwise(SOUND)
    cut = faults.groupBy("conv", F.shiftright("_pos", CHUNK_BITS).alias("cell")).agg(F.sort_array(F.collect_list(F.struct("_pos", "initial", kind.alias("fault")))).alias("rows"))
    chunks = text.durable(with_columns(numbered(cut, ["conv"], ["cell"]), solved, SOLVED), "chunks")

    rounds, rest = [], chunks.select("conv", "place", "total", "spans", "first", "last", "illegal")
    while (rest.agg(F.max("total")).first()[0] or 0) > 1:
        member = F.struct("place", "spans", "first", "last", "illegal")
        groups = rest.groupBy("conv", F.floor(F.col("place") / GROUP).cast("bigint").alias("block")).agg(
            F.ceil(F.max("total") / GROUP).cast("bigint").alias("total"), F.sort_array(F.collect_list(member), asc=True).alias("members")
        )
        rounds.append(text.durable(with_columns(groups, joined, SOLVED), "spans"))
        rest = rounds[-1].select("conv", F.col("block").alias("place"), "total", "spans", "first", "last", "illegal")

    goals = F.filter("spans", lambda s: s["end"].isin(*GOALS))
    best = F.array_min(F.transform(goals, lambda s: F.struct(s["cost"].alias("cost"), s["audit"].alias("audit"), s["end"].alias("end"))))
    whole = rest.select("conv", "illegal", best.alias("best")).select("conv", "illegal", "best.*")
    ways = whole.select("conv", F.lit(0).cast("bigint").alias("place"), F.lit(START).alias("start"), "end")
    for groups in reversed(rounds):
        chosen = windows.join_beside(groups.select("conv", "block", "members"), ways.withColumnRenamed("place", "block"), ["conv", "block"])
        found = with_columns(chosen, traced, "ways array<struct<place: bigint, start: int, end: int>>")
        ways = text.durable(found.select("conv", F.inline("ways")), "ways")
    edits = windows.join_beside(chunks.select("conv", "place", "rows", "spans"), ways, ["conv", "place"]).mapInArrow(edited, EDITED)

    own = F.array(F.struct(F.coalesce("new_role", "role").alias("role"), F.col("text"), F.col("edit")))
    inserted = lambda roles: F.transform(roles, lambda r: F.struct(r.alias("role"), F.lit("").alias("text"), F.lit("I").alias("edit")))
    told = F.concat(inserted(F.col("before")), F.when(F.col("edit") != "D", own).otherwise(F.slice(own, 1, 0)), inserted(F.col("after")))
    messages = placed.join(edits, F.col("_pos") == F.col("pos")).select(F.col("conv").alias(conversation), F.col("_pos").alias("place"), F.posexplode(told).alias("step", "own"))

    turns = faults.groupBy("conv", "turn").agg(*[F.sum(F.col(c).cast("bigint")).alias(c) for c in ("blank", "duplicate", "truncated")])  # a turn has one row of this
    gaps = F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).cast("bigint")
    counted = turns.groupBy("conv").agg(gaps.alias("gaps"), *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")])
    report = windows.join_beside(counted, whole.drop("end"), ["conv"])
    return messages.select(conversation, "place", "step", "own.*"), report.withColumnRenamed("conv", conversation)


def digests(messages: DataFrame, conversation: str = "conv_id") -> DataFrame:
    """``conversation, repaired_sha256`` of ``role:text`` of the messages in order, joined by line ends.

    A digest reads its conversation from front to back, so this is the one step where a conversation meets in one task; it streams through, message by
    message.
    """
    kind = messages.schema[conversation].dataType.simpleString()
    lines = messages.select(F.col(f"`{conversation}`").alias("conv"), "place", "step", F.concat("role", F.lit(":"), "text").alias("line"))

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, now = None, None
        for batch in batches:
            ids, done = [], []
            for conv, line in zip(batch.column("conv").to_pylist(), batch.column("line").to_pylist()):
                if state is None or conv != now:
                    if state is not None:
                        ids.append(now)
                        done.append(state.hexdigest())
                    state, now = sha256(line.encode()), conv
                else:
                    state.update(b"\n" + line.encode())
            if ids:
                yield pa.RecordBatch.from_arrays([pa.array(ids, batch.schema.field("conv").type), pa.array(done, pa.string())], ["conv", "repaired_sha256"])
            last = batch.schema.field("conv").type
        if state is not None:
            yield pa.RecordBatch.from_arrays([pa.array([now], last), pa.array([state.hexdigest()], pa.string())], ["conv", "repaired_sha256"])

    sorted_lines = lines.repartition("conv").sortWithinPartitions("conv", "place", "step")
    return sorted_lines.mapInArrow(stream, f"conv {kind}, repaired_sha256 string").withColumnRenamed("conv", conversation)


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows with planted faults, by the crc32 of ``conv_id:turn`` modulo 20; nulls count as one space, a null turn stays one."""

    def told(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    draw = (F.crc32(F.concat(told("conv_id"), F.lit(":"), told("turn")).cast("binary")) % 20).cast("int")
    rows = conversations.select("conv_id", "turn", told("role").alias("role"), told("text").alias("text"), draw.alias("draw")).where("draw != 0")
    body = F.when(F.col("draw") == 1, F.lit("")).when(F.col("draw") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    copies = F.explode(F.when(F.col("draw") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    role = F.when(F.col("draw") == 4, F.lit("user")).otherwise(F.col("role"))
    return rows.select("conv_id", "turn", role.alias("role"), body.alias("text"), copies.alias("copy")).drop("copy")


def repaired(conversations: DataFrame) -> DataFrame:
    """``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256`` of every conversation, after planted damage and repair.

    A conversation that the damage leaves no rows has zeros, an empty audit and the digest of the empty text. No rows give no rows.
    """
    messages, report = repair(damaged(conversations))
    every = conversations.select("conv_id").distinct()
    found = windows.join_beside(windows.join_beside(every, report, ["conv_id"], "left"), digests(messages), ["conv_id"], "left")
    zero = [F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return found.select("conv_id", *zero, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))
