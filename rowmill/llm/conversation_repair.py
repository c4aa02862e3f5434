"""Cheapest repairs of broken conversations, by a dynamic program that keeps its costs only at checkpoints."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import isqrt

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from rowmill.llm.common import remembered, written

#: White space: a text of nothing else is blank, and it does not count at a text's end.
BLANK = "\x20\x09\x0a\x0b\x0c\x0d"
#: What a whole text ends with.
ENDS = ".!?"
KEEP, REROLE, DELETE, INSERT, CUT_OFF = 0, 3, 4, 3, 3
#: A row's code is four times its fault plus the initial of its role.
CLEAN, BLANK_TEXT, REPEATED, TRUNCATED = range(4)
OTHER, SYSTEM, USER, ASSISTANT = range(4)
#: States of a conversation that is built up: nothing yet, or the last role; it may end in the first and the last one.
START, AFTER_SYSTEM, AFTER_USER, AFTER_ASSISTANT = range(4)
FAR = 1 << 40
#: What an inserted row or one with a new role is in each state; the state after it has the same number.
NEEDED = (USER, USER, ASSISTANT, USER)
NAMES = {USER: "user", ASSISTANT: "assistant"}
INITIALS = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
LEGAL = ((SYSTEM, USER), (USER, ASSISTANT), (ASSISTANT, USER))
ROWS_AT_ONCE = 2000


def repairs(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per conversation of ``rows``: ``conv, gaps, blank, duplicate, truncated, illegal, cost, audit``.

    Rows are taken by turn (nulls first); rows of one turn by the digest of role and text, equal ones beside each other.
    A row's first fault counts: blank text, role and text seen earlier, no ``.!?`` at the end. ``gaps`` are the missing
    turns between the first and the last, ``illegal`` the neighbours whose roles may not follow each other.

    ``audit`` has the initials of the cheapest edits, in order, after which the roles read ``(s?(ua)+)?``: Keep (0),
    Rerole to user or assistant (3), Delete (4; blank and repeated rows must go), Insert an empty row (3); a truncated
    row that stays costs 3 more. Of equally cheap edits the ASCII-least ones.

    Conversations are shuffled without their texts and each is streamed through one task, which holds a byte per row
    (the audit has as many) and cost vectors at the square root of its rows. Null ids are one conversation, a null role
    or text is an empty one. Further columns of ``rows`` play no part. No rows give no rows.
    """
    facts = _facts(rows, conv, turn, role, text).drop("role", "text")
    initial = F.coalesce(*(F.when(F.col("initial") == k, F.lit(v)) for k, v in INITIALS.items()), F.lit(OTHER))
    fault = F.when(F.col("blank"), BLANK_TEXT).when(F.col("nth") > 1, REPEATED).when(~F.col("whole"), TRUNCATED).otherwise(CLEAN)
    # one shuffle by conversation serves the window over equal rows and the order by turn
    numbered = facts.repartition("conv").selectExpr("*", "row_number() OVER (PARTITION BY conv, digest ORDER BY turn) AS nth")
    coded = numbered.sortWithinPartitions("conv", "turn", "digest", "nth").select("conv", "turn", (4 * fault + initial).cast("int").alias("code"))
    kind = coded.schema["conv"].dataType.simpleString()
    counts = ", ".join(f"{name} long" for name in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost"))
    return coded.mapInArrow(_repair_each, f"conv {kind}, {counts}, audit string").withColumnRenamed("conv", conv)


def repaired(rows: DataFrame, found: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The conversations after the edits of ``found`` (of :func:`repairs`): ``conv, place, role, text, edit``.

    ``place`` counts from 0, ``edit`` tells a kept row (K) from one with a new role (R) and an inserted one (I).
    """
    stream, kind = _with_audits(rows, found, conv, turn, role, text)
    return stream.mapInArrow(_edit_each, f"conv {kind}, place long, role string, text string, edit string").withColumnRenamed("conv", conv)


def fingerprints(rows: DataFrame, found: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``(conv, repaired_sha256)``: the SHA-256 of each repaired conversation's ``role:text`` lines."""
    stream, kind = _with_audits(rows, found, conv, turn, role, text)
    return stream.mapInArrow(_hash_each, f"conv {kind}, repaired_sha256 string").withColumnRenamed("conv", conv)


def repaired_conversations(rows: DataFrame, ids: DataFrame, conv: str = "conv_id") -> DataFrame:
    """:func:`repairs` with :func:`fingerprints` for every id of ``ids``; one without rows has nothing to repair."""
    found = written(repairs(rows, conv), "repairs")
    both = found.join(fingerprints(rows, found, conv).withColumnRenamed(conv, "of"), F.col("of").eqNullSafe(F.col(conv))).drop("of")
    every = ids.select(F.col(conv).alias("of")).distinct()
    joined = every.join(both, F.col("of").eqNullSafe(F.col(conv)), "left")
    counts = [F.coalesce(F.col(name), F.lit(0)).alias(name) for name in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    nothing = hashlib.sha256().hexdigest()
    return joined.select(
        F.col("of").alias(conv), *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(nothing)).alias("repaired_sha256")
    )


def damaged(rows: DataFrame) -> DataFrame:
    """``(conv_id, turn, role, text)`` with every fourth row or so spoilt, chosen by its id and turn."""
    one = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    chance = F.crc32(F.concat(one("conv_id"), F.lit(":"), one("turn"))) % 20
    text = F.when(chance == 1, "").when(chance == 2, F.translate(one("text"), ENDS, "")).otherwise(one("text"))
    role = F.when(chance == 4, "user").otherwise(one("role"))
    times = F.when(chance == 0, 0).when(chance == 3, 2).otherwise(1)
    spoilt = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"), times.alias("times"))
    return spoilt.withColumn("copy", F.explode(F.array_repeat(F.lit(0), F.col("times")))).drop("times", "copy")


def _facts(rows: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    of = lambda name: rows[f"`{name}`"]
    role_, text_ = (F.coalesce(of(name).cast("string"), F.lit("")) for name in (role, text))
    end = F.rtrim(text_, F.lit(BLANK))
    last: Column = F.substring(end, -1, 1)
    return rows.select(
        of(conv).alias("conv"),
        of(turn).cast("long").alias("turn"),
        F.sha2(F.concat(F.char_length(role_).cast("string"), F.lit(":"), role_, text_), 256).alias("digest"),
        F.substring(role_, 1, 1).alias("initial"),
        (end == "").alias("blank"),
        last.isin(*ENDS).alias("whole"),
        role_.alias("role"),
        text_.alias("text"),
    )


def _with_audits(rows: DataFrame, found: DataFrame, conv: str, turn: str, role: str, text: str) -> tuple[DataFrame, str]:
    """The rows of each conversation in order, behind one that holds its audit."""
    told = _facts(rows, conv, turn, role, text).select("conv", F.lit(None).cast("string").alias("audit"), "turn", "digest", "role", "text")
    audits = found.select(found[f"`{conv}`"].alias("conv"), "audit", *(F.lit(None).cast(kind).alias(name) for name, kind in told.dtypes[2:]))
    ordered = told.union(audits).repartition("conv").sortWithinPartitions("conv", F.col("audit").isNull(), "turn", "digest")
    return ordered.select("conv", "audit", "role", "text"), told.schema["conv"].dataType.simpleString()


def _closed(costs: list[int]) -> list[int]:
    """Costs of the rest when rows may be inserted first."""
    for _ in range(2):  # from any state at most two inserts are of use
        costs = [min(costs[s], INSERT + costs[NEEDED[s]]) for s in range(4)]
    return costs


END = tuple(_closed([0, FAR, FAR, 0]))


def _edits(code: int, state: int) -> list[tuple[str, int, int]]:
    """What may be done with a row in a state: initial, cost, next state; in ASCII order."""
    fault, initial = divmod(code, 4)
    found = [("D", DELETE, state)]
    if fault in (CLEAN, TRUNCATED):
        more = CUT_OFF if fault == TRUNCATED else 0
        if initial == NEEDED[state] or (initial == SYSTEM and state == START):
            found.append(("K", KEEP + more, initial))
        found.append(("R", REROLE + more, NEEDED[state]))
    return found


@remembered
def before(code: int, after: tuple[int, ...]) -> tuple[tuple[int, ...], int]:
    """The costs before a row from those after it, less their minimum, which comes beside them."""
    costs = _closed([min(cost + after[to] for _, cost, to in _edits(code, state)) for state in range(4)])
    least = min(costs)
    return tuple(c - least for c in costs), least


@remembered
def walk(code: int, after: tuple[int, ...]) -> tuple[tuple[str, int], ...]:
    """For each state before a row the ASCII-least tight edits up to and with it, and the state after it."""
    costs, least = before(code, after)
    found = []
    for state in range(4):
        done = ""
        while True:
            tight = {e: to for e, cost, to in _edits(code, state) if cost + after[to] == costs[state] + least}
            if INSERT + costs[NEEDED[state]] == costs[state]:
                tight["I"] = NEEDED[state]
            edit = min(tight)
            done, state = done + edit, tight[edit]
            if edit != "I":
                break
        found.append((done, state))
    return tuple(found)


def cheapest(codes: bytes | bytearray) -> tuple[int, str]:
    """Cost and audit of a conversation whose rows have these codes.

    Costs are worked out from the end to the front and kept only at every block's end; walking to the front's opposite
    end, each block's costs are worked out again from there.
    """
    size = max(1, isqrt(len(codes)))
    kept, costs, total = [], END, 0
    for at in range(len(codes) - 1, -1, -1):
        if (at + 1) % size == 0 or at == len(codes) - 1:
            kept.append(costs)
        costs, least = before(codes[at], costs)
        total += least
    total, state, audit = total + costs[START], START, []
    for start in range(0, len(codes), size):
        block, after = codes[start : start + size], [kept.pop()]
        for code in reversed(block[1:]):
            after.append(before(code, after[-1])[0])
        for code in block:
            edits, state = walk(code, after.pop())[state]
            audit.append(edits)
    while END[state]:
        audit.append("I")
        state = NEEDED[state]
    return total, "".join(audit)


def _repair_each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Conversations in order, one after the other, to one row for each."""
    kind, done = None, []
    conv, codes, turns, counts = None, None, None, None

    def result() -> tuple:
        cost, audit = cheapest(codes)
        return (conv, turns[1] - turns[0] + 1 - turns[2] if turns else 0, *counts[1:4], counts[4], cost, audit)

    def handed() -> pa.RecordBatch:
        columns = list(zip(*done))
        types = [kind, *[pa.int64()] * 6, pa.string()]
        names = ["conv", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]
        return pa.record_batch([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    for batch in batches:
        kind = batch.schema.field("conv").type
        for own, turn, code in zip(*(column.to_pylist() for column in batch.columns)):
            if codes is None or own != conv:
                if codes is not None:
                    done.append(result())
                    if len(done) >= ROWS_AT_ONCE:
                        yield handed()
                        done.clear()
                conv, codes, turns, counts = own, bytearray(), None, [0] * 5
            elif (codes[-1] % 4, code % 4) not in LEGAL:
                counts[4] += 1
            counts[code // 4] += 1
            codes.append(code)
            if turn is not None:
                turns = (turns[0], turn, turns[2] + (turn != turns[1])) if turns else (turn, turn, 1)
    if codes is not None:
        done.append(result())
        yield handed()


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """``(conv, None, None, None)`` where a conversation begins, then ``(conv, edit, role, text)`` for each of its rows."""
    conv, audit, at, state = None, "", 0, START

    def inserted() -> Iterator[tuple]:
        nonlocal at, state
        while audit[at : at + 1] == "I":
            at, state = at + 1, NEEDED[state]
            yield conv, "I", NAMES[state], ""

    for batch in batches:
        for own, told, role, text in zip(*(column.to_pylist() for column in batch.columns)):
            if told is not None:
                yield from inserted()
                conv, audit, at, state = own, told, 0, START
                yield conv, None, None, None
                continue
            yield from inserted()
            edit, at = audit[at], at + 1
            if edit == "K":
                state = INITIALS[role[0]]
                yield conv, edit, role, text
            elif edit == "R":
                state = NEEDED[state]
                yield conv, edit, NAMES[state], text
    yield from inserted()


def _typed(batches: Iterator[pa.RecordBatch], types: list) -> Iterator[pa.RecordBatch]:
    """The batches; the type of their first column is noted in ``types``."""
    for batch in batches:
        types[:] = [batch.schema.field("conv").type]
        yield batch


def _edit_each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    types, rows, place, held = [], [], 0, 0

    def handed() -> pa.RecordBatch:
        kinds = [types[0], pa.int64(), pa.string(), pa.string(), pa.string()]
        return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=["conv", "place", "role", "text", "edit"])

    for conv, edit, role, text in _edited(_typed(batches, types)):
        if edit is None:
            place = 0
            continue
        rows.append((conv, place, role, text, edit))
        place, held = place + 1, held + len(text)
        if len(rows) >= ROWS_AT_ONCE or held > 8 << 20:
            yield handed()
            rows, held = [], 0
    if rows:
        yield handed()


def _hash_each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    types, done, hashed, started = [], [], None, False

    def handed() -> pa.RecordBatch:
        return pa.record_batch([pa.array([c for c, _ in done], types[0]), pa.array([h for _, h in done], pa.string())], names=["conv", "repaired_sha256"])

    conv = None
    for own, edit, role, text in _edited(_typed(batches, types)):
        if edit is None:
            if hashed:
                done.append((conv, hashed.hexdigest()))
                if len(done) >= ROWS_AT_ONCE:
                    yield handed()
                    done = []
            conv, hashed, started = own, hashlib.sha256(), False
            continue
        hashed.update(f"{chr(10) if started else ''}{role}:{text}".encode())
        started = True
    if hashed:
        done.append((conv, hashed.hexdigest()))
    if done:
        yield handed()
