"""Conversation structure repair: the cheapest edits that make a conversation's roles an optional system turn and pairs of user and assistant.

A state says which role may come next; a state-cost vector has the least cost from a place to the end for each state. Vectors are
kept only at checkpoints: every block of a conversation has one where it ends, and inside a block one vector is kept for each of about
sqrt(n) pieces. Walking forward, the vectors of a piece are computed again from its end and the tight edit with the
least letter is taken.

Rows travel as a code (first letter of the role, fault) and a count of equal rows; they lie in ranges of conversation and turn, so that a
conversation of any size is dealt to many tasks, in blocks of at most BLOCK codes. A block gives the least costs between its states as a
4 by 4 matrix; the matrices, few numbers a block, are passed from the last to the first to set each block's end vector, and each block then walks
from all four states, of which a pass from the first to the last takes the one that applies. Only the hash of the
repaired text needs a conversation's rows one after the other: they stream, sorted on disk, through one task that holds the conversation's edits and a batch.

Defined cases: nulls in text, role, turn (in the key of the damage) and conv_id (likewise) read as one space; the conv_id stays null in the
result, as a conversation of its own. Turns that are null come first and count for no gap. Rows of the same turn go by role, then by the SHA-256 of their
text; repeated rows are adjacent, and all but the first are duplicates. A role that begins with none of s, u and a (or is empty) can't be kept. An empty table
gives an empty result. Other columns aren't read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from math import isqrt

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

from .common import stored

#: Codes of a conversation in a block, at most.
BLOCK = 16384
#: Costs of the edits; KEEP costs nothing.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: States: nothing yet, after a system turn, after a user turn, after an assistant turn.
NEW, SYSTEM, USER, ASSISTANT = range(4)
NEXT = {"u": USER, "a": ASSISTANT}
#: The role that a state asks for, the state after it, and the states in which a conversation may end.
WANTED = ("u", "u", "a", "u")
AFTER = (USER, USER, ASSISTANT, USER)
FULL = {"u": "user", "a": "assistant"}
INFINITE = 1 << 60
#: What is inserted after the last row in each state; no cost or letter where the conversation may end.
TAIL = ("", "II", "I", "")
LEGAL = ("su", "ua", "au")
#: A word's character, and the ends of sentences.
WORD, ENDS = "[^\\x20\\x09-\\x0D]", "[.!?]"

Code = tuple[str, bool, bool, int]
Vector = tuple[int, int, int, int]


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and copies (0: dropped, 2: repeated) after the damage that a row's conversation and turn decide."""
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    kind, role, text = F.crc32(key) % 20, F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    return conversations.select(
        "conv_id",
        "turn",
        F.when(kind == 4, F.lit("user")).otherwise(role).alias("role"),
        F.when(kind == 1, F.lit("")).when(kind == 2, F.regexp_replace(text, ENDS, "")).otherwise(text).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"),
    )


def ordered_by() -> list[Column]:
    return [F.asc_nulls_first(c) for c in ("conv_id", "turn", "role", "digest")]


def coded(rows: DataFrame) -> DataFrame:
    """One row for equal rows of a turn: conv_id, turn, role, digest, initial, blank, duplicate (all of them), truncated, copies."""
    equal = rows.groupBy("conv_id", "turn", "role", "digest").agg(F.sum("copies").alias("copies"), F.first("blank").alias("blank"), F.first("truncated").alias("truncated"))
    place = F.struct(F.col("turn").isNotNull().alias("late"), "turn")
    earliest = equal.where("copies > 0").groupBy(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("digest").alias("d")).agg(F.min(place).alias("earliest"))
    same = equal["conv_id"].eqNullSafe(earliest["c"]) & (equal["role"] == earliest["r"]) & (equal["digest"] == earliest["d"])
    return equal.join(earliest, same, "left").select(
        "conv_id", "turn", "role", "digest", F.substring("role", 1, 1).alias("initial"), "blank", (place > F.col("earliest")).alias("duplicate"), "truncated", "copies"
    )


def step(code: Code, after: Vector) -> Vector:
    """The vector before a row, from the one after it, with what may be inserted before the row."""
    initial, must_go, truncated, times = code
    gone = DELETE * times
    if must_go:
        return after[0] + gone, after[1] + gone, after[2] + gone, after[3] + gone
    extra = TRUNCATED * truncated
    user, assistant = (after[NEXT[x]] + extra + (0 if initial == x else REROLE) for x in "ua")
    new = min(after[NEW] + gone, user, after[SYSTEM] + extra if initial == "s" else INFINITE)
    return inserted((new, min(after[SYSTEM] + gone, user), min(after[USER] + gone, assistant), min(after[ASSISTANT] + gone, user)))


def inserted(v: Vector) -> Vector:
    """The vector where turns may also be inserted. No two in a row lead back to where they began at a gain."""
    user, assistant = min(v[USER], v[ASSISTANT] + INSERT), min(v[ASSISTANT], v[USER] + INSERT)
    return min(v[NEW], user + INSERT), min(v[SYSTEM], user + INSERT), user, assistant


#: The vector after a conversation's last row.
END = inserted((0, INFINITE, INFINITE, 0))


def matrix(codes: list[Code]) -> list[int]:
    """Least costs from each state before the codes to each state just after the last, by rows."""
    columns = []
    for state in range(4):
        v: Vector = tuple(0 if s == state else INFINITE for s in range(4))
        for code in reversed(codes):
            v = step(code, v)
        columns.append(v)
    return [min(columns[end][begin], INFINITE) for begin in range(4) for end in range(4)]


def tight(code: Code, state: int, before: Vector, after: Vector) -> tuple[str, int, bool]:
    """The least letter of the edits that keep the cost, the state after it, and whether it used the row up."""
    initial, must_go, truncated, times = code
    left, wanted = before[state], WANTED[state]
    if left == DELETE * times + after[state]:
        return "D" * times, state, True
    if left == INSERT + before[AFTER[state]]:
        return "I", AFTER[state], False
    if initial == "s" and state == NEW and left == TRUNCATED * truncated + after[SYSTEM]:
        return "K", SYSTEM, True
    return "K" if initial == wanted else "R", NEXT[wanted], True


def walks(codes: list[Code], end: Vector) -> tuple[list[str], list[int], int]:
    """For each state before the codes the edits and the state after them, and the cost from the first state.

    Vectors are kept at the ends of pieces of about sqrt(n) codes, and those within one piece at a time.
    """
    piece = max(1, isqrt(len(codes)))
    cuts = [*range(0, len(codes), piece), len(codes)]
    kept = {cuts[-1]: end}
    v = end
    for i in range(len(codes) - 1, -1, -1):
        v = step(codes[i], v)
        if i % piece == 0:
            kept[i] = v
    letters, states = [[], [], [], []], list(range(4))
    for a, b in zip(cuts, cuts[1:], strict=False):
        vectors = [kept[b]]
        for i in range(b - 1, a - 1, -1):
            vectors.append(step(codes[i], vectors[-1]))
        vectors.reverse()
        for entry in range(4):
            state, out = states[entry], letters[entry]
            for i in range(a, b):
                used = False
                while not used:
                    letter, state, used = tight(codes[i], state, vectors[i - a], vectors[i - a + 1])
                    out.append(letter)
            states[entry] = state
    return ["".join(x) for x in letters], states, v[NEW]


BLOCKS = (
    "conv_id {0}, block long, initials string, flags string, times array<long>, matrix array<long>, blank long, duplicate long, truncated long, illegal long, "
    "first_initial string, last_initial string, turns long, first_turn long, last_turn long"
)


def codes_of(initials: str, flags: str, times: list[int]) -> list[Code]:
    return [(i, f == "d", f == "t", n) for i, f, n in zip(initials, flags, times, strict=True)]


class Block:
    """What is gathered of a block while its rows stream by."""

    def __init__(self, conv_id: object):
        self.conv_id, self.initials, self.flags, self.times = conv_id, [], [], []
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.first_initial = self.last_initial = self.first_turn = self.last_turn = None

    def code(self, initial: str, flag: str, times: int) -> None:
        if flag == "d" and self.flags and self.flags[-1] == "d":
            self.times[-1] += times
        elif times:
            self.initials.append(initial)
            self.flags.append(flag)
            self.times.append(times)

    def add(self, turn: int | None, initial: str, blank: bool, duplicate: bool, truncated: bool, copies: int) -> None:
        if not copies:
            return
        initial = initial if initial and initial in "sua" else "-"
        kept = 0 if blank or duplicate else 1
        if kept:
            self.code(initial, "t" if truncated else "k", 1)
        self.code("-", "d", copies - kept)
        self.blank += copies if blank else 0
        self.duplicate += 0 if blank else copies - kept
        self.truncated += kept and truncated
        if self.last_initial is not None:
            self.illegal += self.last_initial + initial not in LEGAL
        self.illegal += copies - 1  # no role may follow itself
        if self.first_initial is None:
            self.first_initial = initial
        self.last_initial = initial
        if turn is not None and turn != self.last_turn:
            self.turns += 1
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.last_turn = turn

    def row(self, number: int) -> tuple:
        initials, flags = "".join(self.initials), "".join(self.flags)
        return (self.conv_id, number, initials, flags, self.times, matrix(codes_of(initials, flags, self.times)), self.blank, self.duplicate, int(self.truncated), int(self.illegal), self.first_initial, self.last_initial, self.turns, self.first_turn, self.last_turn)


def streamed(df: DataFrame, fn: Callable[[Iterator[tuple]], Iterator[tuple]], schema: str) -> DataFrame:
    """`fn`, which makes tuples of tuples, over the rows of each partition in their order."""
    fields = StructType.fromDDL(schema).fields
    names, arrow = [f.name for f in fields], [to_arrow_type(f.dataType) for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns), strict=True))
        held, size = [], 0
        for out in fn(rows):
            held.append(out)
            size += 200 + sum(len(x) for x in out if isinstance(x, str))
            if size > 1 << 22:
                yield batch_of(held)
                held, size = [], 0
        if held:
            yield batch_of(held)

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), arrow, strict=True)], names)

    return df.mapInArrow(run, schema)


def blocks(codes: DataFrame) -> DataFrame:
    """The blocks of conversations in ranges of conversation and turn, numbered in that order."""

    def gather(rows: Iterator[tuple]) -> Iterator[tuple]:
        number, block = TaskContext.get().partitionId() << 33, None
        for conv_id, *row in rows:
            if block is None or block.conv_id != conv_id or len(block.flags) >= BLOCK:
                if block is not None:
                    yield block.row(number)
                number, block = number + 1, Block(conv_id)
            block.add(*row)
        if block is not None:
            yield block.row(number)

    columns = ("conv_id", "turn", "initial", "blank", "duplicate", "truncated", "copies")
    ranges = codes.repartitionByRange(*ordered_by()).sortWithinPartitions(*ordered_by()).select(*columns)
    return streamed(ranges, gather, BLOCKS.format(codes.schema["conv_id"].dataType.simpleString()))


def end_vectors(of: DataFrame) -> DataFrame:
    """block and end: the vector after each block, passed on from the last block of a conversation to the first."""

    def back(rows: Iterator[tuple]) -> Iterator[tuple]:
        now, v = object(), END
        for conv_id, block, m in rows:
            if conv_id != now:
                now, v = conv_id, END
            yield block, list(v)
            v = tuple(min(m[4 * s + e] + v[e] for e in range(4)) for s in range(4))

    ends = of.select("conv_id", "block", "matrix").repartition("conv_id").sortWithinPartitions("conv_id", F.desc("block"))
    return streamed(ends, back, "block long, end array<long>")


def repaired(conversations: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit and repaired_sha256 of each conversation."""
    kind = conversations.schema["conv_id"].dataType.simpleString()
    trimmed = F.regexp_extract("text", f"(?s)^.*({WORD})", 1)
    rows = damaged(conversations).withColumn("digest", F.unhex(F.sha2("text", 256)))
    codes = coded(rows.select("conv_id", "turn", "role", "digest", (trimmed == "").alias("blank"), (~trimmed.rlike(ENDS)).alias("truncated"), "copies"))
    of = stored(blocks(codes))

    def walk(rows: Iterator[tuple]) -> Iterator[tuple]:
        for end, initials, flags, times, *rest in rows:
            edits, states, cost = walks(codes_of(initials, flags, times), tuple(end))
            yield edits, states, cost, *rest

    counts = "blank duplicate truncated illegal first_initial last_initial turns first_turn last_turn".split()
    walked = streamed(
        of.join(end_vectors(of), "block").select("end", "initials", "flags", "times", "conv_id", "block", *counts),
        walk,
        f"edits array<string>, states array<int>, cost long, conv_id {kind}, block long, blank long, duplicate long, truncated long, illegal long, first_initial string, last_initial string, turns long, first_turn long, last_turn long",
    )

    def join_up(rows: Iterator[tuple]) -> Iterator[tuple]:
        now, begun = None, False
        for conv_id, _, edits, states, cost, blank, duplicate, truncated, illegal, first_initial, last_initial, turns, first_turn, last_turn in rows:
            if begun and conv_id == now:
                sums = [a + b for a, b in zip(sums, (blank, duplicate, truncated, illegal, turns), strict=True)]
                if initial is not None and first_initial is not None:
                    sums[3] += initial + first_initial not in LEGAL
                sums[4] -= last is not None and last == first_turn
            else:
                if begun:
                    yield closed(now, audit, state, total, sums, least, last)
                now, begun, audit, state, total, sums, least, last, initial = conv_id, True, [], NEW, cost, [blank, duplicate, truncated, illegal, turns], None, None, None
            audit.append(edits[state])
            state = states[state]
            least = first_turn if least is None else least
            last = last if last_turn is None else last_turn
            initial = last_initial or initial
        if begun:
            yield closed(now, audit, state, total, sums, least, last)

    def closed(conv_id: object, audit: list[str], state: int, total: int, sums: list[int], least: int | None, last: int | None) -> tuple:
        return conv_id, 0 if least is None else last - least + 1 - sums[4], *sums[:4], total, "".join(audit) + TAIL[state]

    order = ("conv_id", "block", "edits", "states", "cost", *counts)
    measures = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long"
    audits = streamed(walked.select(*order).repartition("conv_id").sortWithinPartitions("conv_id", "block"), join_up, f"conv_id {kind}, {measures}, audit string")
    text = audits.select("conv_id", F.lit(0).alias("part"), F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"), F.lit(b"").alias("digest"), F.col("audit").alias("text"), F.array("gaps", "blank", "duplicate", "truncated", "illegal", "cost").alias("measures"))
    lines = rows.select("conv_id", F.lit(1).alias("part"), "turn", "role", "digest", "text", F.array(F.col("copies").cast("long")).alias("measures"))
    both = text.unionByName(lines).repartition("conv_id").sortWithinPartitions("conv_id", "part", *ordered_by()[1:])
    return streamed(both.drop("digest", "turn"), hashed, f"conv_id {kind}, {measures}, audit string, repaired_sha256 string")


def hashed(rows: Iterator[tuple]) -> Iterator[tuple]:
    """The audit's row of each conversation with the hash of its turns as edited, which come after it."""
    sha = None

    def write(role: str, text: str) -> None:
        nonlocal lines
        sha.update(b"\n" * (lines > 0) + role.encode() + b":" + text.encode())
        lines += 1

    def insert() -> None:
        nonlocal at, state
        while at < len(audit) and audit[at] == "I":
            write(FULL[WANTED[state]], "")
            state, at = AFTER[state], at + 1

    for conv_id, part, role, text, measures in rows:
        if part == 0:
            if sha is not None:
                insert()
                yield *head, sha.hexdigest()
            head, audit, at, state, lines, sha = (conv_id, *measures, text), text, 0, NEW, 0, hashlib.sha256()
            continue
        for _ in range(measures[0]):
            insert()
            edit, at = audit[at], at + 1
            if edit != "D":
                begins = role[0] if edit == "K" else WANTED[state]
                write(role if edit == "K" else FULL[begins], text)
                state = SYSTEM if begins == "s" else NEXT[begins]
    if sha is not None:
        insert()
        yield *head, sha.hexdigest()
