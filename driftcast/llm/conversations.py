"""Conversation structure repair (operator 12): a square-root checkpointed DP.

A conversation's rows are kept, re-roled, deleted, or preceded by inserted
turns so that the role initials read ``(s?(ua)+)?`` at the least cost; of the
cheapest edit strings the ASCII-least wins. The state is what has been emitted
last (nothing, s, u or a) and its backward cost vector has four entries.

* Rows become a byte each (initial, blank, duplicate, truncated). They are
  ordered by a range partitioning, so a conversation that holds a third of the
  rows is spread, and cut into chunks of ``CHUNK`` positions.
* A chunk maps the cost vector behind it to the one before it: a 4 x 4 matrix
  of least sums. One pass from the back chains the chunks of a conversation and
  leaves each the vector behind it: the checkpoints between tasks.
* Within a chunk of m rows, vectors are stored only at every sqrt(m)-th row;
  walking forward, a block's vectors are recomputed from its checkpoint and the
  least letter that keeps the least cost is emitted.
* The edits then meet the texts in one streaming pass over rows sorted by
  conversation, which needs memory for no more than a row and the edit letters.

Defined cases: a null role, text, conv_id or turn counts as one space (so a
null text is blank and a null role has no legal initial), null conv_ids are one
conversation; rows of one turn are taken by role, then by a digest of role and
text; an empty role has no legal initial; an empty table gives no row; repeated
rows are duplicates; very long texts stream one by one; other columns are not
read. A gap count beyond the range of long is cut to its ends.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from driftcast.llm.common import SPACE, staged, take_field

# Positions of a chunk: rows that one matrix stands for.
CHUNK = 4096
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
# States: nothing yet, after s, after u, after a. What is due next: u or a.
START, SYSTEM, USER, ASSISTANT = range(4)
DUE = (USER, USER, ASSISTANT, USER)
ROLE = {USER: "user", ASSISTANT: "assistant"}
INITIALS = "sua"
BLANK, DUPLICATE, CUT = 4, 8, 16
NEVER = math.inf
END = (0.0, 2.0 * INSERT, 1.0 * INSERT, 0.0)


def _text(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(" "))


def damaged(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
            text_col: str = "text") -> DataFrame:
    """(conv, turn, role, text, gone) by crc32(`conv:turn`) mod 20: 0 the row
    is gone, 1 its text is empty, 2 its text has no [.!?], 3 it comes twice, 4
    its role is user."""
    kind = F.pmod(F.crc32(F.concat(_text(conv_col), F.lit(":"), _text(turn_col)).cast("binary")), F.lit(20))
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    twice = F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return (turns.select(F.col(conv_col).alias("conv"), F.col(turn_col).cast("long").alias("turn"),
                         _text(role_col).alias("role"), _text(text_col).alias("text"), kind.alias("kind"))
            .select("conv", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
                    text.alias("text"), (F.col("kind") == 0).alias("gone"), F.explode(twice).alias("copy"))
            .drop("copy"))


def _digest() -> Column:
    """Of role and text together; the order within a turn and role, too."""
    return F.unhex(F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))
                          .cast("binary"), 256))


def row_codes(rows: DataFrame) -> DataFrame:
    """(conv, place, code) of the rows of ``damaged`` that are there: places
    grow with (conv, turn, role, digest) over the whole table, codes hold the
    role's initial and the row's first fault."""
    spark = rows.sparkSession
    order = ["conv", "turn", "role", "digest"]
    last = F.substring(F.rtrim("text", F.lit(SPACE.decode())), -1, 1)
    faults = F.when(last == "", BLANK).when(~last.isin(".", "!", "?"), CUT).otherwise(0)
    initial = F.instr(F.lit(INITIALS), F.substring("role", 1, 1))
    code = F.when(F.length("role") == 0, 0).otherwise(initial) + faults
    light = rows.filter("NOT gone").select("conv", "turn", "role", _digest().alias("digest"), code.alias("code"))
    placed = staged(spark, light.repartitionByRange(*order).sortWithinPartitions(*order)
                    .select("conv", "digest", "code", F.monotonically_increasing_id().alias("place")), "turns")
    said = placed.filter(F.col("code").bitwiseAND(BLANK) == 0)
    again = (said.groupBy("conv", "digest").agg(F.min("place").alias("first"), F.count("*").alias("n"))
             .filter("n > 1").select(F.col("conv").alias("c"), F.col("digest").alias("d"), "first"))
    fresh = F.col("first").isNull() | (F.col("place") == F.col("first")) | (F.col("code").bitwiseAND(BLANK) != 0)
    return (placed.join(again, F.col("conv").eqNullSafe(F.col("c")) & (F.col("digest") == F.col("d")), "left")
            .select("conv", "place", F.when(fresh, F.col("code")).otherwise(
                F.col("code").bitwiseAND(3) + F.lit(DUPLICATE)).cast("int").alias("code")))


def _step(code: int, after: tuple) -> tuple:
    """The cost vector before a row from the one behind it."""
    if code & (BLANK | DUPLICATE):
        best = [DELETE + c for c in after]
    else:
        extra = TRUNCATED if code & CUT else 0
        best = [min(DELETE + after[s], REROLE + extra + after[DUE[s]]) for s in range(4)]
        state = code & 3
        if state == SYSTEM:
            best[START] = min(best[START], KEEP + extra + after[SYSTEM])
        elif state:
            for s in range(4):
                if DUE[s] == state:
                    best[s] = min(best[s], KEEP + extra + after[state])
    return _inserted(best)


def _inserted(best: list) -> tuple:
    """With turns inserted before the row where that is cheaper."""
    user, assistant = min(best[USER], INSERT + best[ASSISTANT]), min(best[ASSISTANT], INSERT + best[USER])
    return min(best[START], INSERT + user), min(best[SYSTEM], INSERT + user), user, assistant


@lru_cache(maxsize=4096)
def matrix(codes: bytes) -> list[tuple]:
    """Column j: the vector before the chunk if only state j may follow it,
    at no cost."""
    out = []
    for j in range(4):
        vector = tuple(0.0 if s == j else NEVER for s in range(4))
        for code in reversed(codes):
            vector = _step(code, vector)
        out.append(vector)
    return out


def through(columns: list[tuple], after: tuple) -> tuple:
    return tuple(min(columns[j][s] + after[j] for j in range(4)) for s in range(4))


def _letter(code: int, state: int, before: tuple, after: tuple) -> tuple[str, int]:
    """The least letter that keeps the least cost, and the state behind it."""
    left, due = before[state], DUE[state]
    if DELETE + after[state] == left:
        return "D", state
    if INSERT + before[due] == left:
        return "I", due
    if not code & (BLANK | DUPLICATE):
        extra = TRUNCATED if code & CUT else 0
        kept = code & 3
        if (kept == due or (kept == SYSTEM and state == START)) and KEEP + extra + after[kept] == left:
            return "K", kept
    return "R", due


@lru_cache(maxsize=4096)
def walk(codes: bytes, after: tuple) -> list[tuple[str, int]]:
    """For every state before the chunk: its edit letters and the state behind
    it. ``after``: the vector behind the chunk."""
    size = max(1, math.isqrt(len(codes) - 1) + 1 if codes else 1)
    marks = list(range(0, len(codes), size))
    vector, behind = after, {}
    for start in reversed(marks):  # vectors behind every block, the checkpoints
        behind[start] = vector
        for code in reversed(codes[start:start + size]):
            vector = _step(code, vector)
    states, letters = list(range(4)), [[] for _ in range(4)]
    for start in marks:
        block = codes[start:start + size]
        vectors = [behind[start]]
        for code in reversed(block):
            vectors.append(_step(code, vectors[-1]))
        vectors.reverse()
        for i, code in enumerate(block):
            for s in range(4):
                letter = "I"
                while letter == "I":
                    letter, states[s] = _letter(code, states[s], vectors[i], vectors[i + 1])
                    letters[s].append(letter)
    return [("".join(letters[s]), states[s]) for s in range(4)]


def edit_chunks(codes: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """(conv, chunk, codes, edits, states) of every chunk of every conversation:
    edit letters and final state for each of the four states before it."""
    conv = take_field(codes, "conv")
    chunks = (codes.groupBy("conv", F.floor(F.col("place") / chunk).alias("chunk"))
              .agg(F.array_sort(F.collect_list(F.struct("place", "code"))).getField("code").alias("codes")))
    summed = T.StructType([conv, T.StructField("chunk", T.LongType()), T.StructField("codes", T.BinaryType()),
                           T.StructField("matrix", T.ArrayType(T.DoubleType()))])
    behind = T.StructType([*summed.fields[:3], T.StructField("after", T.ArrayType(T.DoubleType()))])
    edited = T.StructType([*summed.fields[:3], T.StructField("edits", T.ArrayType(T.StringType())),
                           T.StructField("states", T.ArrayType(T.IntegerType()))])

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = [bytes(c) for c in batch.column("codes").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv"), batch.column("chunk"), pa.array(raw, pa.binary()),
                 pa.array([[x for column in matrix(c) for x in column] for c in raw], pa.list_(pa.float64()))],
                names=summed.names)

    def chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, vector = object(), END
        for batch in batches:
            after = []
            for conv_id, m in zip(batch.column("conv").to_pylist(), batch.column("matrix").to_pylist(), strict=True):
                if conv_id != last:
                    last, vector = conv_id, END
                after.append(list(vector))
                vector = through([m[4 * j:4 * j + 4] for j in range(4)], vector)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(after, pa.list_(pa.float64()))], names=behind.names)

    def edit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [walk(c, tuple(a)) for c, a in zip(batch.column("codes").to_pylist(), batch.column("after").to_pylist(),
                                                       strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array([[e for e, _ in f] for f in found], pa.list_(pa.string())),
                 pa.array([[s for _, s in f] for f in found], pa.list_(pa.int32()))], names=edited.names)

    back = (chunks.mapInArrow(summarise, summed).repartition("conv")
            .sortWithinPartitions("conv", F.col("chunk").desc()).mapInArrow(chain, behind))
    return back.repartition("conv", "chunk").mapInArrow(edit, edited)


class _Conversation:
    """Edits of one conversation, applied to its rows as they stream by."""

    def __init__(self):
        self.codes, self.edits, self.state = [], [], START
        self.row = self.letter = 0
        self.before = START

    def add(self, codes: bytes, edits: list[str], states: list[int]) -> None:
        self.codes.append(codes)
        self.edits.append(edits[self.state])
        self.state = states[self.state]

    def close(self) -> None:
        """What the last state still lacks; then the edits are known."""
        self.edits.append("I" * int(END[self.state] // INSERT))
        self.audit, self.all_codes = "".join(self.edits), b"".join(self.codes)

    def take(self, role: str, text: str) -> Iterator[tuple[str, str, str]]:
        """(letter, role, text) of the turns inserted before a row and of the
        row itself (a deleted one with an empty role)."""
        code = self.all_codes[self.row]
        self.row += 1
        while True:
            letter = self.audit[self.letter]
            self.letter += 1
            if letter == "D":
                yield letter, "", ""
                return
            state = DUE[self.before] if letter != "K" else code & 3
            self.before = state
            if letter == "I":
                yield letter, ROLE[state], ""
                continue
            yield letter, role if letter == "K" else ROLE[state], text
            return

    def rest(self) -> Iterator[tuple[str, str, str]]:
        """Turns inserted behind the last row."""
        for letter in self.audit[self.letter:]:
            self.before = DUE[self.before]
            yield letter, ROLE[self.before], ""


def _stream(rows: DataFrame, edits: DataFrame) -> DataFrame:
    """Edits of a conversation, then its rows in order: (conv, kind, chunk,
    turn, role, digest, text, codes, edits, states)."""
    nothing = {"turn": "bigint", "role": "string", "digest": "binary", "text": "string"}
    left = edits.select("conv", F.lit(1).alias("kind"), "chunk",
                        *[F.lit(None).cast(t).alias(n) for n, t in nothing.items()], "codes", "edits", "states")
    right = rows.select("conv", F.when(F.col("gone"), 0).otherwise(2).alias("kind"), F.lit(0).cast("long").alias("chunk"), "turn", "role",
                        F.when(~F.col("gone"), _digest()).alias("digest"), F.when(~F.col("gone"), F.col("text")).alias("text"),
                        F.lit(None).cast("binary").alias("codes"), F.lit(None).cast("array<string>").alias("edits"),
                        F.lit(None).cast("array<int>").alias("states"))
    return (left.unionByName(right).repartition("conv")
            .sortWithinPartitions("conv", "kind", "chunk", "turn", "role", "digest"))


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """("open" | "row" | "end", conversation id, _Conversation, turn, [(letter,
    role, text), ...]) along the stream."""
    at, talk, closed = object(), None, False
    for batch in batches:
        columns = [batch.column(n).to_pylist() for n in ("conv", "kind", "turn", "role", "text", "codes", "edits", "states")]
        for conv, kind, turn, role, text, codes, edits, states in zip(*columns, strict=True):
            if talk is None or conv != at:
                if talk is not None:
                    if not closed:
                        talk.close()
                    yield "end", at, talk, None, list(talk.rest())
                at, talk, closed = conv, _Conversation(), False
            if kind == 1:
                talk.add(codes, edits, states)
            elif kind == 2:
                if not closed:
                    talk.close()
                    closed = True
                yield "row", at, talk, turn, list(talk.take(role, text))
    if talk is not None:
        if not closed:
            talk.close()
        yield "end", at, talk, None, list(talk.rest())


def _edits(turns: DataFrame, chunk: int, columns: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    rows = damaged(turns, **columns)
    return rows, staged(turns.sparkSession, edit_chunks(row_codes(rows), chunk), "edits")


def repair(turns: DataFrame, chunk: int = CHUNK, **columns: str) -> DataFrame:
    """The repaired turns of all conversations: (conv, position, turn (null
    where inserted), edit, role, text)."""
    rows, edits = _edits(turns, chunk, columns)
    schema = T.StructType([take_field(rows, "conv"), T.StructField("position", T.LongType()), T.StructField("turn", T.LongType()),
                           T.StructField("edit", T.StringType()), T.StructField("role", T.StringType()),
                           T.StructField("text", T.StringType())])

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, position, size = [], 0, 0
        for what, conv, _, turn, found in _conversations(batches):
            for letter, role, text in found:
                if letter != "D":
                    out.append((conv, position, None if letter == "I" else turn, letter, role, text))
                    position, size = position + 1, size + len(text)
            if what == "end":
                position = 0
            if len(out) > 10_000 or size > 1 << 23:
                yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r, strict=True)) for r in out], shape)
                out, size = [], 0
        if out:
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r, strict=True)) for r in out], shape)

    shape = to_arrow_schema(schema)
    return _stream(rows, edits).mapInArrow(apply, schema)


def audits(turns: DataFrame, chunk: int = CHUNK, conv_col: str = "conv_id", **columns: str) -> DataFrame:
    """One row per conversation of ``turns``: its faults, the cost, the edit
    letters and a digest of the repaired conversation."""
    rows, edits = _edits(turns, chunk, {"conv_col": conv_col, **columns})
    longs = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    conv = take_field(rows, "conv")
    schema = T.StructType([T.StructField(conv_col, conv.dataType), *[T.StructField(n, T.LongType()) for n in longs],
                           T.StructField("audit", T.StringType()), T.StructField("repaired_sha256", T.StringType())])
    price = {"D": DELETE, "I": INSERT, "K": KEEP, "R": REROLE}
    shape = to_arrow_schema(schema)

    def report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, sha, first = [], hashlib.sha256(), True
        low = high = seen = None
        distinct = cost = 0
        for what, conv, talk, turn, found in _conversations(batches):
            for letter, role, text in found:
                cost += price[letter]
                if letter != "D":
                    if letter != "I" and talk.all_codes[talk.row - 1] & CUT:
                        cost += TRUNCATED
                    sha.update(f"{'' if first else chr(10)}{role}:{text}".encode())
                    first = False
            if turn is not None:
                low, high = (turn if low is None else low), turn
                distinct += turn != seen
                seen = turn
            if what == "end":
                code = np.frombuffer(talk.all_codes, np.uint8)
                initial = code & 3
                legal = DUE_PAIRS[initial[:-1], initial[1:]] if len(code) > 1 else np.ones(0, bool)
                gaps = 0 if low is None else min(high - low + 1 - distinct, 2 ** 63 - 1)
                out.append((conv, gaps, *(int((code & f != 0).sum()) for f in (BLANK, DUPLICATE, CUT)),
                            int((~legal).sum()), cost, talk.audit, sha.hexdigest()))
                sha, first, low, high, seen, distinct, cost = hashlib.sha256(), True, None, None, None, 0, 0
                if len(out) >= 10_000:
                    yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r, strict=True)) for r in out], shape)
                    out = []
        if out:
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r, strict=True)) for r in out], shape)

    return _stream(rows, edits).mapInArrow(report, schema)


# Legal neighbours: su, ua, au.
DUE_PAIRS = np.zeros((4, 4), bool)
DUE_PAIRS[[SYSTEM, USER, ASSISTANT], [USER, ASSISTANT, USER]] = True
