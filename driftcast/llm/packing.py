"""Best-two-fit packing (operator 8).

Documents become ids plus a separator and pieces of at most ``capacity``
tokens. Pieces of one length are interchangeable, so the packing is decided on
the histogram of lengths alone (``capacity`` cells, whatever the corpus):

* ``best_two_fit`` fills a sequence greedily with the longest pieces that fit,
  then replaces its smallest piece by the two unpacked ones that fill the
  widened gap best, and repeats that sequence as often as the histogram
  allows. The plan is a short list of (lengths, copies).
* The pieces of each length are numbered by Spark (salted by row, so a length
  that a third of all pieces share, or a row repeated so often, is numbered by
  many tasks), and a piece's number
  gives its sequence and offset by arithmetic on the plan.

Defined cases: null text is empty, i.e. the separator alone; repeated rows
are packed one by one; an empty table gives no sequence; null ids stay null;
other columns are not read. Long texts give as many pieces as they need.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftcast.llm.common import mix, staged, strings, take_field, text_slices
from driftcast.llm.tokenise import VOCABULARY, id_streams, word_ids

CAPACITY = 2048
SEPARATOR = 0
# Tasks that share the numbering of one length; grows with the pieces.
SALTS, PIECES_PER_SALT, MAX_SALTS = 128, 4_000_000, 4096


def cut_pieces(docs: DataFrame, vocabulary: str = VOCABULARY, capacity: int = CAPACITY,
               id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, piece, start, length, ids_crc32, _row) of every piece; ``_row`` is
    random, so repeated rows part."""
    schema = T.StructType([
        take_field(docs, id_col),
        T.StructField("piece", T.IntegerType()),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("ids_crc32", T.LongType()),
        T.StructField("_row", T.LongType()),
    ])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, number = word_ids(vocabulary), TaskContext.get().partitionId() << 40
        for batch in text_slices(batches, text_col):
            ids, at = id_streams(strings(batch.column(text_col)), coder)
            # the separator after each document
            ids = np.insert(ids, at[1:], SEPARATOR).astype("<u4")
            at = at + np.arange(len(at))
            size = np.diff(at)
            pieces = -(-size // capacity)
            row = np.repeat(np.arange(len(size)), pieces)
            piece = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            start = piece * capacity
            length = np.minimum(size[row] - start, capacity)
            rows = mix(np.arange(number, number + len(row), dtype=np.uint64)).astype(np.int64)
            number += len(row)
            raw, begin = memoryview(ids.tobytes()), (at[row] + start) * 4
            crc = [zlib.crc32(raw[a:b]) for a, b in zip(begin.tolist(), (begin + length * 4).tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(id_col).take(pa.array(row)), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                 pa.array(length, pa.int64()), pa.array(crc, pa.int64()), pa.array(rows)], names=schema.names)

    return docs.select(id_col, text_col).mapInArrow(cut, schema)


def best_two_fit(counts: np.ndarray, capacity: int) -> list[tuple[list[tuple[int, int]], int]]:
    """Sequences as [(length, how many of it), ...] and how often each is used.

    ``counts[l]`` pieces have length ``l``. A plan entry is repeated while the
    lengths it takes last, which is what packing piece by piece would choose.
    """
    left, plan = counts.astype(np.int64).copy(), []
    while left.any():
        used: dict[int, int] = {}
        gap = capacity
        live = np.flatnonzero(left)
        while gap and len(live := live[:np.searchsorted(live, gap, side="right")]):
            length = int(live[-1])
            used[length] = min(gap // length, int(left[length]))
            gap -= used[length] * length
            live = live[:-1]
        while gap:
            smallest = min(used)
            rest = left.copy()
            for length, n in used.items():
                rest[length] -= n
            pair = _tightest_pair(rest, gap + smallest)
            if pair is None or sum(pair) <= smallest:
                break
            for length, n in ((smallest, -1), (pair[0], 1), (pair[1], 1)):
                used[length] = used.get(length, 0) + n
            used = {length: n for length, n in used.items() if n}
            gap += smallest - sum(pair)
        copies = min(int(left[length]) // n for length, n in used.items())
        for length, n in used.items():
            left[length] -= copies * n
        plan.append((sorted(used.items(), reverse=True), copies))
    return plan


def _tightest_pair(rest: np.ndarray, gap: int) -> tuple[int, int] | None:
    """Two available lengths of the largest sum up to ``gap``."""
    live = np.flatnonzero(rest)
    first = live[live < gap]
    if not len(first):
        return None
    at = np.searchsorted(live, np.minimum(gap - first, first), side="right") - 1
    at = at - ((at >= 0) & (live[at] == first) & (rest[first] < 2))
    total = np.where(at >= 0, first + live[at], -1)
    best = len(total) - 1 - int(total[::-1].argmax())
    return None if total[best] < 0 else (int(first[best]), int(live[at[best]]))


class _Slots:
    """A plan as sorted arrays: (length, number) -> (sequence, offset)."""

    def __init__(self, plan: list[tuple[list[tuple[int, int]], int]]):
        taken: dict[int, int] = {}
        rows, offsets, sequence = [], [], 0
        for lengths, copies in plan:
            offset = 0
            for length, n in lengths:
                rows.append((length, taken.get(length, 0), n, sequence, len(offsets)))
                offsets += [offset + i * length for i in range(n)]
                offset += n * length
                taken[length] = taken.get(length, 0) + n * copies
            sequence += copies
        rows.sort()
        table = np.array(rows, np.int64).reshape(-1, 5)
        self.key = table[:, 0] << 44 | table[:, 1]
        self.first, self.each, self.sequence, self.slot = table[:, 1], table[:, 2], table[:, 3], table[:, 4]
        self.offsets = np.array(offsets, np.int64)

    def place(self, length: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        row = np.searchsorted(self.key, length << 44 | number, side="right") - 1
        copy, slot = np.divmod(number - self.first[row], self.each[row])
        return self.sequence[row] + copy, self.offsets[self.slot[row] + slot]


def pack(docs: DataFrame, vocabulary: str = VOCABULARY, capacity: int = CAPACITY,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every piece with its sequence and its offset there."""
    spark = docs.sparkSession
    pieces = staged(spark, cut_pieces(docs, vocabulary, capacity, id_col, text_col), "pieces")
    salts = int(min(MAX_SALTS, max(SALTS, pieces.count() // PIECES_PER_SALT)))
    salted = pieces.withColumn("_salt", F.pmod("_row", F.lit(salts)).cast("int"))
    # at most capacity x salts cells
    cells = salted.groupBy("length", "_salt").count().toArrow()
    count = np.zeros((capacity + 1, salts), np.int64)
    count[cells["length"].to_numpy(), cells["_salt"].to_numpy()] = cells["count"].to_numpy()
    before = np.cumsum(count, axis=1) - count
    slots = _Slots(best_two_fit(count.sum(axis=1), capacity))
    shared = spark.sparkContext.broadcast((before, slots))
    schema = T.StructType([*pieces.schema.fields[:-1], T.StructField("sequence_id", T.LongType()),
                           T.StructField("offset", T.LongType())])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, slots = shared.value
        for batch in batches:
            length = batch.column("length").to_numpy()
            number = before[length, batch.column("_salt").to_numpy()] + batch.column("_number").to_numpy() - 1
            sequence, offset = slots.place(length, number)
            names = [f.name for f in schema.fields[:-2]]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(sequence), pa.array(offset)],
                                             names=[*names, "sequence_id", "offset"])

    order = Window.partitionBy("length", "_salt").orderBy(id_col, "piece", "_row")
    return salted.withColumn("_number", F.row_number().over(order).cast("long")).mapInArrow(place, schema)
