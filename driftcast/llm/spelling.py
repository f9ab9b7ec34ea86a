"""Spelling variant grouping (operator 13) by blocked Gram matrices.

Two words one edit apart have letter counts at squared distance 2 (a letter
replaced, equal lengths) or 1 (a letter more, adjacent lengths). Squared
distances of many words at once are a NumPy product of letter-count blocks;
pairs at most 2 apart are kept and their edit is verified.

* Words: maximal letter runs, found on the bytes of a slice at once; a run's
  crc32 is taken for all runs together, a byte position per step. Counts are
  summed per task, then shuffled.
* Blocks: letters are dealt to ``classes`` of about equal weight. An edit
  touches two classes at most, so a pair agrees on all the others: words meet
  where their counts of all but two classes are equal, once for every choice of
  the two (``classes`` over 2 choices). More classes make smaller blocks;
  their number grows with the words, so that products stay near a fixed number
  per word. A pair that meets for several choices is kept in the first that
  covers the classes it differs in.
* A block of more than ``CROWD`` words is cut into parts, and each two parts
  meet in a task of their own: nothing is dropped.
* Tasks return a word's number of near words and its best one, not the pairs.
  Roots follow forms by pointer doubling: a form has at least twice the
  occurrences, so chains are short and end.

Defined cases: null text has no words, a null id counts as empty in the hash;
words never have other letters than A-Z, a-z and U+00C0 to U+00FF (U+00D7 and
U+00F7 count as such); repeated rows count their words each; ties of the
largest n fall to the first word in code-point order; a word without near
words has n_near 0 and itself as root; an empty table gives no words; very long
texts are slices of their own, very long words are compared whole; other
columns are not read.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftcast.llm.common import mix, staged, strings, text_slices, utf8

MIN_LENGTH, MIN_COUNT, DAMAGE = 5, 3, 97
# Words of a block that are multiplied at once, and of one task's part.
BATCH, CROWD = 256, 16_384
# Classes of letters: 4, and one more for every 8 times as many words as this.
FEW_WORDS = 1 << 20
# Bytes up to which runs are hashed together.
SHORT = 64
_LETTERS = 256

_CRC = np.arange(256, dtype=np.uint32)
for _ in range(8):
    _CRC = np.where(_CRC & 1, (_CRC >> 1) ^ np.uint32(0xEDB88320), _CRC >> 1).astype(np.uint32)


def classes_for(words: int) -> int:
    return 4 + max(0, math.ceil(math.log(max(words, 1) / FEW_WORDS, 8)))


def letter_runs(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of letters in texts (UTF-8, offsets of the rows): the
    lower-cased bytes of all runs in a row, the runs' offsets in them, their
    lengths in code points, and their rows. U+00C0 to U+00FF are the two-byte
    sequences that begin with 0xC3, which begins no other."""
    low = data | 0x20
    plain = (low >= 97) & (low <= 122) & (data < 128)
    lead = data == 0xC3
    inside = plain | lead
    inside[1:] |= lead[:-1]
    start = inside.copy()
    start[1:] &= ~inside[:-1]
    row_start = bounds[:-1][bounds[:-1] < bounds[1:]]
    start[row_start] = inside[row_start]
    kept = np.where(plain, low, data)[inside]
    first = np.flatnonzero(start[inside])
    at = np.append(first, len(kept))
    points = np.concatenate([[0], np.cumsum(kept != 0xC3)])[at]
    row = np.searchsorted(bounds, np.flatnonzero(start), side="right") - 1
    return kept, at, np.diff(points), row


def crc32_of(prefix: np.ndarray, data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """crc32 of prefix + run for every run; ``prefix`` is the crc32 of the
    run's prefix. Long runs are hashed one by one."""
    size = np.diff(at)
    out = np.bitwise_xor(prefix, np.uint32(0xFFFFFFFF))
    order = np.argsort(size, kind="stable")
    live = order[:np.searchsorted(size[order], SHORT, side="right")]
    for k in range(int(size[live[-1]]) if len(live) else 0):
        live = live[np.searchsorted(size[live], k, side="right"):]
        out[live] = _CRC[(out[live] ^ data[at[live] + k]) & 0xFF] ^ (out[live] >> np.uint32(8))
    out = np.bitwise_xor(out, np.uint32(0xFFFFFFFF))
    for i in np.flatnonzero(size > SHORT).tolist():
        out[i] = zlib.crc32(data[at[i]:at[i + 1]].tobytes(), int(prefix[i]))
    return out


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n) of all damaged runs of at least ``MIN_LENGTH`` code points
    with at least ``MIN_COUNT`` occurrences."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            data, at, size, row = letter_runs(*utf8(strings(batch.column("text"))))
            long = size >= MIN_LENGTH
            data, at, row, size = data[np.repeat(long, np.diff(at))], np.concatenate([[0], np.cumsum(np.diff(at)[long])]), row[long], size[long]
            if not len(row):
                continue
            ids = batch.column("id").to_pylist()
            prefix = np.array([zlib.crc32(f"{'' if i is None else i}:".encode()) for i in ids], np.uint32)
            crc = crc32_of(prefix[row], data, at)
            # the runs as a string array over the same bytes
            runs = pa.LargeStringArray.from_buffers(len(row), pa.py_buffer(at.astype(np.int64)), pa.py_buffer(data))
            hit = crc % DAMAGE == 0
            counted = pc.value_counts(runs.filter(pa.array(~hit))).flatten()
            extra = []
            for run, h in zip(runs.filter(pa.array(hit)).to_pylist(), crc[hit].tolist(), strict=True):
                cut = h % len(run)
                extra.append(run[:cut] + run[cut + 1:])
            extra = [w for w in extra if len(w) >= MIN_LENGTH]
            yield pa.RecordBatch.from_arrays([counted[0].cast(pa.string()), counted[1].cast(pa.int64())], names=["word", "n"])
            yield pa.RecordBatch.from_arrays([pa.array(extra, pa.string()), pa.array([1] * len(extra), pa.int64())], names=["word", "n"])

    rows = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"))
    return (rows.mapInArrow(count, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
            .filter(F.col("n") >= MIN_COUNT))


def latin(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The code points (a byte each) of all words in a row, and their offsets."""
    data, at = utf8(strings(column))
    lead = data == 0xC3
    after = np.concatenate([[False], lead[:-1]]) if len(lead) else lead
    return np.where(after, data + np.uint8(0x40), data)[~lead], np.concatenate([[0], np.cumsum(~lead)])[at]


def letter_classes(words: DataFrame, classes: int) -> np.ndarray:
    """A class for every code point: by falling corpus weight, dealt back and
    forth so that the classes weigh about the same."""
    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(_LETTERS, np.int64)
        for batch in batches:
            total += np.bincount(latin(batch.column(0))[0], minlength=_LETTERS)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["letter", "n"])

    weight = np.zeros(_LETTERS, np.int64)
    # at most 256 rows
    for letter, n in words.select("word").mapInArrow(weigh, "letter bigint, n bigint").groupBy("letter").agg(F.sum("n")).collect():
        weight[letter] = n
    turn = np.arange(_LETTERS) % (2 * classes)
    out = np.zeros(_LETTERS, np.int64)
    out[np.argsort(-weight, kind="stable")] = np.minimum(turn, 2 * classes - 1 - turn)
    return out


def blocks(words: DataFrame, of_letter: np.ndarray, classes: int) -> DataFrame:
    """(choice, block, word, n): every word once for every choice of two
    classes; ``block`` hashes its counts of the other classes' letters."""
    choices = list(combinations(range(classes), 2))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight = mix(np.arange(1, _LETTERS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        for batch in batches:
            points, at = latin(batch.column("word"))
            row = np.repeat(np.arange(len(at) - 1), np.diff(at))
            # a sum over letters, so equal counts give equal sums
            part = np.zeros((classes, len(at) - 1), np.uint64)
            np.add.at(part, (of_letter[points], row), weight[points])
            for i, (x, y) in enumerate(choices):
                kept = np.zeros(len(at) - 1, np.uint64)
                for c in range(classes):
                    if c not in (x, y):
                        kept = mix(kept * np.uint64(0x9E3779B97F4A7C15) + part[c])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(kept), i), pa.int32()), pa.array(kept.view(np.int64)), *batch.columns],
                    names=["choice", "block", "word", "n"])

    return words.select("word", "n").mapInArrow(send, "choice int, block bigint, word string, n bigint")


def one_edit(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether rows of words (a code point per column) are one edit apart;
    ``b`` is as long, or one longer."""
    if a.shape[1] == b.shape[1]:
        return (a != b).sum(axis=1) == 1
    same = np.concatenate([a == b[:, :-1], np.zeros((len(a), 1), bool)], axis=1)
    back = np.concatenate([(a == b[:, 1:])[:, ::-1], np.zeros((len(a), 1), bool)], axis=1)
    return same.argmin(axis=1) + back.argmin(axis=1) >= a.shape[1]


def whole_groups(batches: Iterator[pa.RecordBatch], columns: list[str]) -> Iterator[pa.Table]:
    """Tables of whole groups from rows sorted by ``columns``."""
    rest = None
    for batch in batches:
        table = pa.Table.from_batches([batch] if rest is None else [*rest.to_batches(), batch]).combine_chunks()
        same = np.logical_and.reduce([(c := table.column(n).to_numpy()) == c[-1:] for n in columns])
        cut = int(same.argmax()) if len(same) else 0
        if cut:
            yield table.slice(0, cut)
        rest = table.slice(cut) if len(same) else rest
    if rest is not None and len(rest):
        yield rest


class _Block:
    """Words of whole blocks of one choice (x, y), sorted by block and length."""

    def __init__(self, table: pa.Table, block: np.ndarray, choice: tuple[int, int], of_letter: np.ndarray):
        points, at = latin(table.column("word"))
        order = np.lexsort((np.diff(at), block))
        self.choice, self.order = choice, order
        self.points, self.start, self.size = points, at[order], np.diff(at)[order]
        # the next block begins more than one length away
        self.key = block[order] * (self.size.max() + 2) + self.size
        letters = np.flatnonzero(np.isin(of_letter, choice))
        column = np.full(_LETTERS, len(letters))
        column[letters] = np.arange(len(letters))
        row = np.repeat(np.arange(len(at) - 1), np.diff(at))
        counts = np.bincount(row * (len(letters) + 1) + column[points], minlength=(len(at) - 1) * (len(letters) + 1))
        counts = counts.reshape(-1, len(letters) + 1)[order, :-1]
        used = counts.any(axis=0)
        self.counts, self.of_count = counts[:, used].astype(np.float32), of_letter[letters][used]

    def pairs(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Places (a, b) of the near pairs that belong to this choice."""
        square = (self.counts ** 2).sum(axis=1)
        for s in range(0, len(self.key), BATCH):
            a = slice(s, min(s + BATCH, len(self.key)))
            stop = int(np.searchsorted(self.key, self.key[a.stop - 1] + 1, side="right"))
            for t in range(s, stop, 8 * BATCH):
                b = slice(t, min(t + 8 * BATCH, stop))
                distance = square[a, None] + square[b] - 2 * self.counts[a] @ self.counts[b].T
                grow = self.key[b] - self.key[a, None]
                i, j = np.nonzero((distance <= 2) & ((grow == 0) | (grow == 1)))
                i, j = i + s, j + t
                later = i < j
                yield self._verified(i[later], j[later])

    def _verified(self, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        x, y = self.choice
        other = self.counts[i] != self.counts[j]
        in_x, in_y = other[:, self.of_count == x].any(axis=1), other[:, self.of_count == y].any(axis=1)
        # a pair that differs in class c alone belongs to the first choice with c
        mine = (in_x & in_y) | (in_y & (x == 0)) | (in_x & (x == 0) & (y == 1))
        i, j = i[mine], j[mine]
        keep = np.zeros(len(i), bool)
        kind = self.size[i] * 2 + (self.size[j] - self.size[i])
        for k in np.unique(kind).tolist():
            at = np.flatnonzero(kind == k)
            size = k // 2
            for s in range(0, len(at), max(1, (1 << 22) // (size + 1))):
                part = at[s:s + max(1, (1 << 22) // (size + 1))]
                left = self.points[self.start[i[part]][:, None] + np.arange(size)]
                right = self.points[self.start[j[part]][:, None] + np.arange(size + k % 2)]
                keep[part] = one_edit(left, right)
        return i[keep], j[keep]


_NEAR = T.StructType([T.StructField("word", T.StringType()), T.StructField("n_near", T.LongType()),
                      T.StructField("form", T.StringType()), T.StructField("form_n", T.LongType())])


def near_words(sent: DataFrame, of_letter: np.ndarray, classes: int, crowd: int = CROWD) -> DataFrame:
    """(word, n_near, form, form_n) per word and task: near words found there
    and the best of them."""
    choices = list(combinations(range(classes), 2))
    keys = ["choice", "block", "left", "right"]
    sizes = sent.groupBy("choice", "block").agg(F.count("*").alias("rows")).filter(F.col("rows") > crowd)
    full = staged(sent.sparkSession, sizes.select("choice", "block", F.ceil(F.col("rows") / crowd).cast("int").alias("parts")),
                  "crowded-blocks")
    rows = sent.withColumns({"left": F.lit(0), "right": F.lit(0), "part": F.lit(0)})
    if not full.isEmpty():
        spread = (sent.join(full, ["choice", "block"])
                  .withColumn("part", F.pmod(F.xxhash64("word"), F.col("parts")).cast("int"))
                  .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
                  .withColumns({"left": F.least("part", "other"), "right": F.greatest("part", "other")}))
        rows = rows.join(full, ["choice", "block"], "left_anti").unionByName(spread.select(*rows.columns))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, keys):
            key = [table.column(c).to_numpy() for c in keys]
            block = np.cumsum(np.concatenate([[0], np.any([k[1:] != k[:-1] for k in key], axis=0)]))
            part, cross = table.column("part").to_numpy(), key[2] != key[3]
            # rank of every row as a form: more occurrences, then the first word
            order = pc.sort_indices(table, [("n", "descending"), ("word", "ascending")]).to_numpy()
            rank = np.empty(len(order), np.int64)
            rank[order] = np.arange(len(order))
            near, best = np.zeros(len(order), np.int64), np.full(len(order), len(order))
            for c in np.unique(key[0]).tolist():
                at = np.flatnonzero(key[0] == c)
                here = _Block(table.take(pa.array(at)), block[at], choices[c], of_letter)
                for i, j in here.pairs():
                    i, j = at[here.order[i]], at[here.order[j]]
                    apart = ~cross[i] | (part[i] != part[j])
                    i, j = i[apart], j[apart]
                    for a, b in ((i, j), (j, i)):
                        np.add.at(near, a, 1)
                        np.minimum.at(best, a, rank[b])
            some = np.flatnonzero(near)
            if len(some):
                form = pa.array(order[best[some]])
                yield pa.RecordBatch.from_arrays(
                    [c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in (
                        table.column("word").take(pa.array(some)), pa.array(near[some]),
                        table.column("word").take(form), table.column("n").take(form))], names=_NEAR.names)

    return (rows.select(*keys, "part", "word", "n").repartition(*keys).sortWithinPartitions(*keys)
            .mapInArrow(compare, _NEAR))


def follow(pointers: DataFrame) -> DataFrame:
    """(word, root) from (word, form) without cycles, by pointer doubling on
    shared files: chains of length k end after log2(k) rounds."""
    spark = pointers.sparkSession
    at = staged(spark, pointers.select("word", F.col("form").alias("root")), "forms")
    while True:
        ahead = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        at = staged(spark, at.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"),
                                                                   F.col("next").isNotNull().alias("moved")), "roots")
        if at.filter("moved").isEmpty():
            return at.select("word", "root")
        at = at.select("word", "root")


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", crowd: int = CROWD,
             classes: int | None = None) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word."""
    spark = docs.sparkSession
    words = staged(spark, word_counts(docs, id_col, text_col), "words")
    classes = classes or classes_for(words.count())
    of_letter = letter_classes(words, classes)
    found = near_words(blocks(words, of_letter, classes), of_letter, classes, crowd)
    best = found.groupBy("word").agg(F.sum("n_near").alias("n_near"),
                                     F.min(F.struct((-F.col("form_n")).alias("less"), "form")).alias("best"))
    kept = -F.col("best.less") >= 2 * F.col("n")
    known = staged(spark, words.join(best, "word", "left").select(
        "word", F.when(kept, F.col("best.form")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(kept, -F.col("best.less")).alias("form_n")), "variants")
    roots = follow(known.filter("form IS NOT NULL"))
    return known.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
