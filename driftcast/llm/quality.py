"""Quality rules by a hashed n-gram log-likelihood ratio (operator 2).

Two multinomials over hashed byte n-grams are counted: one of the trusted
target rows, one of the raw corpus (all rows). A document's score is the mean
log ratio of its n-grams, so long and short texts share one threshold (nats
per n-gram), below which it is rejected. The base rules (too short, too much
repeated) reject as well.

One counting scan and one scoring scan; what is shuffled are counts of at most
65,536 buckets per task, and the model is two vectors of that size.

The target are rows of a label table with ``quality = 1``: all of them up to
``TRUSTED_ROWS``, beyond it that many by the ids' hash (the documented bound of
labelled rows). Raw counts cover every document.

Defined cases: null or empty text has no words, fails the base rules and
scores 0; without trusted rows every ratio is 0; a null id is never trusted;
repeated rows each give a row; an empty table gives an empty result; very long
texts are slices of their own; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftcast.llm.common import SPACE, row_sums, strings, take_field, text_slices, utf8
from driftcast.llm.ngrams import BUCKETS, count_rows, grams

NGRAM = 4
SMOOTHING = 0.5
THRESHOLD = -0.5
TRUSTED_ROWS = 200_000
MIN_WORDS, MAX_REPEATED = 50, 50
SYMBOLS = b"#*$%&|<>"
# Text that is counted or judged at once; its n-grams take some forty times as much.
QUALITY_SLICE = 2 << 20


def trusted_ids(labels: DataFrame, id_col: str = "doc_id", bound: int = TRUSTED_ROWS) -> pa.Array:
    """Ids of the trusted target rows, about ``bound`` at most."""
    good = labels.filter(F.col("quality") == 1).select(F.col(id_col)).dropna().distinct()
    count = good.count()
    if count > bound:
        cells = 1 << 20
        good = good.filter(F.pmod(F.xxhash64(id_col), F.lit(cells)) < int(cells * bound / count))
    ids = good.toArrow()[id_col].combine_chunks()
    return ids if isinstance(ids, pa.Array) else pa.concat_arrays(ids.chunks)


def ratio(docs: DataFrame, trusted: pa.Array, id_col: str = "doc_id", text_col: str = "text") -> np.ndarray:
    """log p(bucket | target) - log p(bucket | raw), counted over all rows."""
    shared = docs.sparkSession.sparkContext.broadcast(trusted)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, target = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
        for batch in text_slices(batches, text_col, QUALITY_SLICE):
            data, bounds = utf8(strings(batch.column(text_col)))
            bucket, at = grams(data, bounds, NGRAM)
            raw += np.bincount(bucket, minlength=BUCKETS)
            mine = pc.is_in(batch.column(id_col), value_set=shared.value).to_numpy(zero_copy_only=False)
            target += np.bincount(bucket[np.repeat(mine, np.diff(at))], minlength=BUCKETS)
        bucket, n = count_rows(raw)
        yield pa.RecordBatch.from_arrays([bucket, n, pa.array(target[bucket.to_numpy()], pa.int64())],
                                         names=["bucket", "raw", "target"])

    counts = (docs.select(id_col, text_col).mapInArrow(count, "bucket int, raw bigint, target bigint")
              .groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).toArrow())
    raw, target = np.zeros(BUCKETS), np.zeros(BUCKETS)
    raw[counts["bucket"].to_numpy()] = counts["raw"].to_numpy()
    target[counts["bucket"].to_numpy()] = counts["target"].to_numpy()
    if not target.any():
        return np.zeros(BUCKETS)
    share = [(c + SMOOTHING) / (c.sum() + SMOOTHING * BUCKETS) for c in (target, raw)]
    return np.log(share[0]) - np.log(share[1])


def repeated_words(words_: list[bytes]) -> int:
    """Words in 3-word windows that occur twice or more."""
    if len(words_) < 4:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words_), np.int64, len(words_))
    base = len(number)
    if base < 2 ** 21:
        window = (ids[:-2] * base + ids[1:-1]) * base + ids[2:]
    else:
        _, pair = np.unique(ids[:-1] * base + ids[1:], return_inverse=True)
        window = pair[:-1] * base + ids[2:]
    order = np.argsort(window, kind="stable")
    same = window[order[1:]] == window[order[:-1]]
    if not same.any():
        return 0
    again = np.zeros(len(window), bool)
    again[order[1:][same]] = again[order[:-1][same]] = True
    covered = np.zeros(len(ids), bool)
    for i in range(3):
        covered[i:len(window) + i] |= again
    return int(covered.sum())


def repeated_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    if b"\n" not in text:
        return 0
    lines = [line for line in text.split(b"\n") if line.strip()]
    return len(lines) - len(set(lines))


class Rules:
    """The rules with a fitted model, for a batch of texts."""

    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

    def __init__(self, model: np.ndarray, threshold: float):
        self.model, self.threshold = model, threshold

    def judge(self, texts: pa.Array) -> tuple[list[np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
        """The counts, base_failed, score and kept of every text."""
        data, bounds = utf8(texts)
        bucket, at = grams(data, bounds, NGRAM)
        score = row_sums(self.model[bucket], at) / np.maximum(np.diff(at), 1)
        rows = []
        for text in texts.cast(pa.binary()).to_pylist():
            words_ = text.split()
            rows.append((len(words_), len(text) - len(text.translate(None, SPACE)),
                         len(text) - len(text.translate(None, SYMBOLS)), repeated_lines(text), repeated_words(words_)))
        n, spaces, symbols, lines, again = np.array(rows, np.int64).reshape(-1, 5).T
        chars = pc.utf8_length(texts).to_numpy().astype(np.int64) - spaces
        failed = (n < MIN_WORDS) | (100 * again > MAX_REPEATED * n)
        return [n, chars, symbols, lines, again], failed, score, ~failed & (score >= self.threshold)


def fitted(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, threshold: float) -> Broadcast:
    """The rules with the model of ``docs``, for its tasks."""
    model = ratio(docs, trusted_ids(labels, id_col), id_col, text_col)
    return docs.sparkSession.sparkContext.broadcast(Rules(model, threshold))


def quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            threshold: float = THRESHOLD) -> DataFrame:
    """Every row with its base measures, its score and the verdict."""
    rules = fitted(docs, labels, id_col, text_col, threshold)
    schema = T.StructType([take_field(docs, id_col), *(T.StructField(c, T.LongType()) for c in Rules.counts),
                           T.StructField("base_failed", T.BooleanType()), T.StructField("score", T.DoubleType()),
                           T.StructField("kept", T.BooleanType())])

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, text_col):
            counts, failed, score, kept = rules.value.judge(strings(batch.column(text_col)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(id_col), *(pa.array(c, pa.int64()) for c in counts),
                 pa.array(failed), pa.array(score, pa.float64()), pa.array(kept)], names=schema.names)

    return docs.select(id_col, text_col).mapInArrow(judge, schema)


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              threshold: float = THRESHOLD) -> DataFrame:
    """The rows that pass, with all their columns."""
    rules = fitted(docs, labels, id_col, text_col, threshold)

    def passing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, text_col, QUALITY_SLICE):
            yield batch.filter(pa.array(rules.value.judge(strings(batch.column(text_col)))[3]))

    return docs.mapInArrow(passing, docs.schema)
