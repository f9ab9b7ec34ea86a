"""LM scoring by a hashed maximum-entropy model (operator 4).

P(word | history) = P(class | history) * P(word | class). The most frequent
words are classes of their own; all other words (also unknown ones) belong to
spelling classes, clusters of byte bigrams learned on the frequent vocabulary.
The class softmax is a log-linear model over hashed features of the history:
the word before (n-gram), the word two before (skip) and both together. Its
weights are trained by distributed gradient updates on the counts of
(history, class) over all training tokens. Within a spelling class words have
the maximum-entropy distribution under their unigram counts, add-one smoothed
with one unknown word per class, so the model is a proper distribution.

Exact counts of all training tokens are one shuffle of pre-aggregated counts.
The frequent words (at most ``FREQUENT`` and ``FREQUENT_BYTES``, checked on a
histogram before they are collected; none longer than ``WORD_BYTES``) travel to the tasks; every other token of a document finds its
count in a join on the token.

Defined cases: null or empty text is the end token alone; rows of a null id
are training rows; repeated rows each give a row; an empty table gives an
empty result; without training rows all counts are 0; very long texts are
slices of their own; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftcast.llm.common import mix, row_sums, staged, strings, take_field, text_slices, utf8, words

FREQUENT = 1 << 18
# Bytes of all frequent words, and of one; longer tokens are left to the join.
FREQUENT_BYTES, WORD_BYTES = 8 << 20, 256
SPELLING_BYTES = 1 << 20  # whose bigrams a task weighs at once
SINGLES, SPELLINGS = 24, 40  # class 0 is the end of a text
CLASSES = SINGLES + SPELLINGS
CONTEXT_WORDS = 215
CONTEXTS = 1 + CONTEXT_WORDS + SPELLINGS  # 0: before the text
BIGRAM_BUCKETS = 256
CLUSTERED_WORDS, CLUSTER_ROUNDS = 20_000, 8
FEATURES = 1 << 13
EPOCHS, STEP, PRIOR = 10, 0.7, 1.0
TASKS = 12  # of a gradient update; the history counts have a bounded size


def _bigrams(tokens: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashed byte bigrams of padded tokens, and the tokens' offsets in them."""
    data, bounds = utf8(pc.binary_join_element_wise(" ", tokens, " ", "").cast(pa.string()))
    code = data[:-1].astype(np.uint32) << np.uint32(8) | data[1:]
    bucket = (code * np.uint32(0x9E3779B1)) >> np.uint32(24)
    inside = np.ones(len(bucket), bool)
    inside[bounds[1:-1] - 1] = False
    return bucket[inside], bounds - np.arange(len(bounds))


class Vocabulary:
    """Frequent words with their counts, and the class of any word."""

    def __init__(self, tokens: pa.Array, counts: np.ndarray):
        """``tokens`` by falling count."""
        self.tokens = tokens
        self.log_count = np.log10(counts + 1.0)
        self.spelling = self._cluster(tokens[:CLUSTERED_WORDS])

    @staticmethod
    def _cluster(tokens: pa.Array) -> np.ndarray:
        """Spherical k-means of the words' bigrams: (bucket, cluster) weights."""
        if not len(tokens):
            return np.zeros((BIGRAM_BUCKETS, SPELLINGS), np.float32)
        bucket, at = _bigrams(tokens)
        rows = np.zeros((len(tokens), BIGRAM_BUCKETS), np.float32)
        np.add.at(rows, (np.repeat(np.arange(len(tokens)), np.diff(at)), bucket), 1)
        rows /= np.linalg.norm(rows, axis=1, keepdims=True)
        centre = rows[np.linspace(0, len(rows) - 1, SPELLINGS).astype(int)]
        for _ in range(CLUSTER_ROUNDS):
            nearest = (rows @ centre.T).argmax(axis=1)
            centre = np.stack([rows[nearest == k].sum(axis=0) if (nearest == k).any() else centre[k]
                               for k in range(SPELLINGS)])
            centre /= np.maximum(np.linalg.norm(centre, axis=1, keepdims=True), 1e-9)
        return np.ascontiguousarray(centre.T.astype(np.float32))

    def spelling_class(self, tokens: pa.Array) -> np.ndarray:
        out = [np.zeros(0, np.int64)]
        ends = np.cumsum(pc.binary_length(tokens).to_numpy(zero_copy_only=False).astype(np.int64))
        i = 0
        while i < len(tokens):
            before = ends[i - 1] if i else 0
            end = min(i + 16384, max(i + 1, int(np.searchsorted(ends, before + SPELLING_BYTES, side="right"))))
            bucket, at = _bigrams(tokens[i:end])
            if len(bucket) > 2 * SPELLING_BYTES:  # one long token
                weight = np.bincount(bucket, minlength=BIGRAM_BUCKETS) @ self.spelling
                out.append(weight.argmax(keepdims=True))
            else:
                out.append(np.add.reduceat(self.spelling[bucket], at[:-1], axis=0).argmax(axis=1))
            i = end
        return np.concatenate(out)

    def describe(self, tokens: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rank (-1: not frequent), class and context of distinct tokens."""
        rank = pc.fill_null(pc.index_in(tokens, value_set=self.tokens), -1).to_numpy().astype(np.int64)
        spelling = self.spelling_class(tokens)
        single = (rank >= 0) & (rank < SINGLES - 1)
        own = (rank >= 0) & (rank < CONTEXT_WORDS)
        return rank, np.where(single, rank + 1, SINGLES + spelling), np.where(own, rank + 1, 1 + CONTEXT_WORDS + spelling)


def _tokens(texts: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
    flat, at = words(pc.ascii_lower(texts))
    return flat.dictionary_encode(), at


def _histories(code: np.ndarray, at: np.ndarray, kind: np.ndarray, context: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """History and class of every token (words, then the end, text by text),
    and the texts' offsets in them."""
    ends = at + np.arange(len(at))
    place = np.arange(len(code)) + np.repeat(np.arange(len(at) - 1), np.diff(at))
    total = int(ends[-1])
    classes, contexts = np.zeros(total, np.int64), np.zeros(total + 2, np.int64)
    classes[place], contexts[place + 2] = kind[code], context[code]
    before, skipped = contexts[1:-1].copy(), contexts[:-2].copy()
    start = ends[:-1]
    before[start] = 0
    skipped[start] = 0
    skipped[start[np.diff(ends) > 1] + 1] = 0
    return before * CONTEXTS + skipped, classes, ends


def count_tokens(docs: DataFrame, text_col: str) -> DataFrame:
    """(token, c) over all rows of ``docs``, on shared files."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, text_col):
            coded, _ = _tokens(strings(batch.column(text_col)))
            n = np.bincount(coded.indices.to_numpy(), minlength=len(coded.dictionary))
            yield pa.RecordBatch.from_arrays([coded.dictionary, pa.array(n, pa.int64())], names=["token", "n"])

    counted = docs.select(text_col).mapInArrow(count, "token string, n bigint")
    return staged(docs.sparkSession, counted.groupBy("token").agg(F.sum("n").alias("c")), "token-counts")


def frequent(counts: DataFrame, bound: int = FREQUENT) -> tuple[pa.Array, np.ndarray]:
    """The tokens of the largest counts, ``bound`` and ``FREQUENT_BYTES`` at
    most, by falling count, without those longer than ``WORD_BYTES``. Whole
    count bands are taken while they fit."""
    counts = counts.filter(F.octet_length("token") <= WORD_BYTES)
    band = F.floor(F.log2("c") * 16)
    sizes = sorted(((r["band"], r["n"], r["bytes"]) for r in counts.groupBy(band.alias("band")).agg(
        F.count("*").alias("n"), F.sum(F.octet_length("token")).alias("bytes")).collect()), reverse=True)
    least, total, size = math.inf, 0, 0
    for b, n, n_bytes in sizes:
        total, size = total + n, size + n_bytes
        if total > bound or size > FREQUENT_BYTES:
            break
        least = b
    if least == math.inf:
        return pa.array([], pa.string()), np.zeros(0)
    table = counts.filter(band >= least).toArrow().sort_by([("c", "descending"), ("token", "ascending")])
    return table["token"].combine_chunks().cast(pa.string()), table["c"].to_numpy().astype(np.float64)


def class_totals(counts: DataFrame, vocabulary) -> np.ndarray:
    """log10(N + V + 1) of every class (0 for single words)."""

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens_, types = np.zeros(CLASSES, np.int64), np.zeros(CLASSES, np.int64)
        for batch in batches:
            _, kind, _ = vocabulary.value.describe(strings(batch.column("token")))
            np.add.at(tokens_, kind, batch.column("c").to_numpy())
            np.add.at(types, kind, 1)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(CLASSES)), pa.array(tokens_), pa.array(types)],
                                         names=["kind", "n", "v"])

    rows = (counts.select("token", "c").mapInArrow(total, "kind bigint, n bigint, v bigint")
            .groupBy("kind").agg(F.sum("n").alias("n"), F.sum("v").alias("v")).toArrow())
    out = np.zeros(CLASSES)
    out[rows["kind"].to_numpy()] = np.log10(rows["n"].to_numpy() + rows["v"].to_numpy() + 1.0)
    out[:SINGLES] = 0
    return out


def history_counts(docs: DataFrame, vocabulary, text_col: str) -> DataFrame:
    """(history, kind, n) over all tokens of the training rows; at most
    CONTEXTS ** 2 * CLASSES rows."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.zeros(CONTEXTS * CONTEXTS * CLASSES, np.int32)
        for batch in text_slices(batches, text_col):
            coded, at = _tokens(strings(batch.column(text_col)))
            _, kind, context = vocabulary.value.describe(coded.dictionary)
            history, classes, _ = _histories(coded.indices.to_numpy(), at, kind, context)
            cell = history * CLASSES + classes
            if len(cell) > len(cells) // 32:  # adding all cells is less work than sorting the tokens
                cells += np.bincount(cell, minlength=len(cells)).astype(np.int32)
            else:
                cell, n = np.unique(cell, return_counts=True)
                cells[cell] += n.astype(np.int32)
        used = np.flatnonzero(cells)
        for i in range(0, len(used), 1 << 18):
            part = used[i:i + (1 << 18)]
            yield pa.RecordBatch.from_arrays([pa.array(part // CLASSES, pa.int32()), pa.array(part % CLASSES, pa.int32()),
                                              pa.array(cells[part], pa.int64())], names=["history", "kind", "n"])

    counted = docs.select(text_col).mapInArrow(count, "history int, kind int, n bigint")
    summed = counted.groupBy("history", "kind").agg(F.sum("n").alias("n"))
    return staged(docs.sparkSession, summed.repartition(TASKS, "history"), "history-counts")


class Softmax:
    """The class softmax over hashed history features."""

    def __init__(self):
        self.bias = np.zeros(CLASSES, np.float32)
        self.weight = np.zeros((FEATURES, CLASSES), np.float32)

    @staticmethod
    def features(history: np.ndarray) -> list[np.ndarray]:
        """Buckets of the n-gram, the skip and the joint feature."""
        before, skipped = np.divmod(history.astype(np.uint64), np.uint64(CONTEXTS))
        parts = (before, skipped + np.uint64(1 << 20), history.astype(np.uint64) + np.uint64(1 << 40))
        return [(mix(p) % np.uint64(FEATURES)).astype(np.int64) for p in parts]

    def log_p(self, history: np.ndarray) -> np.ndarray:
        """Natural log P(class | history), a row per history."""
        score = self.bias + sum(self.weight[f] for f in self.features(history))
        score -= score.max(axis=1, keepdims=True)
        return score - np.log(np.exp(score).sum(axis=1, keepdims=True))


def train(histories: DataFrame) -> Softmax:
    """Gradient updates on all history counts. A task sends its expected (and
    first also its observed) counts per feature and class; the gradient is
    their difference, and a weight's step is scaled by the larger of both."""
    context = histories.sparkSession.sparkContext
    model = Softmax()

    def expected(shared, first: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            model = shared.value
            expect = np.zeros((FEATURES + 1, CLASSES), np.float32)
            seen = np.zeros((FEATURES + 1, CLASSES), np.float32)
            for batch in batches:
                history, row = np.unique(batch.column("history").to_numpy(), return_inverse=True)
                observed = np.zeros((len(history), CLASSES), np.float32)
                np.add.at(observed, (row, batch.column("kind").to_numpy()), batch.column("n").to_numpy())
                wanted = np.exp(model.log_p(history)) * observed.sum(axis=1, keepdims=True)
                for f in [*model.features(history), np.full(len(history), FEATURES)]:
                    np.add.at(expect, f, wanted)
                    if first:
                        np.add.at(seen, f, observed)
            parts = [expect.tobytes()] + [seen.tobytes()] * first
            yield pa.RecordBatch.from_arrays([pa.array(range(len(parts)), pa.int32()), pa.array(parts, pa.binary())],
                                             names=["part", "sums"])
        return run

    observed = None
    for epoch in range(EPOCHS):
        shared = context.broadcast(model)
        # TASKS rows of a fixed size
        rows = histories.mapInArrow(expected(shared, epoch == 0), "part int, sums binary").toArrow()
        sums = [np.zeros((FEATURES + 1, CLASSES)) for _ in range(2)]
        for part, raw in zip(rows["part"].to_pylist(), rows["sums"], strict=True):
            sums[part] += np.frombuffer(raw.as_buffer(), np.float32).reshape(FEATURES + 1, CLASSES)
        observed = sums[1] if epoch == 0 else observed
        if not observed.any():
            break
        step = STEP * (observed - sums[0]) / (np.maximum(observed, sums[0]) + PRIOR)
        if epoch == 0:  # the bias first: the classes' shares
            prior = observed[FEATURES] + PRIOR
            model.bias = np.log(prior / prior.sum()).astype(np.float32)
        else:
            model.bias += step[FEATURES].astype(np.float32)
            model.weight += step[:FEATURES].astype(np.float32)
        shared.unpersist()
    return model


def _distinct(history: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``np.unique`` of histories with the inverse, by a table of all of them
    and not by sorting."""
    used = np.zeros(CONTEXTS * CONTEXTS, bool)
    used[history] = True
    return np.flatnonzero(used), (np.cumsum(used) - 1)[history]


class Scorer:
    """The fitted model, for a batch of texts."""

    def __init__(self, vocabulary: Vocabulary, softmax: Softmax, totals: np.ndarray, train_tokens: int, types: int, ends: int):
        self.vocabulary, self.softmax, self.totals = vocabulary, softmax, totals
        self.log_all = math.log10(train_tokens + types + 1)
        self.end_known, self.log_end = ends > 0, math.log10(ends + 1)

    def score(self, texts: pa.Array):
        """Per text: n_tokens, n_known, base and model score without the counts
        of tokens that are not frequent; and those tokens as (row, token, n)."""
        coded, at = _tokens(texts)
        code = coded.indices.to_numpy()
        rank, kind, context = self.vocabulary.describe(coded.dictionary)
        history, classes, ends = _histories(code, at, kind, context)
        seen, row = _distinct(history)
        log_p = self.softmax.log_p(seen).astype(np.float64) / math.log(10)
        model = row_sums(log_p[row, classes] - self.totals[classes], ends)
        count = np.where(rank >= 0, self.vocabulary.log_count[rank], 0.0) if len(self.vocabulary.tokens) else np.zeros(len(rank))
        known = row_sums((rank >= 0).astype(np.int64)[code], at)
        n = np.diff(ends)
        base = row_sums(count[code], at) + self.log_end - n * self.log_all
        # single words have their class alone
        model += row_sums(np.where(kind >= SINGLES, count, 0.0)[code], at)
        rare = (rank < 0)[code]
        text = np.repeat(np.arange(len(at) - 1), np.diff(at))[rare]
        pair, times = np.unique(text * max(1, len(rank)) + code[rare], return_counts=True)
        text, token = np.divmod(pair, max(1, len(rank)))
        return n, known + self.end_known, base, model, (text, coded.dictionary.take(pa.array(token)), times)


def score(docs: DataFrame, held: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row with its base score and the model's log10 probability; the
    rows that ``held`` selects are not learned from."""
    spark = docs.sparkSession
    training = docs.filter(~held)
    counts = count_tokens(training, text_col)
    words_, types = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    ends = training.count()
    train_tokens = words_ + ends
    context = spark.sparkContext
    vocabulary = context.broadcast(Vocabulary(*frequent(counts)))
    softmax = train(history_counts(training, vocabulary, text_col))
    scorer = context.broadcast(Scorer(vocabulary.value, softmax, class_totals(counts, vocabulary), train_tokens,
                                      types + (ends > 0), ends))
    schema = T.StructType([
        T.StructField("_row", T.LongType()), take_field(docs, id_col), T.StructField("held_out", T.BooleanType()),
        T.StructField("n_tokens", T.LongType()), T.StructField("n_known", T.LongType()),
        T.StructField("base_score", T.DoubleType()), T.StructField("score", T.DoubleType()),
        T.StructField("_token", T.StringType()), T.StructField("_n", T.LongType())])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 40
        for batch in text_slices(batches, text_col):
            n, known, base, model, (text, token, times) = scorer.value.score(strings(batch.column(text_col)))
            rows = len(n)
            id_type = batch.column(id_col).type
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(first, first + rows)), batch.column(id_col), batch.column("_held"),
                 pa.array(n, pa.int64()), pa.array(known, pa.int64()), pa.array(base), pa.array(model),
                 pa.nulls(rows, pa.string()), pa.nulls(rows, pa.int64())], names=schema.names)
            few = len(text)
            yield pa.RecordBatch.from_arrays(
                [pa.array(first + text), pa.nulls(few, id_type), pa.nulls(few, pa.bool_()), pa.nulls(few, pa.int64()),
                 pa.nulls(few, pa.int64()), pa.nulls(few, pa.float64()), pa.nulls(few, pa.float64()),
                 token, pa.array(times, pa.int64())], names=schema.names)
            first += rows

    both = staged(spark, docs.select(id_col, text_col, held.alias("_held")).mapInArrow(scan, schema), "lm-scan")
    found = (both.filter("_n IS NOT NULL").select("_row", F.col("_token").alias("token"), "_n").join(counts, "token")
             .groupBy("_row").agg(F.sum("_n").alias("_known"), F.sum(F.col("_n") * F.log10(F.col("c") + 1)).alias("_log")))
    log = F.coalesce("_log", F.lit(0.0))
    return both.filter("_n IS NULL").join(found, "_row", "left").select(
        F.col(id_col), "held_out", "n_tokens", (F.col("n_known") + F.coalesce("_known", F.lit(0))).alias("n_known"),
        F.lit(train_tokens).cast("long").alias("train_tokens"), (F.col("base_score") + log).alias("base_score"),
        (F.col("score") + log).alias("score"))
