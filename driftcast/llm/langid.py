"""Language ID by multilingual mixture inference (operator 9).

Every language has a multinomial over hashed byte n-grams of the lower-cased
letters. A document is a mixture: expectation-maximisation estimates the
languages' proportions from its n-gram likelihoods, and the language set is
the one of largest penalised likelihood among the sets of its k strongest
languages. The prediction is the strongest language of that set, the score its
proportion.

One counting scan (languages x 65,536 counts leave it, pre-added per task) and
one scoring scan; neither shuffles text.

Defined cases: null text, and text without a letter, is ``und`` with score 0,
as is everything when no language was learned; rows with a null language are
never learned from; a null id counts as not held out; repeated rows each give
a row; an empty table gives an empty result; very long texts are slices of
their own; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftcast.llm.common import strings, take_field, text_slices, utf8
from driftcast.llm.ngrams import BUCKETS, count_rows, grams

NGRAMS = (2, 3, 4)
SMOOTHING = 0.5
UNDETERMINED = "und"
ROUNDS, TOLERANCE = 20, 1e-3
# Log-likelihood (nats per n-gram) that one more language must gain.
PENALTY = 0.02
# Share of the strongest language below which a filter rejects a text.
MIN_SCORE = 0.5

# ASCII that is not a letter separates words.
_LETTERS = np.arange(256, dtype=np.uint8)
_LETTERS[[b for b in range(128) if not chr(b).isalpha()]] = 32


def _buckets(texts: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per n: the buckets of all rows and the rows' offsets."""
    padded = pc.binary_join_element_wise(" ", pc.utf8_lower(texts), " ", "")
    data, bounds = utf8(padded.cast(pa.string()))
    data = _LETTERS[data]
    return [grams(data, bounds, n) for n in NGRAMS]


def learn(docs: DataFrame, learned: Column, text_col: str = "text", lang_col: str = "lang") -> tuple[list[str], np.ndarray]:
    """Languages in order, and p(bucket | language) as a (buckets, languages) array."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in text_slices(batches, text_col):
            coded = batch.column("_lang").dictionary_encode()
            code = coded.indices.to_numpy()
            found = _buckets(strings(batch.column(text_col)))
            for i, lang in enumerate(coded.dictionary.to_pylist()):
                mine = totals.setdefault(lang, np.zeros(BUCKETS, np.int64))
                for bucket, at in found:
                    mine += np.bincount(bucket[np.repeat(code == i, np.diff(at))], minlength=BUCKETS)
        for lang, counts in totals.items():
            bucket, n = count_rows(counts)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(bucket)), bucket, n], names=["lang", "bucket", "n"])

    rows = docs.filter(learned & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    counts = (rows.select(text_col, F.col(lang_col).cast("string").alias("_lang"))
              .mapInArrow(count, "lang string, bucket int, n bigint")
              .groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow())
    languages = sorted(set(counts["lang"].to_pylist()))
    table = np.zeros((BUCKETS, len(languages)))
    column = {lang: i for i, lang in enumerate(languages)}
    coded = counts["lang"].combine_chunks().dictionary_encode()
    place = np.array([column[x] for x in coded.dictionary.to_pylist()], np.int64)
    table[counts["bucket"].to_numpy(), place[coded.indices.to_numpy()]] = counts["n"].to_numpy()
    return languages, (table + SMOOTHING) / (table.sum(axis=0) + SMOOTHING * BUCKETS)


def proportions(likelihood: np.ndarray, counts: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, float]:
    """The mixture's proportions by expectation-maximisation, and the
    log-likelihood per n-gram."""
    share, total = start, counts.sum()
    for _ in range(ROUNDS):
        new = share * (likelihood.T @ (counts / (likelihood @ share))) / total
        done = np.abs(new - share).max() < TOLERANCE
        share = new
        if done:
            break
    return share, float(counts @ np.log(likelihood @ share)) / total


def infer(likelihood: np.ndarray, counts: np.ndarray, penalty: float = PENALTY) -> tuple[list[int], np.ndarray]:
    """The language set and all languages' proportions. ``likelihood`` has a
    row per distinct n-gram of the document, ``counts`` how often it occurs."""
    languages = likelihood.shape[1]
    share, _ = proportions(likelihood, counts, np.full(languages, 1 / languages))
    order = np.argsort(-share, kind="stable")
    best, best_value = [int(order[0])], float(counts @ np.log(likelihood[:, order[0]])) / counts.sum()
    for k in range(2, languages + 1):
        some = order[:k]
        start = np.maximum(share[some], 1e-6)
        part, value = proportions(likelihood[:, some], counts, start / start.sum())
        if value - penalty * (k - 1) <= best_value:
            break
        best, best_value = some[np.argsort(-part, kind="stable")].tolist(), value - penalty * (k - 1)
    return best, share


class Model:
    """The learned languages, for a batch of texts."""

    def __init__(self, languages: list[str], table: np.ndarray):
        self.languages, self.table = languages, table

    def predict(self, texts: pa.Array) -> list[tuple[str, float, list[str], list[float]]]:
        """(language, score, language set, its shares) of every text."""
        found = [(bucket, at.tolist()) for bucket, at in _buckets(texts)]
        letters = pc.match_substring_regex(texts, r"\p{L}").to_pylist()
        out = []
        for row, known in enumerate(letters):
            if not known or not self.languages:
                out.append((UNDETERMINED, 0.0, [], []))
                continue
            mine = np.sort(np.concatenate([b[at[row]:at[row + 1]] for b, at in found]), kind="stable")
            starts = np.flatnonzero(np.concatenate([[True], mine[1:] != mine[:-1]]))
            counts = np.diff(np.append(starts, len(mine))).astype(np.float64)
            chosen, share = infer(self.table[mine[starts]], counts)
            out.append((self.languages[chosen[0]], min(1.0, float(share[chosen[0]])),
                        [self.languages[i] for i in chosen], [float(share[i]) for i in chosen]))
        return out


def fitted(docs: DataFrame, learned: Column, text_col: str, lang_col: str) -> Broadcast:
    return docs.sparkSession.sparkContext.broadcast(Model(*learn(docs, learned, text_col, lang_col)))


def identify(docs: DataFrame, learned: Column, id_col: str = "doc_id", text_col: str = "text",
             lang_col: str = "lang") -> DataFrame:
    """(id, lang_pred, score, languages, shares) of every row, learning from
    the rows that ``learned`` selects."""
    model = fitted(docs, learned, text_col, lang_col)
    schema = T.StructType([take_field(docs, id_col), T.StructField("lang_pred", T.StringType()),
                           T.StructField("score", T.DoubleType()),
                           T.StructField("languages", T.ArrayType(T.StringType())),
                           T.StructField("shares", T.ArrayType(T.DoubleType()))])

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, text_col):
            name, score, set_, shares = zip(*model.value.predict(strings(batch.column(text_col))), strict=True)
            yield pa.RecordBatch.from_arrays(
                [batch.column(id_col), pa.array(name, pa.string()), pa.array(score, pa.float64()),
                 pa.array(set_, pa.list_(pa.string())), pa.array(shares, pa.list_(pa.float64()))], names=schema.names)

    return docs.select(id_col, text_col).mapInArrow(predict, schema)


def keep_identified(docs: DataFrame, learned: Column, min_score: float = MIN_SCORE, text_col: str = "text",
                    lang_col: str = "lang") -> DataFrame:
    """The rows with a language that holds ``min_score`` of the text, with
    all their columns."""
    model = fitted(docs, learned, text_col, lang_col)

    def known(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, text_col):
            found = model.value.predict(strings(batch.column(text_col)))
            yield batch.filter(pa.array([name != UNDETERMINED and score >= min_score for name, score, *_ in found]))

    return docs.mapInArrow(known, docs.schema)
