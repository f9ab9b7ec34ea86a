"""Token counts (operator 5): lengths only, by batch encoding in an Arrow function.

Record batches are cut into slices of equal bytes, long texts are split at
white space (which the vocabulary's pre-tokenizer drops, so no token crosses
it), every distinct piece of a slice is encoded in blocks, and only lengths
leave the function. One narrow stage, no shuffle.

Defined cases: null text counts as empty (0 bytes, 0 tokens); repeated rows
each give a row; an empty table gives an empty result; a null id stays null;
a very long text is a slice of its own; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from driftcast.llm.common import row_sums, strings, take_field, text_slices
from driftcast.llm.tokenise import VOCABULARY, word_ids, word_places


def count_tokens(docs: DataFrame, vocabulary: str = VOCABULARY, limit: int = 2048,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) for every row of ``docs``."""
    schema = T.StructType([
        take_field(docs, id_col),
        T.StructField("n_bytes", T.LongType()),
        T.StructField("n_tokens", T.LongType()),
        T.StructField("over_limit", T.BooleanType()),
    ])

    def lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = word_ids(vocabulary)
        for batch in text_slices(batches, text_col):
            texts = strings(batch.column(text_col))
            place, at = word_places(texts, coder)
            tokens = row_sums(coder.young.size[place], at)
            yield pa.RecordBatch.from_arrays(
                [batch.column(id_col), pc.cast(pc.binary_length(texts), pa.int64()),
                 pa.array(tokens, pa.int64()), pa.array(tokens > limit)],
                names=[id_col, "n_bytes", "n_tokens", "over_limit"])

    return docs.select(id_col, text_col).mapInArrow(lengths, schema)
