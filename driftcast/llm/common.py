"""Helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftcast.session import shared_path

# The white space of the contracts: [\x20\x09-\x0D].
SPACE = b" \t\n\x0b\x0c\r"
# Text handled at once by a task; a longer text is a slice of its own.
SLICE_BYTES = 8 << 20


def staged(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet in the shared folder, and read again:
    the lineage ends there, and a lost executor costs no recomputation."""
    path = shared_path(spark, f"llm-{name}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def strings(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    """A text column as one string array, null as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return pc.fill_null(column.cast(pa.string()), "")


def held_out(id_col: str, modulus: int, remainder: int) -> Column:
    """crc32(id as text) mod modulus = remainder; a null id is not."""
    crc = F.crc32(F.col(id_col).cast("string").cast("binary"))
    return F.coalesce(F.pmod(crc, F.lit(modulus)) == remainder, F.lit(False))


def text_slices(batches: Iterator[pa.RecordBatch], column: str = "text",
                limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Record batches cut into slices of about ``limit`` bytes of text each,
    so that memory follows bytes and not rows."""
    for batch in batches:
        size = pc.fill_null(pc.binary_length(batch.column(column)), 0)
        ends = np.cumsum(size.to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < batch.num_rows:
            base = ends[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
            yield batch.slice(start, end - start)
            start = end


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts as one array, and the n + 1 row offsets in it."""
    _, offsets, data = texts.buffers()
    bounds = np.frombuffer(offsets, np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[bounds[0]:bounds[-1]], bounds - bounds[0]


def words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words ([^\\x20\\x09-\\x0D]+) of the texts in a row, and the n + 1
    offsets of the rows in them."""
    lists = pc.ascii_split_whitespace(texts)
    flat = lists.flatten()
    at = lists.offsets.to_numpy().astype(np.int64)
    at = at - at[0]
    full = pc.not_equal(pc.binary_length(flat), 0)
    keep = full.to_numpy(zero_copy_only=False)
    if not keep.all():
        flat = flat.filter(full)
        at = np.concatenate([[0], np.cumsum(keep)])[at]
    return flat, at


def row_sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of the stretches between offsets (0 for empty ones)."""
    total = np.concatenate([np.zeros(1, values.dtype), np.cumsum(values)])
    return total[offsets[1:]] - total[offsets[:-1]]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (multiply and shift) over uint64 values."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def take_field(df: DataFrame, name: str) -> T.StructField:
    """A column of the type it has in ``df``, for output schemas."""
    return T.StructField(name, next(f for f in df.schema.fields if f.name.lower() == name.lower()).dataType)


TEXT_HASH = "__text_hash__"


def text_hash(text_col: str = "text") -> Column:
    return F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))


def keep_rows(docs: DataFrame, verdict: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose verdict is kept, with all their columns.

    ``verdict`` (a table on disk) has a row (id, TEXT_HASH, kept) per row of
    ``docs``; id and text hash name a row, and of rows that share both one
    stays. Only the exceptions take part in the join."""
    keys = (verdict.groupBy(id_col, TEXT_HASH).agg(F.max("kept").alias("kept"), F.count("*").alias("n"))
            .select(F.col(id_col).alias("__id__"), F.col(TEXT_HASH).alias("__hash__"), "kept", "n"))
    keyed = docs.withColumn(TEXT_HASH, text_hash(text_col))
    same = F.col(id_col).eqNullSafe(F.col("__id__")) & (F.col(TEXT_HASH) == F.col("__hash__"))
    out = keyed.join(keys.filter(~F.col("kept") | (F.col("n") > 1)), same, "left_anti")
    repeated = keys.filter(F.col("kept") & (F.col("n") > 1))
    if not repeated.isEmpty():
        out = out.unionByName(keyed.join(repeated, same, "left_semi").dropDuplicates([id_col, TEXT_HASH]))
    return out.drop(TEXT_HASH)
