"""Exact dedup by an extendible-hash index on shared files (operator 1).

1. ``write_entries`` scans the documents once and writes the index entries as
   Parquet files in the shared folder: the hash of the normalised text, sizes,
   id, and the text itself once for the equal texts of a slice; the row that
   carries it is the *sender* of these.
2. ``Directory.grow`` builds the directory from a histogram of hash prefixes:
   it starts with one bucket, and splits every overfull bucket by one more
   hash bit, doubling the directory where a bucket's depth reaches its own.
3. Owner tasks process the buckets (key ranges of the hash), in the order of
   the hash. They chain the texts of one hash, compare their bytes, and answer
   every sender with the place of its text in the chain. A text that very many
   slices send is combined in lanes first, so an owner receives about the
   square root of them.
4. (hash, place) is the group of an entry. Of a group the longest original
   text stays, then the smallest id.

The groups come from the owners' answers alone: with a hash of two bits the
result is the same (tested), the chains are longer. An owner holds the chain
of one hash at a time. Group sizes are pre-aggregated before the shuffle, and
the last join is on Spark's own exchanges, so a hot group is split.

Defined cases: null text is empty, and all empty texts are one group; a null
id is larger than any other; of fully repeated rows the first of the index
stays; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftcast.llm.common import SPACE, TEXT_HASH, keep_rows, staged, strings, take_field, text_hash, text_slices

# Bytes of text in a bucket before it is split. Beyond 2 ** SPLIT_BITS such
# buckets they grow with the corpus, so that the directory keeps a bounded size
# (2 ** 20 cells); an owner's memory does not depend on them.
BUCKET_BYTES = 1 << 20
SPLIT_BITS = 16
PARTITION_BYTES = 64 << 20
# A hash sent by more slices than this is combined in lanes before its owner.
# At least a 65,536th of all sends, so that fewer than 65,536 hashes are.
LANE_SENDS = 1024
HOT_BITS = 16


def _normalised(texts: pa.Array) -> list[bytes]:
    """The texts in UTF-8 without the characters [\\x20\\x09-\\x0D]."""
    return [t.translate(None, SPACE) for t in texts.cast(pa.binary()).to_pylist()]


def write_entries(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hash_bits: int = 64) -> DataFrame:
    """The index entries of all rows, on shared files. ``hash_bits``: leading
    bits of the hash in use."""
    schema = T.StructType([
        T.StructField("entry", T.LongType()), take_field(docs, id_col), T.StructField(TEXT_HASH, T.LongType()),
        T.StructField("digest", T.BinaryType()), T.StructField("hash", T.LongType()),
        T.StructField("n_bytes", T.LongType()), T.StructField("n_chars", T.LongType()),
        T.StructField("sender", T.LongType()), T.StructField("plain", T.BinaryType())])

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entry = TaskContext.get().partitionId() << 40
        for batch in text_slices(batches, text_col):
            texts = strings(batch.column(text_col))
            plain = _normalised(texts)
            first: dict[bytes, int] = {}
            senders = np.array([first.setdefault(t, i) for i, t in enumerate(plain)], np.int64)
            found = [hashlib.sha256(t).digest() for t in first]
            digests = dict(zip(first, found, strict=True))
            digests = [digests[t] for t in plain]
            hashes = np.frombuffer(b"".join(d[:8] for d in digests), ">i8").astype(np.int64)
            hashes = hashes >> (64 - hash_bits) << (64 - hash_bits)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(entry, entry + len(plain))), batch.column(id_col), batch.column(TEXT_HASH),
                 pa.array(digests, pa.binary()), pa.array(hashes), pa.array(list(map(len, plain)), pa.int64()),
                 pc.utf8_length(texts).cast(pa.int64()), pa.array(senders + entry),
                 pa.array([t if s == i else None for i, (s, t) in enumerate(zip(senders, plain, strict=True))],
                          pa.binary())], names=schema.names)
            entry += len(plain)

    rows = docs.select(id_col, text_col, text_hash(text_col).alias(TEXT_HASH))
    return staged(docs.sparkSession, rows.mapInArrow(entries, schema), "index-entries")


class Directory:
    """Hash prefix -> bucket, grown by doubling."""

    def __init__(self, depth: int, table: np.ndarray):
        self.depth, self.table = depth, table

    @classmethod
    def grow(cls, volume: np.ndarray, bucket_bytes: int) -> Directory:
        """``volume[p]`` bytes have the hash prefix ``p`` (2 ** bits cells)."""
        bits = int(len(volume)).bit_length() - 1
        below = np.concatenate([[0], np.cumsum(volume)])
        depth, table, buckets = 0, np.zeros(1, np.int64), [(0, 0)]  # bucket -> (its prefix, its depth)
        full = [0]
        while full:
            bucket = full.pop()
            prefix, local = buckets[bucket]
            width = bits - local
            if local == bits or below[(prefix + 1) << width] - below[prefix << width] <= bucket_bytes:
                continue  # fits, or copies that no further bit can part: its chain overflows
            if local == depth:
                depth, table = depth + 1, np.repeat(table, 2)
            buckets[bucket] = (prefix << 1, local + 1)
            buckets.append((prefix << 1 | 1, local + 1))
            span = depth - local - 1
            table[(prefix << 1 | 1) << span:((prefix << 1 | 1) + 1) << span] = len(buckets) - 1
            full += [bucket, len(buckets) - 1]
        return cls(depth, table)

    def bucket(self, hashes: np.ndarray) -> np.ndarray:
        """Bucket of 64-bit hashes (uint64)."""
        if not self.depth:
            return np.zeros(len(hashes), np.int64)
        return self.table[(hashes >> np.uint64(64 - self.depth)).astype(np.int64)]


def build_directory(senders: DataFrame, bucket_bytes: int = BUCKET_BYTES) -> tuple[Directory, int]:
    """The directory for the texts sent, and their bytes."""
    total = senders.agg(F.sum("n_bytes")).first()[0] or 0
    bucket_bytes = max(bucket_bytes, total >> SPLIT_BITS)
    bits = max(4, int(total // bucket_bytes).bit_length() + 3)
    # 2 ** bits cells, 2 ** (SPLIT_BITS + 4) at most
    cells = (senders.groupBy(F.shiftrightunsigned("hash", 64 - bits).alias("prefix"))
             .agg(F.sum("n_bytes").alias("volume")).toArrow())
    volume = np.zeros(1 << bits, np.int64)
    volume[cells["prefix"].to_numpy()] = cells["volume"].to_numpy()
    return Directory.grow(volume, bucket_bytes), total


def _chained(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[tuple[int, int, bool]]]]:
    """Per batch, and per row of it, (place in the chain of its hash, the
    place's first sender, whether that is this row). Rows come in the order of
    the hash."""
    current, chain = None, []
    for batch in batches:
        found = []
        for hash_, sender, text in zip(*(batch.column(c).to_pylist() for c in ("hash", "sender", "plain")), strict=True):
            if hash_ != current:
                current, chain = hash_, []
            for place, (known, leader) in enumerate(chain):
                if known == text:
                    found.append((place, leader, False))
                    break
            else:
                chain.append((text, sender))
                found.append((len(chain) - 1, sender, True))
        yield batch, found


def combine_hot(senders: DataFrame, partitions: int, lane_sends: int) -> tuple[DataFrame, DataFrame | None]:
    """(the senders for the owners, (sender, leader) of those combined before).

    The sends of a hot hash are spread over lanes; in a lane the first sender
    of a text leads the others."""
    spark = senders.sparkSession
    sends = senders.groupBy("hash").agg(F.count("*").alias("n"))
    total = senders.count()
    # fewer than 2 ** HOT_BITS hashes have more than this share of the sends
    hot = sends.filter(F.col("n") > max(lane_sends, total >> HOT_BITS)).toArrow()
    if not hot.num_rows:
        return senders, None
    lanes = math.isqrt(max(hot["n"].to_pylist())) + 1
    keys = F.broadcast(spark.createDataFrame(hot.select(["hash"])))

    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, found in _chained(batches):
            leads = pa.array([lead for _, _, lead in found], pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [batch.column("sender"), pa.array([leader for _, leader, _ in found], pa.int64()),
                 batch.column("hash"), pc.if_else(leads, batch.column("plain"), pa.scalar(None, pa.binary()))],
                names=["sender", "leader", "hash", "plain"])

    lane = F.pmod(F.xxhash64("sender"), F.lit(lanes))
    combined = staged(spark, senders.join(keys, "hash", "left_semi").select("sender", "hash", "plain")
                      .repartition(partitions, "hash", lane).sortWithinPartitions("hash")
                      .mapInArrow(combine, "sender bigint, leader bigint, hash bigint, plain binary"), "index-lanes")
    rest = senders.join(keys, "hash", "left_anti").select("sender", "hash", "plain")
    leaders = combined.filter("plain is not null").select("sender", "hash", "plain")
    return rest.unionByName(leaders), combined.filter("plain is null").select("sender", "leader")


def chain_texts(senders: DataFrame, directory: Directory, partitions: int, lane_sends: int = LANE_SENDS) -> DataFrame:
    """(sender, bucket, place) of all senders, found by comparing bytes within
    the chains of the owner tasks. On shared files: places follow the order in
    which texts arrive, so they are given once."""
    spark = senders.sparkSession
    shared = spark.sparkContext.broadcast(directory)
    sent, followers = combine_hot(senders, partitions, lane_sends)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = batch.column("hash").to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(shared.value.bucket(hashes), pa.int64()), *batch.columns],
                                             names=["bucket", *batch.schema.names])

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, found in _chained(batches):
            yield pa.RecordBatch.from_arrays(
                [batch.column("sender"), batch.column("bucket"), pa.array([place for place, _, _ in found], pa.int64())],
                names=["sender", "bucket", "place"])

    places = staged(spark, sent.select("hash", "sender", "plain")
                    .mapInArrow(route, "bucket bigint, hash bigint, sender bigint, plain binary")
                    .repartition(partitions, "bucket").sortWithinPartitions("hash")
                    .mapInArrow(own, "sender bigint, bucket bigint, place bigint"), "index-places")
    if followers is None:
        return places
    answers = places.withColumnRenamed("sender", "leader")
    return places.unionByName(followers.join(answers, "leader").select("sender", "bucket", "place"))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bucket_bytes: int = BUCKET_BYTES,
                 hash_bits: int = 64, lane_sends: int = LANE_SENDS) -> DataFrame:
    """Every row with the row of its group that stays."""
    spark = docs.sparkSession
    entries = write_entries(docs, id_col, text_col, hash_bits)
    senders = entries.filter("plain is not null").select("hash", "sender", "n_bytes", "plain")
    directory, total = build_directory(senders, bucket_bytes)
    partitions = max(int(spark.conf.get("spark.sql.shuffle.partitions")), total // PARTITION_BYTES)
    places = chain_texts(senders, directory, partitions, lane_sends)
    placed = staged(spark, entries.drop("plain", "n_bytes").join(places, "sender"), "index-placed")
    first = F.struct((-F.col("n_chars")).alias("n"), F.col(id_col).isNull().alias("missing"),
                     F.col(id_col).alias("id"), F.col("entry").alias("entry"))
    groups = staged(spark, placed.groupBy("hash", "place")
                    .agg(F.min(first).alias("first"), F.count("*").alias("group_size"))
                    .select("hash", "place", "group_size", F.col("first.id").alias("keep_id"),
                            F.col("first.entry").alias("keep_entry")), "index-groups")
    return placed.join(groups, ["hash", "place"]).select(
        F.col(id_col), "keep_id", "group_size", (F.col("entry") == F.col("keep_entry")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"), "bucket", "place", TEXT_HASH)


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    groups = exact_groups(docs, id_col, text_col).select(id_col, TEXT_HASH, "kept")
    return keep_rows(docs, staged(docs.sparkSession, groups, "exact-verdict"), id_col, text_col)
