"""MinHash near-dedup by a chosen-path set similarity join (operator 7).

A document is the set of its distinct word shingles (64-bit hashes). Equal
sets are one representative. Independent trees look for similar ones: the root
and every large node choose two minwise coordinates, and a representative goes
to the child of its value at each; nodes with one member end, and small nodes
are compared exhaustively by their signatures. In a large node all members meet
one of them, the pivot: those similar to it (``PIVOT`` equal coordinates) are
linked with it, and all that can be similar to a member that is not go on to the
children, unless most of the node is near the pivot: then it is one candidate
group. So documents that only share a passage are parted level by level, and
near copies do not branch. What is large at the last level is one
candidate group. A pair of similarity 0.8 misses a
tree with probability ``miss(DEPTH)``; ``trees_for`` repeats independent trees
until the chance to miss it in all is below ``TARGET_MISS``.

Candidate links only decide which representatives meet. Each connected
candidate group is then linked exactly on full sets, in blocks of bounded
size; a task sends every member's link to the least member of its class (a
star, so later rounds are few), never all pairs.
Groups beyond one block share some of their members with every block, and the
members outside the largest class so far are then compared, in blocks, with
the whole group, so no link is lost.

Hot keys: equal sets are pre-aggregated, node sizes are counted by partial
aggregates, and a hot node's rows meet only in joins that Spark splits.

Defined cases: null text, and text without words, has the empty set, is linked
with nothing and is its own component; a null id is larger than any other;
repeated rows are equal sets; an empty table gives an empty result; very long
texts are handled in chunks of shingles; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftcast.llm.common import (
    TEXT_HASH, keep_rows, mix, staged, strings, take_field, text_hash, text_slices, words)
from driftcast.llm.components import connected

SHINGLE = 4
# Links: 100 * intersection >= PERCENT * union.
PERCENT = 80
TARGET_MISS = 1e-6
COORDINATES = 128
CHOSEN = 2
DEPTH = 6
LEAF = 256
# Equal coordinates that make a candidate: a pair of similarity 0.8 falls
# short with probability 2e-6.
MIN_EQUAL = 82
# Coordinates that make a member of a large node one of its pivot's group. Two
# similar members differ in COORDINATES - MIN_EQUAL at most, and so do their
# counts: where one is below PIVOT, the other is below PIVOT + that.
PIVOT = 38
# Share of a large node near its pivot from which the node is one group.
DENSE = 0.75
# Members and bytes of full sets that one task compares.
BLOCK, BLOCK_BYTES = 1024, 16 << 20
SHARED_MEMBERS = 8

_RNG = np.random.default_rng(20240)
_FACTOR = _RNG.integers(1, 2 ** 32, COORDINATES, dtype=np.uint64).astype(np.uint32) | np.uint32(1)
_SHIFT = _RNG.integers(0, 2 ** 32, COORDINATES, dtype=np.uint64).astype(np.uint32)


def miss(depth: int, similarity: float = PERCENT / 100) -> float:
    """Chance that a pair of this similarity is parted within one tree."""
    p = 0.0
    for _ in range(depth):
        p = (1 - similarity + similarity * p) ** CHOSEN
    return p


def trees_for(target: float = TARGET_MISS) -> int:
    return math.ceil(math.log(target) / math.log(miss(DEPTH)))


def shingle_sets(texts: pa.Array, size: int = SHINGLE) -> list[np.ndarray]:
    """The sorted distinct shingles of every text, as 64-bit hashes."""
    flat, at = words(pc.ascii_lower(texts))
    coded = flat.dictionary_encode()
    known = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in coded.dictionary.cast(pa.binary()).to_pylist()),
                        np.uint64, len(coded.dictionary))
    word = known[coded.indices.to_numpy()]
    window = np.zeros(len(word), np.uint64)
    for i in range(size):
        window[:max(0, len(word) - size + 1)] = mix(
            window[:max(0, len(word) - size + 1)] * np.uint64(0x9E3779B97F4A7C15) + word[i:len(word) - size + 1 + i])
    out = []
    for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        if b - a >= size:
            out.append(np.unique(window[a:b - size + 1]))
        elif b > a:
            out.append(np.array([xxhash.xxh3_64_intdigest(word[a:b].tobytes(), seed=b - a)], np.uint64))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def signature(shingles: np.ndarray) -> np.ndarray:
    """The least value of every coordinate's hash, as uint32."""
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    least = np.full(COORDINATES, 0xFFFFFFFF, np.uint32)
    for i in range(0, len(x), 8192):
        hashed = _FACTOR[:, None] * x[None, i:i + 8192] + _SHIFT[:, None]
        np.minimum(least, hashed.min(axis=1), out=least)
    return least


def _node(parent, coordinate, value) -> np.ndarray:
    """Child node of a node by a coordinate's value."""
    with np.errstate(over="ignore"):
        key = mix(np.asarray(parent).astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15) * (np.uint64(1) + coordinate))
        return mix(key ^ np.asarray(value).astype(np.uint64)).astype(np.int64)


def sketch(docs: DataFrame, trees: int, id_col: str = "doc_id", text_col: str = "text",
           shingle: int = SHINGLE) -> DataFrame:
    """Per row: a key in random order, the size and fingerprint of its set,
    its signature (a byte per coordinate) and its nodes below the roots."""
    schema = T.StructType([
        T.StructField("key", T.LongType()), take_field(docs, id_col), T.StructField(TEXT_HASH, T.LongType()),
        T.StructField("n_shingles", T.LongType()), T.StructField("set_id", T.BinaryType()),
        T.StructField("signature", T.BinaryType()), T.StructField("nodes", T.ArrayType(T.LongType()))])
    roots = trees * CHOSEN

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 40
        for batch in text_slices(batches, text_col):
            sets = shingle_sets(strings(batch.column(text_col)), shingle)
            ids, signatures, nodes = [], [], []
            coordinate = np.arange(roots, dtype=np.uint64)
            for s in sets:
                if not len(s):
                    ids.append(None), signatures.append(None), nodes.append([])
                    continue
                sums = np.array([s.sum(), mix(s ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum(), len(s)], np.uint64)
                least = signature(s)
                ids.append(sums.tobytes())
                signatures.append((least & np.uint32(255)).astype(np.uint8).tobytes())
                nodes.append(_node(np.zeros(roots), coordinate, least[:roots]))
            key = mix(np.arange(row, row + len(sets), dtype=np.uint64)).astype(np.int64)
            row += len(sets)
            yield pa.RecordBatch.from_arrays(
                [pa.array(key), batch.column(id_col), batch.column(TEXT_HASH),
                 pa.array([len(s) for s in sets], pa.int64()), pa.array(ids, pa.binary()),
                 pa.array(signatures, pa.binary()), pa.array(nodes, pa.list_(pa.int64()))], names=schema.names)

    rows = docs.select(id_col, text_col, text_hash(text_col).alias(TEXT_HASH))
    return staged(docs.sparkSession, rows.mapInArrow(scan, schema), "sketch")


def _by_node(batches: Iterator[pa.RecordBatch], columns: list[str]) -> Iterator[list[pa.Array]]:
    """Runs of whole groups from rows sorted by ``columns``."""
    rest = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        rest = pa.concat_tables([rest, table]) if rest is not None else table
        last = [rest.column(c)[-1].as_py() for c in columns]
        same = np.ones(len(rest), bool)
        for c, v in zip(columns, last, strict=True):
            same &= rest.column(c).to_numpy() == v
        split = int(np.argmax(same))  # the first row of the last group
        if split:
            yield [c.combine_chunks() for c in rest.slice(0, split).columns]
            rest = rest.slice(split).combine_chunks()
    if rest is not None and len(rest):
        yield [c.combine_chunks() for c in rest.columns]


class Forest:
    """Union-find over small integers."""

    def __init__(self, n: int):
        self.parent = list(range(n))

    def find(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = self.parent[i]
        return i

    def union(self, i: int, j: int) -> bool:
        i, j = self.find(i), self.find(j)
        self.parent[max(i, j)] = min(i, j)
        return i != j

    def stars(self, keys: list[int]) -> list[tuple[int, int]]:
        """(key, least key of its class) of all other members."""
        least: dict[int, int] = {}
        for i, key in enumerate(keys):
            r = self.find(i)
            least[r] = min(least.get(r, key), key)
        return [(key, least[self.find(i)]) for i, key in enumerate(keys) if least[self.find(i)] != key]


def _compare_leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Small nodes exhaustively: stars of the pairs with enough equal coordinates."""
    for node, key, raw in _by_node(batches, ["node"]):
        node, key = node.to_numpy(), key.to_numpy()
        sig = np.frombuffer(b"".join(raw.to_pylist()), np.uint8).reshape(-1, COORDINATES)
        starts = np.flatnonzero(np.concatenate([[True], node[1:] != node[:-1]]))
        sizes = np.diff(np.append(starts, len(node)))
        pairs = starts[sizes == 2]
        pairs = pairs[(sig[pairs] == sig[pairs + 1]).sum(axis=1) >= MIN_EQUAL]
        a, b = key[pairs].tolist(), key[pairs + 1].tolist()
        for start, size in zip(starts[sizes > 2].tolist(), sizes[sizes > 2].tolist(), strict=True):
            mine, forest = sig[start:start + size], Forest(size)
            for i in range(size - 1):
                equal = (mine[i + 1:] == mine[i]).sum(axis=1)
                for j in np.flatnonzero(equal >= MIN_EQUAL).tolist():
                    forest.union(i, i + 1 + j)
            for x, least in forest.stars(key[start:start + size].tolist()):
                a.append(x), b.append(least)
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def _signatures(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, COORDINATES)


def _meet_pivot(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Members with the number of coordinates they share with their node's
    pivot, where it has one."""
    for batch in batches:
        large = pc.is_valid(batch.column("pivot"))
        equal = np.full(batch.num_rows, -1, np.int32)
        picked = np.flatnonzero(large.to_numpy(zero_copy_only=False))
        equal[picked] = (_signatures(batch.column("signature").filter(large))
                         == _signatures(batch.column("pivot").filter(large))).sum(axis=1)
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("node", "key", "signature", "least")),
                                          pa.array(equal, mask=equal < 0)], names=["node", "key", "signature", "least", "equal"])


def _branch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Members of large nodes to their group, as links (key, least), and to the
    children by two more coordinates."""
    for batch in batches:
        equal, group = batch.column("equal").to_numpy(), batch.column("share").to_numpy() >= DENSE
        star = pa.array(np.flatnonzero((equal >= PIVOT) | group))
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(len(star), pa.int64()), batch.column("key").take(star), pa.nulls(len(star), pa.binary()),
             batch.column("least").take(star)], names=["node", "key", "signature", "least"])
        on = pa.array(np.flatnonzero((equal < PIVOT + COORDINATES - MIN_EQUAL) & ~group))
        node, key, raw = (batch.column(c).take(on) for c in ("node", "key", "signature"))
        node, sig = node.to_numpy(), _signatures(raw)
        pick = mix(node.astype(np.uint64))
        first = pick % np.uint64(COORDINATES)
        second = (first + np.uint64(1) + (pick >> np.uint64(32)) % np.uint64(COORDINATES - 1)) % np.uint64(COORDINATES)
        row = np.arange(len(node))
        for c in (first, second):
            yield pa.RecordBatch.from_arrays([pa.array(_node(node, c, sig[row, c.astype(np.int64)])), key, raw,
                                              pa.nulls(len(node), pa.int64())], names=["node", "key", "signature", "least"])


def candidate_links(reps: DataFrame) -> DataFrame:
    """Links (a, b) such that similar representatives are connected."""
    spark = reps.sparkSession
    rows = reps.select(F.explode("nodes").alias("node"), "key")
    signatures = reps.select("key", "signature")
    leaves, stars = [], []
    for depth in range(1, DEPTH + 1):
        large = F.col("n") > LEAF
        pivot = [] if depth == 1 else [F.min_by("signature", "key").alias("pivot")]
        sizes = rows.groupBy("node").agg(F.count("*").alias("n"), F.min("key").alias("least"), *pivot).filter("n > 1")
        if depth == 1:  # only now do the signatures travel, with members of shared nodes and large nodes' pivots
            sizes = staged(spark, sizes, "tree-nodes")
            pivots = sizes.filter(large).select("node", F.col("least").alias("key")).join(signatures, "key").groupBy("node").agg(
                F.first("signature").alias("pivot"))
            sizes = sizes.join(pivots, "node", "left")
            rows = rows.join(sizes, "node").join(signatures, "key")
        else:
            rows = rows.join(staged(spark, sizes.withColumn("pivot", F.when(large, F.col("pivot"))), "tree-nodes"), "node")
        met = staged(spark, rows.select("node", "key", "signature", "least", "pivot").mapInArrow(
            _meet_pivot, "node bigint, key bigint, signature binary, least bigint, equal int"), "tree-rows")
        leaves.append(met.filter("equal IS NULL").select("node", "key", "signature"))
        met = met.filter("equal IS NOT NULL")
        if depth == DEPTH:
            stars.append(met.select(F.col("key").alias("a"), F.col("least").alias("b")))
            break
        share = met.groupBy("node").agg(F.avg((F.col("equal") >= PIVOT).cast("int")).alias("share"))
        if met.isEmpty():
            break
        branches = staged(spark, met.join(share, "node").select("node", "key", "signature", "least", "equal", "share").mapInArrow(
            _branch, "node bigint, key bigint, signature binary, least bigint"), "tree-branches")
        stars.append(branches.filter("node IS NULL").select(F.col("key").alias("a"), F.col("least").alias("b")))
        rows = branches.filter("node IS NOT NULL").select("node", "key", "signature")
    small = reduce(DataFrame.unionByName, leaves)
    links = (small.repartition("node").sortWithinPartitions("node")
             .mapInArrow(_compare_leaves, "a bigint, b bigint"))
    return reduce(DataFrame.unionByName, stars, links)


def exact_links(keys: list[int], sets: list[np.ndarray], labels: list[int], asks: list[bool]) -> list[tuple[int, int]]:
    """Links of full sets, compared where the labels differ and one asks: as
    stars over one key of each label that is linked with another."""
    n = len(keys)
    size = np.array([len(s) for s in sets], np.int64)
    ends = np.concatenate([[0], np.cumsum(size)])
    _, token = np.unique(np.concatenate(sets), return_inverse=True)
    mark = np.zeros(int(token.max()) + 1, bool)
    forest, first = Forest(n), {}
    for i, label in enumerate(labels):
        forest.union(first.setdefault(label, i), i)
    order = sorted(range(n), key=lambda i: not asks[i])  # those that ask first
    place = np.array(order)
    for at, i in enumerate(order[:sum(asks)]):
        later = place[at + 1:]
        fits = later[100 * np.minimum(size[later], size[i]) >= PERCENT * np.maximum(size[later], size[i])]
        mine = forest.find(i)
        if not any(forest.find(j) != mine for j in fits.tolist()):
            continue
        mark[token[ends[i]:ends[i + 1]]] = True
        hits = np.concatenate([[0], np.cumsum(mark[token])])
        mark[token[ends[i]:ends[i + 1]]] = False
        common = hits[ends[fits + 1]] - hits[ends[fits]]
        for j in fits[100 * common >= PERCENT * (size[i] + size[fits] - common)].tolist():
            forest.union(i, j)
    reps = list(first.values())
    merged = Forest(len(reps))
    root = {}
    for r, i in enumerate(reps):
        merged.union(root.setdefault(forest.find(i), r), r)
    return merged.stars([keys[i] for i in reps])


def _link_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks (rows sorted by group and block): stars of the exact links."""
    for group, block, key, label, ask, raw in _by_node(batches, ["group", "block"]):
        group, block = group.to_numpy(), block.to_numpy()
        starts = np.flatnonzero(np.concatenate([[True], (group[1:] != group[:-1]) | (block[1:] != block[:-1])]))
        a, b = [], []
        for start, end in zip(starts.tolist(), [*starts[1:].tolist(), len(group)], strict=True):
            mine: dict[int, tuple] = {}
            for k, x, q, s in zip(*(c.slice(start, end - start).to_pylist() for c in (key, label, ask, raw)), strict=True):
                mine[k] = (x, q or mine.get(k, (0, False))[1], s)
            if len(mine) > 1:
                labels, asks, sets = zip(*mine.values(), strict=True)
                for i, j in exact_links(list(mine), [np.frombuffer(s, np.uint64) for s in sets], list(labels), list(asks)):
                    a.append(i), b.append(j)
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def full_sets(docs: DataFrame, members: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """(key, group, shingles) of the members, on shared files. ``members``:
    (__id__, __hash__, key, group). The texts are shuffled to the members once
    (a merge join at every size: members grow with the corpus)."""
    schema = T.StructType([T.StructField("key", T.LongType()), T.StructField("group", T.LongType()),
                           T.StructField("shingles", T.BinaryType())])
    texts = docs.select(id_col, F.col(text_col).alias("__text__"), text_hash(text_col).alias(TEXT_HASH))
    rows = texts.join(members.hint("merge"), F.col(id_col).eqNullSafe(F.col("__id__"))
                      & (F.col(TEXT_HASH) == F.col("__hash__")))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "__text__"):
            sets = shingle_sets(strings(batch.column("__text__")), shingle)
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("group"), pa.array([s.tobytes() for s in sets], pa.binary())],
                names=schema.names)

    return staged(docs.sparkSession, rows.select("key", "group", "__text__").mapInArrow(read, schema), "full-sets")


def confirmed_links(sets: DataFrame) -> DataFrame:
    """Links of full sets within the candidate groups."""
    spark = sets.sparkSession
    link, shape = "a bigint, b bigint", ["group", "block", "key", "label", "ask", "shingles"]

    def linked(rows: DataFrame, name: str) -> DataFrame:
        return staged(spark, rows.select(*shape).repartition("group", "block").sortWithinPartitions("group", "block")
                      .mapInArrow(_link_blocks, link), name)

    sizes = staged(spark, sets.groupBy("group").agg(F.count("*").alias("n"), F.sum(F.length("shingles")).alias("bytes")),
                   "group-sizes")
    blocks = sizes.select("group", "n", F.ceil(F.greatest(F.col("n") / BLOCK, F.col("bytes") / BLOCK_BYTES)).cast("int").alias("blocks"))
    sized = sets.join(blocks, "group")
    everywhere = (F.col("blocks") > 1) & (F.pmod(F.xxhash64("key"), F.col("n")) < SHARED_MEMBERS)
    home = F.pmod(F.xxhash64("key", F.lit(1)), F.col("blocks")).cast("int")
    links = linked(sized.withColumn("block", F.explode(
        F.when(everywhere, F.sequence(F.lit(0), F.col("blocks") - 1)).otherwise(F.array(home))))
        .withColumns({"label": F.col("key"), "ask": F.lit(True)}), "block-links")
    if blocks.filter("blocks > 1").isEmpty():
        return links
    # groups of several blocks: whoever is outside the largest class asks all
    big = sized.filter("blocks > 1")
    root = connected(links.join(big.select(F.col("key").alias("a")).distinct(), "a", "left_semi"))
    labelled = staged(spark, big.select("key", "group", "blocks").join(root.withColumnRenamed("v", "key"), "key", "left")
                      .select("key", "group", "blocks", F.coalesce("root", "key").alias("label")), "labels")
    main = (labelled.groupBy("group", "label").agg(F.count("*").alias("c")).groupBy("group")
            .agg(F.max_by("label", F.struct("c", "label")).alias("main")))
    asking = staged(spark, labelled.join(main, "group").withColumn("ask", F.col("label") != F.col("main")), "asking")
    asks = asking.filter("ask").groupBy("group").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("rounds"))
    if asks.isEmpty():
        return links
    # block of asking members x block of all members
    rows = asking.join(asks, "group").drop("group").join(sets, "key").withColumn("home", home)
    targets = rows.withColumn("r", F.explode(F.sequence(F.lit(0), F.col("rounds") - 1))).select(
        "group", (F.col("r") * F.col("blocks") + F.col("home")).alias("block"), "key", "label",
        F.lit(False).alias("ask"), "shingles")
    part = F.pmod(F.xxhash64("key", F.lit(2)), F.col("rounds")).cast("int")
    askers = rows.filter("ask").withColumn("h", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "group", (part * F.col("blocks") + F.col("h")).alias("block"), "key", "label", "ask", "shingles")
    return links.unionByName(linked(targets.unionByName(askers), "rest-links"))


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                shingle: int = SHINGLE) -> DataFrame:
    """(id, TEXT_HASH, n_shingles, component_id, kept) of every row."""
    spark = docs.sparkSession
    rows = sketch(docs, trees_for(), id_col, text_col, shingle)
    reps = staged(spark, rows.filter("n_shingles > 0").groupBy("set_id").agg(
        F.min(id_col).alias("rep_id"), F.min("key").alias("key"),
        F.first("signature").alias("signature"), F.first("nodes").alias("nodes")), "representatives")
    groups = connected(candidate_links(reps)).select(F.col("v").alias("key"), F.col("root").alias("group"))
    members = staged(spark, rows.select(F.col(id_col).alias("__id__"), F.col(TEXT_HASH).alias("__hash__"), "key")
                     .join(groups, "key"), "members")
    root = connected(confirmed_links(full_sets(docs, members, id_col, text_col, shingle)))
    rooted = staged(spark, reps.join(root, F.col("key") == F.col("v"), "left").select(
        "set_id", "rep_id", F.coalesce("root", "key").alias("root")), "rooted")
    least = staged(spark, rooted.groupBy("root").agg(F.min("rep_id").alias("component_id")), "least")
    of_set = rooted.join(least, "root").select("set_id", "component_id")
    return (rows.select(id_col, TEXT_HASH, "n_shingles", "set_id").join(of_set, "set_id", "left")
            .select(id_col, TEXT_HASH, "n_shingles", F.coalesce("component_id", id_col).alias("component_id"))
            .withColumn("kept", F.col(id_col).eqNullSafe(F.col("component_id"))))


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     shingle: int = SHINGLE) -> DataFrame:
    """One row of each group, with all columns of ``docs``."""
    verdict = staged(docs.sparkSession, near_groups(docs, id_col, text_col, shingle), "near-verdict")
    return keep_rows(docs, verdict, id_col, text_col)
