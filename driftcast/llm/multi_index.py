"""Embedding near-dedup by an inverted multi-index (operator 11).

A unit vector is cut into halves; each half has its own codebook, and the pairs
of codewords form a grid of cells. A vector lies in the cell of its two nearest
codewords and visits the cells in the order of a multi-sequence traversal
(ascending sum of the two distances) until the target recall. Two vectors meet
if either visits the other's cell.

* ``fit`` learns the codebooks (k-means on ``SAMPLE`` rows at most, by hash).
  ``visits_for`` measures how many cells must be visited: so many that
  ``RECALL`` of pairs planted exactly at the threshold meet, and
  ``LINK_RECALL`` of the links that ``QUERIES`` sampled vectors have by brute
  force against all rows.
* What travels is a byte per component with a proven error (an angle), not the
  vector. Angles decide by the triangle inequality: surely linked, surely not,
  or open; open pairs are verified on full vectors in double precision.
* A cell of more than ``HOT`` vectors is first reduced to balls (a centre, a
  radius, a number of members) small enough that all members are linked with
  each other, so a group of near copies that holds a third of the table meets
  others as a few balls, and no pair within it is written out. Tasks return
  sums and stars, never all pairs.

Defined cases: a vector that is null, empty, zero or holds null or non-finite
components is linked with nothing and is its own component; vectors shorter
than the longest count as padded with zeros; repeated rows are vectors of their
own; a null id is larger than any other; an empty table gives an empty result;
other columns are not read; ties of distances fall to the smaller codeword.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftcast.llm.common import mix, staged, take_field
from driftcast.llm.components import connected

THRESHOLD = 0.9
SAMPLE, QUERIES, ROUNDS = 65_536, 256, 8
RECALL, LINK_RECALL = 0.95, 0.999
MAX_VISITS = 256
# Vectors of a cell before it is reduced to balls, and of one reducing task.
HOT, BALL_TASK = 256, 1024
# Balls of one first codeword that one task holds; vectors compared at once.
TILE, BATCH = 16_384, 512
# Rounding of angles computed in double precision.
SLACK = 1e-7


def unit_rows(column: pa.Array, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors of a list column, zero-padded to ``dim``, and which rows
    have one (finite, not zero)."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    size = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = pc.fill_null(pc.cast(column.flatten(), pa.float64()), math.nan).to_numpy(zero_copy_only=False)
    out = np.zeros((len(size), dim))
    row = np.repeat(np.arange(len(size)), size)
    out[row, np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)] = flat
    top = np.abs(out).max(axis=1, initial=0.0)
    good = np.isfinite(top) & (top > 0)
    out[~good] = 0
    out[good] /= top[good, None]
    out[good] /= np.sqrt((out[good] ** 2).sum(axis=1, keepdims=True))
    return out, good


def codes(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A signed byte per component, the unit vector those stand for, and the
    angle between the two."""
    code = np.rint(unit * (127 / np.abs(unit).max(axis=1, keepdims=True))).astype(np.int8)
    near = decode(code)
    return code, near, 2 * np.arcsin(np.minimum(1, np.sqrt(((unit - near) ** 2).sum(axis=1)) / 2)) + SLACK


def decode(code: np.ndarray) -> np.ndarray:
    near = code.astype(np.float64)
    return near / np.sqrt((near ** 2).sum(axis=1, keepdims=True))


def _distances(x: np.ndarray, book: np.ndarray) -> np.ndarray:
    """Squared distances to the codewords, less the vectors' own part."""
    return (book ** 2).sum(axis=1) - 2 * x @ book.T


def k_means(x: np.ndarray, k: int, seed: int) -> np.ndarray:
    """Lloyd's rounds from distinct rows; a codeword without rows stays."""
    book = x[np.random.default_rng(seed).choice(len(x), k, replace=False)].copy()
    for _ in range(ROUNDS):
        near = np.concatenate([_distances(x[i:i + 8192], book).argmin(axis=1) for i in range(0, len(x), 8192)])
        count = np.bincount(near, minlength=k)
        order = np.argsort(near, kind="stable")
        ends = np.cumsum(count)
        total = np.add.reduceat(x[order], np.minimum(ends - count, len(x) - 1), axis=0)
        book[count > 0] = total[count > 0] / count[count > 0, None]
    return book


class Grid:
    """Two codebooks, the cells they span and the cells a vector visits."""

    def __init__(self, first: np.ndarray, second: np.ndarray, visits: int = 1):
        self.first, self.second, self.visits = first, second, visits

    @property
    def cells(self) -> int:
        return len(self.first) * len(self.second)

    def traverse(self, unit: np.ndarray, visits: int) -> np.ndarray:
        """The first ``visits`` cells of every vector's multi-sequence
        traversal, in order. A cell at places (a, b) of the two sorted
        sequences comes after (a + 1)(b + 1) - 1 others, so only cells with
        that product up to ``visits`` are looked at."""
        half, visits = self.first.shape[1], min(visits, self.cells)
        a, b = np.array([(i, j) for i in range(min(visits, len(self.first)))
                         for j in range(min(visits // (i + 1), len(self.second)))]).T
        out = np.zeros((len(unit), visits), np.int32)
        for s in range(0, len(unit), 1024):
            d1, d2 = _distances(unit[s:s + 1024, :half], self.first), _distances(unit[s:s + 1024, half:], self.second)
            o1, o2 = np.argsort(d1, axis=1, kind="stable")[:, :visits], np.argsort(d2, axis=1, kind="stable")[:, :visits]
            total = np.take_along_axis(d1, o1, 1)[:, a] + np.take_along_axis(d2, o2, 1)[:, b]
            best = np.argsort(total, axis=1, kind="stable")[:, :visits]
            out[s:s + 1024] = o1[np.arange(len(o1))[:, None], a[best]] * len(self.second) + o2[np.arange(len(o2))[:, None], b[best]]
        return out


def _meeting(grid: Grid, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """For pairs of rows: the visits after which the two have met."""
    cells_x, cells_y = grid.traverse(x, MAX_VISITS), grid.traverse(y, MAX_VISITS)

    def place(seen, cell):
        hit = seen == cell[:, None]
        return np.where(hit.any(axis=1), hit.argmax(axis=1), MAX_VISITS) + 1
    return np.minimum(place(cells_x, cells_y[:, 0]), place(cells_y, cells_x[:, 0]))


def vectors(docs: DataFrame, id_col: str, vector_col: str) -> tuple[DataFrame, int]:
    """(key, id, vector) of all rows on shared files, keys in random order;
    and the longest vector's length."""
    schema = T.StructType([T.StructField("key", T.LongType()), take_field(docs, id_col), take_field(docs, vector_col)])

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            key = mix(np.arange(row, row + batch.num_rows, dtype=np.uint64)).astype(np.int64)
            row += batch.num_rows
            yield pa.RecordBatch.from_arrays([pa.array(key), *batch.columns], names=schema.names)

    out = staged(docs.sparkSession, docs.select(id_col, vector_col).mapInArrow(number, schema), "vectors")
    longest = out.filter(F.col(vector_col).isNotNull()).agg(F.max(F.size(vector_col))).first()[0]
    return out, longest or 0


def sample(rows: DataFrame, vector_col: str, dim: int, n_rows: int, limit: int, seed: int) -> np.ndarray:
    """Unit vectors of at most about ``limit`` rows, by hash of their key."""
    part = F.pmod(F.xxhash64("key", F.lit(seed)), F.lit(1 << 20)) < math.ceil(limit / max(n_rows, 1) * (1 << 20))
    # a documented bound: limit rows and some
    table = rows.filter(part).select(vector_col).toArrow()
    unit, good = unit_rows(table.column(vector_col), dim)
    return unit[good]


def fit(rows: DataFrame, vector_col: str, dim: int, n_rows: int, threshold: float = THRESHOLD) -> Grid | None:
    """The grid with its number of visits; None without any vector."""
    unit = sample(rows, vector_col, dim, n_rows, SAMPLE, 1)
    if not len(unit):
        return None
    k = int(max(1, min(len(unit) // 4, 2 ** round(math.log2(max(1.0, math.sqrt(n_rows) / 4))))))
    half = (dim + 1) // 2
    grid = Grid(k_means(unit[:, :half], k, 1), k_means(unit[:, half:], k, 2) if dim > half else np.zeros((1, 0)))
    grid.visits = visits_for(grid, rows, vector_col, dim, sample(rows, vector_col, dim, n_rows, QUERIES, 2), unit, threshold)
    return grid


def visits_for(grid: Grid, rows: DataFrame, vector_col: str, dim: int, queries: np.ndarray, unit: np.ndarray,
               threshold: float) -> int:
    """Cells to visit: the target recalls of planted pairs at the threshold,
    and of the queries' links, found by brute force against all rows."""
    rng = np.random.default_rng(3)
    base = unit[rng.choice(len(unit), min(len(unit), 2048), replace=False)]
    aside = rng.normal(size=base.shape)
    aside -= (aside * base).sum(axis=1, keepdims=True) * base
    aside /= np.maximum(np.sqrt((aside ** 2).sum(axis=1, keepdims=True)), 1e-12)
    planted = _meeting(grid, base, threshold * base + math.sqrt(1 - threshold ** 2) * aside)
    visits = int(np.quantile(planted, RECALL, method="higher"))
    shared = rows.sparkSession.sparkContext.broadcast((grid, queries))

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grid, queries = shared.value
        count = np.zeros(MAX_VISITS + 2, np.int64)
        for batch in batches:
            x, good = unit_rows(batch.column(0), dim)
            x = x[good]
            cosine = x @ queries.T
            at, q = np.nonzero((cosine >= threshold) & (cosine < 1 - 1e-12))
            for i in range(0, len(at), 4096):
                count += np.bincount(_meeting(grid, x[at[i:i + 4096]], queries[q[i:i + 4096]]), minlength=len(count))
        yield pa.RecordBatch.from_arrays([pa.array(np.flatnonzero(count)), pa.array(count[count > 0])], names=["visit", "n"])

    found = rows.select(vector_col).mapInArrow(meet, "visit bigint, n bigint").groupBy("visit").agg(F.sum("n").alias("n"))
    hist = np.zeros(MAX_VISITS + 2, np.int64)
    for visit, n in found.collect():  # at most MAX_VISITS + 1 rows
        hist[visit] = n
    if hist.any():
        done = np.cumsum(hist) / hist.sum()
        visits = max(visits, int(np.argmax(done >= LINK_RECALL)))
    return max(1, min(visits, MAX_VISITS, grid.cells))


_CODED = T.StructType([
    T.StructField("ball", T.LongType()), T.StructField("cell", T.IntegerType()), T.StructField("code", T.BinaryType()),
    T.StructField("radius", T.DoubleType()), T.StructField("n", T.LongType()), T.StructField("visits", T.BinaryType())])


def _coded(keys: pa.Array, cell: np.ndarray, code: np.ndarray, radius: np.ndarray, n: np.ndarray,
           visits: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [keys, pa.array(cell, pa.int32()), _blobs(code), pa.array(radius), pa.array(n, pa.int64()), _blobs(visits)],
        names=_CODED.names)


def _blobs(rows: np.ndarray) -> pa.Array:
    """Each row of a matrix as bytes."""
    width = rows.shape[1] * rows.itemsize
    ends = np.arange(len(rows) + 1, dtype=np.int32) * np.int32(width)
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(ends.tobytes()),
                                                          pa.py_buffer(np.ascontiguousarray(rows).tobytes())])


def _matrix(column: pa.Array, dtype, width: int) -> np.ndarray:
    """The bytes of all rows as a matrix."""
    return np.frombuffer(b"".join(column.to_pylist()), dtype).reshape(len(column), width)


def coded(rows: DataFrame, vector_col: str, dim: int, shared) -> DataFrame:
    """Every vector as a ball of one: its cell, code, error and visited cells."""
    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grid = shared.value
        for batch in batches:
            unit, good = unit_rows(batch.column(vector_col), dim)
            if good.any():
                unit = unit[good]
                code, _, radius = codes(unit)
                visits = grid.traverse(unit, grid.visits)
                yield _coded(batch.column("key").filter(pa.array(good)), visits[:, 0], code, radius,
                             np.ones(len(unit), np.int64), visits)

    return rows.select("key", vector_col).mapInArrow(assign, _CODED)


def group_balls(near: np.ndarray, radius: np.ndarray, limit: float) -> list[tuple[np.ndarray, np.ndarray, float]]:
    """(members, centre's code, radius) of balls that hold all given balls;
    radii stay within ``limit`` unless a ball of one is wider."""
    left, out = np.arange(len(near)), []
    while len(left):
        angle = np.arccos(np.clip(near[left] @ near[left[0]], -1, 1)) + radius[left]
        angle[0] = 0
        inside = left[angle <= limit]
        left = left[angle > limit]
        if len(inside) == 1:
            out.append((inside, np.rint(near[inside[0]] * (127 / np.abs(near[inside[0]]).max())).astype(np.int8), float(radius[inside[0]])))
            continue
        mean = near[inside].mean(axis=0, keepdims=True)
        for centre in (mean / max(np.sqrt((mean ** 2).sum()), 1e-12), near[inside[:1]]):
            code, point, _ = codes(centre)
            wide = float((np.arccos(np.clip(near[inside] @ point[0], -1, 1)) + radius[inside] + SLACK).max())
            if wide <= limit:
                break
        if wide > limit:  # the pivot's rounding alone: members of their own
            out += [(inside[i:i + 1], np.rint(near[x] * (127 / np.abs(near[x]).max())).astype(np.int8), float(radius[x]))
                    for i, x in enumerate(inside)]
        else:
            out.append((inside, code[0], wide))
    return out


def reduce_hot(points: DataFrame, hot: DataFrame, dim: int, shared, threshold: float) -> tuple[DataFrame, DataFrame]:
    """(balls, members (key, ball)) of the hot cells' vectors. A cell is dealt
    to as many tasks as it needs; each returns its own balls."""
    limit = math.acos(threshold) / 2
    shape = T.StructType([*_CODED.fields, T.StructField("key", T.LongType())])
    salted = points.join(hot, "cell").withColumn(
        "salt", F.pmod(F.xxhash64("ball"), F.ceil(F.col("cell_rows") / BALL_TASK)).cast("int"))

    def balls(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grid = shared.value
        for table in grouped(batches, ["cell", "salt"]):
            near = decode(_matrix(table.column("code"), np.int8, dim))
            radius, key, cell = (table.column(c).to_numpy() for c in ("radius", "ball", "cell"))
            found = group_balls(near, radius, limit)
            code = np.stack([c for _, c, _ in found])
            visits = grid.traverse(decode(code), grid.visits)
            visits[(visits != cell[0]).all(axis=1), -1] = cell[0]  # its members' own cell is among them
            head = [int(key[m[0]]) for m, _, _ in found]
            yield pa.RecordBatch.from_arrays(
                [*_coded(pa.array(head), np.full(len(found), cell[0]), code, np.array([r for _, _, r in found]),
                         np.array([len(m) for m, _, _ in found]), visits).columns, pa.nulls(len(found), pa.int64())],
                names=shape.names)
            member = np.concatenate([m for m, _, _ in found])
            ball = np.repeat(np.array(head, np.int64), [len(m) for m, _, _ in found])
            blank = [pa.nulls(len(member), t) for t in (pa.int32(), pa.binary(), pa.float64(), pa.int64(), pa.binary())]
            yield pa.RecordBatch.from_arrays([pa.array(ball), *blank, pa.array(key[member])], names=shape.names)

    out = staged(points.sparkSession, salted.repartition("cell", "salt").sortWithinPartitions("cell", "salt")
                 .select("cell", "salt", "ball", "code", "radius").mapInArrow(balls, shape), "balls")
    return out.filter("key IS NULL").drop("key"), out.filter("key IS NOT NULL").select("key", "ball")


def grouped(batches: Iterator[pa.RecordBatch], columns: list[str]) -> Iterator[pa.Table]:
    """The groups of rows sorted by ``columns``, one table each."""
    rest: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        parts = [batch.column(c).to_numpy() for c in columns]
        change = np.flatnonzero(np.any([p[1:] != p[:-1] for p in parts], axis=0)) + 1
        first = tuple(p[0] for p in parts)
        if rest and tuple(rest[-1].column(c)[-1].as_py() for c in columns) != first:
            yield pa.Table.from_batches(rest).combine_chunks()
            rest = []
        at = 0
        for end in change.tolist():
            rest.append(batch.slice(at, end - at))
            yield pa.Table.from_batches(rest).combine_chunks()
            rest, at = [], end
        rest.append(batch.slice(at))
    if rest:
        yield pa.Table.from_batches(rest).combine_chunks()


def stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges as (vertex, least vertex of its component)."""
    vertex, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    a, b = at[:len(a)], at[len(a):]
    label = np.arange(len(vertex))
    while True:
        low = label.copy()
        np.minimum.at(low, a, label[b])
        np.minimum.at(low, b, label[a])
        low = low[low]
        if (low == label).all():
            break
        label = low
    apart = label != np.arange(len(vertex))
    return vertex[apart], vertex[label[apart]]


# What the comparing tasks return: links added to a ball or vector, an edge of
# the components, or a pair of balls still open.
_FOUND = T.StructType([T.StructField("kind", T.IntegerType()), T.StructField("a", T.LongType()),
                       T.StructField("b", T.LongType()), T.StructField("n", T.LongType())])
_SUM, _EDGE, _OPEN = 0, 1, 2


def _found(kind: int, a: np.ndarray, b: np.ndarray | None = None, n: np.ndarray | None = None) -> pa.RecordBatch:
    none = pa.nulls(len(a), pa.int64())
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(len(a), kind), pa.int32()), pa.array(a, pa.int64()),
         none if b is None else pa.array(b, pa.int64()), none if n is None else pa.array(n, pa.int64())],
        names=_FOUND.names)


def _linked(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Sums and stars of linked pairs, where ``a`` stands for ``n_a`` vectors."""
    who, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    total = np.zeros(len(who), np.int64)
    np.add.at(total, at, np.concatenate([n_b, n_a]))
    yield _found(_SUM, who, n=total)
    yield _found(_EDGE, *stars(a, b))


def compare(balls: DataFrame, cells: DataFrame, dim: int, shared, threshold: float) -> DataFrame:
    """Balls against the balls of the cells they visit. A row per ball and
    first codeword travels (the visited cells with it), and a pair in which
    both visit the other is decided by one side. ``cells``: balls per cell."""
    theta, second, visits = math.acos(threshold), len(shared.value.second), shared.value.visits
    spark = balls.sparkSession
    # at most one row per first codeword
    tiles = {r: -(-n // TILE) for r, n in cells.groupBy(F.floor(F.col("cell") / second).cast("int").alias("row"))
             .agg(F.sum("cell_rows").alias("n")).filter(F.col("n") > TILE).collect()}
    deal = spark.sparkContext.broadcast(tiles)
    shape = T.StructType([T.StructField("row", T.IntegerType()), T.StructField("tile", T.IntegerType()),
                          T.StructField("asks", T.IntegerType()), *_CODED.fields])

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell, ball = batch.column("cell").to_numpy(), batch.column("ball").to_numpy()
            seen = _matrix(batch.column("visits"), np.int32, visits)
            home = cell // second
            count = np.array([deal.value.get(r, 1) for r in home.tolist()], np.int64)
            tile = (mix(ball.astype(np.uint64)) % count.astype(np.uint64)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(home, pa.int32()), pa.array(tile), pa.array(np.zeros(len(home)), pa.int32()), *batch.columns],
                names=shape.names)
            # one asking row per ball, first codeword and tile
            flat = np.sort(seen, axis=1).ravel()
            owner, row = np.repeat(np.arange(len(seen)), visits), flat // second
            start = np.flatnonzero(np.concatenate([[True], (owner[1:] != owner[:-1]) | (row[1:] != row[:-1])]))
            end = np.append(start[1:], len(flat))
            copies = np.array([deal.value.get(r, 1) for r in row[start].tolist()], np.int64)
            tile = np.arange(copies.sum()) - np.repeat(np.cumsum(copies) - copies, copies)
            start, end = np.repeat(start, copies), np.repeat(end, copies)
            raw = np.ascontiguousarray(flat, np.int32).tobytes()
            part = pa.array([raw[4 * s:4 * e] for s, e in zip(start.tolist(), end.tolist(), strict=True)], pa.binary())
            taken = batch.take(pa.array(owner[start]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(row[start], pa.int32()), pa.array(tile, pa.int32()), pa.array(np.ones(len(start)), pa.int32()),
                 *taken.columns[:-1], part], names=shape.names)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for home, ask in _homes_and_askers(batches):
            yield from _decide(home, ask, dim, visits, theta)

    sent = balls.mapInArrow(send, shape)
    return staged(spark, sent.repartition("row", "tile").sortWithinPartitions("row", "tile", "asks")
                  .mapInArrow(meet, _FOUND), "index-links")


def _homes_and_askers(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, pa.RecordBatch]]:
    """(all balls at home in a row and tile, some of the balls that ask there):
    rows come sorted by row, tile and asks, so only homes are held."""
    at, homes, table = None, [], None
    for batch in batches:
        row, tile, asks = (batch.column(c).to_numpy() for c in ("row", "tile", "asks"))
        edge = np.flatnonzero((row[1:] != row[:-1]) | (tile[1:] != tile[:-1]) | (asks[1:] != asks[:-1])) + 1
        for start, end in zip([0, *edge.tolist()], [*edge.tolist(), len(row)], strict=True):
            if start == end:
                continue
            if (row[start], tile[start]) != at:
                at, homes, table = (row[start], tile[start]), [], None
            piece = batch.slice(start, end - start)
            if not asks[start]:
                homes.append(piece)
            elif homes:
                table = pa.Table.from_batches(homes).combine_chunks() if table is None else table
                for i in range(0, piece.num_rows, BATCH):
                    yield table, piece.slice(i, BATCH)


def _decide(home: pa.Table, ask: pa.RecordBatch, dim: int, visits: int, theta: float) -> Iterator[pa.RecordBatch]:
    cell = home.column("cell").to_numpy()
    order = np.argsort(cell, kind="stable")
    cell = cell[order]
    raw = ask.column("visits").to_pylist()
    who = np.repeat(np.arange(len(raw)), [len(r) // 4 for r in raw])
    seen = np.frombuffer(b"".join(raw), np.int32)
    start, end = np.searchsorted(cell, seen), np.searchsorted(cell, seen, side="right")
    full = end > start
    if not full.any():
        return
    a_ball, a_radius, a_n, a_cell = (ask.column(c).to_numpy() for c in ("ball", "radius", "n", "cell"))
    b_ball, b_radius, b_n = (home.column(c).to_numpy()[order] for c in ("ball", "radius", "n"))
    a_near, b_near = decode(_matrix(ask.column("code"), np.int8, dim)), None
    b_code = _matrix(home.column("code").combine_chunks() if isinstance(home.column("code"), pa.ChunkedArray)
                     else home.column("code"), np.int8, dim)
    b_visits = home.column("visits").to_pylist()
    pairs_a, pairs_b, angles = [], [], []
    who, seen, start, end = who[full], seen[full], start[full], end[full]
    by = np.argsort(seen, kind="stable")
    cut = np.flatnonzero(np.concatenate([[True], np.diff(seen[by]) != 0, [True]]))
    reach = theta + a_radius.max() + b_radius.max()
    for s, e in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):
        mine, lo, hi = who[by[s:e]], int(start[by[s]]), int(end[by[s]])
        b_near = decode(b_code[order[lo:hi]])
        cosine = a_near[mine] @ b_near.T
        i, j = np.nonzero(cosine >= (math.cos(reach) if reach < math.pi else -1) - 1e-9)
        pairs_a.append(mine[i]), pairs_b.append(lo + j), angles.append(np.arccos(np.clip(cosine[i, j], -1, 1)))
    a, b, angle = np.concatenate(pairs_a), np.concatenate(pairs_b), np.concatenate(angles)
    keep = (a_ball[a] != b_ball[b]) & (angle - a_radius[a] - b_radius[b] - SLACK <= theta)
    a, b, angle = a[keep], b[keep], angle[keep]
    if not len(a):
        return
    # where both visit the other's cell, the smaller ball decides
    used, at = np.unique(b, return_inverse=True)
    back = np.frombuffer(b"".join(b_visits[order[x]] for x in used.tolist()), np.int32).reshape(len(used), visits)
    mutual = np.zeros(len(a), bool)
    for s in range(0, len(a), 1 << 16):
        mutual[s:s + (1 << 16)] = (back[at[s:s + (1 << 16)]] == a_cell[a[s:s + (1 << 16)], None]).any(axis=1)
    mine = ~mutual | (a_ball[a] < b_ball[b])
    a, b, angle = a[mine], b[mine], angle[mine]
    sure = angle + a_radius[a] + b_radius[b] + SLACK <= theta
    if sure.any():
        x, y = a[sure], b[sure]
        yield from _linked(a_ball[x], b_ball[y], a_n[x], b_n[y])
    if not sure.all():
        yield _found(_OPEN, a_ball[a[~sure]], b_ball[b[~sure]])


def verify(open_pairs: DataFrame, members: DataFrame, vector_col: str, dim: int, threshold: float) -> DataFrame:
    """Open pairs of balls on their members' full vectors, in double precision.
    ``members``: (key, ball, vector)."""
    sides = open_pairs.select(F.monotonically_increasing_id().alias("pair"), "a", "b")
    sides = staged(open_pairs.sparkSession, sides, "open-pairs")
    rows = (sides.select("pair", F.col("a").alias("ball"), F.lit(0).alias("side"))
            .unionByName(sides.select("pair", F.col("b").alias("ball"), F.lit(1).alias("side"))).join(members, "ball"))

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in grouped(batches, ["pair"]):
            unit, _ = unit_rows(table.column(vector_col), dim)
            key, side = table.column("key").to_numpy(), table.column("side").to_numpy()
            left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
            for i in range(0, len(left), 1024):
                a, b = np.nonzero(unit[left[i:i + 1024]] @ unit[right].T >= threshold)
                if len(a):
                    a, b = left[a + i], right[b]
                    yield from _linked(key[a], key[b], np.ones(len(a), np.int64), np.ones(len(b), np.int64))

    return rows.select("pair", "side", "key", vector_col).repartition("pair").sortWithinPartitions("pair").mapInArrow(check, _FOUND)


def near_vectors(docs: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                 threshold: float = THRESHOLD, hot: int = HOT) -> DataFrame:
    """(id, n_links, component_id, kept) of every row."""
    spark = docs.sparkSession
    rows, dim = vectors(docs, id_col, vector_col)
    grid = fit(rows, vector_col, dim, rows.count(), threshold) if dim else None
    if grid is None:
        return rows.select(id_col, F.lit(0).cast("long").alias("n_links"), F.col(id_col).alias("component_id"),
                           F.lit(True).alias("kept"))
    shared = spark.sparkContext.broadcast(grid)
    points = coded(rows, vector_col, dim, shared)
    cells = staged(spark, points.groupBy("cell").agg(F.count("*").alias("cell_rows")), "cells")
    crowded = cells.filter(F.col("cell_rows") > hot)
    balls, members = points, rows.select("key", F.col("key").alias("ball"))
    if not crowded.isEmpty():
        thick, inside = reduce_hot(points, crowded, dim, shared, threshold)
        balls = points.join(crowded, "cell", "left_anti").select(*_CODED.names).unionByName(thick)
        cells = (cells.filter(F.col("cell_rows") <= hot)
                 .unionByName(thick.groupBy("cell").agg(F.count("*").alias("cell_rows"))))
        members = staged(spark, rows.select("key").join(inside, "key", "left")
                         .select("key", F.coalesce("ball", "key").alias("ball")), "ball-members")
    found = compare(balls, cells, dim, shared, threshold)
    sums, edges = found.filter(F.col("kind") == _SUM), found.filter(F.col("kind") == _EDGE)
    of_vectors = spark.createDataFrame([], "key bigint, links bigint")
    pairs = found.filter(F.col("kind") == _OPEN)
    if not pairs.isEmpty():
        exact = staged(spark, verify(pairs, members.join(rows.select("key", vector_col), "key"), vector_col, dim, threshold),
                       "verified")
        of_vectors = exact.filter(F.col("kind") == _SUM).groupBy(F.col("a").alias("key")).agg(F.sum("n").alias("links"))
        # an edge between vectors is one between their balls
        ends = exact.filter(F.col("kind") == _EDGE).select("a", "b")
        edges = edges.select("a", "b").unionByName(
            ends.join(members.select(F.col("key").alias("a"), F.col("ball").alias("ball_a")), "a")
            .join(members.select(F.col("key").alias("b"), F.col("ball").alias("ball_b")), "b")
            .select(F.col("ball_a").alias("a"), F.col("ball_b").alias("b")))
    per_ball = sums.groupBy(F.col("a").alias("ball")).agg(F.sum("n").alias("ball_links"))
    size = members.groupBy("ball").agg(F.count("*").alias("ball_size"))
    root = connected(edges.select("a", "b")).select(F.col("v").alias("ball"), "root")
    placed = staged(spark, rows.select("key", F.col(id_col).alias("__id__")).join(members, "key")
                    .join(size.join(per_ball, "ball", "left").join(root, "ball", "left"), "ball")
                    .join(of_vectors, "key", "left")
                    .select("__id__", F.coalesce("root", "ball").alias("root"),
                            (F.coalesce("ball_links", F.lit(0)) + F.coalesce("links", F.lit(0))
                             + F.col("ball_size") - 1).alias("n_links")), "vector-links")
    least = placed.groupBy("root").agg(F.min("__id__").alias("component_id"))
    return (placed.join(least, "root")
            .select(F.col("__id__").alias(id_col), "n_links", F.coalesce("component_id", "__id__").alias("component_id"))
            .withColumn("kept", F.col(id_col).eqNullSafe(F.col("component_id"))))
