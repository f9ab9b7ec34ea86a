"""Operators on vectors, conversations and words against plain versions, with
the awkward rows: nulls, ties, repeated rows, very long texts, empty tables
and columns named like the outputs."""

import math
import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from driftcast.llm import conversations, multi_index, spelling
from driftcast.llm.queries_groups import QUERIES
from tests.helpers import rows_of
from tests.llm import brute

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_sql(spark, duck, name):
    query, sql = QUERIES[name]
    ours = query(spark, SMALL)
    rows = [tuple(r) for r in ours.collect()]
    theirs = duck.sql(sql)
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert rows_of(ours.columns, rows) == rows_of(theirs.columns, theirs.fetchall())


# --- vectors ---------------------------------------------------------------

def vector_rows(spark, rows, kind="double"):
    return spark.createDataFrame(rows, f"vec_id bigint, embedding array<{kind}>").withColumns(
        {c: F.lit(f"own {c}") for c in ("key", "ball", "cell", "code", "n_links", "component_id", "kept", "root", "n", "visits")})


def planted_vectors(n_alone=120, dim=24, seed=5):
    """Vectors alone, chains just above and below the threshold, a wide ring
    around a centre, and a tight group."""
    rng = np.random.default_rng(seed)

    def unit(x):
        return x / np.linalg.norm(x)

    def aside(x, cosine):
        y = rng.normal(size=dim)
        y = unit(y - (y @ x) * x)
        return cosine * x + math.sqrt(1 - cosine ** 2) * y

    out = [unit(rng.normal(size=dim)) * rng.uniform(0.1, 10) for _ in range(n_alone)]
    for cosine in (0.89, 0.8995, 0.8999, 0.9001, 0.9005, 0.92, 0.99):
        for _ in range(6):
            x = unit(rng.normal(size=dim))
            out += [x, aside(x, cosine)]
    ring, tight = unit(rng.normal(size=dim)), unit(rng.normal(size=dim))
    out += [aside(ring, 0.95) for _ in range(60)]
    out += [aside(tight, 0.995) for _ in range(80)]
    order = rng.permutation(len(out))
    return [(int(k) * 3, [float(v) for v in out[i]]) for k, i in zip(rng.permutation(len(out)), order, strict=True)]


ODD_VECTORS = [(9001, None), (9002, []), (9003, [0.0] * 24), (9004, [1.0] * 23 + [math.nan]), (9005, [1.0] * 23 + [None]),
               (9006, [math.inf] + [1.0] * 23), (None, [1.0] + [0.0] * 23), (9007, [2.0]), (9008, [3.0, 0.0]),
               (9008, [3.0, 0.0]), (9009, [1e300, 1e290]), (9010, [-1.0])]


@pytest.mark.parametrize("hot", [256, 16])
def test_near_vectors(spark, hot, monkeypatch):
    """All links, also open ones near the threshold, with and without balls."""
    monkeypatch.setattr(multi_index, "BALL_TASK", 24)
    monkeypatch.setattr(multi_index, "RECALL", 1.0)  # pairs at the threshold itself, too
    rows = planted_vectors() + ODD_VECTORS
    out = multi_index.near_vectors(vector_rows(spark, rows).repartition(4), hot=hot)
    assert out.columns == ["vec_id", "n_links", "component_id", "kept"]
    got, want = out.collect(), brute.near_vectors(rows)
    assert sorted(map(repr, ((r[0], r[1], r[2]) for r in got))) == sorted(map(repr, want))
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got)


def test_near_vectors_of_floats_and_of_nothing(spark, monkeypatch):
    monkeypatch.setattr(multi_index, "RECALL", 1.0)
    rows = [(i, [float(x) for x in np.float32(v)]) for i, v in planted_vectors(30, 24, 8)]
    out = multi_index.near_vectors(vector_rows(spark, rows, "float"))
    assert sorted((r[0], r[1], r[2]) for r in out.collect()) == sorted(brute.near_vectors(rows))
    for odd in ([], ODD_VECTORS[:4]):
        none = multi_index.near_vectors(vector_rows(spark, odd))
        assert sorted(tuple(r) for r in none.collect()) == sorted((i, 0, i, True) for i, _ in odd)


def test_traversal_is_by_ascending_sum():
    rng = np.random.default_rng(1)
    grid = multi_index.Grid(rng.normal(size=(9, 5)), rng.normal(size=(7, 4)))
    x = rng.normal(size=(40, 9))
    cells = grid.traverse(x, 30)
    for row, mine in zip(x, cells, strict=True):
        total = ((grid.first - row[:5]) ** 2).sum(axis=1)[:, None] + ((grid.second - row[5:]) ** 2).sum(axis=1)
        assert mine.tolist() == np.argsort(total.ravel(), kind="stable")[:30].tolist()
    assert (np.sort(grid.traverse(x, 500), axis=1) == np.arange(63)).all()


def test_measured_recall(spark):
    """The index alone (few visited cells) against brute force."""
    rng = np.random.default_rng(11)
    base = rng.normal(size=(3000, 32))
    rows = [(i, [float(v) for v in x]) for i, x in enumerate(
        np.concatenate([base, base[:600] + 0.25 * rng.normal(size=(600, 32))]))]
    docs = vector_rows(spark, rows)
    staged, dim = multi_index.vectors(docs, "vec_id", "embedding")
    grid = multi_index.fit(staged, "embedding", dim, len(rows))
    assert grid.visits < grid.cells / 2
    x = np.array([v for _, v in rows])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    links = (x @ x.T >= 0.9).sum() - len(x)
    found = sum(r["n_links"] for r in multi_index.near_vectors(docs).collect())
    assert found <= links and found >= 0.95 * links


def test_balls_keep_within_the_limit():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(1, 16)) + 0.08 * rng.normal(size=(300, 16))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    _, near, radius = multi_index.codes(x)
    limit = math.acos(0.9) / 2
    balls = multi_index.group_balls(near, radius, limit)
    assert sorted(i for m, _, _ in balls for i in m.tolist()) == list(range(300)) and len(balls) < 60
    for members, code, wide in balls:
        centre = multi_index.decode(code[None])[0]
        angle = np.arccos(np.clip(x[members] @ centre, -1, 1))
        assert (angle <= wide).all() and (len(members) == 1 or wide <= limit)
        assert (x[members] @ x[members].T >= 0.9).all()


def test_a_tight_group_writes_no_pairs(spark):
    """A third of the table in one tight group: rows found stay far below its pairs."""
    rng = np.random.default_rng(3)
    group = rng.normal(size=(1, 16)) + 0.03 * rng.normal(size=(2000, 16))
    rows = [(i, [float(v) for v in x]) for i, x in enumerate(np.concatenate([group, rng.normal(size=(4000, 16))]))]
    docs, dim = multi_index.vectors(vector_rows(spark, rows), "vec_id", "embedding")
    shared = spark.sparkContext.broadcast(multi_index.fit(docs, "embedding", dim, len(rows)))
    points = multi_index.coded(docs, "embedding", dim, shared)
    cells = points.groupBy("cell").agg(F.count("*").alias("cell_rows"))
    thick, members = multi_index.reduce_hot(points, cells.filter("cell_rows > 256"), dim, shared, 0.9)
    assert members.count() >= 1900 and thick.count() < 200
    total = {r["vec_id"]: r["n_links"] for r in multi_index.near_vectors(vector_rows(spark, rows)).collect()}
    assert all(total[i] >= 1999 for i in range(2000))


# --- conversations -----------------------------------------------------------

ODD_TURNS = [
    (None, 0, "user", "Who am I?"), (None, None, "assistant", "Nobody."), (None, 1, None, "x."), (None, 2, "user", None),
    (501, 1, "user", "A."), (501, 1, "user", "A."), (501, 1, "assistant", "B."), (501, 7, "system", "Late."), (501, None, "", "?"),
    (502, 3, "assistant", "cut off"), (503, 2, "user", " \t\n "), (504, -5, "system", "One."), (504, 9, "system", "Two."),
    (505, 0, "tool", "Ünï. "), (505, 1, "User", "x!"), (506, 0, "user", "long. " * 200_000), (506, 1, "assistant", "ok."),
    (507, 2 ** 62, "user", "far."), (507, -2 ** 62, "assistant", "away."),
]


def turns(spark, rows):
    return spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").withColumns(
        {c: F.lit(f"own {c}") for c in ("conv", "place", "chunk", "codes", "edits", "kind", "audit", "cost", "digest")}).repartition(3)


def random_turns(n, seed=1):
    rng = random.Random(seed)
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "aide", "sage"]
    return [(conv, t, rng.choice(roles), rng.choice(["Yes.", "No!", "cut", "", f"Text {rng.random()}?", f"open {rng.random()}"]))
            for conv in range(n) for t in sorted(rng.sample(range(30), rng.randint(1, 14)))]


@pytest.mark.parametrize("chunk", [4096, 4])
def test_audits(spark, chunk):
    """Against a search by cost; small chunks cut every conversation."""
    rows = ODD_TURNS + random_turns(60)
    by_conv = brute.damaged_turns(rows)
    out = conversations.audits(turns(spark, rows), chunk)
    got = {r["conv_id"]: tuple(r)[1:] for r in out.collect()}
    want = {c: brute.audit(mine)[0] for c, mine in by_conv.items()}
    assert got == want and len(out.columns) == 9
    said = defaultdict(list)
    for r in sorted(conversations.repair(turns(spark, rows), chunk).collect(), key=lambda r: (repr(r["conv"]), r["position"])):
        said[r["conv"]].append((r["role"], r["text"]))
    assert {c: said[c] for c in by_conv} == {c: brute.audit(mine)[1] for c, mine in by_conv.items()}


def test_audits_of_nothing(spark):
    assert conversations.audits(turns(spark, [])).count() == 0
    gone = next(t for t in range(1000) if zlib.crc32(f"7:{t}".encode()) % 20 == 0)
    row = conversations.audits(turns(spark, [(7, gone, "user", "Lost.")])).first()
    assert tuple(row) == (7, 0, 0, 0, 0, 0, 0, "", brute.hashlib.sha256(b"").hexdigest())


def test_walk_is_the_cheapest_and_least(spark):
    rng = random.Random(4)
    kinds = {0: "", conversations.BLANK: "blank", conversations.DUPLICATE: "duplicate", conversations.CUT: "truncated"}
    for _ in range(300):
        codes = bytes(rng.choice([1, 2, 3, 2, 3, 0]) + rng.choice([0, 0, 0, *kinds]) for _ in range(rng.randint(1, 12)))
        edits, state = conversations.walk(codes, conversations.END)[conversations.START]
        edits += "I" * int(conversations.END[state] // conversations.INSERT)
        assert edits == brute.cheapest([("\0sua"[c & 3].strip("\0"), kinds[c & 28]) for c in codes])[1]
        # a matrix stands for its chunk, however it is cut
        cut = rng.randint(0, len(codes))
        tail = conversations.through(conversations.matrix(codes[cut:]), conversations.END)
        both = conversations.through(conversations.matrix(codes[:cut]), tail)
        assert both == conversations.through(conversations.matrix(codes), conversations.END)


def test_a_long_conversation_is_spread(spark):
    """One conversation of many rows lies in several places and chunks."""
    rows = [(1, t, ("user", "assistant")[t % 2], f"Turn {t}.") for t in range(5000)] + random_turns(5)
    damaged = conversations.damaged(turns(spark, rows))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # small tables are coalesced
    try:
        codes = conversations.row_codes(damaged)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert codes.filter("conv = 1").select(F.shiftright("place", 33)).distinct().count() > 1
    chunks = conversations.edit_chunks(codes, 256)
    assert chunks.filter("conv = 1").count() >= 18
    assert chunks.select(F.max(F.length("codes"))).first()[0] <= 256
    got = {r["conv_id"]: tuple(r)[1:] for r in conversations.audits(turns(spark, rows), 256).collect()}
    assert got == {c: brute.audit(mine)[0] for c, mine in brute.damaged_turns(rows).items()}


# --- words -------------------------------------------------------------------

def texts(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, text string").withColumns(
        {c: F.lit(f"own {c}") for c in ("word", "n", "form", "root", "id", "block", "choice", "part")}).repartition(3)


def near_texts(seed=2, n=400):
    """Words, variants of them at every edit, anagrams and shared letters."""
    rng = random.Random(seed)
    letters = "abcdeéßÿàabcd×"
    base = ["".join(rng.choice(letters) for _ in range(rng.randint(5, 9))) for _ in range(60)]
    out = []
    for i in range(n):
        line = []
        for _ in range(60):
            w = rng.choice(base[:1 + rng.randrange(len(base))])
            k = rng.randrange(len(w))
            w = rng.choice([w, w, w, w[:k] + w[k + 1:], w[:k] + rng.choice(letters) + w[k:], w[:k] + rng.choice(letters) + w[k + 1:],
                            "".join(sorted(w)), w.upper()])
            line.append(w)
        out.append((rng.choice([i, i, None]) if i % 9 == 0 else i, rng.choice([" ", "-", "1", "\n", "日", " "]).join(line)))
    return out


ODD_TEXTS = [(1, None), (2, ""), (3, "x" * 100_000 + " " + "x" * 100_000 + " " + "x" * 99_999 + " " + ("x" * 99_999 + "y ") * 6),
             (4, "ÃÃÃÃÃ " * 4), (4, "ÃÃÃÃÃ " * 4), (None, "Spelling spelling"),
             (6, "spelling speling SPELING speling spelling"), (7, "Æsopé æsopé ÆSOPé " * 3), (8, "the cat sat"),
             (9, "grün grünè grünen grünen grünen grüner grüner grüner grüner grüner grüner")]


@pytest.mark.parametrize("classes, crowd", [(None, spelling.CROWD), (3, 20), (5, 16_384)])
def test_variants(spark, classes, crowd):
    rows = near_texts() + ODD_TEXTS
    out = spelling.variants(texts(spark, rows), crowd=crowd, classes=classes)
    assert out.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    got = {r["word"]: tuple(r)[1:] for r in out.collect()}
    assert got == brute.spelling(rows)
    assert any(v[0] for v in got.values()) and any(v[1] != v[0] for v in got.values() if v[0])


def test_variants_of_nothing(spark):
    assert spelling.variants(texts(spark, [])).count() == 0
    assert spelling.variants(texts(spark, [(1, "a bb ccc"), (2, None)])).count() == 0


def test_runs_and_hashes():
    column = pa.array(["Abc déF", "", "ÀÿĀx", "日本y", "z" * 300, "no-break"])
    data, at, size, row = spelling.letter_runs(*spelling.utf8(column))
    runs = [data[a:b].tobytes().decode() for a, b in zip(at[:-1], at[1:], strict=True)]
    assert runs == ["abc", "déf", "Àÿ", "x", "y", "z" * 300, "no", "break"]
    assert size.tolist() == [3, 3, 2, 1, 1, 300, 2, 5] and row.tolist() == [0, 0, 2, 2, 3, 4, 5, 5]
    prefix = np.array([zlib.crc32(f"{r}:".encode()) for r in row], np.uint32)
    assert spelling.crc32_of(prefix, data, at).tolist() == [zlib.crc32(f"{r}:{w}".encode()) for r, w in zip(row, runs, strict=True)]


def test_one_edit():
    def rows(words):
        return np.array([list(w.encode("latin-1")) for w in words], np.uint8)
    assert spelling.one_edit(rows(["abcd", "abcd", "abcd"]), rows(["abce", "abcd", "abdc"])).tolist() == [True, False, False]
    assert spelling.one_edit(rows(["abcd"] * 5), rows(["xabcd", "abxcd", "abcdx", "abdcx", "aabcd"])).tolist() == [True, True, True, False, True]


def test_slices_of_a_very_long_text(spark):
    """Beyond one slice: the same counts as from two slices' own texts."""
    words = " ".join(f"alpha{chr(97 + i % 26)}{chr(97 + i // 26 % 26)} beta" for i in range(700_000))
    assert len(words) > 8 << 20
    rows = [(1, words), (2, words[:1000]), (3, words)]
    got = {r["word"]: r["n"] for r in spelling.word_counts(texts(spark, rows)).collect()}
    assert got == {w: v[2] for w, v in brute.spelling(rows).items()}
