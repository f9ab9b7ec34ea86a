"""BPE encoding and decoding by a tokenization automaton (operator 10).

``Automaton`` compiles the merge list into a deterministic automaton over
tokens whose paths from the start state are exactly the proper tokenizations.
It starts as one state with a loop for every byte and applies one merge gadget
per rule ``(u, v) -> w``, in rule order:

* wherever a ``u`` arc reaches a state with a ``v`` arc, the target is split:
  the copy reached by ``u`` loses its ``v`` arc, and
* an arc ``w`` leads from every state that has the ``u`` arc to where the
  ``v`` arc led.

The states are versions of "after token x". A split takes one arc from the
newest version of ``u``, and ``w`` leads to the version of ``v`` of its time,
so the table holds one lost arc per rule, with the rule's time. ``allowed``
asks for an arc by going back in time: it replaces the younger of the two
tokens by the part at the seam (the second part of ``x``, whose version its
state is; the first part of ``y``, through whose arc it was added) and looks
for a lost arc older than what it has gone back to. Answers are kept as table
entries.

A word is encoded by table-driven transitions: from a state, the arcs whose
labels the next bytes spell are looked up, and the only accepted path is
followed (a dead end is remembered by position and arc). Decoding emits the
arc labels (the bytes of each token) and reads them as UTF-8.

Documents are pre-split by the vocabulary's byte-level pattern; the distinct
words of a slice are encoded together, all advancing one arc per step.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from driftcast.llm.common import row_sums, strings, take_field, text_slices, utf8
from driftcast.llm.tokenise import load, vocabulary_path

VOCABULARY = "byte_bpe_50k.json"
# The byte-level pre-split pattern (fixed value of this vocabulary family).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Code points below have settled character classes (Latin, Greek, Cyrillic).
SETTLED = "\u0530"
# Chunks cut by byte classes: ASCII but the apostrophe, and Latin letters.
PLAIN = "^[\t-\r -&(-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]*$"


def byte_alphabet() -> dict[str, int]:
    """Printable stand-in of every byte in byte-level vocabularies: printable
    Latin-1 bytes stand for themselves, the others are numbered from U+0100."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Automaton:
    """The merge rules as a deterministic automaton over token ids."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]]):
        to_byte = byte_alphabet()
        self.label = {i: bytes(to_byte[c] for c in token) for token, i in vocab.items()}
        # per token its rule's time (0 for bytes) and its two parts
        self.time = {vocab[c]: 0 for c in to_byte if c in vocab}
        self.parts: dict[int, tuple[int, int]] = {}
        # arcs (second token) lost by the states after a token, with the time
        self.lost: dict[tuple[int, int], int] = {}
        self._arcs: dict[tuple[int, int], bool] = {}
        for time, (left, right) in enumerate(merges, 1):
            self._merge_gadget(time, vocab[left], vocab[right], vocab[left + right])
        self._arcs.clear()  # compiled; from here on entries are final
        # the arcs' labels as a trie: byte -> (next bytes, the arc that ends there)
        self.trie: dict[int, tuple] = {}
        for token in sorted(self.time, key=lambda t: len(self.label[t])):
            node, label = self.trie, self.label[token]
            for byte in label[:-1]:
                node = node.setdefault(byte, ({}, None))[0]
            node[label[-1]] = (node.get(label[-1], ({}, None))[0], token)

    def _merge_gadget(self, time: int, u: int, v: int, w: int) -> None:
        if u in self.time and v in self.time and self.allowed(u, v):
            self.lost[u, v] = time
            self.time[w], self.parts[w] = time, (u, v)

    def allowed(self, x: int, y: int) -> bool:
        """Whether the state after token ``x`` has an arc for ``y``."""
        pair, known = (x, y), True
        limit = 1 << 60
        while True:
            if self.lost.get((x, y), limit) < limit:
                known = False
                break
            if self.time[x] >= self.time[y]:
                if not self.time[x]:
                    break
                limit = self.time[x]
                x = self.parts[x][1]
            else:
                limit = min(limit, self.time[y] + 1)
                y = self.parts[y][0]
        if len(self._arcs) > 1_000_000:
            self._arcs.clear()
        self._arcs[pair] = known
        return known

    def encode(self, word: bytes) -> list[int]:
        """The only accepted path that spells a pre-split word: transitions
        from state to state, longest label first, back from dead ends."""
        root, arcs, allowed = self.trie, self._arcs.get, self.allowed
        n, at, here = len(word), 0, None
        path: list[tuple[int, int, list, int]] = []
        dead: set[tuple[int, int]] = set()
        spelled = None
        while at < n:
            if spelled is None:  # the arcs spelled by the next bytes, shortest first
                spelled, node, end = [], root, at
                for byte in word[at:]:
                    if byte not in node:
                        break
                    node, token = node[byte]
                    end += 1
                    if token is not None:
                        spelled.append((end, token))
            while spelled:
                end, token = spelled.pop()
                if not dead or (end, token) not in dead:
                    known = here is None or arcs((here, token))
                    if known or known is None and allowed(here, token):
                        path.append((at, here, spelled, token))
                        at, here, spelled = end, token, None
                        break
            else:
                if not path:
                    raise ValueError(f"no proper tokenization of {word!r}")
                dead.add((at, here))
                at, here, spelled, _ = path.pop()
        return [step[3] for step in path]

    def decode(self, ids) -> bytes:
        """The arc labels of a path."""
        return b"".join(map(self.label.__getitem__, ids))


@lru_cache(maxsize=2)
def automaton(name: str) -> tuple[Automaton, dict[str, int]]:
    """The compiled automaton, and the special strings with their ids."""
    with open(vocabulary_path(name), encoding="utf-8") as f:
        spec = json.load(f)
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    plain = {t: i for t, i in spec["model"]["vocab"].items() if t not in special}
    made = Automaton(plain, merges)
    made.label |= {i: s.encode() for s, i in special.items()}
    return made, special


class _Table:
    """Integer keys to values by open addressing, looked up in batches."""

    FACTOR = np.uint64(0x9E3779B97F4A7C15)

    def __init__(self, entries: dict[int, int]):
        bits = max(4, (2 * len(entries)).bit_length() + 1)
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.values = np.full(1 << bits, -1, np.int64), np.full(1 << bits, -1, np.int32)
        key = np.fromiter(entries.keys(), np.int64, len(entries))
        value = np.fromiter(entries.values(), np.int32, len(entries))
        slot = self._slot(key)
        while len(key):
            # of those that want one slot the first gets it; the others go on
            _, first = np.unique(slot, return_index=True)
            first = first[self.keys[slot[first]] < 0]
            self.keys[slot[first]], self.values[slot[first]] = key[first], value[first]
            rest = np.ones(len(key), bool)
            rest[first] = False
            key, value, slot = key[rest], value[rest], (slot[rest] + 1) & self.mask

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * self.FACTOR) >> self.shift).astype(np.int64)

    def get(self, key: np.ndarray) -> np.ndarray:
        """The values, -1 where a key is unknown."""
        out, slot, row = np.full(len(key), -1, np.int32), self._slot(key), np.arange(len(key))
        while len(row):
            there = self.keys[slot]
            hit = there == key
            out[row[hit]] = self.values[slot[hit]]
            on = ~hit & (there >= 0)
            row, key, slot = row[on], key[on], (slot[on] + 1) & self.mask
        return out


class BatchCoder:
    """The automaton as numpy tables: many words advance in step.

    Texts are cut at single spaces into chunks (each with the space before
    it), chunks into pre-split words by their bytes' classes. The pattern cuts
    a chunk as it cuts the text, unless a space stands inside a longer run of
    white space; such texts, texts with special strings, and chunks beyond
    plain Latin or with an apostrophe go through ``ids`` one by one.
    """

    def __init__(self, name: str):
        import regex
        self.automaton, self.special = automaton(name)
        self.pattern = regex.compile(PATTERN)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self.inner_space = regex.compile(r"\s \s|\s $")
        self.pre_split = load(name).pre_tokenizer.pre_tokenize_str
        self._compile()
        count = max(self.automaton.label) + 1
        labels = [self.automaton.label.get(i, b"") for i in range(count)]
        self.label = pa.array(labels, pa.binary())
        self.decimal = pa.array([str(i) for i in range(count)], pa.string())
        letters, digits, space = b"abcdefghijklmnopqrstuvwxyz", b"0123456789", b" \t\n\x0b\x0c\r"
        self.kind = np.zeros(256, np.int8)
        self.kind[list(letters + letters.upper()) + list(range(128, 256))] = 1
        self.kind[list(digits)], self.kind[list(space)] = 2, 3

    def _compile(self) -> None:
        made = self.automaton
        size = max(made.time) + 1
        self.time = np.zeros(size, np.int64)
        self.left, self.right = np.zeros(size, np.int64), np.zeros(size, np.int64)
        for token, time in made.time.items():
            self.time[token] = time
            self.left[token], self.right[token] = made.parts.get(token, (token, token))
        self.lost = _Table({x << 32 | y: time for (x, y), time in made.lost.items()})
        # the arcs' labels as a trie, nodes numbered from 1
        nodes: dict[int, int] = {}
        ends: dict[int, int] = {}
        for token in made.time:
            node = 0
            for byte in made.label[token]:
                node = nodes.setdefault(node << 8 | byte, len(nodes) + 1)
            ends[node] = token
        self.child = _Table(nodes)
        self.token = np.full(len(nodes) + 1, -1, np.int64)
        self.token[list(ends.keys())] = list(ends.values())

    def allowed(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """``Automaton.allowed`` for many pairs."""
        out, row = np.ones(len(x), bool), np.arange(len(x))
        limit = np.full(len(x), 1 << 60, np.int64)
        while len(row):
            time = self.lost.get(x << 32 | y)
            gone = (time >= 0) & (time < limit)
            out[row[gone]] = False
            after_x, after_y = self.time[x], self.time[y]
            back_x = after_x >= after_y
            on = ~gone & ((after_x > 0) | (after_y > 0))
            limit = np.where(back_x, after_x, np.minimum(limit, after_y + 1))[on]
            x, y = np.where(back_x, self.right[x], x)[on], np.where(back_x, y, self.left[y])[on]
            row = row[on]
        return out

    def encode(self, words_: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pre-split words in a row, and how many each has. Every step
        takes the longest arc of all words that have one; a word that comes
        to a dead end is encoded alone."""
        data, bounds = utf8(words_)
        at, end = bounds[:-1].copy(), bounds[1:]
        here = np.full(len(at), -1, np.int64)
        live = np.flatnonzero(at < end)
        of, taken, stuck = [], [], []
        while len(live):
            row, node = np.arange(len(live)), np.zeros(len(live), np.int64)
            spelled = []
            while len(row):  # the arcs spelled by the next bytes, shortest first
                place = at[live[row]] + len(spelled)
                inside = place < end[live[row]]
                row, place = row[inside], place[inside]
                node = self.child.get(node[inside] << 8 | data[place].astype(np.int64)).astype(np.int64)
                row, node = row[node >= 0], node[node >= 0]
                arcs = np.full(len(live), -1, np.int64)
                arcs[row] = self.token[node]
                spelled.append(arcs)
            chosen, size = np.full(len(live), -1, np.int64), np.zeros(len(live), np.int64)
            for length in range(len(spelled), 0, -1):
                open_ = np.flatnonzero((chosen < 0) & (spelled[length - 1] >= 0))
                token, before = spelled[length - 1][open_], here[live[open_]]
                good = before < 0
                good[~good] = self.allowed(before[~good], token[~good])
                chosen[open_[good]], size[open_[good]] = token[good], length
            dead = chosen < 0
            stuck.append(live[dead])
            live, chosen, size = live[~dead], chosen[~dead], size[~dead]
            of.append(live)
            taken.append(chosen)
            here[live] = chosen
            at[live] += size
            live = live[at[live] < end[live]]
        word, token = np.concatenate([*of, []]).astype(np.int64), np.concatenate([*taken, []]).astype(np.int64)
        alone = np.concatenate([*stuck, []]).astype(np.int64)
        if len(alone):
            paths = [self.automaton.encode(data[bounds[i]:bounds[i + 1]].tobytes()) for i in alone.tolist()]
            keep = ~np.isin(word, alone)
            word = np.concatenate([word[keep], np.repeat(alone, [len(p) for p in paths])])
            token = np.concatenate([token[keep], *paths]).astype(np.int64)
        order = np.argsort(word, kind="stable")
        return token[order], np.bincount(word, minlength=len(bounds) - 1)

    def split(self, text: str) -> list[str]:
        """Pre-split words of a text; beyond the scripts whose character
        classes are settled, by the library's own splitter."""
        if text.isascii() or max(text) < SETTLED:
            return self.pattern.findall(text)
        return [text[a:b] for _, (a, b) in self.pre_split(text)]

    def ids(self, text: str) -> list[int]:
        """The ids of a text, special strings as their own ids."""
        out: list[int] = []
        for part in self.cut.split(text) if self.has_special(text) else [text]:
            if part in self.special:
                out.append(self.special[part])
            elif part:
                found = pa.array(self.split(part), pa.string()).dictionary_encode()
                token, size = self.encode(found.dictionary)
                out += ragged(token, size, found.indices.to_numpy())[0].tolist()
        return out

    def has_special(self, text: str) -> bool:
        return any(s in text for s in self.special)

    def whole(self, text: str) -> bool:
        """Whether a text can't be cut into chunks."""
        return self.has_special(text) or bool(self.inner_space.search(text))

    def _chunk_ids(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct chunks in a row, and how many each has."""
        plain = pc.and_(pc.match_substring_regex(chunks, PLAIN), pc.invert(pc.match_substring_regex(chunks, r"\s\s")))
        plain = plain.to_numpy(zero_copy_only=False)
        simple = chunks.filter(pa.array(plain))
        data, bounds = utf8(simple)
        kind = self.kind[data]
        cut = np.ones(len(data) + 1, bool)
        cut[1:-1] = (kind[1:] != kind[:-1]) & (data[:-1] != 32)
        cut[bounds] = True
        starts = np.flatnonzero(cut)
        if len(data):
            pieces = pa.Array.from_buffers(pa.string(), len(starts) - 1, [
                None, pa.py_buffer(starts.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))])
            coded = pieces.dictionary_encode()
            token, size = ragged(*self.encode(coded.dictionary), coded.indices.to_numpy())
            size = row_sums(size, np.searchsorted(starts, bounds))
        else:
            token, size = np.zeros(0, np.int64), np.zeros(len(simple), np.int64)
        if plain.all():
            return token, size
        others = [self.ids(c) for c in chunks.filter(pa.array(~plain)).to_pylist()]
        sizes = np.zeros(len(chunks), np.int64)
        sizes[plain], sizes[~plain] = size, [len(o) for o in others]
        order = np.concatenate([np.flatnonzero(plain), np.flatnonzero(~plain)])
        token = np.concatenate([token, *others]).astype(np.int64)
        return ragged(token, sizes[order], np.argsort(order))

    def streams(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, and the texts' offsets in them."""
        listed = texts.to_pylist()
        alone = np.array([self.whole(t) for t in listed], bool)
        spaced = pc.split_pattern(pc.if_else(pa.array(alone), "", texts), " ")
        at = spaced.offsets.to_numpy().astype(np.int64)
        at -= at[0]
        chunk = spaced.flatten()
        first = np.zeros(len(chunk), bool)
        first[at[:-1]] = True  # a text's first chunk has no space before it
        start, rest = (chunk.filter(pa.array(m)).dictionary_encode() for m in (first, ~first))
        distinct = pa.concat_arrays([start.dictionary,
                                     pc.binary_join_element_wise("", rest.dictionary, " ").cast(pa.string())])
        code = np.zeros(len(chunk), np.int64)
        code[first] = start.indices.to_numpy()
        code[~first] = rest.indices.to_numpy() + np.int64(len(start.dictionary))
        token, size = ragged(*self._chunk_ids(distinct), code)
        ends = np.concatenate([[0], np.cumsum(size)])[at]
        if not alone.any():
            return token, ends
        parts = [np.array(self.ids(t), np.int64) if a else token[i:j]
                 for t, a, i, j in zip(listed, alone, ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
        return np.concatenate([*parts, []]).astype(np.int64), np.cumsum([0, *map(len, parts)])

    def decode(self, token: np.ndarray, ends: np.ndarray) -> list[bytes]:
        """Every path's arc labels in a row, as the UTF-8 text they spell
        (what is not UTF-8 is replaced, as the library does)."""
        out = pc.binary_join(pa.ListArray.from_arrays(ends.astype(np.int32), self.label.take(pa.array(token))), b"").to_pylist()
        for i, text in enumerate(out):
            try:
                text.decode()
            except UnicodeDecodeError:
                out[i] = text.decode("utf-8", "replace").encode()
        return out

    def listing(self, token: np.ndarray, ends: np.ndarray) -> list[str]:
        """Every path's ids as decimal numbers joined by commas."""
        return pc.binary_join(pa.ListArray.from_arrays(ends.astype(np.int32), self.decimal.take(pa.array(token))), ",").to_pylist()


def ragged(flat: np.ndarray, size: np.ndarray, pick: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The stretches ``pick`` of ``flat`` (cut into stretches of ``size``) in
    a row, and their sizes."""
    start, taken = np.cumsum(size) - size, size[pick]
    ends = np.cumsum(taken)
    total = int(ends[-1]) if len(ends) else 0
    return flat[np.repeat(start[pick] - (ends - taken), taken) + np.arange(total)], taken


@lru_cache(maxsize=2)
def batch_coder(name: str) -> BatchCoder:
    return BatchCoder(name)


def encode_decode(docs: DataFrame, vocabulary: str = VOCABULARY, id_col: str = "doc_id",
                  text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256) of every row; with
    ``with_ids`` also the ids and the decoded text.

    Defined cases: null text counts as empty (0 tokens, digests of the empty
    string); repeated rows each give a row; an empty table an empty result; a
    null id stays null; very long texts are slices of their own; other columns
    are not read. One narrow stage, no shuffle.
    """
    fields = [take_field(docs, id_col), T.StructField("n_tokens", T.LongType()),
              T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())]
    if with_ids:
        fields += [T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.StringType())]
    names = [f.name for f in fields]

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, sha = batch_coder(vocabulary), hashlib.sha256
        for batch in text_slices(batches, text_col):
            texts = strings(batch.column(text_col))
            token, ends = coder.streams(texts)
            decoded = coder.decode(token, ends)
            columns = [batch.column(id_col), pa.array(np.diff(ends), pa.int64()),
                       pa.array([sha(x.encode()).hexdigest() for x in coder.listing(token, ends)], pa.string()),
                       pa.array([sha(x).hexdigest() for x in decoded], pa.string())]
            if with_ids:
                columns += [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(token, pa.int32())),
                            pa.array(decoded, pa.binary()).cast(pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.select(id_col, text_col).mapInArrow(code, T.StructType(fields))
