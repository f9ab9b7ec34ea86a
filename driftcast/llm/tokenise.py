"""Token ids of words by a public tokenizer, each distinct piece encoded once.

The vocabulary's pre-tokenizer drops white space and never crosses it, so a
text's ids are the ids of its white-space separated words in a row: a safe
boundary to split at. It also parts a letter or digit from the punctuation
behind it, so a word's last mark is a piece of its own, and where it lowers
letters, A-Z are lowered before (but in texts that hold a special token's
string): both leave far fewer distinct pieces.

Distinct pieces are encoded in blocks, joined by one space. Pieces of letters
alone are one pre-token each, whose last id ends a word of the vocabulary, so
lengths follow from the ids; of others, by the character offsets. Ids stay in a
worker's cache of two generations of bounded bytes: a piece found in the older
one moves to the younger, so frequent pieces are never encoded again.
"""

from __future__ import annotations

import json
import os
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from driftcast.llm.common import SPACE, utf8

VOCABULARY = "word_bpe_49k.json"
# Bytes of one generation of the cache, and what a piece weighs beside its own.
CACHE_BYTES, PIECE_BYTES = 32 << 20, 64
BLOCK_WORDS = 800
MARKS = b".,;:!?"
_SPACES = np.isin(np.arange(256), list(SPACE))
_MARK = np.isin(np.arange(256), list(MARKS))
_ALNUM = np.array([chr(i).isalnum() and i < 128 for i in range(256)])


def vocabulary_path(name: str) -> str:
    """A path as given, or a file name of the public tokenizers."""
    if os.sep in name:
        return name
    import public_tokenizers
    return public_tokenizers.path(name)


@lru_cache(maxsize=4)
def load(name: str):
    """The library's tokenizer, once per worker, without its own threads."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(vocabulary_path(name))
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


class _Generation:
    """Ids of pieces, ragged: piece ``i`` has ``size[i]`` ids from ``start[i]``
    of ``ids``."""

    def __init__(self):
        self.place: dict[str, int] = {}
        self.ids = np.zeros(0, np.uint32)
        self.size = np.zeros(0, np.int64)
        self.start = np.zeros(0, np.int64)
        self.bytes = 0

    def add(self, pieces: list[str], ids: np.ndarray, size: np.ndarray) -> None:
        first = len(self.size)
        self.place.update(zip(pieces, range(first, first + len(pieces)), strict=True))
        self.start = np.concatenate([self.start, len(self.ids) + np.cumsum(size) - size])
        self.size = np.concatenate([self.size, size])
        self.ids = np.concatenate([self.ids, ids])
        self.bytes += sum(map(len, pieces)) + PIECE_BYTES * len(pieces)

    def gather(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the pieces at ``places`` in a row, and their sizes."""
        size = self.size[places]
        ends = np.cumsum(size)
        return self.ids[np.repeat(self.start[places] - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)], size


class WordIds:
    """A vocabulary with the ids of pieces met lately."""

    def __init__(self, name: str, cache_bytes: int = CACHE_BYTES):
        self.tokenizer, self.cache_bytes = load(name), cache_bytes
        self.young, self.old = _Generation(), _Generation()
        said = json.loads(self.tokenizer.to_str())
        self.special = [t["content"] for t in said.get("added_tokens", [])]
        self.lowers = "Lowercase" in json.dumps(said.get("normalizer"))
        before = self.tokenizer.pre_tokenizer
        self.marks_apart = before is not None and not any(m in t for t in self.special for m in MARKS.decode()) and all(
            [at for _, at in before.pre_tokenize_str(f"{c}{m}")][-1] == (1, 2) for c in "az0\u00e9" for m in MARKS.decode())
        suffix = said["model"].get("end_of_word_suffix")
        self.ends = None
        if suffix:
            self.ends = np.zeros(max(self.tokenizer.get_vocab().values()) + 1, bool)
            self.ends[[i for t, i in self.tokenizer.get_vocab().items() if t.endswith(suffix)]] = True

    def _encode(self, new: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids, sizes = [], []
        for i in range(0, len(new), BLOCK_WORDS):
            block = new[i:i + BLOCK_WORDS]
            found = self.tokenizer.encode(" ".join(block), add_special_tokens=False)
            ids.append(np.array(found.ids, np.uint32))
            begin = np.cumsum([0, *(len(w) + 1 for w in block[:-1])])
            at = np.array([a for a, _ in found.offsets], np.int64)
            sizes.append(np.bincount(np.searchsorted(begin, at, side="right") - 1, minlength=len(block)))
        return np.concatenate(ids), np.concatenate(sizes).astype(np.int64)

    def _encode_letters(self, new: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Of pieces that are one pre-token each: without offsets."""
        blocks = [" ".join(new[i:i + BLOCK_WORDS]) for i in range(0, len(new), BLOCK_WORDS)]
        ids = [np.array(e.ids, np.uint32) for block in blocks
               for e in self.tokenizer.encode_batch_fast([block], add_special_tokens=False)]
        ids = np.concatenate(ids)
        last = np.flatnonzero(self.ends[ids])
        if len(last) != len(new):  # not this vocabulary's way
            return self._encode(new)
        return ids, np.diff(last, prepend=-1)

    def places(self, distinct: list[str]) -> np.ndarray:
        """Index of every piece in ``young``; unseen ones are encoded and added."""
        if self.young.bytes > self.cache_bytes:
            self.young, self.old = _Generation(), self.young
        young, old = self.young, self.old
        at = np.fromiter(map(young.place.get, distinct, repeat(-1)), np.int64, len(distinct))
        missing = np.flatnonzero(at < 0).tolist()
        if missing:
            wanted = [distinct[i] for i in missing]
            known = [w for w in wanted if w in old.place]
            if known:
                young.add(known, *old.gather(np.fromiter(map(old.place.__getitem__, known), np.int64, len(known))))
            new = [w for w in wanted if w not in young.place]
            letters = [w for w in new if w.isalpha() and max(w) <= "\u00ff"] if self.ends is not None else []
            if letters:
                young.add(letters, *self._encode_letters(letters))
            rest = [w for w in new if w not in young.place]
            if rest:
                young.add(rest, *self._encode(rest))
            at[missing] = list(map(young.place.__getitem__, wanted))
        return at

    def pieces(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """All pieces of the texts in a row, and the n + 1 offsets of the rows
        in them."""
        data, bounds = utf8(texts)
        if not len(data):
            return pa.array([], pa.string()), np.zeros(len(texts) + 1, np.int64)
        if self.lowers:
            upper = (data >= 65) & (data <= 90)
            for content in self.special:
                for row in np.flatnonzero(pc.match_substring(texts, content, ignore_case=True).to_numpy(zero_copy_only=False)).tolist():
                    upper[bounds[row]:bounds[row + 1]] = False
            data = np.where(upper, data + np.uint8(32), data)
        full = ~_SPACES[data]
        first = np.zeros(len(data) + 1, bool)  # of a row
        first[bounds] = True
        start = full.copy()
        start[1:] &= ~full[:-1] | first[1:-1]
        if self.marks_apart and len(data) > 1:
            # a mark behind a letter or digit, and before white space or the end
            lead = data == 0xC3
            solid = _ALNUM[data]
            solid[1:] |= lead[:-1] & (data[1:] != 0x97) & (data[1:] != 0xB7)
            last = np.append(~full[1:], True) | first[1:]
            start[1:] |= _MARK[data[1:]] & solid[:-1] & last[1:]
        kept = data[full]
        place = np.flatnonzero(start[full])
        rows = np.concatenate([[0], np.cumsum(start)])[bounds]
        ends = np.append(place, len(kept)).astype(np.int32)
        return pa.StringArray.from_buffers(len(place), pa.py_buffer(ends), pa.py_buffer(kept)), rows


@lru_cache(maxsize=4)
def word_ids(name: str) -> WordIds:
    """The worker's cache for a vocabulary; it lives as long as the worker."""
    return WordIds(name)


def word_places(texts: pa.Array, coder: WordIds) -> tuple[np.ndarray, np.ndarray]:
    """Cache index of every piece of the texts, and the rows' piece offsets."""
    flat, at = coder.pieces(texts)
    if not len(flat):
        return np.zeros(0, np.int64), at
    coded = flat.dictionary_encode()
    return coder.places(coded.dictionary.to_pylist())[coded.indices.to_numpy()], at


def id_streams(texts: pa.Array, coder: WordIds) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all texts in a row, and the rows' id offsets."""
    place, at = word_places(texts, coder)
    ids, size = coder.young.gather(place)
    return ids, np.concatenate([[0], np.cumsum(size)])[at]
