"""License scans by a trained paragraph classifier (operator 6).

A softmax regression over sparse word n-grams (hashed unigrams and bigrams)
tells licence families from ordinary paragraphs, the unknown class. It is
trained on the family templates below, varied and set among corpus words, and
on ordinary corpus paragraphs (at most ``ORDINARY``, chosen by hash: the
documented bound of training rows). Temperature and threshold are calibrated
on a part that training does not see, the threshold so that no ordinary
paragraph passes it. A predicted paragraph is confirmed by comparison with its
family's templates.

Every paragraph (line with a word) of every document is scored, long ones in
overlapping windows of words, and so are windows across the line ends of
consecutive lines with a word, which hold notices that are wrapped over lines.
Such a notice counts once, at the line that holds most of its template. One
narrow scan, no shuffle.

Defined cases: null or empty text has no paragraph; an empty table gives an
empty result (the classifier is then trained on templates alone); repeated
rows each give a row; null ids stay null; very long texts are slices of their
own; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftcast.llm.common import mix, strings, take_field, text_slices, words

UNKNOWN = "unknown"
TEMPLATES: dict[str, tuple[str, ...]] = {
    "MIT": (
        "Released under the MIT License.", "Licensed under the MIT license.", "This project is MIT licensed.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS",
        "This project is released under the Apache 2.0 license."),
    "GPL": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License",
        "You should have received a copy of the GNU General Public License along with this program.",
        "Released under the GPL v3.", "Licensed under the GNU GPL version 2 or later."),
    "LGPL": (
        "This library is licensed under the GNU Lesser General Public License, version 2.1.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License",
        "You should have received a copy of the GNU Lesser General Public License along with this library.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Library General Public License",
        "Released under the LGPL v3.", "Licensed under the GNU LGPL version 2.1 or later."),
    "AGPL": (
        "Licensed under the GNU Affero General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License",
        "You should have received a copy of the GNU Affero General Public License along with this program.",
        "Released under the AGPL v3.", "Licensed under the GNU AGPL version 3 or later."),
    "BSD": (
        "Released under the BSD License.", "Licensed under the 3-clause BSD license.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."),
    "MPL": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
        "Released under the Mozilla Public License 2.0."),
    "CC-BY": (
        "Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Text is available under CC-BY 3.0."),
    "CC-BY-SA": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    "CC-BY-NC": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "Licensed under CC BY-NC-SA 4.0.", "Licensed under CC BY-NC-ND 4.0."),
    "CC0": (
        "Released into the public domain under CC0 1.0.", "To the extent possible under law, the author has waived all copyright",
        "This is free and unencumbered software released into the public domain."),
    "proprietary": (
        "All rights reserved.", "Copyright 2020 Example Company. All rights reserved.",
        "No part of this publication may be reproduced without prior written permission of the publisher."),
}
FAMILIES = (UNKNOWN, *TEMPLATES)
# SPDX identifiers by family, lower case; a later "+", "-only" or "-or-later" is dropped.
SPDX: dict[str, tuple[str, ...]] = {
    "MIT": ("mit", "mit-0"), "Apache-2.0": ("apache-2.0",), "GPL": ("gpl-1.0", "gpl-2.0", "gpl-3.0"),
    "LGPL": ("lgpl-2.0", "lgpl-2.1", "lgpl-3.0"), "AGPL": ("agpl-1.0", "agpl-3.0"),
    "BSD": ("0bsd", "bsd-1-clause", "bsd-2-clause", "bsd-3-clause", "bsd-4-clause"), "MPL": ("mpl-1.0", "mpl-1.1", "mpl-2.0"),
    "CC-BY": tuple(f"cc-by-{v}" for v in ("1.0", "2.0", "2.5", "3.0", "4.0")),
    "CC-BY-SA": tuple(f"cc-by-sa-{v}" for v in ("1.0", "2.0", "2.5", "3.0", "4.0")),
    "CC-BY-NC": tuple(f"cc-by-nc{k}-{v}" for k in ("", "-sa", "-nd") for v in ("1.0", "2.0", "2.5", "3.0", "4.0")),
    "CC0": ("cc0-1.0", "unlicense")}
_SPDX_FAMILY = {i: family for family, ids in SPDX.items() for i in ids}
# How a family names itself, where its text resembles that of a more or less
# specific one: a text is of such a family only if it names it.
_NAMED = {family: re.compile(name) for family, name in {
    "GPL": r"gnu\s+general\s+public|\bgpl",
    "LGPL": r"(?:lesser|library)\s+general\s+public|\blgpl",
    "AGPL": r"affero|\bagpl",
    "CC-BY": r"\bcc[\s-]+by(?![\s-]+(?:nc|sa|nd)\b)|attribution(?!\s*-?\s*(?:non|share|no))",
    "CC-BY-SA": r"\bcc[\s-]+by-sa|attribution\s*-?\s*share",
    "CC-BY-NC": r"\bcc[\s-]+by-nc|attribution\s*-?\s*non",
}.items()}
# Ordinary sentences near the subject.
NEAR_MISSES = (
    "The driver showed a license at the counter.", "She reserved all the rooms for the week.",
    "The general public was invited to the work.", "Version 3 of the report was released in March.",
    "Permission slips are due on Friday.", "He is a member of the public library.",
    "The Apache helicopter landed near the village.", "The students of MIT built a robot.",
    "A copy of the letter was sent to any person who asked.", "They fought for equal rights under the law.",
    "The terms of the agreement were not published.", "The fishing licence costs twenty pounds.")
BITS = 14
ORDINARY, ORDINARY_DOCS = 3000, 600
VARIANTS = 24
WINDOW, STRIDE = 40, 20
ROUNDS, RATE, DECAY = 80, 6.0, 1e-4
MIN_PROBABILITY = 0.5
# Share of a template's word pairs that a confirmed paragraph holds.
MIN_CONTAINED = 0.6
_EDGE = re.compile(r"[a-z0-9]+(?:[.-][a-z0-9]+)*")
_NO_WORD = np.uint64(xxhash.xxh3_64_intdigest(b""))  # of a word of edge punctuation alone
_SPDX_TAG = re.compile(r"spdx-license-identifier:\s*([^\n]*)")
_SPDX_ID = re.compile(r"([a-z0-9.-]+?)(?:-only|-or-later)?\+?")


def _feature_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hash per word (lower case, without edge punctuation), and row offsets."""
    flat, at = words(pc.utf8_lower(texts))
    coded = flat.dictionary_encode()
    bare = pc.utf8_trim(coded.dictionary, "\"'.,;:!?()[]{}<>*#%&$|-").cast(pa.binary()).to_pylist()
    known = np.fromiter(map(xxhash.xxh3_64_intdigest, bare), np.uint64, len(bare))
    return known[coded.indices.to_numpy()], at


def _features(word: np.ndarray) -> np.ndarray:
    """(words, 2): bucket of every word and of the pair it begins. A pair's
    bucket at the end of a window is dropped by the caller."""
    pair = mix(word[:-1] * np.uint64(31) + word[1:]) if len(word) else word
    return np.stack([mix(word), np.append(pair, np.uint64(0))[:len(word)]], axis=1) >> np.uint64(64 - BITS)


class Classifier:
    """Softmax regression over hashed word n-grams with a calibrated unknown class."""

    def __init__(self):
        self.weight = np.zeros((1 << BITS, len(FAMILIES)), np.float32)
        self.bias = np.zeros(len(FAMILIES), np.float32)
        self.temperature, self.threshold = 1.0, MIN_PROBABILITY

    def logits(self, word: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Of the windows [start, end) of words."""
        out = np.zeros((len(start), len(FAMILIES)))
        for i in range(0, len(start), 4096):
            a, b = start[i:i + 4096], end[i:i + 4096]
            low, high = int(a.min()), int(b.max())
            bucket = _features(word[low:high]).astype(np.int64)
            single = np.cumsum(np.vstack([np.zeros((1, len(FAMILIES))), self.weight[bucket[:, 0]]]), axis=0, dtype=np.float64)
            pair = np.cumsum(np.vstack([np.zeros((1, len(FAMILIES))), self.weight[bucket[:, 1]]]), axis=0, dtype=np.float64)
            a, b = a - low, b - low
            total = single[b] - single[a] + pair[np.maximum(b - 1, a)] - pair[a]
            out[i:i + 4096] = total / np.sqrt(np.maximum(2 * (b - a) - 1, 1))[:, None]
        return out + self.bias

    def probabilities(self, word: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return _softmax(self.logits(word, start, end) / self.temperature)

    def fit(self, texts: list[str], label: np.ndarray) -> Classifier:
        """Gradient descent on all but every fifth row, calibration on those."""
        word, at = _feature_words(pa.array(texts, pa.string()))
        start, end = at[:-1], at[1:]
        row = np.repeat(np.arange(len(texts)), np.diff(at))
        bucket = _features(word).astype(np.int64)
        last = np.zeros(len(word), bool)
        last[end[end > start] - 1] = True
        scale = 1 / np.sqrt(np.maximum(2 * (end - start) - 1, 1))
        rows = np.concatenate([row, row[~last]])
        columns = np.concatenate([bucket[:, 0], bucket[~last, 1]])
        order = np.argsort(rows, kind="stable")
        rows, columns = rows[order], columns[order]
        value = scale[rows].astype(np.float32)[:, None]
        full, first = np.unique(rows, return_index=True)
        learn = np.arange(len(texts)) % 5 != 0
        share = learn / np.maximum(np.bincount(label[learn], minlength=len(FAMILIES)), 1)[label]  # families weigh the same
        target = np.eye(len(FAMILIES))[label]
        by_column = np.argsort(columns, kind="stable")
        used, begin = np.unique(columns[by_column], return_index=True)
        row_of, value_of = rows[by_column], value[by_column]
        for _ in range(ROUNDS):
            logits = np.zeros((len(texts), len(FAMILIES)), np.float32)
            logits[full] = np.add.reduceat(self.weight[columns] * value, first, axis=0)
            error = ((_softmax(logits + self.bias) - target) * share[:, None]).astype(np.float32)
            self.weight[used] -= RATE * np.add.reduceat(error[row_of] * value_of, begin, axis=0) + DECAY * self.weight[used]
            self.bias -= RATE * error.sum(axis=0) / len(FAMILIES)
        self._calibrate(self.logits(word, start, end)[~learn], label[~learn])
        return self

    def _calibrate(self, logits: np.ndarray, label: np.ndarray) -> None:
        """The temperature of least log loss; a threshold above all that
        unknown paragraphs reach for another family."""
        if not len(label):
            return
        grid = np.geomspace(0.1, 5, 25)
        loss = [-np.log(np.maximum(_softmax(logits / t)[np.arange(len(label)), label], 1e-12)).mean() for t in grid]
        self.temperature = float(grid[int(np.argmin(loss))])
        unknown = _softmax(logits[label == 0] / self.temperature)[:, 1:]
        if unknown.size:
            self.threshold = float(min(0.95, max(MIN_PROBABILITY, unknown.max())))


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _pairs(text: str) -> set[tuple[str, str]]:
    found = _EDGE.findall(text.lower())
    return set(zip(["^", *found], [*found, "$"], strict=True)) if len(found) < 3 else set(zip(found, found[1:], strict=False))


_TEMPLATE_PAIRS = {family: [_pairs(t) for t in templates] for family, templates in TEMPLATES.items()}


def contained(text: str, family: str) -> float:
    """The largest share of a template's word pairs that the text holds."""
    mine = _pairs(text)
    return max(len(mine & t) / len(t) for t in _TEMPLATE_PAIRS[family])


def identified(text: str) -> list[str]:
    """The families of the SPDX expression in a line."""
    tag = _SPDX_TAG.search(text.lower())
    out = []
    for word in tag[1].replace("(", " ").replace(")", " ").split() if tag else ():
        found = _SPDX_ID.fullmatch(word)
        family = _SPDX_FAMILY.get(found[1]) if found else None
        if family:
            out.append(family)
        elif word not in ("and", "or", "with") and (not found or "exception" not in word):
            break  # the expression has ended
    return list(dict.fromkeys(out))


def confirmed(text: str, family: str, probability: np.ndarray) -> tuple[str, float]:
    """The family whose template the text holds best (the predicted one on
    ties), if it holds enough of it. Of families with like texts only those
    count that the text names, so the GNU GPL's template does not take a notice
    of the LGPL or AGPL that holds most of its words."""
    lower = text.lower()
    found = {f: contained(text, f) if f not in _NAMED or _NAMED[f].search(lower) else 0.0 for f in TEMPLATES}
    best = max(TEMPLATES, key=lambda f: (found[f], f == family, probability[FAMILIES.index(f)]))
    return best, found[best]


def ordinary_paragraphs(docs: DataFrame, text_col: str = "text") -> list[str]:
    """Corpus paragraphs without a licence template, ``ORDINARY`` at most, by
    hash of the text."""
    count = docs.count()
    if not count:
        return []
    cells = 1 << 20
    some = docs.filter(F.pmod(F.xxhash64(text_col), F.lit(cells)) < max(1, cells * ORDINARY_DOCS // count))
    lines = (some.select(F.explode(F.split(F.col(text_col), "\n")).alias("line")).filter("length(trim(line)) > 0")
             .select(F.substring("line", 1, 2000).alias("line")).distinct()
             .orderBy(F.xxhash64("line"), "line").limit(2 * ORDINARY).collect())
    return [r["line"] for r in lines
            if max(contained(r["line"], f) for f in TEMPLATES) < MIN_CONTAINED][:ORDINARY]


def train(docs: DataFrame, text_col: str = "text") -> Classifier:
    """The classifier of a corpus."""
    rng = np.random.default_rng(7)
    plain = ordinary_paragraphs(docs, text_col)
    filler = [w for line in plain[:500] for w in line.split()] or ["the", "of", "and"]
    texts, labels = [], []
    for family, templates in TEMPLATES.items():
        for template in [*templates, *(f"SPDX-License-Identifier: {i}" for i in SPDX.get(family, ()))]:
            for variant in range(VARIANTS):
                mine = [w for w in template.split() if variant < 4 or rng.random() > 0.08]
                around = [filler[i] for i in rng.integers(0, len(filler), int(rng.integers(0, WINDOW - 10)) if variant % 2 else 0)]
                cut = int(rng.integers(0, len(around) + 1))
                text = " ".join([*around[:cut], *(mine or [template]), *around[cut:]])
                texts.append(text.upper() if variant == 3 else text)
                labels.append(FAMILIES.index(family))
    for line in [*plain, *NEAR_MISSES * 8]:
        texts.append(" ".join(line.split()[:WINDOW]))
        labels.append(0)
    order = rng.permutation(len(texts))
    return Classifier().fit([texts[i] for i in order], np.array(labels)[order])


def _paragraphs(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All lines with a word, the row of each, and its number there; and the
    blocks of several such lines without a blank one between them: first line
    and the line after the last."""
    lists = pc.split_pattern(texts, "\n")
    line = lists.flatten()
    at = lists.offsets.to_numpy().astype(np.int64)
    at -= at[0]
    row = np.repeat(np.arange(len(texts)), np.diff(at))
    filled = pc.match_substring_regex(line, r"[^\x20\x09-\x0D]").to_numpy(zero_copy_only=False)
    row = row[filled]
    number = np.arange(len(row)) - np.searchsorted(row, row)
    place = np.flatnonzero(filled)
    first = np.flatnonzero((np.diff(place, prepend=-2) != 1) | (np.diff(row, prepend=-1) != 0))
    last = np.append(first[1:], len(row))[:len(first)]
    several = last - first > 1
    return line.filter(pa.array(filled)), row, number, first[several], last[several]


def _windows(begin: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The stretch, first word and end of the windows of stretches of words."""
    windows = np.maximum(1, -(-(stop - begin - WINDOW) // STRIDE) + 1)
    of = np.repeat(np.arange(len(begin)), windows)
    start = begin[of] + STRIDE * (np.arange(len(of)) - np.repeat(np.cumsum(windows) - windows, windows))
    return of, start, np.minimum(start + WINDOW, stop[of])


def _place(mine: list[tuple[int, bytes]], family: str) -> int:
    """The line of a window's (line, word) that holds most word pairs of the
    family's templates (the first on ties)."""
    lines: dict[int, list[bytes]] = {}
    for n, word in mine:
        lines.setdefault(n, []).append(word)
    wanted = set().union(*_TEMPLATE_PAIRS[family])
    return max(lines, key=lambda n: (len(_pairs(b" ".join(lines[n]).decode()) & wanted), -n))


def _consecutive(found: list[tuple]) -> Iterator[list[tuple]]:
    """Windows (by rising number) in runs of neighbours."""
    run = found[:1]
    for window in found[1:]:
        if window[0] != run[-1][0] + 1:
            yield run
            run = []
        run.append(window)
    yield run


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: its paragraphs, how many name a licence, the families, and the
    most probable one with its paragraph."""
    model = docs.sparkSession.sparkContext.broadcast(train(docs, text_col))
    schema = T.StructType([
        take_field(docs, id_col), T.StructField("n_paragraphs", T.LongType()), T.StructField("n_licensed", T.LongType()),
        T.StructField("families", T.ArrayType(T.StringType())), T.StructField("family", T.StringType()),
        T.StructField("probability", T.DoubleType()), T.StructField("paragraph", T.LongType())])

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, text_col):
            texts = strings(batch.column(text_col))
            line, row, number, first, last = _paragraphs(texts)
            hits: dict[int, list[tuple[float, str, int]]] = {}
            if len(line):
                word, at = _feature_words(line)
                # windows of the lines, and of the blocks of several lines without comment marks
                plain = np.flatnonzero(word != _NO_WORD)
                of, start, end = _windows(at[:-1], at[1:])
                block, from_, to = _windows(np.searchsorted(plain, at[first]), np.searchsorted(plain, at[last]))
                p = np.concatenate([model.value.probabilities(word, start, end),
                                    model.value.probabilities(word[plain], from_, to)])
                family = p[:, 1:].argmax(axis=1) + 1
                likely = np.flatnonzero((p.argmax(axis=1) > 0) & (p[np.arange(len(p)), family] >= model.value.threshold))
                named: set[tuple[int, str]] = set()  # line, family
                runs: dict[tuple[int, str], list[tuple[int, float, int, int, int]]] = {}
                for i in likely.tolist():
                    k = i - len(of)
                    place = np.arange(start[i], end[i]) if k < 0 else plain[from_[k]:to[k]]
                    if not len(place):
                        continue
                    a, b = (int(np.searchsorted(at, x, side="right")) - 1 for x in (place[0], place[-1]))
                    split = np.array([w for n in range(a, b + 1) for w in line[n].as_py().encode().split()], object)
                    lines_of = np.searchsorted(at, place, side="right") - 1
                    mine = list(zip(lines_of.tolist(), split[place - at[a]], strict=True))
                    name, share = confirmed(b" ".join(w for _, w in mine).decode(), FAMILIES[family[i]], p[i])
                    if share < MIN_CONTAINED:
                        continue
                    if k < 0:
                        named.add((a, name))
                        hits.setdefault(int(row[a]), []).append((float(p[i, FAMILIES.index(name)]), name, int(number[a])))
                    else:
                        runs.setdefault((int(block[k]), name), []).append((i, share, a, b, _place(mine, name)))
                for (_, name), found in runs.items():
                    for run in _consecutive(found):
                        # lines that name the family by themselves are found already
                        if not any((n, name) in named for _, _, a, b, _ in run for n in range(a, b + 1)):
                            i, _, _, _, place = max(run, key=lambda r: (r[1], -r[0]))
                            hits.setdefault(int(row[place]), []).append(
                                (float(p[i, FAMILIES.index(name)]), name, int(number[place])))
                tagged = np.flatnonzero(pc.match_substring(line, "spdx-license-identifier", ignore_case=True)
                                        .to_numpy(zero_copy_only=False))
                for n in tagged.tolist():
                    mine = identified(line[n].as_py())
                    known = [h for h in hits.get(int(row[n]), ()) if h[2] != number[n] or h[1] in mine or not mine]
                    q = p[:len(of)][of == n].max(axis=0)
                    known += [(float(q[FAMILIES.index(f)]), f, int(number[n])) for f in mine
                              if not any(h[1:] == (f, number[n]) for h in known)]
                    if known:
                        hits[int(row[n])] = known
            count = np.bincount(row, minlength=len(texts))
            best = [max(hits[i], key=lambda h: (h[0], -h[2])) if i in hits else (None, None, None) for i in range(len(texts))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(id_col), pa.array(count, pa.int64()),
                 pa.array([len({h[2] for h in hits.get(i, ())}) for i in range(len(texts))], pa.int64()),
                 pa.array([sorted({h[1] for h in hits.get(i, ())}) for i in range(len(texts))], pa.list_(pa.string())),
                 pa.array([b[1] for b in best], pa.string()), pa.array([b[0] for b in best], pa.float64()),
                 pa.array([b[2] for b in best], pa.int64())], names=schema.names)

    return docs.select(id_col, text_col).mapInArrow(find, schema)
