"""Licence scans with a generalised suffix automaton over licence words.

The automaton of all templates is built once (its size is linear in their
words) and streamed over every file: for each word it gives the matching
statistic, the longest run ending there that occurs in some template. Maximal
matches, long for their template, are chained, in order in file and template,
into covered spans; of templates that differ in a version only, the span with
the larger share stays. Two neighbours that no template holds reset the
automaton, so only runs of the templates' word pairs are walked in Python;
everything before that is one vectorised pass.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from buildlake.llm.common import doc_texts
from buildlake.llm.words import NON_ALNUM, Words, batch_words, words_of

# fixed values: the base phrases and their labels
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# fixed values: notices as their licences word them
TEMPLATES = {
    "mit-notice": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "apache-notice": "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    "gpl-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "bsd-notice": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "isc-notice": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "cc-by-notice": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
}

# fixed values: licences as one-line notices name them
NAMES = {
    "agpl-3.0": "the GNU Affero General Public License, version 3",
    "apache-2.0": "the Apache License, Version 2.0",
    "bsd-2-clause": "the BSD 2-Clause License",
    "bsd-3-clause": "the BSD 3-Clause License",
    "gpl-2.0": "the GNU General Public License, version 2",
    "gpl-3.0": "the GNU General Public License, version 3",
    "isc": "the ISC License",
    "lgpl-2.1": "the GNU Lesser General Public License, version 2.1",
    "lgpl-3.0": "the GNU Lesser General Public License, version 3",
    "mit": "the MIT License",
    "mpl-2.0": "the Mozilla Public License, version 2.0",
    "unlicense": "the Unlicense",
}
for _kind in ("by", "by-sa", "by-nc", "by-nd", "by-nc-sa", "by-nc-nd"):
    NAMES |= {f"cc-{_kind}-{_version}": f"CC {_kind} {_version}" for _version in ("3.0", "4.0")}
TEMPLATES |= {label: f"under {name}" for label, name in NAMES.items()}

LONG_MATCH = 6
"""Words of a match that counts as long, or half a template's where that is less, two at least."""
MAX_GAP = 24
"""Words, in file or template, between two matches of a chain, or half a template's where that is less."""
SHORT, COVERED, SHORT_COVERED = 20, 0.6, 0.8
"""Share that a chain must cover for its label: of a template of fewer than ``SHORT`` words, and of a longer one."""


def plain_words(text: str) -> list[str]:
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))


def word_hashes(words: list[str]) -> np.ndarray:
    raw = " ".join(words).encode()
    return words_of(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]), NON_ALNUM).hashes


@dataclass
class Automaton:
    """States of a generalised suffix automaton; ``ends[s]``: template to all ends of the state's strings in it."""

    next: list[dict[int, int]]
    link: list[int]
    length: list[int]
    ends: list[dict[int, list[int]]]


def build_automaton(sequences: list[list[int]]) -> Automaton:
    a = Automaton([{}], [-1], [0], [{}])

    def state(length: int, after: dict[int, int], link: int) -> int:
        a.next.append(after)
        a.link.append(link)
        a.length.append(length)
        a.ends.append({})
        return len(a.link) - 1

    def split(p: int, c: int, q: int) -> int:
        """A copy of q for the strings that end at p + c."""
        copy = state(a.length[p] + 1, dict(a.next[q]), a.link[q])
        a.link[q] = copy
        while p >= 0 and a.next[p].get(c) == q:
            a.next[p][c] = copy
            p = a.link[p]
        return copy

    def extend(last: int, c: int) -> int:
        q = a.next[last].get(c)
        if q is not None:
            return q if a.length[q] == a.length[last] + 1 else split(last, c, q)
        new, p = state(a.length[last] + 1, {}, 0), last
        while p >= 0 and c not in a.next[p]:
            a.next[p][c] = new
            p = a.link[p]
        if p >= 0:
            q = a.next[p][c]
            a.link[new] = q if a.length[q] == a.length[p] + 1 else split(p, c, q)
        return new

    for sequence in sequences:
        last = 0
        for c in sequence:
            last = extend(last, c)
    for t, sequence in enumerate(sequences):
        at = 0
        for end, c in enumerate(sequence, 1):
            at = up = a.next[at][c]
            while up > 0:
                a.ends[up].setdefault(t, []).append(end)
                up = a.link[up]
    return a


def matching_statistics(a: Automaton, ids: list[int]) -> list[tuple[int, int]]:
    """For each word: (length, state) of the longest run ending there that a template holds."""
    out, at, n = [], 0, 0
    for c in ids:
        while at and c not in a.next[at]:
            at = a.link[at]
            n = a.length[at]
        if c in a.next[at]:
            at, n = a.next[at][c], n + 1
        out.append((n, at))
    return out


def long_matches(a: Automaton, ids: np.ndarray, pairs: np.ndarray) -> dict[int, list[tuple[int, int, int]]]:
    """By template: (end in file, length, state) of its matches of two words or more that can't be extended to the right.

    ``pairs[x, y]``: whether some template holds word y behind x; ids under 0 are unknown.
    """
    known = np.flatnonzero((ids[:-1] >= 0) & (ids[1:] >= 0))
    held = np.zeros(len(ids) + 1, bool)
    held[known + 1] = pairs[ids[known], ids[known + 1]]  # whether a word goes on from the one before
    edges = np.flatnonzero(held[1:] != held[:-1])
    out: dict[int, list[tuple[int, int, int]]] = {}
    for b, e in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
        open_ones: dict[int, tuple[int, int]] = {}
        for i, (n, at) in enumerate([*matching_statistics(a, ids[b : e + 1].tolist()), (0, 0)]):
            here: dict[int, tuple[int, int]] = {}  # the longest suffix that each template holds
            while at > 0:
                for t in a.ends[at]:
                    here.setdefault(t, (min(n, a.length[at]), at))
                at = a.link[at]
            for t, (m, state) in open_ones.items():
                if m > 1 and here.get(t, (0, 0))[0] != m + 1:
                    out.setdefault(t, []).append((b + i, m, state))
            open_ones = here
    return out


def chains(matches: list[tuple[int, int, int]], a: Automaton, template: int, least: int = 2, max_gap: int = MAX_GAP) -> list[tuple[int, int, int]]:
    """(start, end, covered words) of the best chains over one template, in order and apart from each other.

    A match counts from ``least`` words on, at each of its places in the template.
    """
    items = sorted((end, end - n, t - n, t) for end, n, at in matches if n >= least for t in a.ends[at][template])
    best: list[tuple[int, int]] = []  # covered words and start of the best chain ending in the item
    out: list[tuple[int, int, int]] = []
    for i, (e, b, tb, te) in enumerate(items):
        covered, start = e - b, b
        for j in range(i - 1, -1, -1):
            pe, pb, ptb, pte = items[j]
            if b - pe > max_gap:
                break  # items are in the order of their ends
            if pb < b and ptb < tb and pte <= te and tb - pte <= max_gap:
                fresh = min(e - max(b, pe), te - max(tb, pte))
                if fresh > 0 and best[j][0] + fresh > covered:
                    covered, start = best[j][0] + fresh, best[j][1]
        best.append((covered, start))
    for (e, *_), (covered, start) in sorted(zip(items, best, strict=True), key=lambda x: (-x[1][0], x[0][0] - x[1][1], x[0][0])):
        if all(e <= s or start >= t for s, t, _ in out):
            out.append((start, e, covered))
    return sorted(out)


SCANNED = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, spans array<struct<label: string, start: long, end: long, coverage: double>>"


@dataclass
class Scanner:
    """Templates and phrases, compiled; small, so it travels in the task's closure."""

    vocabulary: np.ndarray
    pairs: np.ndarray
    automaton: Automaton
    templates: list[tuple[str, int]]
    phrases: list[tuple[list[int], str]]
    covered: float | None

    @classmethod
    def compile(cls, templates: dict[str, str], phrases: dict[str, str], covered: float | None = None) -> Scanner:
        texts = {k: plain_words(t) for k, t in templates.items()}
        base = {p: plain_words(p) for p in phrases}
        vocabulary = np.unique(np.concatenate([np.zeros(0, np.uint64), *[word_hashes(w) for w in [*texts.values(), *base.values()] if w]]))
        ids = lambda w: np.searchsorted(vocabulary, word_hashes(w)).tolist()
        sequences = [ids(w) for w in texts.values()]
        pairs = np.zeros((len(vocabulary), len(vocabulary)), bool)
        for s in sequences:
            pairs[s[:-1], s[1:]] = True
        return cls(vocabulary, pairs, build_automaton(sequences), [(k, len(w)) for k, w in texts.items()], [(ids(w), phrases[p]) for p, w in base.items()], covered)

    def needed(self, size: int) -> float:
        return self.covered if self.covered is not None else COVERED if size >= SHORT else SHORT_COVERED

    def ids(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.vocabulary):
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == hashes, at, -1)

    def scan(self, w: Words) -> Iterator[tuple]:
        ids = self.ids(w.hashes)
        for i in range(len(w.ptr) - 1):
            doc = ids[w.ptr[i] : w.ptr[i + 1]]
            yield len(doc), *self.scan_one(doc)

    def scan_one(self, doc: np.ndarray) -> tuple:
        n, first, last, base, found, score, spans = 0, None, None, set(), set(), 0.0, []
        if (doc >= 0).any():
            for phrase, label in self.phrases:
                m = len(doc) - len(phrase) + 1
                if m <= 0:
                    continue
                here = doc[:m] == phrase[0]
                for j, p in enumerate(phrase[1:], 1):
                    here = here & (doc[j : m + j] == p)
                places = np.flatnonzero(here)
                if len(places):
                    n += len(places)
                    base.add(label)
                    first = int(places[0]) if first is None else min(first, int(places[0]))
                    last = int(places[-1]) if last is None else max(last, int(places[-1]))
            matches = long_matches(self.automaton, doc, self.pairs)
            for t in sorted(matches):
                label, size = self.templates[t]
                for start, end, covered in chains(matches[t], self.automaton, t, max(2, min(LONG_MATCH, size // 2)), max(2, min(MAX_GAP, size // 2))):
                    share = covered / max(size, end - start)
                    score = max(score, share)
                    if share >= self.needed(size):
                        spans.append((label, start, end, share))
            # versions of one notice: what a closer one covers as well is that one's
            spans = [s for s in spans if not any(o[1] <= s[1] and s[2] <= o[2] and o[3] > s[3] for o in spans)]
            found = {s[0] for s in spans}
        return n, first, last, ",".join(sorted(base)), ",".join(sorted(base | found)), score, [dict(zip(("label", "start", "end", "coverage"), s, strict=True)) for s in sorted(spans, key=lambda s: (s[1], s[2], s[0]))]


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: dict[str, str] | None = None, phrases: dict[str, str] | None = None, covered: float | None = None) -> DataFrame:
    """Base phrases, template spans and labels of every whole text.

    A template's label is given where a chain covers enough of its words:
    ``covered``, or by default 0.6 of a long and 0.8 of a short template's.
    spans: all such places. score: the largest share that a chain covers of its
    template (of its own words, if those are more), 0 without any. Null and
    empty texts have no words, null places, empty labels and score 0; repeated
    rows get equal results; other columns are ignored; an empty table gives an
    empty result.
    """
    scanner = Scanner.compile(TEMPLATES if templates is None else templates, PHRASES if phrases is None else phrases, covered)
    span = pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("coverage", pa.float64())]))
    kinds = [("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()), ("spans", span)]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, w in batch_words(batch.column(1), NON_ALNUM):
                rows = list(scanner.scan(w))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(rows)), *[pa.array([r[k] for r in rows], t) for k, (_, t) in enumerate(kinds)]], names=["doc_id", *[n for n, _ in kinds]])

    return doc_texts(docs, id_col, text_col).mapInArrow(work, SCANNED)
