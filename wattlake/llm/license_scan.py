"""Licence texts in documents: a generalised suffix automaton of templates, matching statistics, chains.

Method. One suffix automaton holds every run of words of all templates and of the phrases that are looked for
word by word. Each document streams through it: at each word the automaton's state stands for the longest
run of words, ending there, that is in some template (the matching statistics). A phrase stands where its own state is
the state reached or one of its suffixes. Matches of LEAST words or more that don't grow with the next word are
anchors between the text and every place of that run in a template. For each template, anchors in the same order on
both sides and at most GAP words apart are chained so that they cover most of its words. A chain that covers SHARE
of a template is a span with its label; of spans that overlap by more than half, the one that covers more words stays.

Only stretches in which each two neighbouring words are neighbours in a template can have statistics above one;
they are found in whole Arrow batches by word hashes (64 bits, A-Z lower-cased), and only they go through the automaton
word by word. A chain looks back no further than a template and GAP words, so work is linear in the text.

Templates and phrases go to the tasks; they are given by the caller and don't grow with the documents. Nothing is
shuffled. Null texts are empty, and have no words, places or spans. Texts are read whole; repeated
rows and ids, null ids included, are rows of their own. Of the input only doc_id and text are read.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import read
from ._text import pieces, words

#: Words of the shortest anchor, words between anchors of a chain, share of a template that makes a span.
LEAST = 3
GAP = 12
SHARE = 0.6
#: Bytes that are in no word: ASCII without digits and letters.
BREAK = np.zeros(256, bool)
BREAK[[*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = True

#: Phrases that are reported wherever they stand, with their labels.
PHRASES = [("cc-by", "cc by"), ("gpl", "general public license"), ("reserved", "all rights reserved")]

#: The wording of common licence notices, with their labels.
TEMPLATES = [
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.'),
    ("mit", "Released under the MIT License"),
    ("mit", "Licensed under the MIT License"),
    ("mit", 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.'),
    ("mit", 'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.'),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl-2.0", "This work is licensed under the GNU General Public License, version 2"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by", "Licensed under CC BY 4.0"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    ("cc0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
]


class Automaton:
    """A suffix automaton of several sequences of word numbers."""

    def __init__(self, sequences: list[list[int]]):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.size = [-1], [0]
        #: For each state the (sequence, end) places of its runs.
        places: list[list[tuple[int, int]]] = [[]]
        self._places = places
        for number, sequence in enumerate(sequences):
            last = 0
            for end, word in enumerate(sequence):
                last = self._extend(last, word)
                places[last].append((number, end))
        for state in sorted(range(1, len(self.size)), key=lambda v: -self.size[v]):
            places[self.link[state]].extend(places[state])
        self.places = [sorted(set(x)) for x in places]

    def _state(self, size: int, link: int, moves: dict[int, int]) -> int:
        self.next.append(moves)
        self.link.append(link)
        self.size.append(size)
        self._places.append([])
        return len(self.size) - 1

    def _split(self, p: int, q: int, word: int) -> int:
        """The state of q's runs that are one word longer than p's."""
        half = self._state(self.size[p] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = half
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = half
            p = self.link[p]
        return half

    def _extend(self, last: int, word: int) -> int:
        q = self.next[last].get(word)
        if q is not None:
            # an earlier sequence has this run already
            return q if self.size[q] == self.size[last] + 1 else self._split(last, q, word)
        new = self._state(self.size[last] + 1, 0, {})
        p = last
        while p >= 0 and word not in self.next[p]:
            self.next[p][word] = new
            p = self.link[p]
        if p >= 0:
            q = self.next[p][word]
            self.link[new] = q if self.size[q] == self.size[p] + 1 else self._split(p, q, word)
        return new

    def stream(self, sequence: Iterable[int]) -> Iterator[tuple[int, int]]:
        """For each word the state and the number of words of the longest known run that ends there."""
        state = n = 0
        moves, link, size = self.next, self.link, self.size
        for word in sequence:
            while state and word not in moves[state]:
                state = link[state]
                n = size[state]
            if word in moves[state]:
                state = moves[state][word]
                n += 1
            yield state, n

    def state(self, sequence: list[int]) -> int:
        at = 0
        for word in sequence:
            at = self.next[at][word]
        return at


def _hashes(texts: list[str]) -> list[np.ndarray]:
    h, at = words(pa.array(texts, pa.string()), BREAK)
    return [h[lo:hi] for lo, hi in zip(at[:-1], at[1:])]


class Scanner:
    """Finds places of phrases and spans of templates in batches of texts."""

    def __init__(self, templates: list[tuple[str, str]], phrases: list[tuple[str, str]]):
        texts = _hashes([t for _, t in templates] + [t for _, t in phrases])
        if any(not len(t) for t in texts):
            raise ValueError("a template or phrase has no words")
        self.known = np.unique(np.concatenate([np.zeros(0, np.uint64), *texts]))
        numbers = [np.searchsorted(self.known, t).tolist() for t in texts]
        self.labels = [x for x, _ in templates]
        self.length = [len(x) for x in numbers[: len(templates)]]
        self.automaton = Automaton(numbers)
        self.maybe = np.zeros(1 << 16, bool)
        self.maybe[(self.known & np.uint64(0xFFFF)).astype(np.int64)] = True
        n = len(self.known)
        self.pairs = np.unique(np.array([a * n + b for x in numbers for a, b in zip(x, x[1:])], np.int64))
        own: dict[int, list[tuple[int, str]]] = {}
        for (label, _), x in zip(phrases, numbers[len(templates) :]):
            own.setdefault(self.automaton.state(x), []).append((len(x), label))
        self.single = np.array([x[0] for x in numbers[len(templates) :] if len(x) == 1], np.int64)
        #: For each state the phrases that its runs end with.
        self.ends: list[list[tuple[int, str]]] = []
        for v in range(len(self.automaton.size)):
            found = []
            while v > 0:
                found += own.get(v, [])
                v = self.automaton.link[v]
            self.ends.append(found)

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """Numbers of known words, -1 for others."""
        out = np.full(len(hashes), -1, np.int64)
        if len(self.known):
            at = np.flatnonzero(self.maybe[(hashes & np.uint64(0xFFFF)).astype(np.int64)])
            k = np.minimum(np.searchsorted(self.known, hashes[at]), len(self.known) - 1)
            same = self.known[k] == hashes[at]
            out[at[same]] = k[same]
        return out

    def stretches(self, hashes: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, list[int]]]:
        """First word and word numbers of all runs whose neighbours are neighbours in a template or phrase."""
        word = self.numbers(hashes)
        if len(word) < 1:
            return
        code = word[:-1] * len(self.known) + word[1:]
        fit = np.flatnonzero((word[:-1] >= 0) & (word[1:] >= 0))
        if len(self.pairs):
            k = np.minimum(np.searchsorted(self.pairs, code[fit]), len(self.pairs) - 1)
            fit = fit[self.pairs[k] == code[fit]]
        else:
            fit = fit[:0]
        joined = np.zeros(len(word) + 1, bool)
        joined[fit + 1] = True  # with the word before
        joined[offsets] = False
        inside = joined[:-1] | joined[1:]
        if len(self.single):
            inside |= np.isin(word, self.single)
        starts = np.flatnonzero(inside & ~joined[:-1])
        ends = np.flatnonzero(inside & ~joined[1:]) + 1
        for lo, hi in zip(starts.tolist(), ends.tolist()):
            yield lo, word[lo:hi].tolist()

    def scan(self, column):
        """For each row: words, places [(start, label)], spans, best share."""
        hashes, offsets = words(column, BREAK)
        places: dict[int, list] = {}
        anchors: dict[int, dict[int, list]] = {}
        for first, sequence in self.stretches(hashes, offsets):
            row = int(np.searchsorted(offsets, first, "right")) - 1
            base = first - int(offsets[row])
            known = list(self.automaton.stream(sequence))
            for i, (state, n) in enumerate(known):
                for m, label in self.ends[state]:
                    if m <= n:
                        places.setdefault(row, []).append((base + i - m + 1, label))
                if n >= LEAST and (i + 1 == len(known) or known[i + 1][1] != n + 1):
                    for t, end in self.automaton.places[state]:
                        if t < len(self.labels):
                            anchors.setdefault(row, {}).setdefault(t, []).append((base + i, end, n))
        for row in range(len(offsets) - 1):
            spans = []
            for t, found in anchors.get(row, {}).items():
                spans += [(covered, covered / self.length[t], self.labels[t], t, lo, hi) for lo, hi, covered in chains(found)]
            share = max([x[1] for x in spans] + [1.0 for _ in places.get(row, [])[:1]], default=0.0)
            yield int(offsets[row + 1] - offsets[row]), places.get(row, []), apart([x for x in spans if x[1] >= SHARE]), share


def chains(anchors: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """First word, last word + 1 and covered template words of chains of one template's anchors.

    anchors: last word in the text, last word in the template, number of words; in the order of the first. Every anchor is in
    one chain; the chain that covers most is taken first."""
    ends = [x for x, _, _ in anchors]
    best, back, gain = [], [], []
    for i, (x, t, n) in enumerate(anchors):
        top, by, more = n, -1, n
        for j in range(bisect_left(ends, x - n - GAP), i):
            x0, t0, _ = anchors[j]
            new = min(n, t - t0, x - x0)
            if new > 0 and t - n - t0 <= GAP and best[j] + new > top:
                top, by, more = best[j] + new, j, new
        best.append(top)
        back.append(by)
        gain.append(more)
    out = []
    used = [False] * len(anchors)
    for i in sorted(range(len(anchors)), key=lambda i: (-best[i], i)):
        if used[i]:
            continue
        covered, at = 0, i
        low = anchors[i][0] - anchors[i][2] + 1
        while at >= 0 and not used[at]:
            used[at] = True
            covered += gain[at]
            low = min(low, anchors[at][0] - anchors[at][2] + 1)
            at = back[at]
        out.append((low, anchors[i][0] + 1, covered))
    return out


def apart(spans: list[tuple]) -> list[tuple]:
    """Spans, best covered first, without those that overlap a better one by more than half of the shorter; sorted by place."""
    starts: list[int] = []
    kept: list[tuple] = []
    widest = 0
    for s in sorted(spans, key=lambda s: (-s[0], -s[1], s[2], s[3], s[4])):
        lo, hi = s[4], s[5]
        near = kept[bisect_left(starts, lo - widest) : bisect_right(starts, hi)]
        if all(2 * (min(hi, x[5]) - max(lo, x[4])) <= min(hi - lo, x[5] - x[4]) for x in near):
            at = bisect_left(starts, lo)
            starts.insert(at, lo)
            kept.insert(at, s)
            widest = max(widest, hi - lo)
    return kept


SPAN = "struct<label: string, template: int, first_word: bigint, end_word: bigint, covered: bigint, share: double>"


def scanned(docs: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, phrases: list[tuple[str, str]] = PHRASES) -> DataFrame:
    """doc_id, n_words, places (start, label) of phrases, spans of templates, score: the largest share of a template
    or phrase that the text has in order, 0 to 1.

    templates and phrases: (label, text); a template's number is its place in the list."""
    shared = docs.sparkSession.sparkContext.broadcast((templates, phrases))

    def scan(batches):
        scanner = Scanner(*shared.value)
        for batch in batches:
            for part in pieces(batch, "text", 4 << 20):
                found = list(scanner.scan(part.column("text")))
                places = pa.array([[{"start": x, "label": y} for x, y in sorted(p)] for _, p, _, _ in found], pa.list_(pa.struct([("start", pa.int64()), ("label", pa.string())])))
                kind = pa.struct([("label", pa.string()), ("template", pa.int32()), ("first_word", pa.int64()), ("end_word", pa.int64()), ("covered", pa.int64()), ("share", pa.float64())])
                spans = pa.array([[{"label": s[2], "template": s[3], "first_word": s[4], "end_word": s[5], "covered": s[0], "share": s[1]} for s in x] for _, _, x, _ in found], pa.list_(kind))
                n, score = pa.array([x[0] for x in found], pa.int64()), pa.array([min(1.0, x[3]) for x in found], pa.float64())
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), n, places, spans, score], ["doc_id", "n_words", "places", "spans", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(scan, f"doc_id long, n_words long, places array<struct<start: bigint, label: string>>, spans array<{SPAN}>, score double")


def license_spans(docs: DataFrame, templates: list[tuple[str, str]] = TEMPLATES) -> DataFrame:
    """One row for each span: doc_id, label, template, first_word, end_word (after its last), covered, share."""
    return scanned(docs, templates, []).select("doc_id", F.inline("spans"))


def op11_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scanned(read(spark, sf_dir, "documents"))
    base, own = F.col("places.label"), F.col("spans.label")
    joined = lambda x: F.concat_ws(",", F.array_sort(F.array_distinct(x)))
    return found.select(
        "doc_id", "n_words", F.size("places").cast("long").alias("n_base"), F.array_min("places.start").alias("first_word"), F.array_max("places.start").alias("last_word"),
        joined(base).alias("base_labels"), joined(F.concat(base, own)).alias("labels"), "score",
    )


QUERIES = {"op11_license_scan": op11_license_scan}
#: The base columns could be SQL, the method's labels and score can't.
SQL: dict[str, str] = {}
