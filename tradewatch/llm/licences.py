"""Licence scans with a generalised suffix automaton of licence templates.

The automaton holds every run of words of every template. A text is streamed through it word by word, which gives its
matching statistics: how long a run of template words ends here. Where a run can't go on it is maximal; runs of at least
``LEAST_RUN`` words, cut so that they don't overlap in the text, are anchors with their places in the templates. Anchors
of one template that lie within ``GAP`` words are chained, the heaviest chain whose places rise in both text and template;
its share of the template's words is the coverage. A template that is covered for ``COVERAGE`` or more names its licence.

Words are runs of letters, digits and non-ASCII characters, A-Z lower-cased. A text is cut into words in slices; its state
is its place in the automaton and the anchors of the open chains.

Defined cases: a null or empty text has no words and no label; copies of a notice count once as a label, and each place
of a base phrase counts; equal rows give equal results; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The phrases of the contract and the label of each.
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

# Notices by which public licences are applied, with the label of each.
TEMPLATES = (
    ("mit", "Released under the MIT License."),
    ("mit", "This project is licensed under the terms of the MIT license."),
    ("mit", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
        documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
        rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to
        permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright
        notice and this permission notice shall be included in all copies or substantial portions of the Software."""),
    ("apache", "Licensed under the Apache License, Version 2.0."),
    ("apache", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance
        with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0. Unless required
        by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS,
        WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language
        governing permissions and limitations under the License."""),
    ("gpl", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl", """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public
        License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later
        version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the
        implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more
        details."""),
    ("bsd", """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
        following conditions are met: Redistributions of source code must retain the above copyright notice, this list of
        conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice,
        this list of conditions and the following disclaimer in the documentation and/or other materials provided with the
        distribution."""),
    ("isc", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
        granted, provided that the above copyright notice and this permission notice appear in all copies."""),
    ("mpl", """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not
        distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."""),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
    ("cc-by", "Licensed under CC BY 4.0."),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0."),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("cc-by-nc-sa", "Licensed under CC BY-NC-SA 4.0."),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
)

LEAST_RUN = 3
GAP = 40
COVERAGE = 0.85

_NO_WORD = re.compile(r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]")
#: For every byte of UTF-8 what stands for it in words: a-z for A-Z, a space for what parts words, else itself.
_FOLDED = bytes(ord(" ") if _NO_WORD.match(chr(c)) else c for c in range(256)).lower()
#: Characters of a text that are cut into words at a time.
SLICE = 1 << 20


def words(text: str) -> list[bytes]:
    """Words as UTF-8, in which no byte of a non-ASCII character is an ASCII one: several times faster than a regex on characters."""
    return text.encode().translate(_FOLDED).split()


def word_slices(text: str | None, size: int = SLICE) -> Iterator[list[bytes]]:
    """The words of a text in slices that end between words."""
    start = 0
    while text and start < len(text):
        cut = _NO_WORD.search(text, min(start + size, len(text)))
        end = cut.start() if cut else len(text)
        yield words(text[start:end])
        start = end


class Automaton:
    """Generalised suffix automaton of word lists, built online (Blumer et al.); states know where their runs end."""

    def __init__(self, templates: Iterable[list[bytes]]):
        self.next: list[dict[bytes, int]] = [{}]
        self.link, self.length = [-1], [0]
        ends: list[set] = [set()]
        self.templates = [list(t) for t in templates]
        for number, template in enumerate(self.templates):
            last = 0
            for place, word in enumerate(template):
                last = self._extend(last, word, ends)
                ends[last].add((number, place + 1))
        for state in sorted(range(1, len(self.next)), key=self.length.__getitem__, reverse=True):
            if self.link[state] > 0:
                ends[self.link[state]] |= ends[state]
        self.ends = [sorted(e) for e in ends]

    def _state(self, length: int, moves: dict, link: int, ends: list) -> int:
        self.next.append(moves)
        self.link.append(link)
        self.length.append(length)
        ends.append(set())
        return len(self.next) - 1

    def _split(self, source: int, word: bytes, ends: list) -> int:
        """The state of exactly the run that leads on from ``source``, parted from a longer one if need be."""
        target, length = self.next[source][word], self.length[source] + 1
        if self.length[target] == length:
            return target
        copy = self._state(length, dict(self.next[target]), self.link[target], ends)
        self.link[target] = copy
        while source >= 0 and self.next[source].get(word) == target:
            self.next[source][word] = copy
            source = self.link[source]
        return copy

    def _extend(self, last: int, word: bytes, ends: list) -> int:
        if word in self.next[last]:  # an earlier template holds this run
            return self._split(last, word, ends)
        new = self._state(self.length[last] + 1, {}, 0, ends)
        state = last
        while state >= 0 and word not in self.next[state]:
            self.next[state][word] = new
            state = self.link[state]
        if state >= 0:
            self.link[new] = self._split(state, word, ends)
        return new

    def reaches(self, state: int, length: int, least: int) -> dict[int, tuple[int, list[int]]]:
        """For each template the longest of its runs that ends here, when the longest run of all is (state, length):
        the run's length and the places in the template where it ends."""
        found: dict[int, tuple[int, list[int]]] = {}
        while state > 0 and length >= least:
            known = set(found)
            for template, stop in self.ends[state]:
                if template not in known:
                    found.setdefault(template, (length, []))[1].append(stop)
            state = self.link[state]
            length = self.length[state]
        return found


def heaviest_chain(anchors: list[tuple[int, int, int]]) -> int:
    """Words in the heaviest chain of (start, end, end in template) in text order, rising in text and in template.

    A staircase of (end in template, weight), both rising, keeps the best chains that end so far.
    """
    ends, weights, at = [0], [0], 0
    while at < len(anchors):
        same, found = at, []
        while same < len(anchors) and anchors[same][:2] == anchors[at][:2]:  # places of one run exclude each other
            start, end, stop = anchors[same]
            found.append((stop, weights[bisect_right(ends, stop - (end - start)) - 1] + end - start))
            same += 1
        for stop, weight in found:
            place = bisect_left(ends, stop)
            level = place < len(ends) and ends[place] == stop
            if weights[place - 1] >= weight or level and weights[place] >= weight:
                continue
            until = place
            while until < len(ends) and weights[until] <= weight:
                until += 1
            ends[place:until], weights[place:until] = [stop], [weight]
        at = same
    return weights[-1]


class Scan:
    """One text streamed through the automaton: matching statistics, each template's maximal runs, and their chains."""

    def __init__(self, automaton: Automaton, least: int, gap: int):
        self.automaton, self.least, self.gap = automaton, least, gap
        self.state = self.length = self.place = 0
        self.open: dict[int, tuple[int, list[int]]] = {}
        self.chains: dict[int, list[tuple[int, int, int]]] = {}
        self.best = [0] * len(automaton.templates)

    def feed(self, text: list[bytes]) -> None:
        following, link, longest = self.automaton.next, self.automaton.link, self.automaton.length
        root, state, length, least = following[0], self.state, self.length, self.least
        for place, word in enumerate(text, self.place):
            if word not in root:
                if not length:  # no run to end
                    continue
                state = length = 0
            else:
                while word not in following[state]:
                    state = link[state]
                    length = longest[state]
                state = following[state][word]
                length += 1
            if length >= least or self.open:
                now = self.automaton.reaches(state, length, least)
                for template, (run, stops) in self.open.items():
                    if now.get(template, (0,))[0] != run + 1:
                        self._anchor(template, place - run, place, stops)
                self.open = now
        self.state, self.length, self.place = state, length, self.place + len(text)

    def _anchor(self, template: int, start: int, end: int, stops: list[int]) -> None:
        """A maximal run; what it shares in the text with the template's run before it is cut off its head."""
        chain = self.chains.setdefault(template, [])
        if chain and start - chain[-1][1] > self.gap:
            self.best[template] = max(self.best[template], heaviest_chain(chain))
            chain.clear()
        start = max(start, chain[-1][1]) if chain else start
        if start < end:
            chain.extend((start, end, stop) for stop in stops)

    def coverage(self) -> list[float]:
        """The largest share of each template's words that one chain covers; ends the scan."""
        for template, (run, stops) in self.open.items():
            self._anchor(template, self.place - run, self.place, stops)
        self.open = {}
        for template, chain in self.chains.items():
            self.best[template] = max(self.best[template], heaviest_chain(chain))
        return [b / len(t) if t else 0.0 for b, t in zip(self.best, self.automaton.templates)]


@lru_cache(maxsize=4)
def _automaton(templates: tuple[str, ...]) -> Automaton:
    return Automaton(words(t) for t in templates)


def phrase_places(text: list[bytes], phrases: tuple[tuple[list[bytes], str], ...], first: int = 0) -> list[tuple[int, str]]:
    """(place, label) of every phrase whose words stand one after the other; its last word is at ``first`` or later."""
    endings: dict[bytes, list] = {}
    for wanted, label in phrases:
        endings.setdefault(wanted[-1], []).append((wanted, label))
    found = []
    for last, ending in endings.items():
        place = first - 1
        for _ in range(text[first:].count(last)):
            place = text.index(last, place + 1)
            for wanted, label in ending:
                start = place - len(wanted) + 1
                if start >= 0 and text[start : place + 1] == wanted:
                    found.append((start, label))
    return found


def scan_text(text: str | None, automaton: Automaton, phrases: tuple, least: int, gap: int, size: int = SLICE) -> tuple:
    """Number of words, (place, label) of the phrases, and coverage per template of one text."""
    scan, places, tail = Scan(automaton, least, gap), [], []
    room = max((len(wanted) for wanted, _ in phrases), default=1) - 1
    for part in word_slices(text, size):
        joined = tail + part
        places += [(start + scan.place - len(tail), label) for start, label in phrase_places(joined, phrases, len(tail))]
        scan.feed(part)
        tail = joined[len(joined) - min(room, len(joined)) :]
    return scan.place, sorted(places), scan.coverage()


def _scanned(batches: Iterator[pa.RecordBatch], templates: tuple, phrases: tuple, least: int, gap: int, share: float) -> Iterator:
    automaton = _automaton(tuple(text for _, text in templates))
    names = [label for label, _ in templates]
    phrases = tuple((words(phrase), label) for phrase, label in phrases)
    for batch in batches:
        out = []
        for value in batch.column(1):
            n, places, covered = scan_text(value.as_py(), automaton, phrases, least, gap)
            base = {label for _, label in places}
            found = base | {name for name, c in zip(names, covered) if c >= share}
            starts = [start for start, _ in places]
            out.append((
                n, len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)),
                ",".join(sorted(found)), max(covered, default=0.0),
            ))
        kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]
        columns = [pa.array(values, kind) for values, kind in zip(zip(*out) if out else [[]] * 7, kinds)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *columns],
            ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"],
        )


def document_licences(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", templates: tuple[tuple[str, str], ...] = TEMPLATES,
    phrases: tuple[tuple[str, str], ...] = PHRASES, least: int = LEAST_RUN, gap: int = GAP, share: float = COVERAGE,
) -> DataFrame:
    """Words, base phrases, licence labels and the largest template coverage of each text."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text).cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(
        lambda batches: _scanned(batches, templates, phrases, least, gap, share),
        f"doc_id {kind}, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double",
    )
