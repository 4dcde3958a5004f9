"""Licence scans with a generalised suffix automaton of licence templates.

The automaton holds every word run of every template and is built once a task (the templates are fixed and small).
A file streams through it word by word: the state after a word gives the longest run ending there that some template
holds (its matching statistics). Runs that don't grow further and are long enough are matches; per template, matches
that follow one another in the file and in the template form a chain; the template words it covers, over the
template's length, decide the label.

Defined results: a null text is empty; a text without words has n_words 0, no labels and score 0; first_word and
last_word are null without a base phrase; repeated rows are scanned one by one; an empty table gives none; other
columns are ignored.
"""

from __future__ import annotations

import re
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

# Base phrases with their labels, and public licence texts and notices.
BASE = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))
TEMPLATES = (
    ("mit-notice", "Released under the MIT License."),
    ("mit-notice", "This project is licensed under the terms of the MIT license."),
    ("mit-text", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
    documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use,
    copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software
    is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included
    in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
    IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."""),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("apache-2.0", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with
    the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or
    agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF
    ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."""),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl-notice", """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public
    License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This
    program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of
    MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."""),
    ("bsd", """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following
    conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following
    disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
    disclaimer in the documentation and/or other materials provided with the distribution."""),
    ("isc", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,
    provided that the above copyright notice and this permission notice appear in all copies."""),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0."),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("all-rights-reserved", "All rights reserved."),
)

_SCHEMA = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"


def tokens(text: str) -> list[str]:
    """Words of a text with A-Z lowered and nothing else."""
    return WORD.findall(text.encode().lower().decode())


class Automaton:
    """A generalised suffix automaton of token sequences, with every state's ends in the templates."""

    def __init__(self, sequences: list[list[int]]):
        self.next, self.link, self.length = [{}], [-1], [0]
        ends: list[set] = [set()]
        for t, sequence in enumerate(sequences):
            last = 0
            for i, c in enumerate(sequence):
                last = self._grow(last, c, ends)
                ends[last].add((t, i + 1))
        for state in sorted(range(1, len(self.length)), key=lambda s: -self.length[s]):
            if self.link[state] > 0:
                ends[self.link[state]] |= ends[state]
        self.ends = [sorted(e) for e in ends]

    def _state(self, length: int, next_: dict, link: int, ends: list) -> int:
        self.next.append(next_)
        self.link.append(link)
        self.length.append(length)
        ends.append(set())
        return len(self.length) - 1

    def _split(self, p: int, q: int, c: int, ends: list) -> int:
        copy = self._state(self.length[p] + 1, dict(self.next[q]), self.link[q], ends)
        self.link[q] = copy
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = copy
            p = self.link[p]
        return copy

    def _grow(self, last: int, c: int, ends: list) -> int:
        if (q := self.next[last].get(c)) is not None:  # a run that an earlier template holds
            return q if self.length[q] == self.length[last] + 1 else self._split(last, q, c, ends)
        new, p = self._state(self.length[last] + 1, {}, 0, ends), last
        while p >= 0 and c not in self.next[p]:
            self.next[p][c] = new
            p = self.link[p]
        if p >= 0:
            q = self.next[p][c]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, q, c, ends)
        return new

    def matches(self, sequence: list[int], least: int):
        """(end in the sequence, length, state) of every run that doesn't grow further, of least tokens or more."""
        state = length = 0
        for i, c in enumerate(sequence):
            onward = self.next[state].get(c)
            if onward is None and length >= least:
                yield i, length, state
            while onward is None and state:
                state = self.link[state]
                length = self.length[state]
                onward = self.next[state].get(c)
            state, length = (onward, length + 1) if onward is not None else (0, 0)
        if length >= least:
            yield len(sequence), length, state


def chains(found: list[tuple[int, int, list]], sizes: list[int], gap: int) -> dict[int, float]:
    """template -> share of its words covered by its best chain of matches (end, length, ends in templates)."""
    best: dict[int, float] = {}
    open_: dict[int, list] = {}
    for end, length, ends in found:  # by start, so that what is further back than the gap is never met again
        for t, to in ends:
            open_[t] = [x for x in open_.get(t, ()) if end - length - x[0] <= gap]
            start = max(((c, f, e) for f, e, c in open_[t] if f <= end - length + 2 and e < to), default=None)
            covered = (start[0] + min(length, to - start[2])) if start else length
            open_[t].append((end, to, covered))
            best[t] = max(best.get(t, 0.0), covered / sizes[t])
    return best


def scan(docs: DataFrame, templates: tuple = TEMPLATES, base: tuple = BASE, least: int = 3, gap: int = 20, share: float = 0.75) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels and score.

    least: words of a shortest match; gap: words of a file between matches of one chain; share: covered part of a
    template that gives its label.
    """

    def run(batches):
        vocabulary: dict[str, int] = {}
        number = lambda text: [vocabulary.setdefault(w, len(vocabulary)) for w in tokens(text)]
        sequences = [number(text) for _, text in templates]
        phrases = [(number(text), label) for text, label in base]
        automaton, sizes = Automaton(sequences), [len(s) for s in sequences]
        get, names = vocabulary.get, [c.split()[0] for c in _SCHEMA.split(", ")]
        for batch in batches:
            text = batch.column(1)
            for at in range(0, batch.num_rows, 256):
                rows = [_scan(tokens(t.as_py() or ""), get, automaton, sizes, phrases) for t in text.slice(at, 256)]
                columns = [batch.column(0).slice(at, 256), *map(list, zip(*rows))]
                kinds = [pa.int64()] * 5 + [pa.string()] * 2 + [pa.float64()]
                yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    def _scan(words, get, automaton, sizes, phrases):
        ids = np.fromiter(map(get, words, repeat(-1)), np.int64, len(words))
        places, base_labels = [], set()
        for phrase, label in phrases:
            hit = np.ones(max(0, len(ids) - len(phrase) + 1), bool)
            for j, word in enumerate(phrase):
                hit &= ids[j : len(hit) + j] == word
            if hit.any():
                base_labels.add(label)
                places.append(np.flatnonzero(hit))
        known = np.concatenate([[False], ids >= 0, [False]])
        edges = np.flatnonzero(known[1:] != known[:-1])
        found = []
        for a, b in zip(edges[::2].tolist(), edges[1::2].tolist()):
            if b - a >= least:
                found += [(a + end, length, automaton.ends[state]) for end, length, state in automaton.matches(ids[a:b].tolist(), least)]
        covered = {t: x for t, x in chains(found, sizes, gap).items() if x >= share}
        labels = base_labels | {templates[t][0] for t in covered}
        at = np.concatenate(places) if places else None
        first, last = (int(at.min()), int(at.max())) if places else (None, None)
        score = min(1.0, max(covered.values(), default=0.0))
        return len(words), sum(map(len, places)), first, last, ",".join(sorted(base_labels)), ",".join(sorted(labels)), score

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, _SCHEMA)
