"""Licence texts in documents: matching statistics over a suffix automaton, chained into template spans."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from functools import partial
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .words import plain_words

# Phrases whose every place is reported, with their labels.
BASE_PHRASES = (
    ("cc-by", "cc by"),
    ("gpl", "general public license"),
    ("reserved", "all rights reserved"),
)
# The notices by which files name their licence, and short licence texts, with the label
# of the licence.
TEMPLATES = (
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    (
        "apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        "software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR "
        "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
        "permissions and limitations under the License.",
    ),
    ("mit", "Released under the MIT License"),
    ("mit", "Licensed under the MIT License"),
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the Software), to deal in the Software without restriction, including "
        "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
        "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
        "following conditions: The above copyright notice and this permission notice shall be included in all "
        "copies or substantial portions of the Software.",
    ),
    (
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met: Redistributions of source code must retain the above copyright "
        "notice, this list of conditions and the following disclaimer. Redistributions in binary form must "
        "reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
        "documentation and/or other materials provided with the distribution.",
    ),
    (
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    ("gpl", "licensed under the GNU General Public License"),
    (
        "gpl",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, or "
        "(at your option) any later version.",
    ),
    (
        "lgpl",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation",
    ),
    (
        "mpl-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
        "was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    ),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    ("cc-by", "Licensed under CC BY 4.0"),
    ("cc0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
)

# Words of the shortest match that counts, and between two matches of one span.
LEAST_MATCH = 3
MOST_GAP = 8
# Hundredths of a template that a span must cover to give its label.
PERCENT = 75

_SPAN = "array<struct<label: string, template: int, start: bigint, end: bigint, covered: int, share: double>>"
_PLACE = "array<struct<label: string, start: bigint, end: bigint>>"
_SCHEMA = f"doc_id long, n_words long, places {_PLACE}, spans {_SPAN}"


class Automaton:
    """A generalised suffix automaton: every run of words of any template is a path from state 0.

    ``ends[s]`` are the (template, last word, longest match) at which the strings of state ``s`` of
    ``least`` words or more end, those of its suffixes included.
    """

    def __init__(self, templates: Sequence[Sequence[int]], least: int):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        own: dict[int, list[tuple[int, int]]] = {}
        for t, words in enumerate(templates):
            last = 0
            for i, word in enumerate(words):
                last = self._extend(last, word)
                own.setdefault(last, []).append((t, i))
        children: dict[int, list[int]] = {}
        for state, link in enumerate(self.link[1:], 1):
            children.setdefault(link, []).append(state)
        # The ends of a state are its own and those of all states that continue it to the left.
        every: list[set[tuple[int, int]]] = [set(own.get(s, ())) for s in range(len(self.next))]
        for state in sorted(range(1, len(self.next)), key=self.length.__getitem__, reverse=True):
            if self.length[state] >= least:
                every[self.link[state]] |= every[state]
        self.ends: list[tuple[tuple[int, int, int], ...]] = [()] * len(self.next)
        for state in sorted(range(1, len(self.next)), key=self.length.__getitem__):
            if self.length[state] >= least:
                above = self.ends[self.link[state]]
                more = [(t, i, self.length[state]) for t, i in every[state]]
                shorter = [(t, i, n) for t, i, n in above if (t, i) not in every[state]]
                self.ends[state] = tuple(sorted(more + shorter))

    def _state(self, length: int, following: dict[int, int], link: int) -> int:
        self.next.append(following)
        self.length.append(length)
        self.link.append(link)
        return len(self.next) - 1

    def _split(self, state: int, target: int, word: int) -> int:
        """The state for the part of ``target`` that ``state`` and ``word`` spell, parted from the rest."""
        if self.length[target] == self.length[state] + 1:
            return target
        part = self._state(self.length[state] + 1, dict(self.next[target]), self.link[target])
        self.link[target] = part
        while state >= 0 and self.next[state].get(word) == target:
            self.next[state][word] = part
            state = self.link[state]
        return part

    def _extend(self, last: int, word: int) -> int:
        if word in self.next[last]:
            return self._split(last, self.next[last][word], word)
        added = self._state(self.length[last] + 1, {}, 0)
        while last >= 0 and word not in self.next[last]:
            self.next[last][word] = added
            last = self.link[last]
        if last >= 0:
            self.link[added] = self._split(last, self.next[last][word], word)
        return added

    def step(self, state: int, length: int, word: int) -> tuple[int, int]:
        """The longest suffix of what was matched that goes on with ``word``."""
        while word not in self.next[state]:
            state = self.link[state]
            if state < 0:
                return 0, 0
            length = self.length[state]
        return self.next[state][word], length + 1


class Library:
    """Phrases and templates as one automaton."""

    def __init__(self, phrases, templates, least_match: int, most_gap: int, percent: int):
        self.phrases = [(label, self._words(text)) for label, text in phrases]
        self.templates = [(label, self._words(text)) for label, text in templates]
        self.most_gap, self.percent = most_gap, percent
        every = [words for _, words in [*self.phrases, *self.templates]]
        if not all(every):
            raise ValueError("a phrase or template has no words")
        self.vocabulary = {w: i for i, w in enumerate(sorted({w for words in every for w in words}), 1)}
        self.least_match = least_match
        # A phrase may be shorter than a match that counts.
        self.shortest = min([least_match, *[len(words) for _, words in self.phrases]])
        self.automaton = Automaton([[self.vocabulary[w] for w in words] for words in every], self.shortest)
        self.sizes = [len(words) for words in every]
        self.n_phrases = len(self.phrases)

    @staticmethod
    def _words(text: str) -> list[bytes]:
        return [w for block in plain_words(text.encode()) for w in block]

    def scan(self, text: bytes) -> tuple[int, list[tuple[str, int, int]], list[tuple[int, int, int, int]]]:
        """The number of words, the places of phrases, and the longest matches as (template, its first word,
        the text's first word, words), by their end."""
        places: list[tuple[str, int, int]] = []
        matches: list[tuple[int, int, int, int]] = []
        automaton, state, length = self.automaton, 0, 0
        going: dict[tuple[int, int], int] = {}
        base, at = 0, -2

        def close(position: int, following: Mapping[tuple[int, int], int]) -> None:
            for (t, i), n in going.items():
                if (t, i + 1) not in following and n >= self.least_match:
                    matches.append((t, i - n + 1, position - n + 1, n))

        for words in plain_words(text):
            ids = np.fromiter(map(self.vocabulary.get, words, repeat(0)), np.int32, len(words))
            known = np.flatnonzero(ids)
            # A word alone between unknown ones matches nothing, unless it stands where blocks meet.
            if len(known) and self.shortest > 1:
                beside = np.diff(known, prepend=-1) == 1
                beside |= np.append(beside[1:], False) | (known == len(words) - 1)
                known = known[beside]
            for i, word in zip(known.tolist(), ids[known].tolist()):
                if base + i != at + 1:
                    close(at, {})
                    state, length, going = 0, 0, {}
                state, length = automaton.step(state, length, word)
                following = {}
                for t, end, longest in automaton.ends[state]:
                    n = min(longest, length)
                    if t >= self.n_phrases:
                        following[t, end] = n
                    elif end + 1 == self.sizes[t] and n >= self.sizes[t]:
                        places.append((self.phrases[t][0], base + i - end, base + i + 1))
                if going:
                    close(base + i - 1, following)
                going, at = following, base + i
            base += len(words)
        close(at, {})
        return base, places, matches

    def spans(self, matches: list[tuple[int, int, int, int]]) -> list[dict]:
        """Chains of matches of one template, in order in both text and template with at most ``most_gap`` words
        between, as covered spans. Every match is in one span at most; the best covered span comes first."""
        by_template: dict[int, list[tuple[int, int, int]]] = {}
        for t, there, here, n in matches:
            by_template.setdefault(t, []).append((here, there, n))
        found = []
        for t, hits in by_template.items():
            hits.sort()
            covered, before = [n for _, _, n in hits], [-1] * len(hits)
            near = 0
            # Where every hit before it ends: hits further back than the longest reach are left behind.
            reach = max(n for _, _, n in hits) + self.most_gap
            for i, (here, there, n) in enumerate(hits):
                while hits[near][0] + reach < here:
                    near += 1
                for j in range(near, i):
                    h, s, m = hits[j]
                    # What overlaps in either counts once.
                    shared = max(0, h + m - here, s + m - there)
                    apart = max(here - h - m, there - s - m)
                    if s < there and h < here and shared < n and apart <= self.most_gap and covered[j] + n - shared > covered[i]:
                        covered[i], before[i] = covered[j] + n - shared, j
            used = [False] * len(hits)
            for i in sorted(range(len(hits)), key=lambda i: (-covered[i], hits[i])):
                if used[i]:
                    continue
                j, total = i, 0
                chain = []
                while j >= 0 and not used[j]:
                    chain.append(j)
                    j = before[j]
                total = covered[i] - (covered[j] if j >= 0 else 0)
                for j in chain:
                    used[j] = True
                label = self.templates[t - self.n_phrases][0]
                first, last = hits[chain[-1]], hits[chain[0]]
                found.append({
                    "label": label, "template": t - self.n_phrases, "start": first[0], "end": last[0] + last[2],
                    "covered": total, "share": min(1.0, total / self.sizes[t]),
                })
        return sorted(found, key=lambda s: (s["start"], s["end"], s["template"]))


def _scanned(batches: Iterator[pa.RecordBatch], library: Library) -> Iterator[pa.RecordBatch]:
    place = pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
    span = pa.list_(pa.struct([
        ("label", pa.string()), ("template", pa.int32()), ("start", pa.int64()), ("end", pa.int64()),
        ("covered", pa.int32()), ("share", pa.float64()),
    ]))
    for batch in batches:
        counts, places, spans = [], [], []
        for text in batch.column("text").cast(pa.large_binary()):
            n, found, matches = library.scan(text.as_py() or b"")
            counts.append(n)
            places.append([{"label": label, "start": s, "end": e} for label, s, e in found])
            spans.append(library.spans(matches))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(places, place), pa.array(spans, span)],
            names=["doc_id", "n_words", "places", "spans"],
        )


def license_spans(
    docs: DataFrame,
    phrases: Sequence[tuple[str, str]] = BASE_PHRASES,
    templates: Sequence[tuple[str, str]] = TEMPLATES,
    least_match: int = LEAST_MATCH,
    most_gap: int = MOST_GAP,
) -> DataFrame:
    """``doc_id, n_words, places, spans`` of every document (doc_id, text).

    ``places`` are all places of the phrases and ``spans`` the stretches that follow a template (label, its
    number, first word and word after the last, words covered, share of the template), in words from 0.
    Phrases and templates (label, text) make one suffix automaton; a text is streamed through it once, and
    at every word the automaton tells the longest match of each template that ends there. Matches of
    ``least_match`` words or more, apart by ``most_gap`` words at most and in the template's order, are chained.

    Words are runs of letters and digits, A-Z lower-cased, of the whole text. A null or empty text has no words
    and nothing found; a document that repeats a licence has a span for each; repeated rows are treated alike and
    apart, a null doc_id stays null, other columns are not looked at, an empty table gives an empty one.
    """
    library = Library(phrases, templates, least_match, most_gap, PERCENT)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(partial(_scanned, library=library), _SCHEMA)


def _labels(values: Column) -> Column:
    return F.array_join(F.array_sort(F.array_distinct(values)), ",")


def digests(found: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Numbers and labels of what :func:`license_spans` found.

    ``labels`` are those of the phrases and of templates covered by ``percent`` hundredths or more in one span;
    ``score`` is the largest share of a template that one span covers, 1 where a phrase is found, 0 with neither.
    """
    base = F.transform("places", lambda p: p["label"])
    covered = F.filter("spans", lambda s: s["share"] * 100 >= percent)
    starts = F.transform("places", lambda p: p["start"])
    shares = F.transform("spans", lambda s: s["share"])
    return found.select(
        "doc_id",
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        _labels(base).alias("base_labels"),
        _labels(F.concat(base, F.transform(covered, lambda s: s["label"]))).alias("labels"),
        F.when(F.size("places") > 0, 1.0).otherwise(F.coalesce(F.array_max(shares), F.lit(0.0))).alias("score"),
        F.size(covered).cast("long").alias("n_spans"),
    )
