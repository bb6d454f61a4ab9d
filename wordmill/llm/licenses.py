"""License scans with a generalised suffix automaton of licence tokens.

The words of all templates go into one suffix automaton. A file streams through
it: state and matched length give the matching statistics, the longest template
substring that ends at each word. Then, per file:

1. Matches that no longer match contains, of ``min_match`` words or a whole
   template, are placed in every template that holds them: the automaton's suffix
   links lead from a state to the places of its substrings.
2. The matches of one template that follow each other in file and template, with
   at most ``max_gap`` other words between them on either side, are chained; a
   match may give up words at its front to a match before it. The chain that
   covers most words of the template ends first, and chains that share a match
   with it go.
3. A chain that covers ``min_cover`` of its template's words is a span with the
   template's label. A template may ask for more (a phrase: all its words).

Templates are a parameter of the caller: they are on the driver already, hold at
most ``MAX_TEMPLATE_WORDS`` words in all (more raise an error), and their
automaton is broadcast. The files are mapped in place, nothing is shuffled.

Before the automaton runs, numpy drops the stretches without a match: words in a
template, each pair of neighbours next to each other in one, at least as many as
the shortest match asks. That skips none, as a match holds only such pairs.

Defined cases: a null or empty text has no words; a text of any length is one
row; equal templates both count; a template without words never matches; repeated
rows each get their result; an empty table gives no rows; other columns of the
input are kept.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import documents, map_text, register

MIN_MATCH = 4
MAX_GAP = 12
MIN_COVER = 0.6
MAX_TEMPLATE_WORDS = 1_000_000


@dataclass(frozen=True)
class Template:
    """A licence text. ``exact`` templates match as a whole only; the places of
    ``base`` ones are counted."""

    label: str
    text: str
    exact: bool = False
    base: bool = False


# The phrases of the contract.
BASE = (
    Template("cc-by", "cc by", exact=True, base=True),
    Template("gpl", "general public license", exact=True, base=True),
    Template("reserved", "all rights reserved", exact=True, base=True),
)

# Notices and grants in the words of the licences themselves.
NOTICES = (
    Template("mit", "released under the MIT License"),
    Template("mit", "licensed under the MIT License"),
    Template("mit", "SPDX-License-Identifier: MIT", exact=True),
    Template(
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the Software), to deal in the Software without restriction, including "
        "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
        "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
        "following conditions: The above copyright notice and this permission notice shall be included in all "
        "copies or substantial portions of the Software.",
    ),
    Template("apache", "Licensed under the Apache License, Version 2.0"),
    Template("apache", "SPDX-License-Identifier: Apache-2.0", exact=True),
    Template(
        "apache",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        "software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR "
        "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
        "permissions and limitations under the License.",
    ),
    Template("gpl", "licensed under the GNU General Public License, version 3"),
    Template("gpl", "licensed under the GNU General Public License, version 2"),
    Template(
        "gpl",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, or "
        "(at your option) any later version. This program is distributed in the hope that it will be useful, but "
        "WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR "
        "PURPOSE. See the GNU General Public License for more details.",
    ),
    Template(
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met: Redistributions of source code must retain the above copyright "
        "notice, this list of conditions and the following disclaimer. Redistributions in binary form must "
        "reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
        "documentation and/or other materials provided with the distribution.",
    ),
    Template("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    Template("cc-by", "licensed under a Creative Commons Attribution 4.0 International License"),
    Template("cc-by-sa", "licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    Template("cc-by-nc", "licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    Template("cc-by-nc", "cc by nc", exact=True),
    Template("cc-by-sa", "cc by sa", exact=True),
    Template("cc-by-nd", "cc by nd", exact=True),
    Template("cc0", "licensed under CC0 1.0 Universal"),
)

# Lower-cases A-Z and turns every other ASCII character but digits into a space.
_TO_WORDS = bytes(
    c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else c + 32 if 0x41 <= c <= 0x5A else 0x20
    for c in range(256)
)


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(_TO_WORDS).split() if text else []


class LicenceAutomaton:
    """Generalised suffix automaton over the templates' words, with the places
    (template, end) of the substrings of each state."""

    def __init__(self, templates: tuple[Template, ...], min_match: int = MIN_MATCH):
        self.templates = templates
        self.words = [words_of(t.text.encode()) for t in templates]
        self.vocab: dict[bytes, int] = {}
        self.go: list[dict[int, int]] = [{}]
        self.up = [-1]
        self.size = [0]
        self.ends: list[list[tuple[int, int]]] = [[]]
        pairs = set()
        for number, words in enumerate(self.words):
            ids = [self.vocab.setdefault(w, len(self.vocab)) for w in words]
            pairs.update(zip(ids, ids[1:], strict=False))
            state = 0
            for end, w in enumerate(ids, 1):
                state = self._extend(state, w)
                self.ends[state].append((number, end))
        self.below: list[list[int]] = [[] for _ in self.size]
        for v in range(1, len(self.size)):
            self.below[self.up[v]].append(v)
        lengths = [len(w) for w in self.words if w]
        self.min_match = min_match
        #: The shortest run of words that can matter.
        self.least = min([min_match, *lengths])
        side = len(self.vocab) + 1
        self.pairs = np.array(sorted(a * side + b for a, b in pairs), np.int64)
        # Per state, the whole templates that are suffixes of its substrings.
        self.wholes: list[tuple[int, ...]] = [()] * len(self.size)
        full: dict[int, list[int]] = defaultdict(list)
        for v, ends in enumerate(self.ends):
            for number, end in ends:
                if end == len(self.words[number]):
                    full[v].append(number)
        for v in sorted(range(1, len(self.size)), key=self.size.__getitem__):
            self.wholes[v] = self.wholes[self.up[v]] + tuple(full[v])

    def _clone(self, p: int, w: int, q: int) -> int:
        if self.size[q] == self.size[p] + 1:
            return q
        new = len(self.size)
        self.go.append(dict(self.go[q]))
        self.up.append(self.up[q])
        self.size.append(self.size[p] + 1)
        self.ends.append([])
        self.up[q] = new
        while p >= 0 and self.go[p].get(w) == q:
            self.go[p][w] = new
            p = self.up[p]
        return new

    def _extend(self, last: int, w: int) -> int:
        if w in self.go[last]:
            return self._clone(last, w, self.go[last][w])
        new = len(self.size)
        self.go.append({})
        self.up.append(0)
        self.size.append(self.size[last] + 1)
        self.ends.append([])
        p = last
        while p >= 0 and w not in self.go[p]:
            self.go[p][w] = new
            p = self.up[p]
        if p >= 0:
            self.up[new] = self._clone(p, w, self.go[p][w])
        return new

    def places(self, state: int) -> list[tuple[int, int]]:
        """(template, end) of every place of the state's longest substring."""
        out, todo = [], [state]
        while todo:
            v = todo.pop()
            out += self.ends[v]
            todo += self.below[v]
        return out

    def runs(self, words: list[bytes]) -> tuple[np.ndarray, list[tuple[int, int]]]:
        """Word numbers, and the stretches [a, b) that may hold a match."""
        n = len(words)
        ids = np.fromiter(map(self.vocab.get, words, repeat(-1)), np.int64, n)
        if not len(self.pairs) or self.least < 2:
            good = ids >= 0
        else:
            code = ids[:-1] * (len(self.vocab) + 1) + ids[1:]
            at = np.minimum(np.searchsorted(self.pairs, code), len(self.pairs) - 1)
            beside = (self.pairs[at] == code) & (ids[:-1] >= 0) & (ids[1:] >= 0)
            edge = np.flatnonzero(np.diff(np.concatenate(([False], beside, [False])).view(np.int8)))
            return ids, [(a, b + 1) for a, b in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True) if b + 1 - a >= self.least]
        edge = np.flatnonzero(np.diff(np.concatenate(([False], good, [False])).view(np.int8)))
        return ids, list(zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True))

    def statistics(self, ids: list[int]) -> list[tuple[int, int]]:
        """(length, state) of the longest template substring ending at each word."""
        out, state, length = [], 0, 0
        for w in ids:
            while w not in self.go[state] and state:
                state = self.up[state]
                length = self.size[state]
            state = self.go[state].get(w, 0)
            length = length + 1 if state else 0
            out.append((length, state))
        return out


def chains(
    matches: list[tuple[int, int, int]], max_gap: int = MAX_GAP
) -> list[tuple[int, int, int]]:
    """Matches (file end, template end, length) of one template -> chains
    (covered words, first word, last word + 1), the widest first, none sharing
    a match. Only matches at most ``max_gap`` words apart are compared."""
    items = sorted(set(matches))
    best: list[int] = []
    back: list[int] = []
    low = 0
    longest = max((n for _, _, n in items), default=0)
    for j, (e, t, n) in enumerate(items):
        while items[low][0] < e - n - max_gap - longest:
            low += 1
        score, prev = n, -1
        for i in range(low, j):
            d, s, _ = items[i]
            cut = max(d - (e - n), s - (t - n), 0)  # words given up at the front
            if cut < n and d < e and s < t and e - n + cut - d <= max_gap and t - n + cut - s <= max_gap and best[i] + n - cut > score:
                score, prev = best[i] + n - cut, i
        best.append(score)
        back.append(prev)
    used = [False] * len(items)
    out = []
    for j in sorted(range(len(items)), key=lambda x: (-best[x], items[x])):
        path, i = [], j
        while i >= 0 and not used[i]:
            path.append(i)
            i = back[i]
        if i >= 0:
            continue
        for i in path:
            used[i] = True
        e, _, n = items[path[-1]]
        out.append((best[j], e - n, items[j][0]))
    return out


def scan(automaton: LicenceAutomaton, words: list[bytes], max_gap: int, min_cover: float):
    """-> base places (start, label), and spans (start, end, label, share of
    the template covered), sorted."""
    base: list[tuple[int, str]] = []
    spans: set[tuple[int, int, str, float]] = set()
    found: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
    if len(words) < automaton.least:
        return base, []
    ids, runs = automaton.runs(words)
    for a, b in runs:
        stats = automaton.statistics(ids[a:b].tolist())
        for i, (length, state) in enumerate(stats):
            end = a + i + 1
            for number in automaton.wholes[state]:
                size, template = len(automaton.words[number]), automaton.templates[number]
                if size > length:
                    continue
                if template.base:
                    base.append((end - size, template.label))
                spans.add((end - size, end, template.label, 1.0))
            last = i + 1 == len(stats) or stats[i + 1][0] <= length
            if last and length >= automaton.min_match:
                for number, place in automaton.places(state):
                    if not automaton.templates[number].exact and length < len(automaton.words[number]):
                        found[number].append((end, place, length))
    for number, matches in found.items():
        template, size = automaton.templates[number], len(automaton.words[number])
        for covered, start, end in chains(matches, max_gap):
            if covered >= min_cover * size:
                spans.add((start, end, template.label, covered / size))
    return sorted(base), sorted(spans)


def license_spans(
    docs: DataFrame,
    templates: tuple[Template, ...] = BASE + NOTICES,
    min_match: int = MIN_MATCH,
    max_gap: int = MAX_GAP,
    min_cover: float = MIN_COVER,
) -> DataFrame:
    """docs(text, ...) plus lic_words (words of the text), lic_base (places of
    base templates: start word and label) and lic_spans (start, end, label,
    cover: words [start, end) that cover this share of a template)."""
    total = sum(len(words_of(t.text.encode())) for t in templates)
    if total > MAX_TEMPLATE_WORDS:
        raise ValueError(f"templates hold {total} words; their broadcast is bounded by {MAX_TEMPLATE_WORDS}")
    shared = docs.sparkSession.sparkContext.broadcast(LicenceAutomaton(tuple(templates), min_match))
    base_type = pa.list_(pa.struct([("start", pa.int64()), ("label", pa.string())]))
    span_type = pa.list_(
        pa.struct([("start", pa.int64()), ("end", pa.int64()), ("label", pa.string()), ("cover", pa.float64())])
    )

    def add(texts: list[bytes | None]) -> dict[str, pa.Array]:
        sizes, bases, spans = [], [], []
        for text in texts:
            words = words_of(text)
            b, s = scan(shared.value, words, max_gap, min_cover)
            sizes.append(len(words))
            bases.append([{"start": x, "label": y} for x, y in b])
            spans.append([{"start": x, "end": y, "label": z, "cover": c} for x, y, z, c in s])
        return {
            "lic_words": pa.array(sizes, pa.int64()),
            "lic_base": pa.array(bases, base_type),
            "lic_spans": pa.array(spans, span_type),
        }

    return map_text(
        docs,
        add,
        "lic_words bigint, lic_base array<struct<start:bigint,label:string>>, "
        "lic_spans array<struct<start:bigint,end:bigint,label:string,cover:double>>",
    )


@register("op13_license_scan")
def q_licenses(spark, sf_dir):
    found = license_spans(documents(spark, sf_dir, "doc_id", "text"))
    labels = lambda *c: F.array_join(F.array_sort(F.array_distinct(F.concat(*c))), ",")
    return found.select(
        "doc_id",
        F.col("lic_words").alias("n_words"),
        F.size("lic_base").cast("bigint").alias("n_base"),
        F.array_min("lic_base.start").alias("first_word"),
        F.array_max("lic_base.start").alias("last_word"),
        labels(F.col("lic_base.label")).alias("base_labels"),
        labels(F.col("lic_base.label"), F.col("lic_spans.label")).alias("labels"),
        F.coalesce(F.array_max("lic_spans.cover"), F.lit(0.0)).alias("score"),
    )
