"""License scans by patience alignment.

A template and a stretch of a document are aligned by the words that are unique in
both: of those anchors the longest increasing subsequence is kept, and the gaps
between them are aligned again in the same way.  Coverage is the share of the
template's words that are aligned.

A match is a stretch of words, a quarter longer than the template at most, that covers the
template enough.  Stretches are looked at wherever they have one of the template's key
words.  The key words stand on so many of the template's places that an alignment
without any of them can't reach the least coverage, so no match is missed by looking
there only.  Stretches that don't have enough of the template's words in any order are
passed over; their counts move along with the stretch, so a long text with a key word
at every place costs its length.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from math import ceil

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: License notices: (id, text).  Fixed values.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0-header", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0. Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("MIT", "Released under the MIT License."),
    ("MIT-text", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0-header", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("BSD-3-Clause-header", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
)
_WORD = re.compile(r"[^\W_]+(?:[.-][^\W_]+)*")


def words_of(text: str) -> list[str]:
    """Words in lower case, with inner dots and hyphens."""
    return _WORD.findall(text.lower())


def longest_rise(values: list[int]) -> list[int]:
    """Places of a longest strictly increasing subsequence, by patience piles."""
    tops: list[int] = []
    pile_of: list[int] = []
    before: list[int] = []
    for i, v in enumerate(values):
        pile = bisect_left(tops, v)
        before.append(pile_of[pile - 1] if pile else -1)
        if pile == len(tops):
            tops.append(v)
            pile_of.append(i)
        else:
            tops[pile], pile_of[pile] = v, i
    out, i = [], pile_of[-1] if pile_of else -1
    while i >= 0:
        out.append(i)
        i = before[i]
    return out[::-1]


def align(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Aligned places of two word lists, rising in both."""
    found: list[tuple[int, int]] = []
    gaps = [(0, len(a), 0, len(b))]
    while gaps:
        i, j, k, m = gaps.pop()
        while i < j and k < m and a[i] == b[k]:  # equal ends need no anchors
            found.append((i, k))
            i, k = i + 1, k + 1
        while i < j and k < m and a[j - 1] == b[m - 1]:
            j, m = j - 1, m - 1
            found.append((j, m))
        if i == j or k == m:
            continue
        one, two = Counter(a[i:j]), Counter(b[k:m])
        place = {w: y for y, w in enumerate(b[k:m], k) if two[w] == 1}
        anchors = [(x, place[w]) for x, w in enumerate(a[i:j], i) if one[w] == 1 and w in place]
        kept = [anchors[p] for p in longest_rise([y for _, y in anchors])]
        found += kept
        edges = [(i - 1, k - 1), *kept, (j, m)]
        if kept:
            gaps += [(x + 1, p, y + 1, q) for (x, y), (p, q) in zip(edges, edges[1:], strict=False)]
    return sorted(found)


class Scanner:
    """Templates with their key words."""

    def __init__(self, templates=TEMPLATES, least: float = 0.8):
        self.templates = [(name, words_of(text)) for name, text in templates]
        #: words of each template that must be aligned; less a little, as 0.8 * 5 may be over 4 in floats
        self.need = [ceil(least * len(words) - 1e-9) for _, words in self.templates]
        self.counts = [Counter(words) for _, words in self.templates]
        #: words of a stretch: a quarter more than the template
        self.reach = [len(words) + len(words) // 4 for _, words in self.templates]
        spread = Counter(w for _, words in self.templates for w in set(words))
        self.keys: dict[str, list[int]] = {}
        for t, (_, words) in enumerate(self.templates):
            count, covered = self.counts[t], 0
            # the words of fewest templates first, then the longest
            for w in sorted(count, key=lambda w: (spread[w], -len(w), w)):
                self.keys.setdefault(w, []).append(t)
                covered += count[w]
                if covered > len(words) - self.need[t]:
                    break

    def _stretches(self, t: int, words: list[str]):
        """A function of rising starts: the aligned places of the stretch from there, or nothing if they are too few.

        A stretch that doesn't have enough of the template's words in any order isn't aligned;
        the counts of its words move along.
        """
        template, want, reach, need = self.templates[t][1], self.counts[t], self.reach[t], self.need[t]
        have: Counter = Counter()
        common = a = b = 0

        def stretch(lo: int) -> list[tuple[int, int]] | None:
            nonlocal have, common, a, b
            hi = min(lo + reach, len(words))
            if lo >= b:
                have, common, a, b = Counter(), 0, lo, lo
            for w in words[b:hi]:
                have[w] += 1
                common += have[w] <= want.get(w, 0)
            for w in words[a:lo]:
                common -= have[w] <= want.get(w, 0)
                have[w] -= 1
            a, b = lo, hi
            if common < need:
                return None
            pairs = align(template, words[lo:hi])
            return [(x, lo + y) for x, y in pairs] if len(pairs) >= need else None

        return stretch

    def scan(self, text: str) -> list[tuple[str, float, int, int]]:
        """(id, coverage, first word, end) of the stretches that cover a template enough; stretches of one template don't overlap."""
        words = words_of(text)
        hits: dict[int, list[int]] = {}
        there = {w: self.keys[w] for w in self.keys.keys() & set(words)}
        for i, w in enumerate(words) if there else ():
            for t in there.get(w, ()):
                hits.setdefault(t, []).append(i)
        out = []
        for t, places in hits.items():
            done = after = 0
            stretch = self._stretches(t, words)
            for p in places:
                lo = max(done, after, p - self.reach[t] + 1)
                while lo <= p:
                    best = stretch(lo)
                    if best:
                        # a later start may have the rest of the notice
                        for later in range(lo + 1, best[0][1] + 1):
                            best = max(best, stretch(later) or [], key=len)
                        out.append((self.templates[t][0], len(best) / len(self.templates[t][1]), best[0][1], best[-1][1] + 1))
                        lo = done = best[-1][1] + 1
                    else:
                        lo += 1
                after = p + 1
        return sorted(out, key=lambda x: (x[2], x[0]))


@lru_cache(maxsize=4)
def _scanner(templates, least: float) -> Scanner:
    return Scanner(templates, least)


KIND = "doc_id long, licenses array<string>, best string, coverage double, n_matches long, spans array<struct<license:string,coverage:double,start:int,end:int>>"


def scan_licenses(docs: DataFrame, templates=TEMPLATES, least: float = 0.8) -> DataFrame:
    """doc_id, licenses (sorted ids), best, coverage, n_matches, spans (word places), one row for each row of ``docs``.

    ``best`` has the most coverage, of equal ones the longest template, then the
    first by id.  Texts without a match, and null texts, have an empty list, null and 0.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = _scanner(templates, least)
        size = {name: len(words) for name, words in scanner.templates}
        span = pa.list_(pa.struct([("license", pa.string()), ("coverage", pa.float64()), ("start", pa.int32()), ("end", pa.int32())]))
        for batch in batches:
            found = [scanner.scan(t or "") for t in batch.column(1).to_pylist()]
            best = [min(f, key=lambda x: (-x[1], -size[x[0]], x[0])) if f else (None, 0.0) for f in found]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([sorted({x[0] for x in f}) for f in found], pa.list_(pa.string())),
                    pa.array([x[0] for x in best], pa.string()),
                    pa.array([round(x[1], 6) for x in best], pa.float64()),
                    pa.array([len(f) for f in found], pa.int64()),
                    pa.array([[dict(zip(("license", "coverage", "start", "end"), x, strict=True)) for x in f] for f in found], span),
                ],
                ["doc_id", "licenses", "best", "coverage", "n_matches", "spans"],
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, KIND)
