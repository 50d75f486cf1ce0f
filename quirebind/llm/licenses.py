"""License scans by patience alignment.

A template and a passage are aligned at the words that occur once in both, kept
in the order of a longest increasing subsequence; the gaps between these anchors
are aligned the same way.  Where a gap has no anchor, its equal ends are matched.
Coverage is the share of the template's words that are aligned.

A document may hold a license many times, and then no word is unique in it.  So
the aligned passages are windows: words of a template (fewest occurrences in the
document first, common words last) say where it may begin.  They are so many that they
fill more of the template's places than a passage of the asked coverage can lack, so
one of them at least is aligned in it.  Every occurrence opens windows of the template's
length, for every place of the word in the template: with room on both sides, on either
and on none, so that repeated neighbours do not hide each other.  All windows are tried;
those whose words cannot reach the coverage are passed over, which loses nothing.  Of
passages that overlap, those of the largest sum of coverages are taken.  A passage with
more words put in than the room, a quarter of the template, is not looked for.

Defined cases: null and empty texts have no license; repeated rows are scanned
alike; an empty table gives an empty result; further columns are dropped.
"""

import math
import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame

from quirebind.llm.words import id_and_text, map_rows

COVERAGE = 0.8
_TOKEN = re.compile(r"[^\W_]+")

# --- fixed values: license notices and texts --------------------------------------
TEMPLATES = {
    "Apache-2.0 notice": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this "
        "file except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed "
        "to in writing, software distributed under the License is distributed on an \"AS IS\" "
        "BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the "
        "License for the specific language governing permissions and limitations under the "
        "License."
    ),
    "CC-BY-NC-4.0 notice": "Licensed under CC BY-NC 4.0.",
    "GPL-3.0 notice": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0": (
        "This program is free software: you can redistribute it and/or modify it under the terms "
        "of the GNU General Public License as published by the Free Software Foundation, either "
        "version 3 of the License, or (at your option) any later version. This program is "
        "distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even "
        "the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the "
        "GNU General Public License for more details."
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with "
        "or without fee is hereby granted, provided that the above copyright notice and this "
        "permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE "
        "AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED "
        "WARRANTIES OF MERCHANTABILITY AND FITNESS."
    ),
    "MIT notice": "Released under the MIT License.",
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        "software and associated documentation files (the \"Software\"), to deal in the Software "
        "without restriction, including without limitation the rights to use, copy, modify, "
        "merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
        "permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions: The above copyright notice and this permission notice shall be included in "
        "all copies or substantial portions of the Software."
    ),
    "Reserved": "All rights reserved.",
}
#: Words that say where a license may begin only where others are too few.
COMMON = frozenset(
    "a above all an and any as at be by do even for from in is it may not of on or other so "
    "that the this to under use with without you your".split()
)
# --- end of fixed values ------------------------------------------------------------


def tokens(text: str | None) -> list[str]:
    return _TOKEN.findall(text.lower()) if text else []


def _increasing(values: list[int]) -> list[int]:
    """Places of a longest increasing subsequence, by patience sorting."""
    tops: list[int] = []
    piles: list[int] = []
    back: list[int] = []
    for i, v in enumerate(values):
        k = bisect_left(tops, v)
        back.append(piles[k - 1] if k else -1)
        if k == len(tops):
            tops.append(v)
            piles.append(i)
        else:
            tops[k], piles[k] = v, i
    out, at = [], piles[-1] if piles else -1
    while at >= 0:
        out.append(at)
        at = back[at]
    return out[::-1]


def align(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Pairs of places of equal words, increasing in both."""
    pairs: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            pairs.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            pairs.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        ca, cb = Counter(a[a0:a1]), Counter(b[b0:b1])
        where = {w: j for j, w in enumerate(b[b0:b1], b0) if cb[w] == 1}
        once = [(i, where[a[i]]) for i in range(a0, a1) if ca[a[i]] == 1 and a[i] in where]
        anchors = [once[k] for k in _increasing([j for _, j in once])]
        if not anchors:
            continue
        pairs += anchors
        edges = [(a0 - 1, b0 - 1), *anchors, (a1, b1)]
        todo += [
            (i + 1, k, j + 1, m)
            for (i, j), (k, m) in zip(edges, edges[1:], strict=False)
            if i + 1 < k and j + 1 < m
        ]
    return sorted(pairs)


class Scanner:
    def __init__(self, templates: dict[str, str], coverage: float):
        self.coverage = coverage
        self.templates = {k: tokens(v) for k, v in templates.items()}
        # Places of each word in the template, and how many places a passage may lack.
        self.at: dict[str, dict[str, list[int]]] = {}
        self.lack: dict[str, int] = {}
        for k, v in self.templates.items():
            self.lack[k] = len(v) - max(1, math.ceil(coverage * len(v) - 1e-9))
            at: dict[str, list[int]] = {}
            for i, w in enumerate(v):
                at.setdefault(w, []).append(i)
            rare = {w: p for w, p in at.items() if w not in COMMON}
            self.at[k] = rare if sum(map(len, rare.values())) > self.lack[k] else at
        self.vocabulary = set().union(*self.at.values())

    def scan(self, text: str | None) -> list[tuple[str, int, int, float]]:
        """(license, first word, end word, coverage), passages of one license apart."""
        words = tokens(text)
        places: dict[str, list[int]] = {}
        for i, w in enumerate(words):
            if w in self.vocabulary:
                places.setdefault(w, []).append(i)
        found: list[tuple[str, int, int, float]] = []
        if places:
            for name in self.templates:
                found += self._passages(name, words, places)
        return sorted(found, key=lambda f: (f[1], f[0]))

    def _passages(self, name, words, places) -> list[tuple[str, int, int, float]]:
        template, spots = self.templates[name], self.at[name]
        n = len(template)
        room = max(2, n // 4)
        filled, begins = 0, set()
        for w in sorted(spots, key=lambda w: (w in COMMON, len(places.get(w, ())), w)):
            if filled > self.lack[name]:
                break
            filled += len(spots[w])
            begins.update(p - at for p in places.get(w, ()) for at in spots[w])
        windows = {
            (max(0, b - before), b + n + after)
            for b in begins for before in (0, room) for after in (0, room)
        }
        need, spans = Counter(template), set()
        for start, stop in sorted(windows):
            window = words[start : max(start, stop)]
            got = Counter(w for w in window if w in need)
            if sum(min(c, need[w]) for w, c in got.items()) < self.coverage * n:
                continue
            pairs = align(template, window)
            share = len(pairs) / n
            if pairs and share >= self.coverage:
                spans.add((start + pairs[0][1], start + pairs[-1][1] + 1, share))
        return [(name, first, last, share) for first, last, share in _apart(spans)]


def _apart(spans: set[tuple[int, int, float]]) -> list[tuple[int, int, float]]:
    """Of overlapping spans those of the largest sum of shares, and of the fewest words."""
    order = sorted(spans, key=lambda s: (s[1], s[0], s[2]))
    ends = [last for _, last, _ in order]
    best: list[tuple[float, int]] = [(0.0, 0)]
    took: list[int] = []  # how many of the spans before remain with this one; -1 without it
    for k, (first, last, share) in enumerate(order):
        upto = bisect_right(ends, first, 0, k)
        with_it = (round(best[upto][0] + share, 9), best[upto][1] - (last - first))
        took.append(upto if with_it > best[k] else -1)
        best.append(max(with_it, best[k]))
    out, k = [], len(order)
    while k:
        if took[k - 1] < 0:
            k -= 1
        else:
            out.append(order[k - 1])
            k = took[k - 1]
    return out[::-1]


def license_report(
    docs: DataFrame, templates: dict[str, str] | None = None, coverage: float = COVERAGE
) -> DataFrame:
    """Per document: doc_id, n_licenses, and licenses (name, first and end word,
    coverage) in order."""
    known = TEMPLATES if templates is None else templates

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, Any]]:
        scanner = Scanner(known, coverage)
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                found = scanner.scan(text.as_py())
                yield {"doc_id": doc, "n_licenses": len(found), "licenses": [
                    {"license": k, "first": a, "end": b, "coverage": c} for k, a, b, c in found
                ]}

    return map_rows(
        id_and_text(docs), run,
        "doc_id bigint, n_licenses int, licenses array<struct<license: string, first: int, "
        "end: int, coverage: double>>",
    )
