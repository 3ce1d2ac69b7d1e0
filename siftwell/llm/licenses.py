"""Operator 3: licence scans by patience alignment.

A licence template is looked for in each text. Words that occur once in both are anchors; the longest increasing
run of them is kept, and the gaps between are aligned in the same way after their common ends are matched. The
coverage is the share of the template's words that are aligned.

Where a text may hold a template more than once, words would not be unique, so a text is aligned in the regions
around its occurrences of the template's rarest word there. A region where that word is repeated may hold copies back to
back; it is aligned in windows of one copy too: between the word's neighbouring occurrences, and where a copy with the
word in its place would be. Most texts are never aligned: the coverage cannot be
more than the share of the template's words that the text has at all, which one look-up per word bounds.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import carried_columns, fields_of, texts_of
from .toxicity import text_words

#: Notices in their published wording.
TEMPLATES = {
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0.", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.'],
    "MIT": ["Released under the MIT License.", 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.'],
    "GPL-3.0": ["This work is licensed under the GNU General Public License, version 3.", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "ISC": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."],
    "BSD-2-Clause": ["Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."],
}


def longest_increasing(values: list[int]) -> list[int]:
    """Indices of one longest strictly increasing run, by patience piles."""
    tops: list[int] = []
    on_top: list[int] = []
    below = [-1] * len(values)
    for i, v in enumerate(values):
        p = bisect_left(tops, v)
        below[i] = on_top[p - 1] if p else -1
        if p == len(tops):
            tops.append(v)
            on_top.append(i)
        else:
            tops[p], on_top[p] = v, i
    out, i = [], on_top[-1] if on_top else -1
    while i >= 0:
        out.append(i)
        i = below[i]
    return out[::-1]


def align(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Matching places of two lists of words, by patience alignment."""
    found: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            found.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            found.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        in_a, in_b = Counter(a[a0:a1]), Counter(b[b0:b1])
        spot = {w: j for j, w in enumerate(b[b0:b1], b0) if in_b[w] == 1}
        anchors = [(i, spot[w]) for i, w in enumerate(a[a0:a1], a0) if in_a[w] == 1 and w in spot]
        chain = [anchors[k] for k in longest_increasing([j for _, j in anchors])]
        if not chain:
            continue
        found += chain
        ends = [(a0 - 1, b0 - 1), *chain, (a1, b1)]
        todo += [(p[0] + 1, q[0], p[1] + 1, q[1]) for p, q in zip(ends, ends[1:], strict=False) if q[0] > p[0] + 1 and q[1] > p[1] + 1]
    return sorted(found)


class Templates:
    def __init__(self, templates: dict[str, list[str]]):
        self.names, self.words = [], []
        for name, texts in templates.items():
            for text in texts:
                self.names.append(name)
                self.words.append(text_words([text.encode()])[1].tolist())
        self.counts = [Counter(w) for w in self.words]
        self.vocabulary = np.unique(np.array([x for w in self.words for x in w], np.uint64))
        self.needs = np.zeros((len(self.words), len(self.vocabulary)), np.int64)
        for k, c in enumerate(self.counts):
            for w, n in c.items():
                self.needs[k, np.searchsorted(self.vocabulary, np.uint64(w))] = n

    def scan(self, words: np.ndarray, least: float) -> list[tuple[int, float, int, int]]:
        """(template, coverage, first word, end) of each region of a text that covers ``least`` of a template."""
        if not len(self.vocabulary) or not len(words):
            return []
        at = np.minimum(np.searchsorted(self.vocabulary, words), len(self.vocabulary) - 1)
        hit = np.flatnonzero(self.vocabulary[at] == words)
        have = np.bincount(at[hit], minlength=len(self.vocabulary))
        bound = np.minimum(self.needs, have).sum(axis=1) / self.needs.sum(axis=1)
        out = []
        for k in np.flatnonzero(bound >= least):
            template = self.words[k]
            n, own = len(template), np.flatnonzero(self.needs[k])
            # an aligned region misses at most (1 - least) * n words of the template: some of its rarest words that
            # together outweigh this are in every region
            order = own[np.argsort(have[own], kind="stable")]
            spare, spots = (1 - least) * n, []
            for v in order:
                spots.append(hit[at[hit] == v])
                spare -= self.needs[k, v]
                if spare < 0:
                    break
            places = np.unique(np.concatenate(spots))
            last = -1
            for p in places.tolist():
                if p < last:
                    continue
                best = None
                for a, b in self.windows(k, words, p, max(last, 0), least):
                    part = words[a:b].tolist()
                    if (Counter(part) & self.counts[k]).total() < least * n:
                        continue
                    pairs = align(part, template)
                    if len(pairs) >= least * n:
                        first, end = a + pairs[0][0], a + pairs[-1][0] + 1
                        # one copy around this place rather than a part of it and a part of the next
                        best = min(best or (True, True), (not first <= p < end, (end - first) * least > n, -len(pairs), end - first, first, end))
                if best and not best[0]:
                    out.append((int(k), -best[2] / n, best[4], best[5]))
                    last = best[5]
        return out

    def windows(self, k: int, words: np.ndarray, p: int, low: int, least: float) -> list[tuple[int, int]]:
        """Where to align a template around the place of one of its words: widely and, if the word is repeated there
        more than in the template, in windows of one copy."""
        template, word = self.words[k], int(words[p])
        n = len(template)
        a, b = max(low, p - 2 * n), min(len(words), p + 2 * n)
        out = [(a, b)]
        again = a + np.flatnonzero(words[a:b] == words[p])
        own = [t for t, w in enumerate(template) if w == word]
        if len(again) > len(own):
            if len(own) == 1:
                at = int(np.searchsorted(again, p))
                out.append((int(again[at - 1]) + 1 if at else a, int(again[at + 1]) if at + 1 < len(again) else b))
            spare = int(n / max(least, 0.5)) - n
            for t in own:
                out += [(max(a, p - t - more), min(b, p - t + n + more)) for more in {0, spare}]
        return out


def _scan(batches, templates: Templates, least: float, carry: list[str]):
    match = pa.list_(pa.struct([("license", pa.string()), ("coverage", pa.float64()), ("start", pa.int64()), ("end", pa.int64())]))
    for batch in batches:
        texts = texts_of(batch.column(0))
        for at in range(0, len(texts), 256):
            part = texts[at : at + 256]
            row, words = text_words(part)
            cuts = np.searchsorted(row, np.arange(len(part) + 1))
            best, cover, matches = [], [], []
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                found = [{"license": templates.names[k], "coverage": c, "start": s, "end": e} for k, c, s, e in templates.scan(words[a:b], least)]
                found.sort(key=lambda m: (m["start"], m["end"], m["license"]))
                top = min(found, key=lambda m: (m["start"] - m["end"], -m["coverage"], m["start"], m["license"])) if found else None
                best.append(top and top["license"])
                cover.append(top["coverage"] if top else 0.0)
                matches.append(found)
            rest = batch.select(range(1, batch.num_columns)).slice(at, len(part))
            yield pa.RecordBatch.from_arrays([*rest.columns, pa.array(best, pa.string()), pa.array(cover, pa.float64()), pa.array(matches, match)], names=[*carry, "license", "coverage", "matches"])


def scan_licenses(docs: DataFrame, templates: dict[str, list[str]] | None = None, min_coverage: float = 0.8, text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """Finds licence templates in every whole text.

    Returns a row for each row of ``docs`` with the columns ``carry`` (unset: all but the text), ``license`` (of the
    longest matching region; of equal ones the better covered, the earlier, the first by name; null: none),
    ``coverage`` (of that region, 0 if none) and ``matches`` (regions by place: licence, coverage, first word and
    end). Words are lower case, between white space and ASCII punctuation. A null or empty text has no match;
    repeated rows and null ids pass as others; a column named as a result is is dropped; an empty table gives an
    empty one; long texts are scanned whole. One pass over the rows, no shuffle.
    """
    known = Templates(TEMPLATES if templates is None else templates)
    carry = carried_columns(docs, text_col, ["license", "coverage", "matches"]) if carry is None else carry
    slim = docs.select(F.col(text_col).cast("string").alias("__text"), *[F.col(f"`{c}`") for c in carry])
    schema = fields_of(docs, carry, "license string, coverage double, matches array<struct<license:string,coverage:double,start:long,end:long>>")
    return slim.mapInArrow(lambda b: _scan(b, known, min_coverage, carry), schema)
