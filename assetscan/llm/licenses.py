"""Licence scan: normalised text against licence templates by the Dice coefficient of word bigrams.

Lines, paragraphs, whole texts and spans of words are compared as sets of word bigrams (lower case, punctuation dropped,
spelling variants joined). Sets of sizes a and b can only reach the coefficient t if their sizes differ by at
most a factor (2 - t) / t, so templates are sorted by size and only those within the bounds are compared; a segment
is looked at only if it has as many of one template's bigrams (by their hashes) as that template needs. Templates are a
fixed list, so each task holds them.

Spans find what crosses lines and paragraphs or lies inside one. A best span of a template begins and ends with
its bigrams, and lengthening it over a neighbouring one never lowers the coefficient, so per template with enough
bigrams in the document spans between the starts and ends of unbroken runs of its bigrams are compared: for each
start the best end (the first of equal ones), within the size bounds. Spans are taken by coefficient, then the longer
template, then name; one inside a match of at least its coefficient, or over such a match of its own template, adds nothing.

A document's licence is its best match; a match that is part of a longer template's match (a header inside the
complete text, two BSD conditions inside three) is listed but does not name the document.

Defined results. Null or empty text: no match. Fewer than two words: no bigrams, no match. Ties: the higher
coefficient, then the template's name. Repeated rows: equal results. Null doc_id is carried. Empty table: no rows.
"""
from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C
from .license_texts import TEXTS

THRESHOLD = 0.8
SCHEMA = ("doc_id long, license string, dice double, n_matches long, "
          "matches array<struct<license:string,unit:string,start_word:int,n_words:int,dice:double>>")
# Public notices and texts of common licences. A header next to its complete text ends in nothing, the text in "-text";
# "-notice" and "-conditions" are parts that also stand alone.
TEMPLATES: dict[str, str] = {
    "MIT-notice": "Released under the MIT License.",
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0-notice": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC0-1.0-notice": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    "MIT": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    "GPL-3.0": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details. You should have received a copy of the GNU General Public License along with this program. If not, see https://www.gnu.org/licenses/.",
    "BSD-2-Clause-conditions": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "BSD-3-Clause-conditions": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    "Unlicense-notice": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    "Zlib-notice": "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely.",
    **TEXTS,
}
# Spellings that count as one.
VARIANTS = {"licence": "license", "licences": "licenses", "licenced": "licensed", "sublicence": "sublicense", "noncommercial": "non commercial", "programme": "program"}
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def normalise(text: str) -> list[str]:
    return [p for w in _WORD.findall(text.translate(_UPPER)) for p in VARIANTS.get(w, w).split()]


def bigrams(words: list[str]) -> frozenset[tuple[str, str]]:
    return frozenset(zip(words, words[1:]))


class Scanner:
    """Templates by size, with the lookup that says which segments are worth a closer look."""

    def __init__(self, templates: dict[str, str], threshold: float):
        self.threshold = threshold
        self.templates = sorted((len(b), name, b) for name, b in ((n, bigrams(normalise(t))) for n, t in templates.items()) if b)
        self.sizes = np.array([n for n, _, _ in self.templates])
        self.size_of = {name: n for n, name, _ in self.templates}
        self.factor = (2 - threshold) / threshold
        self.need = np.maximum(1, np.ceil(self.sizes / self.factor - 1e-9)).astype(np.int64)
        self.variants = [(self._hashes([raw])[0], self._hashes(norm.split())) for raw, norm in VARIANTS.items()]
        # template bigrams by hash: rows `first[i]:first[i + 1]` of `owner` are the templates that have `grams[i]`
        made = [(C.ngrams(h := self._hashes([w for p in sorted(b) for w in p]), np.arange(len(h)) // 2, 2)[0], t) for t, (_, _, b) in enumerate(self.templates)]
        pairs = np.concatenate([h for h, _ in made]) if made else np.zeros(0, np.uint64)
        owner = np.concatenate([np.full(len(h), t) for h, t in made]) if made else np.zeros(0, np.int64)
        order = np.argsort(pairs, kind="stable")
        self.grams, first = np.unique(pairs[order], return_index=True)
        self.owner, self.first = owner[order], np.append(first, len(pairs))
        self.slots = np.zeros(1 << 20, bool)
        self.slots[(self.grams & np.uint64((1 << 20) - 1)).astype(np.int64)] = True

    @staticmethod
    def _hashes(words: list[str]) -> np.ndarray:
        data = np.frombuffer(" ".join(words).encode(), np.uint8)
        starts, ends, _ = C.find_words(data, np.array([0, len(data)]), C.ALPHANUMERIC)
        return C.word_hashes(data, starts, ends)

    def best(self, words: list[str]) -> tuple[float, str] | None:
        """The template with the highest coefficient of at least the threshold, within the size bounds."""
        have = bigrams(words)
        if not have:
            return None
        lo = np.searchsorted(self.sizes, len(have) / self.factor - 1e-9, "left")
        hi = np.searchsorted(self.sizes, len(have) * self.factor + 1e-9, "right")
        top = None
        for size, name, b in self.templates[lo:hi]:
            dice = 2 * len(have & b) / (size + len(have))
            if dice >= self.threshold - 1e-12 and (top is None or dice > top[0] or dice == top[0] and name < top[1]):
                top = (dice, name)
        return top

    def _joined(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number of the word it stands for, hash) of each word with spelling variants joined."""
        times = np.ones(len(hashes), np.int64)
        found = [(hashes == raw, norm) for raw, norm in self.variants]
        for same, norm in found:
            times[same] = len(norm)
        origin = np.repeat(np.arange(len(hashes)), times)
        out = hashes[origin]
        begin = np.cumsum(times) - times
        for same, norm in found:
            for j, h in enumerate(norm):
                out[begin[same] + j] = h
        return origin, out

    def _spans(self, grams: np.ndarray, hits: np.ndarray, t: int):
        """(coefficient, first bigram, last bigram) of the best span from each run's start that reaches the threshold.
        `hits` are the positions of the template's bigrams among the text's bigrams."""
        size, need = self.templates[t][0], int(self.need[t])
        distinct = len(np.unique(grams[hits]))
        if distinct < need:
            return
        lo, hi = int(hits[0]), int(hits[-1]) + 1
        grams, hits = grams[lo:hi], hits - lo
        order = np.argsort(grams, kind="stable")
        before = np.full(len(grams), -1)                       # where the same bigram was last
        same = grams[order[1:]] == grams[order[:-1]]
        before[order[1:][same]] = order[:-1][same]
        is_hit = np.zeros(len(grams) + 1, bool)
        is_hit[hits] = True
        tail = is_hit[:-1] & ~is_hit[1:]
        limit = int(size * self.factor + 1e-9)
        for x in hits[np.diff(hits, prepend=-2) > 1]:
            width = 2 * limit
            while True:                                        # the window grows while repeated bigrams keep it small
                fresh = before[x:x + width] < x
                have, both = np.cumsum(fresh), np.cumsum(fresh & is_hit[x:x + width][:len(fresh)])
                if have[-1] > limit or x + width >= len(grams) or both[-1] == distinct:
                    break
                width *= 2
            ends = np.flatnonzero(tail[x:x + width][:np.searchsorted(have, limit, "right")])
            if not len(ends):
                continue
            dice = 2 * both[ends] / (have[ends] + size)
            best = int(np.argmax(dice))
            if dice[best] >= self.threshold - 1e-12:
                yield float(dice[best]), int(x + lo), int(x + ends[best] + lo)

    def name(self, matches: list[dict]) -> dict | None:
        """The best match that is no part of a longer template's match."""
        part = lambda m: any(o["start_word"] <= m["start_word"] and m["start_word"] + m["n_words"] <= o["start_word"] + o["n_words"]
                             and self.size_of[o["license"]] > self.size_of[m["license"]] for o in matches)
        return min((m for m in matches if not part(m)), key=lambda m: (-m["dice"], m["license"]), default=None)

    def scan(self, buf: np.ndarray, offs: np.ndarray) -> list[list[dict]]:
        """Matches of each text. Only segments with enough template words are decoded and compared."""
        n = len(offs) - 1
        out: list[list[dict]] = [[] for _ in range(n)]
        low = C.LOWER[buf]
        starts, ends, doc = C.find_words(low, offs, C.ALPHANUMERIC)
        if not len(starts):
            return out
        origin, hashes = self._joined(C.word_hashes(low, starts, ends))
        grams, at = C.ngrams(hashes, doc[origin], 2)
        hit = np.flatnonzero(self.slots[(grams & np.uint64((1 << 20) - 1)).astype(np.int64)])
        where = np.minimum(np.searchsorted(self.grams, grams[hit]), max(len(self.grams) - 1, 0))
        good = self.grams[where] == grams[hit] if len(hit) else np.zeros(0, bool)
        hit, where = hit[good], where[good]
        many = self.first[where + 1] - self.first[where]
        hit = np.repeat(hit, many)                             # one row per template that has the bigram
        template = self.owner[np.arange(len(hit)) - np.repeat(np.cumsum(many) - many, many) + np.repeat(self.first[where], many)]
        left, right = origin[at[hit]], origin[at[hit] + 1]     # its words
        lines = np.cumsum(low == 10)[starts]
        blank = low == 10
        blank[1:] &= low[:-1] == 10
        blank[:1] = False
        paragraphs = np.cumsum(blank)[starts]
        first_word = np.searchsorted(doc, np.arange(n))
        done = set()
        for unit, mark in (("line", lines), ("paragraph", paragraphs), ("text", np.zeros(len(doc), np.int64))):
            new = np.concatenate(([True], (mark[1:] != mark[:-1]) | (doc[1:] != doc[:-1])))
            a = np.flatnonzero(new)
            z = np.concatenate((a[1:], [len(doc)]))
            segment = np.searchsorted(a, left, "right") - 1
            inside = right < z[segment]
            key, shared = np.unique(segment[inside] * len(self.templates) + template[inside], return_counts=True)
            for i in np.unique(key[shared >= self.need[key % len(self.templates)]] // len(self.templates)) if len(key) else ():
                x, y = int(a[i]), int(z[i])
                if (x, y) in done:
                    continue
                done.add((x, y))
                found = self.best(normalise(bytes(buf[starts[x]:ends[y - 1]]).decode()))
                if found:
                    d = int(doc[x])
                    out[d].append({"license": found[1], "unit": unit, "start_word": x - int(first_word[d]), "n_words": y - x, "dice": found[0]})
        # spans: the documents with enough distinct bigrams of a template
        key = doc[left] * len(self.templates) + template if len(left) else np.zeros(0, np.int64)
        order = np.argsort(key, kind="stable")
        keys, first = np.unique(key[order], return_index=True)
        cuts = np.append(first, len(key))
        edge = np.searchsorted(doc[origin[at]], np.arange(n + 1))
        spans: dict[int, list[tuple]] = {}
        for i in np.flatnonzero(np.diff(cuts) >= self.need[keys % len(self.templates)]) if len(keys) else ():
            d, t = divmod(int(keys[i]), len(self.templates))
            a, z = int(edge[d]), int(edge[d + 1])
            for dice, x, y in self._spans(grams[a:z], hit[order[cuts[i]:cuts[i + 1]]] - a, t):
                x, y = int(origin[at[a + x]] - first_word[d]), int(origin[at[a + y] + 1] - first_word[d])
                spans.setdefault(d, []).append((-dice, -self.templates[t][0], self.templates[t][1], x, y - x + 1))
        for d, found in spans.items():
            kept = [(m["dice"], m["license"], m["start_word"], m["start_word"] + m["n_words"]) for m in out[d]]
            for dice, _, name, x, words in sorted(found):
                if any(k >= -dice - 1e-12 and (u <= x and x + words <= v or name == other and x < v and u < x + words) for k, other, u, v in kept):
                    continue
                kept.append((-dice, name, x, x + words))
                out[d].append({"license": name, "unit": "span", "start_word": x, "n_words": words, "dice": -dice})
        return out


def scan_licenses(docs: DataFrame, templates: dict[str, str] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """Per document: its best licence, coefficient, and every matching line, paragraph, whole text or span."""
    struct = pa.struct([("license", pa.string()), ("unit", pa.string()), ("start_word", pa.int32()), ("n_words", pa.int32()), ("dice", pa.float64())])

    def run(batches):
        scanner = Scanner(templates, threshold)
        for rows, buf, offs in C.text_chunks(batches):
            found = scanner.scan(buf, offs)
            for m in found:
                m.sort(key=lambda x: (x["start_word"], x["n_words"]))
            best = [scanner.name(m) for m in found]
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), pa.array([b and b["license"] for b in best], pa.string()), pa.array([b["dice"] if b else 0.0 for b in best], pa.float64()),
                 pa.array([len(m) for m in found], pa.int64()), pa.array(found, pa.list_(struct))],
                names=["doc_id", "license", "dice", "n_matches", "matches"])

    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return d.mapInArrow(run, SCHEMA)
