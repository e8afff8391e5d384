"""Licence texts in documents: Dice coefficient over word bigrams.

Lines, paragraphs and whole texts are compared with licence templates after normalising both (lower case, words of
letters and digits), and so is every run of neighbouring words, whatever lines, sentences or paragraphs it covers. Dice is twice the shared different bigrams over the sum of both counts, so a text can reach ``threshold`` t
only if its count lies between t/(2-t) and (2-t)/t times the template's. The bounds prune by word counts first, before any
bigram is made; then only templates that share a bigram are counted (an inverted index of the templates, which are few).

Runs begin and end at a bigram of the template, as any other end only lowers Dice, and end before their first bigram comes
again, as the run from there on has the same bigrams. A template needs t/(2-t) of its bigrams in the text to be looked for at
all. Of runs that overlap, the one with the most shared bigrams less those of one side only is taken. A run is reported
unless a line, paragraph or text that touches it is reported with the same licence; its position is that of its first character.

Defined cases: null and empty texts match nothing; a text of one word has no bigrams and matches nothing; ties between
templates go to the first by name; repeated rows are each reported; an empty table gives no rows; other columns are left out.
"""

from __future__ import annotations

import heapq
import re
from bisect import bisect_right, insort
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

THRESHOLD = 0.8

# The texts of short public licences and the usual notices of long ones.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
        "required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
        "\"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the "
        "specific language governing permissions and limitations under the License."),
    "BSD-2-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list "
        "of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright "
        "notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided "
        "with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY "
        "EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND "
        "FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE "
        "FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, "
        "PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER "
        "CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR "
        "OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."),
    "AGPL-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) "
        "any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; "
        "without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Affero "
        "General Public License for more details."),
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "GPL-2.0-header": (
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any "
        "later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without "
        "even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public "
        "License for more details."),
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
        "later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without "
        "even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public "
        "License for more details."),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE "
        "IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED "
        "WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
        "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER "
        "IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR "
        "PERFORMANCE OF THIS SOFTWARE."),
    "LGPL-3.0-header": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General "
        "Public License as published by the Free Software Foundation; either version 3 of the License, or (at your option) "
        "any later version. This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; "
        "without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser "
        "General Public License for more details."),
    "MIT": "Released under the MIT License.",
    "MIT-text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
        "permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright "
        "notice and this permission notice shall be included in all copies or substantial portions of the Software. THE "
        "SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE "
        "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS "
        "OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
        "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    "MPL-2.0-header": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, "
        "use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any "
        "purpose, commercial or non-commercial, and by any means."),
    "Zlib": (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held "
        "liable for any damages arising from the use of this software. Permission is granted to anyone to use this software "
        "for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the "
        "following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you "
        "wrote the original software. If you use this software in a product, an acknowledgment in the product documentation "
        "would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not "
        "be misrepresented as being the original software. 3. This notice may not be removed or altered from any source "
        "distribution."),
}
# the clause that the two-clause form lacks stands before its disclaimer
TEMPLATES["BSD-3-Clause"] = TEMPLATES["BSD-2-Clause"].replace(
    "THIS SOFTWARE IS PROVIDED BY", "3. Neither the name of the copyright holder nor the names of its contributors may be used "
    "to endorse or promote products derived from this software without specific prior written permission. THIS SOFTWARE IS "
    "PROVIDED BY")

WORD = re.compile(r"[^\W_]+")
GAP = re.compile(r"\n[ \t]*\n")


def bigrams(text: str) -> set[tuple[str, str]]:
    words = WORD.findall(text.lower())
    return set(zip(words, words[1:]))


class Templates:
    """The templates by bigram, and the sizes that can reach the threshold."""

    def __init__(self, texts: dict[str, str], threshold: float):
        self.threshold = threshold
        self.sets = {name: bigrams(text) for name, text in sorted(texts.items())}
        self.sets = {name: grams for name, grams in self.sets.items() if grams}
        self.of: dict[tuple[str, str], list[str]] = {}
        for name, grams in self.sets.items():
            for gram in grams:
                self.of.setdefault(gram, []).append(name)
        self.bounds = {name: self.sizes(len(grams)) for name, grams in self.sets.items()}
        self.least = min((low for low, _ in self.bounds.values()), default=1.0)
        self.words = {w for gram in self.of for w in gram}

    def sizes(self, n: int) -> tuple[float, float]:
        t = self.threshold
        return n * t / (2 - t) - 1e-9, n * (2 - t) / t + 1e-9

    def best(self, text: str) -> tuple[str, float] | None:
        words = WORD.findall(text.lower())
        if len(words) - 1 < self.least or self.words.isdisjoint(words):
            return None  # different bigrams are at most the words less one
        return self.best_of(set(zip(words, words[1:])))

    def best_of(self, grams: set[tuple[str, str]]) -> tuple[str, float] | None:
        open_ = {name for name, (low, high) in self.bounds.items() if low <= len(grams) <= high}
        if not open_:
            return None
        shared = Counter(name for gram in grams for name in self.of.get(gram, ()) if name in open_)
        scored = [(2 * n / (len(grams) + len(self.sets[name])), name) for name, n in shared.items()]
        dice, name = max(scored, key=lambda s: (s[0], [-ord(c) for c in s[1]]), default=(0.0, ""))
        return (name, dice) if dice >= self.threshold else None

    def run_from(self, name: str, grams: list[tuple[str, str]], first: int, stop: int) -> tuple[int, float, int] | None:
        """(surplus, dice, last) of the best run for a template that begins with bigram ``first`` and ends before ``stop``."""
        own, (_, high) = self.sets[name], self.bounds[name]
        seen: set[tuple[str, str]] = set()
        shared, best = 0, None
        for at in range(first, stop):
            gram = grams[at]
            if gram in seen:
                if gram == grams[first]:
                    break
                continue
            seen.add(gram)
            if len(seen) > high:
                break
            if gram in own:
                shared += 1
                dice = 2 * shared / (len(seen) + len(own))
                if dice >= self.threshold and (best is None or dice > best[1]):
                    best = (3 * shared - len(seen) - len(own), dice, at)
        return best

    def runs(self, text: str) -> list[tuple[int, int, str, float]]:
        """(start, end, template, dice) of the runs that are taken, by place; start and end count characters."""
        words = WORD.findall(text.lower())
        grams = list(zip(words, words[1:]))
        hits: dict[str, list[int]] = {}
        for at, gram in enumerate(grams):
            if gram in self.of:
                for name in self.of[gram]:
                    hits.setdefault(name, []).append(at)
        heap = []
        for name, places in hits.items():
            low = self.bounds[name][0]  # shared bigrams are at least as many as the smallest fitting run has
            if len(places) >= low and len({grams[at] for at in places}) >= low:
                for first in places:
                    if best := self.run_from(name, grams, first, len(grams)):
                        heap.append((-best[0], -best[1], name, first, best[2]))
        heapq.heapify(heap)
        taken: list[tuple[int, int]] = []  # bigrams from, to
        while heap:
            _, _, name, first, last = heapq.heappop(heap)
            n = bisect_right(taken, (first, len(grams)))
            # a run of words holds one word more than bigrams
            if n and taken[n - 1][1] + 1 >= first:
                continue
            if n < len(taken) and taken[n][0] <= last + 1:
                if best := self.run_from(name, grams, first, taken[n][0] - 1):
                    heapq.heappush(heap, (-best[0], -best[1], name, first, best[2]))
                continue
            insort(taken, (first, last))
        if not taken:
            return []
        spans = [m.span() for m in WORD.finditer(text)]
        if len(spans) != len(words):  # lower case of a letter may be a letter and a mark
            spans = _spans_in_lower(text)
        found = []
        for first, last in taken:
            start, end = spans[first][0], spans[last + 1][1]
            if best := self.best(text[start:end]):
                found.append((start, end, *best))
        return found


def _spans_in_lower(text: str) -> list[tuple[int, int]]:
    """Places in ``text`` of the words of its lower case, where that has another length."""
    back = [n for n, c in enumerate(text) for _ in c.lower()]
    return [(back[m.start()], back[m.end() - 1] + 1) for m in WORD.finditer("".join(c.lower() for c in text))]


@lru_cache(maxsize=4)
def _built_in(threshold: float) -> Templates:
    return Templates(TEMPLATES, threshold)


def _pieces(text: str) -> Iterator[tuple[str, int, int, int]]:
    """(kind, position, start, end): lines, then paragraphs of several lines, then a whole text of several paragraphs."""
    start = 0
    for n, line in enumerate(text.split("\n")):
        yield "line", n, start, start + len(line)
        start += len(line) + 1
    start, n = 0, 0
    for gap in [*GAP.finditer(text), None]:
        end = gap.start() if gap else len(text)
        if "\n" in text[start:end].strip("\n"):
            yield "paragraph", n, start, end
        if gap:
            start, n = gap.end(), n + 1
    if n:
        yield "text", 0, 0, len(text)


def scan(text: str, known: Templates) -> list[tuple[str, int, int, int, str, float]]:
    """(kind, position, start, end, template, dice) of all units that reach the threshold."""
    found = []
    for kind, n, start, end in _pieces(text):
        if best := known.best(text[start:end]):
            found.append((kind, n, start, end, *best))
    whole: dict[str, list[tuple[int, int]]] = {}
    for _, _, start, end, name, _ in found:
        whole.setdefault(name, []).append((start, end))
    covered = {name: _joined(reach) for name, reach in whole.items()}
    for start, end, name, dice in known.runs(text):
        reach = covered.get(name, [])
        n = bisect_right(reach, (end, 0))
        if not (n and reach[n - 1][1] > start):
            found.append(("run", start, start, end, name, dice))
    return found


def _joined(reach: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping places as one."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(reach):
        if out and start < out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((start, end))
    return out


def units(text: str, known: Templates | None = None) -> Iterator[tuple[str, int, str]]:
    """(kind, position, text): lines, paragraphs of several lines, a whole text of several paragraphs, and the runs found."""
    for kind, n, start, end in _pieces(text):
        yield kind, n, text[start:end]
    for kind, n, start, end, _, _ in scan(text, known or _built_in(THRESHOLD)):
        if kind == "run":
            yield kind, n, text[start:end]


def find_licenses(docs: DataFrame, threshold: float = THRESHOLD, templates: dict[str, str] | None = None) -> DataFrame:
    """doc_id, unit, position, license and dice: the best template of every unit (line, paragraph, text or run) that reaches the threshold."""
    kind = dict(docs.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _built_in(threshold) if templates is None else Templates(templates, threshold)
        for batch in batches:
            rows, found = [], []
            for row, text in enumerate(batch.column(1).to_pylist()):
                for unit, position, _, _, *best in scan(text or "", known):
                    rows.append(row)
                    found.append((unit, position, *best))
            columns = list(zip(*found)) or [(), (), (), ()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows, pa.int64()))] + [
                    pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.string(), pa.float64()))],
                names=["doc_id", "unit", "position", "license", "dice"])

    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, unit string, position long, license string, dice double")
