"""License scan by patience alignment.

A text is aligned with a template by anchors: words that occur once in both.
The longest increasing run of anchors is kept (patience sorting) and the gaps
between anchors, where other words may now be unique, are aligned the same
way; equal words at the two ends of a gap are matched first. Coverage is the
share of the template's words that are matched.

So that a notice that occurs twice, or words scattered over a long text, do
not hide it, a text is aligned in regions: stretches of ``SPREAD`` template
lengths in which the template has enough words at all (fewer can't reach the
coverage). Regions are found over the whole text; of overlapping ones the best
is kept, and its matched words must make up ``DENSITY`` of the stretch they
span. A license's name and version (``TELLING``) must be among them, and where
regions of several templates overlap the one with the most matched words is
reported, so one license is not named as its neighbour.

Result: one row per document and template found, (id, template, coverage,
first_word, last_word of the best region, n_found). Words are compared in
lower case without outer punctuation. Null and empty texts and templates find
nothing; null ids are reported with a null id; repeated rows give their rows
once each; other columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emporium.llm.common import importable, word_hashes, WordHashes

COVERAGE, DENSITY, SPREAD = 0.8, 0.6, 1.5

_AS_IS_BSD = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT "
    "LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT "
    "HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT "
    "LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY "
    "THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF "
    "THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")
_BSD_2 = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions "
    "are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
    "documentation and/or other materials provided with the distribution.")
_BSD_3 = (
    " 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this "
    "software without specific prior written permission.")
_MIT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
    "(the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, "
    "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
    "subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or "
    "substantial portions of the Software.")
_GNU = (
    "{0} is free software: you can redistribute it and/or modify it under the terms of the GNU {1}General Public License as published "
    "by the Free Software Foundation, either version {2} of the License, or (at your option) any later version. {0} is distributed in "
    "the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A "
    "PARTICULAR PURPOSE. See the GNU {1}General Public License for more details.")
_CC = "This work is licensed under a Creative Commons {} 4.0 International License."

#: License texts, the notices that licenses ask for, and common one-line notices.
TEMPLATES = {
    "MIT-notice": "Released under the MIT License.",
    "MIT": _MIT,
    "MIT-whole": _MIT + (
        " THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF "
        "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR "
        "ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH "
        "THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that "
        "the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS "
        "ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR "
        "BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR "
        "PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR "
        "PERFORMANCE OF THIS SOFTWARE."),
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. "
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in "
        "writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, "
        "either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    "GPL-2.0-notice": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-2.0": _GNU.format("This program", "", "2"),
    "GPL-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0": _GNU.format("This program", "", "3"),
    "LGPL-2.1-notice": "This work is licensed under the GNU Lesser General Public License, version 2.1.",
    "LGPL-2.1": _GNU.format("This library", "Lesser ", "2.1"),
    "LGPL-3.0-notice": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "LGPL-3.0": _GNU.format("This library", "Lesser ", "3"),
    "AGPL-3.0-notice": "This work is licensed under the GNU Affero General Public License, version 3.",
    "AGPL-3.0": _GNU.format("This program", "Affero ", "3"),
    "MPL-2.0-notice": "Licensed under the Mozilla Public License, Version 2.0.",
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this "
        "file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    "CC-BY-NC-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0-short": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0-short": "Licensed under CC BY-SA 4.0.",
    "CC-BY-ND-4.0-short": "Licensed under CC BY-ND 4.0.",
    "CC-BY-NC-SA-4.0-short": "Licensed under CC BY-NC-SA 4.0.",
    "CC-BY-NC-ND-4.0-short": "Licensed under CC BY-NC-ND 4.0.",
    "CC-BY-4.0-notice": _CC.format("Attribution"),
    "CC-BY-SA-4.0-notice": _CC.format("Attribution-ShareAlike"),
    "CC-BY-ND-4.0-notice": _CC.format("Attribution-NoDerivatives"),
    "CC-BY-NC-4.0-long": _CC.format("Attribution-NonCommercial"),
    "CC-BY-NC-SA-4.0-notice": _CC.format("Attribution-NonCommercial-ShareAlike"),
    "CC-BY-NC-ND-4.0-notice": _CC.format("Attribution-NonCommercial-NoDerivatives"),
    "CC0-1.0-notice": (
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or "
        "distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."),
    "BSD-notice": "Released under the BSD License.",
    "BSD-2-Clause": _BSD_2,
    "BSD-2-Clause-whole": f"{_BSD_2} {_AS_IS_BSD}",
    "BSD-3-Clause": _BSD_2 + _BSD_3,
    "BSD-3-Clause-whole": f"{_BSD_2}{_BSD_3} {_AS_IS_BSD}",
    "All-rights-reserved": "All rights reserved.",
} | {f"SPDX-{name}": f"SPDX-License-Identifier: {name}" for name in (
    "MIT ISC Apache-2.0 GPL-2.0-only GPL-2.0-or-later GPL-3.0-only GPL-3.0-or-later LGPL-2.1-only LGPL-2.1-or-later LGPL-3.0-only LGPL-3.0-or-later "
    "AGPL-3.0-only AGPL-3.0-or-later MPL-2.0 BSD-2-Clause BSD-3-Clause CC0-1.0 CC-BY-4.0 CC-BY-SA-4.0 Unlicense").split()}

#: Words of a license's name or version, without which a text is none of its kind. A template must match all of its own.
TELLING = ("2", "2.0", "2.1", "3", "4.0", "affero", "apache", "attribution", "attribution-noderivatives", "attribution-noncommercial",
           "attribution-noncommercial-noderivatives", "attribution-noncommercial-sharealike", "attribution-sharealike", "bsd", "by", "by-nc", "by-nc-nd",
           "by-nc-sa", "by-nd", "by-sa", "cc", "gnu", "lesser", "mit", "mozilla", "mpl", "reserved")


def increasing(values: Sequence[int]) -> list[int]:
    """Places of a longest increasing run of distinct values (patience sorting)."""
    tops: list[int] = []
    piles: list[int] = []
    before: list[int] = []
    for i, v in enumerate(values):
        pile = bisect_left(tops, v)
        before.append(piles[pile - 1] if pile else -1)
        tops[pile:pile + 1] = [v]
        piles[pile:pile + 1] = [i]
    out, i = [], piles[-1] if piles else -1
    while i >= 0:
        out.append(i)
        i = before[i]
    return out[::-1]


def align(a: Sequence[int], b: Sequence[int]) -> list[tuple[int, int]]:
    """Matched places (in a, in b), increasing in both."""
    out: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        i, n, j, m = todo.pop()
        while i < n and j < m and a[i] == b[j]:
            out.append((i, j))
            i, j = i + 1, j + 1
        while i < n and j < m and a[n - 1] == b[m - 1]:
            n, m = n - 1, m - 1
            out.append((n, m))
        if i == n or j == m:
            continue
        once: dict[int, int] = {}
        for k in range(j, m):
            once[b[k]] = k if b[k] not in once else -1
        seen: dict[int, int] = {}
        for k in range(i, n):
            if a[k] in once:
                seen[a[k]] = k if a[k] not in seen else -1
        both = sorted((k, once[w]) for w, k in seen.items() if k >= 0 and once[w] >= 0)
        anchors = [both[k] for k in increasing([y for _, y in both])]
        out += anchors
        if anchors:
            edges = [(i - 1, j - 1), *anchors, (n, m)]
            todo += [(p + 1, q, r + 1, s) for (p, r), (q, s) in zip(edges, edges[1:])]
    return sorted(out)


Region = tuple[float, int, int, int]  # coverage, first word, last word, words matched


class Scanner:
    """Templates, ready to be looked for. A region must match the first use of
    each word of ``telling`` that its template has."""

    def __init__(self, templates: dict[str, str], coverage: float = COVERAGE, density: float = DENSITY, telling: tuple[str, ...] = ()):
        self.coverage, self.density = coverage, density
        cache = WordHashes()
        words = {name: word_hashes(t, cache) for name, t in templates.items()}
        self.templates = {k: w.tolist() for k, w in words.items() if len(w)}
        self.vocabulary = np.unique(np.concatenate([words[k] for k in self.templates])) if self.templates else np.zeros(0, np.uint64)
        self.times = {k: np.bincount(np.searchsorted(self.vocabulary, words[k]), minlength=len(self.vocabulary)) for k in self.templates}
        tell = {cache[t] for t in telling}
        self.must = {k: {b.index(w) for w in tell.intersection(b)} for k, b in self.templates.items()}
        self.names = {k: np.unique(np.searchsorted(self.vocabulary, np.array([b[i] for i in self.must[k]], np.uint64))) for k, b in self.templates.items()}

    def regions(self, words: np.ndarray) -> dict[str, list[Region]]:
        """Regions of each template in a whole text, the best of overlapping ones."""
        if not len(words) or not len(self.vocabulary):
            return {}
        code = np.minimum(np.searchsorted(self.vocabulary, words), len(self.vocabulary) - 1)
        at = np.flatnonzero(self.vocabulary[code] == words)
        code, out = code[at], {}
        total = np.bincount(code, minlength=len(self.vocabulary))
        for name, b in self.templates.items():
            need = int(np.ceil(self.coverage * len(b) - 1e-9))
            times = self.times[name]
            if len(at) < need or np.minimum(total, times).sum() < need or not total[self.names[name]].all():
                continue
            own = times[code] > 0
            pos, used = at[own], code[own]
            reach = max(len(b) + 2, int(SPREAD * len(b)))
            # a word counts in the windows that hold it and fewer than its uses in the template before it
            order = np.argsort(used, kind="stable")
            back = np.arange(len(order)) - times[used[order]]
            same = (back >= 0) & (used[order[back]] == used[order])
            since = np.sort(np.maximum(np.where(same, pos[order[back]] + 1, 0), pos[order] - reach + 1))
            # where a window's first or last words change: all others align as one of these does
            starts = np.unique(np.concatenate([pos, pos - 1, pos - reach, pos - reach + 1]).clip(0))
            inside = np.searchsorted(since, starts, "right") - np.searchsorted(pos, starts)
            found: list[Region] = []
            tried = -1
            for first in starts[inside >= need].tolist():
                if first <= tried:
                    continue
                region = words[first:first + reach].tolist()
                hits = align(region, b)
                cover = len(hits) / len(b)
                if cover >= self.coverage - 1e-9 and self.must[name] <= {j for _, j in hits}:
                    lo, hi = hits[0][0], hits[-1][0]
                    if len(hits) >= self.density * (hi - lo + 1):
                        found.append((cover, first + lo, first + hi, len(hits)))
                        if cover == 1:
                            tried = first + hi
            if found:
                kept: list[Region] = []
                end = -1
                for f in sorted(found, key=lambda f: (f[1], -f[0])):  # the best of overlapping ones
                    if f[1] > end:
                        kept.append(f)
                    elif f[0] > kept[-1][0]:
                        kept[-1] = f
                    end = max(end, f[2])
                out[name] = kept
        return out

    @staticmethod
    def _rows(regions: dict[str, list[Region]]) -> list[tuple[str, float, int, int, int]]:
        return [(name, *max(kept, key=lambda f: (f[0], -f[1]))[:3], len(kept)) for name, kept in regions.items()]

    def find(self, words: np.ndarray) -> list[tuple[str, float, int, int, int]]:
        """(template, coverage, first word, last word, regions found) of a whole
        text, each template by itself."""
        return self._rows(self.regions(words))

    def best(self, words: np.ndarray) -> list[tuple[str, float, int, int, int]]:
        """As ``find``; of regions of several templates that overlap, the one
        with the most words matched is reported (ties: the better covered, the
        earlier in the list of templates)."""
        order = {name: i for i, name in enumerate(self.templates)}
        every = sorted(((-f[3], -f[0], order[name], f[1], f[2], name, f) for name, kept in self.regions(words).items() for f in kept))
        taken: list[tuple[int, int]] = []   # disjoint stretches, in order
        out: dict[str, list[Region]] = {}
        for *_, first, last, name, f in every:
            k = bisect_left(taken, (first, -1))
            if (k == len(taken) or taken[k][0] > last) and (k == 0 or taken[k - 1][1] < first):
                taken.insert(k, (first, last))
                out.setdefault(name, []).append(f)
        return self._rows({name: sorted(out[name], key=lambda f: f[1]) for name in sorted(out, key=order.get)})


_cache = WordHashes()


def scan(df: DataFrame, templates: dict[str, str] | None = None, id_col: str = "doc_id", text_col: str = "text", coverage: float = COVERAGE,
         density: float = DENSITY, telling: tuple[str, ...] = TELLING) -> DataFrame:
    """(id, template, coverage, first_word, last_word, n_found); see the module."""
    scanner = Scanner(TEMPLATES if templates is None else templates, coverage, density, telling)  # a few templates, sent with the task
    importable(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [(i, *f) for i, t in enumerate(b.column(1).to_pylist()) for f in scanner.best(word_hashes(t, _cache))]
            if rows:
                at, name, cover, first, last, n = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(pa.array(at)), pa.array(name), pa.array(cover, pa.float64()), pa.array(first, pa.int64()),
                     pa.array(last, pa.int64()), pa.array(n, pa.int64())], names=["id", "template", "coverage", "first_word", "last_word", "n_found"])

    return (df.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
            .mapInArrow(run, "id long, template string, coverage double, first_word long, last_word long, n_found long")
            .withColumnsRenamed({"id": id_col}))
