"""Licence scans: lines and passages compared to licence wordings by the Dice coefficient over word bigrams.

Text is normalised to lower-case letters, digits and dots. A wording of n distinct bigrams can only reach a coefficient of d with
``n d / (2 - d)`` to ``n (2 - d) / d`` bigrams, so a line meets only the notices whose size bounds hold its own size.

All wordings (notices, titles, identifiers, headers and the whole licence texts of ``licence_texts``) are also looked for inside
lines and across them: a wording is tried where the text has the least number of its bigrams that a match needs, over
all windows of words that begin and end with one of them and have at most ``(2 - d) / d`` times its words. From each place the
best window counts. The wording that the text has most bigrams of goes first, and of one wording the best window; a passage that lies by
half or more in matched lines and passages taken before is the same place.

The wordings are few and fixed; they travel with the tasks as numbers, and no row meets another one. Work is a pass over a text's
words; windows are only formed where a wording has enough of its bigrams.

Defined results: null and empty texts have no match; a line with less than two words matches nothing; of equally good
wordings the first by name counts; repeated lines and passages count each, and repeated rows alike; very long texts are read
whole; other columns are not read, whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache
from importlib.resources import files

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenspan.llm._common import whole

DICE = 0.7

#: Short licence notices in their usual wording, by SPDX identifier.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "BSD-2-Clause": "Released under the BSD 2-Clause License.",
    "BSD-3-Clause": "Use of this source code is governed by a BSD-style license.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related rights to this work.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
}

_WARRANTY_BSD = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT
LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR
CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF
SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT,
STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_CLAUSES_BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form
must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. """
_THIRD_BSD = """Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software
without specific prior written permission. """
_GPL = """This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free
Software Foundation; either version {0} of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but
WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."""

#: Licence texts, file headers, titles and identifiers that may lie inside a line or run over several; (SPDX identifier, wording).
PASSAGES = [
    ("Apache-2.0", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy
     of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is
     distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing
     permissions and limitations under the License."""),
    ("BSD-2-Clause", _CLAUSES_BSD + _WARRANTY_BSD),
    ("BSD-3-Clause", _CLAUSES_BSD + _THIRD_BSD + _WARRANTY_BSD),
    ("GPL-2.0", _GPL.format(2)),
    ("GPL-3.0", _GPL.format(3)),
    ("LGPL-3.0", _GPL.format(3).replace("General Public", "Lesser General Public")),
    ("MIT", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal
     in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the
     Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice
     shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING
     BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE
     FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR
     OTHER DEALINGS IN THE SOFTWARE."""),
    ("MIT", "The MIT License (MIT)"),
    ("MPL-2.0", """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can
     obtain one at https://mozilla.org/MPL/2.0/."""),
    ("Unlicense", """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this
     software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."""),
    *((name, f"SPDX-License-Identifier: {name}") for name in TEMPLATES),
]


_WORDS = re.compile(r"[a-z0-9.]+")


def words_of(text: str) -> list[str]:
    return [w for w in (x.strip(".") for x in _WORDS.findall(text.lower())) if w]


def bigrams(text: str) -> list[str]:
    """The distinct word bigrams of a wording; the same as of a line."""
    words = words_of(text)
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:])} or ({words[0]} if words else set()))


@cache
def licence_texts() -> list[tuple[str, str]]:
    """(SPDX identifier, whole text) of the licences that lie beside this module; read on the driver alone."""
    return sorted((f.name.removesuffix(".txt"), f.read_text(encoding="utf-8")) for f in files("lumenspan.llm").joinpath("licence_texts").iterdir() if f.name.endswith(".txt"))


def size_bounds(n: int | np.ndarray, dice: float = DICE) -> tuple[float, float] | tuple[np.ndarray, np.ndarray]:
    return n * dice / (2 - dice), n * (2 - dice) / dice


def scan_sql(dice: float = DICE, templates: dict[str, str] = TEMPLATES) -> str:
    """The scan in DuckDB's SQL, without pruning."""
    rows = ", ".join("('{}', [{}])".format(name, ", ".join(f"'{g}'" for g in bigrams(text))) for name, text in sorted(templates.items()))
    return rf"""
WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line FROM documents),
w AS (
  SELECT doc_id, row_number() OVER () AS line_id,
         list_filter(list_transform(string_split(regexp_replace(lower(line), '[^a-z0-9.]+', ' ', 'g'), ' '), lambda x: regexp_replace(x, '^\.+|\.+$', '', 'g')), lambda x: x <> '') AS words
  FROM l),
g AS (
  SELECT doc_id, line_id, CASE WHEN len(words) > 1 THEN list_distinct(list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1])) ELSE words END AS grams FROM w),
t(name, part) AS (VALUES {rows}),
d AS (SELECT doc_id, line_id, name, (2.0::DOUBLE * len(list_intersect(grams, part))) / (len(grams) + len(part)) AS dice FROM g, t),
m AS (SELECT doc_id, line_id, arg_min(name, (-dice, name)) AS name, max(dice) AS dice FROM d WHERE dice >= {dice!r} GROUP BY doc_id, line_id),
a AS (
  SELECT doc_id, array_to_string(list_sort(list_distinct(list(name))), ',') AS licenses, count(*) AS n_matches, arg_min(name, (-dice, name)) AS best_license, max(dice) AS best_dice
  FROM m GROUP BY doc_id)
SELECT doc_id, coalesce(licenses, '') AS licenses, coalesce(n_matches, 0)::BIGINT AS n_matches, best_license, best_dice
FROM documents LEFT JOIN a USING (doc_id)
"""


class Wordings:
    """Notices for lines, and all wordings for passages, as numbers of words and bigrams."""

    def __init__(self, notices: dict[str, str], passages: list[tuple[str, str]], dice: float = DICE):
        self.dice = dice
        self.names: list[str] = []
        self.words: dict[str, int] = {}
        parts: list[set[tuple[int, int]]] = []
        self.lengths: list[int] = []
        for name, text in [*sorted(notices.items()), *passages]:
            words = [self.words.setdefault(w, len(self.words)) for w in words_of(text)]
            self.names.append(name)
            self.lengths.append(len(words))
            parts.append(set(zip(words, words[1:])))
        self.n_notices = len(notices)
        self.sizes = np.array([len(p) for p in parts])
        self.low, self.high = size_bounds(self.sizes, dice)
        rows = sorted((a * len(self.words) + b, t) for t, part in enumerate(parts) for a, b in part)
        codes, self.holder = (np.array(x, np.int64) for x in zip(*rows))
        self.codes, start = np.unique(codes, return_index=True)
        self.start = np.append(start, len(codes))

    def _hits(self, ids: np.ndarray) -> np.ndarray:
        """The number among the wordings' bigrams of each bigram, or -1."""
        code = np.where((ids[:-1] >= 0) & (ids[1:] >= 0), ids[:-1] * len(self.words) + ids[1:], -1)
        at = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
        return np.where(self.codes[at] == code, at, -1)

    def _common(self, hits: np.ndarray) -> np.ndarray:
        """How many of the distinct bigrams each wording has."""
        own = np.unique(hits)
        holders = [self.holder[self.start[g] : self.start[g + 1]] for g in own]
        return np.bincount(np.concatenate(holders), minlength=len(self.sizes))

    def matches(self, text: str) -> list[tuple[float, str]]:
        """(coefficient, name) of all lines and passages."""
        lines = [words_of(line) for line in text.split("\n")]
        ends = np.cumsum([len(x) for x in lines])
        words = [w for x in lines for w in x]
        if len(words) < 2:
            return []
        get = self.words.get
        hits = self._hits(np.array([get(w, -1) for w in words], np.int64))
        places = np.flatnonzero(hits >= 0)
        if not len(places):
            return []
        taken, found = np.zeros(len(words), bool), []
        line = np.searchsorted(ends, places, "right")
        inside = places + 1 < ends[line]  # the bigram does not cross the line's end
        for i in np.unique(line[inside]) if self.n_notices else ():
            own = lines[i]
            common, size = self._common(hits[places[inside & (line == i)]])[: self.n_notices], len(set(zip(own, own[1:])))
            fits = (self.low[: self.n_notices] <= size) & (size <= self.high[: self.n_notices])
            score = np.where(fits, (2.0 * common) / (size + self.sizes[: self.n_notices]), 0.0)
            best = int(score.argmax())  # the first by name of equal ones
            if score[best] >= self.dice:
                found.append((float(score[best]), self.names[best]))
                taken[ends[i] - len(own) : ends[i]] = True
        return found + self._passages(words, hits, places, taken)

    def _passages(self, words: list[str], hits: np.ndarray, places: np.ndarray, taken: np.ndarray) -> list[tuple[float, str]]:
        enough = np.flatnonzero(self._common(hits[places]) >= self.low)
        if not len(enough):
            return []
        numbers: dict[tuple[str, str], int] = {}
        pair = np.array([numbers.setdefault(p, len(numbers)) for p in zip(words, words[1:])])
        order = np.argsort(pair, kind="stable")
        before = np.full(len(pair), -1)  # where the bigram occurred last
        again = pair[order][1:] == pair[order][:-1]
        before[order[1:][again]] = order[:-1][again]
        # the wording of which the text has most goes first, of one wording the best window
        by_wording = [sorted(self._windows(int(t), hits, places, before), key=lambda w: (-w[1], w[3])) for t in enough]
        by_wording = sorted((ws for ws in by_wording if ws), key=lambda ws: (-max(w[0] for w in ws), -ws[0][1], ws[0][2]))
        windows = [w for ws in by_wording for w in ws]
        found = []
        starts, stops = (np.array([w[3] + (w[4] if end else 0) for w in windows], np.int64) for end in (False, True))
        open_ = np.ones(len(windows), bool)
        while True:
            lies = np.append(0, np.cumsum(taken))
            open_ &= 2 * (lies[stops] - lies[starts]) < stops - starts
            if not open_.any():
                return found
            first = int(open_.argmax())
            found.append((windows[first][1], windows[first][2]))
            taken[starts[first] : stops[first]] = True

    def _windows(self, t: int, hits: np.ndarray, places: np.ndarray, before: np.ndarray) -> Iterator[tuple[int, float, str, int, int]]:
        """(common bigrams, coefficient, name, first word, words) of the best window from each place of a wording's bigrams."""
        held = np.zeros(len(self.codes), bool)
        held[np.repeat(np.arange(len(self.codes)), np.diff(self.start))[self.holder == t]] = True
        own = places[held[hits[places]]]
        mine = np.zeros(len(hits), bool)
        mine[own] = True
        most = int(self.lengths[t] * (2 - self.dice) / self.dice)
        # a match needs low bigrams within most words, so that most places need no closer look
        reach = np.searchsorted(own, own + most) - np.arange(len(own))
        for start in own[reach >= self.low[t]]:
            part = slice(start, start + most - 1)
            new = before[part] < start
            common, size = np.cumsum(new & mine[part]), np.cumsum(new)
            score = np.where(mine[part], (2.0 * common) / (size + self.sizes[t]), 0.0)
            best = int(score.argmax())
            if score[best] >= self.dice:
                yield int(common[best]), float(score[best]), self.names[t], int(start), best + 2


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", dice: float = DICE, templates: dict[str, str] = TEMPLATES) -> DataFrame:
    """One row per document: id, licenses (distinct names found, sorted), n_matches (lines and passages), best_license and best_dice."""
    wordings = Wordings(templates, [*sorted(templates.items()), *PASSAGES, *licence_texts()], dice)

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [wordings.matches(t) for t in batch.column("text").to_pylist()]
            best = [min(((-d, n) for d, n in x), default=(None, None)) for x in found]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    pa.array([",".join(sorted({n for _, n in x})) for x in found], pa.string()),
                    pa.array([len(x) for x in found], pa.int64()),
                    pa.array([n for _, n in best], pa.string()),
                    pa.array([None if d is None else -d for d, _ in best], pa.float64()),
                ],
                ["id", "licenses", "n_matches", "best_license", "best_dice"],
            )

    rows = docs.select(docs[id_col].alias("id"), whole(docs[text_col]).alias("text"))
    kind = docs.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(scanned, f"id {kind}, licenses string, n_matches long, best_license string, best_dice double").withColumnRenamed("id", id_col)
