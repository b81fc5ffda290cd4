"""Licence scans: Dice coefficient over word bigrams between normalised text and licence templates.

A text is read as its ASCII words in lower case, so that line breaks, case and punctuation do not matter. For a template
of n words the units of a text are its windows of n words, wherever they begin (the whole text where that is shorter): a
notice is found inside a longer line, and a licence text that is spread over many lines of a longer document.
Dice >= t needs at least |template| x t / (2 - t) bigrams in common. That prunes twice by size: a text of fewer words has no
such window, and only templates of which the whole text holds that many bigrams, and then windows that hold as many,
are compared as sets. Before that, texts without any of a few words that every match holds are left out unread.
The templates are a fixed, bounded list that goes with the tasks: the scan is one map-only stage without a shuffle.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import arrow_map

_WARRANTY = (
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. '
    "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
    "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. "
)
_BSD_END = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. '
    "IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; "
    "LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_BSD_NAMES = "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. "
_FREE = "This program is free software: you can redistribute it and/or modify it under the terms of the GNU {} as published by the Free Software Foundation, either version {} of the License, or (at your option) any later version."
_ISC = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"
_CC = "This work is licensed under a Creative Commons {} 4.0 International License."

# SPDX identifiers with the usual notices, standard headers and short texts of each licence.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "0BSD": (_ISC + ".",),
    "AGPL-3.0": ("This work is licensed under the GNU Affero General Public License, version 3.", _FREE.format("Affero General Public License", 3)),
    "All-rights-reserved": ("All rights reserved.",),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.", "Licensed under the Apache License 2.0.", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 '
        'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. '
        "See the License for the specific language governing permissions and limitations under the License.",
    ),
    "BSD-2-Clause": ("Released under the BSD 2-Clause License.", "Licensed under the BSD 2-Clause License.", _BSD + _BSD_END),
    "BSD-3-Clause": ("Released under the BSD 3-Clause License.", "Licensed under the BSD 3-Clause License.", _BSD + _BSD_NAMES + _BSD_END),
    "BSL-1.0": (
        "Distributed under the Boost Software License, Version 1.0.",
        'Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the Software, '
        "and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so",
    ),
    "CC-BY-4.0": ("Licensed under CC BY 4.0.", _CC.format("Attribution")),
    "CC-BY-NC-4.0": ("Licensed under CC BY-NC 4.0.", _CC.format("Attribution-NonCommercial")),
    "CC-BY-NC-ND-4.0": ("Licensed under CC BY-NC-ND 4.0.", _CC.format("Attribution-NonCommercial-NoDerivatives")),
    "CC-BY-NC-SA-4.0": ("Licensed under CC BY-NC-SA 4.0.", _CC.format("Attribution-NonCommercial-ShareAlike")),
    "CC-BY-ND-4.0": ("Licensed under CC BY-ND 4.0.", _CC.format("Attribution-NoDerivatives")),
    "CC-BY-SA-4.0": ("Licensed under CC BY-SA 4.0.", _CC.format("Attribution-ShareAlike")),
    "CC0-1.0": ("Dedicated to the public domain under CC0 1.0.", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    "EPL-2.0": ("Made available under the terms of the Eclipse Public License 2.0.", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/"),
    "GPL-2.0": ("This work is licensed under the GNU General Public License, version 2.", _FREE.format("General Public License", 2)),
    "GPL-3.0": ("This work is licensed under the GNU General Public License, version 3.", _FREE.format("General Public License", 3)),
    "ISC": ("Released under the ISC License.", "Licensed under the ISC License.", _ISC + ", provided that the above copyright notice and this permission notice appear in all copies."),
    "LGPL-3.0": ("This work is licensed under the GNU Lesser General Public License, version 3.", _FREE.format("Lesser General Public License", 3)),
    "MIT": (
        "Released under the MIT License.", "Licensed under the MIT License.",
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: "
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. " + _WARRANTY,
    ),
    "MPL-2.0": (
        "This work is licensed under the Mozilla Public License, version 2.0.",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    ),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain.",
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    ),
    "Zlib": (
        "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: "
        "1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. "
        "3. This notice may not be removed or altered from any source distribution.",
    ),
}

_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
_WORDS = re.compile("[a-z0-9]+")


def words_of(text: str) -> list[str]:
    return _WORDS.findall(text.translate(_LOWER))


def bigrams(words: list[str]) -> list[str]:
    return [f"{a} {b}" for a, b in zip(words, words[1:], strict=False)]


def least_shared(size: int, least: float) -> int:
    """How many bigrams a match shares with a template of so many, at least."""
    return max(1, math.ceil(size * least / (2 - least) - 1e-9))


def anchors(known: list[set[str]], least: float) -> list[str]:
    """Words of which every text that matches a template holds one.

    Words are taken until the bigrams of each template without any of them are fewer than a match shares: the word that
    helps most first, long words before short ones.
    """
    open_ = dict(enumerate(known))
    spare = {k: least_shared(len(b), least) - 1 for k, b in open_.items()}
    out: list[str] = []
    while lacking := {k: b for k, b in open_.items() if len(b) > spare[k]}:
        gain: Counter = Counter()
        for k, b in lacking.items():
            held = Counter(w for pair in b for w in set(pair.split()))
            gain.update({w: min(n, len(b) - spare[k]) for w, n in held.items()})
        best = max(gain, key=lambda w: (len(w) > 3, gain[w], len(w), w))
        out.append(best)
        open_ = {k: {p for p in b if best not in p.split()} for k, b in open_.items()}
    return out


class Scanner:
    """Finds the windows of a text that match a template and that no better window overlaps."""

    def __init__(self, templates: dict[str, tuple[str, ...]], least: float):
        self.least = least
        pairs = sorted((name, words_of(t)) for name, texts in templates.items() for t in texts)
        self.known = [(name, len(w), frozenset(bigrams(w))) for name, w in pairs if len(w) > 1]
        self.of: dict[str, list[int]] = {}
        for k, (_, _, grams) in enumerate(self.known):
            for g in grams:
                self.of.setdefault(g, []).append(k)
        self.words = anchors([set(b) for _, _, b in self.known], least)
        self.automaton = None

    def could(self, text: str) -> bool:
        if self.automaton is None:  # made in the task
            self.automaton = ahocorasick.Automaton()
            for w in self.words:
                self.automaton.add_word(w, w)
            self.automaton.make_automaton()
        return bool(self.words) and next(self.automaton.iter(text.translate(_LOWER)), None) is not None

    def windows(self, words: list[str]) -> list[tuple[float, int, str, int]]:
        """(-dice, -words, license, start) of every window that matches, unsorted."""
        grams = bigrams(words)
        at: dict[int, list[int]] = {}
        for i, g in enumerate(grams):
            for k in self.of.get(g, ()):
                at.setdefault(k, []).append(i)
        out = []
        for k, hits in at.items():
            name, n, own = self.known[k]
            need, wide = least_shared(len(own), self.least), min(n, len(words)) - 1  # bigrams of a window
            if len(hits) < need:
                continue
            run = np.zeros(len(grams) + 1, np.int64)
            run[np.array(hits) + 1] = 1
            run = np.cumsum(run)
            for s in np.flatnonzero(run[wide:] - run[: len(run) - wide] >= need).tolist():
                held = set(grams[s : s + wide])
                dice = 2.0 * len(held & own) / (len(held) + len(own))
                if dice >= self.least:
                    out.append((-dice, -(wide + 1), name, s))
        return out

    def best(self, words: list[str]) -> list[tuple[float, int, str, int]]:
        """The windows that no better one overlaps: better by dice, then more words, then name, then an earlier start."""
        found = sorted(set(self.windows(words)))
        start = np.array([f[3] for f in found], np.int64)
        end = start - np.array([f[1] for f in found], np.int64)
        order = np.argsort(start, kind="stable")
        longest = int((end - start).max(initial=0))
        lo, hi = np.searchsorted(start[order], start - longest), np.searchsorted(start[order], end)
        kept = []
        for i, f in enumerate(found):
            near = order[lo[i] : hi[i]]
            if not ((near < i) & (end[near] > start[i])).any():
                kept.append(f)
        return kept


def scan(docs: DataFrame, templates: dict[str, tuple[str, ...]] | None = None, least: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, line_no, word, n_words, license, dice) for every window that matches and that no better one overlaps.

    word and line_no are the number of its first word and that word's line, from 0. Null and empty texts, texts of one word and
    an empty table give no rows; rows that repeat give their matches each; a null id keeps its matches.
    """
    scanner = Scanner(TEMPLATES if templates is None else templates, least)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = {"doc_id": pa.int64(), "line_no": pa.int32(), "word": pa.int64(), "n_words": pa.int64(), "license": pa.string(), "dice": pa.float64()}
        for b in batches:
            out: list[tuple] = []
            for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if not text or not scanner.could(text):
                    continue
                lines = [words_of(line) for line in text.split("\n")]
                ends = np.cumsum([len(line) for line in lines])
                for minus, less, name, s in scanner.best([w for line in lines for w in line]):
                    out.append((doc, int(np.searchsorted(ends, s, "right")), s, -less, name, -minus))
            cols = list(zip(*out, strict=True)) or [[]] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds.values(), strict=True)], list(kinds))

    asked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).where("text is not null")
    return arrow_map(asked, run, "doc_id long, line_no int, word long, n_words long, license string, dice double")
