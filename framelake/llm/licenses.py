"""Licence scans: Dice coefficient over word bigrams against templates.

Each line, each paragraph and the whole of a text are units. A unit is compared with the templates whose size lets the
coefficient reach the threshold at all: with a and b different bigrams it is at most 2 min(a, b) / (a + b). An inverted
index from bigrams to templates counts the common ones. Notices that are parts of a unit are found by windows as long as
a template, of the templates that have enough of their bigrams in the text."""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framelake.llm.common import unused

#: Templates of fewer words are compared with whole units only: a few common words in a row are no notice.
WINDOW_WORDS = 12

# Licence notices and short licence texts, by SPDX identifier.
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License. See LICENSE in the project root for license information."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, "
        "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
        "subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. "
        "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. "
        "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE "
        "OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 "
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. "
        "See the License for the specific language governing permissions and limitations under the License.",
    ),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    (
        "GPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. "
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
    ),
    (
        "GPL-2.0",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    ),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. "
        "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
        "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR "
        "PERFORMANCE OF THIS SOFTWARE.",
    ),
    (
        "BSD-2-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, "
        "this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    ),
    (
        "BSD-2-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, "
        "this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. "
        "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. "
        "IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; "
        "LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, "
        "EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
    ),
    (
        "BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, "
        "this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. "
        "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. "
        "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. "
        "IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; "
        "LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, "
        "EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
    ),
    (
        "Zlib",
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. "
        "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: "
        "1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. "
        "2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution.",
    ),
    (
        "BSL-1.0",
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, "
        "and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following: "
        "The copyright notices in the Software and this entire statement, including the above license grant, this restriction and the following disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative works of the Software, "
        "unless such copies or derivative works are solely in the form of machine-executable object code generated by a source language processor. "
        "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE, TITLE AND NON-INFRINGEMENT. "
        "IN NO EVENT SHALL THE COPYRIGHT HOLDERS OR ANYONE DISTRIBUTING THE SOFTWARE BE LIABLE FOR ANY DAMAGES OR OTHER LIABILITY, WHETHER IN CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE "
        "OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    (
        "Unlicense",
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means. "
        "In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. "
        "We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law. "
        "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. "
        "IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
)

_WORDS = re.compile(r"\w+").findall


def bigrams(text: str) -> set[tuple[str, str]]:
    """Different pairs of neighbouring words, lower-cased, with marks for begin and end; empty for a text without a word."""
    words = _WORDS(text.lower())
    return set(zip(["<", *words], [*words, ">"], strict=True)) if words else set()


class Scanner:
    def __init__(self, templates, least: float):
        if not 0 < least <= 1:
            raise ValueError("the threshold must be over 0 and at most 1")
        sets = sorted(((name, bigrams(text)) for name, text in templates), key=lambda x: len(x[1]))
        self.names = [name for name, _ in sets]
        self.sizes = [len(s) for _, s in sets]
        self.least = least
        self.index: dict[tuple[str, str], list[int]] = {}
        for k, (_, s) in enumerate(sets):
            for g in s:
                self.index.setdefault(g, []).append(k)
        # For windows: bigrams without the marks, and how many words a template has.
        whole = sorted(((name, _WORDS(text.lower())) for name, text in templates), key=lambda x: len(x[1]))
        self.whole = [(name, len(w), set(zip(w, w[1:], strict=False))) for name, w in whole if len(w) >= WINDOW_WORDS]
        self.inside: dict[tuple[str, str], list[int]] = {}
        for k, (_, _, s) in enumerate(self.whole):
            for g in s:
                self.inside.setdefault(g, []).append(k)

    def best(self, text: str) -> tuple[str, float] | None:
        """(name, coefficient) of the closest template at or above the threshold; of equals the smaller, then the first named."""
        unit = bigrams(text)
        n = len(unit)
        low = bisect_left(self.sizes, n * self.least / (2 - self.least) - 1e-9)
        high = bisect_right(self.sizes, n * (2 - self.least) / self.least + 1e-9)
        if not n or low >= high:
            return None
        common = Counter(k for g in unit & self.index.keys() for k in self.index[g] if low <= k < high)
        scored = [(-2 * c / (n + self.sizes[k]), k) for k, c in common.items()]
        if not scored or -min(scored)[0] < self.least:
            return None
        score, k = min(scored)
        return self.names[k], -score


    def spans(self, words: list[str]) -> list[tuple[str, float, int, int]]:
        """(name, coefficient, a, b): words a to b, as many as the template has, that reach the threshold with it. Of windows that overlap, whatever their
        templates, the best one counts, of equals the longer, then the first; then the best of the rest."""
        grams = list(zip(words, words[1:], strict=False))
        common: dict[int, set] = {}
        for g in self.inside.keys() & set(grams):
            for k in self.inside[g]:
                common.setdefault(k, set()).add(g)
        found = []
        for k, own in common.items():
            name, n, s = self.whole[k]
            # A window has at least as many different bigrams in common with the template as the threshold asks of the smallest one that may do.
            if len(own) < len(s) * self.least / (2 - self.least) or len(words) < n:
                continue
            counts: Counter = Counter()
            shared = 0
            for i, g in enumerate(grams):
                counts[g] += 1
                shared += counts[g] == 1 and g in s
                if i >= n - 1:
                    old = grams[i - n + 1]
                    counts[old] -= 1
                    if not counts[old]:
                        del counts[old]
                        shared -= old in s
                if i >= n - 2 and 2 * shared >= self.least * (len(counts) + len(s)):
                    found.append((-2 * shared / (len(counts) + len(s)), -n, i - n + 2, k))
        out = []
        for score, n, a, k in sorted(found):
            if all(a - n <= x or y <= a for _, _, x, y in out):
                out.append((self.whole[k][0], -score, a, a - n))
        return sorted(out, key=lambda x: x[2])


def scan(docs: DataFrame, templates=TEMPLATES, least: float = 0.8, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, unit, line, license, dice) for each unit at or above the threshold: unit is line, paragraph, document or span, line the
    number of its first line from 1.

    A paragraph is what blank lines separate; a unit equal to a smaller one is not reported again, so one-line paragraphs
    count as lines. A span is a run of words as long as a template of WINDOW_WORDS words or more, anywhere in the text, unless it begins and ends within lines that are reported
    already as a line, a paragraph or the document. Null, empty and wordless texts give no row; rows that repeat are reported each.
    A key that is called like a result makes the result's name end in _."""
    names = [unused(n, [key]) for n in ("unit", "line", "license", "dice")]
    schema = docs.select(key).schema.add(names[0], "string").add(names[1], "long").add(names[2], "string").add(names[3], "double")

    def units(lines: list[str], t: str) -> Iterator[tuple[str, int, int, str]]:
        """(unit, first line, last line, text)"""
        yield from (("line", i, i, x) for i, x in enumerate(lines, 1))
        count, start = 0, None
        for i, x in enumerate([*lines, ""], 1):
            if x.strip(" \t\r"):
                start = start or i
            elif start:
                count += 1
                if i - 1 > start:
                    yield "paragraph", start, i - 1, "\n".join(lines[start - 1 : i - 1])
                start = None
        if count > 1:
            yield "document", 1, len(lines), t

    def scanned(scanner: Scanner, t: str) -> list[tuple[str, int, str, float]]:
        lines = t.split("\n")
        out, known = [], []
        for unit, first, last, x in units(lines, t):
            if found := scanner.best(x):
                out.append((unit, first, *found))
                known.append((first, last))
        inside = scanner.spans(_WORDS(t.lower()))
        if inside:
            # Lower-casing may change a text's length, but never its lines or their words.
            ends = list(accumulate(len(_WORDS(x.lower())) for x in lines))
            for name, score, a, b in inside:
                first, last = bisect_right(ends, a) + 1, bisect_right(ends, b - 1) + 1
                if not any(x <= first and last <= y for x, y in known):
                    out.append(("span", first, name, score))
        return out

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scanner = Scanner(templates, least)
        for b in batches:
            rows = [(k, *r) for k, t in zip(b.iloc[:, 0], b.iloc[:, 1], strict=True) if t for r in scanned(scanner, t)]
            yield pd.DataFrame(rows, columns=schema.names)

    return docs.select(F.col(key), F.col(text).cast("string").alias(unused("text", [key]))).mapInPandas(run, schema)


def query(spark, sf_dir: str) -> DataFrame:
    return scan(spark.read.parquet(f"{sf_dir}/documents.parquet")).withColumn("dice", F.round("dice", 6))
