"""License scans: MinHash bands over overlapping windows, then exact containment.

Texts are cut into words of letters and digits, in lower case, and into shingles of three
words. Templates are grouped by length; a group's windows are three blocks of half its
greatest length, so that every occurrence lies within one window. An occurrence that
holds 80 % of a template then has a resemblance of at least 0.25 with its window, and of
``HASHES`` bands of one row each, one at least agrees with a probability above
1 - 0.75 ** HASHES, which is 0.999999. A template so retrieved is verified exactly: the
share of its shingles that the window holds.

Defined cases: NULL and empty texts match nothing; whole texts are scanned, whatever
their length; matches of one template that overlap are one match, from its first shingle
to its last, with the containment of its best window; a document that holds a license
twice has two rows; repeated rows are scanned each; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from functools import cache
from pathlib import Path
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybrook.llm.words import Texts, mix, pieces, text_bytes, windows, words

WIDTH = 3
HASHES = 48
CONTAINMENT = 0.8

# ASCII other than letters and digits separates words.
SEPARATORS = np.array([b < 0x80 and not chr(b).isalnum() for b in range(256)])

TEMPLATES = {
    "Apache-2.0-line": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0-line": "This work is licensed under the GNU General Public License, version 3.",
    "MIT-line": "Released under the MIT License.",
    "CC-BY-NC-4.0-line": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0-line": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0-line": (
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."
    ),
    "Apache-2.0-notice": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR "
        "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
        "permissions and limitations under the License."
    ),
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
        "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
        "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
        "following conditions: The above copyright notice and this permission notice shall be included in all "
        "copies or substantial portions of the Software."
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "BSD-conditions": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met: Redistributions of source code must retain the above copyright "
        "notice, this list of conditions and the following disclaimer. Redistributions in binary form must "
        "reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
        "documentation and/or other materials provided with the distribution."
    ),
    "GPL-notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY "
        "WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."
    ),
    "MPL-2.0-notice": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
        "was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."
    ),
    "Unlicense": "This is free and unencumbered software released into the public domain.",
    "Apache-2.0-short": "Released under the Apache License 2.0.",
    "GPL-2.0-line": "This program is licensed under the GNU General Public License, version 2.",
    "GPL-3.0-short": "Licensed under the GPL v3.",
    "LGPL-line": "Licensed under the GNU Lesser General Public License.",
    "LGPL-notice": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation; either version 2.1 of the License, or "
        "(at your option) any later version."
    ),
    "AGPL-3.0-line": "Licensed under the GNU Affero General Public License.",
    "AGPL-notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, or "
        "(at your option) any later version."
    ),
    "MIT-licensed": "Licensed under the MIT License.",
    "MIT-terms": "This project is licensed under the terms of the MIT license.",
    "MIT-disclaimer": (
        "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED "
        "TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL "
        "THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF "
        "CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER "
        "DEALINGS IN THE SOFTWARE."
    ),
    "BSD-line": "Licensed under the BSD License.",
    "BSD-3-Clause-line": "Use of this source code is governed by a BSD-style license.",
    "BSD-disclaimer": (
        "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED "
        "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A "
        "PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY "
        "DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, "
        "PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER "
        "CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR "
        "OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
    ),
    "CC-BY-4.0-short": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0-short": "Licensed under CC BY-SA 4.0.",
    "CC-BY-ND-4.0-short": "Licensed under CC BY-ND 4.0.",
    "CC0-1.0-line": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    "CC0-1.0-short": "Released under CC0 1.0 Universal.",
    "BSL-1.0-line": "Distributed under the Boost Software License, Version 1.0.",
    "BSL-1.0": (
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software "
        "and accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, "
        "distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to "
        "permit third-parties to whom the Software is furnished to do so, all subject to the following:"
    ),
    "Zlib": (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be "
        "held liable for any damages arising from the use of this software. Permission is granted to anyone to use "
        "this software for any purpose, including commercial applications, and to alter it and redistribute it "
        "freely, subject to the following restrictions: The origin of this software must not be misrepresented; you "
        "must not claim that you wrote the original software."
    ),
}


@cache
def full_texts() -> dict[str, str]:
    """Whole licenses, by name; those a notice usually stands for."""
    folder = Path(__file__).with_name("license_texts")
    return {f"{f.stem}-text": f.read_text() for f in sorted(folder.glob("*.txt"))}


class Group(NamedTuple):
    """Templates of similar length: half their greatest length in shingles, their numbers,
    the fewest shingles of one, and the least hash of each under every hash function
    (hashes by templates)."""

    block: int
    numbers: np.ndarray
    fewest: int
    least: np.ndarray


class Templates(NamedTuple):
    names: list[str]
    sets: list[np.ndarray]
    groups: list[Group]
    marks: np.ndarray
    every: np.ndarray
    factors: np.ndarray


def shingles(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Shingles of all texts on end, and the first of each text (one more than texts)."""
    found = words(texts, lower=True, separators=SEPARATORS)
    n = np.maximum(np.diff(found.first) - WIDTH + 1, 0)
    first = np.concatenate(([0], np.cumsum(n)))
    places = np.arange(first[-1]) + np.repeat(found.first[:-1] - first[:-1], n)
    return windows(found.hashes, WIDTH)[places], first


@cache
def prepare(items: tuple[tuple[str, str], ...]) -> Templates:
    found, first = shingles(text_bytes(pa.array([text for _, text in items], pa.string())))
    sets = [np.unique(found[a:b]) for a, b in zip(first[:-1], first[1:])]
    short = [name for (name, _), s in zip(items, sets) if not len(s)]
    if short:
        raise ValueError(f"templates of fewer than {WIDTH} words: {short}")
    factors = mix(np.arange(1, HASHES + 1, dtype=np.uint64)) | np.uint64(1)
    by_block: dict[int, list[int]] = {}
    for number, (a, b) in enumerate(zip(first[:-1], first[1:])):
        by_block.setdefault(max(1, 1 << max(0, int(b - a) - 1).bit_length() >> 1), []).append(number)
    groups = [
        Group(block, np.array(numbers), min(len(sets[i]) for i in numbers), np.array([[mix(sets[i] * f).min() for i in numbers] for f in factors]))
        for block, numbers in sorted(by_block.items())
    ]
    # A text whose shingles miss this table has none of any template.
    marks = np.zeros(1 << 20, bool)
    marks[np.concatenate(sets) & np.uint64(len(marks) - 1)] = True
    return Templates([name for name, _ in items], sets, groups, marks, np.unique(np.concatenate(sets)), factors)


class Match(NamedTuple):
    template: int
    first: int
    last: int
    containment: float


def matches(found: np.ndarray, templates: Templates, containment: float = CONTAINMENT) -> list[Match]:
    """Matches in one text, given its shingles."""
    near = np.flatnonzero(templates.marks[found & np.uint64(len(templates.marks) - 1)])
    near = near[np.isin(found[near], templates.every)] if len(near) else near
    out: list[Match] = []
    for group in templates.groups if len(near) else ():
        spans: dict[int, list[Match]] = {}
        # A window is named by its middle block; only windows near a mark are looked at.
        middles = np.unique((near // group.block)[:, None] + np.array([-1, 0, 1]))
        for middle in middles[middles >= 0].tolist():
            start = max(0, (middle - 1) * group.block)
            window = found[start : (middle + 2) * group.block]
            # Shingles of templates in the window: too few, and it holds enough of none.
            marked = np.searchsorted(near, start + len(window)) - np.searchsorted(near, start)
            if not len(window) or marked < containment * group.fewest:
                continue
            least = np.array([mix(window * f).min() for f in templates.factors])
            for place in np.flatnonzero((least[:, None] == group.least).any(axis=0)).tolist():
                number = int(group.numbers[place])
                held = np.isin(window, templates.sets[number])
                share = len(np.unique(window[held])) / len(templates.sets[number])
                if share >= containment:
                    where = np.flatnonzero(held) + start
                    spans.setdefault(number, []).append(Match(number, int(where[0]), int(where[-1]), share))
        for number, some in spans.items():
            merged: list[Match] = []
            for m in sorted(some, key=lambda m: (m.first, m.last)):
                if merged and m.first <= merged[-1].last:
                    was = merged[-1]
                    merged[-1] = Match(number, was.first, max(was.last, m.last), max(was.containment, m.containment))
                else:
                    merged.append(m)
            out += merged
    return sorted(out, key=lambda m: (m.first, m.template))


def scan_licenses(
    documents: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    templates: Mapping[str, str] | None = None,
    containment: float = CONTAINMENT,
) -> DataFrame:
    """One row per match: document id, ``license``, ``first_word`` and ``last_word`` of the
    match (from 0), and ``containment``. The templates, by default statements, notices and
    whole texts, travel with the tasks."""
    items = tuple((TEMPLATES | full_texts() if templates is None else templates).items())
    prepare(items)
    rows = documents.select(F.col(id_column).alias("_id"), F.col(text_column).alias("_text"))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = prepare(items)
        for batch in batches:
            for at, upto in pieces(batch.column(1)):
                found, first = shingles(text_bytes(batch.column(1).slice(at, upto - at)))
                hits = [(at + i, m) for i, (a, b) in enumerate(zip(first[:-1], first[1:])) for m in matches(found[a:b], known, containment)]
                yield pa.record_batch(
                    {
                        "_id": batch.column(0).take(pa.array([i for i, _ in hits], pa.int64())),
                        "license": pa.array([known.names[m.template] for _, m in hits], pa.string()),
                        "first_word": pa.array([m.first for _, m in hits], pa.int64()),
                        "last_word": pa.array([m.last + WIDTH - 1 for _, m in hits], pa.int64()),
                        "containment": pa.array([m.containment for _, m in hits], pa.float64()),
                    }
                )

    kind = rows.schema["_id"].dataType.simpleString()
    return rows.mapInArrow(
        scan, f"_id {kind}, license string, first_word long, last_word long, containment double"
    ).withColumnRenamed("_id", id_column)
