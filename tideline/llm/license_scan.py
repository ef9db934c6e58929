"""Licence scanning by patience alignment of text and templates."""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.shared import Words, pieces

#: Letters, digits and everything beyond ASCII make words.
TABLE = np.zeros(256, bool)
TABLE[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
SEED = 0x71C3

#: Texts of public licences and of their usual notices. Fixed values.
TEMPLATES = {
    "0bsd": 'Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.',
    "agpl-3.0-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Affero General Public License for more details.",
    "apache-2.0-line": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-notice": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.',
    "boost-1.0": 'Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following:',
    "bsd-2-clause": 'Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.',
    "bsd-3-clause-extra": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    "cc-by-4.0-line": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-nc-4.0-line": "Licensed under CC BY-NC 4.0.",
    "cc-by-sa-4.0-line": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "gpl-2.0-notice": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
    "gpl-3.0-line": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-3.0-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
    "isc": 'Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS.',
    "lgpl-2.1-notice": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version. This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public License for more details.",
    "mit": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.',
    "mit-line": "Released under the MIT License.",
    "mpl-2.0-notice": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    "unlicense": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    "zlib": "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:",
}


def rising(values: list[int]) -> list[int]:
    """Places of a longest increasing subsequence."""
    tails: list[int] = []
    ends: list[int] = []
    back = [-1] * len(values)
    for i, v in enumerate(values):
        k = bisect_left(tails, v)
        back[i] = ends[k - 1] if k else -1
        tails[k : k + 1], ends[k : k + 1] = [v], [i]
    out, i = [], ends[-1] if ends else -1
    while i >= 0:
        out.append(i)
        i = back[i]
    return out[::-1]


def patience(a: list, b: list) -> list[tuple[int, int]]:
    """Aligned places of a and b: equal ends, then anchors, and the gaps between anchors the same way."""
    found: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        i, j, k, m = todo.pop()
        while i < j and k < m and a[i] == b[k]:
            found.append((i, k))
            i, k = i + 1, k + 1
        while i < j and k < m and a[j - 1] == b[m - 1]:
            j, m = j - 1, m - 1
            found.append((j, m))
        if i >= j or k >= m:
            continue
        n_a, n_b = Counter(a[i:j]), Counter(b[k:m])
        place = {b[y]: y for y in range(k, m) if n_b[b[y]] == 1}
        once = [(x, place[a[x]]) for x in range(i, j) if n_a[a[x]] == 1 and a[x] in place]
        anchors = [once[x] for x in rising([y for _, y in once])]
        if anchors:
            edges = [(i - 1, k - 1), *anchors, (j, m)]
            found += anchors
            todo += [(p + 1, q, r + 1, s) for (p, r), (q, s) in zip(edges, edges[1:], strict=False)]
    return sorted(found)


def scan_licenses(docs: DataFrame, templates: dict[str, str] | None = None, least: float = 0.8) -> DataFrame:
    """doc_id, license, coverage, first_word, last_word, n_anchored for each copy of a template in a text that covers
    `least` of it. Windows of once to twice the template's words, from each word that the template has, are aligned; of
    those alignments, the ones that share no word and have the largest total weight() are the copies, so that adjoining
    copies are told apart, edited or not. Behind an unbroken copy the search goes on. Where in a text a copy begins makes
    no difference. Columns beside doc_id and text are left out, whatever they are called.

    Words are lower-cased runs of letters, digits and non-ASCII characters, counted from 0. coverage is the share of the
    template's words that the alignment pairs. Texts that are null, empty or hold no licence have no row; repeated rows
    have theirs each; templates without words are left out. A window is aligned only if the words it has in common with
    the template, each at most as often as there, could reach `least`; that bound drops nothing.
    """
    given = {k: v for k, v in (TEMPLATES if templates is None else templates).items()}
    read = Words(pa.array(list(given.values()), pa.string()), lower=True, table=TABLE)
    hashes = read.hashes(SEED)
    known = [(k, hashes[a:b]) for k, a, b in zip(given, read.first, read.first[1:], strict=False) if b > a]
    vocabulary = np.unique(np.concatenate([h for _, h in known])) if known else np.zeros(0, np.uint64)
    weight = np.stack([np.bincount(np.searchsorted(vocabulary, h), minlength=len(vocabulary)) / len(h) for _, h in known], 1) if known else np.zeros((0, 0))
    coded = [(k, np.searchsorted(vocabulary, h).tolist()) for k, h in known]
    schema = pa.schema([("doc_id", pa.int64()), ("license", pa.string()), ("coverage", pa.float64()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("n_anchored", pa.int64())])

    def scan(batches):
        for batch in batches:
            for part in pieces(batch, "text"):
                words = Words(part.column("text"), lower=True, table=TABLE)
                h = words.hashes(SEED)
                code = np.minimum(np.searchsorted(vocabulary, h), len(vocabulary) - 1)
                code = np.where(vocabulary[code] == h, code, -1)
                has = np.zeros((part.num_rows, len(vocabulary)), bool)
                has[words.doc[code >= 0], code[code >= 0]] = True
                out = []
                for d, t in np.argwhere(has @ weight >= least - 1e-9).tolist():
                    name, template = coded[t]
                    own = code[words.first[d] : words.first[d + 1]]
                    for first, last, n in copies(own, template, least):
                        out.append({"doc_id": part.column("doc_id")[d].as_py(), "license": name, "coverage": n / len(template), "first_word": first, "last_word": last, "n_anchored": n})
                yield pa.RecordBatch.from_pylist(out, schema)

    if not known:
        return docs.sparkSession.createDataFrame([], "doc_id long, license string, coverage double, first_word long, last_word long, n_anchored long")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(scan, "doc_id long, license string, coverage double, first_word long, last_word long, n_anchored long")


def copies(code: np.ndarray, template: list[int], least: float) -> list[tuple[int, int, int]]:
    """(first word, last word, words aligned) of each copy of the template, none of which overlap, in their order: of all
    alignments found, those of the largest total of weight() that share no word."""
    found, behind = set(), 0
    for at, ends in _windows(code, np.array(template), least):
        if at >= behind:
            for end in ends:
                pairs = patience(code[at:end].tolist(), template)
                if len(pairs) >= least * len(template) - 1e-9:
                    first, last = at + pairs[0][0], at + pairs[-1][0]
                    found.add((last, -first, -len(pairs)))
                    if len(pairs) == len(template) == last - first + 1:
                        behind = last + 1
                        break
    return heaviest([(-first, last, -n) for last, first, n in sorted(found)])


def weight(first: int, last: int, n: int) -> int:
    """Words aligned, less two fifths of those passed over: a copy that fills its gaps from the next one weighs less than
    both, and one spread over twice its words still weighs something."""
    return 5 * n - 2 * (last - first + 1 - n)


def heaviest(spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Of spans by ascending end, those of the largest total weight that don't overlap; of equal totals the one met first."""
    ends = [last for _, last, _ in spans]
    total, take = [0], []
    for i, span in enumerate(spans):
        before = bisect_left(ends, span[0], 0, i)
        own = total[before] + weight(*span)
        take.append(before if own > total[-1] else None)
        total.append(max(own, total[-1]))
    out, i = [], len(spans)
    while i:
        if take[i - 1] is None:
            i -= 1
        else:
            out.append(spans[i - 1])
            i = take[i - 1]
    return out[::-1]


def _windows(code: np.ndarray, template: np.ndarray, least: float) -> list[tuple[int, list[int]]]:
    """Start and ends of the windows that may reach `least`, in their order. A window begins at one of the template's words
    and ends behind the last of them within its words, or more of them, up to twice as many: a wide one sees a copy that is
    spread, a narrow one a copy whose gaps the next copy would fill."""
    words, often = np.unique(template, return_counts=True)
    at = np.flatnonzero(np.isin(code, words))
    wide = sorted({len(template) * x // 8 for x in (8, 9, 10, 12, 16)})
    reach = np.stack([at + w for w in wide])
    most = np.zeros(reach.shape, np.int64)
    for word, n in zip(words.tolist(), often.tolist(), strict=True):
        own = at[code[at] == word]
        most += np.minimum(np.searchsorted(own, reach) - np.searchsorted(own, at), n)
    end = at[np.searchsorted(at, reach) - 1] + 1 if len(at) else reach
    fine = most >= least * len(template) - 1e-9
    some = np.flatnonzero(fine.any(0))
    return [(int(at[i]), sorted(set(end[fine[:, i], i].tolist()))) for i in some]
