"""License scans: winnowed fingerprints pick candidates, banded alignment measures them.

Templates are cut into grams of ``GRAM`` words and winnowed: of each ``WINDOW`` grams in a
row the least hash is kept, with its place, in an inverted index. Of templates under
``SHORT`` words all pairs of words are kept, as one changed word may hit every longer gram. A document's
grams are looked up in it. Hits that agree on where a template would start make a
candidate, and the words there are aligned with the template in a band of
``BAND`` words around that diagonal. Reported are the template's share of matched
words and the span of the document that they cover.

Words that are missing, and words of the span beyond the template's number, both count against a match. Names and versions tell licenses apart
(``TELLING``, and words with a dot in a number or right after "version"): the span must have those of the
template in the same order and no others, so a notice of another license or version matches nothing rather than the nearest
template. A notice that a text speaks of ("not released under the MIT License") is a match like any other.

The index depends on the templates alone, so it is small whatever the input; every
gram of every document is looked up, and nothing is capped. Templates are notices and whole license texts; others
come as a mapping, or as a table ``(license, text)`` of at most ``TEMPLATE_BYTES`` (an error beyond), which every task indexes.

Defined results: null and empty texts match nothing; a text that repeats a license
gets a row for each place; places never overlap (that with more matched words stays,
then that with more of its template, then the earlier one); repeated rows are reported as often as they come; an
empty table or template list gives an empty result; templates without a word match nothing; of rows of a template
table with one license name the last in text order counts; a null doc_id stays null; extra columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

GRAM = 3
WINDOW = 3
SHORT = GRAM + WINDOW + 2
BAND = 8
COVERAGE = 0.8
TEMPLATE_BYTES = 64 << 20
# Words that tell licenses apart.
TELLING = frozenset(b"affero agpl apache artistic attribution boost bsd by by-nc by-nc-nd by-nc-sa by-nd by-sa cc eclipse gfdl gnu gpl isc lesser lgpl mit mozilla mpl nc nd noncommercial noderivatives sa sharealike zlib".split())
_NUMBER = re.compile(rb"v?\d+(?:\.\d+)*")
_WORD = re.compile(rb"[a-z0-9]+(?:[.\-][a-z0-9]+)*")
MATCHES = "doc_id long, license string, coverage double, matched int, template_words int, start_word int, end_word int"

# Notices of public licenses.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
    "MIT": "Released under the MIT License.",
    "MIT-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "BSD-clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "GPL-2.0-header": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    "LGPL-3.0-header": "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    "Unlicense": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    "MIT-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    "ISC-text": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    "BSD-2-Clause-text": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.",
    "AGPL-3.0-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "LGPL-2.1-header": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "AGPL-3.0": "This work is licensed under the GNU Affero General Public License, version 3.",
    "BSD": "Released under the BSD License.",
    "ISC": "Released under the ISC License.",
    "CC-BY-3.0": "Licensed under CC BY 3.0.",
    "CC-BY-ND-4.0": "Licensed under CC BY-ND 4.0.",
    "CC-BY-NC-SA-4.0": "Licensed under CC BY-NC-SA 4.0.",
    "CC-BY-NC-ND-4.0": "Licensed under CC BY-NC-ND 4.0.",
    "BSD-3-Clause-text": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
}


def words(text: bytes) -> list[bytes]:
    """Lower-cased runs of ASCII letters and digits; dots and hyphens inside them stay."""
    return _WORD.findall(text.lower())


def telling(found: list[bytes]) -> list[bytes]:
    """Those of the words that tell licenses apart, in order; a version without its leading v."""
    out = []
    for before, w in zip([b"", *found], found):
        if w in TELLING:
            out.append(w)
        elif _NUMBER.fullmatch(w) and (b"." in w or w[:1] == b"v" or before in (b"version", b"v")):
            out.append(w.removeprefix(b"v"))
    return out


def winnow(hashes: np.ndarray, window: int = WINDOW) -> list[int]:
    """Places of the least hash of each window, the last one of equals."""
    if len(hashes) <= window:
        return list(range(len(hashes)))
    return sorted({i + window - 1 - int(np.argmin(hashes[i : i + window][::-1])) for i in range(len(hashes) - window + 1)})


class Index:
    """Inverted index of winnowed template grams; words outside every template never form a gram."""

    def __init__(self, templates: dict[str, str] | None = None) -> None:
        own = TEMPLATES if templates is None else templates
        self.names = sorted(own)
        self.number: dict[bytes, int] = {}
        self.texts, self.telling = [], []
        for name in self.names:
            found = words(own[name].encode())
            self.texts.append(np.array([self.number.setdefault(w, len(self.number) + 1) for w in found], np.int64))
            self.telling.append(telling(found))
        self.places = {2: defaultdict(list), GRAM: defaultdict(list)}
        for t, ids in enumerate(self.texts):
            size = 2 if len(ids) < SHORT else GRAM
            grams = self.grams(ids, size)
            mixed = np.array([zlib.crc32(int(g).to_bytes(8, "big")) for g in grams])
            for i in range(len(grams)) if size == 2 else winnow(mixed):
                self.places[size][int(grams[i])].append((t, i))
        self.keys = {size: np.array(sorted(places), np.int64) for size, places in self.places.items()}

    def grams(self, ids: np.ndarray, size: int = GRAM) -> np.ndarray:
        """One number for each run of ``size`` known words, -1 where a word is unknown."""
        if len(ids) < size:
            return np.zeros(0, np.int64)
        code, known = np.zeros(len(ids) - size + 1, np.int64), np.ones(len(ids) - size + 1, bool)
        for i in range(size):
            part = ids[i : len(ids) - size + 1 + i]
            code = code * (len(self.number) + 1) + part
            known &= part > 0
        return np.where(known, code, -1)

    def scan(self, text: bytes | None) -> list[tuple[str, float, int, int, int, int]]:
        """``(license, coverage, matched, template words, first word, word after the last)`` of each place."""
        found = words(text) if text else []
        get = self.number.get
        ids = np.fromiter((get(w, 0) for w in found), np.int64, len(found))
        starts = set()
        for size, keys in self.keys.items():
            grams = self.grams(ids, size)
            at = np.flatnonzero(np.isin(grams, keys)) if len(keys) else []
            starts.update((t, int(p) - i) for p in at for t, i in self.places[size][int(grams[p])])
        starts = sorted(starts)
        matches, last = [], None
        for t, start in starts:
            if last and last[0] == t and start - last[1] <= BAND // 2:
                continue  # within the band of the diagonal just aligned
            last = (t, start)
            template = self.texts[t]
            matched, a, b = align(template, ids, start)
            if matched and matched >= COVERAGE * max(len(template), b - a) and telling(found[a:b]) == self.telling[t]:
                matches.append((self.names[t], matched / len(template), matched, len(template), a, b))
        taken: list[int] = []  # first words of the places that stay, in order
        by_start = {}
        for m in sorted(matches, key=lambda m: (-m[2], -m[1], m[4], m[0])):
            at = bisect_left(taken, m[4])
            before, after = by_start[taken[at - 1]] if at else None, by_start[taken[at]] if at < len(taken) else None
            if (before is None or before[5] <= m[4]) and (after is None or m[5] <= after[4]):
                taken.insert(at, m[4])
                by_start[m[4]] = m
        return [by_start[a] for a in taken]


def align(template: np.ndarray, ids: np.ndarray, start: int, band: int = BAND) -> tuple[int, int, int]:
    """Most template words in order within the band around ``start``: how many, the first word and the word after the last.

    Row i of the table may use words ``start + i - band`` to ``start + i + band``. Of equal counts the
    one that begins nearest to ``start`` wins, then the shorter span.
    """
    best: dict[int, tuple[int, int, int, int]] = {}  # by last word used: matched, -distance of the first from start, -last, first
    top = (0, 0, 0, 0)
    for i, w in enumerate(template.tolist()):
        low, high = max(0, start + i - band), min(len(ids), start + i + band + 1)
        new = []
        for j in (low + np.flatnonzero(ids[low:high] == w)).tolist():
            before = max((v for k, v in best.items() if k < j), default=None)
            new.append((j, (before[0] + 1, before[1], -j, before[3]) if before else (1, -abs(j - start), -j, j)))
        for j, v in new:
            if j not in best or v > best[j]:
                best[j] = v
            top = max(top, v)
        if len(best) > 4 * band:  # words left of the band can only be followed: the best of them stands for all
            past = [k for k in best if k < low]
            if past:
                stand = max(past, key=lambda k: best[k])
                for k in past:
                    if k != stand:
                        del best[k]
    return top[0], top[3], -top[2] + 1 if top[0] else 0


def _templates(given: dict[str, str] | DataFrame | None) -> dict[str, str] | None:
    """A table of templates as a mapping, after a check of its size."""
    if not isinstance(given, DataFrame):
        return given
    rows = given.select("license", "text").where("license IS NOT NULL AND text IS NOT NULL")
    held = rows.agg(F.sum(F.octet_length("text"))).head()[0] or 0
    if held > TEMPLATE_BYTES:
        raise ValueError(f"templates hold {held} bytes, more than {TEMPLATE_BYTES}")
    return {r["license"]: r["text"] for r in rows.orderBy("license", "text").collect()}


def license_matches(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: dict[str, str] | DataFrame | None = None) -> DataFrame:
    """One row for each place of ``docs`` that holds at least ``COVERAGE`` of a template."""
    templates = _templates(templates)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(templates)
        for batch in batches:
            rows = [(key.as_py(), *m) for key, text in zip(batch.column(0), batch.column(1)) for m in index.scan(text.as_py())]
            cols = list(zip(*rows)) or [()] * 7
            kinds = (pa.int64(), pa.string(), pa.float64(), pa.int32(), pa.int32(), pa.int32(), pa.int32())
            names = ["doc_id", "license", "coverage", "matched", "template_words", "start_word", "end_word"]
            yield pa.record_batch([pa.array(c, k) for c, k in zip(cols, kinds)], names)

    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.encode(text_col, "UTF-8").alias("body"))
    return own.mapInArrow(scan, MATCHES)
