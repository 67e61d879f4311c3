"""License scan by conditional compression, confirmed by exact wording.

Sentences with a licensing word are candidates (a sentence ends with its mark, unless a digit or small
letter follows, or before a blank line); candidates with at
most one other sentence between them are one block. A block is compressed alone and with each template as raw zstandard
dictionary; the templates are ranked by the bytes that they save. The best few, and where none of them
holds all the others in turn, are confirmed by word edits: the part of the
block that lies nearest to the template may differ in at most a fifth of the template's words, and in none of the words
that name the license. What is left of a block around its findings is searched again.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame

CUE = r"(?i)licen[cs]|copyright|redistribut|warrant|spdx|permission|public domain"

#: The public wording of licenses and their notices: (license, words that name it, wording).
TEMPLATES = (
    ("Apache-2.0", "apache 2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "apache 2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0'),
    ("Apache-2.0", "spdx-license-identifier apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("MIT", "mit", "Released under the MIT License."),
    ("MIT", "mit", "Licensed under the MIT License."),
    ("MIT", "spdx-license-identifier mit", "SPDX-License-Identifier: MIT"),
    ("MIT", "deal", 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:'),
    ("ISC", "fee", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("BSD-3-Clause", "bsd 3-clause", "Licensed under the BSD 3-Clause License."),
    ("BSD", "redistribution source binary", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("GPL-3.0", "gnu general 3", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "gnu general 3", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-2.0", "gnu general 2", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "gnu general 2", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("LGPL-2.1", "gnu lesser 2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."),
    ("AGPL-3.0", "affero 3", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", "mozilla 2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Unlicense", "unencumbered", "This is free and unencumbered software released into the public domain."),
    ("CC0-1.0", "cc0 1.0", "Licensed under CC0 1.0."),
    ("CC-BY-4.0", "cc by 4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "cc by-sa 4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "cc by-nc 4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "creative attribution 4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "creative attribution-noncommercial 4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-SA-4.0", "creative attribution-sharealike 4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
)
#: Templates of the best savings that are confirmed at once, the rest one by one; one in PART words of a template may differ.
WINNERS, PART = 4, 5
#: A block of more words is examined in windows of so many, which overlap by a third: more than the longest template and its edits.
WINDOW = 450

_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_TRIM = ".,;:!?()[]{}<>\"'*#/"
TYPE = "array<struct<license string, start int, stop int, differences int, saved int>>"


def _norm(word: str) -> str:
    return word.lower().strip(_TRIM)


def _edits(pattern: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Least word edits between the whole pattern and a run of words that ends before each position."""
    steps = np.arange(len(words) + 1)
    row = np.zeros(len(words) + 1, np.int64)
    for i, p in enumerate(pattern, 1):
        new = np.empty_like(row)
        new[0] = i
        new[1:] = np.minimum(row[1:] + 1, row[:-1] + (words != p))
        row = np.minimum.accumulate(new - steps) + steps
    return row


class Scanner:
    """Templates compiled for a task: their words and their compressors."""

    def __init__(self, templates=TEMPLATES):
        self.alone = zstandard.ZstdCompressor(level=3, write_content_size=False, write_checksum=False)
        self.templates = []
        for name, keys, wording in templates:
            words = [w for w in map(_norm, wording.split()) if w]
            raw = zstandard.ZstdCompressionDict(" ".join(words).encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            self.templates.append((name, set(keys.split()), words, zstandard.ZstdCompressor(level=3, dict_data=raw, write_content_size=False, write_checksum=False)))

    def _best(self, words: list[str]):
        """(start, stop, license, differences, bytes saved) of the nearest confirmed template in a window, wherever it occurs."""
        data = " ".join(words).encode("utf-8", "replace")
        alone = len(self.alone.compress(data))
        saved = sorted((len(c.compress(data)) - alone, i) for i, (*_, c) in enumerate(self.templates))
        ids: dict[str, int] = {}
        coded = np.array([ids.setdefault(w, len(ids)) for w in words])
        found = []
        # the ranking is by savings; those without any come last, as edits may leave nothing to save
        able = [(less, i) for less, i in saved if self.templates[i][1] <= ids.keys()]
        for k, (less, i) in enumerate(able):
            if k >= WINNERS and found:
                break
            name, keys, wording, _ = self.templates[i]
            pattern = np.array([ids.get(w, -1) for w in wording])
            ends = _edits(pattern, coded)
            for stop in np.flatnonzero(ends * PART <= len(wording)):
                back = _edits(pattern[::-1], coded[max(0, stop - 2 * len(wording)) : stop][::-1])
                start = int(stop - np.flatnonzero(back == ends[stop])[0])
                if keys <= set(words[start:stop]):
                    found.append((ends[stop] / len(wording), -len(wording), start, int(stop), name, int(ends[stop]), -less))
        out, free = [], 0
        found.sort()
        for *rank, start, stop, name, differences, less in found:
            if rank == list(found[0][:2]) and name == found[0][4] and start >= free:
                out.append((start, stop, name, differences, less))
                free = stop
        return out

    def _window(self, words: list[str], first: int, out: dict) -> None:
        todo = [(0, len(words))]
        while todo:
            a, b = todo.pop()
            part = words[a:b]
            if b - a < 2 or not re.search(CUE, " ".join(part)):
                continue
            at = 0
            for start, stop, name, differences, saved in (best := self._best(part)):
                out[first + a + start, first + a + stop, name] = (differences, saved)
                todo.append((a + at, a + start))
                at = stop
            if best:
                todo.append((a + at, b))

    def scan(self, text: str) -> list[dict]:
        spans = [m.span() for m in _WORD.finditer(text)]
        kept = [(a, b, w) for a, b in spans if (w := _norm(text[a:b]))]
        starts = [next((c for c in text[a:b] if c.isalnum()), "") for a, b, _ in kept] + [""]
        ends = [i + 1 for i, (_, b, _) in enumerate(kept) if text[b - 1] in ".!?" and not (starts[i + 1].isdigit() or starts[i + 1].islower()) or i + 1 == len(kept) or text.count("\n", b, kept[i + 1][0]) > 1]
        sentences = list(zip([0, *ends], ends))
        blocks: list[list[int]] = []
        last = -3
        for i, (a, b) in enumerate(sentences):
            if re.search(CUE, text[kept[a][0] : kept[b - 1][1]]):
                if i - last <= 2 and blocks:
                    blocks[-1][1] = b
                else:
                    blocks.append([a, b])
                last = i
        found: dict = {}
        for a, b in blocks:
            step = 2 * WINDOW // 3
            for at in range(a, max(a + 1, b - WINDOW + step), step):
                self._window([w for *_, w in kept[at : min(b, at + WINDOW)]], at, found)
        out, taken = [], -1
        for (a, b, name), (differences, saved) in sorted(found.items(), key=lambda x: (x[0][0], x[1][0], -x[0][1], x[0][2])):
            if a >= taken:  # overlapping windows see a finding twice
                out.append({"license": name, "start": kept[a][0], "stop": kept[b - 1][1], "differences": differences, "saved": saved})
                taken = b
        return out


def scan_licenses(docs: DataFrame, templates=TEMPLATES) -> DataFrame:
    """(doc_id, licenses) for every row of docs (doc_id, text): findings by place, in code points, end exclusive.

    differences counts the word edits to the template (0: the same words; case and punctuation at the ends of words aside),
    saved the bytes by which the template shortens the compressed block. Null and empty texts and texts without a
    licensing word have an empty array; rows that repeat are each scanned; a null doc_id stays null; other columns
    are not read.
    """

    def run(batches):
        scanner = Scanner(templates)
        kind = pa.list_(pa.struct([("license", pa.string()), ("start", pa.int32()), ("stop", pa.int32()), ("differences", pa.int32()), ("saved", pa.int32())]))
        for b in batches:
            text = b.column(1)
            cued = pc.fill_null(pc.match_substring_regex(text, CUE), False).to_numpy(zero_copy_only=False)
            found: list[list[dict]] = [[] for _ in range(b.num_rows)]
            for i in np.flatnonzero(cued):
                found[i] = scanner.scan(text[int(i)].as_py())
            yield pa.RecordBatch.from_arrays([b.column(0).cast(pa.int64()), pa.array(found, kind)], ["doc_id", "licenses"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id long, licenses {TYPE}")
