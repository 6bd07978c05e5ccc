"""Operator 1, license scans: MinHash bands over overlapping windows of a text
retrieve license templates, exact shingle containment verifies them.

Words are folded (letters and digits, lower case); shingles are three words, as
notices may be five words short. A match is a span of at most ``STRETCH`` times
the template's words that holds ``THRESHOLD`` of its different shingles, so
words may be put in. For a template of n words a text is cut into blocks of
about n / 4 to n / 2 shingles (powers of two, shared by templates), and
``WINDOW`` neighbouring blocks from each block on are a window, so each such
span lies wholly inside a window, wherever it begins. The similarity that a
window with a match must have is known from the lengths; :func:`band_rows` takes
the widest bands for which such a window is retrieved with probability
``RECALL`` at least, and for a template of too few shingles each window with
one of them is looked at. The best span of a retrieved window is found exactly.

The templates are an argument, (license, text) pairs or a table of them whose
size is checked (:func:`template_rows`); only they are sent to the tasks. The
query takes :func:`production`. Texts never leave their task.

Defined results: a very long text is worked on whole, by the task that holds it;
null, empty and very short texts match nothing; a text may
match several templates, and each several times (``occurrences`` counts spans
that do not overlap; the best, first of equals, is reported); repeated rows are
reported each; an empty table gives no rows; other columns are dropped.
"""

from __future__ import annotations

import json
import os
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sftforge.llm.common import slim
from sftforge.llm.wordhash import chunks, mix, windows

SHINGLE = 3
THRESHOLD = 0.8
HASHES = 48
RECALL = 0.999
#: A place may be so many times as long as its template, by words put in.
STRETCH = 2
#: Templates of fewer different shingles are looked up directly, which costs less than hashes.
HASHED = 4
#: Blocks a window; all but one of them hold the longest place of a template.
WINDOW = 4 * STRETCH + 1

# Public notices by SPDX identifier.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except '
                   "in compliance with the License. You may obtain a copy of the License at "
                   "http://www.apache.org/licenses/LICENSE-2.0"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            'associated documentation files (the "Software"), to deal in the Software without restriction'),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
            "that the following conditions are met"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                "General Public License as published by the Free Software Foundation, either version 3 of the "
                "License, or (at your option) any later version."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
)

# Further notices as their licenses or stewards word them.
_FSF = ("This program is free software; you can redistribute it and/or modify it under the terms of the GNU {} as "
        "published by the Free Software Foundation; either version {} of the License, or (at your option) any later "
        "version.")
NOTICES = (
    ("MIT", "Licensed under the MIT License."),
    ("GPL-2.0", _FSF.format("General Public License", "2")),
    ("LGPL-2.1", _FSF.format("Lesser General Public License", "2.1")),
    ("LGPL-3.0", _FSF.format("Lesser General Public License", "3")),
    ("AGPL-3.0", _FSF.format("Affero General Public License", "3")),
    ("EPL-1.0", "All rights reserved. This program and the accompanying materials are made available under the terms of "
                "the Eclipse Public License v1.0 which accompanies this distribution"),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public "
                "License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/"),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0."),
    ("BSD", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("OFL-1.1", "This Font Software is licensed under the SIL Open Font License, Version 1.1."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights "
                "to this work."),
    *((f"CC-{kind}-4.0", f"This work is licensed under a Creative Commons {name} 4.0 "
       "International License.") for kind, name in (
        ("BY-SA", "Attribution-ShareAlike"), ("BY-NC", "Attribution-NonCommercial"), ("BY-ND", "Attribution-NoDerivatives"),
        ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"), ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives"))),
    *((id, f"SPDX-License-Identifier: {id}") for id in (
        "MIT", "ISC", "0BSD", "BSD-2-Clause", "BSD-3-Clause", "Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0",
        "AGPL-3.0", "MPL-2.0", "EPL-1.0", "EPL-2.0", "CC0-1.0", "CC-BY-4.0", "CC-BY-SA-4.0", "Unlicense", "Zlib", "BSL-1.0",
        "OFL-1.1")),
)
#: What is sent to every task is bounded: templates, and bytes of their texts.
MAX_TEMPLATES, MAX_TEMPLATE_BYTES = 2000, 8 << 20


def production() -> tuple:
    """``TEMPLATES``, ``NOTICES`` and the license bodies of ``licenses.jsonl``, as (SPDX id, text)."""
    with open(os.path.join(os.path.dirname(__file__), "licenses.jsonl"), encoding="utf-8") as f:
        bodies = [json.loads(line) for line in f]
    return TEMPLATES + NOTICES + tuple((x["license"], x["text"]) for x in bodies)


def template_rows(templates) -> list:
    """(license, text) of a sequence, or of a table with these columns, ordered
    by them; an error past the size bound, before any text is collected."""
    if isinstance(templates, DataFrame):
        size = templates.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("b")).head()
        n, size = size.n, size.b
    else:
        templates = [tuple(t) for t in templates]
        n, size = len(templates), sum(len(text.encode()) for _, text in templates)
    if n > MAX_TEMPLATES or size > MAX_TEMPLATE_BYTES:
        raise ValueError(f"{n} templates of {size} bytes are more than {MAX_TEMPLATES} or {MAX_TEMPLATE_BYTES} bytes")
    if isinstance(templates, DataFrame):
        return sorted(tuple(r) for r in templates.select("license", "text").collect())
    return templates


@dataclass(frozen=True)
class Template:
    license: str
    number: int
    n_words: int
    shingles: np.ndarray   # different ones, sorted
    least: np.ndarray      # minimum under each hash function
    block: int             # shingles a block
    rows: int              # hash functions a band; 0 if too few shingles for any


def band_rows(similarity: float, hashes: int = HASHES, recall: float = RECALL) -> int:
    """The most rows a band may have so that a pair of ``similarity`` shares a
    band of ``hashes`` functions with probability ``recall``; one at least."""
    fits = [r for r in range(1, 9) if 1 - (1 - similarity ** r) ** (hashes // r) >= recall]
    return max(fits, default=1)


def _hashed(x: np.ndarray, i: int) -> np.ndarray:
    return mix(x + np.uint64((i + 1) * 0x9E3779B97F4A7C15 % (1 << 64)))


def _text_shingles(w):
    """(shingle hash, its first word, its document) of a chunk's texts."""
    if len(w.doc) < SHINGLE:
        none = np.zeros(0, np.int64)
        return none.astype(np.uint64), none, none
    at = np.flatnonzero(w.doc[:len(w.doc) - SHINGLE + 1] == w.doc[SHINGLE - 1:])
    return windows(w.hash, SHINGLE)[at], at, w.doc[at]


def prepare(templates=TEMPLATES, threshold: float = THRESHOLD) -> list[Template]:
    import pyarrow as pa
    out = []
    for number, (license, text) in enumerate(template_rows(templates)):
        for _, _, w in chunks(pa.array([text]), folded=True):
            all_of, _, _ = _text_shingles(w)
            if not len(all_of):
                raise ValueError(f"template {number} has fewer than {SHINGLE} words")
            own, n = np.unique(all_of), len(w.hash)
            least = np.array([_hashed(own, i).min() for i in range(HASHES)])
            block = 1 << (-(-(STRETCH * n - SHINGLE) // (WINDOW - 1)) - 1).bit_length()
            similarity = threshold * len(own) / (WINDOW * block + (1 - threshold) * len(own))
            sure = len(own) >= HASHED and 1 - (1 - similarity) ** HASHES >= RECALL
            block = block if sure else max(block, 2)
            out.append(Template(license, number, n, own, least, block, band_rows(similarity) if sure else 0))
    return out


def _window_minima(w, shingle, doc, sizes: list[int]) -> dict:
    """For each block size (powers of two, ascending): the least hash of each
    window under each function, and the windows' owner, start and end."""
    per_doc = np.bincount(doc, minlength=w.n_docs)
    begin = np.concatenate([[0], np.cumsum(per_doc)[:-1]])
    out, below = {}, None
    for size in sizes:
        blocks = -(-per_doc // size)
        owner = np.repeat(np.arange(w.n_docs), blocks)
        zero = np.cumsum(blocks) - blocks
        within = np.arange(len(owner)) - zero[owner]
        start = begin[owner] + within * size
        end = np.minimum(start + WINDOW * size, (begin + per_doc)[owner])
        # a block of a larger size is made of whole blocks of the size below
        first = start if below is None else below[1][owner] + within * (size // below[0])
        steps, reach = [], 1  # of 1, 2, 4, ... blocks, as far as the document goes
        while reach < WINDOW:
            step = min(reach, WINDOW - reach)
            last = np.flatnonzero(owner[step:] != owner[:-step])
            steps.append((step, last))
            reach += step
        out[size] = np.empty((HASHES, len(owner)), np.uint64), owner, start, end, first, steps
        below = size, zero
    for i in range(HASHES):
        least = _hashed(shingle, i)
        for size in sizes:
            into, _, _, _, first, steps = out[size]
            least = np.minimum.reduceat(least, first)
            span = least
            for step, last in steps:
                wide = span.copy()
                np.minimum(span[:-step], span[step:], out=wide[:-step])
                wide[last] = span[last]
                span = wide
            into[i] = span
    return {size: x[:4] for size, x in out.items()}


def _best_span(shingle, where, width: int):
    """(different shingles, first, last place) of the span of at most ``width``
    shingles with the most different ones of ``shingle[where]``; of equals the
    shortest, then the first."""
    _, code = np.unique(shingle[where], return_inverse=True)
    places, code = where.tolist(), code.tolist()
    count, different, left, best = [0] * len(places), 0, 0, (0, 0, 0)
    for right, place in enumerate(places):
        different += count[code[right]] == 0
        count[code[right]] += 1
        while place - places[left] >= width or count[code[left]] > 1:
            count[code[left]] -= 1
            different -= count[code[left]] == 0
            left += 1
        best = min(best, (-different, place - places[left], places[left]))
    return -best[0], best[2], best[2] + best[1]


def _matches(w, templates: list[Template], threshold: float):
    """(document, template, containment, first word, last word) of the best span of each matching window."""
    shingle, first, doc = _text_shingles(w)
    if not len(shingle):
        return
    found = _window_minima(w, shingle, doc, sorted({t.block for t in templates}))
    for t in templates:
        least, owner, start, end = found[t.block]
        hit = np.zeros(len(owner), bool)
        if not t.rows:
            near = np.r_[0, np.cumsum(np.isin(shingle, t.shingles))]
            hit = near[end] > near[start]
        for band in range(HASHES // t.rows if t.rows else 0):
            rows = slice(band * t.rows, (band + 1) * t.rows)
            hit |= (least[rows] == t.least[rows, None]).all(axis=0)
        for at in np.flatnonzero(hit):
            where = np.flatnonzero(np.isin(shingle[start[at]:end[at]], t.shingles)) + start[at]
            if len(where) < threshold * len(t.shingles):
                continue
            held, a, z = _best_span(shingle, where, STRETCH * t.n_words - SHINGLE + 1)
            if held / len(t.shingles) >= threshold:
                yield int(owner[at]), t, held / len(t.shingles), int(first[a]), int(first[z]) + SHINGLE - 1


def scan(docs: DataFrame, templates=TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """One row for each document and template that it holds: doc_id, license,
    template, containment, the words (from 0) and bytes of the best span, and
    the number of spans."""
    known = prepare(templates, threshold)
    schema = ("doc_id long, license string, template int, containment double, first_word long, last_word long, "
              "first_byte long, end_byte long, occurrences long")

    def find(batches):
        import pyarrow as pa
        names = [x.split()[0] for x in schema.split(", ")]
        kinds = [pa.int64(), pa.string(), pa.int32(), pa.float64()] + [pa.int64()] * 5
        for b in batches:
            rows = []
            for at, _, w in chunks(b.column(1), folded=True):
                spans: dict = {}
                for doc, t, part, a, z in _matches(w, known, threshold):
                    spans.setdefault((doc, t.number), []).append((a, z, part))
                for (doc, number), found in sorted(spans.items()):
                    best, count, upto = None, 0, -1
                    for a, z, part in sorted(found):
                        if best is None or part > best[2]:
                            best = a, z, part
                        if a > upto:
                            count += 1
                        upto = max(upto, z)
                    a, z, part = best
                    zero, base = w.first[doc], w.offsets[doc]
                    rows.append((at + doc, known[number].license, number, part, a - zero, z - zero,
                                 w.start[a] - base, w.end[z] - base, count))
            if rows:
                cols = [list(c) for c in zip(*rows)]
                ids = b.column(0).take(pa.array(cols[0])).cast(pa.int64())
                yield pa.RecordBatch.from_arrays([ids, *(pa.array(c, k) for c, k in zip(cols[1:], kinds[1:]))],
                                                 names=names)

    return slim(docs, "doc_id", "text").mapInArrow(find, schema)
