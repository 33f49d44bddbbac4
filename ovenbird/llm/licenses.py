"""License scan: winnowed template fingerprints, then banded alignment.

Templates are cut into words (runs of letters and digits, lower-case) and their
``GRAM``-word shingles are winnowed: of every ``WINDOW`` adjacent shingles the
one of the smallest hash is kept.  An inverted index maps the kept hashes to
(template, position).  Every shingle of a document is looked up, so a document
that shares ``GRAM + WINDOW - 1`` adjacent words with a template shares a
fingerprint and becomes a candidate.  Its hits on about one diagonal give a
place; a local alignment in a band around the diagonal (word by word, with
insertions, deletions and changes) gives the matched share of the template's
words and the span in the document.

A match is reported from ``coverage`` on.  Matches of different templates that
overlap by more than half of the shorter one exclude each other: the one with
more matched words stays, then the higher coverage, then the earlier template.

The templates are broadcast; their total size is checked (``MAX_BYTES``).

Defined results: a null or empty text has no match; a license that occurs
several times in a text is reported for each place, also where copies adjoin;
repeated rows are scanned each; an empty table, or no template, gives no rows; a
very long text is scanned whole; other columns are not read.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import words
from .common import batches, flat_bytes, id_text

GRAM, WINDOW = 3, 2
MAX_BYTES = 32 << 20
MATCH, CHANGE, GAP = 2, -1, -1

#: Usual notices of widely used licenses (id, text).
TEMPLATES = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "This project is licensed under the terms of the MIT license."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
            "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
            "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
            "following conditions: The above copyright notice and this permission notice shall be included in all "
            "copies or substantial portions of the Software."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                   "compliance with the License. You may obtain a copy of the License at "
                   "http://www.apache.org/licenses/LICENSE-2.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0-or-later", "This program is free software: you can redistribute it and/or modify it under the terms of the "
                         "GNU General Public License as published by the Free Software Foundation, either version 3 of "
                         "the License, or (at your option) any later version."),
    ("GPL-2.0-or-later", "This program is free software; you can redistribute it and/or modify it under the terms of the "
                         "GNU General Public License as published by the Free Software Foundation; either version 2 of "
                         "the License, or (at your option) any later version."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("BSD", "Released under the BSD License."),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted "
                     "provided that the following conditions are met: Redistributions of source code must retain the "
                     "above copyright notice, this list of conditions and the following disclaimer."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
                "was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights "
                "to this work."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
]


def text_words(text: str) -> np.ndarray:
    raw = words.LOWER[np.frombuffer(text.encode("utf-8"), np.uint8)]
    starts, ends, _ = words.spans(raw, np.array([0, len(raw)]), letters=True)
    return words.hashes(raw, starts, ends)


def winnow(h: np.ndarray) -> list[int]:
    """Places of the shingle hashes that are the smallest (rightmost of equal
    ones) of some ``WINDOW`` adjacent ones."""
    if len(h) <= WINDOW:
        return [int(len(h) - 1 - np.argmin(h[::-1]))] if len(h) else []
    kept = {i + WINDOW - 1 - int(np.argmin(h[i:i + WINDOW][::-1])) for i in range(len(h) - WINDOW + 1)}
    return sorted(kept)


@dataclass
class Index:
    names: list[str]
    words: list[np.ndarray]
    grams: np.ndarray                       # sorted fingerprints
    places: list[list[tuple[int, int]]]     # (template, position) of each


def build_index(templates) -> Index:
    if sum(len(t.encode()) for _, t in templates) > MAX_BYTES:
        raise ValueError("the templates exceed the size that may be broadcast")
    found: dict[int, list[tuple[int, int]]] = {}
    kept = [text_words(t) for _, t in templates]
    for k, w in enumerate(kept):
        # A template of fewer words than a shingle can't be found by shingles.
        if 0 < len(w) < GRAM:
            raise ValueError(f"template too short: {templates[k][1]!r}")
        h = words.shingle_hashes(w, GRAM)
        for i in winnow(h):
            found.setdefault(int(h[i]), []).append((k, i))
    grams = np.array(sorted(found), np.uint64)
    return Index([n for n, _ in templates], kept, grams, [found[int(g)] for g in grams])


def align(a: list[int], b: list[int], diagonal: int, band: int) -> tuple[int, int, int]:
    """Best local alignment of words ``a`` with ``b`` where places in b minus
    places in a stay within ``band`` of ``diagonal``: (matched words, first,
    end in b).  Of equally good ones the one nearest the diagonal, since a
    neighbouring copy may lie within the band."""
    width = 2 * band + 1
    empty = (0, 0, -1, -1)  # score, matched, first and end in b
    above, best, nearest = [empty] * (width + 2), empty, 0
    for i, x in enumerate(a):
        row = [empty] * (width + 2)
        for d in range(1, width + 1):
            j = i + diagonal + d - 1 - band
            if not 0 <= j < len(b):
                continue
            score, matched, first, end = above[d]
            if x == b[j]:
                cell = (score + MATCH, matched + 1, first if score > 0 else j, j + 1)
            else:
                cell = (score + CHANGE, matched, first, end)
            for other in (above[d + 1], row[d - 1]):
                if other[0] + GAP > cell[0]:
                    cell = (other[0] + GAP, *other[1:])
            if cell[0] > 0:
                row[d] = cell
                apart = abs(d - 1 - band)
                if cell[0] > best[0] or (cell[0] == best[0] and apart < nearest):
                    best, nearest = cell, apart
        above = row
    return best[1:]


def _text_matches(index: Index, h: np.ndarray, hits: list[tuple[int, int]], least: float) -> list[tuple[int, int, int, int]]:
    """hits: (place in the text, number of the fingerprint).  The matches of one
    text: (template, matched words, first word, end word)."""
    by: dict[int, list[tuple[int, int]]] = {}
    for p, g in hits:
        for t, q in index.places[g]:
            by.setdefault(t, []).append((p, p - q))
    found = []
    for t, places in by.items():
        template = index.words[t]
        band = max(3, len(template) // 8)
        places.sort()
        open_: list[list[int]] = []  # first diagonal, first place of a group of hits
        for p, diagonal in places:
            open_ = [g for g in open_ if p - g[1] <= len(template) + band]
            if any(abs(diagonal - g[0]) <= band for g in open_):
                continue
            open_.append([diagonal, p])
            low = max(0, diagonal - 2 * band)
            part = h[low:diagonal + len(template) + 2 * band].tolist()
            matched, first, end = align(template.tolist(), part, diagonal - low, 2 * band)
            if matched >= least * len(template):
                found.append((t, matched, low + first, low + end))
    found.sort(key=lambda m: (-m[1], -m[1] / len(index.words[m[0]]), m[0], m[2]))
    kept: list[tuple[int, int, int, int]] = []  # (first, end, template, matched), sorted
    longest = max((m[3] - m[2] for m in found), default=0)
    for t, matched, first, end in found:
        near = kept[bisect_left(kept, (first - longest,)):bisect_left(kept, (end,))]
        if all(2 * (min(end, e) - max(first, f)) <= min(end - first, e - f) for f, e, _, _ in near):
            insort(kept, (first, end, t, matched))
    return [(t, matched, first, end) for first, end, t, matched in kept]


def scan(raw: np.ndarray, off: np.ndarray, index: Index, least: float) -> list[tuple[int, int, int, int, int]]:
    """(text, template, matched words, first byte, end byte) of all matches."""
    low = words.LOWER[raw]
    starts, ends, of = words.spans(low, off, letters=True)
    if len(starts) < GRAM or not len(index.grams):
        return []
    h = words.hashes(low, starts, ends)
    grams = words.shingle_hashes(h, GRAM)
    at = np.minimum(np.searchsorted(index.grams, grams), len(index.grams) - 1)
    hit = np.flatnonzero((index.grams[at] == grams) & (of[:-GRAM + 1] == of[GRAM - 1:]))
    out = []
    for part in np.split(hit, np.flatnonzero(np.diff(of[hit])) + 1) if len(hit) else []:
        text = int(of[part[0]])
        begin, end = np.searchsorted(of, [text, text + 1])
        matches = _text_matches(index, h[begin:end], list(zip((part - begin).tolist(), at[part].tolist(), strict=True)), least)
        out += [(text, t, n, int(starts[begin + f] - off[text]), int(ends[begin + e - 1] - off[text])) for t, n, f, e in matches]
    return out


def find_licenses(docs: DataFrame, templates=None, coverage: float = 0.85) -> DataFrame:
    """Rows (doc_id, license, template, matched_words, coverage, span_start,
    span_end, span_text): spans in code points of the text, end excluded."""
    index = build_index(TEMPLATES if templates is None else list(templates))
    shared = docs.sparkSession.sparkContext.broadcast(index)
    rows = id_text(docs)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for b in batches(it, 2 << 20):
            raw, off = flat_bytes(b.column(1))
            found = scan(raw, off, index, coverage)
            if not found:
                continue
            spans = []
            for text, _, _, s, e in found:
                data = raw[off[text]:off[text] + e].tobytes()
                start = len(data[:s].decode())
                inside = data[s:].decode()
                spans.append((start, start + len(inside), inside))
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array([x[0] for x in found])), pa.array([index.names[x[1]] for x in found]),
                 pa.array([x[1] for x in found], pa.int32()), pa.array([x[2] for x in found], pa.int32()),
                 pa.array([x[2] / len(index.words[x[1]]) for x in found]),
                 pa.array([x[0] for x in spans], pa.int64()), pa.array([x[1] for x in spans], pa.int64()),
                 pa.array([x[2] for x in spans])],
                names=["doc_id", "license", "template", "matched_words", "coverage", "span_start", "span_end", "span_text"])
    return rows.mapInArrow(run, f"doc_id {rows.dtypes[0][1]}, license string, template int, matched_words int, "
                                "coverage double, span_start bigint, span_end bigint, span_text string")
