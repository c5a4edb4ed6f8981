"""License scan: winnowed fingerprints of templates, then banded alignment.

A text's words that any template has become small numbers. Runs of ``GRAM`` such
words are hashed and winnowed (the least of each ``WINDOW`` neighbours is kept),
so a common stretch of ``GRAM + WINDOW - 1`` words always shares a fingerprint.
An inverted index from fingerprint to template and position gives candidates
with an offset; each candidate place is then aligned with its template inside a
band around that offset, which finds the matched words and their span despite
changed, missing or added words; what lies before and behind a place is searched
again. Of places that overlap, the one stays that has most words in common with
its template beyond those that differ. The index is as large as the templates,
so every task holds it.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patronage.llm.common import batches_of

GRAM, WINDOW, BAND = 3, 2, 8
#: Least share of a template's words, in thousandths.
COVER = 800

#: Short notices as they are commonly written, by SPDX name (fixed values).
TEMPLATES = {
    "AGPL-3.0": "This work is licensed under the GNU Affero General Public License, version 3.",
    "AGPL-3.0-or-later": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                         "Affero General Public License as published by the Free Software Foundation, either version 3 of "
                         "the License, or (at your option) any later version.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-notice": "you may not use this file except in compliance with the License. You may obtain a copy of the "
                         "License at http://www.apache.org/licenses/LICENSE-2.0",
    "BSL-1.0": "Distributed under the Boost Software License, Version 1.0.",
    "BSD-3-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted "
                    "provided that the following conditions are met",
    "CC-BY-3.0": "This work is licensed under a Creative Commons Attribution 3.0 Unported License.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-4.0-short": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-NC-4.0-notice": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    "CC-BY-NC-ND-4.0": "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 "
                       "International License.",
    "CC-BY-NC-ND-4.0-short": "Licensed under CC BY-NC-ND 4.0.",
    "CC-BY-NC-SA-4.0": "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 "
                       "International License.",
    "CC-BY-NC-SA-4.0-short": "Licensed under CC BY-NC-SA 4.0.",
    "CC-BY-ND-4.0": "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.",
    "CC-BY-ND-4.0-short": "Licensed under CC BY-ND 4.0.",
    "CC-BY-SA-3.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 3.0 Unported License.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC-BY-SA-4.0-short": "Licensed under CC BY-SA 4.0.",
    "CC0-1.0": "This work is dedicated to the public domain under the Creative Commons CC0 1.0 Universal Public Domain "
               "Dedication.",
    "EPL-2.0": "This program and the accompanying materials are made available under the terms of the Eclipse Public License "
               "2.0",
    "GFDL-1.3-or-later": "Permission is granted to copy, distribute and/or modify this document under the terms of the GNU "
                         "Free Documentation License, Version 1.3 or any later version published by the Free Software "
                         "Foundation",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-2.0-or-later": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU "
                        "General Public License as published by the Free Software Foundation; either version 2 of the "
                        "License, or (at your option) any later version.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-or-later": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                        "General Public License as published by the Free Software Foundation, either version 3 of the "
                        "License, or (at your option) any later version.",
    "ISC-notice": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
                  "hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "LGPL-2.1": "This work is licensed under the GNU Lesser General Public License, version 2.1.",
    "LGPL-2.1-or-later": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU "
                         "Lesser General Public License as published by the Free Software Foundation; either version 2.1 of "
                         "the License, or (at your option) any later version.",
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "LGPL-3.0-or-later": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                         "Lesser General Public License as published by the Free Software Foundation, either version 3 of "
                         "the License, or (at your option) any later version.",
    "MIT": "Released under the MIT License.",
    "MIT-notice": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
                  "associated documentation files (the \"Software\"), to deal in the Software without restriction",
    "MPL-1.1": "The contents of this file are subject to the Mozilla Public License Version 1.1",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
}
#: ASCII bytes that are no letter or digit part words.
APART = bytes(c if c > 127 or chr(c).isalnum() else 32 for c in range(256))


def words(text: str | None) -> list[bytes]:
    return (text or "").encode().lower().translate(APART).split()


class Index:
    """Templates as word numbers, and their fingerprints."""

    def __init__(self, templates: dict[str, str]):
        self.names = sorted(templates)
        said = [words(templates[n]) for n in self.names]
        self.number = {w: i for i, w in enumerate(sorted({w for s in said for w in s}))}
        self.said = [np.array([self.number[w] for w in s], np.int64) for s in said]
        self.places: dict[int, list[tuple[int, int]]] = defaultdict(list)
        for t, s in enumerate(self.said):
            at, h = self.fingerprints(s)
            for i, x in zip(at.tolist(), h.tolist(), strict=True):
                self.places[x].append((t, i))
        self.known = np.array(sorted(self.places), np.int64)

    def fingerprints(self, s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions and hashes of the winnowed runs; words of no template (-1) are in none."""
        n = len(s) - GRAM + 1
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        base, h, ok = len(self.number) + 1, np.zeros(n, np.uint64), np.ones(n, bool)
        for k in range(GRAM):
            h = h * np.uint64(base) + s[k:k + n].astype(np.uint64)
            ok &= s[k:k + n] >= 0
        h = (h * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(2)  # scattered, and below the mark for "none"
        h = np.where(ok, h.astype(np.int64), np.int64(1) << 62)
        if n <= WINDOW:
            keep = np.array([int(h.argmin())])
        else:
            seen = np.lib.stride_tricks.sliding_window_view(h, WINDOW)
            keep = np.unique(seen.argmin(axis=1) + np.arange(len(seen)))
        keep = keep[ok[keep]]
        return keep, h[keep]

    def scan(self, text: str | None) -> list[tuple[str, int, int, int, int]]:
        """(template, first word, last word, words matched, thousandths covered)."""
        get = self.number.get
        s = np.array([get(w, -1) for w in words(text)], np.int64)
        at, h = self.fingerprints(s)
        hit = np.nonzero(np.isin(h, self.known))[0]
        if not len(hit):
            return []
        shifts: dict[int, list[int]] = defaultdict(list)
        for k in hit.tolist():
            for t, i in self.places[int(h[k])]:
                shifts[t].append(int(at[k]) - i)
        found = []
        for t, starts in shifts.items():
            starts.sort()
            group: list[int] = []
            last = -1
            for x in [*starts, None]:
                if group and (x is None or x - group[0] > BAND):
                    got = self.places_in(s, t, max(0, group[0] - BAND, last + 1), group[-1] + len(self.said[t]) + BAND)
                    found += [(self.names[t], *g) for g in got]
                    last = max([last, *(g[1] for g in got)])
                    group = []
                if x is not None:
                    group.append(x)
        return self.best(found)

    def best(self, found: list[tuple[str, int, int, int, int]]) -> list[tuple[str, int, int, int, int]]:
        """The places without those that share half of the shorter one's words
        with a better one: a word of the template or of the place that the other
        has not takes off one of the matched words."""
        def worth(g: tuple[str, int, int, int, int]) -> int:
            size = len(self.said[self.names.index(g[0])])
            return g[3] - (size - g[3]) - (g[2] - g[1] + 1 - g[3])
        out: list[tuple[str, int, int, int, int]] = []
        for g in sorted(found, key=lambda g: (-worth(g), -g[3], g)):
            if not any(2 * (min(g[2], o[2]) - max(g[1], o[1]) + 1) >= min(g[2] - g[1], o[2] - o[1]) + 1 for o in out):
                out.append(g)
        return sorted(out, key=lambda g: (g[0], g[1]))

    def places_in(self, s: np.ndarray, t: int, first: int, past: int) -> list[tuple[int, int, int, int]]:
        """Places of a template that cover it well enough, within text words first to past."""
        todo, out = [(first, min(past, len(s)))], []
        while todo:
            first, past = todo.pop()
            there = np.isin(self.said[t], s[first:past]).sum() if past > first else 0  # at least as many as can match
            if 1000 * there // len(self.said[t]) < COVER:
                continue
            got = self.align(s, t, first, past)
            if got and got[3] >= COVER:
                out.append(got)
                todo += [(first, got[0]), (got[1] + 1, past)]
        return out

    def align(self, s: np.ndarray, t: int, first: int, past: int) -> tuple[int, int, int, int] | None:
        """Most template words matched in order within text words first to past,
        staying in a band of offsets; of equal alignments the shortest span, and
        of these the last."""
        a, b = self.said[t].tolist(), s[first:past].tolist()
        width = len(b) - len(a)
        # row[j]: (matches, start) of the best alignment of a[:i] with b[:j]; start is of its first match.
        row: list[tuple[int, int]] = [(0, -1)] * (len(b) + 1)
        top = (0, 0, 0)  # matches, start - end, start
        for i, w in enumerate(a):
            low, high = max(0, i - BAND), min(len(b), i + max(0, width) + BAND)
            new = list(row)
            for j in range(low, high):
                best = max(new[j], row[j + 1])
                if b[j] == w:
                    m, start = row[j]
                    start = start if m else j
                    best = max(best, (m + 1, start))
                    top = max(top, (m + 1, start - j, start))
                new[j + 1] = best
            row = new
        m, span, start = top
        return (first + start, first + start - span, m, 1000 * m // len(a)) if m else None


def scan_licenses(docs: DataFrame, templates: dict[str, str] | None = None) -> DataFrame:
    """doc_id, license, first_word, last_word, n_matched, cover_permille: one row
    for each place of a text that covers a template well enough, and better than
    the other templates' places that it overlaps.

    Words are runs of ASCII letters and digits and other bytes, lower-cased.
    Null and empty texts match nothing; a null doc_id is kept; repeated rows
    repeat; an empty table gives no rows; other columns are not read. Texts are
    read whole; no shuffle.
    """
    batches_of(docs.sparkSession)
    said = dict(TEMPLATES if templates is None else templates)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(said)
        for b in batches:
            out = [(d, *x) for d, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)
                   for x in index.scan(t)]
            cols = list(zip(*out, strict=True)) or [()] * 6
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.string()),
                 *[pa.array(c, pa.int32()) for c in cols[2:]]],
                names=["doc_id", "license", "first_word", "last_word", "n_matched", "cover_permille"])
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        run, "doc_id long, license string, first_word int, last_word int, n_matched int, cover_permille int")
