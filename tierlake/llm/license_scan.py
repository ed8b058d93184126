"""Licence notices in documents: MinHash bands over overlapping windows, then exact shingle containment.

Shingles of all texts of a slice stand in one row and are cut into blocks. Two neighbouring blocks are a window, so a notice
of at most one block lies in a window as a whole. A window retrieves the notices that share one of its minima (bands of one
hash). With the number of bands of ``bands_for`` a window that holds a notice is missed with a probability of at most
``MISS``. What is retrieved is verified: the share of the notice's shingles that the document has inside the window.

Licences quote one another, so matches compete for the shingles of a document: the match with the most shingles takes them,
and one that has at least half of its shingles from a better match of another licence isn't reported.

Notices are grouped by size, powers of two; minima of larger blocks are minima of smaller ones.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierlake.llm.common import PUNCTUATION, mix, shingles, text_slices

WORDS = 5
CONTAINMENT = 0.8
MISS = 1e-4
_FOUND = "row_id long, license string, containment double, first_shingle long, n_windows int"

# Public notices by SPDX identifier; several may share one.
NOTICES: list[tuple[str, str]] = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with '
        "the License. You may obtain a copy of the License at",
    ),
    (
        "BSD-2-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met:",
    ),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    (
        "GPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later "
        "version.",
    ),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation the '
        "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
        "persons to whom the Software is furnished to do so, subject to the following conditions:",
    ),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
]

_GNU = (
    "This {} is free software; you can redistribute it and/or modify it under the terms of the GNU {}General Public License as "
    "published by the Free Software Foundation; either version {} of the License, or (at your option) any later version."
)
_GNU_ONLY = (
    "This {} is free software; you can redistribute it and/or modify it under the terms of the GNU {}General Public License "
    "version {} as published by the Free Software Foundation."
)
_GNU_WORK = "This work is licensed under the GNU {}General Public License, version {}."
_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
    "conditions are met: {}Redistributions of source code must retain the above copyright notice, this list of conditions and "
    "the following disclaimer. {}Redistributions in binary form must reproduce the above copyright notice, this list of "
    "conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. "
)
_BSD_ADVERTS = (
    "All advertising materials mentioning features or use of this software must display the following acknowledgement: This "
    "product includes software developed by the organization. "
)
_BSD_NAMES = (
    "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
    "derived from this software without specific prior written permission."
)
_CREATIVE = "This work is licensed under a Creative Commons {} License."

# What tells further licences from those above and from one another.
TEMPLATES: list[tuple[str, str]] = [
    *NOTICES,
    *[
        (name, _BSD.format(*numbers) + rest.format(*numbers[2:]) + names)
        for numbers in (("1. ", "2. ", "3. ", "4. "), ("", "", "", ""))  # listed by number, and by bullet
        for name, rest, names in (("BSD-2-Clause", "", ""), ("BSD-3-Clause", "{}", _BSD_NAMES), ("BSD-4-Clause", "{}" + _BSD_ADVERTS + "{}", _BSD_NAMES))
    ],
    *[
        (name, text.format(*fields))
        for name, kind, version in (
            ("GPL-2.0", "", "2"),
            ("GPL-3.0", "", "3"),
            ("LGPL-2.0", "Library ", "2"),
            ("LGPL-2.1", "Lesser ", "2.1"),
            ("LGPL-3.0", "Lesser ", "3"),
            ("AGPL-3.0", "Affero ", "3"),
        )
        for text, fields in (
            (_GNU, ("library" if name[0] == "L" else "program", kind, version)),
            (_GNU_ONLY, ("library" if name[0] == "L" else "program", kind, version)),
            (_GNU_WORK, (kind, version)),
        )
    ],
    ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("LGPL-2.0", "GNU LIBRARY GENERAL PUBLIC LICENSE Version 2, June 1991"),
    ("LGPL-2.1", "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999"),
    ("LGPL-3.0", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("AGPL-3.0", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"),
    (
        "EPL-1.0",
        "All rights reserved. This program and the accompanying materials are made available under the terms of the Eclipse "
        "Public License v1.0 which accompanies this distribution",
    ),
    (
        "EPL-2.0",
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which "
        "is available at",
    ),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License v2.0"),
    (
        "BSL-1.0",
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and "
        'accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and '
        "transmit the Software",
    ),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0."),
    (
        "Zlib",
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable "
        "for any damages arising from the use of this software. Permission is granted to anyone to use this software for any "
        "purpose, including commercial applications, and to alter it and redistribute it freely",
    ),
    (
        "MIT-0",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation the '
        "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
        'persons to whom the Software is furnished to do so. THE SOFTWARE IS PROVIDED "AS IS"',
    ),
    (
        "0BSD",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted. "
        "THE SOFTWARE IS",
    ),
    ("CC0-1.0", "The person who associated a work with this deed has dedicated the work to the public domain"),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work"),
    ("CC0-1.0", "Creative Commons Legal Code CC0 1.0 Universal"),
    ("CC-BY-3.0", _CREATIVE.format("Attribution 3.0 Unported")),
    ("CC-BY-SA-3.0", _CREATIVE.format("Attribution-ShareAlike 3.0 Unported")),
    ("CC-BY-SA-4.0", _CREATIVE.format("Attribution-ShareAlike 4.0 International")),
    ("CC-BY-ND-4.0", _CREATIVE.format("Attribution-NoDerivatives 4.0 International")),
    ("CC-BY-NC-SA-4.0", _CREATIVE.format("Attribution-NonCommercial-ShareAlike 4.0 International")),
    ("CC-BY-NC-ND-4.0", _CREATIVE.format("Attribution-NonCommercial-NoDerivatives 4.0 International")),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."),
    ("CC-BY-NC-ND-4.0", "Licensed under CC BY-NC-ND 4.0."),
]


def shingle_set(text: str, words: int) -> np.ndarray:
    """Distinct shingle hashes of one text."""
    parts = [shingles(o, c, words, PUNCTUATION)[1] for _, o, c in text_slices(pa.array([text]))]
    return np.unique(np.concatenate(parts))


def bands_for(size: int, block: int, containment: float, miss: float) -> int:
    """Bands with which a window holding ``containment`` of a notice of ``size`` shingles is missed with at most ``miss``."""
    shared = math.ceil(containment * size)
    similarity = shared / (2 * block + size - shared)
    return max(1, math.ceil(math.log(miss) / math.log(1 - similarity))) if similarity < 1 else 1


def tightest(positions: np.ndarray, values: np.ndarray, count: int) -> tuple[int, int]:
    """First and last position of the first shortest run that has all ``count`` distinct values."""
    seen: dict[int, int] = defaultdict(int)
    places, codes, low = positions.tolist(), values.tolist(), 0
    best = (places[0], places[-1])
    for place, code in zip(places, codes, strict=True):
        seen[code] += 1
        while len(seen) == count and seen[codes[low]] > 1:
            seen[codes[low]] -= 1
            low += 1
        if len(seen) == count and place - places[low] < best[1] - best[0]:
            best = (places[low], place)
    return best


def joined(matches: list[tuple[int, int, int, int]]) -> list[tuple[int, int, int, int]]:
    """Matches (first, last, shingles, windows) of one notice, of those that overlap the one with the most shingles."""
    out: list[tuple[int, int, int, int]] = []
    reach = -1
    for first, last, count, n in sorted(matches):
        if first > reach:
            out.append((first, last, count, n))
        else:
            old = out[-1]
            out[-1] = (*max((old[:3], (first, last, count)), key=lambda m: m[2]), old[3] + n)
        reach = max(reach, last)
    return out


class Scanner:
    """Finds notices in packed texts."""

    def __init__(self, notices: list[tuple[str, str]], words: int, containment: float, miss: float) -> None:
        self.words, self.containment = words, containment
        self.names: list[str] = []
        self.sets: list[np.ndarray] = []
        for name, text in notices:
            found = shingle_set(text, words)
            if found.size:
                self.names.append(name)
                self.sets.append(found)
        self.of_block: dict[int, list[int]] = defaultdict(list)
        for i, found in enumerate(self.sets):
            self.of_block[1 << max(0, math.ceil(math.log2(found.size)))].append(i)
        #: per block size: all shingles of its notices, which notice has which, and how many each needs
        self.inverted: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        for block, of in self.of_block.items():
            known = np.unique(np.concatenate([self.sets[i] for i in of]))
            has = np.stack([np.isin(known, self.sets[i]) for i in of], axis=1)
            self.inverted[block] = known, has, containment * has.sum(axis=0)
        self.bands = {b: max(bands_for(self.sets[i].size, b, containment, miss) for i in of) for b, of in self.of_block.items()}
        most = max(self.bands.values(), default=0)
        salts = mix(np.arange(1, 2 * most + 1, dtype=np.uint64))
        self.factors, self.shifts = salts[:most] | np.uint64(1), salts[most:]
        #: per block size and band: the notices' minima, and their upper halves as flags
        self.minima: dict[tuple[int, int], np.ndarray] = {}
        self.flags: dict[tuple[int, int], np.ndarray] = {}
        for block, of in self.of_block.items():
            for band in range(self.bands[block]):
                least = np.array([self._hash(self.sets[i], band).min() for i in of], dtype=np.uint32)
                flags = np.zeros(1 << 16, dtype=bool)
                flags[least >> np.uint32(16)] = True
                self.minima[block, band], self.flags[block, band] = np.unique(least), flags

    def _hash(self, values: np.ndarray, band: int) -> np.ndarray:
        return ((values * self.factors[band] + self.shifts[band]) >> np.uint64(32)).astype(np.uint32)

    def _retrieve(self, values: np.ndarray) -> dict[int, np.ndarray]:
        """Numbers of the windows that share a minimum with a notice, by block size."""
        found: dict[int, list[np.ndarray]] = defaultdict(list)
        for band in range(len(self.factors)):
            least, size = self._hash(values, band), 1
            for block in sorted(self.of_block):
                while size < block:
                    if least.size % 2:
                        least = np.append(least, np.uint32(0xFFFFFFFF))
                    least = np.minimum(least[0::2], least[1::2])
                    size *= 2
                if band >= self.bands[block]:
                    continue
                window = np.minimum(least, np.append(least[1:], np.uint32(0xFFFFFFFF)))
                near = np.flatnonzero(self.flags[block, band][window >> np.uint32(16)])
                found[block].append(near[np.isin(window[near], self.minima[block, band])])
        return {block: np.unique(np.concatenate(parts)) for block, parts in found.items()}

    def scan(self, offsets: np.ndarray, content: np.ndarray) -> list[tuple[int, str, float, int, int]]:
        """(row, licence, containment, first shingle, windows) of every match, best window first seen; rows in order."""
        rows, values = shingles(offsets, content, self.words, PUNCTUATION)
        if not values.size:
            return []
        begin = np.searchsorted(rows, np.arange(offsets.size - 1))
        #: per row and notice: windows' matches as (first position, last, distinct shingles, windows)
        matches: dict[int, dict[int, list[tuple[int, int, int, int]]]] = defaultdict(lambda: defaultdict(list))
        for block, windows in self._retrieve(values).items():
            for window in windows.tolist():
                low, high = window * block, min((window + 2) * block, values.size)
                part, of = values[low:high], rows[low:high]
                known, has, needed = self.inverted[block]
                at = np.minimum(np.searchsorted(known, part), known.size - 1)
                there = np.unique(at[known[at] == part])
                for k in np.flatnonzero(has[there].sum(axis=0) >= needed).tolist():
                    i = self.of_block[block][k]
                    held = (known[at] == part) & has[at, k]
                    for row in np.unique(of[held]).tolist():
                        mine = np.flatnonzero(held & (of == row))
                        count = np.unique(part[mine]).size
                        if count / self.sets[i].size >= self.containment:
                            first, last = tightest(mine, part[mine], count)
                            matches[row][i].append((low + first, low + last, count, 1))
        best: dict[tuple[int, str], tuple[float, int, int]] = {}
        for row, found in matches.items():
            places = [(-count, -count / self.sets[i].size, i, first, last, n) for i, m in found.items() for first, last, count, n in joined(m)]
            start = min(p[3] for p in places)
            owner = np.full(max(p[4] for p in places) + 1 - start, "", dtype=object)
            for _, share, i, first, last, n in sorted(places):
                name = self.names[i]
                spots = first - start + np.flatnonzero(np.isin(values[first : last + 1], self.sets[i]))
                taken = (owner[spots] != "") & (owner[spots] != name)
                if 2 * np.count_nonzero(taken) >= spots.size:
                    continue
                owner[spots[~taken]] = name
                at = first - int(begin[row])
                old = best.get((row, name), (0.0, at, 0))
                best[row, name] = (max(old[0], -share), min(old[1], at), old[2] + n)
        return [(row, name, *value) for (row, name), value in sorted(best.items())]


def scan_licenses(
    docs: DataFrame,
    notices: list[tuple[str, str]] | None = None,
    key: str = "doc_id",
    text: str = "text",
    words: int = WORDS,
    containment: float = CONTAINMENT,
    miss: float = MISS,
) -> DataFrame:
    """One row per document and licence found: ``row_id, license, containment, first_shingle, n_windows``.

    Words are runs of ASCII letters, digits and other non-ASCII bytes, A-Z lower-cased. Whole texts are scanned. Null texts,
    texts without words and documents without a notice give no rows; of licences that claim the same passage the one with most of
    it is reported. A text or notice shorter than ``words`` is one shingle.
    Repeated rows are reported each; keys may be null; an empty table or list of notices gives no rows.
    """
    scanner = Scanner(TEMPLATES if notices is None else notices, words, containment, miss)

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, offsets, content in text_slices(batch.column(1)):
                found = scanner.scan(offsets, content)
                if found:
                    row, name, share, at, windows = (list(c) for c in zip(*found, strict=True))
                    ids = batch.column(0).take(pa.array(np.array(row) + first))
                    columns = [ids, pa.array(name), pa.array(share), pa.array(at, pa.int64()), pa.array(windows, pa.int32())]
                    yield pa.RecordBatch.from_arrays(columns, names=["row_id", "license", "containment", "first_shingle", "n_windows"])

    rows = docs.select(F.col(key).cast("long").alias("row_id"), F.col(text).cast("string").alias("body"))
    return rows.mapInArrow(scan, _FOUND)
