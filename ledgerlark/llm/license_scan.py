"""Licence statements in documents: MinHash bands over text windows, verified by shingle containment."""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlark.llm.text import ALNUM, Minima, distinct, shingles, word_hashes

#: Words of a shingle; a shorter template is one shingle.
SHINGLE = 3
#: One minimum a band. Some window has a Jaccard similarity of 0.6 or more with a copy of the template: at most a
#: quarter is cut off and as much added. So 24 bands miss it with chance 0.4 ** 24 < 3e-10.
BANDS = 24
FILTER_BITS = 16
#: Words are scanned in parts of this many, each with a lap into the next.
PART = 1 << 14

# Wording of common licence statements.
STATEMENTS = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0",
    "MIT": "Released under the MIT License",
    "MIT-grant": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files, to deal in the Software without restriction"
    ),
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3",
    "GPL-notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation"
    ),
    "BSD-grant": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted "
        "provided that the following conditions are met"
    ),
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    "reserved": "All rights reserved",
}


class Templates:
    """Shingle sets of the templates and, by window size, the band keys that retrieve them."""

    def __init__(self, texts: Mapping[str, str]):
        self.names = sorted(name for name, text in texts.items() if text)
        words, bounds = word_hashes(pa.array([texts[n] for n in self.names], pa.string()), ALNUM)
        self.words = [words[a:b] for a, b in zip(bounds[:-1], bounds[1:])]
        self.sets = [distinct(shingles(w, SHINGLE)) for w in self.words]
        self.minima = Minima(BANDS)
        #: Words of a template: the window that looks for it has as many.
        self.sizes = sorted({len(w) for w in self.words if len(w)})
        self.bands: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        for size in self.sizes:
            own = [i for i, w in enumerate(self.words) if len(w) == size]
            least = np.stack([self.minima(self.sets[i]) for i in own])
            flags = np.zeros((BANDS, 1 << FILTER_BITS), dtype=bool)
            flags[np.arange(BANDS), least & ((1 << FILTER_BITS) - 1)] = True
            self.bands[size] = (np.array(own), least, flags)


def scan_words(
    words: np.ndarray, bounds: np.ndarray, templates: Templates, percent: int
) -> list[tuple[int, int, int, int, float]]:
    """(row, template, first word, words, containment) of the matches in a batch of texts.

    Windows run over all the texts' words at once; verification keeps to the text a window starts in.
    """
    out: list[tuple[int, int, int, int, float]] = []
    if len(words) < SHINGLE:
        return out
    hashes = shingles(words, SHINGLE)
    lap = max(templates.sizes, default=0)
    for part in range(0, len(hashes), PART):
        narrow = templates.minima.narrowed(hashes[part : part + PART + lap])
        least = np.add(np.multiply(templates.minima.a, narrow), templates.minima.b)
        for size in templates.sizes:
            if size < SHINGLE:
                continue
            own, keys, flags = templates.bands[size]
            span = size - SHINGLE + 1
            step = max(1, span // 4)
            starts = np.arange(0, len(narrow), step)
            cells = np.minimum.reduceat(least, starts, axis=1)
            window = cells.copy()
            for shift in range(1, min(-(-span // step), len(starts))):
                np.minimum(window[:, :-shift], cells[:, shift:], out=window[:, :-shift])
            hit = np.zeros(len(starts), dtype=bool)
            for band in range(BANDS):
                hit |= flags[band][window[band] & ((1 << FILTER_BITS) - 1)]
            for at in np.flatnonzero(hit).tolist():
                first = part + int(starts[at])
                row = int(np.searchsorted(bounds, first, side="right")) - 1
                lo, hi = max(bounds[row], first - step), min(bounds[row + 1] - SHINGLE + 1, first + span + step)
                for i in own[(window[:, at] == keys).any(axis=1)].tolist() if lo < hi else ():
                    inside = np.isin(hashes[lo:hi], templates.sets[i])
                    held = len(distinct(hashes[lo:hi][inside])) / len(templates.sets[i])
                    if 100 * held >= percent:
                        spots = lo + np.flatnonzero(inside)
                        start, length = int(spots[0] - bounds[row]), int(spots[-1] - spots[0]) + SHINGLE
                        out.append((row, i, start, length, held))
    return out


def merged(found: list[tuple[int, int, int, int, float]]) -> list[tuple[int, int, int, int, float]]:
    """One match, the fullest and then first, of overlapping ones of a row and template."""
    out: list[tuple[int, int, int, int, float]] = []
    for match in sorted(found, key=lambda m: (m[0], m[1], m[2], -m[4])):
        if out and out[-1][:2] == match[:2] and match[2] < out[-1][2] + out[-1][3]:
            if match[4] > out[-1][4]:
                out[-1] = match
        else:
            out.append(match)
    return out


def scan(
    docs: DataFrame,
    texts: Mapping[str, str] = STATEMENTS,
    doc_id: str = "doc_id",
    text: str = "text",
    percent: int = 80,
) -> DataFrame:
    """doc_id, license, first_word, words, containment: the places where a text holds a template.

    Words are runs of letters and digits, A-Z lower-cased. For each length of a template, windows of as
    many words, a quarter of them apart, are compared with it by BANDS MinHash bands; where one agrees, the
    window and a step on both sides must hold ``percent`` per cent of the template's shingles. The whole
    text is scanned, in place: nothing is shuffled and only the templates are shared.

    Null and empty texts hold nothing; rows that repeat are scanned each; a null doc_id is carried along.
    A template shorter than a shingle is not looked for, and one without words never matches. Columns other
    than the two named are ignored; empty input gives no rows.
    """
    templates = Templates(texts)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    doc_type = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {doc_type}, license string, first_word long, words long, containment double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                words, bounds = word_hashes(batch.column(1), ALNUM)
                found = merged(scan_words(words, bounds, templates, percent))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array([m[0] for m in found], pa.int64())),
                        pa.array([templates.names[m[1]] for m in found], pa.string()),
                        pa.array([m[2] for m in found], pa.int64()),
                        pa.array([m[3] for m in found], pa.int64()),
                        pa.array([m[4] for m in found], pa.float64()),
                    ],
                    names=["doc_id", "license", "first_word", "words", "containment"],
                )

    return rows.mapInArrow(run, schema)
