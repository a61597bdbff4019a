"""Licence scan: sparse TF-IDF cosine of headers and licence files to templates, and inheritance down directories.

A text is read as its sequence of words, so line breaks, comment marks and wrapping do not matter. Every window of it as long as a template
(or the whole text, if that is shorter) is compared with the template by the cosine of word and word-pair weights; the best template of
``LEAST`` or more, whose naming words all stand in the window, is the text's own licence. Weights come from the templates, a fixed and
small table. All windows are bounded from above at once by running sums (weights are linear in the words, and a norm is at least that
of words seen once each); only those whose bound reaches the best found so far are computed exactly, so no window is passed over.

A file without a licence takes that of the nearest directory at or above its own that has a licence file.

Null and empty texts have no licence of their own. A null path inherits nothing and gives nothing. A directory with several licence
files takes the best-scoring one, ties by licence name. Every row is judged by its own text, whatever id or path it shares, and
answered once. Very long texts are read in pieces that overlap by the longest template. Other columns are not read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewmill.llm.common import written

LEAST = 0.6
LICENCE_FILE = r"(?i)^(licen[cs]e|copying|notice|unlicense)([.-][a-z0-9.]+)?$"
BLOCK = 1 << 18  # words compared at a time
_WORD = re.compile(r"[a-z0-9]+(?:\.[0-9]+)*")

# Notices and opening passages by which the licences are commonly declared, and the words that name each.
TEMPLATES = (
    ("MIT", "Released under the MIT License.", "mit"),
    ("MIT", "This project is licensed under the MIT License.", "mit"),
    ("MIT", "SPDX-License-Identifier: MIT", "mit spdx"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:", ""),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.", ""),
    ("ISC", "SPDX-License-Identifier: ISC", "isc spdx"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0.", "apache"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.", "apache"),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION 1. Definitions. \"License\" shall mean the terms and conditions for use, reproduction, and distribution as defined by Sections 1 through 9 of this document.", "apache"),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0", "apache spdx"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3.", "gnu 3"),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.", "gnu 3"),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007 Copyright (C) 2007 Free Software Foundation, Inc. Everyone is permitted to copy and distribute verbatim copies of this license document, but changing it is not allowed. Preamble The GNU General Public License is a free, copyleft license for software and other kinds of works.", "gnu 3"),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-or-later", "gpl 3.0 spdx"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2.", "gnu 2"),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.", "gnu 2"),
    ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991 Copyright (C) 1989, 1991 Free Software Foundation, Inc. Everyone is permitted to copy and distribute verbatim copies of this license document, but changing it is not allowed. Preamble The licenses for most software are designed to take away your freedom to share and change it.", "gnu 2"),
    ("GPL-2.0", "SPDX-License-Identifier: GPL-2.0-only", "gpl 2.0 spdx"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0.", "cc by nc"),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.", "creative noncommercial"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0.", "cc by"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License.", "creative attribution"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0.", "cc by sa"),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", "creative sharealike"),
    ("BSD-3-Clause", "Released under the 3-Clause BSD License.", "3 bsd"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.", "neither endorse"),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause", "bsd 3 spdx"),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS", ""),
    ("BSD-2-Clause", "SPDX-License-Identifier: BSD-2-Clause", "bsd 2 spdx"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.", "mozilla"),
    ("MPL-2.0", "Mozilla Public License Version 2.0 1. Definitions 1.1. \"Contributor\" means each individual or legal entity that creates, contributes to the creation of, or owns Covered Software.", "mozilla"),
    ("MPL-2.0", "SPDX-License-Identifier: MPL-2.0", "mpl spdx"),
    ("Unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.", "unencumbered"),
)
Template = tuple[str, str, str]


def _grams(words: list[str]) -> Counter:
    return Counter(words) + Counter(zip(words, words[1:], strict=False))


class Matcher:
    """The templates' weights, and windows of word sequences against them."""

    def __init__(self, templates: tuple[Template, ...], least: float):
        self.least = least
        self.words = [_WORD.findall(text.lower()) for _, text, _ in templates]
        self.names = [name for name, _, _ in templates]
        self.musts = [frozenset(must.split()) for _, _, must in templates]
        counted = [_grams(words) for words in self.words]
        seen = Counter(term for grams in counted for term in grams)
        self.idf = {term: math.log((1 + len(counted)) / (1 + n)) + 1 for term, n in seen.items()}
        self.unknown = math.log(1 + len(counted)) + 1
        self.weights = []
        for grams in counted:
            norm = math.sqrt(sum((n * self.idf[term]) ** 2 for term, n in grams.items()))
            self.weights.append({term: n * self.idf[term] / norm for term, n in grams.items()})
        self.longest = max(map(len, self.words), default=1)

        self.number = {w: k for k, w in enumerate(sorted({w for words in self.words for w in words}))}
        self.outside = len(self.number)
        pairs = sorted({pair for words in self.words for pair in zip(words, words[1:], strict=False)})
        code = [self.number[a] * (self.outside + 1) + self.number[b] for a, b in pairs]
        order = np.argsort(code)
        self.codes = np.array(code, np.int64)[order]
        terms = [*self.number, None], [*(pairs[k] for k in order), None]
        self.squares = [np.array([self.idf.get(t, self.unknown) ** 2 for t in own]) for own in terms]
        self.gains = [[np.array([weights.get(t, 0.0) * self.idf.get(t, 0.0) for t in own]) for own in terms] for weights in self.weights]

    def cosine(self, window: list[str], template: int) -> float:
        own = {term: n * self.idf.get(term, self.unknown) for term, n in _grams(window).items()}
        norm = math.sqrt(sum(x * x for x in own.values()))
        return sum(x * own.get(term, 0.0) for term, x in self.weights[template].items()) / norm

    def best(self, texts: list[list[str]]) -> list[tuple[float, str] | None]:
        """Score and licence of the best window of every word sequence."""
        found: list[tuple[float, str] | None] = [None] * len(texts)
        every = [w for words in texts for w in words]
        if not every:
            return found
        ids = np.fromiter((self.number.get(w, self.outside) for w in every), np.int64, len(every))
        code = ids[:-1] * (self.outside + 1) + ids[1:]
        at = np.searchsorted(self.codes, code)
        known = np.append(self.codes, -1)[at] == code
        pair = np.where(known, at, len(self.codes))
        sizes = np.array([len(words) for words in texts])
        stop = np.repeat(np.cumsum(sizes), sizes)
        start = stop - np.repeat(sizes, sizes)
        place, owner = np.arange(len(every)), np.repeat(np.arange(len(texts)), sizes)

        def sums(single: np.ndarray, double: np.ndarray, end: np.ndarray, first: np.ndarray) -> np.ndarray:
            one, two = np.concatenate([[0.0], np.cumsum(single[ids])]), np.concatenate([[0.0], np.cumsum(double[pair])])
            return one[end] - one[first] + two[np.maximum(end - 1, first)] - two[first]

        open_windows = []
        for k, words in enumerate(self.words):
            first = np.flatnonzero((place + len(words) <= stop) | (place == start))
            end = np.minimum(first + len(words), stop[first])
            bound = sums(*self.gains[k], end, first) / np.sqrt(np.maximum(sums(*self.squares, end, first), 1e-12))
            good = np.flatnonzero(bound >= self.least - 1e-6)
            open_windows += [(-b, o, k, a, z) for b, o, a, z in zip(
                bound[good].tolist(), owner[first[good]].tolist(), first[good].tolist(), end[good].tolist(), strict=True)]
        for negative, o, k, a, z in sorted(open_windows):
            if found[o] is not None and -negative < found[o][0] - 1e-6:
                continue
            window = every[a:z]
            if self.musts[k].issubset(window):
                score = round(self.cosine(window, k), 6)
                if score >= self.least:
                    found[o] = max(found[o] or (0.0, ""), (score, self.names[k]))
        return found

    def pieces(self, text: str | None) -> Iterator[list[str]]:
        """Words in runs of ``BLOCK``, each with the last words before it."""
        matches = (m.group() for m in _WORD.finditer((text or "").lower()))
        carried: list[str] = []
        while block := list(islice(matches, BLOCK)):
            yield carried + block
            carried = (carried + block)[-(self.longest - 1):] if self.longest > 1 else []


def _judge(matcher: Matcher):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            best: list[tuple[float, str] | None] = [None] * batch.num_rows
            held, rows, size = [], [], 0

            def flush() -> None:
                for row, found in zip(rows, matcher.best(held), strict=True):
                    if found is not None:
                        best[row] = max(best[row] or (0.0, ""), found)

            for row, text in enumerate(batch.column("text")):
                for piece in matcher.pieces(text.as_py()):
                    held.append(piece)
                    rows.append(row)
                    size += len(piece)
                    if size >= BLOCK:
                        flush()
                        held, rows, size = [], [], 0
            flush()
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), batch.column("path"), pa.array([b and b[1] for b in best], pa.string()),
                pa.array([b and b[0] for b in best], pa.float64())], ["doc_id", "path", "licence", "score"])

    return run


def own_licence(docs: DataFrame, least: float = LEAST, templates: tuple[Template, ...] = TEMPLATES) -> DataFrame:
    """doc_id, path, licence and score of every row; null where its text declares none."""
    read = docs.select("doc_id", "path", "text")
    return read.mapInArrow(_judge(Matcher(templates, least)), f"doc_id {read.schema['doc_id'].dataType.simpleString()}, path string, licence string, score double")


def _directory(path: Column) -> Column:
    return F.regexp_replace(path, "/?[^/]*$", "")


def scan(docs: DataFrame, least: float = LEAST, templates: tuple[Template, ...] = TEMPLATES) -> DataFrame:
    """doc_id, path, licence, score, origin (own, inherited, none) and the directory inherited from, for every row of ``docs``."""
    own = written(own_licence(docs, least, templates).withColumn("directory", _directory(F.col("path"))), "licence-own")
    files = own.where(F.col("licence").isNotNull() & F.regexp_extract("path", "[^/]*$", 0).rlike(LICENCE_FILE)).groupBy(
        F.col("directory").alias("above")).agg(F.max(F.struct("score", "licence")).alias("given"))
    directories = own.select("directory").where("directory is not null").distinct()
    steps = F.split("directory", "/", -1)
    above = F.transform(F.sequence(F.lit(0), F.size(steps)), lambda k: F.array_join(F.slice(steps, F.lit(1), k), "/"))
    nearest = directories.select("directory", F.posexplode(above).alias("depth", "above")).join(files, "above").groupBy("directory").agg(
        F.max_by(F.struct("above", "given"), "depth").alias("nearest"))
    joined = own.join(written(nearest, "licence-nearest"), "directory", "left")
    mine = F.col("licence").isNotNull()
    return joined.select(
        "doc_id", "path",
        F.when(mine, F.col("licence")).otherwise(F.col("nearest.given.licence")).alias("licence"),
        F.when(mine, F.col("score")).otherwise(F.col("nearest.given.score")).alias("score"),
        F.when(mine, "own").when(F.col("nearest").isNotNull(), "inherited").otherwise("none").alias("origin"),
        F.when(~mine, F.col("nearest.above")).alias("inherited_from"))
