"""Licences named right on standard texts, and every window against plain arithmetic; nothing is shared with the module."""

from __future__ import annotations

import math
import random
import re
import textwrap
from collections import Counter

import pytest

from reviewmill.llm import license

MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."""
BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
{}
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES ARE DISCLAIMED."""
THIRD = "\n3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.\n"
GPL = "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version {} of the License, or (at your option) any later version.\n\nThis program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY."
STANDARD = [
    ("MIT", "MIT License\n\nCopyright (c) 2020 Some Body\n\n" + MIT), ("MIT", MIT),
    ("BSD-3-Clause", "BSD 3-Clause License\n\nCopyright (c) 2020, Some Body\nAll rights reserved.\n\n" + BSD.format(THIRD)), ("BSD-3-Clause", BSD.format(THIRD)),
    ("BSD-2-Clause", "Copyright (c) 2020, Some Body\n\n" + BSD.format("")),
    ("GPL-2.0", GPL.format(2)), ("GPL-3.0", GPL.format(3)),
    ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE\n Version 2, June 1991\n\nCopyright (C) 1989, 1991 Free Software Foundation, Inc.,\n51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA\nEveryone is permitted to copy and distribute verbatim copies\nof this license document, but changing it is not allowed.\n\nPreamble\n\nThe licenses for most software are designed to take away your\nfreedom to share and change it."),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE\n Version 3, 29 June 2007\n\nCopyright (C) 2007 Free Software Foundation, Inc. <https://fsf.org/>\nEveryone is permitted to copy and distribute verbatim copies\nof this license document, but changing it is not allowed.\n\nPreamble\n\nThe GNU General Public License is a free, copyleft license for\nsoftware and other kinds of works."),
    ("Apache-2.0", "Copyright 2020 Some Body\n\nLicensed under the Apache License, Version 2.0 (the \"License\");\nyou may not use this file except in compliance with the License.\nYou may obtain a copy of the License at\n\n    http://www.apache.org/licenses/LICENSE-2.0\n\nUnless required by applicable law or agreed to in writing, software\ndistributed under the License is distributed on an \"AS IS\" BASIS,\nWITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."),
    ("Apache-2.0", "                                 Apache License\n                           Version 2.0, January 2004\n                        http://www.apache.org/licenses/\n\n   TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION\n\n   1. Definitions.\n\n      \"License\" shall mean the terms and conditions for use, reproduction,\n      and distribution as defined by Sections 1 through 9 of this document."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. 2.0. If a copy of the MPL was not distributed with this\nfile, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("ISC", "ISC License\n\nCopyright (c) 2020, Some Body\n\nPermission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee is hereby granted, provided that the above\ncopyright notice and this permission notice appear in all copies."),
    ("Unlicense", "This is free and unencumbered software released into the public domain.\n\nAnyone is free to copy, modify, publish, use, compile, sell, or\ndistribute this software, either in source code form or as a compiled\nbinary, for any purpose, commercial or non-commercial, and by any\nmeans."),
]
PROSE = "the driver showed his license at the station and under the bridge some words of a general public were heard"
DOCS = "doc_id long, path string, text string, licence string, score double, directory string"


def frame(spark, rows):
    return spark.createDataFrame([(i, p, t, "x", 0.0, "x") for i, p, t in rows], DOCS).repartition(3)


def dressed(text, k):
    """As a file, wrapped in a comment, or inside other text."""
    if k == 0:
        return text
    lines = [line for part in text.split("\n") for line in (textwrap.wrap(part, 37) or [""])]
    if k == 1:
        return "\n".join(f" * {line}" for line in lines)
    return PROSE + "\n" + "\n".join(f"# {line}" for line in lines) + "\nimport os\n" + PROSE * 5


def test_standard_texts_are_named_right(spark):
    rows = [(3 * n + k, f"d{n}/x", dressed(text, k)) for n, (_, text) in enumerate(STANDARD) for k in range(3)]
    rows += [(900, "p/x", PROSE * 40), (901, "p/y", None), (902, "p/z", ""), (903, "p/w", "SPDX-License-Identifier: Zlib"), (904, "p/v", "Released under the Foo License.")]
    got = {r.doc_id: r.licence for r in license.own_licence(frame(spark, rows)).collect()}
    assert got == {3 * n + k: name for n, (name, _) in enumerate(STANDARD) for k in range(3)} | {k: None for k in range(900, 905)}


def test_every_template_finds_itself():
    matcher = license.Matcher(license.TEMPLATES, license.LEAST)
    for name, text, _ in license.TEMPLATES:
        score, found = matcher.best([list(words) for words in matcher.pieces(text)])[0]
        assert found == name and score == 1.0


def test_rows_that_share_an_id_are_judged_apart(spark):
    mit = "Released under the MIT License."
    rows = [(None, None, mit), (None, None, "plain"), (5, "a/x", mit), (5, "a/x", "plain"), (6, "a/y", mit), (6, "a/y", mit)]
    got = sorted(((r.doc_id, r.path, r.licence, r.origin) for r in license.scan(frame(spark, rows)).collect()), key=repr)
    assert got == sorted([
        (None, None, "MIT", "own"), (None, None, None, "none"), (5, "a/x", "MIT", "own"), (5, "a/x", None, "none"), (6, "a/y", "MIT", "own"), (6, "a/y", "MIT", "own")], key=repr)


def brute(text, templates, least):
    def words(t):
        return re.findall(r"[a-z0-9]+(?:\.[0-9]+)*", t.lower())

    def grams(w):
        return Counter(w) + Counter(zip(w, w[1:]))

    counted = [(name, words(t), must.split()) for name, t, must in templates]
    df = Counter(g for _, w, _ in counted for g in grams(w))
    rare = math.log(1 + len(counted)) + 1

    def vector(w):
        return {g: n * (math.log((1 + len(counted)) / (1 + df[g])) + 1 if g in df else rare) for g, n in grams(w).items()}

    own, best = words(text or ""), None
    for name, w, must in counted:
        template = vector(w)
        size = math.sqrt(sum(x * x for x in template.values()))
        for start in range(max(1, len(own) - len(w) + 1) if own else 0):
            window = own[start:start + len(w)]
            if set(must) <= set(window):
                mine = vector(window)
                score = round(sum(x * template.get(g, 0) for g, x in mine.items()) / size / math.sqrt(sum(x * x for x in mine.values())), 6)
                if score >= least:
                    best = max(best or (0, ""), (score, name))
    return best


@pytest.mark.parametrize("block", [9, 1 << 18])
def test_windows_against_plain_arithmetic(monkeypatch, block):
    monkeypatch.setattr(license, "BLOCK", block)
    rng = random.Random(block)
    templates = (("A", "one two three four five", "one"), ("B", "one two six", ""), ("C", "seven 2.0 eight seven", "seven 2.0"), ("D", "nine", "nine"))
    vocabulary = ["one", "two", "three", "four", "five", "six", "seven", "2.0", "eight", "x", "y", "ONE", "é"]
    matcher = license.Matcher(templates, 0.55)
    for _ in range(300):
        text = " ".join(rng.choices(vocabulary, k=rng.randint(0, 40))) if rng.random() > 0.05 else None
        got = [b for b in matcher.best(list(matcher.pieces(text))) if b]
        want = brute(text, templates, 0.55)
        if block > 100:
            assert (max(got) if got else None) == want or abs(max(got)[0] - want[0]) < 2e-6
        elif want and len(want) and got:
            assert abs(max(got)[0] - want[0]) < 2e-6


def test_query_against_plain_arithmetic(spark):
    """Every 7th document and every licence file by plain arithmetic, then the nearest directory above."""
    from reviewmill.llm.queries import op9_license, repository_paths

    sf_dir = "/root/testdata/sf0.001"
    rows = repository_paths(spark.read.parquet(f"{sf_dir}/documents.parquet")).collect()
    own = {r.doc_id: brute((r.text or "")[:4000], license.TEMPLATES, license.LEAST) for r in rows if len(r.text or "") < 4000}
    got = {r.doc_id: r for r in op9_license(spark, sf_dir).collect()}
    assert len(got) == len(rows)
    for doc_id, want in own.items():
        mine = got[doc_id]
        assert (mine.origin == "own") == (want is not None)
        assert want is None or (mine.licence == want[1] and abs(mine.score - want[0]) < 2e-6)
