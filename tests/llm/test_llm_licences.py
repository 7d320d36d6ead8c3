"""Licence texts as they stand in files: wrapped, in comments, with list marks."""

from __future__ import annotations

import random
import re
import textwrap

import pytest

from episeries.llm import license_scan

SCHEMA = "doc_id long, text string, sentence string, pos int"
MIT = """The MIT License (MIT)
Copyright (c) 2020 Some One

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE."""
GPL = """// This program is free software: you can redistribute it and/or modify
// it under the terms of the GNU General Public License as published by
// the Free Software Foundation, either version 3 of the License, or
// (at your option) any later version.
//
// This program is distributed in the hope that it will be useful,
// but WITHOUT ANY WARRANTY; without even the implied warranty of
// MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
// GNU General Public License for more details.
#include <stdio.h>"""
MPL = """/* This Source Code Form is subject to the terms of the Mozilla Public
 * License, v. 2.0. If a copy of the MPL was not distributed with this
 * file, You can obtain one at https://mozilla.org/MPL/2.0/. */"""
BSD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE
FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL
DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER
CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY,
OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE
OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""


def found(spark, texts):
    df = spark.createDataFrame([(i, t, "s", 3) for i, t in enumerate(texts)], SCHEMA)
    return {r.doc_id: r for r in license_scan.licenses(df).collect()}


@pytest.mark.parametrize("name, text, sentences", [
    ("MIT", MIT, 4), ("GPL-3.0-or-later", GPL, 3), ("MPL-2.0", MPL, 2), ("BSD-2-Clause", BSD, 5)])
def test_usual_texts(spark, name, text, sentences):
    row = found(spark, [text])[0]
    assert (row.licenses, row.n_sentences, row.n_unmatched) == (name, sentences, 0)


def test_every_rule_at_any_width(spark):
    rng, by = random.Random(5), dict(license_scan.SENTENCES)
    texts = []
    for _, sequence in license_scan.RULES:
        mark = rng.choice(["", "# ", " * ", "// ", "-- "])
        body = "\n\n".join(textwrap.fill(by[i].capitalize() + ".", rng.randint(12, 90), break_long_words=False) for i in sequence)
        texts.append("\n".join(mark + line for line in ("Begin.\n" + body + "\nend").split("\n")))
    rows = found(spark, texts)
    for i, (name, sequence) in enumerate(license_scan.RULES):
        assert (rows[i].licenses, rows[i].identifiers) == (name, ",".join(sequence))


def test_a_sentence_must_end_and_begin_with_a_piece(spark):
    rows = found(spark, ["not MIT License", "MIT License terms", "x\nMIT\nLicense\ny", "MIT License\n" * 3,
                         "SPDX-License-Identifier: MPL-2.0", "MIT License 2.0\n\n\n", "..\n \n", "MIT"])
    assert {i: r.licenses for i, r in rows.items()} == {2: "MIT", 3: "MIT", 4: "MPL-2.0"}
    assert rows[3].n_sentences == 3


def test_every_sentence_has_a_telling_word():
    for _, sentence in license_scan.SENTENCES:
        assert re.search(license_scan.TELLING, sentence)
        assert sentence == " ".join(re.findall("[a-z0-9]+", sentence))
