"""Licence scans: known texts, order of rules, spans and a plain version over the table."""

import re

import pytest

from parcelflow.llm import licences, queries

SF = "/root/testdata/sf0.01"

MIT = '''The MIT License

Copyright (c) 2020 Someone

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
SOFTWARE.
'''
APACHE = '''# Licensed under the Apache License, Version 2.0 (the "License");
# you may not use this file except in compliance with the License.
# You may obtain a copy of the License at
#
#     http://www.apache.org/licenses/LICENSE-2.0
#
# Unless required by applicable law or agreed to in writing, software
# distributed under the License is distributed on an "AS IS" BASIS,
# WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
# See the License for the specific language governing permissions and
# limitations under the License.
import os
'''
GPL = '''/* This program is free software: you can redistribute it and/or modify
 * it under the terms of the GNU General Public License as published by
 * the Free Software Foundation, either version 3 of the License, or
 * (at your option) any later version.
 *
 * This program is distributed in the hope that it will be useful,
 * but WITHOUT ANY WARRANTY; without even the implied warranty of
 * MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
 * GNU General Public License for more details.
 *
 * You should have received a copy of the GNU General Public License
 * along with this program.  If not, see <https://www.gnu.org/licenses/>.
 */
'''
BSD_HEAD = '''Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
'''
BSD_THIRD = "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.\n"
BSD_TAIL = '''
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS).
'''


def names(text):
    return [x["licence"] for x in licences._scan(text)[1]]


@pytest.mark.parametrize("text,want", [
    (MIT, ["mit"]), (APACHE, ["apache-2.0"]), (GPL, ["gpl-3-or-later"]), (BSD_HEAD + BSD_TAIL, ["bsd-2-clause"]), (BSD_HEAD + BSD_THIRD + BSD_TAIL, ["bsd-3-clause"]),
    (GPL.replace("General", "Lesser General").replace("version 3", "version 2.1"), ["lgpl-2.1-or-later"]),
    ("Licensed under the Apache License, Version 2.0.", ["apache-2.0"]), ("Released under the MIT License. Then more.", ["mit"]),
    ("x y. This work is licensed under the GNU General Public License, version 3.\nnext", ["gpl-3"]), ("Licensed under CC BY-NC 4.0.\nThe", ["cc-by-nc-4.0"]),
    ("// SPDX-License-Identifier: GPL-2.0-only\nint x;", ["gpl-2.0-only"]), ("I read the license of my car. Permission was denied.", []),
    (MIT + APACHE, ["mit", "apache-2.0"]), ("THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.", ["unknown"]),
    ("", []), (None, []),
])
def test_known_texts(text, want):
    assert names(text) == want


def test_order_of_sentences_matters():
    head, source, binary = ("bsd/grant", "bsd/source", "bsd/binary")
    assert licences.recognised([head, source, binary]) == [("bsd-2-clause", 0, 3)]
    assert [x[0] for x in licences.recognised([head, binary, source])] == ["unknown"] * 3


def test_every_pattern_holds_a_trigger():
    for name, pattern in licences.SENTENCES:
        assert any(t in pattern.replace("\\", "").replace("[sc]", "s") for t in licences.TRIGGERS), name


def test_spans_point_at_the_sentences():
    text = "Intro here. Released under the MIT License. Outro."
    (span,) = licences._scan(text)[1]
    assert text[span["start"] : span["start"] + span["length"]] == "Released under the MIT License."


def test_query_equals_a_plain_search(spark):
    """The table's licence lines are fixed sentences; each stands at the start of a line or after a sentence."""
    lines = {"Licensed under the Apache License, Version 2.0.": "apache-2.0", "Released under the MIT License.": "mit",
             "This work is licensed under the GNU General Public License, version 3.": "gpl-3", "Licensed under CC BY-NC 4.0.": "cc-by-nc-4.0", "All rights reserved.": "all-rights-reserved"}
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = queries.op9_licences(spark, SF).collect()
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    for r in rows:
        text = texts[r["doc_id"]]
        want = sorted({v for k, v in lines.items() if re.search(r"(?:^|[.!?]\s|\n)" + re.escape(k), text)})
        assert r["licences"] == ",".join(want), (r["doc_id"], r["licences"], want)
    assert sum(bool(r["licences"]) for r in rows) > 30


def test_edge_rows(spark, docs):
    rows = [(1, None), (None, MIT), (2, ""), (3, "a " * 100_000 + ". Released under the MIT License."), (3, "a " * 100_000 + ". Released under the MIT License."), (4, "\n\n...\n")]
    out = licences.scan(docs(rows).withColumnRenamed("lang", "licences").withColumnRenamed("source", "t")).collect()
    assert sorted(((r["doc_id"], len(r["licences"])) for r in out), key=str) == sorted([(1, 0), (None, 1), (2, 0), (3, 1), (3, 1), (4, 0)], key=str)
    assert licences.scan(docs([])).collect() == []


@pytest.mark.parametrize("text,want", [
    ("Released under CC BY 4.0.", ["cc-by-4.0"]), ("Content is available under CC BY-SA 4.0.", ["cc-by-sa-4.0"]), ("Available under a CC-BY 3.0.", ["cc-by-3.0"]),
    ("Distributed under the terms of the CC BY 4.0.", ["cc-by-4.0"]), ("Released under Creative\nCommons BY 4.0.", ["cc-by-4.0"]),
    ("# This file is in the public\n# domain.\nx = 1", ["public-domain"]), ("All rights\nreserved.", ["all-rights-reserved"]),
    (" * This code has been placed in the\n * public\n * domain.", ["public-domain"]), ("// All  rights\n// reserved.\n", ["all-rights-reserved"]),
])
def test_every_wording_passes_the_prefilter(text, want):
    assert names(text) == want


@pytest.mark.parametrize("version", ["2", "3"])
def test_notices_of_one_version_only(version):
    either = GPL.index("either version"), GPL.index("later version.") + len("later version.")
    assert names(GPL[: either[0]] + f"version {version} of the License.\n" + GPL[either[1] :]) == [f"gpl-{version}-only"]
    kernel = f"""/*
 * This program is free software; you can redistribute it and/or modify
 * it under the terms of the GNU General Public License version {version} as
 * published by the Free Software Foundation.
 *
 * This program is distributed in the hope that it will be useful,
 * but WITHOUT ANY WARRANTY; without even the implied warranty of
 * MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
 * GNU General Public License for more details.
 */
"""
    assert names(kernel) == [f"gpl-{version}-only"]
    assert names(kernel.replace("General", "Lesser General").replace(f"version {version}", "version 2.1")) == ["lgpl-2.1-only"]


FULL_TEXTS = [
    ("   GNU GENERAL PUBLIC LICENSE\n      Version 3, 29 June 2007\n\n Copyright (C) 2007 Free Software Foundation, Inc. <https://fsf.org/>\n Everyone is permitted to copy and distribute verbatim copies\n"
     " of this license document, but changing it is not allowed.\n\n Preamble\n\n  The GNU General Public License is a free, copyleft license for\nsoftware and other kinds of works.\n", ["gpl-3"]),
    ("  GNU GENERAL PUBLIC LICENSE\n  Version 2, June 1991\n\n Copyright (C) 1989, 1991 Free Software Foundation, Inc.,\n 51 Franklin Street\n Everyone is permitted to copy and distribute verbatim copies\n"
     " of this license document, but changing it is not allowed.\n", ["gpl-2"]),
    ("GNU LESSER GENERAL PUBLIC LICENSE\n Version 2.1, February 1999\n\n", ["lgpl-2.1"]), ("GNU AFFERO GENERAL PUBLIC LICENSE\n Version 3, 19 November 2007\n\n", ["agpl-3"]),
    ("   Apache License\n  Version 2.0, January 2004\n  http://www.apache.org/licenses/\n\n TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION\n", ["apache-2.0"]),
    ("Mozilla Public License Version 2.0\n==================================\n\n1. Definitions", ["mpl-2.0"]),
    ("/* This Source Code Form is subject to the terms of the Mozilla Public\n * License, v. 2.0. If a copy of the MPL was not distributed with this\n * file, You can obtain one at https://mozilla.org/MPL/2.0/. */\n", ["mpl-2.0"]),
    ("Eclipse Public License - v 2.0\n\n THE ACCOMPANYING PROGRAM IS PROVIDED UNDER THE TERMS OF THIS ECLIPSE\n PUBLIC LICENSE (\"AGREEMENT\"). ANY USE", ["epl-2.0"]),
    ("Attribution-NonCommercial-ShareAlike 4.0 International\n\nCreative", ["cc-by-nc-sa-4.0"]), ("Creative Commons Attribution 4.0 International Public License\n\n", ["cc-by-4.0"]),
    ("CC0 1.0 Universal\n\n", ["cc0-1.0"]), ("Boost Software License - Version 1.0 - August 17th, 2003\n\nPermission", ["boost-1.0"]),
    ("// Distributed under the Boost Software License, Version 1.0.\n", ["boost-1.0"]), ("The MIT License (MIT)\n\nCopyright (c) X\n", ["mit"]),
]


@pytest.mark.parametrize("text,want", FULL_TEXTS)
def test_titles_and_first_sentences_of_whole_licences(text, want):
    assert names(text) == want
    assert names("Some text before it ends. More\n\n" + text) == want


@pytest.mark.parametrize("line", ["this is a licence note\n", "in no event shall x be liable for any direct ", "permission and copyright\n", "see the license\n# "])
def test_texts_without_sentence_ends_take_linear_time(line):
    import time

    text = line * (1_000_000 // len(line))
    began = time.process_time()
    assert names(text) == []
    assert time.process_time() - began < 10
    assert names(text + ".\n\n" + MIT) == ["mit"] and names(text + "\nReleased under the MIT License. Then") == ["mit"]


def test_a_known_sentence_ends_a_long_one():
    """What stands before the last lines of a long sentence does not matter, comment marks and white space do not count."""
    text = "word word\n" * 50_000 + "   //  Released under  \n  //    the   MIT License.\n"
    assert names(text) == ["mit"]
