"""Licence scans by sentence rules.

A text is cut into sentences; each is normalised (comment marks, quotes, white space and case) and looked up among known
licence sentences, which gives it an identifier. The identifiers of a text, in order, are then matched against an ordered
list of licence rules: at each place the first rule whose sequence stands there names the licence and takes its sentences.
Known sentences that no rule takes are reported as parts of an unknown licence.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelflow.llm.common import slices

# Known licence sentences, as (identifier, pattern of the whole normalised sentence). Groups fill in the
# braces of the identifier. An identifier `ref=X` names licence X by itself.
SENTENCES = [
    ("ref={0}", r"spdx-license-identifier: ?([a-z0-9.+()-]+(?: (?:or|and|with) [a-z0-9.+()-]+)*)(?: .*)?"),
    ("apache-2.0/grant", r"licensed under the apache license, version 2\.0 \(the 'license'\); you may not use this file except in compliance with the license"),
    ("apache-2.0/copy", r"you may obtain a copy of the license at:?(?: ?https?://www\.apache\.org/licenses/license-2\.0(?:\.html|\.txt)?)?"),
    ("apache-2.0/as-is", r"unless required by applicable law or agreed to in writing, software distributed under the license is distributed on an 'as is' basis, without warranties or conditions of any kind, either express or implied"),
    ("apache-2.0/see", r"see the license for the specific language governing permissions and limitations under the license"),
    ("ref=apache-{0}", r"(?:this \w+ is |it is )?(?:licensed|released|distributed|available) under (?:the terms of )?the apache (?:software )?licen[sc]e,? (?:version |v\.? ?)?(2\.0|1\.1|1\.0)"),
    ("ref=mit", r"(?:this \w+ is |it is )?(?:licensed|released|distributed|available) under (?:the terms of )?the (?:mit|expat) licen[sc]e"),
    ("mit/grant", r"permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files \(the 'software'\), to deal in the software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the software, and to permit persons to whom the software is furnished to do so, subject to the following conditions"),
    ("mit/notice", r"the above copyright notice and this permission notice (?:\(including the next paragraph\) )?shall be included in all copies or substantial portions of the software"),
    ("mit/as-is", r"the software is provided 'as is', without warranty of any kind, express or implied, including but not limited to the warranties of merchantability, fitness for a particular purpose and noninfringement"),
    ("mit/liability", r"in no event shall the (?:authors|copyright holders|authors or copyright holders) be liable for any claim, damages or other liability, whether in an action of contract, tort or otherwise, arising from, out of or in connection with the software or the use or other dealings in the software"),
    ("bsd/grant", r"redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("bsd/source", r"redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer"),
    ("bsd/binary", r"redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution"),
    ("bsd/advertising", r"all advertising materials mentioning features or use of this software must display the following acknowledgement.*"),
    ("bsd/endorse", r"neither the names? of .+ nor the names of (?:its|their) contributors may be used to endorse or promote products derived from this software without specific prior written permission"),
    ("bsd/as-is", r"this software is provided by .+ 'as is' and any express or implied warranties, including, but not limited to, the implied warranties of merchantability and fitness for a particular purpose are disclaimed"),
    ("bsd/liability", r"in no event shall .+ be liable for any direct, indirect, incidental, special, exemplary, or consequential damages .+"),
    ("ref=bsd-{0}-clause", r"(?:this \w+ is |it is )?(?:licensed|released|distributed|available) under (?:the terms of )?the (?:bsd[ -])?([234])-clause (?:bsd )?licen[sc]e"),
    ("gpl/{0}/{1}", r"this (?:program|file|software|library) is free software[:;,] you can redistribute it and/or modify it under the terms of the gnu (lesser |library |affero )?general public license as published by the free software foundation[,;:] (?:either )?version (2\.1|2|3)(?:\.0)? of the license,? or (?:\(at your option\) |at your option,? )any later version"),
    ("gpl-only/{0}/{1}", r"this (?:program|file|software|library) is free software[:;,] you can redistribute it and/or modify it under the terms of the gnu (lesser |library |affero )?general public license,? (?:as published by the free software foundation[,;:]? )?version (2\.1|2|3)(?:\.0)?(?: of the license)?(?:,? as published by the free software foundation)?(?:[,;] and no later version)?"),
    ("gpl-only/{0}/{1}", r"this (?:program|file|software|library) is free software[:;,] you can redistribute it and/or modify it under the terms of the gnu (lesser |library |affero )?general public license,? as published by the free software foundation[,;:] version (2\.1|2|3)(?:\.0)? of the license(?:,? only)?"),
    ("gpl/hope", r"this (?:program|file|software|library) is distributed in the hope that it will be useful, but without any warranty[;,] without even the implied warranty of merchantability or fitness for a particular purpose"),
    ("gpl/see", r"see the gnu (?:lesser |library |affero )?general public license for more details"),
    ("gpl/copy", r"you should have received a copy of the gnu (?:lesser |library |affero )?general public license along with this (?:program|file|software|library).*"),
    ("ref={0}gpl-{1}", r"(?:this \w+ is |it is )?(?:licensed|released|distributed|available) under (?:the terms of )?the gnu (lesser |affero )?general public licen[sc]e,? (?:version |v\.? ?)(2\.1|2|3)(?:\.0)?(?: or later)?"),
    ("gpl-text/{0}/{1}", r"gnu (lesser |library |affero )?general public license,? version (2\.1|2|3)(?:\.0)?(?:, (?:\d{1,2} )?[a-z]+ \d{4})?"),
    ("fsf/verbatim", r"(?:<?https?://\S+>? )?everyone is permitted to copy and distribute verbatim copies of this license document, but changing it is not allowed"),
    ("gpl/preamble", r"the gnu (?:affero )?general public license is a free, copyleft license for software and other kinds of works(?:, specifically designed to ensure cooperation with the community in the case of network server software)?"),
    ("apache-text/{0}", r"apache license,? version (2\.0|1\.1|1\.0)(?:, january 2004)?(?: https?://www\.apache\.org/licenses/?\S*)?"),
    ("apache-terms", r"terms and conditions for use, reproduction, and distribution"),
    ("mit/title", r"(?:the )?(?:mit|expat) licen[sc]e(?: \(mit\))?"),
    ("boost/title", r"boost software license -? ?version 1\.0(?: - august 17th, 2003)?"),
    ("ref=boost-1.0", r"(?:this \w+ is |it is |use, modification and distribution (?:is|are) )?(?:licensed|released|distributed|available|subject) (?:under|to) (?:the terms of )?the boost software licen[sc]e,? version 1\.0"),
    ("boost/grant", r"permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license \(the 'software'\) to use, reproduce, display, distribute, execute, and transmit the software, and to prepare derivative works of the software, and to permit third-parties to whom the software is furnished to do so, all subject to the following"),
    ("epl-title/{0}", r"eclipse public license,? (?:[-–] )?(?:version |v\.? ?)([12]\.0)"),
    ("epl/program", r"the accompanying program is provided under the terms of this eclipse public license \('agreement'\)"),
    ("mpl-title/{0}", r"mozilla public license,? version (2\.0|1\.1)(?: =+)?"),
    ("ref=cc-by{0}{1}{2}-{3}", r"(?:creative commons )?attribution(-noncommercial)?(-noderivatives|-noderivs)?(-sharealike)? ([1-4]\.[05]) (?:international|unported|generic)(?: public)?(?: licen[sc]e)?"),
    ("ref=cc0-1.0", r"(?:creative commons )?cc0 1\.0 universal(?: public domain dedication)?"),
    ("mpl/{0}", r"this source code form is subject to the terms of the mozilla public license, v\. ?(2\.0|1\.1)"),
    ("mpl-copy", r"if a copy of the mpl was not distributed with this file,? you can obtain one at:? https?://(?:www\.)?mozilla\.org/mpl/(?:2\.0|1\.1)/?"),
    ("ref=cc-{0}-{1}", r"(?:this (?:\w+ )?is |it is |content is )?(?:licensed|released|distributed|available) under (?:a |the )?(?:terms of the )?(?:cc|creative commons)[ -](by(?:-nc|-nd|-sa)*|zero|0)[ -]?(?:license )?(?:version )?([1-4]\.[05])(?: international)?(?: licen[sc]e)?"),
    ("unlicense/free", r"this is free and unencumbered software released into the public domain"),
    ("unlicense/anyone", r"anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means"),
    ("isc/grant", r"permission to use, copy, modify, and(?:/or)? distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies"),
    ("isc/as-is", r"the software is provided 'as is' and .+ disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness"),
    ("zlib/as-is", r"this software is provided 'as-is', without any express or implied warranty"),
    ("zlib/grant", r"permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions"),
    ("public-domain", r"this (?:work|software|file|program|code) (?:is|has been placed) in the public domain"),
    ("all-rights-reserved", r"(?:copyright .+ )?all rights reserved"),
]

# Licence rules in the order in which they are tried.
RULES = [
    ("apache-2.0", ("apache-2.0/grant", "apache-2.0/copy", "apache-2.0/as-is", "apache-2.0/see")),
    ("apache-2.0", ("apache-2.0/grant", "apache-2.0/copy")),
    ("apache-2.0", ("apache-2.0/grant",)),
    ("apache-{0}", ("apache-text/{0}", "apache-terms")),
    ("apache-{0}", ("apache-text/{0}",)),
    ("mit", ("mit/title", "mit/grant", "mit/notice", "mit/as-is", "mit/liability")),
    ("mit", ("mit/title", "mit/grant", "mit/notice", "mit/as-is")),
    ("mit", ("mit/title", "mit/grant", "mit/notice")),
    ("mit", ("mit/title",)),
    ("mit", ("mit/grant", "mit/notice", "mit/as-is", "mit/liability")),
    ("mit", ("mit/grant", "mit/notice", "mit/as-is")),
    ("mit-like", ("mit/grant", "mit/notice")),
    ("bsd-4-clause", ("bsd/grant", "bsd/source", "bsd/binary", "bsd/advertising", "bsd/endorse", "bsd/as-is", "bsd/liability")),
    ("bsd-3-clause", ("bsd/grant", "bsd/source", "bsd/binary", "bsd/endorse", "bsd/as-is", "bsd/liability")),
    ("bsd-3-clause", ("bsd/grant", "bsd/source", "bsd/binary", "bsd/endorse")),
    ("bsd-2-clause", ("bsd/grant", "bsd/source", "bsd/binary", "bsd/as-is", "bsd/liability")),
    ("bsd-2-clause", ("bsd/grant", "bsd/source", "bsd/binary")),
    ("{0}gpl-{1}", ("gpl-text/{0}/{1}", "fsf/verbatim", "gpl/preamble")),
    ("{0}gpl-{1}", ("gpl-text/{0}/{1}", "fsf/verbatim")),
    ("{0}gpl-{1}", ("gpl-text/{0}/{1}",)),
    ("{0}gpl-{1}-or-later", ("gpl/{0}/{1}", "gpl/hope", "gpl/see", "gpl/copy")),
    ("{0}gpl-{1}-or-later", ("gpl/{0}/{1}", "gpl/hope", "gpl/see")),
    ("{0}gpl-{1}-or-later", ("gpl/{0}/{1}",)),
    ("{0}gpl-{1}-only", ("gpl-only/{0}/{1}", "gpl/hope", "gpl/see", "gpl/copy")),
    ("{0}gpl-{1}-only", ("gpl-only/{0}/{1}", "gpl/hope", "gpl/see")),
    ("{0}gpl-{1}-only", ("gpl-only/{0}/{1}",)),
    ("boost-1.0", ("boost/title", "boost/grant")),
    ("boost-1.0", ("boost/title",)),
    ("boost-1.0", ("boost/grant",)),
    ("epl-{0}", ("epl-title/{0}", "epl/program")),
    ("epl-{0}", ("epl-title/{0}",)),
    ("epl", ("epl/program",)),
    ("mpl-{0}", ("mpl/{0}", "mpl-copy")),
    ("mpl-{0}", ("mpl/{0}",)),
    ("mpl-{0}", ("mpl-title/{0}",)),
    ("unlicense", ("unlicense/free", "unlicense/anyone")),
    ("unlicense", ("unlicense/free",)),
    ("isc", ("isc/grant", "isc/as-is")),
    ("isc", ("isc/grant",)),
    ("zlib", ("zlib/as-is", "zlib/grant")),
    ("public-domain", ("public-domain",)),
    ("all-rights-reserved", ("all-rights-reserved",)),
]

# Every known sentence, once normalised, holds one of these, so texts without any are not cut up.
TRIGGERS = (" under cc", " under the cc", " under a cc", " under terms of the cc", " under the terms of the cc", " under a terms of the cc", "creative commons", "licen", "permission", "copyright", "redistribution", "warrant", "in no event", "public domain", "all rights reserved", "neither the name", "advertising materials", "anyone is free", "copy of the mpl", "cc0 1.0", "attribution", "terms and conditions for use")
FAMILY = {"lesser": "l", "library": "l", "affero": "a", "": "", "-noncommercial": "-nc", "-noderivatives": "-nd", "-noderivs": "-nd", "-sharealike": "-sa"}
LONGEST = 4000  # characters of the longest known sentence, once normalised, whatever names it holds

PATTERNS = [(name, re.compile(pattern)) for name, pattern in SENTENCES]
SENTENCE_END = re.compile(r"(?<![\s,(]v)[.!?]['\")\]]*(?=\s|$)|:(?=[ \t]*\n)|\n[ \t#*/;-]*(?=\n|(?:\(?\d{1,2}[.)]|\(?[a-z]\))\s)|\n(?=[ \t]*(?:#+|//+|\*+|/\*+|--+|;+)?[ \t]*(?:spdx|copyright))", re.I)
# How a known sentence may begin on a new line after text that no mark has closed.
LINE_START = re.compile(
    r"\n(?=[ \t#*/;-]*(?:(?:licensed|released|distributed|available) under|this (?:\w+ )?is|this source code form|the (?:above copyright|software is)|permission|redistribution|"
    r"unless required|you (?:may|should)|anyone is|all rights|all advertising|neither the|in no event|see the|"
    r"everyone is|if a copy|gnu (?:lesser |library |affero )?general|the (?:gnu|mit|accompanying)|(?:mit|apache) licen|(?:mozilla|eclipse) public|boost software|creative commons|attribution))", re.I)
LINE_MARK = re.compile(r"(?:^|\n)[ \t]*(?:(?:#+|//+|\*+/?|/\*+|--+|;+|%+|>+|<!--)[ \t]*)?")
BULLET = re.compile(r"^(?:[-*•]|\(?\d{1,2}[.)]|\(?[a-z]\))\s+")
SPACE = re.compile(r"\s+")
# A trigger in a raw text: its words, with white space and comment marks where normalising leaves one space. The words alone
# are looked for first, which is much faster.
TRIGGER_WORDS = [t.split() for t in TRIGGERS]
TRIGGER = re.compile("|".join(r"\s[\s#/*;%<>!-]*".join(map(re.escape, words)) for words in TRIGGER_WORDS))
QUOTES = str.maketrans({c: "'" for c in "\"“”‘’`´"})


def normalised(sentence: str) -> str:
    """Lower case, one kind of quote, single spaces; without comment marks, list marks and closing punctuation."""
    plain = SPACE.sub(" ", LINE_MARK.sub(" ", sentence)).strip().translate(QUOTES).replace("''", "'").lower()
    return BULLET.sub("", plain).rstrip(".!?: ").removesuffix("*/").rstrip(".!?: ")


def sentences(text: str) -> Iterator[tuple[int, int]]:
    """(start, end) of the sentences of a whole text, in order."""
    at = 0
    for m in SENTENCE_END.finditer(text):
        if text[at : m.end()].strip():
            yield at, m.end()
        at = m.end()
    if text[at:].strip():
        yield at, len(text)


def identifier(sentence: str) -> str | None:
    """Identifier of a normalised sentence, if it is known."""
    if len(sentence) > LONGEST or not any(t in sentence for t in TRIGGERS):
        return None
    for name, pattern in PATTERNS:
        m = pattern.fullmatch(sentence)
        if m:
            return name.format(*(FAMILY.get((g or "").strip(), (g or "").strip()) for g in m.groups()))
    return None


def _stands(rule: tuple[str, ...], ids: list[str], at: int) -> list[str] | None:
    """Values of the braces if the rule's sequence stands at this place."""
    if at + len(rule) > len(ids):
        return None
    values: list[str] = []
    for want, got in zip(rule, ids[at:]):
        if "{" in want:
            want_parts, got_parts = want.split("/"), got.split("/")
            if len(want_parts) != len(got_parts) or want_parts[0] != got_parts[0]:
                return None
            values = got_parts[1:]
        elif want != got:
            return None
    return values


def recognised(ids: list[str]) -> list[tuple[str, int, int]]:
    """(licence, first, last) over a sequence of sentence identifiers; last is exclusive."""
    found, at = [], 0
    while at < len(ids):
        if ids[at].startswith("ref="):
            found.append((ids[at][4:], at, at + 1))
            at += 1
            continue
        for licence, rule in RULES:
            values = _stands(rule, ids, at)
            if values is not None:
                found.append((licence.format(*values), at, at + len(rule)))
                at += len(rule)
                break
        else:
            found.append(("unknown", at, at + 1))
            at += 1
    return found


def _openings(text: str, a: int, b: int) -> list[int]:
    """Places in a sentence, in order, where a known sentence that ends with it may begin on a new line: what follows is not longer than one.

    Lines are measured from the end and no further than that, so a text without sentence ends costs as much as any other.
    """
    starts = [m.end() for m in LINE_START.finditer(text, a, b)]
    end = a + len(text[a:b].rstrip(".!?: \t\r\n*/"))
    length, found = 0, []
    for at in reversed(starts):
        if at < end:
            length += len(SPACE.sub(" ", LINE_MARK.sub(" ", text[at:end])))
            end = at
        if length > 2 * LONGEST:
            break
        found.append(at)
    return found[::-1]


FOUND = "sentences array<struct<id:string,start:int,length:int>>, licences array<struct<licence:string,start:int,length:int>>"


def _scan(text: str | None) -> tuple[list, list]:
    low = (text or "").lower()
    if not any(all(w in low for w in words) for words in TRIGGER_WORDS) or not TRIGGER.search(low):
        return [], []
    known = []
    for a, b in sentences(text):
        name = identifier(normalised(text[a:b]))
        for at in [] if name else _openings(text, a, b):
            name = identifier(normalised(text[at:b]))
            if name:
                a = at
                break
        if name:
            a += len(text[a:b]) - len(text[a:b].lstrip())
            known.append({"id": name, "start": a, "length": b - a})
    names = [k["id"] for k in known]
    licences = []
    for licence, first, last in recognised(names):
        a, b = known[first]["start"], known[last - 1]["start"] + known[last - 1]["length"]
        licences.append({"licence": licence, "start": a, "length": b - a})
    return known, licences


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, sentences, licences) of every row: known sentences and recognised licences with their spans in characters.

    Null and empty texts have none; repeated rows come back as often as they are given.
    """
    kind = pa.list_(pa.struct([("id", pa.string()), ("start", pa.int32()), ("length", pa.int32())]))
    licence_kind = pa.list_(pa.struct([("licence", pa.string()), ("start", pa.int32()), ("length", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "t", 1 << 23):
            made = [_scan(t) for t in batch.column("t").to_pylist()]
            columns = [batch.column("doc_id"), pa.array([m[0] for m in made], kind), pa.array([m[1] for m in made], licence_kind)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "sentences", "licences"])

    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("t"))
    return rows.mapInArrow(run, f"doc_id bigint, {FOUND}")
