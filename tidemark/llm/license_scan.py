"""Licences by their sentences.

Texts are cut into paragraphs, these are normalised, and the sentences in them
that licences are known to consist of get an identifier.  Ordered rules then say which
sequences of identifiers make which licence; a rule takes the sentences it
matches, so that the whole licence goes before the short notice it contains.

Covered are notices and short licences of Apache-2.0, MIT, BSD, ISC, GPL, LGPL,
AGPL, MPL-2.0, CC, CC0, Unlicense and SPDX lines, and, by one of their first
sentences, the full texts of Apache-2.0, GPL-2 and 3, AGPL-3, LGPL-2.1 and 3,
MPL-2.0, CC, Boost, zlib, EPL (without its version) and Artistic-2.0; also
titles, short names ("GPLv3"), ``License:`` fields and expressions of common
SPDX identifiers in prose ("licensed under MIT OR Apache-2.0").  Texts of
other licences come out with neither a name nor ``unknown``, unless they hold
sentences of these.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.frames import id_text

# Identifiers of the SPDX list that fields and prose are read for.
SPDX_IDS = (
    "0BSD", "AGPL-3.0", "AGPL-3.0-only", "AGPL-3.0-or-later", "Apache-2.0", "Artistic-2.0", "BSD-2-Clause", "BSD-3-Clause",
    "BSD-4-Clause", "BSL-1.0", "CC-BY-3.0", "CC-BY-4.0", "CC-BY-NC-4.0", "CC-BY-NC-ND-4.0", "CC-BY-NC-SA-4.0", "CC-BY-ND-4.0",
    "CC-BY-SA-3.0", "CC-BY-SA-4.0", "CC0-1.0", "EPL-1.0", "EPL-2.0", "GPL-2.0", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0",
    "GPL-3.0-only", "GPL-3.0-or-later", "ISC", "LGPL-2.1", "LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0", "LGPL-3.0-only",
    "LGPL-3.0-or-later", "MIT", "MPL-2.0", "Unlicense", "Zlib",
)
_CANONICAL = {i.lower(): i for i in SPDX_IDS}
_ID = "(?:" + "|".join(re.escape(i) for i in sorted(_CANONICAL, key=len, reverse=True)) + ")(?![\\w-])"
_IDS = rf"(?P<ids>{_ID}(?: (?:or|and) {_ID})*)"
_UNDER = r"(?:(?:this|the) (?:file|work|software|project|program|code|text) is )?(?:dual[- ])?(?:licensed|released|distributed) under (?:the )?(?:terms of )?(?:the )?"
_MONTH = r"(?:january|february|march|april|may|june|july|august|september|october|november|december)"

# What licences and notices say, normalised (lower case, single
# spaces, straight quotes, no end mark), as patterns of phrases.
SENTENCES = {
    "apache licensed": r'(?:this (?:file|work|software|project|code) is )?(?:licensed|released|distributed) under (?:the )?(?:terms of )?(?:the )?apache(?: software)? licen[cs]e,? version 2(?:\.0)?(?: \(the "license"\))?',
    "apache may not": r"you may not use this (?:file|work|software) except in compliance with the licen[cs]e",
    "apache obtain": r"you may obtain a copy of the licen[cs]e at:?(?: https?://\S+)?",
    "apache unless": r'unless required by applicable law or agreed to in writing, software distributed under the licen[cs]e is distributed on an "as is" basis, without warranties or conditions of any kind, either express or implied',
    "apache see": r"see the licen[cs]e for the specific language governing permissions and limitations under the licen[cs]e",
    "mit named": r"(?:this (?:file|work|software|project|code) is )?(?:licensed|released|distributed) under (?:the )?(?:terms of )?(?:the )?(?:mit|expat)(?: \(expat\))? licen[cs]e(?: \(mit\))?",
    "mit permission": r'permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files \(the "software"\), to deal in the software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the software, and to permit persons to whom the software is furnished to do so, subject to the following conditions',
    "mit notice": r"the above copyright notice and this permission notice(?: \(including the next paragraph\))? shall be included in all copies or substantial portions of the software",
    "mit warranty": r'the software is provided "as is", without warranty of any kind, express or implied, including but not limited to the warranties of merchantability, fitness for a particular purpose and noninfringement',
    "mit liability": r"in no event shall the authors or copyright holders be liable for any claim, damages or other liability, whether in an action of contract, tort or otherwise, arising from, out of or in connection with the software or the use or other dealings in the software",
    "bsd named 2": r"(?:this (?:file|work|software|project|code) is )?(?:licensed|released|distributed) under (?:the )?(?:terms of )?(?:the )?(?:bsd[- ]2[- ]clause|2-clause bsd|simplified bsd|freebsd)(?: licen[cs]e)?",
    "bsd named 3": r"(?:this (?:file|work|software|project|code) is )?(?:licensed|released|distributed) under (?:the )?(?:terms of )?(?:the )?(?:bsd[- ]3[- ]clause|3-clause bsd|new bsd|modified bsd)(?: licen[cs]e)?",
    "bsd named": r"(?:this (?:file|work|software|project|code) is )?(?:licensed|released|distributed) under (?:the )?(?:terms of )?(?:a |the )?bsd(?:[- ]style)? licen[cs]e",
    "bsd redistribution": r"redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "bsd source": r"(?:\(?[1a][.)] ?)?redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer",
    "bsd binary": r"(?:\(?[2b][.)] ?)?redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution",
    "bsd endorse": r"(?:\(?[3c][.)] ?)?neither the name of (?:(?!neither the name of ).)+? may be used to endorse or promote products derived from this software without specific prior written permission",
    "bsd warranty": r'this software is provided by (?:(?!this software is provided by ).)+? "as is" and any express or implied warranties, including, but not limited to, the implied warranties of merchantability and fitness for a particular purpose are disclaimed',
    "bsd liability": r"in no event shall (?:(?!in no event shall ).)+? be liable for any direct, indirect, incidental, special, exemplary, or consequential damages",
    "isc permission": r"permission to use, copy, modify, and(?:/or)? distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies",
    "isc named": r"(?:this (?:file|work|software|project|code) is )?(?:licensed|released|distributed) under (?:the )?(?:terms of )?(?:the )?isc licen[cs]e",
    "gpl named": r"(?:this (?:file|work|software|project|program|code) is )?(?:licensed|released|distributed) under (?:the )?(?:terms of )?(?:the )?gnu (?P<family>(?:lesser |library |affero )?)general public licen[cs]e,? (?:version |v)(?P<version>\d)(?:\.(?P<minor>\d))?(?P<later>,? or (?:\(at your option\) )?any later version)?(?: of the licen[cs]e)?",
    "gpl redistribute": r"(?:(?:this |the )?[\w.+-]{1,80},? )?is free software[:;,] you can redistribute it and/or modify it under the terms of the gnu (?P<family>(?:lesser |library |affero )?)general public licen[cs]e as published by the free software foundation[;,] (?:either )?version (?P<version>\d)(?:\.(?P<minor>\d))?(?: of the licen[cs]e)?(?P<later>,? or \(?at your option\)? any later version)?",
    "gpl warranty": r"this (?:program|library|file|software) is distributed in the hope that it will be useful, but without any warranty; without even the implied warranty of merchantability or fitness for a particular purpose",
    "gpl details": r"see the gnu (?:lesser |library |affero )?general public licen[cs]e for more details",
    "gpl received": r"you should have received a copy of the gnu (?:lesser |library |affero )?general public licen[cs]e along with this (?:program|library|file|software)",
    "cc named": r"(?:this (?:file|work|text|document) is )?(?:licensed|released|distributed) under (?:a |the )?(?:terms of )?(?:the )?(?:cc|creative commons)[ -](?P<terms>by(?:-nc)?(?:-sa|-nd)?)(?: (?P<number>\d\.\d))?(?: licen[cs]e)?",
    "cc zero": r"(?:this (?:file|work|text|document) is )?(?:licensed|released|distributed|dedicated)(?: to the public domain)? under (?:the )?(?:cc0|creative commons zero)(?:[ -]1\.0)?(?: licen[cs]e| universal)?",
    "mpl named": r"(?:this (?:source code form|file|work|software|project|code) is )?(?:subject to|licensed under|released under|distributed under) the (?:terms of the )?mozilla public licen[cs]e,? (?:v\. ?|version )2\.0",
    "mpl obtain": r"if a copy of the mpl was not distributed with this file, you can obtain one at https?://\S+",
    "unlicense": r"this is free and unencumbered software released into the public domain",
    "spdx": r"spdx-license-identifier: (?P<spdx>\(*[a-z0-9](?:[a-z0-9.+-]*[a-z0-9+])?\)*(?: (?:or|and|with) \(*[a-z0-9](?:[a-z0-9.+-]*[a-z0-9+])?\)*)*)",
    "proprietary": r"all rights reserved",
    "apache body": r'"license" shall mean the terms and conditions for use, reproduction, and distribution as defined by sections 1 through 9 of this document',
    "gpl 3 body": r"the gnu (?P<family>(?:affero )?)general public license is a free, copyleft license for software and other kinds of works",
    "gpl 2 body": r"the licenses for most software are designed to take away your freedom to share and change it",
    "lgpl 2 body": r"this license, the lesser general public license, applies to some specially designated software packages",
    "lgpl 3 body": r"this version of the gnu lesser general public license incorporates the terms and conditions of version 3 of the gnu general public license",
    "mpl body": r'"contributor" means each individual or legal entity that creates, contributes to the creation of, or owns covered software',
    "cc words": r"(?:licensed under a|agree to be bound by the terms and conditions of this) creative commons (?P<terms>attribution(?:-noncommercial)?(?:-sharealike|-noderivatives)?) (?P<number>\d\.\d)(?: international| unported)?(?: public)? licen[cs]e",
    "boost permission": r"permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license",
    "zlib warranty": r"this software is provided ['\"]as-is['\"], without any express or implied warranty",
    "epl body": r'the accompanying program is provided under the terms of this eclipse public license \("agreement"\)',
    "artistic body": r"this license establishes the terms under which a given free software package may be copied, modified, distributed, and/or redistributed",
    "bsd advertising": r"(?:\(?[3c][.)] ?)?all advertising materials mentioning features or use of this software must display the following acknowledge?ment",
    "licence field": rf'licen[cs]e"? ?[:=] ?[\'"]?{_IDS}',
    "spdx named": rf"{_UNDER}{_IDS}(?: licen[cs]es?)?",
    "gpl short": rf"{_UNDER}(?:gnu )?(?P<letter>[al]?)gpl,?[ -]?(?:version |v ?)?(?P<version>[23])(?:\.(?P<minor>\d))?(?P<later>\+| or later|,? or (?:\(at your option\) )?any later version)?(?: licen[cs]e)?",
    "gnu title": rf"gnu (?P<family>(?:lesser |library |affero )?)general public licen[cs]e,? version (?P<version>\d)(?:\.(?P<minor>\d))?, (?:\d{{1,2}} )?{_MONTH} \d{{4}}",
    "apache title": r"apache licen[cs]e,? version 2\.0, january 2004",
    "mit title": r"the mit licen[cs]e \((?:mit|expat)\)",
    "boost named": rf"{_UNDER}boost software licen[cs]e(?:,? (?:version |v ?)?1\.0)?",
}

_GNU = {"": "GPL", "lesser ": "LGPL", "library ": "LGPL", "affero ": "AGPL"}

_CC = {"attribution": "by", "noncommercial": "nc", "sharealike": "sa", "noderivatives": "nd"}

# Ordered rules: the longest sequences of a family go first.  "?" marks a sentence that may be missing.
RULES = (
    ("GNU title", ("gnu title", "gpl 3 body?", "gpl 2 body?", "lgpl 2 body?", "lgpl 3 body?")),
    ("Apache-2.0", ("apache title", "apache body?")),
    ("MIT", ("mit title", "mit permission", "mit notice", "mit warranty", "mit liability?")),
    ("Apache-2.0", ("apache licensed", "apache may not", "apache obtain?", "apache unless", "apache see?")),
    ("MIT", ("mit permission", "mit notice", "mit warranty", "mit liability?")),
    ("BSD-4-Clause", ("bsd redistribution", "bsd source", "bsd binary", "bsd advertising", "bsd endorse", "bsd warranty", "bsd liability?")),
    ("BSD-3-Clause", ("bsd redistribution", "bsd source", "bsd binary", "bsd endorse", "bsd warranty", "bsd liability?")),
    ("BSD-2-Clause", ("bsd redistribution", "bsd source", "bsd binary", "bsd warranty", "bsd liability?")),
    ("ISC", ("isc permission",)),
    ("GNU", ("gpl redistribute", "gpl warranty?", "gpl details?", "gpl received?")),
    ("MPL-2.0", ("mpl named", "mpl obtain?")),
    ("Unlicense", ("unlicense",)),
    ("Apache-2.0", ("apache licensed",)),
    ("MIT", ("mit named",)),
    ("BSD-2-Clause", ("bsd named 2",)),
    ("BSD-3-Clause", ("bsd named 3",)),
    ("BSD", ("bsd named",)),
    ("ISC", ("isc named",)),
    ("GNU", ("gpl named",)),
    ("CC", ("cc named",)),
    ("CC0-1.0", ("cc zero",)),
    ("SPDX", ("spdx",)),
    ("LicenseRef-all-rights-reserved", ("proprietary",)),
    ("Apache-2.0", ("apache body",)),
    ("GNU-3", ("gpl 3 body",)),
    ("GPL-2.0", ("gpl 2 body",)),
    ("LGPL-2.1", ("lgpl 2 body",)),
    ("LGPL-3.0", ("lgpl 3 body",)),
    ("MPL-2.0", ("mpl body",)),
    ("CC", ("cc words",)),
    ("BSL-1.0", ("boost permission",)),
    ("Zlib", ("zlib warranty",)),
    ("EPL", ("epl body",)),
    ("Artistic-2.0", ("artistic body",)),
    ("SPDX ids", ("licence field",)),
    ("SPDX ids", ("spdx named",)),
    ("GNU short", ("gpl short",)),
    ("MIT", ("mit title",)),
    ("BSL-1.0", ("boost named",)),
)
UNKNOWN = "unknown"

# Every known sentence holds one of these: single words or parts of words, as any white space may stand between words.
ANCHORS = ("licen", "permission", "redistribut", "copyright", "warrant", "liable", "unencumbered", "reserved", "mozilla", "bsd", "commons", "contributor", "advertising", "released", "distributed")
_SHORT = re.compile(r"\b(?:cc0?|mpl)\b|gpl")  # anchors too, but parts of many words
# For each sentence, the words of which its normalised text holds one.
WORDS = {
    "apache licensed": ("apache",), "apache may not": ("compliance",), "apache obtain": ("obtain",), "apache unless": ("applicable",),
    "apache see": ("governing",), "mit named": ("mit", "expat"), "mit permission": ("hereby",), "mit notice": ("substantial",),
    "mit warranty": ("noninfringement",), "mit liability": ("dealings",), "bsd named 2": ("bsd",), "bsd named 3": ("bsd",),
    "bsd named": ("bsd",), "bsd redistribution": ("redistribution",), "bsd source": ("redistributions",),
    "bsd binary": ("redistributions",), "bsd endorse": ("endorse",), "bsd warranty": ("warranties",), "bsd liability": ("liable",),
    "isc permission": ("hereby",), "isc named": ("isc",), "gpl named": ("gnu",), "gpl redistribute": ("gnu",),
    "gpl warranty": ("merchantability",), "gpl details": ("gnu",), "gpl received": ("gnu",), "cc named": ("cc", "commons"),
    "cc zero": ("cc0", "commons"), "mpl named": ("mozilla",), "mpl obtain": ("mpl",), "unlicense": ("unencumbered",),
    "spdx": ("spdx",), "proprietary": ("reserved",),
    "apache body": ("reproduction",), "gpl 3 body": ("copyleft",), "gpl 2 body": ("freedom",), "lgpl 2 body": ("designated",),
    "lgpl 3 body": ("incorporates",), "mpl body": ("contributor",), "cc words": ("commons",), "boost permission": ("hereby",),
    "zlib warranty": ("as-is",), "epl body": ("eclipse",), "artistic body": ("establishes",), "bsd advertising": ("advertising",),
    "licence field": ("license", "licence"), "spdx named": ("under",), "gpl short": ("gpl",), "gnu title": ("gnu",),
    "apache title": ("january",), "mit title": ("mit",), "boost named": ("boost",),
}
MAX_SPREAD = 400
MAX_TAIL = 600

# A phrase is not part of a longer word or number, and not denied.
_KNOWN = [
    (name, re.compile(rf"(?<!\w)(?<!\bnot )(?<!\bnever )(?:{pattern})(?!\w|\.\d)")) for name, pattern in SENTENCES.items()
]
# Known by how they begin; they go on to the end of the sentence.
_TAILED = ("bsd liability", "gpl received")
_TAIL = re.compile(rf".{{0,{MAX_TAIL}}}?(?=[.!?]+(?:[\s\"')\]]|$)|$)")
_END = re.compile(r"\n[ \t\r]*\n")
_MARKS = re.compile(r"[.!?:]*")
_QUOTES = str.maketrans("“”‘’", "\"\"''")
_LEAD = re.compile(r"(?:[\s#*/;%|>!-]|--|<!--|\(c\))+")
_TOKEN = re.compile(r"\S+")
_SIGNS = re.compile(r"[#*/;%|>!<-]+")
_HYPHEN = re.compile(r"\w-$")


def _lower(text: str) -> str:
    """``text`` in lower case, character by character where the length would change."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


def normalised(text: str) -> tuple[str, list[int], list[int]]:
    """A text in lower case, with single spaces, straight quotes and no comment signs; where its words begin, here and there.

    Comment signs may stand anywhere, as lines may have been joined; a hyphen at
    the end of a line is followed by the rest of its word.
    """
    flat, here, there, length, at, split = [], [], [], 0, 0, True
    for line in text.split("\n"):
        lead = _LEAD.match(line)
        token = None
        for token in _TOKEN.finditer(line, lead.end() if lead else 0):
            word = token[0]
            if _SIGNS.fullmatch(word):
                continue
            if not split:
                flat.append(" ")
                length += 1
            split = False
            here.append(length)
            there.append(at + token.start())
            flat.append(word)
            length += len(word)
        split = split or bool(token and _HYPHEN.search(token[0]))
        at += len(line) + 1
    return _lower("".join(flat).translate(_QUOTES)), here, there


def _expression(part: str, start: int, end: int) -> int:
    """Where an SPDX expression ends: words are operators if in capitals, or if the line ends after the expression."""
    for operator in re.finditer(r"\s(?:or|and|with)\s", part[start:end], re.IGNORECASE):
        if not operator[0].strip().isupper():
            whole = "\n" not in part[start:end] and re.match(r"[\s#*/;%|>!.-]*$", part[end:].split("\n")[0])
            return end if whole else start + operator.start()
    return end


def _may_hold(text: str) -> bool:
    low = text.lower()
    return any(a in low for a in ANCHORS) or _SHORT.search(low) is not None


def known_sentences(text: str) -> list[tuple[int, int, str]]:
    """``start, end, identifier`` of the known sentences of a text, in order, without overlap.

    They are searched in whole paragraphs, wherever lines are wrapped: end marks
    stand within sentences too ("v. 2.0", "Inc."), and parts of a sentence up to
    a colon or semicolon can be known by themselves.  A known sentence may stand
    anywhere between other words: the leftmost counts, and of those the longest.
    """
    out, at = [], 0
    if not _may_hold(text):
        return out
    for end in [*(m.end() for m in _END.finditer(text)), len(text)]:
        part = text[at:end]
        if _may_hold(part):
            out += [(at + a, at + b, name) for a, b, name in _within(part)]
        at = end
    return out


def _within(part: str) -> list[tuple[int, int, str]]:
    """Known sentences within a paragraph."""
    flat, here, there = normalised(part)

    def place(i: int) -> int:
        """Of a character of a word."""
        word = bisect_right(here, i) - 1
        return there[word] + i - here[word]

    found = []
    for name, pattern in _KNOWN:
        if not any(w in flat for w in WORDS[name]):
            continue
        for m in pattern.finditer(flat):
            start, end = place(m.start()), place(m.end() - 1) + 1
            told = {k: v.strip() for k, v in m.groupdict().items() if v}
            if name == "spdx":
                expression = place(m.start("spdx"))
                end = _expression(part, expression, end)
                told["spdx"] = " ".join(part[expression:end].lower().split())
            tail = _TAIL.match(flat, m.end()) if name in _TAILED else None
            last = place(tail.end() - 1) + 1 if tail else end
            found.append((start, end, last, name + "".join(f"|{k}={v}" for k, v in told.items())))
    found.sort(key=lambda f: (f[0], -f[1]))
    alone: list[tuple[int, int, int, str]] = []
    for one in found:
        if not alone or one[0] >= alone[-1][1]:
            alone.append(one)
    out = []
    for (start, end, last, name), after in zip(alone, [*(f[0] for f in alone[1:]), len(part)]):
        end = max(end, min(last, after))
        end = start + len(part[start:end].rstrip())
        out.append((start, min(after, _MARKS.match(part, end).end()), name))
    return out


def _licence(name: str, sentence: str) -> str:
    """The licence's name, with what its first sentence says of family, version and terms."""
    told = dict(x.split("=", 1) for x in sentence.split("|")[1:])
    if name == "GNU":
        family = _GNU[told["family"] + " " if told.get("family") else ""]
        return f"{family}-{told['version']}.{told.get('minor', '0')}-{'or-later' if 'later' in told else 'only'}"
    if name == "GNU short":
        later = "or-later" if "later" in told else "only"
        return f"{told.get('letter', '').upper()}GPL-{told['version']}.{told.get('minor', '0')}-{later}"
    if name == "GNU title":
        return f"{_GNU[told['family'] + ' ' if told.get('family') else '']}-{told['version']}.{told.get('minor', '0')}"
    if name == "SPDX ids":
        return " ".join(_CANONICAL.get(word, word.upper()) for word in told["ids"].split())
    if name == "GNU-3":
        return f"{_GNU[told['family'] + ' ' if told.get('family') else '']}-3.0"
    if name == "CC":
        for word, short in _CC.items():
            told["terms"] = told["terms"].replace(word, short)
        return f"CC-{told['terms'].upper()}" + (f"-{told['number']}" if "number" in told else "")
    return told["spdx"] if name == "SPDX" else name


def match_rules(sentences: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """``start, end, licence`` by the ordered rules; each sentence is taken once.

    The sentences of a rule follow one another with no other known sentence and
    at most ``MAX_SPREAD`` characters between them.  What no rule takes is
    ``unknown``, and neighbours of that kind are one finding.
    """
    kinds = [s[2].split("|")[0] for s in sentences]
    taken: dict[int, tuple[int, str]] = {}  # first sentence: last sentence and licence
    free = [True] * len(sentences)

    def follows(i: int) -> bool:
        return i == 0 or sentences[i][0] - sentences[i - 1][1] <= MAX_SPREAD

    for name, rule in RULES:
        for first in range(len(kinds)):
            i = first
            for step in rule:
                there = i < len(kinds) and free[i] and kinds[i] == step.rstrip("?") and (i == first or follows(i))
                if there:
                    i += 1
                elif not step.endswith("?"):
                    break
            else:
                taken[first] = (i - 1, _licence(name, sentences[first][2]))
                free[first:i] = [False] * (i - first)
    out, i = [], 0
    while i < len(sentences):
        if i in taken:
            last, name = taken[i]
        else:
            last, name = i, UNKNOWN
            while last + 1 < len(sentences) and free[last + 1] and follows(last + 1):
                last += 1
        out.append((sentences[i][0], sentences[last][1], name))
        i = last + 1
    return out


def scan_licences(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_sentences, found`` for every row of ``df``; ``found`` has ``start, end, licence`` in code points.

    Whole texts are searched.  Null and empty texts have no findings; null ids
    stay null; repeated rows come out as often as they go in; an empty table
    gives an empty result; other columns are not read.  Nothing is shuffled.
    """
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("licence", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, found = [], []
            for text in batch.column("text"):
                sentences = known_sentences(text.as_py())
                counts.append(len(sentences))
                found.append([dict(zip(("start", "end", "licence"), f)) for f in match_rules(sentences)])
            yield pa.record_batch(
                [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(found, kind)],
                ["doc_id", "n_sentences", "found"],
            )

    return id_text(df, id_col, text_col).mapInArrow(
        run, "doc_id bigint, n_sentences bigint, found array<struct<start:bigint,end:bigint,licence:string>>"
    )


def digest(found: DataFrame) -> DataFrame:
    """``doc_id, n_sentences, licences, spans`` of a scan, as texts joined by commas."""
    spans = F.transform("found", lambda f: F.concat_ws(":", f["licence"], f["start"].cast("string"), f["end"].cast("string")))
    names = F.array_sort(F.array_distinct(F.transform("found", lambda f: f["licence"])))
    return found.select(
        "doc_id", "n_sentences", F.array_join(names, ",").alias("licences"), F.array_join(spans, ",").alias("spans")
    )
