"""License recognition by sentences: normalised sentences become identifiers of known license sentences, and the
sequence of identifiers of a document is matched against ordered rules.

A text is read as its lower-case ASCII words, so line breaks, rulers and comment signs inside a sentence do not matter. A
known sentence begins with a line, or after . ! ? : ; ) and white space, and ends with its line or at . ! ? : ; before white
space; between the two it may be wrapped over any lines. Null and empty texts have no sentences. Matching walks a tree of
words from the first word of a line or sentence, so the cost is about one pass over the text for any number of rules.
SPDX license lines count as sentences ``spdx-`` and the license's name. A reservation of all rights without a license is
``Proprietary``; names do not tell a version alone from that version or later.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.llm.common import map_texts

# Sentences of public licenses and of the notes that refer to them.
SENTENCES = {
    "mit-note": ["Released under the MIT License.", "Licensed under the MIT License.", "This project is licensed under the MIT License."],
    "mit-grant": ["Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"],
    "mit-notice": ["The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."],
    "mit-warranty": ["THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."],
    "apache-note": ["Licensed under the Apache License, Version 2.0.", "Licensed under the Apache License, Version 2.0 (the \"License\");", "Released under the Apache License, Version 2.0."],
    "apache-use": ["you may not use this file except in compliance with the License."],
    "apache-copy": ["You may obtain a copy of the License at"],
    "apache-warranty": ["WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."],
    "gpl3-note": ["This work is licensed under the GNU General Public License, version 3.", "Licensed under the GNU General Public License, version 3."],
    "gpl-free": ["This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."],
    "gpl-warranty": ["This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."],
    "ccbync4-note": ["Licensed under CC BY-NC 4.0.", "This work is licensed under CC BY-NC 4.0."],
    "ccby4-note": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "bsd-grant": ["Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"],
    "bsd-name": ["Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."],
}
_LEADS = [f"{x}{y}" for x in ("", "This work is ", "This project is ", "This program is ", "This software is ", "This file is ", "This code is ", "This document is ", "The code is ")
          for y in ("licensed under ", "released under ", "distributed under ", "published under ", "available under ")]
#: Names by which notes call a license.
NAMES = {
    "MIT": ["MIT License", "MIT"],
    "Apache-2.0": ["Apache License, Version 2.0", "Apache License, Version 2.0 (the \"License\");", "Apache License v2.0", "Apache License 2.0", "Apache 2.0 License", "Apache 2.0"],
    "BSD-3-Clause": ["BSD 3-Clause License", "3-Clause BSD License", "BSD 3-Clause", "New BSD License", "Modified BSD License", "Revised BSD License"],
    "BSD-2-Clause": ["BSD 2-Clause License", "2-Clause BSD License", "BSD 2-Clause", "Simplified BSD License", "FreeBSD License"],
    "BSD": ["BSD License", "BSD"],
    "ISC": ["ISC License", "ISC"],
    "MPL-2.0": ["Mozilla Public License, Version 2.0", "Mozilla Public License, v. 2.0", "Mozilla Public License v2.0", "Mozilla Public License 2.0", "MPL 2.0", "MPLv2"],
    "BSL-1.0": ["Boost Software License, Version 1.0", "Boost Software License 1.0", "BSL 1.0"],
    "Zlib": ["zlib License", "zlib/libpng License"],
    "Unlicense": ["Unlicense"],
    "CC0-1.0": ["CC0 1.0", "CC0", "CC0 1.0 Universal", "Creative Commons CC0 1.0 Universal", "Creative Commons Zero v1.0 Universal", "CC0 1.0 Universal License"],
    **{f"EPL-{v}": [f"Eclipse Public License, Version {v}", f"Eclipse Public License - v {v}", f"Eclipse Public License v{v}", f"Eclipse Public License {v}", f"EPL {v}"] for v in ("1.0", "2.0")},
}
_GNU = {"GPL": ("GNU General Public License", ("2", "3")), "LGPL": ("GNU Lesser General Public License", ("2.1", "3")), "AGPL": ("GNU Affero General Public License", ("3",))}
_CREATIVE = {"BY": "Attribution", "BY-SA": "Attribution-ShareAlike", "BY-ND": "Attribution-NoDerivatives", "BY-NC": "Attribution-NonCommercial",
             "BY-NC-SA": "Attribution-NonCommercial-ShareAlike", "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives"}
for _short, _long in _CREATIVE.items():
    for _v, _kind in (("4.0", "International"), ("3.0", "Unported"), ("2.0", "Generic")):
        NAMES[f"CC-{_short}-{_v}"] = [f"CC {_short} {_v}", f"CC {_short} {_v} License", *[f"Creative Commons {_long} {_v}{x}" for x in ("", f" {_kind}", " License", f" {_kind} License")]]
#: Sentences by license that are enough by themselves; * stands for a name of up to SLOT words.
ALONE = {
    "ISC": [f"Permission to use, copy, modify, {x} distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies." for x in ("and", "and/or")],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
    "Unlicense": ["This is free and unencumbered software released into the public domain."],
    "CC0-1.0": ["To the extent possible under law, * waived all copyright and related or neighboring rights to *.",
                "To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights to this software to the public domain worldwide."],
    "Zlib": ["This software is provided 'as-is', without any express or implied warranty."],
    "BSL-1.0": ["Distributed under the Boost Software License, Version 1.0. (See accompanying file LICENSE_1_0.txt or copy at"],
    **{f"EPL-{v}": [f"This program and the accompanying materials are made available under the terms of the Eclipse Public License {x}{v} {y}" for x in ("", "v", "v. ") for y in (
        "which is available at", f"which is available at https://www.eclipse.org/legal/epl-{v}", f"which accompanies this distribution, and is available at", "which accompanies this distribution, and is available at *", "which is available at *", "which accompanies this distribution.")] for v in ("1.0", "2.0")},
    "Proprietary": ["All rights reserved.", "Copyright * All rights reserved.", "(c) * All rights reserved."],
}
for _short, (_long, _versions) in _GNU.items():
    NAMES[_short] = [_long, _short]
    for _v in _versions:
        _full = _v if "." in _v else f"{_v}.0"
        _lgpl = [_long, "GNU Library General Public License"] if _short == "LGPL" else [_long]
        NAMES[f"{_short}-{_full}"] = [f"{x}{y}" for x in [*[f"{n}{sep}{v}" for n in _lgpl for sep in (", version ", " v", " ") for v in {_v, _full}], f"{_short}v{_v}", f"{_short} v{_v}", f"{_short} {_v}", f"{_short} {_full}"]
                                      for y in ("", " or later", " only", ", or any later version", ", or (at your option) any later version")]
        _terms = "you can redistribute it and/or modify it under the terms of the"
        _freely = [f"{_terms} {n} as published by the Free Software Foundation, {x}" for n in _lgpl for x in (
            f"either version {_v} of the License, or (at your option) any later version.", f"either version {_v} of the License, or any later version.", f"version {_v} of the License.", f"version {_v}.")]
        _freely += [f"{_terms} {n} {x} as published by the Free Software Foundation." for n in _lgpl for x in (f"version {_v}", f"version {_v} only", f"v{_v}")]
        _months = {"2": "June 1991", "2.1": "February 1999", "3": "19 November 2007" if _short == "AGPL" else "29 June 2007"}
        ALONE[f"{_short}-{_full}"] = [*_freely, *[f"This {x} is free software: {y}" for x in ("program", "library", "file", "software") for y in _freely], f"{_long} Version {_v}, {_months[_v]}"]
_IDS = {"MIT": "mit", "Apache-2.0": "apache", "GPL-3.0": "gpl3", "CC-BY-NC-4.0": "ccbync4", "CC-BY-4.0": "ccby4"}
_taken = {" ".join(re.findall("[a-z0-9]+", x.lower())) for texts in SENTENCES.values() for x in texts}
for _table, _end in ((NAMES, "note"), (ALONE, "text")):
    for _license, _texts in _table.items():
        _all = [f"{lead}{the}{x}" for lead in _LEADS for the in ("the ", "a ", "") for x in _texts] if _end == "note" else _texts
        _id = f"{_IDS.get(_license, _license.lower())}-{_end}"
        SENTENCES[_id] = [*SENTENCES.get(_id, []), *[x for x in _all if " ".join(re.findall("[a-z0-9]+", x.lower())) not in _taken]]
SENTENCES["apache-warranty"].append("Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.")
SENTENCES["bsd-name"].append("Neither the name of * nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.")
SENTENCES["bsd-name"].append("Neither the name of * nor the names of * contributors may be used to endorse or promote products derived from this software without specific prior written permission.")
SENTENCES["gpl-warranty"] += [SENTENCES["gpl-warranty"][0].replace("program", x) for x in ("library", "file", "software")]

#: Ordered rules: a license is recognised where its sentences follow each other in this order, other sentences between them allowed.
RULES = {
    "MIT": [("mit-note",), ("mit-grant", "mit-notice"), ("mit-grant", "mit-warranty")],
    "Apache-2.0": [("apache-note",), ("apache-use", "apache-copy"), ("apache-use", "apache-warranty"), ("apache-copy", "apache-warranty")],
    "GPL-3.0": [("gpl3-note",), ("gpl-free",), ("gpl3-text",)],
    "CC-BY-NC-4.0": [("ccbync4-note",)],
    "CC-BY-4.0": [("ccby4-note",)],
    "BSD-3-Clause": [("bsd-3-clause-note",), ("bsd-grant", "bsd-name")],
    "BSD-2-Clause": [("bsd-2-clause-note",), ("bsd-grant",)],
    "GPL": [("gpl-note",), ("gpl-warranty",)],
}
for _license in [*NAMES, *ALONE]:
    RULES.setdefault(_license, [(f"{_license.lower()}-{end}",) for table, end in ((NAMES, "note"), (ALONE, "text")) if _license in table])
#: A recognised license that holds another's rule hides it: a name with a version the name without, any the mere reservation.
HIDES = {x: tuple(y for y in ("GPL", "LGPL", "AGPL", "BSD", "Proprietary") if x != y and (y == "Proprietary" or (y in x if y == "GPL" else x.startswith(y + "-")))) for x in RULES}
HIDES["BSD-3-Clause"] += ("BSD-2-Clause",)
HIDES["Proprietary"] = ()

#: Words of a name in place of a *.
SLOT = 30
_SPDX = re.compile(r"SPDX-License-Identifier:[ \t]*([^\r\n]*)", re.IGNORECASE)
_TERM = re.compile(r"[\s(]*([A-Za-z0-9][A-Za-z0-9.+-]*)[)]*")
_KNOWN = {x.lower(): x for x in RULES}


def spdx_terms(text: str) -> list[tuple[str, int, int]]:
    """(license, start, end) of the terms of SPDX license lines; -only, -or-later and + are left out of the names, exceptions skipped."""
    out = []
    for line in _SPDX.finditer(text):
        at, before = line.start(1), "or"
        while term := _TERM.match(text, at, line.end()):
            word, at = term[1], term.end()
            operator = word.lower() in ("and", "or", "with")
            if operator == (before in ("and", "or", "with")):
                break
            if not operator and before != "with" and word.upper() not in ("NONE", "NOASSERTION"):
                name = re.sub(r"(-only|-or-later|\+)$", "", word, flags=re.IGNORECASE)
                out.append((_KNOWN.get(name.lower(), name), term.start(1), term.end(1)))
            before = word.lower() if operator else ""
    return out


_ENDS = re.compile(r"\n|(?<=[.!?:;])(?=\s)")
_WORDS = re.compile(r"[A-Za-z0-9]+")
#: The first word of a line or sentence, nothing where the line has none left.
_FIRST = re.compile(r"(?:\A\n?|\n|(?<=[.!?:;)])(?=\s))[^A-Za-z0-9\n]*([A-Za-z0-9]+|(?=\n)|\Z)")


def normal(sentence: str) -> str:
    """Lower-case ASCII words joined by spaces."""
    return " ".join(_WORDS.findall(sentence)).lower()


class Recogniser:
    """Sentence table and rules in force."""

    def __init__(self, sentences: dict[str, Sequence[str]] = SENTENCES, rules: dict[str, Sequence[Sequence[str]]] = RULES):
        #: Tree of the sentences' words; the identifier of a sentence stands under the empty word.
        self.tree: dict = {}
        for name, texts in sentences.items():
            for text in texts:
                node = self.tree
                for word in re.findall(r"[a-z0-9]+|\*", text.lower()):
                    node = node.setdefault(word, {})
                node[""] = name
        self.rules = rules

    def _longest(self, text: str, start: int, node: dict, last: int | None = None) -> tuple[str, int] | None:
        """(identifier, end of the last word) of the longest known sentence from here that ends where a sentence can."""
        found = None
        for word in _WORDS.finditer(text, start):
            if "" in node and _ENDS.search(text, last, word.start()):
                found = node[""], last
            if "*" in node and (named := self._after_name(text, word.start(), node["*"])):
                return named
            node = node.get(word[0].lower())
            if node is None:
                return found
            last = word.end()
        return (node[""], last) if "" in node else found

    def _after_name(self, text: str, start: int, node: dict) -> tuple[str, int] | None:
        last = None
        for n, word in zip(range(SLOT + 1), _WORDS.finditer(text, start)):
            if n and "" in node and _ENDS.search(text, last, word.start()):
                return node[""], last
            if n and word[0].lower() in node and (found := self._longest(text, word.start(), node, last)):
                return found
            last = word.end()
        return (node[""], last) if "" in node and last and not _WORDS.search(text, last) else None

    def sentences(self, text: str | None) -> list[tuple[str, int, int]]:
        """(identifier, start, end) of the known sentences, in order; the end takes in the signs up to white space."""
        out, at = [], 0
        while text and at < len(text) and (first := _FIRST.search(text, at)):
            at = max(first.end(), at + 1)
            if first[1].lower() in self.tree and (found := self._longest(text, first.start(1), self.tree)):
                start = first.start(1)
                while start > first.start() and not text[start - 1].isspace():
                    start -= 1
                at = found[1]
                end = at
                while end < len(text) and not text[end].isspace():
                    end += 1
                out.append((found[0], start, end))
        if text and "spdx" in text.lower():
            out = sorted([*out, *[(f"spdx-{name}", a, b) for name, a, b in spdx_terms(text)]], key=lambda x: x[1:])
        return out

    def licenses(self, ids: Sequence[str]) -> list[str]:
        """Licenses whose rule is an ordered subsequence of the identifiers."""
        if not ids:
            return []
        found = {name for name, rules in self.rules.items() for rule in rules if _follows(ids, rule)}
        found |= {x.removeprefix("spdx-") for x in ids if x.startswith("spdx-")}
        if any(x.startswith("spdx-") for x in ids):
            found.discard("Proprietary")
        return sorted(found - {x for name in found for x in HIDES.get(name, ())})


@cache
def usual() -> Recogniser:
    """The recogniser of the tables above, built once in each process."""
    return Recogniser()


def _follows(ids: Sequence[str], rule: Sequence[str]) -> bool:
    rest = iter(ids)
    return all(want in rest for want in rule)


def licenses(docs: DataFrame, key: str = "doc_id", text: str = "text", sentences=None, rules=None) -> DataFrame:
    """(key, licenses array<string>, n_sentences, spans): recognised licenses and known sentences of every whole text.

    ``spans`` lists identifier:start:end in code points, end exclusive, comma-joined in order. One row per input row.
    """

    def make():
        known = Recogniser(sentences or SENTENCES, rules or RULES) if sentences or rules else usual()

        def step(c):
            hits = [known.sentences(t) for t in c["text"]]
            return {
                "key": c["key"], "licenses": [known.licenses([h[0] for h in x]) for x in hits], "n_sentences": [len(x) for x in hits],
                "spans": [",".join(f"{n}:{a}:{b}" for n, a, b in x) for x in hits],
            }

        return step

    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    schema = f"key {kind}, licenses array<string>, n_sentences long, spans string"
    return map_texts(rows, "text", schema, make).withColumnRenamed("key", key)
