"""Licence scans by sentence-rule recognition.

Texts are cut into lines, sentences of a line and sentences over several
lines; each is normalised (lower case, letters and digits only) and looked up
in a table of known licence sentences. The identifiers found, in text order,
are matched against ordered licence rules: a rule matches where its
identifiers follow one another without another known sentence between them.
"""

from __future__ import annotations

import re
from functools import cache
from itertools import product

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import map_batches, small_batches

# Names of licences, public licence texts by sentence.
NAMES = {
    "MIT": ("mit license", "the mit license", "mit"),
    "Apache-2.0": ("the apache license version 2 0", "apache license 2 0", "apache 2 0", "the apache 2 0 license"),
    "GPL-2.0": ("the gnu general public license version 2", "gpl 2 0", "gplv2"),
    "GPL-3.0": ("the gnu general public license version 3", "gpl 3 0", "gplv3"),
    "LGPL-3.0": ("the gnu lesser general public license version 3", "lgpl 3 0"),
    "AGPL-3.0": ("the gnu affero general public license version 3", "agpl 3 0"),
    "BSD-2-Clause": ("the bsd 2 clause license", "bsd 2 clause"),
    "BSD-3-Clause": ("the bsd 3 clause license", "bsd 3 clause"),
    "ISC": ("the isc license", "isc"),
    "MPL-2.0": ("the mozilla public license version 2 0", "mpl 2 0"),
    "CC0-1.0": ("cc0 1 0", "cc0"),
    "CC-BY-4.0": ("cc by 4 0", "a creative commons attribution 4 0 international license"),
    "CC-BY-SA-4.0": ("cc by sa 4 0", "a creative commons attribution sharealike 4 0 international license"),
    "CC-BY-NC-4.0": ("cc by nc 4 0", "a creative commons attribution noncommercial 4 0 international license"),
    "CC-BY-ND-4.0": ("cc by nd 4 0", "a creative commons attribution noderivatives 4 0 international license"),
    "Unlicense": ("the unlicense", "unlicense"),
}
SUBJECTS = ("", "this work is ", "this software is ", "this file is ", "this project is ", "this program is ")
VERBS = ("licensed under ", "released under ", "distributed under ", "available under ", "published under ")
TEXTS = {
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions "
        "of the Software",
        "The software is provided \"as is\", without warranty of any kind, express or implied, including but not "
        "limited to the warranties of merchantability, fitness for a particular purpose and noninfringement"),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0 (the \"License\")",
        "you may not use this file except in compliance with the License",
        "You may obtain a copy of the License at"),
    "GPL-3.0": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version",
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
        "implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE"),
    "GPL-2.0": (
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation; either version 2 of the License, or (at your "
        "option) any later version",
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
        "implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE"),
    "LGPL-3.0": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation; either version 3 of the License, or (at "
        "your option) any later version",
        "This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
        "implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE"),
    "AGPL-3.0": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, or (at "
        "your option) any later version",
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
        "implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE"),
    "MPL-2.0": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",),
    "BSD-2-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the "
        "following disclaimer",
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
        "following disclaimer in the documentation and/or other materials provided with the distribution"),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies",),
    "Unlicense": ("This is free and unencumbered software released into the public domain",),
}
BSD_ENDORSE = ("Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
               "promote products derived from this software without specific prior written permission")
# Every known sentence holds one of these.
_TRIGGER = re.compile(r"licen[sc]e|permission|redistribut|warrant|spdx|under|you may|public domain|free software"
                      r"|either version", re.I)
_SENTENCE = re.compile(r"(?<=[.;:!?])\s+")
_BLANK = re.compile(r"\n[^\S\n]*\n\s*")
_MARK = re.compile(r"^(?:\d+ |[a-z] |\(c\) )")


def normal(sentence: str) -> str:
    """Lower case; runs of anything but letters and digits are one space; no list mark in front."""
    s = " ".join(re.findall(r"[^\W_]+", sentence.lower()))
    return _MARK.sub("", s)


def _parts(sentence: str) -> list[str]:
    """The units that the scan makes of a known sentence, if it is cut."""
    parts = [u for _, _, u in _split(sentence, 0)]
    return [u for u in parts if _TRIGGER.search(u)] if len(parts) > 1 else []


@cache
def sentences() -> dict[str, str]:
    """Normalised known sentences to their identifiers."""
    out = {}
    for name, aliases in NAMES.items():
        for alias in aliases:
            for subject in SUBJECTS:
                for verb in VERBS:
                    for the in ("", "the "):
                        for tail in ("", " license"):
                            out.setdefault(f"{subject}{verb}{the}{alias}{tail}", f"{name}:notice")
            out[f"spdx license identifier {alias}"] = f"{name}:notice"
        out[f"spdx license identifier {normal(name)}"] = f"{name}:notice"
    for name, listed in TEXTS.items():
        for i, s in enumerate(listed):
            for j, part in enumerate((s, *_parts(s))):
                out.setdefault(normal(part), f"{name}:{i + 1}" + (f".{j}" if j else ""))
    out[normal(BSD_ENDORSE)] = "BSD:endorse"
    return out


@cache
def rules() -> list[tuple[str, str, tuple[str, ...]]]:
    """``(rule, licence, identifiers in order)``, longer rules first."""
    out = [(f"{name}/notice", name, (f"{name}:notice",)) for name in NAMES]
    known = sentences()
    for name, listed in TEXTS.items():
        # Each sentence as one unit (a line) or as the units it is cut into.
        ways = [[(known[normal(s)],)] + ([tuple(known[normal(u)] for u in _parts(s))] if _parts(s) else [])
                for s in listed]
        out += [(f"{name}/text", name, sum(way, ())) for way in product(*ways)]
    out.append(("BSD-3-Clause/text", "BSD-3-Clause", ("BSD-2-Clause:1", "BSD-2-Clause:2", "BSD-2-Clause:3",
                                                     "BSD:endorse")))
    return sorted(out, key=lambda r: (-len(r[2]), r[0]))


def _units(text: str):
    """``(start, end, text)`` of lines, of sentences in a line, and of sentences over lines, whole and between blank
    lines (headings and copyright lines have no full stop)."""
    at = 0
    for line in text.split("\n"):
        if line.strip():
            yield at, at + len(line), line
            yield from _split(line, at)
        at += len(line) + 1
    for start, end, unit in _split(text, 0):
        if "\n" in unit:
            yield start, end, unit
            if _BLANK.search(unit):
                yield from _split(unit, start, _BLANK)


def _split(text: str, at: int, ends: re.Pattern = _SENTENCE):
    start = 0
    for m in ends.finditer(text):
        yield at + start, at + m.start(), text[start:m.start()]
        start = m.end()
    yield at + start, at + len(text), text[start:]


def tightest(found: set[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """The units that hold no other unit of the same identifier: one sweep from the last start to the first."""
    least: dict[str, int] = {}           # of an identifier, the first end among the units that start later
    out = []
    for start, end, name in sorted(found, key=lambda f: (-f[0], f[1])):
        if least.get(name, end + 1) > end:
            out.append((start, end, name))
            least[name] = end
    return out


def recognise(text: str | None) -> list[tuple[int, int, str]]:
    """Known sentences: ``(start, end, identifier)`` in text order, without overlaps (the tightest unit of one
    sentence, the longest of different ones that start together)."""
    if not text or not _TRIGGER.search(text):
        return []
    known = sentences()
    found = {(s, e, known[n]) for s, e, u in _units(text) if _TRIGGER.search(u) and (n := normal(u)) in known}
    found = tightest(found)
    out: list[tuple[int, int, str]] = []
    for f in sorted(found, key=lambda f: (f[0], -f[1])):
        if not out or f[0] >= out[-1][1]:
            out.append(f)
    return out


def match(found: list[tuple[int, int, str]]) -> list[tuple[str, str, int, int, int]]:
    """``(rule, licence, start, end, sentences)`` of the rules along a sequence of known sentences."""
    out, i = [], 0
    ids = [f[2] for f in found]
    while i < len(ids):
        for name, licence, wanted in rules():
            if tuple(ids[i:i + len(wanted)]) == wanted:
                out.append((name, licence, found[i][0], found[i + len(wanted) - 1][1], len(wanted)))
                i += len(wanted)
                break
        else:
            i += 1
    return out


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, rule, licence, start, end, sentences``: a row for each rule found in each text.

    Positions are code points. Null and empty texts and texts without known
    sentences give no rows. Repeated rows give their rows again; null ids
    stay null. Other columns are not read.
    """
    small_batches(docs.sparkSession)
    names = ("doc_id", "rule", "licence", "start", "end", "sentences")

    def run(batches):
        for b in batches:
            rows = [(d, *m) for d, t in zip(b["doc_id"], b["text"], strict=True) for m in match(recognise(t))]
            yield {c: [r[i] for r in rows] for i, c in enumerate(names)}

    return map_batches(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")), run,
                       "doc_id long, rule string, licence string, start long, end long, sentences long")
