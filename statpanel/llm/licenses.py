"""License notices by conditional compression.

Text near the words that license notices use is cut into blocks. Each block is compressed with every template as a raw zstandard
dictionary; the templates that save most are then aligned with the block word by word, and a notice is reported with the exact
differences in wording if what stands there is the template but for a few words.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from difflib import SequenceMatcher
from functools import cache

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statpanel.llm.lexicon import chunks, texts_of

#: Wordings of license notices. {…} stands for words that vary from notice to notice.
TEMPLATES = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the
        License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or
        agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR
        CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and
        limitations under the License.""",
    ],
    "MIT": [
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Distributed under the MIT License.",
        "Released under the terms of the MIT License.",
        """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation
        files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy,
        modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is
        furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included
        in all copies or substantial portions of the Software.""",
    ],
    "BSD-3-Clause": [
        "Released under the BSD 3-Clause License.",
        "Licensed under the BSD 3-Clause License.",
        """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following
        conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the
        following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the
        following disclaimer in the documentation and/or other materials provided with the distribution. Neither the name of the copyright
        holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific
        prior written permission.""",
    ],
    "ISC": [
        """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,
        provided that the above copyright notice and this permission notice appear in all copies.""",
        "Licensed under the ISC License.",
    ],
    "GPL-2.0": [
        "This work is licensed under the GNU General Public License, version 2.",
        "Licensed under the GNU General Public License, version 2.",
        """This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as
        published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.""",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "Licensed under the GNU General Public License, version 3.",
        """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as
        published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.""",
    ],
    "LGPL-3.0": [
        "This work is licensed under the GNU Lesser General Public License, version 3.",
        "Licensed under the GNU Lesser General Public License, version 3.",
    ],
    "AGPL-3.0": [
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "Licensed under the GNU Affero General Public License, version 3.",
    ],
    "MPL-2.0": [
        """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed
        with this file, You can obtain one at http://mozilla.org/MPL/2.0/.""",
        "Licensed under the Mozilla Public License, Version 2.0.",
    ],
    "CC-BY-4.0": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ],
    "CC-BY-SA-4.0": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ],
    "CC-BY-NC-4.0": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "CC0-1.0": ["To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."],
    "Unlicense": ["This is free and unencumbered software released into the public domain."],
    "Proprietary": ["All rights reserved.", "Copyright {…} All rights reserved."],
}
#: Words near which a notice may stand; words that carry a license's name or version and must not differ.
CUES = r"licen[cs]|copyright|all rights reserved|redistribut|permission|public domain|free software|waived|mozilla|creative commons|\bcc[ -]by"
NAMES = re.compile(
    r"\d+(?:\.\d+)*|apache|mit|bsd|clause|isc|gnu|gpl|lgpl|agpl|lesser|affero|mozilla|mpl|cc0?|by|sa|nc|nd|sharealike|noncommercial|noderivatives|commons|unencumbered|waived"
)

#: Words that carry a short notice, of which one may lack or differ.
CARRIERS = frozenset("this the a is under released licensed version v work".split())

#: Templates aligned per block, words around a cue that a block takes, least share of a template's words in place, most words at a {…}.
WINNERS, AROUND, LEAST_SHARE, GAP = 12, 160, 0.9, 12

_CUE = re.compile(CUES, re.I)
_WORD = re.compile(r"\w+(?:\.\d+)*")


@dataclass(frozen=True)
class Template:
    license: str
    words: tuple[str, ...]
    gaps: frozenset[int]  # places in the words before which other words may stand
    shape: zstandard.ZstdCompressor


def words_of(text: str) -> list[tuple[str, int, int]]:
    """Lower-case words, with versions as one word, and their places."""
    return [(m[0].lower(), m.start(), m.end()) for m in _WORD.finditer(text)]


@cache
def templates() -> tuple[Template, ...]:
    out = []
    for name, wordings in TEMPLATES.items():
        for wording in wordings:
            pieces = [[w for w, _, _ in words_of(piece)] for piece in wording.split("{…}")]
            words = tuple(w for piece in pieces for w in piece)
            gaps = frozenset(sum(map(len, pieces[:i])) for i in range(1, len(pieces)))
            known = zstandard.ZstdCompressionDict(" ".join(words).encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            out.append(Template(name, words, gaps, zstandard.ZstdCompressor(level=19, dict_data=known, write_content_size=False)))
    return tuple(out)


def candidate_blocks(text: str) -> list[tuple[int, int]]:
    """Character spans of AROUND words on each side of every cue; spans that touch are one block."""
    cues = [m.start() for m in _CUE.finditer(text)]
    if not cues:
        return []
    places = [(a, b) for _, a, b in words_of(text)]
    out: list[list[int]] = []
    at = 0
    for cue in cues:
        while at + 1 < len(places) and places[at][1] <= cue:
            at += 1
        span = [max(0, at - AROUND), min(len(places), at + AROUND + 1)]
        if out and span[0] <= out[-1][1]:
            out[-1][1] = span[1]
        else:
            out.append(span)
    return [(places[a][0], places[b - 1][1]) for a, b in out]


def ranked(words: list[str]) -> list[tuple[float, Template]]:
    """Templates by the share of the block's compressed size that knowing them saves."""
    block = " ".join(words).encode()
    plain = len(zstandard.ZstdCompressor(level=19, write_content_size=False).compress(block))
    saved = [(1 - len(t.shape.compress(block)) / plain, t) for t in templates()]
    return sorted(saved, key=lambda s: (-s[0], s[1].license, len(s[1].words)))


def align(words: list[str], template: Template) -> list[tuple[int, int, float, list[str]]]:
    """Every stand of the template in the words: from, to, share of its words in place, differences.

    A stand begins where a run of the template's words begins. It counts if LEAST_SHARE of the template's words, or in a template of
    fewer than ten all but one of CARRIERS, stand there in order, no word that names a license or version differs (numbers may be
    put in), and at most one word for eight of the template's is put in, beside up to GAP words at each {…}, which are no difference.
    """
    out, done = [], 0
    goal = template.words
    starts = [i for i, w in enumerate(words) if w in goal[:2]]
    for start in starts:
        if start < done:
            continue
        lead = goal.index(words[start])
        window = words[start : start + len(goal) + len(goal) // 4 + 2 + GAP * len(template.gaps)]
        matcher = SequenceMatcher(None, goal[lead:], window, autojunk=False)
        matches = [m for m in matcher.get_matching_blocks() if m.size]
        hits = sum(m.size for m in matches)
        if hits < min(LEAST_SHARE * len(goal), len(goal) - 1):
            continue
        end = matches[-1].b + matches[-1].size
        changes = [f"-{w}" for w in goal[:lead]]
        for kind, a, b, c, d in matcher.get_opcodes():
            put_in = window[c : min(d, end)]
            if kind == "insert" and lead + a in template.gaps and len(put_in) <= GAP:
                continue
            if kind != "equal":
                changes += [f"-{w}" for w in goal[lead + a : lead + b]] + [f"+{w}" for w in put_in]
        if hits < LEAST_SHARE * len(goal) and not CARRIERS.issuperset(c[1:] for c in changes if c[0] == "-"):
            continue
        if any(NAMES.fullmatch(c[1:]) and not (c[0] == "+" and c[1].isdigit()) for c in changes):
            continue
        if sum(c[0] == "+" for c in changes) > max(1, len(goal) // 8):
            continue
        out.append((start, start + end, hits / len(goal), changes))
        done = start + end
    return out


def notices(text: str) -> list[tuple[str, int, int, float, float, list[str]]]:
    """(license, start, end, saved, share, differences) of each notice in a text; of notices that overlap the longer stays."""
    found = []
    for a, b in candidate_blocks(text):
        placed = [(w, a + s, a + e) for w, s, e in words_of(text[a:b])]
        # A block can hold several notices: rank templates for each cue's own surroundings.
        for lo, hi in _near_cues(text, placed):
            part = placed[lo:hi]
            for saved, template in ranked([w for w, _, _ in part])[: WINNERS]:
                for s, e, share, changes in align([w for w, _, _ in part], template):
                    found.append((template.license, part[s][1], part[e - 1][2], saved, share, changes))
    found.sort(key=lambda f: (f[1] - f[2], -f[4], len(f[5]), f[0], f[1]))
    kept: list[tuple] = []
    for f in found:
        if all(f[2] <= k[1] or f[1] >= k[2] for k in kept):
            kept.append(f)
    return sorted(kept, key=lambda f: f[1])


def _near_cues(text: str, placed: list[tuple[str, int, int]]) -> list[tuple[int, int]]:
    """Word ranges around each cue of a block, one of the length of a short notice and one of a long one."""
    out = set()
    cues = [m.start() for m in _CUE.finditer(text, placed[0][1], placed[-1][2])]
    at = 0
    for cue in cues:
        while at + 1 < len(placed) and placed[at][2] <= cue:
            at += 1
        for around in (14, AROUND):
            out.add((max(0, at - around), min(len(placed), at + around + 1)))
    return sorted(out)


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, license, start, end, notice, saved, share, differences) of every license notice in the whole texts of docs.

    start and end are code points; `saved` is the share of its compressed size that the block loses if the template is known, `share`
    that of the template's words in place, `differences` the template's words that lack (-) and words put in (+). Texts without a notice,
    null texts and empty texts give no row; repeated rows give their rows each; other columns are ignored.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = rows.filter(F.col("text").rlike(f"(?i){CUES}"))  # texts without a cue never leave the JVM

    def run(batches):
        for batch in batches:
            for part in chunks(batch, "text"):
                out = []
                for doc, text in zip(part.column(0).to_pylist(), texts_of(part)):
                    out += [(doc, n, a, b, text[a:b], saved, share, diff) for n, a, b, saved, share, diff in notices(text)]
                columns = zip(*out) if out else [[]] * len(_TYPES)
                arrays = [pa.array(c, t) for c, t in zip(columns, _TYPES.values())]
                yield pa.RecordBatch.from_arrays(arrays, list(_TYPES))

    schema = "doc_id long, license string, start long, end long, notice string, saved double, share double, differences array<string>"
    return rows.mapInArrow(run, schema)


_TYPES = {
    "doc_id": pa.int64(),
    "license": pa.string(),
    "start": pa.int64(),
    "end": pa.int64(),
    "notice": pa.string(),
    "saved": pa.float64(),
    "share": pa.float64(),
    "differences": pa.list_(pa.string()),
}
