"""License scans by conditional compression.

Lines of a text that use a license's vocabulary are candidates, with GAP lines before and after; candidates less than
2 GAP apart are one block. A block, and each candidate line in it, is compressed on its own and with each wording as
zstandard's raw dictionary; the bytes saved, as a share of the size on its own or of the wording's if that is less,
times the wording's size rank the wordings, so of two that are there the longer one comes first. Wordings of which a
telling word isn't in the block at all can't be confirmed, and aren't tried. With a dictionary a long input is parsed worse than without, so what is over SHORT bytes is
compressed in windows instead, around every match of the vocabulary and as wide as the wording needs. Those that save
MIN_SAVED or more are confirmed, best first, by the exact differences: wherever a stretch of the block's words as long
as the wording has enough of its words, the two are aligned, and the wording is found where at most MAX_DIFFERENT of its
words are missing or come with others between them, and none of the words that tell licenses apart (numbers and the
like) differs. A confirmed wording takes its words, and the next ones have to be found in what is left. So the cost
grows with the number of a block's words, whatever its length.

The table WORDINGS is a choice: notices, titles, identifiers and the grants of short licenses, not every license in use.
SPDX expressions are taken apart (`words`), and each of their licenses that the table knows has a row.

Defined results: a null or empty text has no candidates; a very long line or block is scanned whole; a document without
a license has no row; of wordings that save alike the last by name comes first; repeated rows are scanned each; an empty
table gives no rows; other columns don't matter, whatever their names.
"""

from __future__ import annotations

import difflib
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from functools import cache, reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

GAP = 4
MIN_SAVED = 0.15
#: Wordings of so many words save too little to be cut by it; they are ranked all the same.
FEW = 4
MAX_DIFFERENT = 0.12
#: Blocks and lines up to so many bytes are compressed whole.
SHORT = 500
VOCABULARY = r"(?i)licen[cs]|copyright|copyleft|warrant|redistribut|permission|spdx|public domain|all rights|creative commons|\bCC[ -]?(?:BY|0)|as is"
#: Strings of which any match of VOCABULARY holds one, in lower case; they are much cheaper to look for.
HINTS = ("licen", "copyright", "copyleft", "warrant", "redistribut", "permission", "spdx", "public domain", "all rights", "creative commons", "cc by", "cc-by", "ccby", "cc 0", "cc-0", "cc0", "as is")
# Wordings of licenses, as their texts and customary notices have them.
WORDINGS = {
    "MIT": (
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "This project is licensed under the terms of the MIT license.",
        "SPDX-License-Identifier: MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
        "The MIT License (MIT)",
        "MIT License",
    ),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Released under the Apache License 2.0.",
        "SPDX-License-Identifier: Apache-2.0",
        "Apache License Version 2.0, January 2004",
        "Apache License 2.0",
        "Apache License, Version 2.0",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "Licensed under the GNU General Public License v3.0.",
        "SPDX-License-Identifier: GPL-3.0-only",
        "SPDX-License-Identifier: GPL-3.0-or-later",
        "GNU GENERAL PUBLIC LICENSE Version 3",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    "GPL-2.0": (
        "This work is licensed under the GNU General Public License, version 2.",
        "SPDX-License-Identifier: GPL-2.0-only",
        "SPDX-License-Identifier: GPL-2.0-or-later",
        "GNU GENERAL PUBLIC LICENSE Version 2",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    ),
    "LGPL-3.0": ("This work is licensed under the GNU Lesser General Public License, version 3.", "SPDX-License-Identifier: LGPL-3.0-only", "SPDX-License-Identifier: LGPL-3.0-or-later", "GNU LESSER GENERAL PUBLIC LICENSE Version 3"),
    "LGPL-2.1": (
        "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1",
        "This work is licensed under the GNU Lesser General Public License, version 2.1.",
        "SPDX-License-Identifier: LGPL-2.1-only",
        "SPDX-License-Identifier: LGPL-2.1-or-later",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    ),
    "AGPL-3.0": ("This work is licensed under the GNU Affero General Public License, version 3.", "SPDX-License-Identifier: AGPL-3.0-only", "SPDX-License-Identifier: AGPL-3.0-or-later", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3"),
    "BSD-3-Clause": (
        "Released under the BSD 3-Clause License.",
        "BSD 3-Clause License",
        "SPDX-License-Identifier: BSD-3-Clause",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    ),
    "BSD-2-Clause": (
        "Released under the BSD 2-Clause License.",
        "BSD 2-Clause License",
        "SPDX-License-Identifier: BSD-2-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    ),
    "MPL-2.0": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "Licensed under the Mozilla Public License, version 2.0.", "SPDX-License-Identifier: MPL-2.0", "Mozilla Public License Version 2.0"),
    "MPL-1.1": ("SPDX-License-Identifier: MPL-1.1", "Mozilla Public License Version 1.1"),
    "EPL-2.0": ("SPDX-License-Identifier: EPL-2.0", "Eclipse Public License - v 2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at"),
    "EPL-1.0": ("SPDX-License-Identifier: EPL-1.0", "Eclipse Public License - v 1.0"),
    "EUPL-1.2": ("SPDX-License-Identifier: EUPL-1.2", "European Union Public Licence v. 1.2", "Licensed under the EUPL, Version 1.2"),
    "BSL-1.0": ("SPDX-License-Identifier: BSL-1.0", "Boost Software License - Version 1.0", "Distributed under the Boost Software License, Version 1.0."),
    "Artistic-2.0": ("SPDX-License-Identifier: Artistic-2.0", "The Artistic License 2.0"),
    "OFL-1.1": ("SPDX-License-Identifier: OFL-1.1", "This Font Software is licensed under the SIL Open Font License, Version 1.1.", "SIL OPEN FONT LICENSE Version 1.1"),
    "CDDL-1.0": ("SPDX-License-Identifier: CDDL-1.0", "COMMON DEVELOPMENT AND DISTRIBUTION LICENSE (CDDL) Version 1.0"),
    "MS-PL": ("SPDX-License-Identifier: MS-PL", "Microsoft Public License (Ms-PL)"),
    "NCSA": ("SPDX-License-Identifier: NCSA", "University of Illinois/NCSA Open Source License"),
    "0BSD": ("SPDX-License-Identifier: 0BSD", "BSD Zero Clause License"),
    "BSD-3-Clause-Clear": ("SPDX-License-Identifier: BSD-3-Clause-Clear", "The Clear BSD License"),
    "Apache-1.1": ("SPDX-License-Identifier: Apache-1.1", "Apache License, Version 1.1"),
    "ISC": ("SPDX-License-Identifier: ISC", "ISC License", "Released under the ISC License.", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    "Zlib": ("Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:", "SPDX-License-Identifier: Zlib"),
    "Unlicense": ("SPDX-License-Identifier: Unlicense", "This is free and unencumbered software released into the public domain.",),
    "CC0-1.0": ("SPDX-License-Identifier: CC0-1.0", "Licensed under CC0 1.0.", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    "CC-BY-4.0": ("SPDX-License-Identifier: CC-BY-4.0", "Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    "CC-BY-SA-4.0": ("SPDX-License-Identifier: CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    "CC-BY-NC-4.0": ("SPDX-License-Identifier: CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    "CC-BY-ND-4.0": ("SPDX-License-Identifier: CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0.", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License."),
    "CC-BY-NC-SA-4.0": ("SPDX-License-Identifier: CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License."),
    "proprietary": ("All rights reserved.",),
}
# Words that tell licenses apart, besides numbers.
TELLING = frozenset("mit apache gnu gpl lgpl agpl lesser affero general bsd clause mozilla mpl isc cc cc0 by nc sa nd attribution sharealike noncommercial noderivatives unlicense unencumbered not no neither clear zero eclipse eupl european boost artistic sil ofl cddl microsoft illinois ncsa".split())
_WORD = re.compile(r"[^\W_]+", re.UNICODE)
_CANDIDATE = re.compile(VOCABULARY)


_SPDX = re.compile(r"(?i)SPDX-License-Identifier:[ \t]*(\(*[A-Za-z0-9.+-]+\)*(?:[ \t]+(?:AND|OR|WITH)[ \t]+\(*[A-Za-z0-9.+-]+\)*)*)")
_HEAD = "SPDX-License-Identifier: "


@cache
def _identifiers() -> frozenset[str]:
    """The identifiers that the table knows, in lower case."""
    return frozenset(text.removeprefix(_HEAD).lower() for texts in WORDINGS.values() for text in texts if text.startswith(_HEAD))


def words(text: str) -> list[str]:
    """Words in lower case; an SPDX expression gives a wording of its own for each of its licenses.

    What WITH is followed by is an exception and no license. An identifier that the table doesn't know is one word, so
    that none that it begins with is found in it.
    """
    out: list[str] = []
    at = 0
    for m in _SPDX.finditer(text):
        out += _words(text[at : m.start()])
        parts = m[1].replace("(", " ").replace(")", " ").split()
        for before, part in zip(["", *parts], parts, strict=False):
            if part.upper() not in ("AND", "OR", "WITH") and before.upper() != "WITH":
                known = part.lower() in _identifiers()
                out += [*_words(_HEAD), *(_words(part) if known else [part.lower()])]
        at = m.end()
    return out + _words(text[at:])


def _words(text: str) -> list[str]:
    return [w.lower().replace("licence", "license") for w in _WORD.findall(text)]


def _telling(w: str) -> bool:
    return w in TELLING or any(c.isdigit() for c in w)


@cache
def _wordings() -> list[tuple[str, int, list[str], object]]:
    """(license, number of the wording, its words, a compressor that has it as dictionary)."""
    import zstandard as z

    return [(name, k, words(text), z.ZstdCompressor(level=19, dict_data=z.ZstdCompressionDict(text.encode(), dict_type=z.DICT_TYPE_RAWCONTENT), write_content_size=False, write_dict_id=False)) for name, texts in WORDINGS.items() for k, text in enumerate(texts)]


@cache
def _plain():
    import zstandard as z

    return z.ZstdCompressor(level=19, write_content_size=False)


def candidates(text: str) -> list[tuple[int, list[str]]]:
    """(first line, lines) of each candidate block."""
    lines = text.split("\n")
    runs: list[list[int]] = []
    for k in (k for k, line in enumerate(lines) if _CANDIDATE.search(line)):
        if runs and k - 2 * GAP <= runs[-1][1]:
            runs[-1][1] = min(len(lines), k + GAP + 1)
        else:
            runs.append([max(0, k - GAP), min(len(lines), k + GAP + 1)])
    return [(a, lines[a:b]) for a, b in runs]


def windows(text: str, hits: list[tuple[int, int]], spans: list[tuple[int, int]], wording: list[str]) -> set[bytes]:
    """The pieces of text that hold the wording if it is at any of the hits, which are numbers of first and last words."""
    room = len(wording) + int(MAX_DIFFERENT * len(wording)) + 1
    most = 2 * len(" ".join(wording)) + 100  # bytes of very long words would dilute it
    out, served = set(), -1
    for first, last in hits:
        if last <= served:
            continue
        served = last + room // 2
        end = min(served, len(spans) - 1)
        a = max(spans[max(0, first - room)][0], spans[first][0] - most)
        b = min(spans[min(len(spans) - 1, end + room)][1], spans[end][1] + most, spans[last][1] + 2 * most)
        out.add(text[a:b].encode())
    return out


def differences(block: list[str], wording: list[str]) -> tuple[int, int, list[str], list[str]] | None:
    """Where the wording lies in the block, its missing words and the strange ones between; None if not in it."""
    match = difflib.SequenceMatcher(None, block, wording, autojunk=False)
    pieces = [m for m in match.get_matching_blocks() if m.size]
    if not pieces:
        return None
    longest = max(range(len(pieces)), key=lambda k: pieces[k].size)
    room = max(1, int(MAX_DIFFERENT * len(wording)) + 1)
    a = b = longest  # pieces far from the main one are chance
    while a > 0 and pieces[a].a - (pieces[a - 1].a + pieces[a - 1].size) <= room:
        a -= 1
    while b + 1 < len(pieces) and pieces[b + 1].a - (pieces[b].a + pieces[b].size) <= room:
        b += 1
    start, end = pieces[a].a, pieces[b].a + pieces[b].size
    missing = wording[: pieces[a].b] + wording[pieces[b].b + pieces[b].size :]
    strange = []
    for x, y in zip(pieces[a:b], pieces[a + 1 : b + 1], strict=True):
        strange += block[x.a + x.size : y.a]
        missing += wording[x.b + x.size : y.b]
    wrong = [w for w in missing + strange if _telling(w)]
    if wrong or len(missing) + len(strange) > MAX_DIFFERENT * len(wording):
        return None
    return start, end, missing, strange


def located(left: list[str], wording: list[str]) -> Iterator[tuple[int, int, list[str], list[str]]]:
    """All places of the wording, first to last, that don't overlap; each alignment is over a few times its words."""
    slack = int(MAX_DIFFERENT * len(wording))
    need, room, own = len(wording) - slack, slack + 1, set(wording)
    hits = [k for k, w in enumerate(left) if w in own]
    at = 0
    while at + need <= len(hits):
        start = hits[at]
        if hits[at + need - 1] - start > need + slack + room:  # too far apart to be one place
            at += 1
            continue
        end = start + len(wording) + slack + 2 * room  # of any place that begins up to `room` words on
        if found := differences(left[start:end], wording):
            a, b, missing, strange = found
            yield start + a, start + b, missing, strange
            at = bisect_left(hits, start + b)
        else:
            at = max(at + 1, bisect_left(hits, start + room))


def scan(text: str) -> list[tuple[int, int, str, int, float, str, str]]:
    """(first line, last line, license, wording, share saved, missing words, strange words) of each license found."""
    out = []
    for first, lines in candidates(text):
        # the whole block, and each of its candidate lines, which a long block would dilute
        text = "\n".join(lines)
        parts = {x.encode() for x in (text, *filter(_CANDIDATE.search, lines))}
        whole = {x for x in parts if len(x) <= SHORT}
        hits: list[tuple[int, int]] = []
        spans: list[tuple[int, int]] = []
        if len(whole) < len(parts):
            spans = [m.span() for m in _WORD.finditer(text)]
            starts, ends = [a for a, _ in spans], [b for _, b in spans]
            hits = [(bisect_right(ends, m.start()), bisect_left(starts, m.end()) - 1) for m in _CANDIDATE.finditer(text)]
        left = [w for line in lines for w in words(line)]
        of = [first + k for k, line in enumerate(lines) for _ in words(line)]
        there = set(left)
        alone: dict[bytes, int] = {}
        saved = []
        for name, k, w, c in _wordings():
            if any(_telling(x) and x not in there for x in w):
                continue  # a telling word that isn't there would be missing, so the wording can't be confirmed
            share = float("-inf")
            for x in whole | windows(text, hits, spans, w):
                n = alone[x] if x in alone else alone.setdefault(x, len(_plain().compress(x)))
                share = max(share, (n - len(c.compress(x))) / min(n, len(" ".join(w))))
            saved.append((share * len(" ".join(w)), share, name, k, w))
        for _, share, name, k, wording in sorted(saved, reverse=True):
            if share < MIN_SAVED and len(wording) > FEW:
                continue
            for start, end, missing, strange in list(located(left, wording)):
                out.append((of[start], of[end - 1], name, k, round(share, 4), " ".join(missing), " ".join(strange)))
                left[start:end] = ["\n"] * (end - start)
    return out


def scanned(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for each license found in a document."""
    names = ("first_line", "last_line", "license", "wording", "saved", "missing", "strange")
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.float64(), pa.string(), pa.string())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, rows = [], []
            for r, text in enumerate(batch.column(1).to_pylist()):
                for row in scan(text):
                    at.append(r)
                    rows.append(row)
            columns = list(zip(*rows, strict=True)) or [[] for _ in names]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int64())), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], [id_col, *names])

    spark_kinds = {pa.int64(): T.LongType(), pa.string(): T.StringType(), pa.float64(): T.DoubleType()}
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), *(T.StructField(n, spark_kinds[k]) for n, k in zip(names, kinds, strict=True))])
    # the text is put in lower case once, for all the hints
    hinted = F.exists(F.array(F.lower(F.col(text_col))), lambda low: reduce(lambda a, b: a | b, (low.contains(h) for h in HINTS)))
    return docs.select(F.col(id_col), F.col(text_col)).where(hinted & F.col(text_col).rlike(VOCABULARY)).mapInArrow(run, schema)


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scanned(spark.read.parquet(f"{sf_dir}/documents.parquet"))
