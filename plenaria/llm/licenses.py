"""License scans by conditional compression.

A block is a line with a cue word and what follows it up to an empty line. Windows of about three times a template's length are
cut around the cue words, wherever lines and paragraphs break. The size of a window under zstandard, alone and with each template as raw
dictionary, gives the bytes saved; a template of which at least `gain` of its own size is saved is confirmed by
exact wording differences: the words missing, added and changed in the stretch of the window that fits it best may be
at most 1 - `share` of the template's words, and none of them may be a number or a word that makes it another
licence (`MARKS`). Candidates are ranked by the bytes that their template saves; of confirmed stretches that overlap the one of
the greatest reduction counts.

Scale: one pass, no shuffle; only windows with a cue are compressed, each cue is in a bounded number of windows, and templates are a constant.

Null and empty texts have no blocks; every document gives a row. Ties go to the template first by
name. Repeated rows give repeated results; an empty table gives no rows. Only the named columns are read.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from . import common

#: Notices by which texts name their licence.
_BSD = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"
_BSD_2 = _BSD + " Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
_BSD_3 = " Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
_BSD_END = " THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES,"
_FREE = "This program is free software: you can redistribute it and/or modify it under the terms of the GNU {0} General Public License as published by the Free Software Foundation, either version {1} of the License, or (at your option) any later version."


def _gnu(kind: str, version: str) -> list[str]:
    return [t.replace("GNU  ", "GNU ") for t in (f"This work is licensed under the GNU {kind} General Public License, version {version}.", _FREE.format(kind, version))]


def _cc(short: str, long: str) -> list[str]:
    return [f"Licensed under CC {short} 4.0.", f"This work is licensed under a Creative Commons {long} 4.0 International License."]


def _spdx(*names: str) -> list[str]:
    return [f"SPDX-License-Identifier: {n}" for n in names]


def _short(*names: str) -> list[str]:
    """The usual one-line notices of a licence under the names it goes by."""
    return [form.format(n) for n in names for form in ("This project is licensed under the {0} license.", "Licensed under the {0} license.", "Available under the terms of the {0} license.", "License: {0}", "This project is {0} licensed.")]


_MIT = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction"
_MIT_END = ", including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."
_APACHE = "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."
_APACHE_END = " You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."
_ISC = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."

#: BSD: the opening sentence without its conditions, which BSD-2-Clause and BSD-3-Clause share.
TEMPLATES = {
    "AGPL-3.0": [*_gnu("Affero", "3"), *_spdx("AGPL-3.0-only", "AGPL-3.0-or-later")],
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0.", _APACHE, _APACHE + _APACHE_END, *_short("Apache 2.0", "Apache-2.0", "Apache License 2.0"), *_spdx("Apache-2.0")],
    "BSD": [_BSD],
    "BSD-2-Clause": [_BSD_2 + _BSD_END, *_short("BSD 2-Clause", "BSD-2-Clause"), *_spdx("BSD-2-Clause")],
    "BSD-3-Clause": [_BSD_2 + _BSD_3, _BSD_3.strip(), *_short("BSD 3-Clause", "BSD-3-Clause"), *_spdx("BSD-3-Clause")],
    "BSL-1.0": ["Distributed under the Boost Software License, Version 1.0.", *_spdx("BSL-1.0")],
    "CC-BY-4.0": _cc("BY", "Attribution"),
    "CC-BY-NC-4.0": _cc("BY-NC", "Attribution-NonCommercial"),
    "CC-BY-NC-ND-4.0": _cc("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives"),
    "CC-BY-NC-SA-4.0": _cc("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"),
    "CC-BY-ND-4.0": _cc("BY-ND", "Attribution-NoDerivatives"),
    "CC-BY-SA-4.0": _cc("BY-SA", "Attribution-ShareAlike"),
    "CC0-1.0": ["To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights to this software to the public domain worldwide.", *_spdx("CC0-1.0")],
    "EPL-2.0": ["This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0", *_spdx("EPL-2.0")],
    "GPL-2.0": [*_gnu("", "2"), *_short("GPLv2", "GPL-2.0"), *_spdx("GPL-2.0-only", "GPL-2.0-or-later")],
    "GPL-3.0": [*_gnu("", "3"), *_short("GPLv3", "GPL-3.0"), *_spdx("GPL-3.0-only", "GPL-3.0-or-later")],
    "ISC": [_ISC, *_short("ISC"), *_spdx("ISC")],
    "LGPL-2.1": [*_gnu("Lesser", "2.1"), *_spdx("LGPL-2.1-only", "LGPL-2.1-or-later")],
    "LGPL-3.0": [*_gnu("Lesser", "3"), *_spdx("LGPL-3.0-only", "LGPL-3.0-or-later")],
    "MIT": ["Released under the MIT License.", "Licensed under the MIT License.", _MIT + ".", _MIT + _MIT_END, *_short("MIT"), *_spdx("MIT")],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", *_short("MPL 2.0", "MPL-2.0"), *_spdx("MPL-2.0")],
    "Unlicense": ["This is free and unencumbered software released into the public domain.", *_spdx("Unlicense")],
    "Zlib": ["Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:", *_spdx("Zlib")],
}
CUES = (b"licen", b"permission", b"redistribution", b"copyright", b"unencumbered")
GAIN, SHARE = 0.3, 0.9
#: Words that make another licence of the same wording.
MARKS = re.compile(r"[0-9]|lesser|library|affero|documentation|commercial|deriv|sharealike|(?:^|-)(?:nc|nd|sa)(?:-|$)|^not$")
#: Numbers of a list's points; a version at the start of a line is none.
POINT = re.compile(r"(?m)(?<!ersion\n)^[^\w\n]*[0-9][.)](?=\s)")
TOKEN = re.compile(r"[A-Za-z0-9]+(?:[.-][A-Za-z0-9]+)*")


def blocks(text: bytes) -> list[str]:
    """Lines with a cue, each joined with what follows it up to an empty line."""
    low = text.lower()
    if not any(c in low for c in CUES):
        return []
    out, taken = [], -1
    lines = text.decode("utf-8").split("\n")
    marks = [any(c in x for c in CUES) for x in low.split(b"\n")]
    for i, marked in enumerate(marks):
        if marked and i > taken:
            taken = i
            while taken + 1 < len(lines) and lines[taken + 1].strip():
                taken += 1
            out.append(" ".join(lines[i : taken + 1]).strip())
    return out


def fit(said: list[str], words: list[str]) -> tuple[int, int, int, list[str]]:
    """(start, end, differences, differing words of both) of the stretch of said with the fewest differences from words."""
    n = len(words)
    for i in range(len(said) - n + 1):
        if said[i] == words[0] and said[i : i + n] == words:
            return i, i + n, 0, []
    table = [list(range(n + 1))]
    for w in said:
        last, row = table[-1], [0]
        for j in range(n):
            row.append(min(last[j] + (w != words[j]), last[j + 1] + 1, row[j] + 1))
        table.append(row)
    end = min(range(len(table)), key=lambda i: (table[i][n], -i))
    i, j, differ = end, n, []
    while j:
        here = table[i][j]
        if i and here == table[i - 1][j - 1] + (said[i - 1] != words[j - 1]):
            differ += [] if said[i - 1] == words[j - 1] else [said[i - 1], words[j - 1]]
            i, j = i - 1, j - 1
        elif i and here == table[i - 1][j] + 1:
            differ.append(said[i - 1])
            i -= 1
        else:
            differ.append(words[j - 1])
            j -= 1
    return i, end, table[end][n], differ


class Scanner:
    def __init__(self, templates: dict[str, list[str]], gain: float = GAIN, share: float = SHARE):
        import zstandard as z

        self.gain, self.share = gain, share
        self.alone = z.ZstdCompressor(level=19)
        empty = len(self.alone.compress(b""))
        self.given = [(name, TOKEN.findall(t.lower()), len(self.alone.compress(t.encode())) - empty, z.ZstdCompressor(level=19, dict_data=z.ZstdCompressionDict(t.encode(), dict_type=z.DICT_TYPE_RAWCONTENT))) for name, texts in sorted(templates.items()) for t in texts]

    def found(self, text: bytes) -> list[tuple[str, float, int]]:
        """(licence, share of the template's size saved, differing words) of every confirmed notice, each once, in order."""
        plain = POINT.sub(lambda m: " " * len(m[0]), text.decode("utf-8"))
        at = [(m.start(), m.end()) for m in TOKEN.finditer(plain)]
        said = [plain[a:b].lower() for a, b in at]
        cues, held, out = [c.decode() for c in CUES], set(said), []
        near = [i for i, w in enumerate(said) if any(c in w for c in cues)]
        for given in self.given:
            words = given[1]
            if sum(w in held for w in words) < self.share * len(words):
                continue
            reach, k = len(words) * 5 // 4, 0
            while k < len(near):
                last = near[k] + reach
                lo, hi = max(0, near[k] - reach), min(len(said), last + reach + 1)
                out += [(a + lo, b + lo, *x) for a, b, *x in self._window(given, plain[at[lo][0] : at[hi - 1][1]], said[lo:hi])]
                while k < len(near) and near[k] <= last:
                    k += 1
        return [x[2:5] for x in _strongest(out)]

    def _window(self, given: tuple, window: str, said: list[str]) -> list[tuple]:
        (name, words, own, compressor), raw, out = given, window.encode(), []
        reduction = len(self.alone.compress(raw)) - len(compressor.compress(raw))
        saved = reduction / own
        if saved < self.gain:
            return out
        left, shift = said, 0
        while len(left) >= self.share * len(words):  # every place of the template in the window
            a, b, n, differ = fit(left, words)
            if n > (1 - self.share) * len(words) + 1e-9:
                break
            if not any(MARKS.search(w) for w in differ):
                out.append((a + shift, b + shift, name, round(min(1.0, saved), 4), n, reduction))
            left, shift = left[b:], shift + b
        return out


def _strongest(found: list[tuple]) -> list[tuple]:
    """Of stretches (start, end, name, share saved, words that differ, bytes saved) that overlap the one of the greatest
    reduction, in order; equal ones: the longest, then the one that differs least."""
    out: list[tuple] = []
    for x in sorted(set(found), key=lambda x: (-x[5], x[0] - x[1], x[4], x[2], x[0])):
        if all(x[1] <= y[0] or y[1] <= x[0] for y in out):
            out.append(x)
    return sorted(out)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: dict[str, list[str]] | None = None) -> DataFrame:
    """doc_id, n_blocks, license (of the strongest notice, null: none), licenses (all, sorted), reduction (share of the template's size saved), n_diff."""
    common.shared_dir(docs.sparkSession)
    rows = common.pick(docs, id=id_col, text=text_col)
    templates = templates or TEMPLATES

    def run(batches):
        import pyarrow as pa

        scanner = Scanner(templates)
        for piece in common.pieces(batches):
            out = []
            for text in common.encoded(piece.column("text")):
                here = blocks(text)
                found = sorted((-f[1], f[0], f[2]) for f in (scanner.found(text) if here else []))
                top = found[0] if found else (None, None, None)
                out.append((len(here), top[1], sorted({f[1] for f in found}), -top[0] if found else None, top[2]))
            cols = list(zip(*out, strict=True))
            kinds = [pa.int64(), pa.string(), pa.list_(pa.string()), pa.float64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([piece.column("id"), *[pa.array(c, k) for c, k in zip(cols, kinds, strict=True)]], names=["doc_id", "n_blocks", "license", "licenses", "reduction", "n_diff"])

    return rows.mapInArrow(run, f"doc_id {rows.schema['id'].dataType.simpleString()}, n_blocks long, license string, licenses array<string>, reduction double, n_diff long")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op8: the licence that every document names."""
    return scan(common.table(spark, sf_dir, "documents"))
