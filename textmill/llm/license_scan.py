"""License scans by sentence rules.

A sentence ends at a line end, or at . ! ? before white space, but for a single letter's full stop, and
after the mark of a list (1. or a. or 2) or (3), at the begin of a line); a
text is also read with its single line ends as spaces, for notices that are wrapped; a line whose words all vanish is blank there. A sentence is normalised to its words in
lower case without any ASCII character but letters and digits; words that vanish (comment marks, bullets) are
skipped. Known sentences have an identifier, found by the hash of the normalised sentence and
confirmed on the words themselves. The identifiers of a text, in order, are then matched against RULES, in
their order: a rule's identifiers have to follow each other with at most GAP other known sentences in
between, and a sentence serves one match at most.

Nulls and so on: a null, empty or wordless text has no sentences and no matches; rows stand each for
themselves; extra columns are ignored; an empty table gives an empty result. Whole texts are read.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from textmill.llm._text import Words, member, slices, spans, texts, whole

#: Other known sentences, and bytes, between two sentences of a rule at most.
GAP, REACH = 2, 2000
#: What a text states that has no other licence and reserves all rights.
RESERVED = "Proprietary"
# Sentences of public licence notices, as their authors publish them.
MIT_GRANT = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"
MIT_NOTICE = "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."
SENTENCES = {
    "mit-line": [
        "Released under the MIT License.", "Licensed under the MIT License.", "This project is licensed under the MIT License.",
        "Distributed under the MIT License.", "The MIT License (MIT)", "MIT License", "SPDX-License-Identifier: MIT"
    ],
    "mit-grant": [MIT_GRANT, MIT_GRANT + " " + MIT_NOTICE],
    "mit-notice": [MIT_NOTICE],
    "apache-line": [
        "Licensed under the Apache License, Version 2.0.", "Released under the Apache License, Version 2.0.", "Apache License, Version 2.0",
        "SPDX-License-Identifier: Apache-2.0"
    ],
    "apache-grant": [
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
        "Licensed under the Apache License, Version 2.0 (the \"License\");",
        "Licensed under the Apache License, Version 2.0 (the \"License\")"
    ],
    "apache-use": ["you may not use this file except in compliance with the License."],
    "apache-copy": [
        "You may obtain a copy of the License at", "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"
    ],
    "gpl3-line": [
        "This work is licensed under the GNU General Public License, version 3.",
        "Licensed under the GNU General Public License, version 3.", "Licensed under the GNU GPL, version 3.",
        "SPDX-License-Identifier: GPL-3.0-only"
    ],
    "gpl3-later-line": ["SPDX-License-Identifier: GPL-3.0-or-later"],
    "gpl2-line": [
        "This work is licensed under the GNU General Public License, version 2.",
        "Licensed under the GNU General Public License, version 2.", "SPDX-License-Identifier: GPL-2.0-only"
    ],
    "gpl2-later-line": ["SPDX-License-Identifier: GPL-2.0-or-later"],
    "gpl3-grant": [
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."
    ],
    "gpl2-grant": [
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."
    ],
    "gpl-hope": [
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."
    ],
    "gpl-see": ["See the GNU General Public License for more details."],
    "lgpl-line": ["Licensed under the GNU Lesser General Public License, version 3.", "SPDX-License-Identifier: LGPL-3.0-only"],
    "lgpl-later-line": ["SPDX-License-Identifier: LGPL-3.0-or-later"],
    "agpl-line": ["Licensed under the GNU Affero General Public License, version 3.", "SPDX-License-Identifier: AGPL-3.0-only"],
    "agpl-later-line": ["SPDX-License-Identifier: AGPL-3.0-or-later"],
    "bsd-use": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"
    ],
    "bsd-source": [
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."
    ],
    "bsd-binary": [
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
    ],
    "bsd-name": [
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
    ],
    "bsd3-line": ["Licensed under the 3-Clause BSD License.", "SPDX-License-Identifier: BSD-3-Clause"],
    "bsd2-line": ["Licensed under the 2-Clause BSD License.", "SPDX-License-Identifier: BSD-2-Clause"],
    "isc-grant": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."
    ],
    "mpl-line": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License, version 2.0.", "SPDX-License-Identifier: MPL-2.0"
    ],
    "mpl-copy": ["If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."],
    "unlicense": ["This is free and unencumbered software released into the public domain."],
    "cc0-line": [
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
        "Licensed under CC0 1.0.", "SPDX-License-Identifier: CC0-1.0"
    ],
    "cc-by-line": [
        "Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-4.0"
    ],
    "cc-by-sa-line": [
        "Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-SA-4.0"
    ],
    "cc-by-nc-line": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-NC-4.0"
    ],
    "cc-by-nd-line": [
        "Licensed under CC BY-ND 4.0.",
        "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License."
    ],
    "as-is": [
        "The software is provided \"as is\", without warranty of any kind.",
        "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.",
        "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS.",
        "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.",
    ],
    "reserved": ["All rights reserved."],
}
# Licences by the identifiers that state them, the more telling rule first.
RULES = [
    (
        "MIT", ("mit-line", "mit-grant", "mit-notice", "as-is")
    ), ("MIT", ("mit-grant", "mit-notice", "as-is")), (
        "MIT", ("mit-line", "mit-grant", "mit-notice")
    ), ("MIT", ("mit-grant", "mit-notice")), ("MIT", ("mit-grant", "as-is")), (
        "Apache-2.0", ("apache-grant", "apache-use", "apache-copy")
    ), ("Apache-2.0", ("apache-grant", "apache-copy")), ("Apache-2.0", ("apache-grant",)),
    (
        "GPL-3.0-or-later", ("gpl3-grant", "gpl-hope", "gpl-see")
    ), (
        "GPL-2.0-or-later", ("gpl2-grant", "gpl-hope", "gpl-see")
    ), ("GPL-3.0-or-later", ("gpl3-grant",)), ("GPL-2.0-or-later", ("gpl2-grant",)),
    (
        "BSD-3-Clause", ("bsd-use", "bsd-source", "bsd-binary", "bsd-name", "as-is")
    ), (
        "BSD-3-Clause", ("bsd-use", "bsd-source", "bsd-binary", "bsd-name")
    ), (
        "BSD-2-Clause", ("bsd-use", "bsd-source", "bsd-binary", "as-is")
    ), ("ISC", ("isc-grant", "as-is")), ("BSD-2-Clause", ("bsd-use", "bsd-source", "bsd-binary")), ("MPL-2.0", ("mpl-line", "mpl-copy")),
    ("MIT", ("mit-line",)), ("MIT", ("mit-grant",)), (
        "Apache-2.0", ("apache-line",)
    ), ("GPL-3.0-only", ("gpl3-line",)), ("GPL-2.0-only", ("gpl2-line",)), (
        "LGPL-3.0-only", ("lgpl-line",)
    ), ("AGPL-3.0-only", ("agpl-line",)),
    ("GPL-3.0-or-later", ("gpl3-later-line",)), ("GPL-2.0-or-later", ("gpl2-later-line",)), (
        "LGPL-3.0-or-later", ("lgpl-later-line",)
    ), ("AGPL-3.0-or-later", ("agpl-later-line",)),
    (
        "BSD-3-Clause", ("bsd3-line",)
    ), (
        "BSD-2-Clause", ("bsd2-line",)
    ), ("ISC", ("isc-grant",)), ("MPL-2.0", ("mpl-line",)), ("Unlicense", ("unlicense",)), ("CC0-1.0", ("cc0-line",)),
    ("CC-BY-4.0", ("cc-by-line",)), (
        "CC-BY-SA-4.0", ("cc-by-sa-line",)
    ), ("CC-BY-NC-4.0", ("cc-by-nc-line",)), ("CC-BY-ND-4.0", ("cc-by-nd-line",)), (RESERVED, ("reserved",)),
]

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_KEPT = np.zeros(256, bool)
_KEPT[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True
_STOPS = np.zeros(256, bool)
_STOPS[[ord(c) for c in ".!?"]] = True


def normalised(text: str) -> tuple[str, ...]:
    words = (
        "".join(c for c in w if c.isascii() and c.isalnum() or not c.isascii())
        for w in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text).split()
    )
    return tuple(w for w in words if w)


class Sentences:
    """Sentences of some texts under one reading: per sentence its text, first and end byte, and hash."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lines: bool):
        w = Words(data, offsets)
        self.n = 0
        if not w.n:
            return
        low = _LOWER[data]
        kept = _KEPT[low]
        # the kept bytes of every word, closed up
        cum = np.r_[0, np.cumsum(kept)]
        a, b = cum[w.start], cum[w.end]
        word = spans(low[kept], a, b)
        some = b > a
        closes = _STOPS[data[w.end - 1]] & (b - a != 1)
        newline = np.r_[0, np.cumsum(data == 10)]
        # line ends since the word before that does not vanish
        last = np.maximum.accumulate(np.where(some, np.arange(w.n), -1))[:-1]
        between = np.r_[newline[w.start[1:]] - np.where(last >= 0, newline[w.end[last]], 0), 0]
        closes |= between >= (1 if lines else 2)
        # a list's mark, the first word of a line that does not vanish, is a sentence of its own
        before = np.r_[1, between[:-1]] > 0
        begins = before & some
        begins[w.first[:-1][np.diff(w.first) > 0]] |= some[w.first[:-1][np.diff(w.first) > 0]]
        head = data[w.start + (data[w.start] == ord("(")) * (w.end - w.start > 1)]
        digit = (head >= 48) & (head <= 57)
        tail = data[w.end - 1]
        mark = begins & (
            w.end - w.start - (b - a) == 1 + (data[w.start] == ord("("))
        ) & ((tail == ord(".")) | (tail == ord(")"))) & ((b - a == 1) | (digit & (b - a == 2)))
        closes |= mark
        closes[:-1] |= mark[1:]
        closes[w.first[1:][np.diff(w.first) > 0] - 1] = True
        ends = np.flatnonzero(closes)
        first = np.r_[0, ends[:-1] + 1]
        at = np.r_[0, np.cumsum(some)]
        cut = np.r_[at[first], at[-1]]
        self.hash = whole(word[some], cut, 31)
        go = np.diff(cut) > 0
        self.doc, self.start, self.end, self.hash = w.doc[first[go]], w.start[first[go]], w.end[ends[go]], self.hash[go]
        self.n = len(self.doc)


@lru_cache(1)
def known() -> tuple[np.ndarray, list[tuple[str, ...]], list[str]]:
    """Sorted hashes of known sentences, and for each the words and the identifier."""
    rows = {}
    for name, sentences in SENTENCES.items():
        for s in sentences:
            words = normalised(s)
            data, off = texts(pa.array([" ".join(words)]))
            rows[int(Sentences(data, off, True).hash[0])] = (words, name)
    keys = np.array(sorted(rows), np.uint64)
    return keys, [rows[int(k)][0] for k in keys], [rows[int(k)][1] for k in keys]


def recognise(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, list[list[tuple[int, int, str]]]]:
    """Sentences of each text (by lines); for each text its known sentences (first byte, end byte, identifier), in order."""
    keys, words, names = known()
    n_docs = len(offsets) - 1
    found: list[dict] = [{} for _ in range(n_docs)]
    count = np.zeros(n_docs, np.int64)
    for lines in (True, False):
        s = Sentences(data, offsets, lines)
        if not s.n:
            continue
        if lines:
            count = np.bincount(s.doc, minlength=n_docs)
        for i in np.flatnonzero(member(keys, s.hash)):
            k = int(np.searchsorted(keys, s.hash[i]))
            if normalised(data[s.start[i] : s.end[i]].tobytes().decode("utf-8", "replace")) == words[k]:
                found[s.doc[i]].setdefault((int(s.start[i]), int(s.end[i])), names[k])
    return count, [_apart(f) for f in found]


def _apart(found: dict[tuple[int, int], str]) -> list[tuple[int, int, str]]:
    """The sentences that overlap no longer one, in order."""
    out: list[tuple[int, int, str]] = []
    for (a, b), name in sorted(found.items(), key=lambda x: (x[0][0] - x[0][1], x[0][0])):
        i = bisect_left(out, (a, b))
        if (i == 0 or out[i - 1][1] <= a) and (i == len(out) or b <= out[i][0]):
            insort(out, (a, b, name))
    return out


def match(found: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """(first, end, licence) of the rules' matches in a sequence of (first byte, end byte, identifier), by place."""
    ids = [name for _, _, name in found]
    used, out, where = [False] * len(ids), [], {}
    for i, x in enumerate(ids):
        where.setdefault(x, []).append(i)
    for licence, rule in RULES:
        if not all(x in where for x in rule):
            continue
        for i in where[rule[0]]:
            at = [] if used[i] else [i]
            for want in rule[1:] if at else ():
                near = range(at[-1] + 1, min(len(ids), at[-1] + 2 + GAP))
                j = next((j for j in near if ids[j] == want and not used[j] and found[j][0] - found[at[-1]][1] <= REACH), None)
                if j is None:
                    break
                at.append(j)
            if len(at) == len(rule):
                for j in at:
                    used[j] = True
                out.append((at[0], at[-1] + 1, licence))
    if any(x != RESERVED for _, _, x in out):
        out = [x for x in out if x[2] != RESERVED]
    return sorted(out)


MATCHES = "array<struct<licence:string,first_byte:int,end_byte:int>>"
_MATCHES = pa.list_(pa.struct([("licence", pa.string()), ("first_byte", pa.int32()), ("end_byte", pa.int32())]))


def _scan(batches):
    for batch in batches:
        data, off = texts(batch.column("text"))
        for a, b in slices(off):
            base = off[a : b + 1] - off[a]
            count, found = recognise(data[off[a] : off[b]], base)
            matches = []
            for i, f in enumerate(found):
                m = match(f) if f else []
                matches.append(
                    [{"licence": x, "first_byte": f[s][0] - int(base[i]), "end_byte": f[e - 1][1] - int(base[i])} for s, e, x in m]
                )
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id").slice(a, b - a), "n_sentences": pa.array(count, pa.int64()), "n_known": pa.array(
                    [len(f) for f in found], pa.int64()
                ),
                "licences": pa.array(
                    [sorted({m["licence"] for m in ms}) for ms in matches], pa.list_(pa.string())
                ), "matches": pa.array(matches, _MATCHES),
            })


def scan(docs: DataFrame) -> DataFrame:
    """Per row of (doc_id, text): doc_id, n_sentences, n_known, licences (each once, sorted), matches (with bytes of the text)."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        _scan, f"doc_id {kind}, n_sentences long, n_known long, licences array<string>, matches {MATCHES}"
    )


def op4_license_scan(spark, sf_dir: str) -> DataFrame:
    return scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))
