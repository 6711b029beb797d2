import pyarrow as pa

from textmill.llm import license_scan as L
from textmill.llm._text import texts


def found(*t):
    data, off = texts(pa.array(t))
    return [[x for _, _, x in L.match(f)] for f in L.recognise(data, off)[1]]


def commented(lines, mark):
    return "\n".join((mark + " " + x).rstrip() for x in lines)


def bsd(marks, three):
    s = {k: L.SENTENCES[k][0] for k in ("bsd-use", "bsd-source", "bsd-binary", "bsd-name")}
    wrap = lambda x: x.replace(" the following", "\n   the following").replace(" names of", "\n   names of")
    items = [f"{m} {wrap(s[k])}" for m, k in zip(marks, ("bsd-source", "bsd-binary", "bsd-name")[: 2 + three])]
    return ("Copyright (c) 2020 X\n\n" + s["bsd-use"].replace(" forms,", " forms,\n") + "\n\n" + "\n\n".join(items)).split("\n")


def test_numbered_bsd():
    for marks in (("1.", "2.", "3."), ("a.", "b.", "c."), ("1)", "2)", "3)"), ("(1)", "(2)", "(3)"), ("*", "*", "*")):
        for mark in ("", "#", " *", "//"):
            got = found(commented(bsd(marks, True), mark), commented(bsd(marks, False), mark))
            assert got == [["BSD-3-Clause"], ["BSD-2-Clause"]], (marks, mark)


def test_blank_comment_lines():
    for mark in (" *", "#", "//", ";;"):
        gpl = [
            "Copyright (c) X", "", *L.SENTENCES["gpl3-grant"][0].replace(" modify it", "\nmodify it").split("\n"), "",
            *L.SENTENCES["gpl-hope"][0].split(" but ", 1), "", "See the GNU General Public", "License for more details."
        ]
        gpl[4] += ""
        mit = [
            "Copyright (c) X", "", *L.MIT_GRANT.replace(" and associated", "\nand associated").split("\n"), "",
            *L.MIT_NOTICE.replace(" in all", "\nin all").split("\n")
        ]
        got = found(commented(mit, mark), "/*\n" + commented(mit, mark) + "\n */")
        assert got == [["MIT"], ["MIT"]], mark
        assert found(commented(gpl[:4], mark)) == [["GPL-3.0-or-later"]], mark


def test_versions_reserved_rights_and_distance():
    spdx = "SPDX-License-Identifier: "
    names = [f"{x}-{k}" for x in ("GPL-2.0", "GPL-3.0", "LGPL-3.0", "AGPL-3.0") for k in ("only", "or-later")]
    assert found(*[spdx + x for x in names]) == [[x] for x in names]
    assert found(
        "All rights reserved.", "Copyright X. All rights reserved.\n\n" + "\n".join(bsd(("1.", "2.", "3."), True))
    ) == [["Proprietary"], ["BSD-3-Clause"]]
    far = L.MIT_GRANT + "\n\n" + "other words here. " * 400 + "\n\n" + L.SENTENCES["as-is"][1]
    assert found(far) == [["MIT"]]
    data, off = texts(pa.array([far, L.MIT_GRANT + "\n\n" + L.MIT_NOTICE + "\n\n" + L.SENTENCES["as-is"][1]]))
    assert [[m[:2] for m in L.match(f)] for f in L.recognise(data, off)[1]] == [[(0, 1)], [(0, 3)]]


def test_apache_notice_once():
    notice = [
        "Licensed under the Apache License, Version 2.0 (the \"License\");",
        "you may not use this file except in compliance with the License.", "You may obtain a copy of the License at", "",
        "    http://www.apache.org/licenses/LICENSE-2.0"
    ]
    for mark in ("", "#", " *"):
        assert found(commented(notice, mark) if mark else "\n".join(notice)) == [["Apache-2.0"]]


def test_against_every_sentence(spark):
    """Empty table, nulls, repeated rows, extra columns and a very long text."""
    line = "Released under the MIT License."
    rows = [(1, None, "a"), (2, "", "b"), (3, line, "c"), (3, line, "c"), (None, "x\n" * 300_000 + line + "\n" + "y " * 300_000, "d")]
    d = spark.createDataFrame(rows, "doc_id long, text string, licences string")
    got = sorted(((r.doc_id or 0, list(r.licences)) for r in L.scan(d).collect()))
    assert got == [(0, ["MIT"]), (1, []), (2, []), (3, ["MIT"]), (3, ["MIT"])]
    assert L.scan(d.limit(0)).count() == 0
