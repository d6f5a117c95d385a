import math
from collections import Counter

import pytest

from brandflow.llm import license_scan, spdx

APACHE = "# Licensed under the Apache License, Version 2.0."


def test_lines_files_and_inheritance(spark):
    rows = [
        (1, "p/LICENSE", "Released under the MIT License."),
        (2, "p/a/x.py", "code\nmore code"),
        (3, "p/a/b/y.py", f"text\n{APACHE}\ncode"),
        (4, "p/a/b/c/z.py", None),
        (5, "p/a/b/COPYING", "This work is licensed under the GNU General Public License, version 3."),
        (6, "q/w.py", "the license of the version under which"),
        (7, None, "no path"),
        (8, "top.py", ""),
        (9, "p/a/b/c/z.py", "Licensed under CC BY 4.0 for everyone who has time to read such a long line about nothing at all"),
    ]
    files = spark.createDataFrame([(*r, "x", "y") for r in rows], "file_id long, path string, text string, licence string, directory string")
    matcher = license_scan.fit_matcher(files)
    got = {r["file_id"]: (r["licence"], r["line"], r["inherited_from"]) for r in license_scan.licences(files, matcher).collect()}
    assert got == {
        1: ("MIT", 0, None), 2: ("MIT", -1, "p"), 3: ("Apache-2.0", 1, None), 4: ("GPL-3.0", -1, "p/a/b"), 5: ("GPL-3.0", 0, None),
        6: (None, -1, None), 7: (None, -1, None), 8: (None, -1, None), 9: ("GPL-3.0", -1, "p/a/b"),
    }
    assert license_scan.licences(files.limit(0), license_scan.fit_matcher(files.limit(0))).collect() == []


def test_screening_loses_nothing(docs):
    """Every line of the table, compared with every template without the prefix filter."""
    matcher = license_scan.fit_matcher(docs)
    n = docs.count()
    texts = [r["text"] or "" for r in docs.collect()]
    words = {w for t in license_scan.TEMPLATES.values() for w in license_scan.words(t)}
    for w in words:
        df = sum(any(x == w for x in license_scan.words(t)) for t in texts)
        assert abs(matcher.idf[w] - math.log((1 + n) / (1 + df)) - 1e-3) < 1e-9
    hits = Counter()
    for text in texts:
        best = (None, 0.0, -1)
        for k, line in enumerate(text.lower().split("\n")):
            found = matcher.best(line)
            if found and found[1] > best[1]:
                best = (*found, k)
        assert matcher.scan(text) == best
        hits[best[0]] += 1
    assert len(hits) > 2


def test_odd_rows(odd):
    files = odd.selectExpr("doc_id AS file_id", "concat('d/', doc_id) AS path", "text", "lang", "label")
    assert license_scan.licences(files, license_scan.fit_matcher(files)).count() == odd.count()


def test_texts_headers_tags_and_several_licences(spark):
    texts = license_scan.licence_texts()
    header = "\n".join(f" * {line}" for line in texts["Apache-2.0.header"].split("\n"))
    gnu = "\n".join(f"# {line}" for line in texts["GPL-3.0.header"].split("\n"))
    rows = [
        (1, "p/LICENSE", "MIT License\n\nCopyright (c) 2020 Some Body\n\n" + texts["MIT"].split("\n", 1)[1]),
        (2, "p/a/x.py", "code = 1"),
        (3, "q/x.c", f"/*\n * Copyright 2020 Some Body\n{header}\n */\n" + "\n".join(f"int variable{k} = {k};" for k in range(300))),
        (4, "q/y.py", "import one\n# Licensed under the Apache License,\n# Version 2.0.\nimport two"),
        (5, "q/z.py", f"#!/bin/python\n{gnu}\nimport one"),
        (6, "q/w.rs", "fn one()\n// SPDX-License-Identifier: (MIT OR Apache-2.0) AND GPL-2.0-only WITH Classpath-exception-2.0\n"),
        (7, "q/v.py", "Released under the MIT License.\ncode\nThis work is licensed under the GNU General Public License, version 3."),
        *((10 + k, f"t{k}/COPYING", t) for k, t in enumerate(texts.values())),
    ]
    files = spark.createDataFrame(rows, "file_id long, path string, text string")
    got = {r["file_id"]: r for r in license_scan.licences(files, license_scan.fit_matcher(files)).collect()}
    assert got[1]["licence"] == "MIT" and (got[2]["licence"], got[2]["inherited_from"]) == ("MIT", "p")
    assert (got[3]["licence"], got[4]["licence"], got[4]["line"], got[5]["licence"]) == ("Apache-2.0", "Apache-2.0", 1, "GPL-3.0")
    assert {(x["licence"], x["line"]) for x in got[6]["licences"]} == {("MIT", 1), ("Apache-2.0", 1), ("GPL-2.0-only", 1)}
    assert {(x["licence"], x["line"]) for x in got[7]["licences"]} >= {("MIT", 0), ("GPL-3.0", 2)}
    for k, name in enumerate(texts):
        assert got[10 + k]["licence"] == name.removesuffix(".header")


@pytest.mark.parametrize(
    "line, want",
    [
        ("MIT Copyright 2020 Foo", "MIT"),
        ("Apache-2.0 see the file LICENSE for details", "Apache-2.0"),
        ("MIT OR Apache-2.0", "MIT OR Apache-2.0"),
        ("mit or apache-2.0 */", "MIT OR Apache-2.0"),
        ("(MIT OR Apache-2.0) AND GPL-2.0-only WITH Classpath-exception-2.0 -->", "(MIT OR Apache-2.0) AND GPL-2.0-only WITH Classpath-exception-2.0"),
        ("GPL-2.0+", "GPL-2.0+"),
        ("MIT AND unknown words", "MIT"),
        ("GPL-2.0-only WITH no-such-exception", "GPL-2.0-only"),
        ("LicenseRef-Own-1 OR ISC", "LicenseRef-Own-1 OR ISC"),
        ("(MIT OR", None),
        ("NONE", None),
        ("NOASSERTION", None),
        ("Foo", None),
        ("2020", None),
        ("", None),
    ],
)
def test_spdx_expressions(line, want):
    assert spdx.expression(line) == want
    if want:
        assert all(name in spdx.IDENTIFIERS or "LicenseRef" in name for name in (n.removesuffix("+") for n in spdx.identifiers(want)))


def test_stated_licences_of_files_and_directories(spark):
    tag = "// SPDX-License-Identifier: "
    rows = [
        (1, "a/LICENSE", tag + "MIT OR Apache-2.0"),
        (2, "a/b/x.c", "int x;"),
        (3, "c/x.c", tag + "MIT Copyright 2020 Foo"),
        (4, "c/y.c", tag + "NONE"),
        (5, "c/z.c", "\n" * 20_000 + (tag + "ISC\nint y;\n") * 3000),
        (6, "c/z.c", "\n" * 20_000 + (tag + "ISC\nint y;\n") * 3000),
        (7, "d/COPYING", "GNU AFFERO GENERAL PUBLIC LICENSE\n" + license_scan.licence_texts()["GPL-3.0"].split("\n", 1)[1]),
    ]
    files = spark.createDataFrame(rows, "file_id long, path string, text string")
    got = {r["file_id"]: r for r in license_scan.licences(files, license_scan.fit_matcher(files)).collect()}
    assert (got[1]["licence"], got[2]["licence"], got[2]["inherited_from"]) == ("MIT OR Apache-2.0", "MIT OR Apache-2.0", "a")
    assert [(x["licence"], x["cosine"]) for x in got[3]["licences"]] == [("MIT", 1.0)] and got[3]["licence"] == "MIT"
    assert got[4]["licence"] is None and not got[4]["licences"]
    assert (got[5]["licence"], got[5]["line"]) == ("ISC", 20_000) and got[5][2:] == got[6][2:]
    assert got[7]["licence"] == "AGPL-3.0"
