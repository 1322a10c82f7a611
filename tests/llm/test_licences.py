import math

import pytest

from obligato.llm import licences

MIT, GPL = "Released under the MIT License.", "This work is licensed under the GNU General Public License, version 3."


def scanned(spark, rows, schema="path string, text string"):
    df = spark.createDataFrame(rows, schema)
    return df, licences.scan(df, licences.fit(df))


def test_headers_files_and_inheritance(spark):
    prose = "some words of prose\n" * 30
    rows = [("/a/LICENSE", MIT), ("/a/x.txt", prose), ("/a/b/c/y.txt", prose), ("/a/b/COPYING.md", "head\n" + GPL + "\ntail"),
            ("/a/b/z.txt", prose + "// " + MIT + "\n" + prose), ("/q/w.txt", prose), ("/a/b/e.txt", ""), ("/a/b/n.txt", None), (None, prose),
            ("/a/c/LICENSE", prose), ("/a/c/v.txt", prose), ("nodir.txt", prose), ("/a/x.txt", prose)]
    _, out = scanned(spark, rows)
    got = sorted((r.path or "", r.licence, r.how, r.source) for r in out.collect())
    expected = [
        ("/a/LICENSE", "MIT", "file", None), ("/a/x.txt", "MIT", "inherited", "/a/LICENSE"), ("/a/x.txt", "MIT", "inherited", "/a/LICENSE"),
        ("/a/b/c/y.txt", "GPL-3.0", "inherited", "/a/b/COPYING.md"), ("/a/b/COPYING.md", "GPL-3.0", "file", None),
        ("/a/b/z.txt", "MIT", "header", None), ("/q/w.txt", None, "none", None), ("/a/b/e.txt", "GPL-3.0", "inherited", "/a/b/COPYING.md"),
        ("/a/b/n.txt", "GPL-3.0", "inherited", "/a/b/COPYING.md"), ("", None, "none", None), ("/a/c/LICENSE", "MIT", "inherited", "/a/LICENSE"),
        ("/a/c/v.txt", "MIT", "inherited", "/a/LICENSE"), ("nodir.txt", None, "none", None)]
    assert got == sorted(expected)


def test_several_licence_files_in_a_directory(spark):
    rows = [("/d/LICENSE-b", MIT), ("/d/LICENSE-a", GPL), ("/d/f", "prose"), ("/d/LICENSE-c", MIT + " and other unrelated words here")]
    _, out = scanned(spark, rows)
    assert {r.path: r.source for r in out.collect()}["/d/f"] == "/d/LICENSE-a"


def test_notice_over_several_lines_and_within_prose(spark):
    m = licences.Matcher(licences.TEMPLATES, licences.THRESHOLD, 100, {"the": 90, "license": 10, "licensed": 10, "this": 60, "is": 50, "under": 8})
    assert m.best(b"x y\nThis work is licensed under\nthe GNU General Public\nLicense, version 3.\nz")[1] == "GPL-3.0"
    assert m.best(b"the word licensed stands in prose that is long enough to hide what it says here") is None
    assert m.best(None) is None and m.best(b"") is None and m.best(b"\n\n") is None


def test_cosine_and_sign_words_match_a_direct_computation():
    m = licences.Matcher(licences.TEMPLATES, 0.7, 1000, {"the": 900, "under": 40, "license": 7})
    words = licences.words_of(b"released under the MIT license today")
    idf = lambda w: math.log(1001 / (1 + {"the": 900, "under": 40, "license": 7}.get(w, 0))) + 1
    a = {w: idf(w) for w in "released under the mit license today".split()}
    b = {w: idf(w) for w in "released under the mit license".split()}
    cosine = sum(b[w] * a[w] for w in b) / math.sqrt(sum(x * x for x in a.values()) * sum(x * x for x in b.values()))
    assert m.cosine(words) == (pytest.approx(cosine), "MIT")
    for _, v in m.templates:  # words outside the signs alone never reach the threshold
        rest = {w: x for w, x in v.items() if w not in m.signs}
        assert math.sqrt(sum(x * x for x in rest.values())) < m.threshold


def test_clashing_columns_and_empty_table(spark):
    df, out = scanned(spark, [("/a/LICENSE", MIT, 1, "q"), ("/a/b", "x", 2, "r")], "path string, text string, dir int, own string")
    assert {r.path: r.licence for r in out.collect()} == {"/a/LICENSE": "MIT", "/a/b": "MIT"}
    assert licences.scan(df.limit(0), licences.fit(df.limit(0))).count() == 0


def test_neighbouring_words_and_corpus_size_do_not_hide_a_notice(spark):
    texts = ["Released under the MIT License by Acme.", "Released under the MIT License. All rights reserved.",
             "Copyright 2021 Acme. Released under the MIT License.", "prose before it, released under the MIT License, and prose behind it " + "word " * 40]
    apache = "Licensed under the Apache License, Version 2.0. See LICENSE for details."
    for documents in (100, 10 ** 8):
        m = licences.Matcher(licences.TEMPLATES, licences.THRESHOLD, documents, {"the": documents // 2, "license": documents // 10})
        assert [m.best(t.encode())[1] for t in texts] == ["MIT"] * 4
        assert m.best(apache.encode())[1] == "Apache-2.0"
    rows = [(f"/p/{i}", t) for i, t in enumerate([*texts, apache])]
    _, out = scanned(spark, rows)
    assert sorted((r.path, r.licence, r.how) for r in out.collect()) == [
        (p, "Apache-2.0" if t == apache else "MIT", "header") for p, t in rows]


def test_words_that_no_template_has_weigh_by_their_document_frequency(spark):
    text = "Released beneath the MIT License"
    rows = [("/x", text)] + [(f"/{i}", "beneath the prose") for i in range(30)]
    df, out = scanned(spark, rows)
    m = licences.fit(df)
    got = {r.path: (r.licence, r.score) for r in out.collect()}
    frequency = {"released": 1, "beneath": 31, "the": 31, "mit": 1, "license": 1}
    direct = licences.Matcher(licences.TEMPLATES, licences.THRESHOLD, 31, frequency)
    score, name = direct.best(text.encode())
    assert m.documents == 31 and got["/x"] == (name, pytest.approx(score, abs=1e-8))
    assert score > licences.Matcher(licences.TEMPLATES, 0.1, 31, frequency | {"beneath": 0}).best(text.encode())[0]


BSD = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:\n"
       "1. Redistributions of source code must retain the above copyright notice.\n2. Redistributions in binary form must reproduce the above "
       "copyright notice.\n")
THIRD = "3. Neither the name of the holder nor the names of its contributors may be used to endorse or promote products.\n"
DISCLAIMER = "THIS SOFTWARE IS PROVIDED AS IS\n"
GNU = "This program is free software: you can redistribute it and/or modify it under the terms of the GNU {}, either version {} of the License, or any later version."
RELATIVES = [
    ("This work is licensed under the GNU General Public License, version 2.", "GPL-2.0"), (GPL, "GPL-3.0"),
    ("This work is licensed under version 2 of the GNU General Public License.", "GPL-2.0"),
    ("This work is licensed under the GNU General Public License v3.", "GPL-3.0"),
    ("This work is licensed under the GNU General Public License, version 1.", None),
    ("This work is licensed under the GNU General Public License.", None),
    ("This work is licensed under the GNU Affero General Public License, version 3.", "AGPL-3.0"),
    ("This library is licensed under the GNU Lesser General Public License, version 2.1.", "LGPL-2.1"),
    ("This library is licensed under the GNU Lesser General Public License, version 3.", "LGPL-3.0"),
    *[(GNU.format(f"{kind}General Public License as published by the Free Software Foundation", version), name) for kind, version, name in
      [("", "2", "GPL-2.0"), ("", "3", "GPL-3.0"), ("Affero ", "3", "AGPL-3.0"), ("Lesser ", "2.1", "LGPL-2.1"), ("Lesser ", "3", "LGPL-3.0")]],
    *[(f"Licensed under CC BY{x} 4.0.", f"CC-BY{x}-4.0") for x in ("", "-NC", "-ND", "-SA", "-NC-ND", "-NC-SA")],
    *[(f"This work is licensed under a Creative Commons Attribution{x} 4.0 International License.", f"CC-BY{y}-4.0") for x, y in
      [("", ""), ("-NonCommercial", "-NC"), ("-NoDerivatives", "-ND"), ("-ShareAlike", "-SA"), ("-NonCommercial-ShareAlike", "-NC-SA")]],
    ("Licensed under CC BY 3.0.", None), ("Licensed under the Apache License, Version 1.1.", None),
    ("Licensed under the Apache License 2.0", "Apache-2.0"), ("Licensed under the Apache License, Version 2.0.", "Apache-2.0"),
    ("Licensed under the BSD 2-Clause License.", "BSD-2-Clause"), ("Licensed under the BSD 3-Clause License.", "BSD-3-Clause"),
    (BSD + DISCLAIMER, "BSD-2-Clause"), (BSD + THIRD + DISCLAIMER, "BSD-3-Clause"),
    (BSD + DISCLAIMER + "other parts: " + THIRD, "BSD-2-Clause"),
    (BSD + "3. All advertising materials must display this.\n" + THIRD + DISCLAIMER, None),
    ("Released under the ISC License.", None), ("Released under the MIT No Attribution License.", None), (MIT, "MIT"),
    ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 1.1.", None),
    ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "MPL-2.0"),
]


@pytest.mark.parametrize("documents", [100, 10 ** 8])
@pytest.mark.parametrize("around", ["{}", "Copyright 2021 Acme. {} See the file for more."])
def test_relatives_are_told_apart(documents, around):
    m = licences.Matcher(licences.TEMPLATES, licences.THRESHOLD, documents, {"the": documents // 2, "license": documents // 10, "version": documents // 20})
    got = [(t, (m.best(around.format(t).encode()) or (0, None))[1]) for t, _ in RELATIVES]
    assert got == RELATIVES


def test_every_template_with_its_own_words_tells_its_licence():
    m = licences.Matcher(licences.TEMPLATES, licences.THRESHOLD, 100, {})
    for name, text in licences.TEMPLATES:
        if not text.startswith("Redistribution"):  # shared; the conditions after it tell
            assert m.best(text.encode())[1] == name


def test_a_directory_inherits_the_relative_not_the_listed_neighbour(spark):
    rows = [("/a/LICENSE", RELATIVES[0][0]), ("/a/x.txt", "prose"), ("/b/LICENSE", "Licensed under CC BY-SA 3.0."), ("/b/y.txt", "prose")]
    _, out = scanned(spark, rows)
    assert {r.path: r.licence for r in out.collect()} == {"/a/LICENSE": "GPL-2.0", "/a/x.txt": "GPL-2.0", "/b/LICENSE": None, "/b/y.txt": None}
