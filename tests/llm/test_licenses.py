from tidegate.llm import licenses


def test_spellings_case_and_holders(spark, docs):
    mit = dict((k, t) for k, t in licenses.KNOWN if "Permission is hereby granted" in t and t.startswith("The MIT License (MIT)"))["MIT"]
    odd = "Copyright (c) 2020 Someone\n" + mit.replace("sublicense", "sub-licence").upper().replace(",", " ,").replace("\n", " \n")
    rows = [
        (1, mit), (2, odd), (2, odd), (3, "Intro.\nreleased under the MIT LICENCE\nEnd."), (4, None), (5, ""), (6, "© 2020\n"), (None, mit + " and more"),
        (7, "All rights reserved."), (8, "words " * 50000),
    ]
    df = docs([(*r, 1) for r in rows], ", digest int").repartition(3)
    got = sorted(((r["doc_id"] or 0, r["licenses"], [tuple(n) for n in r["notices"]]) for r in licenses.scan(df, licenses.known_licenses(spark)).collect()))
    lone = [(k, [], []) for k in (4, 5, 6, 7, 8)]
    assert got == [(0, [], []), (1, ["MIT"], []), (2, ["MIT"], []), (2, ["MIT"], []), (3, [], [(1, "MIT")]), *lone]


def test_two_names_null_and_empty(spark, docs):
    known = spark.createDataFrame([("B", "Do as you like!"), ("A", "do AS you like"), ("C", None), (None, "x"), ("D", "--")], "license string, text string")
    got = licenses.scan(docs([(1, "(Do as you like)"), (2, "..."), (3, "x")]), known).collect()
    assert sorted((r["doc_id"], tuple(r["licenses"]), tuple(n["license"] for n in r["notices"])) for r in got) == [(1, ("A", "B"), ("A", "B")), (2, (), ()), (3, (), ())]
    assert licenses.scan(docs([]), known).collect() == []


def test_long_texts_and_spdx_lines(spark, docs):
    text = lambda name: (licenses.TEXTS / f"{name}.txt").read_text(encoding="utf-8")
    names = sorted(p.stem for p in licenses.TEXTS.glob("*.txt"))
    assert {"Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "MPL-2.0", "CC0-1.0", "CC-BY-SA-4.0", "Unlicense"} <= set(names)
    rows = [(k, " ".join(text(n).split(" ")).upper().replace("\n\n", "\n \n")) for k, n in enumerate(names)]
    apache = text("Apache-2.0")
    rows += [(100, apache[: apache.index("APPENDIX")]), (101, apache.replace("[yyyy] [name of copyright owner]", "2021 Someone"))]
    rows += [(102, "# SPDX-License-Identifier: BSD-3-Clause"), (103, "x = 1\n/* SPDX-License-Identifier: GPL-2.0-or-later */"), (104, "SPDX-License-Identifier: Made-Up")]
    got = {r["doc_id"]: (r["licenses"], [n["license"] for n in r["notices"]]) for r in licenses.scan(docs(rows), licenses.known_licenses(spark)).collect()}
    assert [got[k][0] for k in range(len(names))] == [[n] for n in names]
    assert got[100][0] == got[101][0] == ["Apache-2.0"]
    assert got[102] == (["BSD-3-Clause"],) * 2 and got[103] == ([], ["GPL-2.0-or-later"]) and got[104] == ([], [])
