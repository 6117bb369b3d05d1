import re

from rillstone.llm import licenses


def rows(spark, *texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {r.doc_id: r for r in licenses.scan(docs).collect()}


def labels(row):
    return {b.label for b in row.base} | {n.label for n in row.notices}


def test_notices(spark):
    got = rows(
        spark,
        "Some text. Released under the MIT License. More.",
        "Licensed under the Apache License, Version 2.0.",
        "This work is licensed under the GNU General Public License, version 3.",
        "Licensed under CC BY-NC 4.0.",
        "All rights reserved.",
        "General license for the public; rights all reserved; by cc",
        "permission is hereby granted free of charge to any person",
    )
    assert "mit" in labels(got[0])
    # the longest phrase of a place; the base phrases stay
    assert labels(got[1]) == {"apache-2.0"}
    assert labels(got[2]) == {"gpl", "gpl-3.0"} and {n.label for n in got[2].notices} == {"gpl-3.0"}
    assert labels(got[3]) == {"cc-by", "cc-by-nc"} and {n.label for n in got[3].notices} == {"cc-by-nc"}
    assert "reserved" in labels(got[4])
    assert not labels(got[5]) and got[5].score == 0
    assert "mit" in labels(got[6])
    assert all(0 <= r.score <= 1 for r in got.values())


def test_bodies_and_identifiers(spark):
    got = rows(
        spark,
        "# SPDX-License-Identifier: Apache-2.0\nimport this",
        "// SPDX-License-Identifier: GPL-3.0-or-later",
        "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO",
        "Redistributions of source code must retain the above copyright notice, this list",
        "it under the terms of the GNU Lesser General Public License as published by",
        "You may not use this file except in compliance with the License.",
        "spdx identifier license mit; the software is as is",
    )
    assert [sorted(labels(got[i])) for i in range(7)] == [
        ["apache-2.0"], ["gpl-3.0"], ["mit"], ["bsd"], ["gpl", "lgpl"], ["apache-2.0"], [],
    ]


def test_a_longer_phrase_hides_only_what_it_contains(spark):
    got = rows(spark, "Apache License. And the Apache License, Version 2.0. " * 3)
    assert sorted(n.label for n in got[0].notices) == ["apache"] * 3 + ["apache-2.0"] * 3


def test_anchors_must_agree_on_a_place(spark):
    got = rows(spark, "apache one two license three version", "mit x x x license")
    assert not labels(got[0]) and not labels(got[1])


def test_base_places_against_plain_search(spark, odd_docs):
    texts = {
        1: "cc by CC-BY cc cc by", 2: "all rights reserved all rights\nreserved rights all",
        3: "The GENERAL public. license general public license", 4: None, 5: "", 6: "ünlicense cc by",
    }
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    for r in licenses.scan(docs).collect():
        low = re.sub("[A-Z]", lambda m: m[0].lower(), texts[r.doc_id] or "")
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
        expected = sorted(
            (label, i)
            for phrase, label in licenses.BASE.items()
            for i in range(len(words))
            if words[i : i + len(phrase.split())] == phrase.split()
        )
        assert sorted((b.label, b["at"]) for b in r.base) == expected
        assert r.n_words == len(words)


def test_kelvin_sign_is_no_letter_k(spark):
    got = rows(spark, "MPL İ Mozilla Public License Version 2.0 K k")
    assert "mpl-2.0" in labels(got[0]) and got[0].n_words == 10


def test_odd_and_empty(spark, odd_docs, no_docs):
    got = licenses.scan(odd_docs).collect()
    assert len(got) == odd_docs.count()
    assert all(r.n_words == 0 and r.score == 0 for r in got if r.doc_id in (0, 1, 2, 3))
    assert licenses.scan(no_docs).count() == 0


def test_no_shuffle_and_no_python(spark):
    plan = licenses.op1_license_scan(spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Join" not in plan
