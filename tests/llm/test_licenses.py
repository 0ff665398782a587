"""License scan against a plain search, and its suppression of contained detections."""

import re

import brute
import pytest
from pyspark.sql import functions as F

from meterbook.llm import licenses
from meterbook.llm.queries import op10_license_scan

TEXTS = [
    None, "", " ", "mit license", "MIT-License mit  license", "xmit license", "mit licenses", "mït license MIT\nLICENSE",
    "apache license mit license general public license", "general public general public license.", "émit license mit licenseé",
    "a b c Apache, License! 2.0", "word " * 3000 + "Apache License " * 2500, "no words ... !!!", "日本 mit license 𝒳 mit license",
]


def scanned(spark, texts):
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, license_note string")
    return licenses.scan_licenses(docs).orderBy("doc_id").collect()


def test_base_places_equal_a_plain_search(spark):
    for row, text in zip(scanned(spark, TEXTS), TEXTS, strict=True):
        words, places, first, last, labels = brute.license_base(text)
        at = [x for b in row.license.base for x in b["at"]]
        assert (row.license.n_words, len(at), min(at, default=None), max(at, default=None)) == (words, places, first, last)
        assert ",".join(sorted(b.label for b in row.license.base)) == labels
        assert row.license_note == "x"


@pytest.mark.parametrize(("text", "want"), [
    ("Licensed under the Apache License, Version 2.0.", [("apache-2.0", 2)]),
    ("Licensed under CC BY-NC 4.0.", [("cc-by-nc-4.0", 2)]),
    ("This work is licensed under the GNU General Public License, version 3.", [("gpl-3.0", 2)]),
    ("Released under the MIT License.", [("mit", 2)]),
    ("// SPDX-License-Identifier: BSD-3-Clause", [("bsd-3-clause", 1)]),
    ("See the MIT license. All rights reserved.", [("mit", 3), ("all-rights-reserved", 2)]),
    ("The driver has a license to drive.", []),
])
def test_detections(spark, text, want):
    row = scanned(spark, [text])[0]
    assert [(d.label, d.level) for d in row.license.detections] == want
    assert all(0 <= d.start < d.end <= len(text) for d in row.license.detections)
    assert 0 <= row.license.score <= 1


def test_rules_are_many_and_have_their_keyword():
    rules = licenses.rules()
    assert len(rules) > 250 and len({r["rule"] for r in rules}) == len(rules)


def test_query_equals_brute_force(spark, small):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    rows = op10_license_scan(spark, small).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute.license_base(texts[r.doc_id])
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert licenses.scan_licenses(docs).count() == 0
    assert licenses.scan_licenses(docs).select(F.size("license.base")).count() == 0


def written(pattern, turn):
    """A text that a rule's pattern matches: each turn takes other branches and repeats; separators are line breaks."""
    out = []
    for kind, value in pattern:
        kind = str(kind)
        if kind == "LITERAL":
            out.append(chr(value))
        elif kind == "ANY":
            out.append(".")
        elif kind == "IN":
            kind, value = str(value[0][0]), value[0][1]
            out.append(chr(value) if kind == "LITERAL" else "\n" if value[0] == 0 else chr(value[0]))
        elif kind in ("MAX_REPEAT", "POSSESSIVE_REPEAT"):
            low, high, inner = value
            out += [written(inner, turn)] * max(low, min(high, turn % 2 if low == 0 else 8 if str(inner[0][0]) == "IN" and kind != "MAX_REPEAT" else low))
        elif kind == "SUBPATTERN":
            out.append(written(value[3], turn))
        elif kind == "BRANCH":
            out.append(written(value[1][turn // 2 % len(value[1])], turn))
    return "".join(out)


def test_gate_and_keywords_skip_no_rule(spark):
    texts, places = [], []
    for rule in licenses.rules():
        for turn in range(14):
            text = f". {written(re._parser.parse(rule['pattern']), turn)} ."
            match = re.search(rule["pattern"], text)
            if match and text not in texts:
                texts.append(text)
                places.append((match.start(), match.end(), rule))
    assert {r["rule"] for *_, r in places} == {r["rule"] for r in licenses.rules()}
    for row, text, (start, end, rule) in zip(scanned(spark, texts), texts, places, strict=True):
        assert any(d.start <= start and d.end >= end and d.level <= rule["level"] for d in row.license.detections), (text, rule)


@pytest.mark.parametrize(("text", "label"), [
    ("Released under GPLv2.", "gpl-2.0"), ("distributed under BSD", "bsd"), ("available under CC0 1.0", "cc0-1.0"), ("published\nunder cc by 4.0", "cc-by-4.0"),
    ("All rights\nreserved", "all-rights-reserved"), ("Permission is hereby\n          granted, free of charge", "permissive-grant"),
    ('provided "as is", without\n * \n * warranty', "as-is-disclaimer"), ("(c) 2020 Somebody", "copyright-notice"), ("© 2020 Somebody", "copyright-notice")])
def test_wrapped_and_unlicensed_words(spark, text, label):
    assert [d.label for d in scanned(spark, [text])[0].license.detections] == [label]


def wrapped(words):
    """A sentence as it stands in a source file: capitals, commas, and a comment mark where its lines end."""
    parts = words.split(" ")
    lines = [" ".join(parts[i:i + 7]) for i in range(0, len(parts), 7)]
    return "/*\n * " + ",\n * ".join(line.upper() if n % 2 else line for n, line in enumerate(lines)) + ".\n */"


def test_every_signature_is_found_under_its_label_and_once(spark):
    assert len(licenses.SIGNATURES) >= 100 and len({w for _, w in licenses.SIGNATURES}) == len(licenses.SIGNATURES)
    assert {label for label, _ in licenses.SIGNATURES} <= {label for label, *_ in licenses.NAMES}
    assert all(any(sign in words for sign in licenses.SIGNS) for _, words in licenses.SIGNATURES)
    texts = [wrapped(words) for _, words in licenses.SIGNATURES]
    for row, text, (label, words) in zip(scanned(spark, texts), texts, licenses.SIGNATURES, strict=True):
        longest = max(row.license.detections, key=lambda d: d.end - d.start)
        assert longest.label == label and longest.level == 2, (words, row.license.detections)
        assert (longest.start, longest.end) == (text.lower().index(words.split(" ")[0], 3), len(text) - len(".\n */")), words


BODIES = {
    "mit": """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.""",
    "isc": """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH
REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY
AND FITNESS.""",
    "0bsd": """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted.

THE SOFTWARE IS PROVIDED "AS IS" AND THE COPYRIGHT HOLDER WILL NOT PAY.""",
    "zlib": """// The origin of this software must not be misrepresented; you must not
//    claim that you wrote the original software.
// This notice may not be removed or altered from any source distribution.""",
    "bsd": """# Redistribution and use in source and binary forms, with or without
# modification, are permitted provided that the following conditions are met:""",
}


def test_bodies_without_their_name(spark):
    rows = scanned(spark, list(BODIES.values()))
    for row, label in zip(rows, BODIES, strict=True):
        assert {d.label for d in row.license.detections} == {label}
    assert rows[0].license.score > 0.99


def test_sentences_that_are_cut_short_are_not_found(spark):
    texts = [" ".join(words.split(" ")[:-1]) for _, words in licenses.SIGNATURES]
    for row, text, (label, words) in zip(scanned(spark, texts), texts, licenses.SIGNATURES, strict=True):
        shorter = {other for other, w in licenses.SIGNATURES if w in text}
        full = next(r["rule"] for r in licenses.rules() if r["pattern"] == licenses._regex(words))
        assert full not in {d.rule for d in row.license.detections}, (label, shorter)
