from __future__ import annotations

import random
from re import _parser

import pytest

from salestide.llm import license_scan, queries
from tests.llm import plain


def _scan(docs):
    return {r.id: r for r in license_scan.scan(docs).collect()}


def test_the_small_table(spark, small):
    made = {r.doc_id: r for r in queries.licenses(spark, plain.FOLDER).collect()}
    assert len(made) == len(small[1])
    for row in small[1]:
        r = made[row.doc_id]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == plain.licenses(row.text)
        assert 0 <= r.score <= 1 and set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))


TEXTS = {
    1: "Licensed under CC BY-NC 4.0.",
    2: "cc by cc by\ncc  BY mit License",
    3: "This is free software under the GNU General Public License, version 3 or later",
    4: "SPDX-License-Identifier: Apache-2.0",
    5: "the GNU Lesser General Public License v2.1 applies",
    6: "permit licensees acc by bycc", 7: None, 8: "", 9: "...!", 10: "gnu general public", 11: "MIT LICENSE",
    12: "MITé license mit licénse", 13: "apache license " * 4000, 14: "under the terms of the Apache License, Version 2.0",
}


@pytest.fixture(scope="module")
def edges(make_docs):
    return _scan(make_docs([*[(i, t, None) for i, t in TEXTS.items()], (11, TEXTS[11], "s")], clashing=True))


def test_base_phrases_on_edges(edges):
    for i, text in TEXTS.items():
        r = edges[i]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == plain.licenses(text), i


def test_more_specific_rules_suppress_what_they_contain(edges):
    assert edges[1].labels == "cc-by,cc-by-nc-4.0" and edges[1].score == 0.95
    assert edges[3].labels == "gpl,gpl-3.0"
    assert edges[4].labels == "apache-2.0" and edges[4].score == 1.0
    assert edges[5].labels == "lgpl-2.1"
    assert edges[14].labels == "apache,apache-2.0"
    assert edges[6].labels == "" and edges[6].score == 0.0 and edges[7].labels == ""


def test_there_are_hundreds_of_rules_in_order():
    rules = license_scan.rules()
    assert len(rules) > 200 and [r[0] for r in rules] == sorted(r[0] for r in rules)


def _said(pattern):
    """A text that the expression of a rule matches: first choices, without optional parts."""

    def one(parsed):
        made = ""
        for kind, value in parsed:
            name = str(kind)
            if name == "LITERAL":
                made += chr(value)
            elif name == "IN":
                first = value[0][1]
                made += chr(first[0] if isinstance(first, tuple) else first)
            elif name == "MAX_REPEAT":
                made += one(value[2]) * value[0]
            elif name == "SUBPATTERN":
                made += one(value[3])
            elif name == "BRANCH":
                made += one(value[1][0])
            else:
                assert name == "ASSERT", name
        return made

    return one(_parser.parse(pattern)).strip()


def test_no_keyword_silences_a_rule(make_docs):
    """Each rule finds a text that its expression matches, though it may be suppressed."""
    rules = license_scan.rules()
    made = _scan(make_docs([(i, _said(rule[4]), None) for i, rule in enumerate(rules)]))
    for i, (_, weight, label, _, pattern) in enumerate(rules):
        assert label in made[i].labels.split(",") and made[i].score >= weight, (pattern, made[i])


NOTICES = {
    "GPLv3": "gpl-3.0", "under GPLv2 or later": "gpl-2.0", "LGPLv2.1+": "lgpl-2.1", "Apache2 license": "apache-2.0",
    "MIT/Apache-2.0": "apache-2.0,mit", "Apache-2.0 OR MIT": "apache-2.0,mit",
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
    " documentation files (the \"Software\"), to deal in the Software without restriction, including": "mit",
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that"
    " the following conditions are met:": "bsd",
    "Neither the name of X nor the names of its contributors may be used to endorse or promote products derived from"
    " this software without specific prior written permission.": "bsd-3-clause",
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public"
    " License as published by the Free Software Foundation, either version 3 of the License, or": "gpl,gpl-3.0",
    "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.": "cc-by-nc-4.0",
    "This is free and unencumbered software released into the public domain.": "unlicense",
    "a permission is hereby given to use the public library": "",
}


def test_notices_and_bodies(make_docs):
    made = _scan(make_docs([(i, text, None) for i, text in enumerate(NOTICES)]))
    assert [made[i].labels for i in range(len(NOTICES))] == list(NOTICES.values())


def test_labels_against_all_rules_and_all_pairs(make_docs):
    """Parts of signatures side by side, whole, cut and one inside another."""
    rules, draw = license_scan.rules(), random.Random(5)
    said = [_said(rule[4]) for rule in rules]
    texts = [*said, *filter(None, TEXTS.values()), *NOTICES]
    for _ in range(100):
        parts = []
        for one in draw.sample(said, draw.randint(1, 5)):
            words = one.split()
            cut = draw.choice([0, 0, 0, 1, 2])
            parts.append(" ".join(words[cut:] if draw.random() < 0.5 else words[: len(words) - cut]))
            parts.append(draw.choice(["", "the", "2 0", "version 3", "license", "or"]))
        texts.append(" ".join(parts))
    made = _scan(make_docs([(i, text, None) for i, text in enumerate(texts)]))
    for i, text in enumerate(texts):
        assert (made[i].labels, made[i].score) == plain.all_licenses(text, rules), text


def test_spdx_lines(make_docs):
    tags = {
        "MIT": "mit", "ISC": "isc", "MIT-0": "mit-0", "Artistic-2.0": "artistic-2.0", "BSL-1.0": "bsl-1.0",
        "LicenseRef-Proprietary": "proprietary", "BUSL-1.1": "busl-1.1", "CPL-1.0": "cpl-1.0", "PSF-2.0": "psf-2.0",
    }
    rows = [(i, f"# SPDX-License-Identifier: {tag}\nimport os", None) for i, tag in enumerate(tags)]
    made = _scan(make_docs(rows))
    assert [(made[i].labels, made[i].score) for i in range(len(tags))] == [(x, 1.0) for x in tags.values()]


def test_no_documents_and_no_python(make_docs):
    made = license_scan.scan(make_docs([]))
    assert made.collect() == []
    assert "Python" not in made._jdf.queryExecution().toString()
