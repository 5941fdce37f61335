import re

import pytest

from skyflow.llm import licenses
from skyflow.llm.common import table
from skyflow.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute(text):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    places = []
    for phrase, label in licenses.PHRASES:
        p = phrase.split()
        places += [(i, label) for i in range(len(words) - len(p) + 1) if words[i : i + len(p)] == p]
    starts = [i for i, _ in places]
    labels = ",".join(sorted({label for _, label in places}))
    return len(words), len(places), min(starts, default=None), max(starts, default=None), labels


TEXTS = [
    None,
    "",
    "cc by",
    "CC-BY cc by cc cc by",
    "the apache, license apache license version 2 apache apache license",
    "gnu general public license gnu general gnu general public license general public",
    "mit license " * 5000,
    "Released under the MIT License.",
    "this work is licensed under the gnu general public license, version 3. mit license",
    "permission is hereby granted free of charge to any person obtaining a copy of this software",
    "ﬁ über mit licenseé mit license",
]


def test_small(spark):
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(TEXTS)] + [(3, TEXTS[3], "x")], "doc_id long, text string, labels string")
    found = licenses.report(docs).collect()
    assert len(found) == len(TEXTS) + 1
    for row in found:
        assert tuple(row)[1:6] == brute(TEXTS[row.doc_id])
        assert 0 <= row.score <= 1 and {*filter(None, row.base_labels.split(","))} <= {*row.labels.split(",")}
    assert licenses.report(docs.limit(0)).count() == 0


@pytest.mark.parametrize("text, label", licenses.TEMPLATES)
def test_templates(text, label):
    index = licenses.LicenseIndex(licenses.PHRASES, licenses.TEMPLATES)
    _, _, chains = index.scan(f"some words before {text} and after".encode())
    assert (label, 1.0) in [(c[0], c[3]) for c in chains]
    words = text.split()
    if len(words) >= 25:
        changed = " ".join([*words[:11], "other", *words[12:]])
        _, _, chains = index.scan(changed.encode())
        assert label in [c[0] for c in chains if 0.8 <= c[3] < 1]
    assert index.scan(b"the of and to " * 50)[2] == []


def test_matching_statistics():
    texts = [[1, 2, 3, 1, 2, 4], [2, 3, 5, 1], [1, 1, 1]]
    automaton = licenses.SuffixAutomaton(texts)
    runs = {tuple(t[i:j]) for t in texts for i in range(len(t)) for j in range(i + 1, len(t) + 1)}
    words = [1, 2, 3, 5, 1, 1, 1, 1, 2, 4, 9, 2, 3, 1, 2]
    for at, (state, length) in enumerate(automaton.stream(words)):
        wanted = max((n for n in range(at + 2) if tuple(words[at + 1 - n : at + 1]) in runs), default=0)
        assert length == wanted
        ends = {(n, j) for n, t in enumerate(texts) for j in range(1, len(t) + 1) if length and t[j - length : j] == words[at + 1 - length : at + 1] and j >= length}
        assert not length or {*automaton.ends[state]} == ends


def test_query(spark):
    texts = {r.doc_id: r.text for r in table(spark, SF, "documents").collect()}
    found = QUERIES["op2_licenses"](spark, SF).collect()
    assert len(found) == len(texts)
    for row in found:
        assert tuple(row)[1:6] == brute(texts[row.doc_id])
    assert any(row.n_base for row in found)
