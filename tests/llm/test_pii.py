import hashlib
import re

import pytest
from pyspark.sql import functions as F

from skyflow.llm import pii
from skyflow.llm.common import table
from skyflow.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def valid(kind, match):
    digits = [int(c) for c in match if c in "0123456789"]
    if kind == "ip":
        return all(int(p) <= 255 for p in match.split("."))
    if kind == "card":
        doubled = [d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(reversed(digits))]
        return 13 <= len(digits) <= 19 and sum(doubled) % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def brute(text):
    return [(k, m.start(), m.end()) for k, p in PATTERNS.items() for m in re.finditer(p, text or "") if valid(k, m[0])]


def wanted(text):
    spans = brute(text)
    digest = hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in spans).encode()).hexdigest()
    return (*(sum(s[0] == k for s in spans) for k in PATTERNS), digest)


TEXTS = [
    None,
    "",
    "é🙂 a@b.c, x@y",
    "a@b.com_x@c.org.de a.b@c..d a@b-.c",
    "1.2.3.4.5.6.7.8 256.1.1.1 1.2.3 001.02.3.255 00000000000000255.1.1.1 1.2.3.99999999999999999999",
    "4111 1111 1111 1111, 4111-1111-1111-1111 4111111111111112 411111111111111111111111 4111  1111 1111 1111",
    "+49 (0) 30 123456 +1-202-555-0143. +12 +1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6 ++1234567890",
    "7" * 30000,
    "a" * 30000 + "@",
    "1 " * 20000,
    "a@b" + ".c" * 20000,
    "1." * 20000,
    "+1" + " " * 30000 + "x",
    "call 030 1234567 or me [at] host [dot] org",
    "x@y.z" * 300,
]


def test_many_spans_in_one_text(spark):
    """More matches than are summed together, and places far into a long text."""
    parts = [f"é🙂 mail u{i}@ex{i}.com, call +1 202 555 {1000 + i} or key=abcdefghijklmnopq{i} at 10.0.{i % 300}.1;" for i in range(3000)]
    text = " ".join(parts)
    always = pii.Model(((1.0, pii.Tree(1.0)),), {kind: 0.5 for kind in pii.GENERATORS})
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    row = pii.find(docs, always).first()
    base = brute(text)
    assert [tuple(x) for x in row.base] == base and len(base) > 20 * pii.STRETCH
    more = [tuple(x) for x in row.spans][len(base) :]
    assert more == sorted(more, key=lambda x: (list(pii.GENERATORS).index(x[0]), x[1]))
    proposed = [(k, m.start(), m.end()) for k, p in pii.GENERATORS.items() if k == "secret" for m in re.finditer(r"(?<![A-Za-z0-9_])[A-Za-z0-9_]{16,}", text)]
    assert [x for x in more if x[0] == "secret"] == [x for x in proposed if not any(b[1] <= x[1] and x[2] <= b[2] for b in base)]
    wanted, at = [], 0
    for start, end, kind in sorted((a, b, k) for k, a, b in map(tuple, row.spans)):
        if start >= at:
            wanted += [text[at:start], f"[{kind.upper()}]"]
        at = max(at, end)
    assert pii.redact(docs, always).first().text == "".join(wanted) + text[at:]


def test_contexts_are_cut_from_parts(spark):
    text = "é🙂x" * 1000
    pairs = [(0, 0), (0, 5), (1020, 24), (1023, 1), (1024, 24), (2047, 953), (2990, 24), (3000, 24), (0, 3000)]
    rows = spark.createDataFrame([(text, a, n) for a, n in pairs], "text string, a long, n long")
    found = rows.select(pii._cut(pii._parts(F.col("text")), F.col("a"), F.col("n"))).collect()
    assert [r[0] for r in found] == [text[a : a + n] for a, n in pairs]


def test_base_spans(spark):
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(TEXTS)] + [(3, TEXTS[3], "x"), (None, "a@b.c", "x")], "doc_id long, text string, c string")
    for row in pii.find(docs, None).collect():
        text = "a@b.c" if row.doc_id is None else TEXTS[row.doc_id]
        assert [tuple(s) for s in row.base] == brute(text) == [tuple(s) for s in row.spans], (text or "")[:60]
    assert len(pii.report(docs).collect()) == len(TEXTS) + 2
    assert pii.report(docs.limit(0)).count() == 0


def test_redact(spark):
    docs = spark.createDataFrame([(1, "mail a@b.c now +49 30 1234567!", 1), (2, None, 1), (3, "none", 1), (4, "é 1.2.3.4", 1)], "doc_id long, text string, base int")
    found = pii.redact(docs.withColumnRenamed("base", "other"), None)
    assert found.columns == ["doc_id", "text", "other"]
    assert {r.doc_id: r.text for r in found.collect()} == {1: "mail [EMAIL] now [PHONE]!", 2: None, 3: "none", 4: "é [IP]"}
    with pytest.raises(ValueError):
        pii.find(docs, None)


def test_trees_read_back():
    text = """GBT: uid=x
  Tree 0 (weight 1.0):
    If (feature 1 <= 2.5)
     Predict: -1.0
    Else (feature 1 > 2.5)
     If (feature 0 <= -0.5)
      Predict: 0.25
     Else (feature 0 > -0.5)
      Predict: 1.0E-2
  Tree 1 (weight 0.1):
    Predict: 0.5
"""
    (w0, tree), (w1, leaf) = pii.read_trees(text)
    assert (w0, w1, leaf.value, tree.feature, tree.limit) == (1.0, 0.1, 0.5, 1, 2.5)
    assert tree.low.value == -1 and tree.high.low.value == 0.25 and tree.high.high.value == 0.01


def test_model_adds_what_looks_alike(spark):
    """Phones that lack the plus look like those that have it; long counts don't."""
    rows = []
    for i in range(300):
        rows.append((i, f"you can call +49 30 {1000 + i} {5000 + i} today"))
        rows.append((1000 + i, f"item {10**9 + i * 7919} of the list"))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = pii.fit(docs)
    more = spark.createDataFrame([(1, "you can call 4930 1234 5678 today"), (2, "item 1000999999 of the list")], "doc_id long, text string")
    found = {r.doc_id: [s.kind for s in r.spans] for r in pii.find(more, model).collect()}
    assert found == {1: ["number"], 2: []}
    assert pii.redact(more, model).filter("doc_id = 1").first().text == "you can call [NUMBER] today"


def test_every_document_is_learned_from(spark):
    """The learner is given every candidate of the documents that are not left out, also beyond the 4,000 once sampled."""
    named, other = "api_key = AKIA{0:012d}", "the number AKIA{0:012d} here"
    texts = [(n, (named if n % 40 else other).format(n) + f" mail a{n}@b.com") for n in range(8000)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(4)
    taken = {}
    real = pii.GBTClassifier.fit

    def fit(self, rows, *args):
        taken["n"] = rows.agg(F.sum("n")).first()[0]
        return real(self, rows, *args)

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(pii.GBTClassifier, "fit", fit)
        model = pii.fit(docs)
    left_out = docs.filter(F.pmod(F.xxhash64("doc_id"), F.lit(3)) == 0).count()
    per_document = pii._with_base(docs, F.col("text"), ["b", "p"]).agg(F.min(F.size("p")), F.max(F.size("p"))).first()
    assert per_document[0] == per_document[1] and taken["n"] == per_document[0] * (8000 - left_out) > 2 * 4000
    assert model and set(model.thresholds) <= {*pii.GENERATORS}


def test_query(spark):
    texts = {r.doc_id: r.text for r in table(spark, SF, "documents").collect()}
    df = QUERIES["op1_pii"](spark, SF)
    assert not re.search("Python|Pandas|Arrow", df._jdf.queryExecution().toString())
    found = df.collect()
    assert {r.doc_id: tuple(r)[1:6] for r in found} == {i: wanted(t) for i, t in texts.items()}
    for row in found:
        base = [f"{k}:{a}:{b}" for k, a, b in brute(texts[row.doc_id])]
        assert {*base} <= {*row.spans.split(",")} if base else True
    print(sum(len([s for s in r.spans.split(",") if s and s.split(":")[0] in pii.GENERATORS]) for r in found), "added")
