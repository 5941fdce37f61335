import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from skyflow.llm import toxicity
from skyflow.llm.common import table
from skyflow.llm.queries import QUERIES

SF = "/root/testdata/sf0.1"


def test_held_out(spark):
    found = {r.doc_id: r for r in QUERIES["op9_toxicity"](spark, SF).collect()}
    assert len(found) == table(spark, SF, "documents").count()
    for i, row in found.items():
        assert row.held_out == (zlib.crc32(str(i).encode()) % 4 == 2)
        assert 0 <= row.score <= 1 and row.predicted == int(row.score >= 0.3)
    held = [(r.toxic, found[r.doc_id].predicted) for r in table(spark, SF, "labels").collect() if found[r.doc_id].held_out]
    caught = [p for t, p in held if t == 1]
    false = [p for t, p in held if t == 0]
    assert np.mean(caught) >= 0.85 and np.mean(false) <= 0.02


def test_small(spark):
    toxic = [(i, f"you awful{i % 3} person number {i}", "x") for i in range(40)]
    clean = [(100 + i, f"a nice person number {i}", "x") for i in range(300)]
    docs = spark.createDataFrame([*toxic, *clean, (500, None, "x"), (501, "", "x"), (501, "", "x"), (None, "awful1", "x"), (502, "fine " * 60000, "x")], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(i, 1) for i in range(40)] + [(100 + i, 0) for i in range(300)] + [(500, None)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    scores = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    assert min(scores[i] for i in range(40)) > 0.3 > max(scores[100 + i] for i in range(300))
    assert scores[500] == scores[501] < 0.3
    kept = toxicity.without_toxic(docs, model)
    assert kept.columns == docs.columns and kept.filter("doc_id < 100").count() == 0 and kept.count() >= 303
    assert toxicity.fit(docs, labels.limit(0)) is None
    assert toxicity.report(docs, labels.filter("toxic = 0")).agg(F.max("score")).first()[0] == 0
    assert toxicity.report(docs.limit(0), labels).count() == 0


@pytest.mark.parametrize("prior", [0.1, 0.4])
def test_positives_among_unlabelled(prior):
    """All positives carry feature 1; of the unlabelled, the share of positives does."""
    positive = [np.array([1, 7, 100 + i]) for i in range(50)]
    unlabelled = [np.array([1, 7, 200 + i]) for i in range(int(100 * prior))]
    unlabelled += [np.array([2, 7, 400 + i]) for i in range(int(100 * (1 - prior)))]
    model = toxicity.train(positive, unlabelled, prior)
    weight = dict(zip(model.features.tolist(), model.weights.tolist(), strict=True))
    assert [*weight] == [1] and weight[1] > 0 and weight[1] + model.bias > 0 > model.bias


def test_nothing_tells_them_apart():
    model = toxicity.train([np.array([1])], [np.array([1])], 0.2)
    assert len(model.features) == 0 and 0 <= model.score(b"word") < 0.3


def test_few_examples_leave_other_text_alone():
    positive = [np.array([1, 2, 3, 100 + i]) for i in range(9)]
    unlabelled = [np.array([1, 2, 3, 200 + i]) for i in range(9)] + [np.array([300 + i]) for i in range(141)]
    assert toxicity.train(positive, unlabelled, 0.14).score(b"") < 0.3


def fixture(spark, copies=1):
    """Toxic and other texts; some ids have several rows, and several texts."""
    toxic = [(i, f"you awful{i % 3} awful{i % 3} person{i % 7} number {i}") for i in range(60)]
    clean = [(100 + i, f"a nice person{i % 7} number {i % 90}") for i in range(300)]
    many = [(0, f"awful0 text {i % 40}") for i in range(40 * copies)] + clean[:50] * copies
    docs = spark.createDataFrame([*toxic, *clean, *many, (None, "awful1"), (500, None)], "doc_id long, text string")
    return docs, spark.createDataFrame([(i, 1) for i in range(60)] + [(100 + i, 0) for i in range(300)], "doc_id long, toxic int")


def test_training_equals_brute_force(spark, monkeypatch):
    """Sample, features and weights as found from all rows at once."""
    monkeypatch.setattr(toxicity, "LEAST_Z", 2.0)
    docs, labels = fixture(spark)
    learned = lambda i: i is not None and zlib.crc32(str(i).encode()) % 4 != 2
    rows = {(r.doc_id, r.text or "") for r in docs.collect() if learned(r.doc_id)}
    of = lambda keep: [np.array(toxicity.features_of(t.encode()), "<i4") for i, t in sorted(rows) if keep(i)]
    known = [i for i in [*range(60), *range(100, 400)] if learned(i)]
    wanted = toxicity.train(of(lambda i: i < 60), of(lambda i: True), sum(i < 60 for i in known) / len(known))
    model = toxicity.fit(docs, labels)
    assert len(model.features) > 5 and model.features.tolist() == wanted.features.tolist()
    assert np.allclose(model.weights, wanted.weights, atol=1e-9) and abs(model.bias - wanted.bias) < 1e-9


def test_repeated_ids_do_not_grow_the_sample(spark, monkeypatch):
    """At most POSITIVES and UNLABELLED texts, though one id has a third of the rows and forty texts."""
    docs, labels = fixture(spark)
    more, _ = fixture(spark, copies=20)
    once, again = toxicity.fit(docs, labels), toxicity.fit(more, labels)
    assert once.features.tolist() == again.features.tolist() and once.weights.tolist() == again.weights.tolist()
    monkeypatch.setattr(toxicity, "POSITIVES", 10)
    monkeypatch.setattr(toxicity, "UNLABELLED", 30)
    ids = more.select("doc_id").filter("doc_id is not null")
    positive = toxicity._sample(more, ids.filter("doc_id < 60"), toxicity.POSITIVES)
    unlabelled = toxicity._sample(more, ids, toxicity.UNLABELLED)
    assert positive.count() == 10 and unlabelled.count() == 30
    sets = toxicity.feature_sets(more, positive, unlabelled).agg(F.sum("p"), F.sum("u")).first()
    assert 0 < sets[0] <= 10 and 0 < sets[1] <= 30
