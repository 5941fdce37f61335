import hashlib

import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from skyflow.llm import pii, simhash, toxicity
from skyflow.llm.common import table
from tests.llm import test_decontaminate, test_pii, test_simhash

SF = "/root/testdata/sf0.01"
TOKENIZER = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_stages_against_brute_force(spark, tmp_path):
    """Each stage on what the one before kept; models are fitted once and then applied row by row."""
    docs = table(spark, SF, "documents")
    names, before = docs.columns, docs
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, before, SF).write.parquet(str(tmp_path / f"{number}"))
        after = spark.read.parquet(str(tmp_path / f"{number}"))
        old = {r.doc_id: r for r in before.collect()}
        new = {r.doc_id: r for r in after.collect()}
        assert len(new) == after.count()
        if name != "bpe":
            assert after.columns == names
        if name == "toxicity":
            model = toxicity.fit(before, table(spark, SF, "labels"))
            assert new == {i: r for i, r in old.items() if model.score(r.text.encode()) < 0.3}
            assert len(new) < len(old)
        elif name == "simhash_near_dedup":
            prints = [(i, test_simhash.brute_fingerprint(r.text)) for i, r in old.items()]
            assert new == {i: old[i] for i, _, c in test_simhash.brute(prints) if i == c}
            assert len(new) < len(old)
        elif name == "benchmark_decontamination":
            items = [tuple(r) for r in table(spark, SF, "benchmark").collect()]
            found = {r[0]: r for r in test_decontaminate.brute([(i, r.text) for i, r in old.items()], items)}
            left = {r[0]: r for r in test_decontaminate.brute([(i, r.text) for i, r in new.items()], items)}
            assert new.keys() == old.keys() and any(r[-1] for r in found.values()) and not any(r[-1] for r in left.values())
            for i, row in new.items():
                assert left[i][1] == found[i][1] - found[i][2]
                assert row == old[i] if not found[i][-1] else row.n_chars == len(row.text)
        elif name == "pii":
            model = pii.fit(before)
            spans = {r.doc_id: r.spans for r in pii.find(before, model).collect()}
            assert new.keys() == old.keys() and any(spans.values())
            for i, row in new.items():
                assert not test_pii.brute(row.text)
                assert row.text == old[i].text if not spans[i] else "[" in row.text and row.n_chars == len(row.text)
        else:
            encoded = {i: TOKENIZER.encode(r.text, add_special_tokens=False).ids for i, r in old.items()}
            assert {i: tuple(r)[1:] for i, r in new.items()} == {
                i: (len(e), sha(",".join(map(str, e))), sha(old[i].text)) for i, e in encoded.items()
            }
        before = after
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF).collect())) == sorted(map(tuple, before.collect()))


def test_stages_take_odd_tables(spark):
    rows = [(1, None, "x"), (2, "", "x"), (3, "some text of a document", "x"), (3, "some text of a document", "x"), (None, "no id", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    for table_ in (docs, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            found = stage(spark, table_, SF)
            assert name == "bpe" or found.columns == docs.columns
            assert found.count() <= table_.count()


def test_near_duplicate_stage_broadcasts_no_fingerprints(spark, monkeypatch):
    """The optimizer takes exploded fingerprints for few; links alone may be small enough to send around."""
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    kept, plans = simhash.staged, {}

    def watched(df, name):
        plans[name] = plan(df)
        return kept(df, name)

    monkeypatch.setattr(simhash, "staged", watched)
    docs = spark.createDataFrame([(i, f"text number {i // 2}") for i in range(60)], "doc_id long, text string")
    found = corpus_pipeline.without_near_duplicates(spark, docs, SF)
    assert sorted(row.doc_id for row in found.collect()) == [*range(0, 60, 2)]
    assert "Broadcast" not in plans["simhash-cells"]
    joins = [line for line in plan(found).splitlines() if "Join" in line]
    assert "ShuffledHashJoin" in joins[0] and all("SortMergeJoin" in line for line in joins[1:3])
