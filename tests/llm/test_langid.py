import itertools
import zlib

import numpy as np
from skyflow.llm import langid
from skyflow.llm.common import table
from skyflow.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def segmentations(word):
    for cuts in itertools.product([0, 1], repeat=len(word) - 1):
        parts, at = [], 0
        for i, c in enumerate(cuts, 1):
            if c:
                parts.append(word[at:i])
                at = i
        yield [*parts, word[at:]]


def test_forward_sums_all_segmentations():
    rng = np.random.default_rng(2)
    vocabulary = ["▁", "▁a", "a", "b", "ab", "ba", "aba", "bb"]
    probability = np.concatenate([rng.random((len(vocabulary), 2)), np.zeros((1, 2))])
    pieces = langid.Pieces(vocabulary)
    words = ["a", "ab", "abab", "bbab", "xab"]
    for which, lattice in pieces.lattices(words):
        alpha, beta = langid.forward(lattice, probability), langid.backward(lattice, probability)
        assert np.allclose(alpha[:, -1], beta[:, 0])
        for row, i in enumerate(which.tolist()):
            total = np.zeros(2)
            for parts in segmentations("▁" + words[i]):
                p = np.ones(2)
                for part in parts:
                    if part in vocabulary:
                        p = p * probability[vocabulary.index(part)]
                    else:
                        p = p * (langid.UNKNOWN if len(part) == 1 else 0)
                total += p
            assert np.allclose(alpha[row, -1], total)


def test_small(spark, monkeypatch):
    monkeypatch.setattr(langid, "CACHE_WORDS", 40)
    vocabulary = list("abcdefghijklmnopqrstuvwxyz") + ["▁", "the", "der", "und", "and"]
    rows = [(i, "the cat and the dog", "en", "x") for i in range(30)] + [(100 + i, "der hund und der", "de", "x") for i in range(30)]
    rows += [(500, None, "en", "x"), (501, "", None, "x"), (502, "123 ²!", "en", "x"), (503, "the the the " * 40000, None, "x")]
    rows += [(504, "der " + "und" * 20000, "de", "x"), (504, "der", "de", "x"), (None, "the", "en", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score string")
    model = langid.fit(docs, vocabulary)
    assert model.languages == ["de", "en"]
    found = langid.predict(docs, model).collect()
    assert len(found) == len(rows)
    by_id = {r.doc_id: (r.lang_pred, r.score) for r in found}
    assert by_id[0][0] == "en" and by_id[100][0] == "de" and by_id[503][0] == "en" and by_id[504][0] == "de"
    assert by_id[500] == by_id[501] == by_id[502] == ("und", 0.0) and by_id[None][0] == "en"
    assert all(0 <= s <= 1 for _, s in by_id.values())
    empty = docs.limit(0)
    assert langid.predict(empty, model).count() == 0
    assert {r.lang_pred for r in langid.predict(docs, langid.fit(empty, vocabulary)).collect()} == {"und"}


def test_held_out(spark):
    lang = {r.doc_id: r.lang for r in table(spark, SF, "documents").collect()}
    found = {r.doc_id: r for r in QUERIES["op7_language"](spark, SF).collect()}
    assert found.keys() == lang.keys()
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= r.score <= 1 for i, r in found.items())
    right = [r.lang_pred == lang[i] for i, r in found.items() if r.held_out]
    assert np.mean(right) >= 0.9


def test_long_pieces_are_used():
    import public_tokenizers
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = {model.id_to_piece(i).lower() for i in range(model.get_piece_size())}
    vocabulary = langid.read_vocabulary(path)
    assert {p for p in pieces if p.removeprefix(langid.START).isalpha()} <= {*vocabulary}
    number = max(range(len(vocabulary)), key=lambda i: len(vocabulary[i]))
    longest = vocabulary[number]
    (_, lattice), = langid.Pieces(vocabulary).lattices([longest.removeprefix(langid.START)])
    assert lattice[0, int(not longest.startswith(langid.START)), len(longest) - 1] == number


def test_reads_do_not_grow_with_the_languages(spark):
    """Thirty languages: the documents are read four times, as they are for two."""
    vocabulary = list("abcdefghijklmnopqrstuvwxyz")
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    letters = "abcdefghijklmnopqrstuvwxyzäöüß"
    rows = [(i, f"{letters[i % 30] * 3} {letters[i % 30]} w", f"l{i % 30:02}") for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit(docs.mapInArrow(counted, docs.schema), vocabulary)
    assert len(model.languages) == 30 and read.value <= 3 * 600
    found = langid.predict(docs.mapInArrow(counted, docs.schema), model).collect()
    assert read.value <= 4 * 600
    known = {"abcdefghijklmnopqrstuvwxyz".index(t[0]) for _, t, _ in rows if t[0] in vocabulary}
    right = sum(r.lang_pred == f"l{r.doc_id % 30:02}" for r in found if r.doc_id % 30 in known)
    assert right > 0.9 * 26 * 20
