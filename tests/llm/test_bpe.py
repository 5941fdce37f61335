import hashlib
import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from skyflow.llm import bpe
from skyflow.llm.common import table
from skyflow.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("byte_bpe_50k.json")
TOKENIZER = Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def automaton():
    return bpe.MergeAutomaton(*bpe.read_tokenizer(PATH))


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def wanted(text):
    ids = TOKENIZER.encode(text or "", add_special_tokens=False).ids
    return len(ids), digest(",".join(map(str, ids))), digest(TOKENIZER.decode(ids, skip_special_tokens=False))


def test_random_texts(automaton):
    rng = random.Random(3)
    letters = "aabehlo 's't\n\t \x1c\x85　éñ中文🙂́²Ⅷ٣_-=0123  AAA=="
    for _ in range(4000):
        text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 40)))
        text += rng.choice(["", "<|endoftext|>", "<|endoftext|>x", " " * rng.randint(0, 40) + "a", chr(rng.randrange(0x250, 0xD000)) * 5])
        ids = TOKENIZER.encode(text, add_special_tokens=False).ids
        assert automaton.encode(text).tolist() == ids
        assert automaton.decode(ids) == TOKENIZER.decode(ids, skip_special_tokens=False) == text


def test_latin_split_is_the_same():
    rng = random.Random(6)
    plain = [chr(c) for c in range(0x250) if not bpe.NOT_LATIN.search(chr(c))]
    full = bpe.regex.compile(bpe.SPLIT_PATTERN)
    texts = [c + a + b for a in plain for b in " a1_'\n" for c in ("", b)]
    texts += ["".join(rng.choices([*plain, *("  'aabstdlvrem11__\n\n" * 20)], k=rng.randint(1, 30))) for _ in range(20000)]
    assert all(bpe.LATIN_PATTERN.findall(t) == full.findall(t) for t in texts)


def test_broken_tokens_decode_alike(automaton):
    rng = random.Random(4)
    for _ in range(500):
        ids = [rng.randrange(50257) for _ in range(8)]
        assert automaton.decode(ids) == TOKENIZER.decode(ids, skip_special_tokens=False)


def test_automaton_accepts_only_what_merges_make(automaton):
    """Every pair of tokens is an arc exactly if the two are how their text is encoded."""
    rng = random.Random(5)
    tokens = [t for t in automaton.tokens.values() if automaton.labels[t].isalpha()]
    for _ in range(3000):
        u, v = rng.choice(tokens), rng.choice(tokens)
        ids = TOKENIZER.encode((automaton.labels[u] + automaton.labels[v]).decode(), add_special_tokens=False).ids
        assert automaton.has_arc(u, v) == (ids == [u, v])


def test_small(spark, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_WORDS", 5)
    texts = [None, "", " ", "a", "x" * 70000, "hello world " * 9000, "\x00\n\n"]
    docs = spark.createDataFrame([*enumerate(texts), (3, "a")], "doc_id long, ids string").withColumnRenamed("ids", "text").selectExpr("*", "1 AS ids")
    found = bpe.digests(docs, PATH).collect()
    assert sorted(map(tuple, found)) == sorted((i, *wanted(t)) for i, t in [*enumerate(texts), (3, "a")])
    assert bpe.digests(docs.limit(0), PATH).count() == 0


def test_decode_a_table(spark):
    docs = spark.createDataFrame([(1, "one two"), (2, ""), (3, None)], "doc_id long, text string")
    both = bpe.decode(bpe.encode(docs, PATH), PATH)
    assert sorted((r.doc_id, r.decoded) for r in both.collect()) == [(1, "one two"), (2, ""), (3, "")]
    none = spark.createDataFrame([(1, None), (2, [31373, 995])], "doc_id long, ids array<int>")
    assert [r.decoded for r in bpe.decode(none, PATH).orderBy("doc_id").collect()] == ["", "hello world"]


def test_query(spark):
    texts = {r.doc_id: r.text for r in table(spark, SF, "documents").collect()}
    found = QUERIES["op4_bpe"](spark, SF).collect()
    assert {r.doc_id: tuple(r)[1:] for r in found} == {i: wanted(t) for i, t in texts.items()}
