import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from checks.compare import differences
from skyflow.llm import decontaminate
from skyflow.llm.common import table
from skyflow.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, window=10):
    windows = {}
    for item, text in items:
        w = words_of(text)
        n = min(window, len(w))
        for i in range(len(w) - n + 1) if w else ():
            windows.setdefault(tuple(w[i : i + n]), set()).add("" if item is None else str(item))
    lengths = {len(x) for x in windows}
    out = []
    for doc, text in docs:
        w = words_of(text)
        hit, found = set(), set()
        for n in lengths:
            for i in range(len(w) - n + 1):
                if own := windows.get(tuple(w[i : i + n])):
                    found |= own
                    hit.update(range(i, i + n))
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc, len(w), len(hit), len(found), digest, bool(hit)))
    return sorted(out, key=repr)


ITEMS = [
    (1, "One two three four five six seven eight nine ten eleven twelve"),
    (2, "two three four five six seven eight nine ten eleven"),
    (10, "Short item"),
    (3, "a a a a a a a a a a a a"),
    (None, "x"),
    (4, None),
    (5, ""),
    (1, "One two three four five six seven eight nine ten eleven twelve"),
]
DOCS = [
    (1, "zero ONE two, three four five six seven eight nine ten eleven twelve thirteen"),
    (2, "a " * 25),
    (3, None),
    (4, ""),
    (5, "... !!!"),
    (6, "short item short ITEM x"),
    (7, "one two three four five six seven eight nine"),
    (7, "one two three four five six seven eight nine"),
    (None, "größer short  item, größer"),
    (8, "lorem ipsum " * 30000 + "short item"),
]


@pytest.mark.parametrize("items", [ITEMS, ITEMS[:2], ITEMS[4:7], []])
def test_small(spark, rows, items):
    docs = spark.createDataFrame([(*d, "x") for d in DOCS], "doc_id long, text string, items string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert rows(decontaminate.report(docs, bench)) == brute(DOCS, items)
    assert decontaminate.report(docs.limit(0), bench).count() == 0


def test_query(spark, rows):
    docs = [tuple(r) for r in table(spark, SF, "documents").select("doc_id", "text").collect()]
    items = [tuple(r) for r in table(spark, SF, "benchmark").select("item_id", "text").collect()]
    found = rows(QUERIES["op8_decontaminate"](spark, SF))
    assert found == brute(docs, items)
    assert any(r[-1] for r in found)
    assert differences(QUERIES["op8_decontaminate"](spark, SF), ORACLE["op8_decontaminate"], SF) is None


def test_blocks_and_shards(spark, rows, monkeypatch):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string")
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 60)
    monkeypatch.setattr(decontaminate, "SHARD_WORDS", 20)
    assert rows(decontaminate.report(docs, bench)) == brute(DOCS, ITEMS)


@pytest.mark.parametrize("block_bytes", [10, 1 << 24])
def test_remove(spark, monkeypatch, block_bytes):
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block_bytes)
    docs = spark.createDataFrame([(*d, 5) for d in DOCS], "doc_id long, text string, words int")
    bench = spark.createDataFrame(ITEMS[:3], "item_id long, text string")
    kept = decontaminate.remove_passages(docs, bench)
    assert kept.columns == docs.columns and kept.count() == len(DOCS)
    texts = {r.doc_id: r.text for r in kept.collect()}
    assert texts[1] == "zero  thirteen" and texts[3] is None and texts[6] == "  x" or texts[6] == " x"
    left = brute([(r.doc_id, r.text) for r in kept.collect()], ITEMS[:3])
    assert not any(r[-1] for r in left)
    assert kept.filter(F.col("words") != 5).count() == 0


def test_index_counts_and_places():
    rng = np.random.default_rng(5)
    symbols = rng.integers(0, 4, 400)
    symbols[0] = 0
    index = decontaminate.FMIndex(symbols, 4)
    for length in (1, 2, 3, 5):
        patterns = rng.integers(1, 4, (20, length))
        low, high = index.search(patterns)
        for p, a, b in zip(patterns, low, high, strict=True):
            wanted = [i for i in range(len(symbols) - length + 1) if (symbols[i : i + length] == p).all()]
            assert sorted(index.locate(np.arange(a, b)).tolist()) == wanted


def test_occurrences_in_a_document_are_not_multiplied_by_items(monkeypatch):
    expand, sizes = decontaminate._expand, []

    def counted(*args):
        at, owner = expand(*args)
        sizes.append(len(at))
        return at, owner

    monkeypatch.setattr(decontaminate, "_expand", counted)
    template = " ".join(f"w{i}" for i in range(10))
    windows = decontaminate.Windows([(f"i{n:03}", f"{template} own{n}".encode()) for n in range(100)], 10)
    ids = np.array([windows.symbols[w] for w in template.encode().split()], np.int32)
    found = decontaminate.search_shard(windows, [np.tile(ids, 200), ids[:9], ids])
    names = [f"i{n:03}" for n in range(100)]
    assert found == [([(0, 2000)], names), ([], []), ([(0, 10)], names)]
    assert sum(sizes) == 200
    monkeypatch.setattr(decontaminate, "EXPANDED", 50)
    assert decontaminate.search_shard(windows, [np.tile(ids, 200), ids[:9], ids]) == found
