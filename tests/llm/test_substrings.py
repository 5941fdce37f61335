import hashlib
import random
import re

import numpy as np

from checks.compare import differences
from skyflow.llm import substrings
from skyflow.llm.common import table
from skyflow.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


def brute(rows):
    docs = [(i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in rows]
    first = {}
    for i, w in docs:
        for j in range(len(w) - 12) if i is not None else ():
            key = tuple(w[j : j + 13])
            first[key] = min(i, first.get(key, i))
    out = []
    for i, w in docs:
        gone = set()
        for j in range(len(w) - 12) if i is not None else ():
            if first[tuple(w[j : j + 13])] < i:
                gone.update(range(j, j + 13))
        kept = " ".join(x for j, x in enumerate(w) if j not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def made(rng):
    """Documents with shared passages, copies, runs of one word, and passages shared from the middle."""
    words = [f"w{i}" for i in range(40)] + ["é", "🙂", "a\x1cb"]
    passages = [[rng.choice(words) for _ in range(rng.randint(5, 40))] for _ in range(12)]
    rows = []
    for i in range(120):
        parts = []
        for _ in range(rng.randint(0, 4)):
            p = rng.choice(passages)
            at = rng.randint(0, len(p) - 1)
            parts += rng.choice([p, p[at:], [rng.choice(words)] * rng.randint(1, 30), [rng.choice(words) for _ in range(20)]])
        rows.append((rng.randint(0, 200), rng.choice([" ", "\n", " \t "]).join(parts)))
    rows += [(300 + i, rows[3][1] or "x") for i in range(20)] + [(1, None), (2, ""), (None, rows[5][1]), (None, rows[5][1])]
    rows += [(400, "same word " * 20000), (401, "same word " * 20000 + "end"), (402, "word same " * 7)]
    return rows


def test_small(spark, rows, monkeypatch):
    for seed, size in ((1, 8 << 20), (2, 100_000)):
        monkeypatch.setattr(substrings, "SHARD_BYTES", size)
        data = made(random.Random(seed))
        docs = spark.createDataFrame([(*d, "x") for d in data], "doc_id long, text string, shard string")
        assert rows(substrings.report(docs)) == brute(data)
    assert substrings.report(docs.limit(0)).count() == 0


def test_query(spark):
    df = QUERIES["op3_repeats"](spark, SF)
    assert differences(df, ORACLE["op3_repeats"], SF) is None
    assert df.filter("n_removed > 0").count() > 0
    docs = [tuple(r) for r in table(spark, SF, "documents").select("doc_id", "text").collect()]
    assert sorted(map(tuple, df.collect()), key=repr) == brute(docs)


def test_prefixes_split_evenly():
    rng = np.random.default_rng(3)
    hot = rng.integers(0, 1 << 40, 5000).astype(np.uint64) + (np.uint64(77) << np.uint64(56))
    keys = np.concatenate([rng.integers(0, 1 << 63, 5000).astype(np.uint64), hot, np.full(300, 5 << 50, np.uint64)])
    begins = substrings.split_prefixes(keys, 20)
    assert begins[0] == 0 and (np.diff(begins.astype(object)) > 0).all()
    sizes = np.bincount(np.searchsorted(begins, keys, side="right") - 1)
    assert len(begins) >= 15 and sizes.max() <= 600
    assert substrings.split_prefixes(keys[:0], 20).tolist() == [0]


def test_deep_nodes_are_runs_of_equal_windows():
    rng = np.random.default_rng(4)
    symbols = rng.integers(0, 2, (300, 13)).astype(np.uint8)
    symbols[100:200] = symbols[:100]
    marks = np.arange(300, dtype=np.uint64)
    marks[100:150] = marks[:50]
    order, begins = substrings.deep_nodes(symbols, marks)
    groups = np.split(order, begins[1:])
    assert sorted(sorted(g.tolist()) for g in groups if len(g) > 1) == [[i, 100 + i] for i in range(50)]


def test_hot_ids_do_not_fill_a_shard(spark, rows, monkeypatch):
    monkeypatch.setattr(substrings, "SHARD_BYTES", 10_000)
    clean = substrings._clean_rows

    def bounded(texts, known):
        assert texts.num_rows <= 60, texts.num_rows
        return clean(texts, known)

    monkeypatch.setattr(substrings, "_clean_rows", bounded)
    rng = random.Random(5)
    text = lambda n: " ".join(rng.choice("abcdefgh") * 3 for _ in range(n))
    shared, same = text(20), text(60)
    data = [(None, shared + " " + text(40)) for _ in range(300)] + [(7, shared + " " + text(40)) for _ in range(300)]
    data += [(8, same)] * 307 + [(9, same + " " + shared), (5, shared)] + [(None, "x  y")] * 200
    docs = spark.createDataFrame(data, "doc_id long, text string")
    assert rows(substrings.report(docs)) == brute(data)
