import random
import re

import xxhash
from pyspark.sql import functions as F

from skyflow.llm import simhash
from skyflow.llm.common import table
from skyflow.llm.components import connected
from skyflow.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    shingles = [words[i : i + 3] for i in range(len(words) - 2)] or [words]
    hashes = [xxhash.xxh64_intdigest(" ".join(s).encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def brute(rows):
    prints = {}
    for i, f in rows:
        prints.setdefault(f, []).append(i)
    parent = {f: f for f in prints}

    def root(f):
        while parent[f] != f:
            f = parent[f]
        return f

    keys = [*prints]
    for a in range(len(keys)):
        for b in range(a):
            if (keys[a] ^ keys[b]).bit_count() <= 2:
                parent[root(keys[a])] = root(keys[b])
    first = {}
    for f, ids in prints.items():
        first[root(f)] = min([first.get(root(f), 1 << 62), *(i for i in ids if i is not None)])
    return sorted(((i, f"{f:016x}", first[root(f)] if first[root(f)] < 1 << 62 else None) for i, f in rows), key=repr)


def test_query(spark, rows):
    docs = [(r.doc_id, brute_fingerprint(r.text)) for r in table(spark, SF, "documents").collect()]
    found = rows(QUERIES["op10_simhash"](spark, SF))
    assert found == brute(docs)
    assert any(i != c for i, _, c in found)


def test_small(spark, rows):
    data = [(1, None), (2, ""), (3, " \t\n\x0b\f\r"), (4, "one"), (5, "ONE"), (6, "one two"), (7, "one\x1ctwo"), (7, "one\x1ctwo")]
    data += [(8, "long text " * 40000), (9, "LONG text " * 40000), (None, "null id"), (10, "null id"), (None, "only null id")]
    docs = spark.createDataFrame([(*d, "x") for d in data], "doc_id long, text string, bits string")
    found = rows(simhash.near_duplicates(docs))
    assert found == brute([(i, brute_fingerprint(t)) for i, t in data])
    assert simhash.near_duplicates(docs.limit(0)).count() == 0
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == sorted([1, 4, 6, 7, 7, 8, 10, None, None], key=repr)


def planted(rng, size):
    """Numbers with chains and crowds of numbers that differ in a few bits."""
    found = {rng.getrandbits(64) for _ in range(size)}
    for start in [*found][: size // 8]:
        for _ in range(rng.randint(1, 6)):
            for _ in range(rng.randint(1, 3)):
                start ^= 1 << rng.randrange(64)
            found.add(start)
    centre = rng.getrandbits(64)
    found |= {centre ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for _ in range(size)}
    return [*found, 0, (1 << 64) - 1, 1 << 63]


def test_links_connect_what_brute_force_connects(spark, monkeypatch):
    numbers = planted(random.Random(7), 300)
    signed = [(n - (1 << 64) if n >> 63 else n,) for n in numbers]
    wanted = {(i, c) for i, _, c in brute([*enumerate(numbers)])}
    first = {n: i for i, n in enumerate(numbers)}
    for rows_of_cell in (64, 3):
        monkeypatch.setattr(simhash, "CELL_ROWS", rows_of_cell)
        links = simhash.links(spark.createDataFrame(signed, "bits long"))
        assert links.filter(F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) > 2).count() == 0
        label = {r.node % (1 << 64): r.component % (1 << 64) for r in connected(links).collect()}
        groups = {}
        for n in numbers:
            groups.setdefault(label.get(n, n), []).append(first[n])
        assert {(i, min(g)) for g in groups.values() for i in g} == wanted


def test_what_grows_with_the_documents_is_never_broadcast(spark, monkeypatch):
    """The optimizer takes exploded rows for as few as the fingerprints, and these for as small as their files."""
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    kept, plans = simhash.staged, {}

    def watched(df, name):
        plans[name] = plan(df)
        return kept(df, name)

    monkeypatch.setattr(simhash, "staged", watched)
    docs = spark.createDataFrame([(i, f"text number {i // 2}") for i in range(60)], "doc_id long, text string")
    found = simhash.near_duplicates(docs)
    assert found.count() == 60 and found.select("component_id").distinct().count() == 30
    joins = [line for line in plan(found).splitlines() if "Join" in line]
    assert "SortMergeJoin" in plans["simhash-cells"] and "Broadcast" not in plans["simhash-cells"]
    # The links' components are joined first; what is made of them meets the fingerprints and the rows by shuffles.
    assert ["SortMergeJoin" in line for line in joins[:2]] == [True, True]
    pairs = simhash.links(spark.range(100).select(F.col("id").alias("bits")))
    assert "SortMergeJoin" in plan(pairs) and "Broadcast" not in plan(pairs)


def test_cells_bound_the_distance(spark):
    rng = random.Random(9)
    pairs = []
    for _ in range(200):
        a = rng.getrandbits(64)
        b = a
        for _ in range(rng.randint(0, 2)):
            b ^= 1 << rng.randrange(64)
        pairs.append(tuple(x - (1 << 64) if x >> 63 else x for x in (a, b)))
    df = spark.createDataFrame(pairs, "a long, b long")
    cells = lambda c: F.transform(simhash.cells_near(F.col(c)), lambda s: s + simhash.cell_of(F.col(c)))
    assert df.filter(~F.arrays_overlap(cells("a"), cells("b"))).count() == 0


def test_components(spark, rows):
    chain = [(i, i + 1) for i in range(100, 140)]
    star = [(7, i) for i in range(200, 260)]
    links = spark.createDataFrame([*chain, *star, (300, 301), (301, 300), (9, 9)], "u long, v long")
    found = dict(rows(connected(links)))
    assert found == {i: 100 for i in range(100, 141)} | {i: 7 for i in [7, *range(200, 260)]} | {300: 300, 301: 300}
    assert connected(links.limit(0)).count() == 0
