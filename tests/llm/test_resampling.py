import hashlib
import math
import re
import zlib
from collections import Counter

from pyspark.sql import functions as F

from skyflow.llm import resampling
from skyflow.llm.common import table

SF = "/root/testdata/sf0.001"


def words_of(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def features_of(text, longest):
    words = words_of(text)
    return [" ".join(words[i : i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]


def brute(docs, target, longest=1, percent=10, least_words=20, buckets=10000):
    place = lambda f: zlib.crc32(f.encode()) % buckets
    s, t = Counter(), Counter()
    for _, text in docs:
        s.update(map(place, features_of(text, longest)))
    for text in target:
        t.update(map(place, features_of(text, longest)))
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = {
        b: math.floor(1000 * math.log(float(t[b] + 1) * float(all_s + buckets) / (float(s[b] + 1) * float(all_t + buckets)))) for b in s
    }
    rows = []
    for i, text in docs:
        found = features_of(text, longest)
        weight = sum(gain[place(f)] for f in found)
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append([i, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(words_of(text))])
    able = [r for r in rows if r[5] >= least_words]
    able.sort(key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for rank, row in enumerate(able[: len(able) * percent // 100], 1):
        row[4] = rank
    return sorted((tuple(r[:5]) for r in rows), key=repr)


def test_whole_table(spark, rows):
    docs, target = table(spark, SF, "documents"), table(spark, SF, "benchmark")
    plain = [(r.doc_id, r.text) for r in docs.collect()]
    texts = [r.text for r in target.collect()]
    found = rows(resampling.resample(docs, target))
    assert found == brute(plain, texts)
    assert sum(r[4] is not None for r in found) > 10


def test_longer_runs_and_pieces(spark, rows, monkeypatch):
    docs = [(i, f"Alpha beta-gamma {i} " * (10 + i)) for i in range(30)] + [(40, "ünïcode " * 25)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    target = spark.createDataFrame([("beta gamma 3 alpha",)], "text string")
    found = rows(resampling.resample(df, target, longest=3, percent=50, buckets=97))
    assert found == brute(docs, ["beta gamma 3 alpha"], longest=3, percent=50, buckets=97)
    data = " ".join(f"w{i}" for i in range(500)).encode()
    whole = [f for _, part in resampling.features(data, 3) for f in part]
    monkeypatch.setattr(resampling, "PIECE", 7)
    pieces = list(resampling.features(data, 3))
    assert len(pieces) > 100 and sum(n for n, _ in pieces) == 500
    assert Counter(f for _, part in pieces for f in part) == Counter(whole)


def test_nulls_ties_repeated_rows_and_clashing_names(spark, rows):
    text = "one two three four five " * 5
    docs = [(1, text)] * 40 + [(2, text), (None, text), (None, text), (3, None), (4, ""), (5, "short text"), (6, "long words " * 300_000)]
    df = spark.createDataFrame([(*d, 1, 2, "x") for d in docs], "doc_id long, text string, row int, rank int, score string")
    target = spark.createDataFrame([("three four", 7), (None, 8)], "text string, n int")
    found = rows(resampling.resample(df, target, percent=30))
    assert found == brute(docs, ["three four", None], percent=30)
    ranks = sorted(r[4] for r in found if r[4])
    assert ranks == list(range(1, 44 * 30 // 100 + 1))


def test_empty_tables(spark, rows):
    docs = spark.createDataFrame([], "doc_id long, text string")
    some = spark.createDataFrame([(i, "a b c d " * 9) for i in range(20)], "doc_id long, text string")
    assert rows(resampling.resample(docs, some)) == []
    found = rows(resampling.resample(some, docs))
    assert found == brute([(i, "a b c d " * 9) for i in range(20)], [])
    assert sum(r[4] is not None for r in found) == 2


def test_selection_equals_sorting(spark):
    """Many equal scores: the key's place in the order is exact for every wanted rank."""
    keys = spark.range(3000).select(
        (F.col("id") % 5).alias("down"), (F.col("id") % 2).alias("nameless"), (F.col("id") % 7).alias("known"), F.col("id").alias("row")
    )
    ordered = sorted(tuple(r) for r in keys.collect())
    for k in (1, 2, 700, 2999, 3000):
        assert resampling.kth_key(keys, k) == ordered[k - 1]
