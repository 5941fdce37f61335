import math
from collections import Counter

import numpy as np
import pytest

from skyflow.llm import whitening
from skyflow.llm.common import table

SCHEMA = "vec_id long, embedding array<float>, n int, x string"


def brute(rows, components=8, weights="count"):
    """Reference by plain numpy over all rows."""
    kept = [(i, [math.floor(1024 * float(np.float32(c))) + 100000 for c in v]) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    length = max(Counter(len(x) for _, x in kept).items(), key=lambda item: (item[1], item[0]))[0]
    kept = [(i, x) for i, x in kept if len(x) == length]
    fit = [x for _, x in kept] if weights == "count" else [list(x) for x in {tuple(x) for _, x in kept}]
    n, total = len(fit), [sum(c) for c in zip(*fit)]
    centred = np.array(fit, float) - np.array(total) / n
    matrix = centred.T @ centred / n
    values, vectors = np.linalg.eigh(matrix)
    order = np.argsort(-values)[:components]
    found = {}
    for place, (i, x) in enumerate(kept):
        deviation = sum((n * c - s) ** 2 for c, s in zip(x, total))
        z = (np.array(x) - np.array(total) / n) @ vectors[:, order] / np.sqrt(values[order])
        found.setdefault((i, deviation), []).append((place, z))
    return n, found, values[order] / np.trace(matrix), vectors[:, order]


def check(found, expected, components):
    n, rows, explained, _ = expected
    by_row = {}
    for r in found:
        assert r.n == n and r.identity_error <= 1e-8
        assert abs(r.explained / explained[r.component - 1] - 1) < 1e-9
        by_row.setdefault((r.vec_id, r.deviation), []).append((r.component, r.whitened))
    assert set(by_row) == set(rows)
    signs = None
    for key, values in by_row.items():
        assert len(values) == components * len(rows[key])
        mine = np.array([np.mean([w for c, w in values if c == k + 1]) for k in range(components)])
        theirs = rows[key][0][1]
        if signs is None and np.abs(theirs).min() > 1e-3:
            signs = np.sign(mine * theirs)
        if signs is not None:
            assert np.allclose(mine * signs, theirs, atol=1e-7)
    assert signs is not None


def test_whole_table(spark):
    df = table(spark, "/root/testdata/sf0.01", "embeddings")
    plain = [(r.vec_id, r.embedding) for r in df.collect()]
    check(whitening.whiten(df).collect(), brute(plain), 8)


def many(rng, n, d=5):
    return [(i, rng.normal(size=d).round(3).tolist()) for i in range(n)]


@pytest.mark.parametrize("weights", ["count", "one"])
def test_copies_nulls_repeated_rows_and_clashing_names(spark, weights):
    rng = np.random.default_rng(3)
    rows = many(rng, 60) + [(100 + i, [0.5, 0.25, -0.125, 1.0, 2.0]) for i in range(40)] + [(7, [9.0, 1.0, 2.0, 3.0, 4.0])] * 3 + [(None, [1.0, 5.0, 2.0, 8.0, 4.0])] * 2
    bad = [(1, None), (2, []), (3, [1.0, None, 1.0, 1.0, 1.0]), (4, [1.0, math.nan, 1.0, 1.0, 1.0]), (5, [math.inf, 1.0, 1.0, 1.0, 1.0]), (6, [1.0, 2.0])]
    df = spark.createDataFrame([(*r, 3, "x") for r in rows + bad], SCHEMA)
    found = whitening.whiten(df, components=4, weights=weights).collect()
    check(found, brute(rows, 4, weights), 4)


def test_fewer_dimensions_than_components(spark):
    rows = many(np.random.default_rng(4), 30, d=3)
    check(whitening.whiten(spark.createDataFrame([(*r, 3, "x") for r in rows], SCHEMA)).collect(), brute(rows, 3), 3)


def test_directions_without_variance(spark):
    rng = np.random.default_rng(5)
    flat = [(i, [*rng.normal(size=2).tolist(), 0.5, 0.5]) for i in range(30)]
    found = whitening.whiten(spark.createDataFrame([(*r, 3, "x") for r in flat], SCHEMA)).collect()
    assert {r.component for r in found} == {1, 2} and len(found) == 60
    for rows in ([], [(1, [1.0, 2.0])], [(i, [1.0, 2.0]) for i in range(9)], [(1, None)]):
        assert whitening.whiten(spark.createDataFrame([(*r, 3, "x") for r in rows], SCHEMA)).collect() == []


def test_exact_beyond_doubles():
    x = np.array([[2**31, 5], [3, 2**33]])
    moved = whitening._moved(x, 10**7, [7 * 10**15, 11])
    exact = [[10**7 * 2**31 - 7 * 10**15, 10**7 * 5 - 11], [10**7 * 3 - 7 * 10**15, 10**7 * 2**33 - 11]]
    assert moved.tolist() == exact
    assert whitening._deviation(moved) == [None, None]
    assert whitening._deviation(np.array([[3 * 10**9, 1], [3 * 10**9, 5 * 10**8]])) == [9 * 10**18 + 1, None]
