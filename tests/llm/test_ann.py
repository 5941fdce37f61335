import numpy as np
import pytest
from pyspark.sql import functions as F

from skyflow.llm import ann
from skyflow.llm.common import table
from skyflow.llm.queries import QUERIES

SF = "/root/testdata/sf0.1"


def brute(ids, vectors, nearest=5):
    norms = np.sqrt((vectors * vectors).sum(axis=1))
    out = {}
    for row in np.flatnonzero(ids % 50 == 0):
        scores = (vectors * vectors[row]).sum(axis=1) / (norms * norms[row])
        order = [i for i in np.lexsort((ids, -scores)) if ids[i] != ids[row]][:nearest]
        out[int(ids[row])] = [(int(ids[i]), float(scores[i])) for i in order]
    return out


def test_query_recall(spark):
    rows = table(spark, SF, "embeddings").collect()
    ids, vectors = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows])
    wanted = brute(ids, vectors)
    found = {}
    for r in QUERIES["op5_neighbours"](spark, SF).orderBy("query_id", "rank").collect():
        found.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert found.keys() == wanted.keys() and all(len(f) == 5 for f in found.values())
    hits = [len({i for i, _ in found[q]} & {i for i, _ in wanted[q]}) / 5 for q in wanted]
    assert np.mean(hits) >= 0.95
    exact = {(q, i): s for q in wanted for i, s in wanted[q]}
    assert all(abs(exact[q, i] - s) < 1e-12 for q in found for i, s in found[q] if (q, i) in exact)


def test_small(spark, rows, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK_ROWS", 3)
    data = [(0, [1.0, 0.0]), (1, [2.0, 0.0]), (2, [3.0, 0.0]), (3, [0.0, 1.0]), (4, [-1.0, 0.0]), (50, [1.0, 1.0])]
    bad = [(100, None), (150, []), (200, [0.0, 0.0]), (5, [None, 1.0]), (6, [float("nan"), 1.0]), (7, [float("inf"), 1.0]), (None, [1.0, 0.0])]
    odd = [(8, [1.0, 2.0, 3.0]), (250, [1.0, 2.0, 3.0]), (300, [1.0])]
    vectors = spark.createDataFrame([(*d, 1) for d in [*data, data[1], *bad, *odd]], "vec_id long, embedding array<double>, rank int")
    found = rows(ann.nearest_neighbours(vectors, F.col("vec_id") % 50 == 0))
    wanted = brute(np.array([i for i, _ in data]), np.array([v for _, v in data]))
    expected = sorted((q, n, i, s) for q, near in wanted.items() for n, (i, s) in enumerate(near, 1))
    assert [r for r in found if r[0] < 250] == expected
    assert [r[:3] for r in found if r[0] >= 250] == [(250, 1, 8)]
    assert ann.nearest_neighbours(vectors.limit(0), F.col("vec_id") % 50 == 0).count() == 0


def ladder(index, query, query_id, nearest):
    """Rows verified and the step of the first width that ends a search, by all distances and all cosines."""
    unit = index.vectors / index.lengths[:, None]
    query = query / np.linalg.norm(query)
    distance, cosine = np.abs((unit - query) @ index.directions), unit @ query
    step = 0
    while True:
        width = ann.FIRST_WIDTH * ann.WIDER**step
        rows = np.flatnonzero((distance <= width).sum(axis=1) >= ann.THRESHOLD * ann.PROJECTIONS)
        best = {}
        for row in rows:
            if index.ids[row] != query_id:
                best[index.ids[row]] = max(best.get(index.ids[row], -2), cosine[row])
        near = sorted(best.values(), reverse=True)
        sure = len(near) >= nearest and width >= ann.SURE * np.sqrt(max(0, 2 - 2 * near[nearest - 1]))
        share = lambda n: min(n, max(ann.LEAST_VERIFIED, int(ann.SHARE_VERIFIED * n)))
        many = len(set(index.ids[rows].tolist())) >= share(len(set(index.ids.tolist())))
        many = many and len({tuple(np.round(unit[r], 9)) for r in rows}) >= share(len({tuple(np.round(u, 9)) for u in unit}))
        if sure or many:
            return rows, step, near
        step += 1


@pytest.mark.parametrize("narrow", [1, 12, 10**9])
def test_windows_count_collisions(monkeypatch, narrow):
    """Each search ends at the first width that ends it, wherever the one before ended, with what collides there."""
    monkeypatch.setattr(ann, "NARROW", narrow)
    rng = np.random.default_rng(1)
    close = rng.standard_normal((20, 16))
    vectors = np.concatenate([rng.standard_normal((800, 16)), np.repeat(close, 20, axis=0) + 0.01 * rng.standard_normal((400, 16))])
    index = ann.CollisionIndex(np.arange(1200) // 2 * 2, vectors)
    steps = set()
    for row in (7, 900, 1100, 20, 30, 1199):
        rows, step, near = ladder(index, vectors[row], index.ids[row], 5)
        found = index.search(index.ids[row], vectors[row], 5)
        at = (vectors[row] / np.linalg.norm(vectors[row])) @ index.directions
        assert index.step == step and index.colliding(at, ann.FIRST_WIDTH * ann.WIDER**step).tolist() == rows.tolist()
        assert np.allclose([score for _, score in found], near[:5], atol=1e-12)
        steps.add(step)
    assert max(steps) - min(steps) > 10


def test_near_vectors_end_the_search_early():
    """In groups of close vectors a small part of the block is touched, and nothing is missed."""
    rng = np.random.default_rng(4)
    centres = rng.standard_normal((400, 32))
    vectors = np.repeat(centres, 10, axis=0) + 0.05 * rng.standard_normal((4000, 32))
    index, unit = ann.CollisionIndex(np.arange(4000), vectors), vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    for row in range(0, 4000, 100):
        found = [i for i, _ in index.search(row, vectors[row], 5)]
        cosine = unit @ unit[row]
        cosine[row] = -2
        assert found == np.argsort(-cosine)[:5].tolist()
        at, width = unit[row] @ index.directions, ann.FIRST_WIDTH * ann.WIDER**index.step
        assert (np.abs(unit @ index.directions - at) <= width).mean() < 0.25


def test_repeated_rows_take_one_place(spark, rows):
    data = [(0, [1.0, 0.0]), *[(1, [1.0, 0.0])] * 10, *[(i, [1.0, 0.1 * i]) for i in range(2, 8)]]
    vectors = spark.createDataFrame(data, "vec_id long, embedding array<double>")
    found = rows(ann.nearest_neighbours(vectors, F.col("vec_id") == 0))
    assert [r[:3] for r in found] == [(0, n, n) for n in range(1, 6)]
    twice = rows(ann.nearest_neighbours(vectors.union(vectors), F.col("vec_id") == 0))
    assert twice == found


def test_copies_of_a_row_do_not_end_the_search():
    rng = np.random.default_rng(2)
    vectors = rng.standard_normal((1000, 16))
    hot = vectors[0] + 0.01 * rng.standard_normal((400, 16))
    index = ann.CollisionIndex(np.concatenate([np.arange(1000), np.full(400, 1000)]), np.concatenate([vectors, hot]))
    found = index.search(0, vectors[0], 5)
    assert found[0][0] == 1000 and len({i for i, _ in found}) == 5


def hot_recall():
    """Recall of queries near a vector that a third of the rows have, with vectors a little nearer than it."""
    rng, recalls = np.random.default_rng(3), []
    unit = lambda x: x / np.linalg.norm(x, axis=-1, keepdims=True)
    for _ in range(20):
        query, noise = unit(rng.standard_normal(64)), rng.standard_normal((21, 64))
        around = unit(noise - np.outer(noise @ query, query))
        hot, near = unit(query + 0.5 * around[0]), unit(query + 0.49 * around[1:])
        vectors = np.concatenate([unit(rng.standard_normal((2980, 64))), near, np.tile(hot, (1500, 1))])
        found = ann.CollisionIndex(np.arange(len(vectors)), vectors).search(-1, query, len(near))
        recalls.append(len({i for i, _ in found} & {*range(2980, 3000)}) / len(near))
    return float(np.mean(recalls))


def test_recall_near_a_hot_vector():
    assert hot_recall() >= 0.95


def test_tiny_and_huge_vectors(spark, rows):
    data = [(i, [np.cos(i / 10), np.sin(i / 10)]) for i in range(12)]
    scale = {0: 1e300, 2: 1e-300, 3: 5e-324, 5: 1e200, 7: 1e-170}
    sized = [(i, [float(x * scale.get(i, 1.0)) for x in v]) for i, v in data if i != 3] + [(3, [5e-324, 0.0])]
    vectors = spark.createDataFrame(sized, "vec_id long, embedding array<double>")
    found = rows(ann.nearest_neighbours(vectors, F.col("vec_id").isin(0, 7)))
    assert [r[2] for r in found] == [3, 1, 2, 4, 5, 6, 8, 5, 9, 4]
    wanted = [1.0, *np.cos([0.1, 0.2, 0.4, 0.5, 0.1, 0.1, 0.2, 0.2, 0.3])]
    assert np.allclose([r[3] for r in found], wanted, atol=1e-12)
