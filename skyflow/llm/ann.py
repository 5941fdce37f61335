"""Approximate nearest neighbours by counting collisions in query-centred windows.

Vectors are dealt to blocks of bounded size. A block keeps, for each of several random projections,
its vectors in order of their projection. Around a query's projection a window is opened in every
order; a vector collides where it lies inside, and is verified on the original vectors if it collides
in most windows. Windows have one of a ladder of widths. The search ends at the first width at which
no nearer vector is likely to be outside, given how near the verified ones are, or at which a share of the
block is verified. Vectors outside narrow windows cost nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

NEAREST = 5
#: Vectors of a block, on average.
BLOCK_ROWS = 16_384
PROJECTIONS = 96
#: Share of the projections in which a vector must collide to be verified.
THRESHOLD = 0.85
#: Half-width of the narrowest windows on unit vectors, and the factor from one width to the next.
FIRST_WIDTH, WIDER = 0.7 / 1.15**20, 1.15
#: A vector at distance d has a normally distributed difference of projections with deviation d. In windows of this many
#: deviations it collides in 94 % of the projections on average, three deviations of that number above ``THRESHOLD``.
SURE = 1.9
#: Windows also stop to widen when so many ids and different vectors, and so large a share of the block's, are verified.
LEAST_VERIFIED, SHARE_VERIFIED = 200, 0.08
#: Windows with under one in so many of all places are counted place by place, wider ones by the ranks of all vectors.
NARROW = 12
SEED = 20


def scaled(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Vectors divided by powers of two so that their largest components are near 1, and the exponents.

    No square is lost then. Cosines stay the same to the last bit where they could be computed before.
    """
    _, exponents = np.frexp(np.abs(vectors).max(axis=-1))
    return np.ldexp(vectors, -exponents[..., None]), exponents


class CollisionIndex:
    """The sorted projections of a block of vectors, and the rank each vector has in them."""

    #: Between the projections in the one array that holds all of them in order.
    GAP = 1e4

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        vectors, exponents = scaled(vectors)
        self.ids, self.vectors = ids, vectors
        self.different_ids, self.id_numbers = np.unique(ids, return_inverse=True)
        self.lengths = np.sqrt((vectors * vectors).sum(axis=1))
        #: Of the vectors as they were given; infinite or zero where a double cannot hold it.
        self.norms = np.ldexp(self.lengths, exponents)
        rng = np.random.default_rng(SEED)
        self.directions = rng.standard_normal((vectors.shape[1], PROJECTIONS))
        projected = ((vectors / self.lengths[:, None]) @ self.directions).T
        # Copies of a vector, scaled or not, collide together; a few projections tell vectors apart.
        apart = np.round(projected[:4], 9) + 0.0
        _, numbers = np.unique(apart, axis=1, return_inverse=True)
        self.vector_numbers = numbers.reshape(-1)
        self.different_vectors = int(self.vector_numbers.max()) + 1
        order = np.argsort(projected, axis=1, kind="stable")
        self.offsets = np.arange(PROJECTIONS) * self.GAP
        self.sorted = (np.take_along_axis(projected, order, axis=1) + self.offsets[:, None]).ravel()
        self.ranks = np.empty(projected.shape, np.uint16 if len(ids) < 1 << 16 else np.uint32)
        np.put_along_axis(self.ranks, order, np.arange(len(ids), dtype=self.ranks.dtype)[None, :], axis=1)
        self.order = order.astype(self.ranks.dtype).ravel()
        self.needed = int(np.ceil(THRESHOLD * PROJECTIONS))
        #: Where the search of the query before ended, on the ladder of widths.
        self.step = 0

    def colliding(self, at: np.ndarray, width: float) -> np.ndarray:
        """Rows that collide in enough windows of half-width ``width`` around the projections ``at``, in order."""
        size = len(self.ids)
        low = np.searchsorted(self.sorted, at + self.offsets - width)
        high = np.searchsorted(self.sorted, at + self.offsets + width, side="right")
        if NARROW * int((high - low).sum()) < PROJECTIONS * size:
            places = np.concatenate([self.order[i:j] for i, j in zip(low.tolist(), high.tolist(), strict=True)])
            counts = np.bincount(places, minlength=size)
        else:
            # A rank is in the window exactly if its distance to the window's start is under the length.
            starts, lengths = (low - np.arange(PROJECTIONS) * size).astype(self.ranks.dtype), (high - low).astype(self.ranks.dtype)
            counts = np.zeros(size, np.uint8 if PROJECTIONS < 256 else np.uint32)
            distance, inside = np.empty(size, self.ranks.dtype), np.empty(size, bool)
            for ranks, start, length in zip(self.ranks, starts, lengths, strict=True):
                np.less(np.subtract(ranks, start, out=distance), length, out=inside)
                np.add(counts, inside.view(np.uint8), out=counts)
        return np.flatnonzero(counts >= self.needed)

    @staticmethod
    def _enough(found: np.ndarray, numbers: np.ndarray, different: int) -> bool:
        """Whether rows have enough of the ``different`` values that ``numbers`` tells apart."""
        wanted = min(different, max(LEAST_VERIFIED, int(SHARE_VERIFIED * different)))
        if len(found) < wanted:
            return False
        seen = np.zeros(different, bool)
        seen[numbers[found]] = True
        return np.count_nonzero(seen) >= wanted

    def search(self, query_id: int, query: np.ndarray, nearest: int) -> list[tuple[int, float]]:
        """(id, cosine) of the nearest ids verified, each by its best row, without the query's own id.

        Whatever ends the search at one width also ends it at all wider ones, so the first such width is
        looked for from where the query before ended, in growing strides and then by halving.
        """
        query, _ = scaled(query)
        norm = np.sqrt((query * query).sum())
        at = (query / norm) @ self.directions
        scores, known, found = np.empty(len(self.ids)), np.zeros(len(self.ids), bool), {}

        def verify(rows: np.ndarray) -> None:
            new = rows[~known[rows]]
            known[new] = True
            # Summed row by row, so equal vectors have equal scores.
            scores[new] = (self.vectors[new] * query).sum(axis=1) / (self.lengths[new] * norm)

        def ends(step: int) -> bool:
            width = FIRST_WIDTH * WIDER**step
            found[step] = rows = self.colliding(at, width)
            if self._enough(rows, self.id_numbers, len(self.different_ids)) and self._enough(
                rows, self.vector_numbers, self.different_vectors
            ):
                return True
            verify(rows)
            near = self.ids[rows[scores[rows] >= 1 - (width / SURE) ** 2 / 2]]
            return len(near) >= nearest and len(np.unique(near[near != query_id])) >= nearest

        # The step ``low`` is too narrow, or before the first; ``high`` is not.
        stride = 1
        if ends(self.step):
            high = self.step
            while (low := max(-1, high - stride)) >= 0 and ends(low):
                high, stride = low, 2 * stride
        else:
            low = self.step
            while not ends(high := low + stride):
                low, stride = high, 2 * stride
        while high - low > 1:
            middle = (low + high) // 2
            low, high = (low, middle) if ends(middle) else (middle, high)
        self.step = high

        verify(found[high])
        rows = found[high][self.ids[found[high]] != query_id]
        order = np.lexsort((self.ids[rows], -scores[rows]))
        # The first row of each id is its best.
        first = np.unique(self.ids[rows[order]], return_index=True)[1]
        best = rows[order[np.sort(first)[:nearest]]]
        return list(zip(self.ids[best].tolist(), scores[best].tolist(), strict=True))


def usable(vector: Column) -> Column:
    """Whether a vector has only finite components and one that is not zero."""
    finite = lambda x: x.isNotNull() & (F.abs(x) < float("inf")) & ~F.isnan(x)
    return vector.isNotNull() & F.forall(vector, finite) & F.exists(vector, lambda x: x != 0)


def _search_blocks(batches: Iterator[pa.RecordBatch], nearest: int) -> Iterator[pa.RecordBatch]:
    """Rows of a partition come block by block, vectors before queries."""
    block, kept, index = None, [], None
    for batch in batches:
        blocks, roles = batch["block"].to_pylist(), batch["is_query"].to_pylist()
        ids = batch["vec_id"].to_pylist()
        flat = batch["vector"].flatten().to_numpy(zero_copy_only=False)
        ends = np.cumsum(batch["vector"].value_lengths().to_numpy(zero_copy_only=False)).tolist()
        found = []
        for key, is_query, i, start, end in zip(blocks, roles, ids, [0, *ends], ends):
            vector = flat[start:end]
            if key != block:
                block, kept, index = key, [], None
            if not is_query:
                kept.append((i, vector.copy()))
                continue
            if index is None and kept:
                index = CollisionIndex(np.array([x for x, _ in kept]), np.array([v for _, v in kept]))
                kept = []
            if index is not None:
                found += [(i, other, score) for other, score in index.search(i, vector, nearest)]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([x[0] for x in found], pa.int64()),
                pa.array([x[1] for x in found], pa.int64()),
                pa.array([x[2] for x in found], pa.float64()),
            ],
            ["query_id", "vec_id", "score"],
        )


def nearest_neighbours(
    vectors: DataFrame, is_query: Column, *, id_col: str = "vec_id", vector_col: str = "embedding", nearest: int = NEAREST
) -> DataFrame:
    """Rows (query_id, rank, vec_id, score): for rows of ``vectors`` that meet ``is_query``, the nearest other rows.

    Nearness is the cosine in double precision; ties go to the smaller id. Rows without id, and
    vectors that are null, empty, zero or have a component that is null or not finite take no part;
    vectors of different lengths are not compared. Rows that share an id count as one, its best.
    """
    rows = vectors.select(
        F.col(f"`{id_col}`").cast("long").alias("vec_id"),
        F.col(f"`{vector_col}`").cast("array<double>").alias("vector"),
        F.coalesce(is_query, F.lit(False)).alias("is_query"),
    ).filter(F.col("vec_id").isNotNull() & usable(F.col("vector")))
    blocks = 1 + rows.count() // BLOCK_ROWS
    length = F.size("vector").cast("string")
    name = lambda number: F.concat_ws(".", length, number.cast("string"))
    data = rows.select(name(F.pmod(F.xxhash64("vec_id"), F.lit(blocks))).alias("block"), F.lit(False).alias("is_query"), "vec_id", "vector")
    # Every block sees every query; queries stream through it and are never held together.
    queries = rows.filter("is_query").select(F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("number"), "vec_id", "vector")
    queries = queries.select(name(F.col("number")).alias("block"), F.lit(True).alias("is_query"), "vec_id", "vector")
    dealt = data.union(queries).repartition(2 * blocks, "block").sortWithinPartitions("block", "is_query", "vec_id")
    found = dealt.mapInArrow(lambda batches: _search_blocks(batches, nearest), "query_id long, vec_id long, score double")
    found = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= nearest)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
