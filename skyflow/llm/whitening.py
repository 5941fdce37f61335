"""Whitening of embeddings by a covariance weighted with multiplicities.

Vectors become whole numbers, equal ones are grouped and counted, and every pass works on the
distinct ones: exact sums, the covariance as a weighted product of centred matrices per task, and
the projection on its eigenvectors. The rows get their vector's projection by a join on its digest.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyflow.llm import common
from skyflow.plans.staging import staged

COMPONENTS = 8
#: Vector entries are multiplied, rounded down and moved by these.
SCALE, SHIFT = 1024, 100_000
#: Vectors of a matrix product at a time.
BLOCK = 4096
#: Eigenvalues below this share of the largest, times the number of dimensions, are zero in doubles.
ZERO = 2.0**-50
LARGEST = 2**63 - 1


def grid_vectors(rows: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Rows (vec_id, x, digest) of the vectors without null or non-finite entries; ``x`` are whole numbers."""
    entries = F.col(f"`{vector_col}`").cast("array<double>")
    bad = lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))
    sound = entries.isNotNull() & (F.size(entries) > 0) & ~F.exists(entries, bad)
    x = F.transform(entries, lambda c: F.floor(c * SCALE) + SHIFT)
    kept = rows.filter(F.coalesce(sound, F.lit(False))).select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), x.alias("x"))
    return kept.withColumn("digest", F.sha2(F.array_join(F.col("x").cast("array<string>"), ",").cast("binary"), 256))


def _matrix(column: pa.ListArray) -> np.ndarray:
    """Lists of equal length as a matrix."""
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(column), -1) if len(column) else np.zeros((0, 0), values.dtype)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    for batch in common.slices(batches, BLOCK):
        if batch.num_rows:
            yield batch, _matrix(batch["x"]), batch["weight"].to_numpy()


def sums(distinct: DataFrame, dimensions: int) -> tuple[int, list[int]]:
    """Number of vectors and exact sum of every dimension; columns (x, weight)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [0] * (dimensions + 1)
        for _, x, weight in _blocks(batches):
            # Whole numbers of Python where a product might not fit.
            exact = np.abs(x).max() * float(weight.sum()) < 2.0**62
            parts = weight @ x if exact else weight.astype(object) @ x.astype(object)
            total = [t + int(p) for t, p in zip(total, [weight.sum(), *parts])]
        yield pa.RecordBatch.from_arrays([pa.array(range(dimensions + 1), pa.int32()), pa.array(map(str, total))], ["place", "part"])

    parts = distinct.select("x", "weight").mapInArrow(common.releasing(run), "place int, part string")
    found = parts.groupBy("place").agg(F.sum(F.col("part").cast("decimal(38,0)")).alias("total")).collect()
    total = {row["place"]: int(row["total"]) for row in found}
    return total.get(0, 0), [total.get(i + 1, 0) for i in range(dimensions)]


def _moved(x: np.ndarray, n: int, total: list[int]) -> np.ndarray:
    """``n * x - S`` exactly, as numbers of Python where they might not fit."""
    if n * (float(np.abs(x).max()) + 1) < 2.0**62:
        return n * x - np.array(total, np.int64)
    return n * x.astype(object) - np.array(total, object)


def covariance(distinct: DataFrame, n: int, total: list[int]) -> np.ndarray:
    """Covariance of (x, weight) with divisor ``n``, centred before multiplying.

    A task adds up its products; their sum is formed in Spark, and as many numbers as the matrix has reach the driver.
    """
    dimensions = len(total)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        product = np.zeros((dimensions, dimensions))
        for _, x, weight in _blocks(batches):
            centred = (_moved(x, n, total) / n).astype(np.float64)
            product += (centred * weight[:, None]).T @ centred
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(dimensions), pa.int32()), pa.array(list(product), pa.list_(pa.float64()))], ["line", "values"]
        )

    parts = distinct.select("x", "weight").mapInArrow(common.releasing(run), "line int, values array<double>")
    cells = parts.select("line", F.posexplode("values").alias("place", "value")).groupBy("line", "place").agg(F.sum("value").alias("value"))
    found = np.zeros((dimensions, dimensions))
    for row in cells.collect():
        found[row["line"], row["place"]] = row["value"] / n
    return (found + found.T) / 2


def directions(matrix: np.ndarray, components: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues and, as columns, their unit eigenvectors; of each the largest entry is positive."""
    values, vectors = np.linalg.eigh(matrix)
    values, vectors = values[::-1], vectors[:, ::-1]
    there = values > max(values[0], 0) * len(values) * ZERO
    values, vectors = values[there][:components], vectors[:, there][:, :components]
    largest = np.abs(vectors).argmax(axis=0)
    return values, vectors * np.where(vectors[largest, range(len(values))] < 0, -1.0, 1.0)


def _deviation(moved: np.ndarray) -> list[int | None]:
    """Exact sums of squares, None where they exceed a long."""
    rough = np.square(moved.astype(np.float64)).sum(axis=1)
    if moved.dtype != object and rough.max() < 2.0**62:
        return np.square(moved).sum(axis=1).tolist()
    exact = [sum(int(c) ** 2 for c in row) for row in moved]
    return [value if value <= LARGEST else None for value in exact]


def whiten_distinct(distinct: DataFrame, n: int, total: list[int], values: np.ndarray, vectors: np.ndarray) -> DataFrame:
    """Rows (digest, n, deviation, z) of the distinct vectors, each whitened once; ``z`` has an entry per component."""
    scaled = vectors / np.sqrt(values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, x, _ in _blocks(batches):
            moved = _moved(x, n, total)
            z = (moved / n).astype(np.float64) @ scaled
            yield pa.RecordBatch.from_arrays(
                [batch["digest"], batch["n"], pa.array(_deviation(moved), pa.int64()), pa.array(list(z), pa.list_(pa.float64()))],
                ["digest", "n", "deviation", "z"],
            )

    columns = distinct.select("digest", "n", "x", "weight")
    return columns.mapInArrow(common.releasing(run), "digest string, n long, deviation long, z array<double>")


def identity_error(whitened: DataFrame, n: int, components: int, weight: str = "n") -> float:
    """Largest absolute entry of the covariance of ``z`` less the identity, centred before multiplying."""
    z = [F.get("z", F.lit(i)) for i in range(components)]
    w = F.col(weight) if weight else F.lit(1)
    means = whitened.agg(*[(F.sum(w * c) / n).alias(f"m{i}") for i, c in enumerate(z)]).first()
    centred = [c - F.lit(float(m)) for c, m in zip(z, means)]
    pairs = [(i, j) for i in range(components) for j in range(i + 1)]
    parts = whitened.agg(*[(F.sum(w * centred[i] * centred[j]) / n).alias(f"c{i}_{j}") for i, j in pairs]).first()
    return max(abs(value - (i == j)) for (i, j), value in zip(pairs, parts))


def whiten(
    rows: DataFrame,
    *,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    components: int = COMPONENTS,
    weights: str = "count",
) -> DataFrame:
    """Rows (vec_id, component, n, deviation, whitened, explained, identity_error), ``components`` per usable vector at most.

    Vectors that are null, empty, or hold null or non-finite entries take no part, nor do those whose length is not the
    most frequent one (ties: the longer). The covariance is fitted with each distinct vector counted as often as it
    occurs (``weights="count"``) or once (``"one"``); ``n`` is the number of vectors counted. Components are numbered
    from 1 by falling eigenvalue and have the same sign for all rows. Directions without variance cannot be whitened and
    are left out, so equal vectors alone, or a single one, give no rows; nor does an empty table. ``deviation`` is null
    where it exceeds a long. Repeated rows and rows without id are rows of their own. Vectors of a third of all rows
    are one row in every pass but the join, where they are sent to the rows instead.
    """
    spark = rows.sparkSession
    empty = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    grid = grid_vectors(rows, id_col=id_col, vector_col=vector_col)
    # Equal vectors are counted in each task before they are shuffled.
    counted = staged(grid.groupBy("digest", "x").agg(F.count("*").alias("n")), "whitening-x")
    length = counted.groupBy(F.size("x").alias("length")).agg(F.sum("n").alias("n")).orderBy(F.desc("n"), F.desc("length")).first()
    if length is None:
        return spark.createDataFrame([], empty)
    dimensions = length["length"]
    weight = F.col("n") if weights == "count" else F.lit(1).cast("long")
    distinct = counted.filter(F.size("x") == dimensions).withColumn("weight", weight)
    n, total = sums(distinct, dimensions)
    matrix = covariance(distinct, n, total)
    values, vectors = directions(matrix, components)
    if not len(values):
        return spark.createDataFrame([], empty)
    whitened = staged(whiten_distinct(distinct, n, total, values, vectors), "whitened")
    error = identity_error(whitened, n, len(values), "n" if weights == "count" else "")
    found = common.hot_lookup(grid.select("vec_id", "digest"), whitened, "digest", {"deviation": "deviation", "z": "z"}, "n")
    explained = F.array(*[F.lit(float(e / np.trace(matrix))) for e in values])
    # Vectors of another length have no ``z`` and end here.
    return found.select("vec_id", "deviation", F.posexplode("z").alias("place", "whitened")).select(
        "vec_id",
        (F.col("place") + 1).alias("component"),
        F.lit(n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(explained, F.col("place")).alias("explained"),
        F.lit(error).alias("identity_error"),
    )
