"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyflow.plans.staging import staged


def _large_star(links: DataFrame) -> DataFrame:
    """Each node's larger neighbours are linked with its smallest neighbour, or itself."""
    both = links.select("u", "v").union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("n"), F.least("u", "m").alias("m"))
    return both.filter("v > u").join(least, F.col("u") == F.col("n")).select(F.col("m").alias("u"), "v").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours are linked with the smallest of them; links have u < v."""
    least = links.groupBy("v").agg(F.min("u").alias("m")).select(F.col("v").alias("n"), "m")
    joined = links.join(least, F.col("v") == F.col("n"))
    moved = joined.filter("u > m").select(F.col("m").alias("u"), F.col("u").alias("v"))
    return moved.union(least.select(F.col("m").alias("u"), F.col("n").alias("v"))).distinct()


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def connected(links: DataFrame) -> DataFrame:
    """Rows (node, component): each node of ``links`` (u, v) with the smallest node reachable.

    Alternates two steps that link nodes with the smallest node around them until nothing changes.
    Each step is written to the shared folder; no component is gathered anywhere.
    """
    ordered = links.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).filter("u < v")
    now = staged(ordered.distinct(), "links")
    state = _state(now)
    while True:
        now = staged(_small_star(_large_star(now)), "links")
        before, state = state, _state(now)
        if state == before:
            break
    member = now.select(F.col("v").alias("node"), F.col("u").alias("component"))
    return member.union(now.select(F.col("u").alias("node"), F.col("u").alias("component")).distinct())
