"""Joining a large table with a lookup table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DEFAULT_SPREAD = 32
LOOKUP_BYTES = 32 * 1024 * 1024
# Fixed value: Spark's own threshold where none is set.
SPARK_DEFAULT_BYTES = 10 * 1024 * 1024


def estimated_bytes(df: DataFrame) -> int:
    """Size of ``df`` as the optimizer estimates it before running anything."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def broadcast_limit(df: DataFrame) -> int:
    """Largest stored size, in bytes, of a table that is sent to every executor.

    A threshold that was set for the session holds, a negative one switches broadcasts off. Spark's
    default gives way to ``LOOKUP_BYTES``: lookups are joined with fact tables that cost far more
    to shuffle.
    """
    text = df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold")
    session = df.sparkSession._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(text)
    return LOOKUP_BYTES if session == SPARK_DEFAULT_BYTES else session


def unique_lookup(df: DataFrame, key: Column, columns: list[str], order: str) -> DataFrame:
    """One row per ``key``, the one with the smallest ``order``; columns ``lookup_key`` and ``columns``."""
    return (
        df.filter(key.isNotNull())
        .groupBy(key.alias("lookup_key"))
        .agg(F.min_by(F.struct(*columns), F.col(order)).alias("found"))
        .select("lookup_key", "found.*")
    )


def lookup_join(
    facts: DataFrame,
    key: Column,
    lookup: DataFrame,
    columns: dict[str, str],
    *,
    max_bytes: int | None = None,
    spread: int = DEFAULT_SPREAD,
    also: Column | None = None,
) -> DataFrame:
    """Left join ``facts`` with a table that is unique on ``lookup_key``.

    ``columns`` maps lookup columns to their names in the result. ``also`` is a further condition in
    these names, for a table that is unique on ``lookup_key`` together with it. A lookup within the
    broadcast limit goes to every executor and the facts are not moved. A larger one is
    shuffled: each lookup row is copied ``spread`` times and the facts of one key are split
    over the copies, so a key with a large share of the facts, or the null key, does not
    end up in one task. A streaming fact side works with both.
    """
    limit = broadcast_limit(lookup) if max_bytes is None else max_bytes
    renamed = lookup.select(
        F.col("lookup_key").alias("_lookup_key"),
        *[F.col(source).alias(name) for source, name in columns.items()],
    )
    same = F.col("_key") == F.col("_lookup_key")
    if also is not None:
        same = same & also
    if estimated_bytes(renamed) <= limit:
        keyed = facts.withColumn("_key", key)
        joined = keyed.join(F.broadcast(renamed), same, "left")
    else:
        # The split depends on the row alone, so a task that runs again places it the same.
        part = F.pmod(F.xxhash64(*[F.col(f"`{name}`") for name in facts.columns]), F.lit(spread))
        keyed = facts.withColumns({"_key": key, "_part": part})
        copies = renamed.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(spread - 1))))
        joined = keyed.join(copies, same & (F.col("_part") == F.col("_copy")), "left")
    return joined.select(*[F.col(f"`{name}`") for name in facts.columns], *columns.values())
