"""Which row is the newest: orders that resolve ties, and aggregates over them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyflow.sources.parse import METADATA


def ingest_order(df: DataFrame) -> Column | None:
    """Column that tells which of two rows with equal times came later.

    The message offset when the rows carry metadata: messages of one key share a
    partition, so offsets order them. None for rows without metadata.
    """
    return F.col(f"{METADATA}.offset") if METADATA in df.columns else None


def order_within_window(seconds: Column, width: int, tie: Column) -> Column:
    """Second and tie-break of a row as one number that sorts like the pair.

    Valid between rows of one epoch-aligned window of ``width`` seconds. With a plain
    number as the order, Spark can aggregate in a hash table; an order of two columns
    forces it to sort all rows first. The second within the window takes the upper bits
    and the tie-break the rest; a tie-break that does not fit fails the job.
    """
    bits = 62 - (width - 1).bit_length()
    ceiling = 1 << bits
    fits = F.when(
        (tie >= 0) & (tie < ceiling) | tie.isNull(),
        F.coalesce(tie, F.lit(0)).cast("long"),
    ).otherwise(F.raise_error(F.concat(F.lit("tie-break out of range: "), tie.cast("string"))).cast("long"))
    return F.pmod(seconds, F.lit(width).cast("long")) * F.lit(ceiling) + fits


def latest_known(value: Column, order: Column) -> Column:
    """Aggregate: the non-null ``value`` with the greatest ``order``."""
    return F.max_by(value, F.when(value.isNotNull(), order))


def latest_by_key(df: DataFrame, keys: list[str], order: list[str | Column]) -> DataFrame:
    """The newest row of each key, by ``order`` ascending, nulls first.

    An aggregate rather than a numbered window: every task first reduces its own rows to
    one per key, so a key that holds a large share of the table costs no more than any
    other. Ends in one row per key whatever the optimizer does.
    """
    columns = df.columns
    rank = F.struct(*[F.col(c) if isinstance(c, str) else c for c in order])
    others = [c for c in columns if c not in keys]
    newest = df.groupBy(*keys).agg(F.max_by(F.struct(*others), rank).alias("_newest"))
    return newest.select(*[F.col(c) if c in keys else F.col(f"_newest.{c}") for c in columns])


def first_per_key(df: DataFrame, keys: list[str], order: list[Column], n: int = 1, spread: int = 64) -> DataFrame:
    """The first ``n`` rows of each key in the given order.

    For small ``n`` Spark cuts every task's rows to ``n`` per key before the shuffle. Above
    its threshold it does not, so the rows of a key are first split into ``spread`` parts
    that each keep ``n``; the last ranking then sees at most ``spread * n`` rows of a key.
    """

    def ranked(rows: DataFrame, by: list[str]) -> DataFrame:
        number = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
        return rows.withColumn("_number", number).filter(F.col("_number") <= n).drop("_number")

    threshold = int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold"))
    if n <= threshold:
        return ranked(df, keys)
    part = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.lit(spread))
    return ranked(ranked(df.withColumn("_part", part), [*keys, "_part"]), keys).drop("_part")
