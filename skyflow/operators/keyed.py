"""Tables with one row per key: newest wins, numbering, retention."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyflow.plans.ordering import ingest_order, latest_by_key

__all__ = ["assign_time_group", "latest_by_key", "newest_rows", "retain"]


def newest_rows(df: DataFrame, keys: list[str], time: str) -> DataFrame:
    """The newest row per key by event time, then by ingest order where it is known."""
    tie = ingest_order(df)
    return latest_by_key(df, keys, [time] if tie is None else [time, tie])


def assign_time_group(taf: DataFrame, order: list[str | Column]) -> DataFrame:
    """Number the periods of each bulletin 0, 1, 2 ... in ``time_group``.

    A period is identified by its validity and type; copies of a period are first reduced
    to the newest by ``order``, so numbering sees one row per period however often a
    bulletin was sent.
    """
    period = ["station_id", "issue_time", "valid_from", "valid_to", "fcst_type"]
    periods = latest_by_key(taf.drop("time_group"), period, order)
    within = Window.partitionBy("station_id", "issue_time").orderBy("valid_from", "valid_to", "fcst_type")
    return periods.withColumn("time_group", F.row_number().over(within) - 1)


def retain(df: DataFrame, written_at: str, ttl_seconds: int, now: int | Column) -> DataFrame:
    """Rows written less than ``ttl_seconds`` before ``now``; both are epoch seconds."""
    return df.filter(F.col(written_at) > F.lit(now) - F.lit(ttl_seconds))
