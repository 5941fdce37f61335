"""Scalar building blocks used by parsers and table transforms.

Everything here maps columns to columns with built-in functions, so it stays inside
whole-stage code generation and never raises on dirty input under ANSI mode.
"""

from __future__ import annotations

import sys

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The time range Spark can print and compute windows on (years 1 to 9999).
MIN_EPOCH = -62135596800
MAX_EPOCH = 253402300799

MINUTE = 60
HOUR = 3600
DAY = 86400

# Every character that counts as white space in Unicode, as text for ``btrim``.
WHITE_SPACE = "".join(filter(str.isspace, map(chr, range(sys.maxunicode + 1))))


def epoch_to_ts(seconds: Column) -> Column:
    """Epoch seconds to timestamp; null outside years 1 to 9999.

    The conversion never goes through local time text, so it holds across daylight
    saving changes in any session time zone.
    """
    return F.when(seconds.between(MIN_EPOCH, MAX_EPOCH), F.timestamp_seconds(seconds))


def iso_to_ts(text: Column) -> Column:
    """ISO-8601 text to timestamp; null when the text is not a time."""
    return F.try_to_timestamp(text)


def iso_to_epoch(text: Column) -> Column:
    """ISO-8601 text to epoch seconds; null when the text is not a time."""
    return F.unix_seconds(iso_to_ts(text))


def bucket(seconds: Column, width: int) -> Column:
    """Start of the ``width``-second bucket that holds an epoch value (floor, also below 0)."""
    return seconds - F.pmod(seconds, F.lit(width).cast("long"))


def point_lat_lon(coordinates: Column) -> tuple[Column, Column]:
    """Latitude and longitude of GeoJSON point coordinates, which are ordered lon, lat."""
    return F.get(coordinates, F.lit(1)), F.get(coordinates, F.lit(0))


def json_text(value: Column) -> Column:
    """A nested column as JSON text."""
    return F.to_json(value)


def rounded_int(value: Column) -> Column:
    """A JSON number to int, half up, so that 12.5 is 13 and not lost."""
    return F.round(value).try_cast("int")


def clean_text(text: Column) -> Column:
    """Text without white space at either end."""
    return F.btrim(text, F.lit(WHITE_SPACE))


def trim_strings(df: DataFrame) -> DataFrame:
    """Strip every string column; other columns are left alone."""
    return df.select(
        *[
            clean_text(F.col(f"`{name}`")).alias(name) if kind == "string" else F.col(f"`{name}`")
            for name, kind in df.dtypes
        ]
    )


def path_to_structs(path: Column) -> Column:
    """Track path, an array of six-element text arrays, to an array of typed structs.

    Short or unreadable elements give nulls. Whole numbers go through double because a
    producer may write a second as ``1700000000.0``; doubles are exact far beyond 2**32.
    """
    # Element order of a waypoint and the type of each element.
    layout = [
        ("time", "long"),
        ("latitude", "double"),
        ("longitude", "double"),
        ("baro_altitude", "double"),
        ("true_track", "double"),
        ("on_ground", "boolean"),
    ]

    def element(point: Column, index: int, kind: str) -> Column:
        text = F.get(point, F.lit(index))
        return text.try_cast("double").try_cast("long") if kind == "long" else text.try_cast(kind)

    return F.transform(
        path,
        lambda point: F.struct(
            *[element(point, i, kind).alias(name) for i, (name, kind) in enumerate(layout)]
        ),
    )


def require_not_null(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows in which none of ``columns`` is null."""
    for name in columns:
        df = df.filter(F.col(name).isNotNull())
    return df


def with_speed_kmh(df: DataFrame) -> DataFrame:
    """``speed_kmh`` from ``velocity`` in m/s; null when velocity is null or zero."""
    velocity = F.col("velocity")
    return df.withColumn("speed_kmh", F.when(velocity != 0, velocity * F.lit(3.6)))


def with_altitude_category(df: DataFrame) -> DataFrame:
    """``altitude_category``: low under 3000 m, medium under 10000 m, else high; null stays null."""
    altitude = F.col("baro_altitude")
    return df.withColumn(
        "altitude_category",
        F.when(altitude < 3000, "low").when(altitude < 10000, "medium").when(altitude.isNotNull(), "high"),
    )


def with_processing_columns(df: DataFrame, topic: Column | str) -> DataFrame:
    """``_source_topic`` and ``processing_timestamp`` (epoch seconds)."""
    source = F.lit(topic) if isinstance(topic, str) else topic
    return df.withColumns(
        {
            "_source_topic": source,
            "processing_timestamp": F.unix_timestamp(F.current_timestamp()),
        }
    )


def with_date_partitions(df: DataFrame, timestamp: Column | str) -> DataFrame:
    """``year``, ``month`` and ``day`` of a timestamp in the session time zone."""
    ts = F.col(timestamp) if isinstance(timestamp, str) else timestamp
    return df.withColumns({"year": F.year(ts), "month": F.month(ts), "day": F.dayofmonth(ts)})


def interval_seconds(interval: str) -> int:
    """Length of an interval such as ``1 minute`` or ``10 seconds``."""
    count, unit = interval.split()
    units = {"second": 1, "minute": MINUTE, "hour": HOUR, "day": DAY}
    return int(count) * units[unit.rstrip("s").lower()]
