"""How much flies where: distinct aircraft per country, cell and time."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyflow.functions.columns import DAY, HOUR, bucket, epoch_to_ts
from skyflow.functions.geo import is_position
from skyflow.operators.places import PlaceIndex, country_from_airport, country_from_position

GLOBAL = "GLOBAL"
#: Logarithm of the number of buckets of a sketch.
SKETCH_SIZE = 12


def distinct_per_window(
    events: DataFrame,
    groups: list[str],
    entity: list[str],
    count_name: str,
    bucket_name: str,
    *,
    window: str,
    delay: str,
    approx: bool = False,
    with_global: bool = False,
) -> DataFrame:
    """Distinct entities per group and tumbling window of ``timestamp``.

    The exact count first reduces the rows to one per window, group and entity and then
    counts those. Both steps combine inside each task before the shuffle, and the first
    one spreads a busy group over its entities. It runs on streams too, where a plain
    distinct count is refused.

    ``with_global`` adds rows for ``GLOBAL``: distinct over all groups, not the sum, as an
    entity may be in several. A batch widens the reduced rows. A stream widens its input,
    which saves it one stateful step.
    """
    code = groups[0]
    rows = events.select(*dict.fromkeys([*groups, *entity, "timestamp"])).withWatermark("timestamp", delay)

    def widened(df: DataFrame) -> DataFrame:
        return df.withColumn(code, F.explode(F.array(F.col(code), F.lit(GLOBAL))))

    def reduced(df: DataFrame, span) -> DataFrame:
        return df.groupBy(span, *groups, *entity).agg(F.lit(1).alias("_seen"))

    known = reduce(Column.__and__, [F.col(name).isNotNull() for name in entity])
    span = F.window("timestamp", window).alias("w")
    if approx:
        source = widened(rows) if with_global else rows
        key = F.col(entity[0]) if len(entity) == 1 else F.when(known, F.xxhash64(*entity))
        counted = source.groupBy(span, *groups).agg(F.approx_count_distinct(key).alias(count_name))
    else:
        if with_global and rows.isStreaming:
            distinct = reduced(widened(rows), span)
        elif with_global:
            distinct = reduced(widened(reduced(rows, span).drop("_seen")), F.col("w"))
        else:
            distinct = reduced(rows, span)
        counted = distinct.groupBy("w", *groups).agg(F.count_if(known).alias(count_name))
    return counted.select(*groups, F.unix_seconds("w.start").alias(bucket_name), count_name)


def sketches_per_minute(
    events: DataFrame, groups: list[str], entity: list[str], *, delay: str = "10 minutes", size: int = SKETCH_SIZE
) -> DataFrame:
    """A mergeable sketch of the distinct entities per group and minute of ``timestamp``: (groups, minute_bucket, sketch).

    The rows are small whatever happened in the minute, so they are kept when the events are gone, and longer spans or
    other groups are counted from them (``counts_from_sketches``). It runs on streams too, with one stateful step.
    """
    rows = events.select(*dict.fromkeys([*groups, *entity, "timestamp"])).withWatermark("timestamp", delay)
    known = reduce(Column.__and__, [F.col(name).isNotNull() for name in entity])
    key = F.col(entity[0]) if len(entity) == 1 else F.when(known, F.xxhash64(*entity))
    span = F.window("timestamp", "1 minute").alias("w")
    sketched = rows.groupBy(span, *groups).agg(F.hll_sketch_agg(key, F.lit(size)).alias("sketch"))
    return sketched.select(*groups, F.unix_seconds("w.start").alias("minute_bucket"), "sketch")


def counts_from_sketches(
    sketches: DataFrame,
    groups: list[str],
    count_name: str,
    bucket_name: str = "hour_bucket",
    width: int = HOUR,
    *,
    with_global: bool = False,
) -> DataFrame:
    """Approximate distinct entities per group and ``width`` seconds, from sketches per minute.

    ``with_global`` adds rows for ``GLOBAL`` by merging the sketches of all groups, which counts an entity of several groups
    once. The standard error is 1.04 / sqrt(2 ** size), 1.6 % for ``SKETCH_SIZE``; small counts are nearly exact.
    """
    code = groups[0]
    span = bucket(F.col("minute_bucket"), width).alias(bucket_name)
    merged = sketches.groupBy(*groups, span).agg(F.hll_union_agg("sketch").alias("sketch"))
    if with_global:
        others = [F.col(name) for name in groups[1:]]
        whole = merged.groupBy(*others, bucket_name).agg(F.hll_union_agg("sketch").alias("sketch"))
        merged = merged.unionByName(whole.withColumn(code, F.lit(GLOBAL)))
    return merged.select(*groups, bucket_name, F.hll_sketch_estimate("sketch").alias(count_name))


def active_sketches(flights: DataFrame, places: PlaceIndex, **options) -> DataFrame:
    """Sketches of the aircraft per country of their position and minute."""
    narrow = flights.select("icao24", "latitude", "longitude", "timestamp")
    located = country_from_position(narrow, "latitude", "longitude", places)
    return sketches_per_minute(located, ["country_code"], ["icao24"], **options)


def departure_sketches(info: DataFrame, airports: DataFrame, **options) -> DataFrame:
    """Sketches of the leaving aircraft per country of the departure airport and minute."""
    return _airport_sketches(info, airports, "firstSeen", "estDepartureAirport", **options)


def arrival_sketches(info: DataFrame, airports: DataFrame, **options) -> DataFrame:
    """Sketches of the arriving aircraft per country of the arrival airport and minute."""
    return _airport_sketches(info, airports, "lastSeen", "estArrivalAirport", **options)


def _airport_sketches(info: DataFrame, airports: DataFrame, time: str, airport: str, **options) -> DataFrame:
    located = country_from_airport(info.select("icao24", time, airport), airport, airports)
    timed = located.withColumn("timestamp", epoch_to_ts(F.col(time)))
    return sketches_per_minute(timed, ["country_code"], ["icao24"], **options)


def active_by_country(
    flights: DataFrame,
    places: PlaceIndex,
    window: str,
    bucket_name: str,
    *,
    delay: str = "10 minutes",
    approx: bool = False,
    with_global: bool = False,
) -> DataFrame:
    """Distinct aircraft per country of their position and window."""
    narrow = flights.select("icao24", "latitude", "longitude", "timestamp")
    located = country_from_position(narrow, "latitude", "longitude", places)
    return distinct_per_window(
        located,
        ["country_code"],
        ["icao24"],
        "active_aircraft_cnt",
        bucket_name,
        window=window,
        delay=delay,
        approx=approx,
        with_global=with_global,
    )


def active_by_country_hour(flights: DataFrame, places: PlaceIndex, **options) -> DataFrame:
    """Distinct aircraft per country and hour."""
    return active_by_country(flights, places, "1 hour", "hour_bucket", **options)


def active_by_country_minute(flights: DataFrame, places: PlaceIndex, **options) -> DataFrame:
    """Distinct aircraft per country and minute."""
    return active_by_country(flights, places, "1 minute", "minute_bucket", **options)


def _airport_traffic(
    info: DataFrame,
    airports: DataFrame,
    time: str,
    airport: str,
    count_name: str,
    *,
    delay: str = "10 minutes",
    approx: bool = False,
    with_global: bool = False,
    count_flights: bool = False,
) -> DataFrame:
    narrow = info.select(*dict.fromkeys(["icao24", "firstSeen", time, airport]))
    located = country_from_airport(narrow, airport, airports)
    return distinct_per_window(
        located.withColumn("timestamp", epoch_to_ts(F.col(time))),
        ["country_code"],
        ["icao24", "firstSeen"] if count_flights else ["icao24"],
        count_name,
        "hour_bucket",
        window="1 hour",
        delay=delay,
        approx=approx,
        with_global=with_global,
    )


def departures_by_country_hour(info: DataFrame, airports: DataFrame, **options) -> DataFrame:
    """Distinct aircraft leaving per country of the departure airport and hour.

    ``count_flights=True`` counts flights, so an aircraft leaving twice in an hour counts
    twice. On a stream, ``delay`` must cover how long after ``firstSeen`` a flight is
    reported, which can be hours; later rows are dropped.
    """
    return _airport_traffic(info, airports, "firstSeen", "estDepartureAirport", "departures_cnt", **options)


def arrivals_by_country_hour(info: DataFrame, airports: DataFrame, **options) -> DataFrame:
    """Distinct aircraft arriving per country of the arrival airport and hour."""
    return _airport_traffic(info, airports, "lastSeen", "estArrivalAirport", "arrivals_cnt", **options)


def traffic_density_by_cell_minute(flights: DataFrame, cell_deg: float = 1.0, delay: str = "10 seconds") -> DataFrame:
    """Distinct aircraft per geographic cell and minute; rows without a position are left out."""
    cells = flights.filter(is_position(F.col("latitude"), F.col("longitude"))).select(
        F.floor(F.col("latitude") / F.lit(cell_deg)).alias("cell_lat"),
        F.floor(F.col("longitude") / F.lit(cell_deg)).alias("cell_lon"),
        "icao24",
        "timestamp",
    )
    return distinct_per_window(
        cells,
        ["cell_lat", "cell_lon"],
        ["icao24"],
        "aircraft_cnt",
        "minute_bucket",
        window="1 minute",
        delay=delay,
    )


def _flights_by_day(info: DataFrame, time: str, count_name: str) -> DataFrame:
    timed = info.filter(F.col(time).isNotNull())
    return timed.groupBy("icao24", bucket(F.col(time), DAY).alias("day_bucket")).agg(F.count("*").alias(count_name))


def departures_by_icao24_day(info: DataFrame) -> DataFrame:
    """Flights per aircraft and day of departure."""
    return _flights_by_day(info, "firstSeen", "departures_cnt")


def arrivals_by_icao24_day(info: DataFrame) -> DataFrame:
    """Flights per aircraft and day of arrival."""
    return _flights_by_day(info, "lastSeen", "arrivals_cnt")
