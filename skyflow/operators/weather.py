"""Stored weather tables: newest observation, history, hazard warnings, forecast periods.

Filters and column lists per table; duplicates of a key are resolved to the newest message.
On a stream the shaping functions (``*_rows``) are used alone and the keyed sink resolves
duplicates, because hazard and forecast times run ahead of the clock and a watermark on
them would discard current rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyflow.functions.columns import HOUR, bucket, json_text, require_not_null
from skyflow.operators.keyed import newest_rows
from skyflow.sources.parse import METADATA
from skyflow.sources.schemas import TABLE_KEYS

# Columns of the stored tables in their order.
METAR_LATEST = (
    "station_id obs_time lat lon site temp dewp wdir wspd wgst visib ceil cover fltcat wx altim slp clouds raw_ob"
).split()
METAR_HISTORY = "station_id obs_time fltcat temp wspd visib ceil wx raw_ob".split()
SIGMET = (
    "hour_bucket icao_id series_id valid_from valid_to fir_id fir_name hazard qualifier base top dir spd chng "
    "polygon raw_sigmet"
).split()
TAF = (
    "station_id issue_time time_group valid_from valid_to lat lon site fcst_type wdir wspd wgst visib ceil cover "
    "fltcat clouds raw_taf"
).split()


def _shaped(df: DataFrame, columns: list[str]) -> DataFrame:
    kept = [METADATA] if METADATA in df.columns else []
    return df.select(*columns, *kept)


def _newest(df: DataFrame, keys: list[str], time: str, columns: list[str]) -> DataFrame:
    # A key that holds the event time itself leaves only the ingest order to decide.
    return newest_rows(df, keys, time).select(*columns)


def metar_latest_rows(metar: DataFrame) -> DataFrame:
    """Observations with station, time and position, clouds as JSON text."""
    rows = require_not_null(metar, ["lat", "lon", "station_id", "obs_time"])
    return _shaped(rows.withColumn("clouds", json_text(F.col("clouds_array"))), METAR_LATEST)


def metar_latest(metar: DataFrame) -> DataFrame:
    """The newest observation of each station."""
    return _newest(metar_latest_rows(metar), TABLE_KEYS["metar_latest_by_station"], "obs_time", METAR_LATEST)


def metar_history_rows(metar: DataFrame) -> DataFrame:
    """Observations with station and time, timeline columns only."""
    return _shaped(require_not_null(metar, ["station_id", "obs_time"]), METAR_HISTORY)


def metar_history(metar: DataFrame) -> DataFrame:
    """One observation per station and time."""
    return _newest(metar_history_rows(metar), TABLE_KEYS["metar_history_by_station"], "obs_time", METAR_HISTORY)


def sigmet_rows(sigmet: DataFrame, require_polygon: bool = True) -> DataFrame:
    """Warnings with office, start and area; hour bucket and polygon as JSON text."""
    rows = require_not_null(sigmet, ["valid_from", "icao_id"])
    shapes = [F.col(c) for c in ("polygon_coords", "multi_polygon_coords") if c in sigmet.columns]
    drawn = F.coalesce(*[json_text(F.when(F.size(shape) > 0, shape)) for shape in shapes])
    rows = rows.withColumns({"hour_bucket": bucket(F.col("valid_from"), HOUR), "polygon": drawn})
    if require_polygon:
        rows = require_not_null(rows, ["polygon"])
    return _shaped(rows, SIGMET)


def sigmet_by_validtime(sigmet: DataFrame, require_polygon: bool = True) -> DataFrame:
    """One warning per hour bucket, office, series and start."""
    return _newest(sigmet_rows(sigmet, require_polygon), TABLE_KEYS["sigmet_by_validtime"], "valid_from", SIGMET)


def taf_rows(taf: DataFrame) -> DataFrame:
    """Forecast periods with station and issue time, clouds as JSON text."""
    rows = require_not_null(taf, ["station_id", "issue_time"])
    return _shaped(rows.withColumn("clouds", json_text(F.col("clouds_array"))), TAF)


def taf_by_station(taf: DataFrame) -> DataFrame:
    """One row per station, bulletin, period number and period start."""
    return _newest(taf_rows(taf), TABLE_KEYS["taf_by_station"], "issue_time", TAF)
