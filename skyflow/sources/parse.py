"""JSON messages to typed rows.

Each parser takes a DataFrame with a text ``value`` column, batch or stream. When the
input carries message metadata (see ``messages.with_message_metadata``) it is passed on,
because its offset is the ingest order that breaks ties later.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from skyflow.functions.columns import (
    clean_text,
    epoch_to_ts,
    iso_to_epoch,
    iso_to_ts,
    path_to_structs,
    point_lat_lon,
    rounded_int,
)
from skyflow.sources import schemas

METADATA = "_metadata"


def _passed_on(raw: DataFrame) -> list[str]:
    return [METADATA] if METADATA in raw.columns else []


def _decoded(raw: DataFrame, schema: str) -> DataFrame:
    """The fields of each message as columns, nulls for a message that is not JSON.

    A generated row instead of a projected struct: the optimizer copies projections into
    every filter it pushes down, and would decode a message once per filtered column. It
    never pushes a filter on generated columns below the generator, so decoding happens
    once.
    """
    message = F.array(F.from_json("value", schema))
    return raw.select(F.inline(message), *_passed_on(raw))


def parse_flight_states(raw: DataFrame) -> DataFrame:
    """Aircraft states: 19 typed fields and the event time ``timestamp``."""
    return _decoded(raw, schemas.FLIGHT_STATE).withColumn("timestamp", epoch_to_ts(F.col("time_position")))


def parse_flight_info(raw: DataFrame) -> DataFrame:
    """Flights with estimated departure and arrival airports."""
    return _decoded(raw, schemas.FLIGHT_INFO)


def parse_flight_tracks(raw: DataFrame) -> DataFrame:
    """Trajectories with ``path`` as an array of typed waypoints."""
    return _decoded(raw, schemas.FLIGHT_TRACK).withColumn("path", path_to_structs(F.col("path")))


def _property(name: str, alias: str) -> Column:
    return F.col(f"properties.{name}").alias(alias)


def _number(name: str, alias: str | None = None) -> Column:
    return rounded_int(F.col(f"properties.{name}")).alias(alias or name)


def _clouds() -> Column:
    layers = F.col("properties.clouds")
    return F.transform(
        layers,
        lambda layer: F.struct(rounded_int(layer["base"]).alias("base"), layer["cover"].alias("cover")),
    ).alias("clouds_array")


def _position() -> list[Column]:
    lat, lon = point_lat_lon(F.col("geometry.coordinates"))
    return [lat.alias("lat"), lon.alias("lon")]


def parse_metar(raw: DataFrame) -> DataFrame:
    """Airport observations, one flat row per GeoJSON feature."""
    observed = F.col("properties.obsTime")
    return _decoded(raw, schemas.METAR).select(
        _property("id", "station_id"),
        _property("site", "site"),
        *[_number(name) for name in ("temp", "dewp", "wdir", "wspd", "wgst", "ceil")],
        _property("cover", "cover"),
        _property("fltcat", "fltcat"),
        _property("visib", "visib"),
        _property("wx", "wx"),
        _number("altim"),
        _number("slp"),
        _property("rawOb", "raw_ob"),
        _clouds(),
        iso_to_epoch(observed).alias("obs_time"),
        iso_to_ts(observed).alias("timestamp"),
        *_position(),
        *_passed_on(raw),
    )


def parse_taf(raw: DataFrame) -> DataFrame:
    """Forecast periods, one flat row per GeoJSON feature."""
    issued = F.col("properties.issueTime")
    return _decoded(raw, schemas.TAF).select(
        _property("id", "station_id"),
        _property("site", "site"),
        _number("timeGroup", "time_group"),
        _property("fcstType", "fcst_type"),
        *[_number(name) for name in ("wdir", "wspd", "wgst")],
        _property("visib", "visib"),
        _number("ceil"),
        _clouds(),
        _property("fltcat", "fltcat"),
        _property("rawTAF", "raw_taf"),
        _property("cover", "cover"),
        iso_to_epoch(issued).alias("issue_time"),
        iso_to_epoch(F.col("properties.validTimeFrom")).alias("valid_from"),
        iso_to_epoch(F.col("properties.validTimeTo")).alias("valid_to"),
        iso_to_ts(issued).alias("timestamp"),
        *_position(),
        *_passed_on(raw),
    )


def parse_sigmet(raw: DataFrame) -> DataFrame:
    """Hazard warnings, one flat row per GeoJSON feature.

    A polygon is in ``polygon_coords``; a multi-polygon has one more array level and is in
    ``multi_polygon_coords``.
    """
    shape, text = F.col("geometry.type"), F.col("geometry.coordinates")
    many = F.coalesce(shape == "MultiPolygon", F.lit(False))
    starts = F.col("properties.validTimeFrom")
    return _decoded(raw, schemas.SIGMET).select(
        _property("icaoId", "icao_id"),
        _property("firId", "fir_id"),
        _property("firName", "fir_name"),
        _property("seriesId", "series_id"),
        _property("hazard", "hazard"),
        _property("qualifier", "qualifier"),
        _number("base"),
        _number("top"),
        _property("dir", "dir"),
        _property("spd", "spd"),
        _property("chng", "chng"),
        _property("rawSigmet", "raw_sigmet"),
        F.from_json(F.when(~many, text), schemas.POLYGON).alias("polygon_coords"),
        F.from_json(F.when(many, text), schemas.MULTI_POLYGON).alias("multi_polygon_coords"),
        iso_to_epoch(starts).alias("valid_from"),
        iso_to_epoch(F.col("properties.validTimeTo")).alias("valid_to"),
        iso_to_ts(starts).alias("timestamp"),
        *_passed_on(raw),
    )


def states_from_snapshot(df: DataFrame, ingested_at: Column | None = None) -> DataFrame:
    """API snapshot ``{time, states: [[17 values], ...]}`` to one record per aircraft.

    States with fewer than 17 values or without coordinates are dropped, an empty callsign
    becomes null. ``ingested_at`` (epoch seconds) defaults to the clock.
    """
    now = F.unix_timestamp(F.current_timestamp()) if ingested_at is None else ingested_at
    snapshot = F.from_json("value", "time BIGINT, states ARRAY<ARRAY<STRING>>")
    states = (
        df.select(snapshot.alias("s"))
        .select(F.coalesce("s.time", now).alias("fetch_timestamp"), F.explode("s.states").alias("v"))
        .filter(F.size("v") >= 17)
    )

    fields = []
    for index, field in enumerate(StructType.fromDDL(schemas.STATE_VECTOR).fields):
        text, kind = F.get("v", F.lit(index)), field.dataType.simpleString()
        if field.name == "callsign":
            value = F.nullif(clean_text(text), F.lit(""))
        elif kind == "array<int>":
            value = F.from_json(text, kind)
        elif kind in ("bigint", "int"):
            value = text.try_cast("double").try_cast(kind)
        else:
            value = text.try_cast(kind)
        fields.append(value.alias(field.name))
    rows = states.select(*fields, "fetch_timestamp", now.cast("long").alias("ingestion_timestamp"))
    return rows.filter(F.col("longitude").isNotNull() & F.col("latitude").isNotNull())


def split_features(df: DataFrame) -> DataFrame:
    """GeoJSON FeatureCollection text to one ``value`` text per feature, passed through unchanged."""
    features = F.from_json("value", "features ARRAY<STRING>")
    others = [name for name in df.columns if name != "value"]
    return df.select(*others, F.explode(features["features"]).alias("value"))


def flatten_pages(df: DataFrame) -> DataFrame:
    """API pages with a ``data`` array of structs to one row per item."""
    return df.select(F.explode("data").alias("item")).select("item.*")
