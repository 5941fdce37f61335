"""Rows in the shape of the six topics, derived from the given tables.

Each projection is one SQL text for Spark and DuckDB; five tokens differ between them.
The session time zone is UTC. ``seq`` is the ingest order.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# How each engine writes the five tokens.
SPARK_TOKENS = {
    "HEX": "hex({0})",
    "EPOCH": "unix_timestamp(CAST({0} AS TIMESTAMP))",
    "DIV": "({0}) div ({1})",
    "STR": "CAST({0} AS STRING)",
    "EACH": "explode(array({0}))",
}
DUCKDB_TOKENS = {
    "HEX": "to_hex({0})",
    "EPOCH": "CAST(floor(epoch({0})) AS BIGINT)",
    "DIV": "({0}) // ({1})",
    "STR": "CAST({0} AS VARCHAR)",
    "EACH": "unnest([{0}])",
}



def _code(number: str) -> str:
    """SQL for three characters in base 36, as airline codes have."""
    digits = "'0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ'"
    parts = [f"substr({digits}, CAST($DIV({number};{power}) % 36 AS INT) + 1, 1)" for power in (1296, 36, 1)]
    return f"concat({', '.join(parts)})"


PROJECTIONS = {
    "flight_states": f"""
SELECT event_id AS seq, lpad(lower($HEX(user_id)), 6, '0') AS icao24,
  CASE WHEN event_id % 11 = 0 THEN NULL ELSE concat({_code('user_id')}, $STR(user_id % 97)) END AS callsign,
  CASE WHEN event_id % 53 = 0 THEN NULL ELSE $EPOCH(ts) END AS time_position,
  $EPOCH(ts) AS last_contact,
  CASE WHEN event_id % 29 = 0 THEN NULL ELSE CAST((event_id * 7919) % 36000 AS DOUBLE) / CAST(100 AS DOUBLE) - CAST(180 AS DOUBLE) END AS longitude,
  CASE WHEN event_id % 29 = 0 THEN NULL ELSE CAST((event_id * 104729) % 18000 AS DOUBLE) / CAST(100 AS DOUBLE) - CAST(90 AS DOUBLE) END AS latitude,
  value * CAST(100 AS DOUBLE) - CAST(300 AS DOUBLE) AS baro_altitude,
  event_type IN ('signup', 'error') AS on_ground,
  CASE WHEN event_id % 31 = 0 THEN CAST(0 AS DOUBLE) ELSE value END AS velocity,
  CAST((event_id * 37) % 360 AS DOUBLE) AS true_track,
  CAST(event_id % 21 - 10 AS DOUBLE) AS vertical_rate,
  value * CAST(100 AS DOUBLE) AS geo_altitude,
  CAST(event_id % 4 AS INT) AS position_source,
  concat('Land ', $STR(user_id % 12)) AS origin_country,
  CASE WHEN event_id % 3 = 0 THEN NULL ELSE CAST(event_id % 9 AS INT) END AS sensor,
  CASE WHEN event_id % 10 = 0 THEN NULL ELSE lpad($STR(event_id % 7777), 4, '0') END AS squawk,
  event_id % 5 = 0 AS spi,
  $EPOCH(ts) + 5 AS fetch_timestamp, $EPOCH(ts) + 6 AS ingestion_timestamp
FROM events
""",
    "flight_info": """
SELECT o_orderkey AS seq, lpad(lower($HEX(o_custkey)), 6, '0') AS icao24,
  $EPOCH(o_orderdate) + 3600 * (o_orderkey % 24) + o_orderkey % 3600 AS firstSeen,
  $EPOCH(o_orderdate) + 3600 * (o_orderkey % 24) + o_orderkey % 3600 + 1800 + (o_orderkey * 61) % 36000 AS lastSeen,
  CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE concat('A', lpad($STR(o_custkey % 27), 3, '0')) END AS estDepartureAirport,
  CASE WHEN o_orderkey % 19 = 0 THEN NULL ELSE concat('A', lpad($STR(o_orderkey % 27), 3, '0')) END AS estArrivalAirport,
  concat('CS', $STR(o_custkey % 97)) AS callsign,
  CAST(o_orderkey % 5000 AS INT) AS estDepartureAirportHorizDistance,
  CAST(o_orderkey % 300 AS INT) AS estDepartureAirportVertDistance,
  CASE WHEN o_orderkey % 19 = 0 THEN NULL ELSE CAST(o_orderkey % 4000 AS INT) END AS estArrivalAirportHorizDistance,
  CAST(o_orderkey % 200 AS INT) AS estArrivalAirportVertDistance,
  CAST(o_orderkey % 7 AS INT) AS departureAirportCandidatesCount,
  CAST(o_orderkey % 5 AS INT) AS arrivalAirportCandidatesCount
FROM orders
""",
    "airports": """
SELECT CAST(n_nationkey AS BIGINT) AS seq, concat('A', lpad($STR(n_nationkey), 3, '0')) AS icao_code, n_name AS airport_name,
  concat('N', substr('ABCDEFGHIJKL', CAST(n_nationkey % 12 AS INT) + 1, 1)) AS country_iso2, concat('Country ', $STR(n_nationkey % 12)) AS country_name,
  concat('C', $STR(n_regionkey)) AS city_iata_code
FROM nation
""",
    "cities": """
SELECT c_custkey AS seq, c_name AS city_name,
  CAST((c_custkey * 6271) % 17000 AS DOUBLE) / CAST(100 AS DOUBLE) - CAST(85 AS DOUBLE) AS latitude,
  CAST((c_custkey * 9973) % 36000 AS DOUBLE) / CAST(100 AS DOUBLE) - CAST(180 AS DOUBLE) AS longitude,
  concat('N', substr('ABCDEFGHIJKL', CAST(n_nationkey % 12 AS INT) + 1, 1)) AS country_iso2, concat('C', $STR(n_regionkey)) AS iata_code
FROM customer JOIN nation ON c_nationkey = n_nationkey
""",
    "airlines": f"""
SELECT s_suppkey AS seq, {_code("s_suppkey")} AS icao_code, s_name AS airline_name,
  concat('Country ', $STR(s_nationkey)) AS country_name, CAST(s_suppkey * 7 % 300 AS INT) AS fleet_size
FROM supplier
""",
    "track_waypoints": """
SELECT l_orderkey AS seq, lpad(lower($HEX(o_custkey)), 6, '0') AS icao24,
  $EPOCH(o_orderdate) + 3600 * (o_orderkey % 24) AS starttime,
  $EPOCH(o_orderdate) + 3600 * (o_orderkey % 24) + 60 * rn AS time,
  CAST(l_partkey % 180 - 90 AS DOUBLE) AS lat, CAST(l_suppkey % 360 - 180 AS DOUBLE) AS lon,
  l_extendedprice AS baro_altitude, CAST(l_partkey % 360 AS DOUBLE) AS true_track,
  (rn = 1 OR rn = n) AS on_ground,
  concat('CS', $STR(o_custkey % 97)) AS callsign,
  $EPOCH(o_orderdate) + 3600 * (o_orderkey % 24) + 60 * n AS endtime
FROM (SELECT *,
        row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_shipdate, l_partkey, l_suppkey, l_extendedprice) AS rn,
        count(*) OVER (PARTITION BY l_orderkey) AS n
      FROM lineitem) l JOIN orders ON l_orderkey = o_orderkey
""",
    "metar": """
SELECT event_id AS seq, concat('K', lpad($STR(user_id % 40), 3, '0')) AS station_id,
  concat('Site ', $STR(user_id % 40)) AS site,
  $DIV($EPOCH(ts);3600) * 3600 AS obs_time,
  CASE WHEN user_id % 40 = 39 THEN NULL ELSE CAST(user_id % 40 AS DOUBLE) END AS lat,
  CASE WHEN user_id % 40 = 39 THEN NULL ELSE CAST(user_id % 40 - 100 AS DOUBLE) END AS lon,
  CAST(event_id % 45 - 10 AS INT) AS temp, CAST(event_id % 60 AS INT) AS wspd,
  CAST(event_id % 90 AS INT) AS ceil, $STR(event_id % 10) AS visib,
  CASE WHEN event_id % 90 < 5 THEN 'LIFR' WHEN event_id % 90 < 10 THEN 'IFR' WHEN event_id % 90 <= 30 THEN 'MVFR' ELSE 'VFR' END AS fltcat,
  CASE WHEN event_id % 4 = 0 THEN NULL ELSE concat('[{"base":', $STR(event_id % 90), ',"cover":"BKN"}]') END AS clouds,
  CASE WHEN event_id % 6 = 0 THEN NULL ELSE CAST(event_id % 30 - 15 AS INT) END AS dewp,
  CAST(event_id % 36 * 10 AS INT) AS wdir, CASE WHEN event_id % 2 = 0 THEN NULL ELSE CAST(event_id % 70 AS INT) END AS wgst,
  CASE WHEN event_id % 5 = 0 THEN NULL ELSE 'OVC' END AS cover, CASE WHEN event_id % 8 < 5 THEN NULL ELSE 'RA BR' END AS wx,
  CAST(1000 + event_id % 40 AS INT) AS altim, CAST(990 + event_id % 50 AS INT) AS slp,
  concat('METAR ', lpad($STR(event_id), 9, '0')) AS raw_ob
FROM events
""",
    "taf": """
SELECT event_id * 4 + g AS seq, concat('K', lpad($STR(user_id % 40), 3, '0')) AS station_id,
  $DIV($EPOCH(ts);21600) * 21600 AS issue_time, CAST(g AS INT) AS time_group,
  $DIV($EPOCH(ts);21600) * 21600 + 7200 * g AS valid_from,
  $DIV($EPOCH(ts);21600) * 21600 + 7200 * (g + 1) AS valid_to,
  CASE WHEN g = 0 THEN 'PREVAIL' WHEN g % 2 = 1 THEN 'FM' ELSE 'TEMPO' END AS fcst_type,
  CAST((event_id + g) % 60 AS INT) AS wspd,
  CASE WHEN (event_id + g) % 90 < 5 THEN 'LIFR' WHEN (event_id + g) % 90 < 10 THEN 'IFR' WHEN (event_id + g) % 90 <= 30 THEN 'MVFR' ELSE 'VFR' END AS fltcat,
  concat('Site ', $STR(user_id % 40)) AS site, CAST((event_id + g) % 36 * 10 AS INT) AS wdir,
  CASE WHEN event_id % 2 = 0 THEN NULL ELSE CAST((event_id + g) % 70 AS INT) END AS wgst,
  $STR(event_id % 10) AS visib, CAST((event_id + g) % 90 AS INT) AS ceil, CASE WHEN g = 0 THEN NULL ELSE 'SCT' END AS cover,
  CASE WHEN event_id % 4 = 0 THEN NULL ELSE concat('[{"base":', $STR(event_id % 90), ',"cover":"BKN"}]') END AS clouds,
  concat('TAF ', lpad($STR(event_id), 9, '0')) AS raw_taf
FROM (SELECT *, $EACH(0, 1, 2, 3) AS g FROM events) p
""",
    "sigmet": """
SELECT event_id AS seq, CASE WHEN event_id % 41 = 0 THEN NULL ELSE concat('Z', lpad($STR(user_id % 12), 3, '0')) END AS icao_id,
  $STR(event_id % 2) AS series_id, $DIV($EPOCH(ts);3600) * 3600 AS valid_from, $DIV($EPOCH(ts);3600) * 3600 + 14400 AS valid_to,
  $DIV($EPOCH(ts);3600) * 3600 AS hour_bucket,
  CASE event_id % 3 WHEN 0 THEN 'TS' WHEN 1 THEN 'ICE' ELSE 'TURB' END AS hazard,
  concat('F', $STR(event_id % 30)) AS fir_id, concat('FIR ', $STR(event_id % 30)) AS fir_name,
  CASE WHEN event_id % 2 = 0 THEN 'SEV' ELSE 'EMBD' END AS qualifier, CASE WHEN event_id % 4 = 0 THEN NULL ELSE 'NE' END AS dir,
  $STR(event_id % 25) AS spd, CASE WHEN event_id % 2 = 0 THEN 'NC' ELSE 'WKN' END AS chng,
  concat('SIGMET ', lpad($STR(event_id), 9, '0')) AS raw_sigmet,
  CAST((event_id * 100) % 20000 AS INT) AS base, CAST((event_id * 100) % 20000 + 10000 AS INT) AS top,
  CASE WHEN event_id % 13 = 0 THEN NULL ELSE concat('[[[', $STR(CAST(event_id % 170 AS DOUBLE)), ',', $STR(CAST(event_id % 80 AS DOUBLE)), '],[',
    $STR(CAST(event_id % 170 + 1 AS DOUBLE)), ',', $STR(CAST(event_id % 80 AS DOUBLE)), '],[',
    $STR(CAST(event_id % 170 AS DOUBLE)), ',', $STR(CAST(event_id % 80 + 1 AS DOUBLE)), '],[',
    $STR(CAST(event_id % 170 AS DOUBLE)), ',', $STR(CAST(event_id % 80 AS DOUBLE)), ']]]') END AS polygon
FROM events
""",
}


def _written(sql: str, tokens: dict[str, str]) -> str:
    """Replace ``$TOKEN(a;b)`` by the text of one engine, innermost last."""
    while (start := sql.rfind("$")) >= 0:
        name = re.match(r"\$([A-Z]+)\(", sql[start:]).group(1)
        opening = start + len(name) + 1
        depth, end = 0, opening
        while True:
            depth += {"(": 1, ")": -1}.get(sql[end], 0)
            if depth == 0:
                break
            end += 1
        arguments = sql[opening + 1 : end].split(";")
        sql = sql[:start] + tokens[name].format(*arguments) + sql[end + 1 :]
    return sql


def oracle(name: str) -> str:
    """The projection as DuckDB text, in parentheses."""
    return f"({_written(PROJECTIONS[name], DUCKDB_TOKENS).strip()})"


def rows(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The projection over the tables below ``sf_dir``."""
    sql = _written(PROJECTIONS[name], SPARK_TOKENS).replace("{", "{{").replace("}", "}}")
    for table in ("events", "orders", "nation", "customer", "supplier", "lineitem"):
        sql = re.sub(rf"\b(FROM|JOIN) {table}\b", rf"\1 {{{table}}}", sql)
    needed = re.findall(r" \{(\w+)\}", sql)
    return spark.sql(sql, **{t: _table(spark, sf_dir, t) for t in needed})


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    table = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    # One small file is one task; making and parsing messages is worth all cores.
    if name in ("events", "orders"):
        table = table.repartition(spark.sparkContext.defaultParallelism)
    # Orders grow with their items; the estimate is of stored columns, which a broadcast multiplies in the driver.
    return table.hint("merge") if name == "orders" else table


def _messages(df: DataFrame, topic: str, key, value) -> DataFrame:
    """Rows as raw messages; ``seq`` becomes offset and message time."""
    return df.select(
        key.cast("string").alias("key"),
        F.to_json(value).alias("value"),
        F.lit(topic).alias("topic"),
        F.lit(0).alias("partition"),
        F.col("seq").alias("offset"),
        F.timestamp_seconds("seq").alias("timestamp"),
    )


def _iso(column: str):
    return F.date_format(F.timestamp_seconds(column), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def _feature(properties: dict, geometry):
    return F.struct(
        F.lit("Feature").alias("type"),
        F.struct(*[c.alias(name) for name, c in properties.items()]).alias("properties"),
        geometry.alias("geometry"),
    )


def _plain(names: str) -> dict:
    return {name: F.col(name) for name in names.split()}


def flight_state_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = rows(spark, sf_dir, "flight_states")
    sensors = F.when(F.col("sensor").isNotNull(), F.array("sensor", F.col("sensor") + 1)).alias("sensors")
    fields = [c for c in df.columns if c not in ("seq", "sensor")]
    return _messages(df, "flights_raw", F.col("icao24"), F.struct(*fields, sensors))


def flight_info_messages(spark: SparkSession, sf_dir: str, pace: int = 1) -> DataFrame:
    """Flights; with a ``pace`` their times are divided by it, so that years become weeks."""
    df = rows(spark, sf_dir, "flight_info")
    df = df.withColumns({name: F.floor(F.col(name) / pace) for name in ("firstSeen", "lastSeen")})
    fields = [c for c in df.columns if c != "seq"]
    return _messages(df, "flight_data", F.concat_ws("-", "icao24", "firstSeen"), F.struct(*fields))


def flight_track_messages(spark: SparkSession, sf_dir: str, pace: int = 1) -> DataFrame:
    """One message per track; a path element is an array of numbers and a flag. The start is divided by ``pace``."""
    earlier = F.col("starttime") - F.floor(F.col("starttime") / pace)
    point = F.array(
        *[F.col(c).cast("string") for c in ("time", "lat", "lon", "baro_altitude", "true_track", "on_ground")]
    )
    tracks = (
        rows(spark, sf_dir, "track_waypoints")
        .withColumns({name: F.col(name) - earlier for name in ("starttime", "time", "endtime")})
        .groupBy("seq", "icao24", F.col("starttime").alias("startTime"), F.col("endtime").alias("endTime"), "callsign")
        .agg(F.array_sort(F.collect_list(F.struct("time", point.alias("p")))).alias("points"))
        .withColumn("path", F.col("points.p"))
    )
    value = F.struct("icao24", "startTime", "endTime", "callsign", "path")
    return _messages(tracks, "flight_track", F.concat_ws("-", "icao24", "startTime"), value)


def _point():
    return F.when(
        F.col("lat").isNotNull(), F.struct(F.lit("Point").alias("type"), F.array("lon", "lat").alias("coordinates"))
    )


def metar_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = rows(spark, sf_dir, "metar")
    properties = {
        "id": F.col("station_id"),
        **_plain("site"),
        "obsTime": _iso("obs_time"),
        **_plain("temp dewp wdir wspd wgst ceil cover fltcat visib wx altim slp"),
        "rawOb": F.col("raw_ob"),
        "clouds": F.from_json("clouds", "ARRAY<STRUCT<base: INT, cover: STRING>>"),
    }
    return _messages(df, "current_airport_weather", F.col("station_id"), _feature(properties, _point()))


def taf_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = rows(spark, sf_dir, "taf")
    properties = {
        "id": F.col("station_id"),
        "issueTime": _iso("issue_time"),
        "validTimeFrom": _iso("valid_from"),
        "validTimeTo": _iso("valid_to"),
        "timeGroup": F.col("time_group"),
        "fcstType": F.col("fcst_type"),
        **_plain("site wdir wspd wgst visib ceil cover fltcat"),
        "clouds": F.from_json("clouds", "ARRAY<STRUCT<base: INT, cover: STRING>>"),
        "rawTAF": F.col("raw_taf"),
    }
    geometry = F.struct(F.lit("Point").alias("type"), F.array(F.lit(-75.5), F.lit(40.25)).alias("coordinates"))
    return _messages(df, "future_airport_weather", F.col("station_id"), _feature(properties, geometry))


def sigmet_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = rows(spark, sf_dir, "sigmet")
    properties = {
        "icaoId": F.col("icao_id"),
        "seriesId": F.col("series_id"),
        "hazard": F.col("hazard"),
        "validTimeFrom": _iso("valid_from"),
        "validTimeTo": _iso("valid_to"),
        **_plain("base top qualifier dir spd chng"),
        "firId": F.col("fir_id"),
        "firName": F.col("fir_name"),
        "rawSigmet": F.col("raw_sigmet"),
    }
    geometry = F.struct(
        F.lit("Polygon").alias("type"),
        F.from_json("polygon", "ARRAY<ARRAY<ARRAY<DOUBLE>>>").alias("coordinates"),
    )
    return _messages(df, "weather_warnings", F.col("icao_id"), _feature(properties, geometry))
