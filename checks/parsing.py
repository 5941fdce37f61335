"""Queries for sources and parsers (S), and scalar functions (P)."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from checks import fixtures, inputs
from checks.fixtures import oracle
from checks.registry import query
from skyflow.functions import columns as c
from skyflow.operators import places, positions
from skyflow.plans.staging import new_folder, staged
from skyflow.sources import messages, parse, schemas
from skyflow.sources.archive import read_archive
from skyflow.sources.reference import read_reference
from skyflow.streaming.sinks import write_archive

STATES, INFO, WAYPOINTS = oracle("flight_states"), oracle("flight_info"), oracle("track_waypoints")
METAR, TAF, SIGMET = oracle("metar"), oracle("taf"), oracle("sigmet")
AIRPORTS, AIRLINES, CITIES = oracle("airports"), oracle("airlines"), oracle("cities")


def offset():
    """Message offset, which is ``seq`` of the row a message was made from."""
    return F.col("_metadata.offset").alias("seq")


STATE_FIELDS = (
    "icao24, callsign, time_position, last_contact, longitude, latitude, baro_altitude, on_ground, velocity, "
    "true_track, vertical_rate, geo_altitude, position_source, origin_country, squawk, spi, fetch_timestamp, "
    "ingestion_timestamp"
)


@query(
    "s1_parse_flight_states",
    f"""SELECT seq, {STATE_FIELDS}, time_position AS event_time,
        CASE WHEN sensor IS NOT NULL THEN concat('[', sensor, ',', sensor + 1, ']') END AS sensors FROM {STATES}""",
)
def s1(spark, sf_dir):
    rows = inputs.states(spark, sf_dir)
    sensors = F.to_json("sensors").alias("sensors")
    return rows.select(offset(), *STATE_FIELDS.split(", "), sensors, F.unix_seconds("timestamp").alias("event_time"))


@query(
    "s2_parse_flight_tracks",
    f"""SELECT seq, icao24, starttime AS "startTime", endtime AS "endTime", callsign, count(*) AS points,
        min(time) AS first_time, max(time) AS last_time, arg_min(lat, time) AS first_lat, arg_max(lon, time) AS last_lon,
        arg_max(baro_altitude, time) AS last_altitude, arg_max(true_track, time) AS last_track,
        arg_max(on_ground, time) AS last_on_ground
        FROM {WAYPOINTS} GROUP BY ALL""",
)
def s2(spark, sf_dir):
    first, last = F.get("path", F.lit(0)), F.get("path", F.size("path") - 1)
    return inputs.tracks(spark, sf_dir).select(
        offset(),
        "icao24",
        "startTime",
        "endTime",
        "callsign",
        F.size("path").cast("long").alias("points"),
        first["time"].alias("first_time"),
        last["time"].alias("last_time"),
        first["latitude"].alias("first_lat"),
        last["longitude"].alias("last_lon"),
        last["baro_altitude"].alias("last_altitude"),
        last["true_track"].alias("last_track"),
        last["on_ground"].alias("last_on_ground"),
    )


INFO_FIELDS = (
    "icao24 firstSeen lastSeen estDepartureAirport estArrivalAirport callsign estDepartureAirportHorizDistance "
    "estDepartureAirportVertDistance estArrivalAirportHorizDistance estArrivalAirportVertDistance "
    "departureAirportCandidatesCount arrivalAirportCandidatesCount"
).split()


@query("s3_parse_flight_info", f"""SELECT seq, {", ".join(f'{name} AS "{name}"' for name in INFO_FIELDS)} FROM {INFO}""")
def s3(spark, sf_dir):
    return inputs.info(spark, sf_dir).select(offset(), *INFO_FIELDS)


@query(
    "s4_parse_metar",
    f"""SELECT seq, station_id, site, obs_time, lat, lon, temp, dewp, wdir, wspd, wgst, ceil, cover, visib, wx, altim, slp,
        fltcat, clouds, raw_ob, obs_time AS event_time FROM {METAR}""",
)
def s4(spark, sf_dir):
    fields = "station_id site obs_time lat lon temp dewp wdir wspd wgst ceil cover visib wx altim slp fltcat raw_ob".split()
    clouds = c.json_text(F.col("clouds_array")).alias("clouds")
    return inputs.metar(spark, sf_dir).select(offset(), *fields, clouds, F.unix_seconds("timestamp").alias("event_time"))


@query(
    "s5_parse_taf",
    f"""SELECT seq, station_id, issue_time, time_group, valid_from, valid_to, fcst_type, site, wdir, wspd, wgst, visib, ceil,
        cover, fltcat, raw_taf, clouds, 40.25::DOUBLE AS lat, (-75.5)::DOUBLE AS lon FROM {TAF}""",
)
def s5(spark, sf_dir):
    fields = (
        "station_id issue_time time_group valid_from valid_to fcst_type site wdir wspd wgst visib ceil cover fltcat raw_taf lat lon"
    ).split()
    return inputs.taf(spark, sf_dir).select(offset(), *fields, c.json_text(F.col("clouds_array")).alias("clouds"))


@query(
    "s6_parse_sigmet",
    f"""SELECT seq, icao_id, series_id, valid_from, valid_to, hazard, base, top, polygon, fir_id, fir_name, qualifier, dir, spd,
        chng, raw_sigmet FROM {SIGMET}""",
)
def s6(spark, sf_dir):
    fields = "icao_id series_id valid_from valid_to hazard base top fir_id fir_name qualifier dir spd chng raw_sigmet".split()
    polygon = c.json_text(F.col("polygon_coords")).alias("polygon")
    return inputs.sigmet(spark, sf_dir).select(offset(), *fields, polygon)


@query(
    "s8_with_message_metadata",
    f"""SELECT 'flights_raw' AS topic, CAST(0 AS INTEGER) AS "partition", seq AS "offset", icao24 AS key,
        seq * 1000 AS timestamp FROM {STATES}""",
)
def s8(spark, sf_dir):
    return messages.with_message_metadata(fixtures.flight_state_messages(spark, sf_dir)).select("_metadata.*")


@query(
    "s9_route_by_topic",
    f"""SELECT 'weather_warnings' AS _source_topic, seq AS "offset", icao_id AS key FROM {SIGMET}
        UNION ALL SELECT 'flight_data', seq, concat(icao24, '-', firstSeen) FROM {INFO}""",
)
def s9(spark, sf_dir):
    mixed = fixtures.flight_state_messages(spark, sf_dir)
    for more in (fixtures.flight_info_messages, fixtures.sigmet_messages):
        mixed = mixed.unionByName(more(spark, sf_dir))
    routed = [messages.route_by_topic(mixed, topic) for topic in ("weather_warnings", "flight_data")]
    return routed[0].unionByName(routed[1]).select("_source_topic", "offset", "key")


def _cut(spark, sf_dir):
    good = fixtures.flight_state_messages(spark, sf_dir)
    cut = F.when(F.col("offset") % 101 == 0, F.substring("value", 1, 10)).otherwise(F.col("value"))
    return good.withColumn("value", cut)


@query(
    "s10_split_malformed",
    f"""SELECT seq AS "offset", icao24 AS key, seq % 101 = 0 AS malformed FROM {STATES}""",
)
def s10(spark, sf_dir):
    valid, malformed = messages.split_malformed(_cut(spark, sf_dir))
    sides = [side.select("offset", "key", F.lit(bad).alias("malformed")) for side, bad in ((valid, False), (malformed, True))]
    return sides[0].unionByName(sides[1])


@query(
    "s10_decoding_counts",
    f"""SELECT count(*) AS consumed, count(*) FILTER (seq % 101 <> 0) AS processed,
        count(*) FILTER (seq % 101 = 0) AS failed FROM {STATES}""",
)
def s10_counts(spark, sf_dir):
    return messages.decoding_counts(_cut(spark, sf_dir))


@query(
    "s10_split_malformed_types",
    f"""SELECT seq AS "offset", icao24 AS key, seq % 101 = 0 OR seq % 7 = 0 AS malformed FROM {STATES}""",
)
def s10_types(spark, sf_dir):
    """Cut messages, and messages with text where a number belongs."""
    text = F.regexp_replace("value", '"last_contact":([0-9]+)', '"last_contact":"at $1"')
    raw = _cut(spark, sf_dir)
    raw = raw.withColumn("value", F.when(F.col("offset") % 7 == 0, text).otherwise(F.col("value")))
    valid, malformed = messages.split_malformed(raw, schemas.FLIGHT_STATE)
    sides = [side.select("offset", "key", F.lit(bad).alias("malformed")) for side, bad in ((valid, False), (malformed, True))]
    return sides[0].unionByName(sides[1])


SNAPSHOT_FIELDS = (
    "icao24 callsign origin_country time_position last_contact longitude latitude baro_altitude on_ground velocity "
    "true_track vertical_rate sensors geo_altitude squawk spi position_source"
).split()


@query(
    "s11_states_from_snapshot",
    f"""SELECT icao24, nullif(trim(callsign), '') AS callsign, time_position, last_contact, longitude, latitude,
        baro_altitude, on_ground, velocity, true_track, vertical_rate, geo_altitude, position_source, origin_country, squawk, spi,
        max(last_contact) OVER (PARTITION BY seq // 50) AS fetch_timestamp,
        CAST(1800000000 AS BIGINT) AS ingestion_timestamp FROM {STATES}
        QUALIFY longitude IS NOT NULL AND latitude IS NOT NULL AND seq % 43 <> 0""",
)
def s11(spark, sf_dir):
    rows = fixtures.rows(spark, sf_dir, "flight_states")
    rows = rows.withColumn("callsign", F.coalesce(F.concat("callsign", F.lit("  ")), F.lit("")))
    known = [F.col(f).cast("string") if f in rows.columns else F.lit(None).cast("string") for f in SNAPSHOT_FIELDS]
    state = F.when(F.col("seq") % 43 == 0, F.array(*known[:-1])).otherwise(F.array(*known))
    snapshots = rows.groupBy(F.floor(F.col("seq") / 50).alias("n")).agg(
        F.max("last_contact").alias("time"), F.collect_list(state).alias("states")
    )
    value = F.to_json(F.struct("time", "states"), {"ignoreNullFields": "false"}).alias("value")
    states = parse.states_from_snapshot(snapshots.select(value), F.lit(1800000000))
    return states.drop("sensors")


@query(
    "s12_split_features",
    f"SELECT station_id, obs_time, raw_ob FROM {METAR}",
)
def s12(spark, sf_dir):
    single = fixtures.metar_messages(spark, sf_dir)
    collections = single.groupBy(F.floor(F.col("offset") / 40).alias("n")).agg(
        F.concat(F.lit('{"type":"FeatureCollection","features":['), F.concat_ws(",", F.collect_list("value")), F.lit("]}")).alias("value")
    )
    return parse.parse_metar(parse.split_features(collections)).select("station_id", "obs_time", "raw_ob")


@query(
    "s13_read_reference",
    f"""SELECT seq AS id, icao_code, country_iso2, city_iata_code, trim(airport_name) AS airport_name,
        CAST(seq AS DOUBLE) + 0.5 AS latitude FROM {AIRPORTS}""",
)
def s13(spark, sf_dir):
    rows = inputs.airports(spark, sf_dir).withColumn("latitude", F.col("id") + 0.5)
    text = rows.select(*[F.concat(F.lit(" "), F.col(name).cast("string")).alias(name) for name in rows.columns])
    path = new_folder(spark, "airports")
    text.write.json(path)
    fields = ["id", "icao_code", "country_iso2", "city_iata_code", "airport_name", "latitude"]
    return read_reference(spark, path, "airports").select(*fields)


@query(
    "s13_read_reference_array",
    f"""SELECT seq AS id, icao_code, country_iso2, city_iata_code, concat(trim(airport_name), ' {{"}}]') AS airport_name,
        CAST(seq AS DOUBLE) + 0.5 AS latitude FROM {AIRPORTS}""",
)
def s13_array(spark, sf_dir):
    """The same table from files that hold one array of 20,000 elements each, read in pieces of 64 KB."""
    rows = inputs.airports(spark, sf_dir).withColumns(
        {"latitude": F.col("id") + 0.5, "airport_name": F.concat(F.col("airport_name"), F.lit(' {"}]'))}
    )
    element = F.to_json(F.struct(*[F.col(name).cast("string").alias(name) for name in rows.columns]))
    path, size = new_folder(spark, "airports"), "spark.sql.files.maxPartitionBytes"
    arrays = rows.groupBy(F.floor(F.col("id") / 20_000)).agg(F.concat(F.lit("["), F.concat_ws(", ", F.collect_list(element)), F.lit("]")).alias("value"))
    arrays.select("value").write.text(path)
    fields = ["id", "icao_code", "country_iso2", "city_iata_code", "airport_name", "latitude"]
    before = spark.conf.get(size)
    spark.conf.set(size, 64 * 1024)
    try:
        return staged(read_reference(spark, path, "airports", multi_line=True).select(*fields), "elements")
    finally:
        spark.conf.set(size, before)


@query("s14_flatten_pages", f"SELECT seq, icao_code, airline_name, country_name, fleet_size FROM {AIRLINES}")
def s14(spark, sf_dir):
    items = fixtures.rows(spark, sf_dir, "airlines")
    pages = items.groupBy(F.floor(F.col("seq") / 5).alias("offset")).agg(F.collect_list(F.struct("*")).alias("data"))
    return parse.flatten_pages(pages)


@query("s15_trim_strings", "SELECT c_custkey, c_name, c_mktsegment FROM customer")
def s15(spark, sf_dir):
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet")
    padded = customer.select(
        "c_custkey",
        F.concat(F.lit("\t "), "c_name", F.lit("\n")).alias("c_name"),
        F.concat("c_mktsegment", F.lit("  ")).alias("c_mktsegment"),
    )
    return c.trim_strings(padded)


@query(
    "s16_read_archive",
    f"""SELECT icao24, time_position, last_contact FROM {STATES}
        WHERE time_position >= epoch(DATE '2024-01-05') AND time_position < epoch(DATE '2024-01-12')""",
)
def s16(spark, sf_dir):
    path = new_folder(spark, "archive")
    write_archive(inputs.states(spark, sf_dir).drop("_metadata"), 0, path, "timestamp")
    week = read_archive(spark, path, datetime.date(2024, 1, 5), datetime.date(2024, 1, 11))
    return week.select("icao24", "time_position", "last_contact")


@query("p1_aircraft_position", f"SELECT icao24, callsign, latitude AS lat, longitude AS lon FROM {STATES}")
def p1(spark, sf_dir):
    return positions.aircraft_position(inputs.states(spark, sf_dir))


WAYPOINT_FIELDS = "icao24, starttime, time, lat, lon, baro_altitude, true_track, on_ground, callsign, endtime"


@query("p2_track_waypoints", f"SELECT {WAYPOINT_FIELDS} FROM {WAYPOINTS}")
def p2(spark, sf_dir):
    return positions.track_waypoints(inputs.tracks(spark, sf_dir)).drop("_metadata")


@query(
    "p3_path_to_structs",
    f"""SELECT seq, time, lat AS latitude, lon AS longitude, baro_altitude, true_track, on_ground FROM {WAYPOINTS}""",
)
def p3(spark, sf_dir):
    rows = fixtures.rows(spark, sf_dir, "track_waypoints")
    point = F.array(*[F.col(n).cast("string") for n in "time lat lon baro_altitude true_track on_ground".split()])
    path = c.path_to_structs(F.array(point))
    return rows.select("seq", F.explode(path).alias("point")).select("seq", "point.*")


@query(
    "p4_times",
    f"""SELECT seq, time_position AS epoch, strftime(to_timestamp(time_position) AT TIME ZONE 'UTC', '%Y-%m-%d %H:%M:%S') AS text,
        time_position AS parsed FROM {STATES}""",
)
def p4(spark, sf_dir):
    rows = fixtures.rows(spark, sf_dir, "flight_states").withColumn("ts", c.epoch_to_ts(F.col("time_position")))
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    return rows.select(
        "seq",
        F.unix_seconds("ts").alias("epoch"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("text"),
        c.iso_to_epoch(iso).alias("parsed"),
    )


@query(
    "p5_bucket",
    f"""SELECT seq, last_contact // 60 * 60 AS minute_bucket, last_contact // 3600 * 3600 AS hour_bucket,
        last_contact // 86400 * 86400 AS day_bucket,
        CAST(floor((seq - 1000) / 60.0) AS BIGINT) * 60 AS around_zero FROM {STATES}""",
)
def p5(spark, sf_dir):
    at = F.col("last_contact")
    return fixtures.rows(spark, sf_dir, "flight_states").select(
        "seq",
        c.bucket(at, c.MINUTE).alias("minute_bucket"),
        c.bucket(at, c.HOUR).alias("hour_bucket"),
        c.bucket(at, c.DAY).alias("day_bucket"),
        c.bucket(F.col("seq") - 1000, c.MINUTE).alias("around_zero"),
    )


@query("p6_point_lat_lon", f"SELECT seq, lat, lon FROM {METAR}")
def p6(spark, sf_dir):
    rows = fixtures.rows(spark, sf_dir, "metar")
    point = F.when(F.col("lat").isNotNull(), F.array("lon", "lat"))
    lat, lon = c.point_lat_lon(point)
    return rows.select("seq", lat.alias("lat"), lon.alias("lon"))


@query("p7_json_text", f"SELECT seq, polygon FROM {SIGMET}")
def p7(spark, sf_dir):
    rows = fixtures.rows(spark, sf_dir, "sigmet")
    rings = F.from_json("polygon", "ARRAY<ARRAY<ARRAY<DOUBLE>>>")
    return rows.select("seq", c.json_text(rings).alias("polygon"))


@query(
    "p8_require_not_null",
    f"""SELECT seq, icao24, callsign FROM {STATES}
        WHERE callsign IS NOT NULL AND time_position IS NOT NULL AND latitude IS NOT NULL""",
)
def p8(spark, sf_dir):
    rows = fixtures.rows(spark, sf_dir, "flight_states")
    return c.require_not_null(rows, ["callsign", "time_position", "latitude"]).select("seq", "icao24", "callsign")


@query(
    "p9_with_speed_kmh",
    f"SELECT seq, CASE WHEN velocity <> 0 THEN velocity * 3.6::DOUBLE END AS speed_kmh FROM {STATES}",
)
def p9(spark, sf_dir):
    return c.with_speed_kmh(fixtures.rows(spark, sf_dir, "flight_states")).select("seq", "speed_kmh")


@query(
    "p10_with_altitude_category",
    f"""SELECT seq, CASE WHEN baro_altitude < 3000 THEN 'low' WHEN baro_altitude < 10000 THEN 'medium'
        WHEN baro_altitude IS NOT NULL THEN 'high' END AS altitude_category FROM {STATES}""",
)
def p10(spark, sf_dir):
    return c.with_altitude_category(fixtures.rows(spark, sf_dir, "flight_states")).select("seq", "altitude_category")


@query(
    "p11_with_processing_columns",
    f"SELECT seq, 'flights_raw' AS _source_topic, true AS stamped FROM {STATES}",
)
def p11(spark, sf_dir):
    rows = c.with_processing_columns(fixtures.rows(spark, sf_dir, "flight_states"), "flights_raw")
    return rows.select("seq", "_source_topic", (F.col("processing_timestamp") > 1700000000).alias("stamped"))


@query(
    "p12_with_date_partitions",
    f"""SELECT seq, CAST(year(t) AS INTEGER) AS year, CAST(month(t) AS INTEGER) AS month, CAST(day(t) AS INTEGER) AS day
        FROM (SELECT seq, to_timestamp(time_position) AT TIME ZONE 'UTC' AS t FROM {STATES})""",
)
def p12(spark, sf_dir):
    rows = fixtures.rows(spark, sf_dir, "flight_states")
    return c.with_date_partitions(rows, c.epoch_to_ts(F.col("time_position"))).select("seq", "year", "month", "day")


@query(
    "p13_country_from_airport",
    f"""SELECT i.seq, coalesce(a.country_iso2, 'Unknown Code') AS country_code
        FROM {INFO} i LEFT JOIN {AIRPORTS} a ON upper(i.estDepartureAirport) = a.icao_code""",
)
def p13(spark, sf_dir):
    rows = fixtures.rows(spark, sf_dir, "flight_info").select("seq", F.lower("estDepartureAirport").alias("airport"))
    return places.country_from_airport(rows, "airport", inputs.airports(spark, sf_dir)).select("seq", "country_code")


# Nearest place by brute force, with the haversine formula.

def located(cities: str) -> str:
    """SQL for the states with the country of the nearest city, by trying all of them."""
    return f"""(SELECT s.*, coalesce(n.country, 'Unknown') AS country_code FROM {STATES} s LEFT JOIN (
    SELECT seq, arg_min(country, ROW(h, id)) AS country FROM (
        SELECT s.seq, c.seq AS id, c.country_iso2 AS country,
            pow(sin(radians(s.latitude - c.latitude) / 2), 2) + cos(radians(s.latitude)) * cos(radians(c.latitude))
                * pow(sin(radians(s.longitude - c.longitude) / 2), 2) AS h
        FROM {STATES} s, {cities} c WHERE s.latitude IS NOT NULL)
    GROUP BY seq) n ON s.seq = n.seq)"""


LOCATED = located(CITIES)
# The same cities inside one degree.
CLOSE_CITIES = f"""(SELECT seq, country_iso2, latitude / 170 + 48.5::DOUBLE AS latitude, longitude / 360 + 2.5::DOUBLE AS longitude
    FROM {CITIES})"""


@query("p14_country_from_position", f"SELECT seq, country_code FROM {LOCATED}")
def p14(spark, sf_dir):
    rows = inputs.states(spark, sf_dir).select(offset(), "latitude", "longitude")
    index = inputs.place_index(spark, sf_dir)
    return places.country_from_position(rows, "latitude", "longitude", index).select("seq", "country_code")


@query("p14_country_from_position_clustered", f"SELECT seq, country_code FROM {located(CLOSE_CITIES)}")
def p14_clustered(spark, sf_dir):
    rows = inputs.states(spark, sf_dir).select(offset(), "latitude", "longitude")
    cities = inputs.places(spark, sf_dir).withColumns({"lat": F.col("lat") / 170 + 48.5, "lon": F.col("lon") / 360 + 2.5})
    index = places.build_place_index(cities)
    return places.country_from_position(rows, "latitude", "longitude", index).select("seq", "country_code")


@query(
    "p15_country_name",
    f"""SELECT c.seq, coalesce(n.country_name, 'Unknown') AS country_name
        FROM (SELECT seq, CASE WHEN seq % 7 = 0 THEN 'ZZ' ELSE country_iso2 END AS code FROM {CITIES}) c
        LEFT JOIN (SELECT DISTINCT country_iso2, country_name FROM {AIRPORTS}) n ON c.code = n.country_iso2""",
)
def p15(spark, sf_dir):
    code = F.when(F.col("id") % 7 == 0, "ZZ").otherwise(F.col("country_iso2"))
    rows = inputs.cities(spark, sf_dir).select(F.col("id").alias("seq"), code.alias("code"))
    return places.country_name(rows, "code", inputs.airports(spark, sf_dir)).select("seq", "country_name")
