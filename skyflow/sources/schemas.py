"""Record layouts of the six topics, the reference data and the stored tables.

All fields are nullable and every schema is declared; nothing is inferred from data.
"""

from __future__ import annotations

# Topic names.
FLIGHT_STATES_TOPIC = "flights_raw"
FLIGHT_INFO_TOPIC = "flight_data"
FLIGHT_TRACKS_TOPIC = "flight_track"
METAR_TOPIC = "current_airport_weather"
TAF_TOPIC = "future_airport_weather"
SIGMET_TOPIC = "weather_warnings"

# A message as a stream delivers it: the columns of Spark's Kafka source with text payloads.
RAW_MESSAGE = "key STRING, value STRING, topic STRING, partition INT, offset BIGINT, timestamp TIMESTAMP"

# Fields of an aircraft state, in the order of the state vector of the API.
STATE_VECTOR = (
    "icao24 STRING, callsign STRING, origin_country STRING, time_position BIGINT, "
    "last_contact BIGINT, longitude DOUBLE, latitude DOUBLE, baro_altitude DOUBLE, "
    "on_ground BOOLEAN, velocity DOUBLE, true_track DOUBLE, vertical_rate DOUBLE, "
    "sensors ARRAY<INT>, geo_altitude DOUBLE, squawk STRING, spi BOOLEAN, position_source INT"
)
FLIGHT_STATE = STATE_VECTOR + ", fetch_timestamp BIGINT, ingestion_timestamp BIGINT"

# Fields of a flight with its estimated airports.
FLIGHT_INFO = (
    "icao24 STRING, firstSeen BIGINT, estDepartureAirport STRING, lastSeen BIGINT, "
    "estArrivalAirport STRING, callsign STRING, "
    "estDepartureAirportHorizDistance INT, estDepartureAirportVertDistance INT, "
    "estArrivalAirportHorizDistance INT, estArrivalAirportVertDistance INT, "
    "departureAirportCandidatesCount INT, arrivalAirportCandidatesCount INT"
)

# Fields of a trajectory; a path element mixes numbers and a flag, so it is read as text.
FLIGHT_TRACK = (
    "icao24 STRING, startTime BIGINT, endTime BIGINT, callsign STRING, path ARRAY<ARRAY<STRING>>"
)

# Weather numbers are read as doubles and rounded on output: a fraction in an int field would be lost.
CLOUDS = "ARRAY<STRUCT<base: DOUBLE, cover: STRING>>"
POINT = "STRUCT<type: STRING, coordinates: ARRAY<DOUBLE>>"

# Properties of an airport observation.
METAR = (
    "type STRING, properties STRUCT<id: STRING, site: STRING, obsTime: STRING, temp: DOUBLE, "
    "dewp: DOUBLE, wdir: DOUBLE, wspd: DOUBLE, wgst: DOUBLE, ceil: DOUBLE, cover: STRING, "
    "fltcat: STRING, visib: STRING, wx: STRING, altim: DOUBLE, slp: DOUBLE, rawOb: STRING, "
    f"clouds: {CLOUDS}>, geometry {POINT}"
)

# Properties of one forecast period.
TAF = (
    "type STRING, properties STRUCT<id: STRING, site: STRING, issueTime: STRING, "
    "validTimeFrom: STRING, validTimeTo: STRING, timeGroup: DOUBLE, fcstType: STRING, "
    "wdir: DOUBLE, wspd: DOUBLE, wgst: DOUBLE, visib: STRING, ceil: DOUBLE, "
    f"clouds: {CLOUDS}, fltcat: STRING, rawTAF: STRING, cover: STRING>, geometry {POINT}"
)

# Properties of a hazard warning; coordinates stay text until the geometry type is known.
SIGMET = (
    "type STRING, properties STRUCT<icaoId: STRING, firId: STRING, firName: STRING, "
    "seriesId: STRING, hazard: STRING, qualifier: STRING, validTimeFrom: STRING, "
    "validTimeTo: STRING, base: DOUBLE, top: DOUBLE, dir: STRING, spd: STRING, chng: STRING, "
    "rawSigmet: STRING>, geometry STRUCT<type: STRING, coordinates: STRING>"
)
POLYGON = "ARRAY<ARRAY<ARRAY<DOUBLE>>>"
MULTI_POLYGON = "ARRAY<ARRAY<ARRAY<ARRAY<DOUBLE>>>>"

# Reference data. Files hold text only; ``*_NUMBERS`` lists what is cast on read.
AIRPORTS = (
    "id STRING, gmt STRING, airport_id STRING, iata_code STRING, city_iata_code STRING, "
    "icao_code STRING, country_iso2 STRING, geoname_id STRING, latitude STRING, longitude STRING, "
    "airport_name STRING, country_name STRING, phone_number STRING, timezone STRING"
)
AIRLINES = (
    "id STRING, fleet_average_age STRING, airline_id STRING, callsign STRING, hub_code STRING, "
    "iata_code STRING, icao_code STRING, country_iso2 STRING, date_founded STRING, "
    "iata_prefix_accounting STRING, airline_name STRING, country_name STRING, fleet_size STRING, "
    "status STRING, type STRING"
)
CITIES = (
    "id STRING, gmt STRING, city_id STRING, iata_code STRING, country_iso2 STRING, "
    "geoname_id STRING, latitude STRING, longitude STRING, city_name STRING, timezone STRING"
)
REFERENCE_SCHEMAS = {"airports": AIRPORTS, "airlines": AIRLINES, "cities": CITIES}
REFERENCE_NUMBERS = {
    "airports": {"id": "long", "airport_id": "long", "latitude": "double", "longitude": "double"},
    "airlines": {"id": "long", "airline_id": "long", "fleet_average_age": "double", "fleet_size": "int"},
    "cities": {"id": "long", "city_id": "long", "latitude": "double", "longitude": "double"},
}

# Key of each stored table, and seconds a row is kept after it is written.
TABLE_KEYS = {
    "aircrafts_by_icao24": ["icao24"],
    "aircraftstates_by_icao24": ["icao24", "starttime", "time"],
    "aircrafts_by_cell_minute": ["minute_bucket", "icao24"],
    "activeaircraft_by_country_hour": ["country_code", "hour_bucket"],
    "departures_by_country_hour": ["country_code", "hour_bucket"],
    "arrivals_by_country_hour": ["country_code", "hour_bucket"],
    "metar_latest_by_station": ["station_id"],
    "metar_history_by_station": ["station_id", "obs_time"],
    "sigmet_by_validtime": ["hour_bucket", "icao_id", "series_id", "valid_from"],
    "taf_by_station": ["station_id", "issue_time", "time_group", "valid_from"],
}
TABLE_TTL_SECONDS = {
    "metar_history_by_station": 259200,
    "sigmet_by_validtime": 604800,
    "taf_by_station": 259200,
}
