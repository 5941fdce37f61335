"""Queries for flight aggregates (A), keyed tables (W) and enrichment (E)."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import fixtures, inputs
from checks.parsing import AIRLINES, AIRPORTS, CITIES, INFO, LOCATED, METAR, SIGMET, STATES, TAF, WAYPOINTS, offset
from checks.registry import query
from skyflow.operators import activity, enrich, keyed, positions, quality, transitions, weather
from skyflow.plans.staging import staged


def latest_of(source: str, keys: str, order: str = "seq DESC") -> str:
    """SQL for the newest row per key."""
    return f"(SELECT * FROM {source} QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY {order}) = 1)"


def _last(column: str) -> str:
    return f"arg_max({column}, ROW(time_position, seq)) FILTER ({column} IS NOT NULL)"


BY_MINUTE = f"""(SELECT time_position // 60 * 60 AS minute_bucket, icao24, max(time_position) AS last_seen_ts,
    {_last('latitude')} AS lat, {_last('longitude')} AS lon, {_last('geo_altitude')} AS geo_altitude,
    {_last('velocity')} AS velocity, {_last('true_track')} AS true_track
    FROM {STATES} WHERE time_position IS NOT NULL GROUP BY 1, 2)"""


@query("a1_latest_by_minute", f"SELECT * FROM {BY_MINUTE}")
def a1(spark, sf_dir):
    return positions.latest_by_minute(inputs.states(spark, sf_dir))


def counted(source: str, time: str, name: str, bucket: str = "hour_bucket", width: int = 3600, entity: str = "icao24") -> str:
    """SQL for distinct entities per country and bucket."""
    return f"""(SELECT country_code, {time} // {width} * {width} AS {bucket}, count(DISTINCT {entity}) AS {name}
        FROM {source} WHERE {time} IS NOT NULL GROUP BY 1, 2)"""


def with_global(source: str) -> str:
    """SQL that repeats every row for ``GLOBAL``."""
    return f"(SELECT * FROM {source} UNION ALL SELECT * REPLACE ('GLOBAL' AS country_code) FROM {source})"


def by_airport(column: str) -> str:
    return f"""(SELECT i.*, coalesce(a.country_iso2, 'Unknown Code') AS country_code
        FROM {INFO} i LEFT JOIN {AIRPORTS} a ON i.{column} = a.icao_code)"""


LEAVING, ARRIVING = by_airport("estDepartureAirport"), by_airport("estArrivalAirport")
ACTIVE = counted(LOCATED, "time_position", "active_aircraft_cnt")
DEPARTURES = counted(LEAVING, "firstSeen", "departures_cnt")
ARRIVALS = counted(ARRIVING, "lastSeen", "arrivals_cnt")


def _active(spark, sf_dir, **options):
    return activity.active_by_country_hour(inputs.states(spark, sf_dir), inputs.place_index(spark, sf_dir), **options)


def _departures(spark, sf_dir, **options):
    return activity.departures_by_country_hour(inputs.info(spark, sf_dir), inputs.airports(spark, sf_dir), **options)


def _arrivals(spark, sf_dir, **options):
    return activity.arrivals_by_country_hour(inputs.info(spark, sf_dir), inputs.airports(spark, sf_dir), **options)


@query("a2_active_by_country_hour", f"SELECT * FROM {ACTIVE}")
def a2(spark, sf_dir):
    return _active(spark, sf_dir)


def with_exact(near, exact, count, error):
    """The exact counts, and whether an approximate one lies within three standard errors of each."""
    keys = ["country_code", "hour_bucket"]
    both = exact.join(near.withColumnRenamed(count, "near"), keys, "full")
    close = F.abs(F.col("near") - F.col(count)) <= F.lit(1) + F.col(count) * (3 * error)
    return both.select(*keys, count, F.coalesce(close, F.lit(False)).alias("close"))


def closely(counts: str) -> str:
    """SQL for ``with_exact``: every count is met."""
    return f"SELECT *, true AS close FROM {counts}"


#: Standard errors of the two kinds of approximate counts.
PLAIN_ERROR, SKETCH_ERROR = 0.05, 1.04 / 2 ** (activity.SKETCH_SIZE / 2)


@query("a2_active_by_country_hour_approx", closely(ACTIVE))
def a2_approx(spark, sf_dir):
    return with_exact(_active(spark, sf_dir, approx=True), _active(spark, sf_dir), "active_aircraft_cnt", PLAIN_ERROR)


@query("a2_active_from_sketches", closely(counted(with_global(LOCATED), "time_position", "active_aircraft_cnt")))
def a2_sketches(spark, sf_dir):
    """Hours and ``GLOBAL`` from stored sketches per minute."""
    sketches = staged(activity.active_sketches(inputs.states(spark, sf_dir), inputs.place_index(spark, sf_dir)), "sketches")
    near = activity.counts_from_sketches(sketches, ["country_code"], "active_aircraft_cnt", with_global=True)
    return with_exact(near, _active(spark, sf_dir, with_global=True), "active_aircraft_cnt", SKETCH_ERROR)


@query("a3_departures_by_country_hour", f"SELECT * FROM {DEPARTURES}")
def a3(spark, sf_dir):
    return _departures(spark, sf_dir)


@query("a3_departures_by_country_hour_approx", closely(DEPARTURES))
def a3_approx(spark, sf_dir):
    return with_exact(_departures(spark, sf_dir, approx=True), _departures(spark, sf_dir), "departures_cnt", PLAIN_ERROR)


@query("a3_departures_from_sketches", closely(counted(with_global(LEAVING), "firstSeen", "departures_cnt")))
def a3_sketches(spark, sf_dir):
    sketches = staged(activity.departure_sketches(inputs.info(spark, sf_dir), inputs.airports(spark, sf_dir)), "sketches")
    near = activity.counts_from_sketches(sketches, ["country_code"], "departures_cnt", with_global=True)
    return with_exact(near, _departures(spark, sf_dir, with_global=True), "departures_cnt", SKETCH_ERROR)


@query("a4_arrivals_from_sketches", closely(counted(with_global(ARRIVING), "lastSeen", "arrivals_cnt")))
def a4_sketches(spark, sf_dir):
    sketches = staged(activity.arrival_sketches(inputs.info(spark, sf_dir), inputs.airports(spark, sf_dir)), "sketches")
    near = activity.counts_from_sketches(sketches, ["country_code"], "arrivals_cnt", with_global=True)
    return with_exact(near, _arrivals(spark, sf_dir, with_global=True), "arrivals_cnt", SKETCH_ERROR)


@query(
    "a3_departing_flights_by_country_hour",
    f"SELECT * FROM {counted(LEAVING, 'firstSeen', 'departures_cnt', entity='(icao24, firstSeen)')}",
)
def a3_flights(spark, sf_dir):
    return _departures(spark, sf_dir, count_flights=True)


@query("a4_arrivals_by_country_hour", f"SELECT * FROM {ARRIVALS}")
def a4(spark, sf_dir):
    return _arrivals(spark, sf_dir)


@query(
    "a5_departures_with_global",
    f"SELECT * FROM {counted(with_global(LEAVING), 'firstSeen', 'departures_cnt')}",
)
def a5(spark, sf_dir):
    return _departures(spark, sf_dir, with_global=True)


@query(
    "a5_active_with_global",
    f"SELECT * FROM {counted(with_global(LOCATED), 'time_position', 'active_aircraft_cnt')}",
)
def a5_active(spark, sf_dir):
    return _active(spark, sf_dir, with_global=True)


DENSITY = f"""(SELECT CAST(floor(latitude / 5.0) AS BIGINT) AS cell_lat, CAST(floor(longitude / 5.0) AS BIGINT) AS cell_lon,
    time_position // 60 * 60 AS minute_bucket, count(DISTINCT icao24) AS aircraft_cnt FROM {STATES}
    WHERE time_position IS NOT NULL AND latitude IS NOT NULL AND longitude IS NOT NULL GROUP BY 1, 2, 3)"""


@query("a6_traffic_density_by_cell_minute", f"SELECT * FROM {DENSITY}")
def a6(spark, sf_dir):
    return activity.traffic_density_by_cell_minute(inputs.states(spark, sf_dir), 5.0)


@query(
    "a7_active_by_country_minute",
    f"SELECT * FROM {counted(LOCATED, 'time_position', 'active_aircraft_cnt', 'minute_bucket', 60)}",
)
def a7(spark, sf_dir):
    return activity.active_by_country_minute(inputs.states(spark, sf_dir), inputs.place_index(spark, sf_dir))


@query(
    "a8_departures_by_icao24_day",
    f"SELECT icao24, firstSeen // 86400 * 86400 AS day_bucket, count(*) AS departures_cnt FROM {INFO} GROUP BY 1, 2",
)
def a8(spark, sf_dir):
    return activity.departures_by_icao24_day(inputs.info(spark, sf_dir))


@query(
    "a8_arrivals_by_icao24_day",
    f"SELECT icao24, lastSeen // 86400 * 86400 AS day_bucket, count(*) AS arrivals_cnt FROM {INFO} GROUP BY 1, 2",
)
def a8_arrivals(spark, sf_dir):
    return activity.arrivals_by_icao24_day(inputs.info(spark, sf_dir))


TRANSITIONS = f"""(SELECT icao24, time_position AS time, CASE WHEN on_ground THEN 'arrival' ELSE 'departure' END AS event
    FROM (SELECT *, lag(on_ground) OVER (PARTITION BY icao24 ORDER BY time_position) AS before
        FROM (SELECT icao24, time_position, arg_max(on_ground, seq) AS on_ground FROM {STATES}
            WHERE time_position IS NOT NULL GROUP BY 1, 2))
    WHERE before <> on_ground)"""


@query("a9_ground_transitions", f"SELECT * FROM {TRANSITIONS}")
def a9(spark, sf_dir):
    return transitions.ground_transitions(inputs.states(spark, sf_dir))


@query(
    "w1_latest_by_key",
    f"""SELECT station_id, obs_time, seq, raw_ob FROM {latest_of(METAR, 'station_id', 'obs_time DESC, seq DESC')}""",
)
def w1(spark, sf_dir):
    rows = fixtures.rows(spark, sf_dir, "metar").select("station_id", "obs_time", "seq", "raw_ob")
    return keyed.latest_by_key(rows, ["station_id"], ["obs_time", "seq"])


_LATEST = latest_of(f"(SELECT * FROM {METAR} WHERE lat IS NOT NULL)", "station_id", "obs_time DESC, seq DESC")
METAR_LATEST = f"(SELECT {', '.join(weather.METAR_LATEST)} FROM {_LATEST})"
METAR_HISTORY = f"(SELECT {', '.join(weather.METAR_HISTORY)} FROM {latest_of(METAR, 'station_id, obs_time')})"
_WARNINGS = latest_of(
    f"(SELECT * FROM {SIGMET} WHERE icao_id IS NOT NULL AND polygon IS NOT NULL)",
    "hour_bucket, icao_id, series_id, valid_from",
)
SIGMETS = f"(SELECT {', '.join(weather.SIGMET)} FROM {_WARNINGS})"
TAFS = f"""(SELECT * FROM (SELECT {', '.join(c for c in weather.TAF if c not in ('lat', 'lon'))},
    40.25::DOUBLE AS lat, (-75.5)::DOUBLE AS lon FROM {latest_of(TAF, 'station_id, issue_time, time_group, valid_from')}))"""


@query("w2_metar_latest", f"SELECT * FROM {METAR_LATEST}")
def w2(spark, sf_dir):
    return weather.metar_latest(inputs.metar(spark, sf_dir))


@query("w3_metar_history", f"SELECT * FROM {METAR_HISTORY}")
def w3(spark, sf_dir):
    return weather.metar_history(inputs.metar(spark, sf_dir))


def sigmets(spark, sf_dir):
    return weather.sigmet_by_validtime(inputs.sigmet(spark, sf_dir))


@query("w4_sigmet_by_validtime", f"SELECT * FROM {SIGMETS}")
def w4(spark, sf_dir):
    return sigmets(spark, sf_dir)


def tafs(spark, sf_dir):
    return weather.taf_by_station(inputs.taf(spark, sf_dir))


@query("w5_taf_by_station", f"SELECT * FROM {TAFS}")
def w5(spark, sf_dir):
    return tafs(spark, sf_dir)


AIRCRAFT = f"""(SELECT icao24, callsign, latitude AS lat, longitude AS lon
    FROM {latest_of(STATES, 'icao24', 'time_position DESC NULLS LAST, seq DESC')})"""


@query("w6_aircraft_current", f"SELECT * FROM {AIRCRAFT}")
def w6(spark, sf_dir):
    return positions.aircraft_current(inputs.states(spark, sf_dir))


@query(
    "w7_assign_time_group",
    f"""SELECT station_id, issue_time, valid_from, fcst_type, raw_taf, CAST(row_number() OVER (
            PARTITION BY station_id, issue_time ORDER BY valid_from, valid_to, fcst_type) - 1 AS INTEGER) AS time_group
        FROM {latest_of(TAF, 'station_id, issue_time, valid_from, valid_to, fcst_type')}""",
)
def w7(spark, sf_dir):
    rows = fixtures.rows(spark, sf_dir, "taf")
    fields = ["station_id", "issue_time", "valid_from", "fcst_type", "raw_taf", "time_group"]
    return keyed.assign_time_group(rows, ["seq"]).select(*fields)


NOW, TTL = 1705000000, 259200


@query(
    "w8_retain",
    f"SELECT seq, station_id, obs_time FROM {METAR} WHERE obs_time > {NOW} - {TTL}",
)
def w8(spark, sf_dir):
    rows = fixtures.rows(spark, sf_dir, "metar").select("seq", "station_id", "obs_time")
    return keyed.retain(rows, "obs_time", TTL, NOW)


# Codes repeat where there are more airlines than codes; the first airline counts.
AIRLINE_BY_CODE = f"(SELECT * FROM {AIRLINES} QUALIFY row_number() OVER (PARTITION BY icao_code ORDER BY seq) = 1)"


@query(
    "e1_enrich_airline",
    f"""SELECT s.seq, s.callsign, a.airline_name, a.country_name AS airline_country, a.fleet_size AS airline_fleet_size
        FROM {STATES} s LEFT JOIN {AIRLINE_BY_CODE} a ON upper(substr(s.callsign, 1, 3)) = a.icao_code""",
)
def e1(spark, sf_dir):
    rows = inputs.states(spark, sf_dir).select(offset(), "callsign")
    return enrich.enrich_airline(rows, inputs.airlines(spark, sf_dir))


@query(
    "e2_enrich_airports",
    f"""SELECT i.seq, d.airport_name AS dep_airport_name, d.country_iso2 AS dep_country_iso2,
        d.country_name AS dep_country_name, d.city_iata_code AS dep_city_iata_code,
        r.airport_name AS arr_airport_name, r.country_iso2 AS arr_country_iso2,
        r.country_name AS arr_country_name, r.city_iata_code AS arr_city_iata_code
        FROM {INFO} i LEFT JOIN {AIRPORTS} d ON i.estDepartureAirport = d.icao_code
        LEFT JOIN {AIRPORTS} r ON i.estArrivalAirport = r.icao_code""",
)
def e2(spark, sf_dir):
    rows = inputs.info(spark, sf_dir).select(offset(), "estDepartureAirport", "estArrivalAirport")
    return enrich.enrich_airports(rows, inputs.airports(spark, sf_dir)).drop("estDepartureAirport", "estArrivalAirport")


@query(
    "e3_enrich_city",
    f"""SELECT a.seq, a.icao_code, c.city_name, c.country_iso2 AS city_country_iso2 FROM {AIRPORTS} a
        LEFT JOIN {latest_of(CITIES, 'iata_code', 'seq')} c ON a.city_iata_code = c.iata_code""",
)
def e3(spark, sf_dir):
    rows = inputs.airports(spark, sf_dir).select(F.col("id").alias("seq"), "icao_code", "city_iata_code")
    return enrich.enrich_city(rows, inputs.cities(spark, sf_dir)).drop("city_iata_code")


def _check(table: str, source: str, *checks: tuple[str, str]) -> str:
    lines = [f"SELECT '{check}' AS \"check\", '{table}' AS \"table\", {value} AS value FROM {source}" for check, value in checks]
    return " UNION ALL ".join(lines)


_COUNTRIES = ("countries", "count(DISTINCT country_code) FILTER (regexp_matches(country_code, '^[A-Z]{2}$'))")
_CHECKS = " UNION ALL ".join(
    [
        _check("aircrafts_by_icao24", AIRCRAFT, ("rows", "count(*)")),
        _check(
            "aircraftstates_by_icao24",
            WAYPOINTS,
            ("rows", "count(*)"),
            ("valid_positions", "count(*) FILTER (lat BETWEEN -90 AND 90 AND lon IS NOT NULL)"),
        ),
        _check("departures_by_country_hour", DEPARTURES, ("rows", "count(*)"), _COUNTRIES),
        _check("arrivals_by_country_hour", ARRIVALS, ("rows", "count(*)"), _COUNTRIES),
        _check(
            "activeaircraft_by_country_hour",
            ACTIVE,
            ("rows", "count(*)"),
            ("country_present", "count(*) FILTER (country_code = 'NA')"),
        ),
        _check("aircrafts_by_cell_minute", BY_MINUTE, ("rows", "count(*)")),
    ]
)


@query("e4_quality_report", f"SELECT *, value > 0 AS ok FROM ({_CHECKS})")
def e4(spark, sf_dir):
    tables = {
        "aircrafts_by_icao24": positions.aircraft_current(inputs.states(spark, sf_dir)),
        "aircraftstates_by_icao24": positions.track_waypoints(inputs.tracks(spark, sf_dir)),
        "departures_by_country_hour": _departures(spark, sf_dir),
        "arrivals_by_country_hour": _arrivals(spark, sf_dir),
        "activeaircraft_by_country_hour": _active(spark, sf_dir),
        "aircrafts_by_cell_minute": a1(spark, sf_dir),
    }
    return quality.quality_report(tables, "NA")
