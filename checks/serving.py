"""Queries over the stored tables (Q), each table built from the messages first."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import fixtures, inputs
from checks.flights import (
    AIRCRAFT,
    ARRIVALS,
    BY_MINUTE,
    DEPARTURES,
    LEAVING,
    METAR_HISTORY,
    METAR_LATEST,
    SIGMETS,
    TAFS,
    a1,
    a3,
    a4,
    counted,
    sigmets,
    tafs,
    w2,
    w3,
    w6,
    with_global,
)
from checks.parsing import STATES, WAYPOINT_FIELDS, WAYPOINTS, p2
from checks.registry import query
from skyflow.operators import activity, serving

# Fixed values that hit rows at every scale of the given tables.
MINUTE = 1704067200 + 86400
FLIGHT_KEY = 1
NOON = 1704067200 + 10 * 86400 + 43200
WEEK = 7 * 86400


@query(
    "q1_live_map",
    f"SELECT * FROM {BY_MINUTE} WHERE minute_bucket = (SELECT max(time_position) // 60 * 60 FROM {STATES})",
)
def q1(spark, sf_dir):
    newest = fixtures.rows(spark, sf_dir, "flight_states").agg(F.max("time_position")).first()[0]
    return serving.live_map(a1(spark, sf_dir), newest - newest % 60)


@query("q2_aircraft_state", f"SELECT * FROM {AIRCRAFT} WHERE icao24 = '00000c'")
def q2(spark, sf_dir):
    return serving.aircraft_state(w6(spark, sf_dir), "00000c")


@query(
    "q3_flight_track",
    f"""SELECT {WAYPOINT_FIELDS} FROM {WAYPOINTS}
        WHERE (icao24, starttime) = (SELECT (icao24, starttime) FROM {WAYPOINTS} ORDER BY seq DESC LIMIT 1)""",
)
def q3(spark, sf_dir):
    flight = fixtures.rows(spark, sf_dir, "track_waypoints").agg(F.max_by(F.struct("icao24", "starttime"), "seq")).first()[0]
    return serving.flight_track(p2(spark, sf_dir), flight["icao24"], flight["starttime"])


@query(
    "q4_country_series",
    f"""SELECT * FROM {counted(with_global(LEAVING), 'firstSeen', 'departures_cnt')}
        WHERE country_code = 'GLOBAL' AND hour_bucket BETWEEN 820454400 AND 852076800""",
)
def q4(spark, sf_dir):
    series = activity.departures_by_country_hour(inputs.info(spark, sf_dir), inputs.airports(spark, sf_dir), with_global=True)
    return serving.country_series(series, "GLOBAL", 820454400, 852076800)


@query("q5_metar_for_stations", f"SELECT * FROM {METAR_LATEST} WHERE station_id IN ('K001', 'K007', 'K039', 'KXXX')")
def q5(spark, sf_dir):
    return serving.metar_for_stations(w2(spark, sf_dir), ["K001", "K007", "K039", "KXXX"])


@query(
    "q5_metar_for_station_table",
    f"SELECT * FROM {METAR_LATEST} WHERE station_id IN (SELECT 'K' || lpad(CAST(s_suppkey AS VARCHAR), 3, '0') FROM supplier)",
)
def q5_table(spark, sf_dir):
    supplier = spark.read.parquet(f"{sf_dir}/supplier.parquet")
    stations = supplier.select(F.concat(F.lit("K"), F.lpad(F.col("s_suppkey").cast("string"), 3, "0")).alias("station_id"))
    return serving.metar_for_stations(w2(spark, sf_dir), stations)


@query(
    "q6_first_per_partition",
    f"SELECT * FROM {METAR_HISTORY} QUALIFY row_number() OVER (PARTITION BY station_id ORDER BY obs_time DESC) <= 3",
)
def q6(spark, sf_dir):
    return serving.newest_per_station(w3(spark, sf_dir), 3)


@query(
    "q7_metar_range",
    f"SELECT * FROM {METAR_HISTORY} WHERE station_id = 'K007' AND obs_time BETWEEN {NOON - WEEK} AND {NOON}",
)
def q7(spark, sf_dir):
    return serving.metar_range(w3(spark, sf_dir), "K007", NOON - WEEK, NOON)


@query("q8_active_sigmets", f"SELECT * FROM {SIGMETS} WHERE valid_from <= {NOON} AND valid_to >= {NOON}")
def q8(spark, sf_dir):
    return serving.active_sigmets(sigmets(spark, sf_dir), NOON)


@query("q9_at_altitude", f"SELECT * FROM {SIGMETS} WHERE base <= 12000 AND top >= 12000")
def q9(spark, sf_dir):
    return serving.at_altitude(sigmets(spark, sf_dir), 12000)


@query(
    "q10_latest_taf",
    f"SELECT * FROM {TAFS} WHERE station_id = 'K007' QUALIFY rank() OVER (ORDER BY issue_time DESC) = 1",
)
def q10(spark, sf_dir):
    return serving.latest_taf(tafs(spark, sf_dir), "K007")


BULLETIN = 1704067200 + 10 * 86400


@query(
    "q11_taf_window",
    f"""SELECT * FROM {TAFS} WHERE station_id = 'K007' AND issue_time = (SELECT max(issue_time) FROM {TAFS} WHERE station_id = 'K007')
        AND valid_from >= issue_time + 7200 AND valid_to <= issue_time + 21600""",
)
def q11(spark, sf_dir):
    table = tafs(spark, sf_dir)
    issued = table.filter("station_id = 'K007'").agg(F.max("issue_time")).first()[0]
    return serving.taf_window(table, "K007", issued, issued + 7200, issued + 21600)


@query(
    "q12_compare_forecast",
    f"""SELECT h.station_id, h.obs_time, h.fltcat AS observed_fltcat, t.issue_time, t.time_group,
        t.fltcat AS forecast_fltcat, h.fltcat = t.fltcat AS match
        FROM {METAR_HISTORY} h JOIN {TAFS} t ON h.station_id = t.station_id AND h.obs_time >= t.valid_from
            AND h.obs_time < t.valid_to AND t.issue_time <= h.obs_time
        QUALIFY row_number() OVER (PARTITION BY h.station_id, h.obs_time
            ORDER BY t.issue_time DESC, t.time_group DESC, t.valid_from DESC) = 1""",
)
def q12(spark, sf_dir):
    return serving.compare_forecast(w3(spark, sf_dir), tafs(spark, sf_dir))


@query("q13_share_by", f"SELECT fltcat, count(*) AS cnt FROM {METAR_HISTORY} GROUP BY 1")
def q13(spark, sf_dir):
    return serving.share_by(w3(spark, sf_dir), "fltcat")


@query(
    "q14_timeline",
    f"""SELECT hour_bucket, country_code, sum(departures_cnt)::BIGINT AS departures FROM {DEPARTURES} GROUP BY 1, 2""",
)
def q14(spark, sf_dir):
    return serving.timeline(a3(spark, sf_dir), "hour_bucket", "country_code", F.sum("departures_cnt"), "departures")


@query(
    "q15_departures_vs_arrivals",
    f"""SELECT country_code, hour_bucket, coalesce(departures_cnt, 0) AS departures_cnt,
        coalesce(arrivals_cnt, 0) AS arrivals_cnt
        FROM {DEPARTURES} d FULL JOIN {ARRIVALS} a USING (country_code, hour_bucket)""",
)
def q15(spark, sf_dir):
    return serving.departures_vs_arrivals(a3(spark, sf_dir), a4(spark, sf_dir), ["country_code", "hour_bucket"])


@query(
    "q16_table_profile",
    f"SELECT count(*) AS row_count, count(DISTINCT (icao24, starttime, time)) AS distinct_keys FROM {WAYPOINTS}",
)
def q16(spark, sf_dir):
    return serving.table_profile(p2(spark, sf_dir), ["icao24", "starttime", "time"])


@query("q16_table_sample", f"SELECT {WAYPOINT_FIELDS} FROM {WAYPOINTS} ORDER BY {WAYPOINT_FIELDS} LIMIT 5000")
def q16_sample(spark, sf_dir):
    return serving.table_sample(p2(spark, sf_dir), WAYPOINT_FIELDS.split(", "), 5000)
