from pyspark.sql import functions as F

from skyflow.operators import activity, keyed, positions, quality, serving, transitions
from skyflow.plans.ordering import first_per_key

STATE = (
    "icao24 STRING, time_position BIGINT, last_contact BIGINT, latitude DOUBLE, longitude DOUBLE, geo_altitude DOUBLE, "
    "velocity DOUBLE, true_track DOUBLE, on_ground BOOLEAN"
)


def states(spark, *tuples, offsets=False):
    df = spark.createDataFrame([(t + (None,) * 9)[:9] for t in tuples], STATE)
    df = df.withColumn("timestamp", F.timestamp_seconds("time_position"))
    if offsets:
        df = df.withColumn("_metadata", F.struct(F.col("last_contact").alias("offset")))
    return df


def test_minute_keeps_last_known_values(spark):
    for offsets in (False, True):
        df = states(spark, ("a", 60, 1, 10.0, 20.0), ("a", 61, 2, None, 21.0), ("a", 121, 3, 12.0, 22.0), offsets=offsets)
        found = sorted(tuple(r)[:5] for r in positions.latest_by_minute(df).collect())
        assert found == [(60, "a", 61, 10.0, 21.0), (120, "a", 121, 12.0, 22.0)]


def test_equal_seconds_follow_the_offset(spark):
    df = states(spark, ("a", 60, 5, 1.0, 1.0), ("a", 60, 9, 2.0, 2.0), ("a", 60, 7, 3.0, 3.0), offsets=True)
    assert positions.latest_by_minute(df).first().lat == 2.0


def test_minute_aggregates_in_a_hash_table(spark):
    plan = positions.latest_by_minute(states(spark, offsets=True))._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_tie_break_out_of_range_fails(spark):
    import pytest

    df = states(spark, ("a", 60, -1, 1.0, 1.0), offsets=True)
    with pytest.raises(Exception, match="out of range"):
        positions.latest_by_minute(df).collect()


def test_rows_without_time_enter_no_window(spark):
    assert positions.latest_by_minute(states(spark, ("a", None, 1, 10.0, 20.0))).count() == 0


def info(spark, *tuples):
    return spark.createDataFrame(list(tuples), "icao24 STRING, firstSeen BIGINT, lastSeen BIGINT, estDepartureAirport STRING, estArrivalAirport STRING")


def airports(spark):
    return spark.createDataFrame([(1, "A", "NA"), (2, "B", "NB")], "id INT, icao_code STRING, country_iso2 STRING")


def test_global_is_distinct_not_a_sum(spark, rows):
    df = info(spark, ("x", 0, 0, "A", "A"), ("x", 60, 0, "B", "A"), ("y", 70, 0, "B", "A"))
    counts = activity.departures_by_country_hour(df, airports(spark), with_global=True)
    assert rows(counts) == [("GLOBAL", 0, 2), ("NA", 0, 1), ("NB", 0, 2)]


def test_aircraft_and_flights(spark, rows):
    df = info(spark, ("x", 0, 0, "A", "A"), ("x", 60, 0, "A", "A"), (None, 60, 0, "A", "A"), ("x", None, 0, "A", "A"))
    assert rows(activity.departures_by_country_hour(df, airports(spark))) == [("NA", 0, 1)]
    assert rows(activity.departures_by_country_hour(df, airports(spark), count_flights=True)) == [("NA", 0, 2)]


def test_unknown_aircraft_alone_count_zero(spark, rows):
    assert rows(activity.departures_by_country_hour(info(spark, (None, 60, 0, "A", "A")), airports(spark))) == [("NA", 0, 0)]


def test_approximate_counts_are_close(spark):
    df = spark.range(20000).select(
        F.concat(F.lit("x"), F.col("id") % 5000).alias("icao24"),
        (F.col("id") % 3600).alias("firstSeen"),
        F.lit("A").alias("estDepartureAirport"),
    )
    near = activity.departures_by_country_hour(df, airports(spark), approx=True).first().departures_cnt
    assert abs(near - 5000) <= 3 * 0.05 * 5000


def test_sketches_are_rolled_up(spark, rows):
    def flight(i, t, airport):
        return (None if i is None else f"x{i}", t, t, airport, airport)

    df = info(spark, *[flight(i, i * 7 % 7200, "A") for i in range(2000)], *[flight(i, 30, "B") for i in range(5)], flight(None, 90, "B"), flight(None, 7300, "B"))
    sketches = activity.departure_sketches(df, airports(spark))
    assert sketches.filter("country_code = 'NB'").count() == 3
    found = rows(activity.counts_from_sketches(sketches, ["country_code"], "n", with_global=True))
    exact = rows(activity.departures_by_country_hour(df, airports(spark), with_global=True))
    assert [r[:2] for r in found] == [r[:2] for r in exact]
    assert all(abs(a[2] - b[2]) <= 1 + 0.05 * b[2] for a, b in zip(found, exact))
    assert ("NB", 0, 5) in found and ("NB", 7200, 0) in found and ("GLOBAL", 7200, 0) in found
    day = rows(activity.counts_from_sketches(sketches, ["country_code"], "n", "day_bucket", 86400))
    assert [r[:2] for r in day] == [("NA", 0), ("NB", 0)] and day[1][2] == 5


def flags(spark, *pairs):
    return states(spark, *[("a", t, i, None, None, None, None, None, f) for i, (t, f) in enumerate(pairs)])


def test_transitions(spark, rows):
    df = flags(spark, (10, True), (20, False), (30, False), (40, True), (25, False), (35, None))
    assert rows(transitions.ground_transitions(df)) == [("a", 20, "departure"), ("a", 40, "arrival")]


def test_transitions_across_days(spark, rows):
    df = flags(spark, (86399, True), (86400, False), (5 * 86400, False), (9 * 86400, True))
    assert rows(transitions.ground_transitions(df)) == [("a", 777600, "arrival"), ("a", 86400, "departure")]


def test_newest_wins_whatever_the_arrival(spark, rows):
    df = spark.createDataFrame([("k", 5, "new"), ("k", 3, "old"), ("j", None, "none")], "k STRING, t INT, v STRING")
    assert rows(keyed.latest_by_key(df, ["k"], ["t"])) == [("j", None, "none"), ("k", 5, "new")]


def test_first_per_key_beyond_the_threshold(spark, rows):
    df = spark.range(3000).select((F.col("id") % 3).alias("k"), "id")
    many = first_per_key(df, ["k"], [F.desc("id")], 1500)
    assert many.count() == 3000
    spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", "1")
    try:
        two = first_per_key(df, ["k"], [F.desc("id")], 2)
        assert rows(two) == [(0, 2994), (0, 2997), (1, 2995), (1, 2998), (2, 2996), (2, 2999)]
    finally:
        spark.conf.unset("spark.sql.optimizer.windowGroupLimitThreshold")


def test_retention_ends_at_the_ttl(spark, rows):
    df = spark.createDataFrame([(100,), (101,)], "w INT")
    assert rows(keyed.retain(df, "w", 50, 150)) == [(101,)]


def warnings(spark):
    return spark.createDataFrame(
        [(3600, 3600, 7200, 100, 200), (0, 0, 3599, None, 200)],
        "hour_bucket BIGINT, valid_from BIGINT, valid_to BIGINT, base INT, top INT",
    )


def test_active_sigmets_include_both_ends(spark):
    assert [serving.active_sigmets(warnings(spark), at).count() for at in (3600, 7200, 7201)] == [1, 1, 0]


def test_active_sigmets_of_any_length(spark):
    """A warning that is valid for six hours is listed five hours after it began."""
    row = [(0, "Z", "1", 0, 6 * 3600)]
    table = spark.createDataFrame(row, "hour_bucket BIGINT, icao_id STRING, series_id STRING, valid_from BIGINT, valid_to BIGINT")
    assert serving.active_sigmets(table, 5 * 3600).count() == 1
    assert serving.active_sigmets(table, 5 * 3600, longest_hours=6).count() == 1
    assert serving.active_sigmets(table, 5 * 3600, longest_hours=3).count() == 0


def test_table_sample_is_ordered(spark, rows):
    table = spark.range(100).selectExpr("100 - id AS id", "id AS other").repartition(5)
    assert rows(serving.table_sample(table, ["id"], 3)) == [(1, 99), (2, 98), (3, 97)]


def test_altitude_includes_both_ends(spark):
    assert [serving.at_altitude(warnings(spark), feet).count() for feet in (99, 100, 200, 201)] == [0, 1, 1, 0]


def test_forecast_end_belongs_to_the_next_period(spark, rows):
    history = spark.createDataFrame([("K", 7200, "VFR"), ("K", 99999, "VFR")], "station_id STRING, obs_time BIGINT, fltcat STRING")
    taf = spark.createDataFrame(
        [("K", 0, 0, 0, 7200, "IFR"), ("K", 0, 1, 7200, 14400, "VFR"), ("K", 7201, 0, 0, 14400, "LIFR")],
        "station_id STRING, issue_time BIGINT, time_group INT, valid_from BIGINT, valid_to BIGINT, fltcat STRING",
    )
    assert rows(serving.compare_forecast(history, taf)) == [("K", 7200, "VFR", 0, 1, "VFR", True)]


def test_overlong_forecast_period_counts(spark, rows):
    history = spark.createDataFrame([("K", 10**9, "VFR")], "station_id STRING, obs_time BIGINT, fltcat STRING")
    taf = spark.createDataFrame(
        [("K", 0, 0, 0, 2 * 10**9, "IFR")],
        "station_id STRING, issue_time BIGINT, time_group INT, valid_from BIGINT, valid_to BIGINT, fltcat STRING",
    )
    assert rows(serving.compare_forecast(history, taf)) == [("K", 10**9, "VFR", 0, 0, "IFR", False)]


def test_quality_report_flags_an_empty_table(spark, rows):
    empty = spark.createDataFrame([], "country_code STRING, hour_bucket BIGINT, departures_cnt BIGINT")
    report = rows(quality.quality_report({"departures_by_country_hour": empty}))
    assert report == [("countries", "departures_by_country_hour", 0, False), ("rows", "departures_by_country_hour", 0, False)]
