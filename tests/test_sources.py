import datetime
import json

import pytest
from pyspark.sql import functions as F

from checks import fixtures
from skyflow.operators import weather
from skyflow.plans.staging import new_folder
from skyflow.sources import messages, parse
from skyflow.sources.archive import read_archive
from skyflow.sources.arrays import array_elements
from skyflow.sources.reference import read_reference
from skyflow.streaming.sinks import publish, to_messages, write_archive


def raw(spark, *values):
    return spark.createDataFrame([(v if v is None or isinstance(v, str) else json.dumps(v),) for v in values], "value STRING")


def test_flight_state(spark):
    df = parse.parse_flight_states(raw(spark, {"icao24": "a1b2c3", "time_position": 1700000000, "velocity": 0}))
    row = df.withColumn("timestamp", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss")).first()
    assert (row.icao24, row.velocity, row.timestamp) == ("a1b2c3", 0.0, "2023-11-14 22:13:20")
    assert row.callsign is None and row.sensors is None and len(row) == 20


def test_sensors_are_an_array(spark):
    row = parse.parse_flight_states(raw(spark, {"icao24": "a", "sensors": [1, 2]})).first()
    assert (row.icao24, row.sensors) == ("a", [1, 2])


def test_track_messages_do_not_broadcast_the_orders(spark, tmp_path):
    day = datetime.datetime(2024, 1, 1)
    spark.createDataFrame([(1, 7, day), (2, 8, day)], "o_orderkey LONG, o_custkey LONG, o_orderdate TIMESTAMP").write.parquet(f"{tmp_path}/orders.parquet")
    items = [(1, 5, 6, 1, 2.0, day), (1, 5, 6, 2, 3.0, day), (2, 5, 6, 1, 4.0, day), (3, 5, 6, 1, 5.0, day)]
    schema = "l_orderkey LONG, l_partkey LONG, l_suppkey LONG, l_linenumber INT, l_extendedprice DOUBLE, l_shipdate TIMESTAMP"
    spark.createDataFrame(items, schema).write.parquet(f"{tmp_path}/lineitem.parquet")
    made = fixtures.flight_track_messages(spark, str(tmp_path))
    assert "BroadcastExchange" not in made._jdf.queryExecution().executedPlan().toString()
    found = {row.offset: (row.key.split("-")[0], len(json.loads(row.value)["path"])) for row in made.collect()}
    assert found == {1: ("000007", 2), 2: ("000008", 1)}


def test_undecodable_messages_keep_their_row(spark):
    df = parse.parse_flight_states(raw(spark, '{"a":7,', None, {"icao24": "x"}))
    assert sorted(r.icao24 or "" for r in df.collect()) == ["", "", "x"]


def test_message_is_decoded_once(spark):
    rows = weather.metar_latest_rows(parse.parse_metar(raw(spark, "{}")))
    assert rows._jdf.queryExecution().executedPlan().toString().count("from_json") == 1


def test_track(spark):
    track = {"icao24": "a", "startTime": 1, "endTime": 2, "path": [[1, 2.5, -3.25, None, 10, True], [1, 2]]}
    path = parse.parse_flight_tracks(raw(spark, track)).first().path
    assert [tuple(p) for p in path] == [(1, 2.5, -3.25, None, 10.0, True), (1, 2.0, None, None, None, None)]


def metar(**properties):
    point = {"type": "Point", "coordinates": [-73.5, 40.25]}
    return {"type": "Feature", "properties": {"id": "KJFK", **properties}, "geometry": point}


def test_metar(spark):
    sent = metar(obsTime="2026-01-11T14:35:00.000Z", temp=12.5, clouds=[{"base": 46, "cover": "BKN"}])
    row = parse.parse_metar(raw(spark, sent)).first()
    assert (row.station_id, row.obs_time, row.temp, row.lat, row.lon) == ("KJFK", 1768142100, 13, 40.25, -73.5)
    stored = weather.metar_latest(parse.parse_metar(raw(spark, sent))).first()
    assert stored.clouds == '[{"base":46,"cover":"BKN"}]'


def test_metar_with_bad_time_is_dropped_from_tables(spark):
    rows = parse.parse_metar(raw(spark, metar(obsTime="bad")))
    assert rows.first().obs_time is None
    assert weather.metar_latest(rows).count() == 0 and weather.metar_history(rows).count() == 0


def sigmet(shape, coordinates):
    properties = {"icaoId": "ZNY", "seriesId": "1", "validTimeFrom": "2026-01-11T14:35:00Z"}
    return {"properties": properties, "geometry": {"type": shape, "coordinates": coordinates}}


def test_sigmet_shapes(spark):
    ring = [[10, 20], [11, 20.5], [10, 20]]
    one = weather.sigmet_by_validtime(parse.parse_sigmet(raw(spark, sigmet("Polygon", [ring])))).first()
    assert one.polygon == "[[[10.0,20.0],[11.0,20.5],[10.0,20.0]]]"
    assert one.hour_bucket == 1768140000
    many = weather.sigmet_by_validtime(parse.parse_sigmet(raw(spark, sigmet("MultiPolygon", [[ring], [ring]])))).first()
    assert many.polygon.startswith("[[[[10.0,20.0]")


def test_sigmet_without_polygon(spark):
    rows = parse.parse_sigmet(raw(spark, sigmet("Polygon", []), sigmet("Polygon", None)))
    assert weather.sigmet_by_validtime(rows).count() == 0
    assert weather.sigmet_by_validtime(rows, require_polygon=False).count() == 1


def test_split_malformed(spark):
    df = raw(spark, '{"a":7,', {"a": 7}, None, "plain", {"sensors": [1]})
    valid, malformed = messages.split_malformed(df)
    assert (valid.count(), malformed.count()) == (2, 3)
    assert tuple(messages.decoding_counts(df).first()) == (5, 2, 3)


def test_snapshot(spark):
    def state(callsign, lon=1.0, values=17):
        return (["a1", callsign, "X", 5, 6, lon, 2.0, 3.0, False, 4.0, 5.0, 6.0, [1, 2], 7.0, "1200", False, 0])[:values]

    snapshot = {"time": 100, "states": [state("UAL1   "), state(""), state("B", lon=None), state("C", values=16)]}
    found = parse.states_from_snapshot(raw(spark, snapshot), F.lit(200)).collect()
    assert sorted((r.callsign or "-", r.sensors, r.fetch_timestamp, r.ingestion_timestamp) for r in found) == [
        ("-", [1, 2], 100, 200),
        ("UAL1", [1, 2], 100, 200),
    ]
    assert found[0].on_ground is False and found[0].squawk == "1200"


def test_features_and_pages(spark):
    collection = {"type": "FeatureCollection", "features": [metar(site="A"), metar(site="B")]}
    assert sorted(r.site for r in parse.parse_metar(parse.split_features(raw(spark, collection))).collect()) == ["A", "B"]
    pages = spark.createDataFrame([([(1, "x"), (2, "y")],), ([],)], "data ARRAY<STRUCT<id: INT, name: STRING>>")
    assert parse.flatten_pages(pages).count() == 2


def test_metadata(spark):
    at = datetime.datetime(2024, 1, 1, tzinfo=datetime.timezone.utc)
    df = spark.createDataFrame([("k", "{}", "flights_raw", 3, 9, at)], messages.RAW_MESSAGE)
    tagged = messages.with_message_metadata(df)
    assert tuple(tagged.first()["_metadata"]) == ("flights_raw", 3, 9, "k", 1704067200000)
    assert parse.parse_flight_states(tagged).first()["_metadata"].offset == 9


def test_reference(spark, tmp_path):
    rows = [{"id": "7", "icao_code": " KJFK ", "latitude": "40.64", "longitude": "bad", "country_iso2": "US"}]
    (tmp_path / "airports.json").write_text(json.dumps(rows))
    row = read_reference(spark, str(tmp_path / "airports.json"), "airports", multi_line=True).first()
    assert (row.id, row.icao_code, row.latitude, row.longitude) == (7, "KJFK", 40.64, None)


def hard_elements(count):
    """Objects with braces, quotes and backslashes in their texts, nested ones, and such that look alike."""
    texts = ["", "}", '}{"', "\\\\", '\\"}', "[{},", "x" * 90, "é}\n{"]
    return [{"id": str(i), "airport_name": texts[i % 8], "more": [{"a": {"b": texts[(i + 3) % 8]}}, {}], "z": texts[i % 5]} for i in range(count)]


@pytest.mark.parametrize("block", [37, 64, 1000])
def test_array_elements(spark, tmp_path, block):
    rows = hard_elements(60)
    (tmp_path / "a.json").write_text(json.dumps(rows, ensure_ascii=False))
    (tmp_path / "b.json").write_text("[\n" + " ,\n".join(json.dumps(row, indent=1) for row in rows[:20]) + "\n]\n")
    (tmp_path / "c.json").write_text(" [] \n")
    (tmp_path / "d.json").write_text("")
    before = {name: spark.conf.get(name) for name in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", block)
        spark.conf.set("spark.sql.files.openCostInBytes", 1)
        assert spark.read.option("lineSep", "}").text(str(tmp_path)).rdd.getNumPartitions() > 5
        found = [json.loads(row.value) for row in array_elements(spark, str(tmp_path)).collect()]
        read = read_reference(spark, str(tmp_path), "airports", multi_line=True).select("id", "airport_name").collect()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    by_text = lambda items: sorted(json.dumps(item, sort_keys=True) for item in items)
    assert by_text(found) == by_text(rows + rows[:20])
    assert sorted((r.id, r.airport_name) for r in read) == sorted((int(r["id"]), r["airport_name"].strip(" ")) for r in rows + rows[:20])


def test_start_position():
    assert messages.starting_offsets("earliest") == "earliest"
    assert messages.starting_offsets('{"t":{"0":5}}')
    with pytest.raises(ValueError):
        messages.starting_offsets("middle")


def test_archive_prunes_and_does_not_repeat(spark):
    path = new_folder(spark, "archive")
    days = spark.sql("SELECT id, timestamp_seconds(1704067200 + id * 43200) AS ts FROM range(20)")
    write_archive(days, 3, path, "ts")
    write_archive(days, 3, path, "ts")
    write_archive(days.limit(0), 4, path, "ts")
    part = read_archive(spark, path, datetime.date(2024, 1, 2), datetime.date(2024, 1, 3))
    assert sorted(r.id for r in part.collect()) == [2, 3, 4, 5]
    assert {f.split("/day=")[1].split("/")[0] for f in part.inputFiles()} == {"2", "3"}
    assert read_archive(spark, path, datetime.date(2020, 1, 1), datetime.date(2020, 1, 3)).count() == 0
    assert spark.read.parquet(path).count() == 20


def test_publish(spark, tmp_path):
    df = spark.createDataFrame([("a1", 5), (None, 6)], "icao24 STRING, firstSeen BIGINT")
    publish(to_messages(df, ["icao24", "firstSeen"]), "flight_data", "json", path=str(tmp_path / "out"))
    sent = sorted((r.key, r.value, r.topic) for r in spark.read.json(str(tmp_path / "out")).collect())
    assert sent == [("6", '{"firstSeen":6}', "flight_data"), ("a1-5", '{"icao24":"a1","firstSeen":5}', "flight_data")]
