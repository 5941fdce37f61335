import datetime
import json
import os
import time

import pytest
from pyspark.sql import functions as F

from checks import streams
from skyflow.operators import activity, positions, serving
from skyflow.sources import archive, messages, parse, schemas
from skyflow.sources.archive import read_archive
from skyflow.streaming import jobs, monitor, sinks, tables, transitions

ONCE = {"availableNow": True}


class Topic:
    """A folder of message files that a stream reads one by one, in the order they were added."""

    def __init__(self, folder, topic):
        self.folder, self.topic, self.offset, self.files = str(folder), topic, 0, 0
        os.makedirs(self.folder, exist_ok=True)

    def add(self, *values):
        lines = []
        for value in values:
            text = value if isinstance(value, str) else json.dumps(value)
            lines.append({"key": "k", "value": text, "topic": self.topic, "partition": 0, "offset": self.offset, "timestamp": "2024-01-01T00:00:00Z"})
            self.offset += 1
        path = f"{self.folder}/{self.files:04d}.json"
        with open(path, "w") as out:
            out.write("\n".join(map(json.dumps, lines)))
        os.utime(path, (1700000000 + self.files, 1700000000 + self.files))
        self.files += 1

    def read(self, spark):
        stream = messages.read_stream(
            spark, "json", self.topic, location=self.folder, position="earliest", options={"maxFilesPerTrigger": "1"}
        )
        return messages.with_message_metadata(stream)


def state(icao24, t, on_ground=False, lat=1.0, lon=1.0):
    return {"icao24": icao24, "time_position": t, "last_contact": t, "latitude": lat, "longitude": lon, "on_ground": on_ground}


def stored(spark, stream, tmp_path, keys, name="feed", order=()):
    table = tables.KeyedTable(f"{tmp_path}/{name}", keys, list(order))
    query = tables.upsert_sink(stream, table, name, f"{tmp_path}/checkpoints", ONCE)
    query.awaitTermination()
    return tables.current_view(spark, table), query


@pytest.fixture
def states(tmp_path):
    return Topic(tmp_path / "states", schemas.FLIGHT_STATES_TOPIC)


def test_late_rows_and_restart(spark, states, tmp_path, rows):
    states.add(state("a", 60), state("b", 61))
    states.add(state("a", 300))
    states.add(state("b", 300))
    states.add(state("a", 62, lat=9.0), state("b", 301))  # the first row is late by now
    states.add(state("z", 10_000))

    def minutes():
        parsed = parse.parse_flight_states(states.read(spark))
        view, query = stored(spark, positions.latest_by_minute(parsed), tmp_path, ["minute_bucket", "icao24"])
        return rows(view.select("minute_bucket", "icao24", "last_seen_ts", "lat")), query

    first, query = minutes()
    assert first == [(300, "a", 300, 1.0), (300, "b", 301, 1.0), (60, "a", 60, 1.0), (60, "b", 61, 1.0)]
    assert sum(r.late for r in monitor.batch_stats(query).collect()) == 1
    states.add(state("z", 20_000))
    again, _ = minutes()
    assert again == sorted([*first, (9960, "z", 10000, 1.0)], key=repr)


def test_distinct_counts_over_batches(spark, tmp_path, rows):
    topic = Topic(tmp_path / "info", schemas.FLIGHT_INFO_TOPIC)

    def flight(icao24, t, airport):
        return {"icao24": icao24, "firstSeen": t, "lastSeen": t, "estDepartureAirport": airport}

    topic.add(flight("x", 10, "A"), flight("x", 20, "A"), flight("y", 30, "B"))
    topic.add(flight("x", 40, "B"), flight("x", 50, "A"))
    topic.add(flight("z", 50_000, "A"))
    airports = spark.createDataFrame([(1, "A", "NA"), (2, "B", "NB")], "id INT, icao_code STRING, country_iso2 STRING")
    counts = activity.departures_by_country_hour(parse.parse_flight_info(topic.read(spark)), airports, with_global=True)
    view, _ = stored(spark, counts, tmp_path, ["country_code", "hour_bucket"])
    assert rows(view) == [("GLOBAL", 0, 2), ("NA", 0, 1), ("NB", 0, 2)]


def test_transitions_over_batches(spark, states, tmp_path, rows):
    states.add(state("a", 10, True), state("a", 20, False))
    states.add(state("a", 28, False), state("a", 26, False), state("b", 40, True))
    states.add(state("b", 41, True))
    states.add(state("a", 60, True), state("a", 12, False))  # the last row is late by now
    states.add(state("a", 1000, False))
    states.add(state("z", 5000, False))
    changes = transitions.ground_transitions_stream(parse.parse_flight_states(states.read(spark)))
    view, _ = stored(spark, changes, tmp_path, ["icao24", "time"])
    assert rows(view) == [("a", 1000, "departure"), ("a", 20, "departure"), ("a", 60, "arrival")]


def test_aircraft_not_seen_are_forgotten(spark, states, tmp_path, rows):
    """State is dropped after an hour without a flag, over restarts; the first flag after that is no change."""
    states.add(state("a", 10, True), state("b", 10, True))
    states.add(state("a", 3000, False))
    states.add(state("z", 6000, True))

    def changes():
        stream = transitions.ground_transitions_stream(parse.parse_flight_states(states.read(spark)), forget_after=3600)
        view, query = stored(spark, stream, tmp_path, ["icao24", "time"])
        return rows(view), [json.loads(p.json)["stateOperators"] for p in query.recentProgress]

    assert changes()[0] == [("a", 3000, "departure")]
    states.add(state("a", 6500, True), state("b", 6500, False))
    states.add(state("z", 20_000, True))
    found, _ = changes()
    assert found == [("a", 3000, "departure"), ("a", 6500, "arrival")]
    states.add(state("z", 40_000, False))
    states.add(state("z", 60_000, False))
    found, progress = changes()
    assert found == [("a", 3000, "departure"), ("a", 6500, "arrival")]
    # Of the three aircraft the last is known, and the second of its flag that is still open.
    last = [operator for operators in progress for operator in operators if operator["operatorName"].startswith("transformWithState")][-1]
    assert last["numRowsTotal"] <= 3


def test_aircraft_share_a_state(spark, states, tmp_path, rows):
    """A bucket has many aircraft, some of which are forgotten before others; state does not grow with the aircraft."""
    names = [f"a{n}" for n in range(3000)]
    states.add(*[state(name, 10 + n % 50, True) for n, name in enumerate(names)])
    states.add(*[state(name, 3000, False) for name in names[::3]])
    states.add(state("z", 5000, True))
    states.add(*[state(name, 6000, True) for name in names[1::3]], *[state(name, 6000, True) for name in names[::3]])
    states.add(state("z", 9000, True))
    stream = transitions.ground_transitions_stream(parse.parse_flight_states(states.read(spark)), forget_after=3600)
    view, query = stored(spark, stream, tmp_path, ["icao24", "time"])
    expected = [(name, 3000, "departure") for name in names[::3]] + [(name, 6000, "arrival") for name in names[::3]]
    assert rows(view) == sorted(expected, key=repr)
    progress = [json.loads(p.json)["stateOperators"] for p in query.recentProgress]
    states_of = [o["numRowsTotal"] for operators in progress for o in operators if o["operatorName"].startswith("transformWithState")]
    assert 0 < max(states_of) <= 3 * transitions.BUCKETS


def batch_of(spark, *tuples):
    return spark.createDataFrame(list(tuples), "k STRING, t INT, v STRING")


def test_keyed_table(spark, tmp_path, rows):
    table = tables.KeyedTable(str(tmp_path / "t"), ["k"], ["t"], hidden=["t"], ttl_seconds=100)

    def append(batch_id, *tuples):
        tables.append_changes(table, batch_of(spark, *tuples), batch_id)

    append(0, ("a", 5, "a5"), ("a", 4, "a4"), ("b", 1, "b1"))
    append(1, ("a", 3, "a3"), ("b", 1, "b1 again"))
    append(1, ("a", 3, "a3"), ("b", 1, "b1 again"))
    expected = [("a", "a5"), ("b", "b1 again")]
    assert rows(tables.current_view(spark, table)) == expected
    tables.compact(spark, table)
    assert rows(tables.current_view(spark, table)) == expected
    append(2, ("c", 1, "c1"), ("a", 4, "a4"))
    log = f"{table.path}/log/writer=none"
    os.makedirs(f"{log}/batch_id=3")  # a batch that was not finished
    assert rows(tables.current_view(spark, table)) == [*expected, ("c", "c1")]
    tables.vacuum(spark, table)
    assert sorted(os.listdir(log)) == ["batch_id=2", "batch_id=3"]
    tables.compact(spark, table)
    tables.vacuum(spark, table)
    assert rows(tables.current_view(spark, table)) == [*expected, ("c", "c1")]
    assert os.listdir(f"{table.path}/state") == ["through=1"] and not os.path.exists(f"{log}/batch_id=2")
    append(2, ("c", 1, "c1"), ("a", 4, "a4"))  # the batch runs again after it was merged
    assert rows(tables.current_view(spark, table)) == [*expected, ("c", "c1")]
    now = int(time.time())
    assert tables.current_view(spark, table, now + 200).count() == 0
    tables.compact(spark, table, now + 200)
    tables.vacuum(spark, table)
    assert rows(tables.current_view(spark, table, now + 200)) == [] and os.listdir(f"{table.path}/base") == []
    append(4, ("d", 1, "d1"))
    assert rows(tables.current_view(spark, table)) == [("d", "d1")]


def files_of(table):
    """Data files of the base by bucket and slot."""
    found = {}
    for folder, _, names in os.walk(f"{table.path}/base"):
        if "slot=" in folder:
            place = tuple(int(x.split("=")[1]) for x in folder.split("/")[-2:])
            found.setdefault(place, set()).update(f"{folder}/{n}" for n in names if n.endswith(".parquet"))
    return found


def test_compaction_rewrites_only_what_the_log_touched(spark, tmp_path, rows):
    table = tables.KeyedTable(str(tmp_path / "t"), ["k"], ["t"], hidden=["t"], buckets=8)
    everything = spark.range(500).select(F.concat(F.lit("k"), "id").alias("k"), F.lit(1).alias("t"), F.lit("old").alias("v"))
    tables.append_changes(table, everything, 0)
    tables.compact(spark, table)
    before = files_of(table)
    assert set(before) == {(b, 0) for b in range(8)}
    tables.append_changes(table, batch_of(spark, ("k7", 2, "new")), 1)
    tables.compact(spark, table)
    tables.vacuum(spark, table)
    after = files_of(table)
    assert [place for place in before if before[place] != after[place]] == [(bucket(spark, table, "k7"), 0)]
    found = dict(rows(tables.current_view(spark, table)))
    assert len(found) == 500 and {k for k, v in found.items() if v == "new"} == {"k7"}
    # One key is read from one bucket.
    view = tables.key_view(spark, table, ["k7", "nowhere"])
    assert rows(view) == [("k7", "new")] and len(view.inputFiles()) < len(tables.current_view(spark, table).inputFiles())
    tables.compact(spark, table)  # nothing new: no further state
    assert os.listdir(f"{table.path}/state") == ["through=1"]


def bucket(spark, table, key):
    return spark.range(1).select(tables.bucket_of(table, F.lit(key))).first()[0]


def test_expiry_drops_parts_and_rewrites_nothing(spark, tmp_path, rows):
    table = tables.KeyedTable(str(tmp_path / "t"), ["k"], ["t"], hidden=["t"], ttl_seconds=800, buckets=4, slots=8)
    for n in range(8):
        tables.append_changes(table, batch_of(spark, (f"k{n}", 1, "v"), ("same", n, f"v{n}")), n, written_at=1000 + 100 * n)
        tables.compact(spark, table, 1000 + 100 * n)
    tables.vacuum(spark, table)
    before = files_of(table)
    assert {slot for _, slot in before} == set(range(10, 18))
    now = 1000 + 800 + 300
    expected = [*((f"k{n}", "v") for n in range(4, 8)), ("same", "v7")]
    assert rows(tables.current_view(spark, table, now)) == expected
    tables.compact(spark, table, now)
    tables.vacuum(spark, table)
    after = files_of(table)
    assert {slot for _, slot in after} == set(range(13, 18)) and all(before[place] == files for place, files in after.items())
    assert rows(tables.current_view(spark, table, now)) == expected


def test_two_writers_compact_at_the_same_time(spark, tmp_path, rows, monkeypatch):
    table = tables.KeyedTable(str(tmp_path / "t"), ["k"], ["t"], hidden=["t"])
    tables.append_changes(table, batch_of(spark, ("a", 1, "a1")), 0, "one")
    tables.compact(spark, table)
    tables.append_changes(table, batch_of(spark, ("b", 1, "b1")), 1, "one")
    seen = tables._state(spark, table, None)
    tables.append_changes(table, batch_of(spark, ("c", 1, "c1")), 0, "two")
    tables.compact(spark, table)
    tables.vacuum(spark, table, keep=2)
    # The other one had looked before the last batch came.
    with monkeypatch.context() as patch:
        patch.setattr(tables, "_state", lambda *_: seen)
        tables.compact(spark, table)
    expected = [("a", "a1"), ("b", "b1"), ("c", "c1")]
    assert len(os.listdir(f"{table.path}/state/through=1")) == 2
    assert rows(tables.current_view(spark, table)) == expected
    tables.append_changes(table, batch_of(spark, ("c", 2, "c2")), 1, "two")
    for _ in range(2):
        tables.compact(spark, table)
        tables.vacuum(spark, table, keep=2)
        assert rows(tables.current_view(spark, table)) == [*expected[:2], ("c", "c2")]


def test_keyed_table_with_new_checkpoint(spark, tmp_path, rows):
    table = tables.KeyedTable(str(tmp_path / "t"), ["k"], ["t"], hidden=["t"])
    for batch_id in range(3):
        tables.append_changes(table, batch_of(spark, ("a", batch_id, f"a{batch_id}")), batch_id, "one")
    tables.compact(spark, table)
    tables.append_changes(table, batch_of(spark, ("new", 0, "new")), 0, "two")
    tables.append_changes(table, batch_of(spark, ("a", 2, "late")), 1, "two")
    found = rows(tables.current_view(spark, table))
    assert [k for k, _ in found] == ["a", "new"]
    tables.compact(spark, table)
    tables.vacuum(spark, table)
    assert rows(tables.current_view(spark, table)) == found


def test_expired_folders_are_not_read(spark, tmp_path, rows):
    table = tables.KeyedTable(str(tmp_path / "t"), ["k"], ["t"], hidden=["t"], ttl_seconds=100)
    for batch_id in range(2):
        tables.append_changes(table, batch_of(spark, (f"k{batch_id}", 1, "v")), batch_id)
    marker = f"{table.path}/log/writer=none/batch_id=0/_SUCCESS"
    os.utime(marker, (1_000_000, 1_000_000))
    view = tables.current_view(spark, table)
    assert len(view.inputFiles()) == 1 and rows(view) == [("k1", "v")]


def test_sink_keeps_its_log_short(spark, states, tmp_path, rows):
    for n in range(9):
        states.add(state("a", n), state(f"b{n}", n))
    table = tables.KeyedTable(f"{tmp_path}/t", ["icao24"], ["time_position"], compact_every=2)
    parsed = parse.parse_flight_states(states.read(spark)).select("icao24", "time_position")
    tables.upsert_sink(parsed, table, "feed", f"{tmp_path}/c", ONCE).awaitTermination()
    writer = os.listdir(f"{table.path}/log")
    assert len(writer) == 1 and writer != ["writer=none"]
    assert len(os.listdir(f"{table.path}/log/{writer[0]}")) <= 4 and len(os.listdir(f"{table.path}/state")) == 2
    assert rows(tables.current_view(spark, table)) == [("a", 8), *((f"b{n}", n) for n in range(9))]


def test_archive_with_new_checkpoint(spark, tmp_path, rows):
    rows_of = lambda v: spark.createDataFrame([(v, 1704067200)], "v STRING, t BIGINT")
    for writer, value in (("one", "x"), ("two", "y"), ("two", "y")):
        sinks.write_archive(rows_of(value), 0, f"{tmp_path}/a", F.timestamp_seconds("t"), writer)
    assert rows(spark.read.parquet(f"{tmp_path}/a").select("v")) == [("x",), ("y",)]


def test_merged_days(spark, tmp_path, rows):
    path, day = f"{tmp_path}/a", datetime.date(2024, 1, 1)

    def write(batch_id, value, t=1704067200):
        sinks.write_archive(spark.createDataFrame([(value, t)], "v STRING, t BIGINT"), batch_id, path, F.timestamp_seconds("t"), "one")

    def read():
        return [v for v, in rows(read_archive(spark, path, day, day + datetime.timedelta(1)).select("v"))]

    for n in range(3):
        write(n, f"v{n}")
    write(3, "next day", 1704067200 + 86400)
    expected = ["next day", "v0", "v1", "v2"]
    # A merge that stopped before its mark has no effect.
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(type(spark), "createDataFrame", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            sinks.merge_days(spark, path, [day])
    assert read() == expected and len(archive.day_folders(spark, path, [day])[day]) == 3
    sinks.merge_days(spark, path, [day, day + datetime.timedelta(1)])
    assert read() == expected and len(archive.day_folders(spark, path, [day])[day]) == 1
    write(1, "v1")  # runs again before its folder is gone, and after
    assert read() == expected
    sinks.drop_merged(spark, path, [day])
    assert read() == expected
    write(1, "v1")
    write(4, "late")
    assert read() == ["late", *expected]
    sinks.merge_days(spark, path, [day])
    sinks.drop_merged(spark, path, [day])
    assert read() == ["late", *expected] and len(archive.day_folders(spark, path, [day])[day]) == 1
    sinks.merge_days(spark, path, [day])  # one folder: nothing to do
    assert len(os.listdir(f"{path}/_merged")) == 2


def test_routes_and_handlers(spark, tmp_path):
    for topic in ("one", "two", "three"):
        t = Topic(tmp_path / "mixed" / topic, topic)
        t.add("{}", "{}")
    stream = messages.read_topics(
        spark, "json", ["one", "two"], location=f"{tmp_path}/mixed/*", position="earliest"
    )
    seen = []
    routed = messages.route_by_topic(stream, "two")
    sinks.for_each_message_batch(
        routed, lambda batch, n: seen.extend(r["_source_topic"] for r in batch.collect()), "h", f"{tmp_path}/c", ONCE
    ).awaitTermination()
    assert seen == ["two", "two"]
    assert stream.isStreaming


def test_console(spark, states, tmp_path):
    states.add(state("a", 1))
    query = sinks.console_sink(states.read(spark).select("topic"), 5, "show", f"{tmp_path}/c", ONCE)
    query.awaitTermination()
    progress = json.loads(query.recentProgress[0].json)
    assert progress["numInputRows"] == 1 and "Console" in progress["sink"]["description"]


def test_console_brings_few_rows_to_the_driver(spark, states, tmp_path):
    states.add(*[state(f"a{n}", n) for n in range(1000)])
    query = sinks.console_sink(states.read(spark).select("topic"), 5, "show", f"{tmp_path}/c", ONCE)
    query.awaitTermination()
    progress = json.loads(query.recentProgress[0].json)
    assert progress["numInputRows"] == 1000 and progress["sink"]["numOutputRows"] == 5


def test_message_counters(spark, states, tmp_path):
    states.add(state("a", 1), "{broken")
    log = monitor.BatchLog()
    spark.streams.addListener(log)
    try:
        counted = monitor.with_message_counters(states.read(spark))
        query = sinks.for_each_message_batch(counted, lambda batch, n: batch.count(), "count", f"{tmp_path}/c", ONCE)
        query.awaitTermination()
        line = monitor.batch_stats(query).first()
        assert (line.consumed, line.processed, line.failed, line.ok) == (2, 1, 1, True)
        for _ in range(50):
            if log.lines:
                break
            time.sleep(0.1)
        assert log.table(spark).first().failed == 1
        log.store(spark, f"{tmp_path}/log")
        assert not log.lines and spark.read.parquet(f"{tmp_path}/log").first().failed == 1
    finally:
        spark.streams.removeListener(log)


def test_messages_are_decoded_once_to_be_counted_and_split(spark, tmp_path, monkeypatch, rows):
    """All counters share one decoding, and the archives split messages by what it found."""
    optimized = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    raw = messages.with_message_metadata(
        spark.createDataFrame([("k", "{broken", schemas.METAR_TOPIC, 0, 0, datetime.datetime(2024, 1, 1))], schemas.RAW_MESSAGE)
    )
    counted = monitor.with_message_counters(raw, {schemas.METAR_TOPIC: schemas.METAR})
    assert counted.columns == raw.columns and optimized(counted).count("from_json") == 1
    Topic(tmp_path / "metar", schemas.METAR_TOPIC).add(
        {"properties": {"id": "K", "obsTime": "2024-01-01T00:00:00Z", "temp": 2}}, "{broken", {"properties": 3}
    )
    config = jobs.JobConfig(
        f"{tmp_path}/metar", f"{tmp_path}/tables", f"{tmp_path}/archive", f"{tmp_path}/checkpoints", "json", "earliest", archive_trigger=ONCE
    )
    written = {}

    def watched(batch, batch_id, path, timestamp):
        # What stands above the batch that is kept; a filter below a parser would decode again.
        written[path] = optimized(batch).split("InMemoryRelation")[0].count("from_json"), rows(batch)

    monkeypatch.setattr(jobs, "write_archive", watched)
    jobs._archives(spark, config, "archives", jobs.weather_topics()).awaitTermination()
    assert written[f"{tmp_path}/archive/weather_metar"][0] == 1 and len(written[f"{tmp_path}/archive/weather_metar"][1]) == 1
    decodings, dead = written[f"{tmp_path}/archive/dead_letters/{schemas.METAR_TOPIC}"]
    assert decodings == 0 and sorted(row[1] for row in dead) == ['{"properties": 3}', "{broken"]
    assert all(len(row) == 6 for row in dead)


def test_flight_job_does_not_look_up_rows_to_count_its_states(spark, tmp_path, monkeypatch):
    """Its queries start with the count switched off; the session's own setting is as before."""
    setting, seen = "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows", {}
    note = lambda config, name, rows: seen.update({name: spark.conf.get(setting, None)})
    monkeypatch.setattr(jobs, "_store", note)
    monkeypatch.setattr(jobs, "_tables", lambda *args: None)
    monkeypatch.setattr(jobs, "_archives", lambda *args: None)
    monkeypatch.setattr(monitor.BatchLog, "of", lambda self, *queries: list(queries))
    os.makedirs(tmp_path / "topics")
    config = jobs.JobConfig(f"{tmp_path}/topics", f"{tmp_path}/t", f"{tmp_path}/a", f"{tmp_path}/c", "json", "earliest")
    airports = spark.createDataFrame([(1, "A", "NA")], "id INT, icao_code STRING, country_iso2 STRING")
    places = spark.createDataFrame([(1, 0.0, 0.0, "GH")], "id BIGINT, lat DOUBLE, lon DOUBLE, country STRING")
    try:
        for before in (None, "true"):
            spark.conf.unset(setting) if before is None else spark.conf.set(setting, before)
            own = spark.conf.get(setting, None)
            jobs.run_flight_job(spark, config, airports, places)
            assert len(seen) == 4 and set(seen.values()) == {"false"} and spark.conf.get(setting, None) == own
    finally:
        spark.conf.unset(setting)
        config.log.leave(spark)


def test_lag_of_every_batch_is_stored(spark, tmp_path, rows):
    log = monitor.BatchLog()
    for number, name in enumerate(["mine", "other", "mine"]):
        source = {"endOffset": {"t": {"0": 5, "1": 7}}, "latestOffset": {"t": {"0": 20005, "1": 7}}, "numInputRows": 3}
        log.take({"name": name, "batchId": number, "sources": [source, {"endOffset": {"logOffset": 1}, "numInputRows": 1}]})
    log.names.add("mine")
    assert log.lag(spark).count() == 4
    log.store(spark, f"{tmp_path}/log")
    found = rows(spark.read.parquet(f"{tmp_path}/log-lag").filter("batch_id = 2"))
    assert found == [("mine", 2, "t", 0, 5, 20005, 20000, False), ("mine", 2, "t", 1, 7, 7, 0, True)]
    assert rows(spark.read.parquet(f"{tmp_path}/log").select("query", "batch_id", "consumed")) == [("mine", 0, 4), ("mine", 2, 4)]
    assert not log.lines and not log.behind


def test_lag(spark, rows):
    progress = {"sources": [{"endOffset": {"t": {"0": 5, "1": 7}}, "latestOffset": '{"t": {"0": 20005, "1": 7}}'}]}
    assert rows(monitor.stream_lag(spark, progress)) == [("t", 0, 5, 20005, 20000, False), ("t", 1, 7, 7, 0, True)]


def test_flight_and_weather_jobs(spark, tmp_path, rows):
    source = tmp_path / "topics"
    Topic(source / "a", schemas.FLIGHT_STATES_TOPIC).add(state("a", 100), state("a", 90, lat=5.0), state("b", 90_000), "{broken", '{"time_position": "abc"}')
    Topic(source / "b", schemas.FLIGHT_INFO_TOPIC).add(
        {"icao24": "a", "firstSeen": 10, "lastSeen": 20, "estDepartureAirport": "A", "estArrivalAirport": "B"},
        {"icao24": "b", "firstSeen": 10**6, "lastSeen": 10**6},
    )
    Topic(source / "c", schemas.FLIGHT_TRACKS_TOPIC).add(
        {"icao24": "a", "startTime": 1, "endTime": 3, "callsign": "X", "path": [[1, 1, 1, 1, 1, True], [3, 1, 1, 1, 1, False]]}
    )
    point = {"type": "Point", "coordinates": [1, 2]}
    Topic(source / "d", schemas.METAR_TOPIC).add(
        {"properties": {"id": "K", "obsTime": "2024-01-01T02:00:00Z", "temp": 2}, "geometry": point},
        {"properties": {"id": "K", "obsTime": "2024-01-01T01:00:00Z", "temp": 1}, "geometry": point},
    )
    Topic(source / "e", schemas.TAF_TOPIC).add(
        {"properties": {"id": "K", "issueTime": "2024-01-01T00:00:00Z", "validTimeFrom": "2024-01-01T00:00:00Z", "timeGroup": 0}}
    )
    Topic(source / "f", schemas.SIGMET_TOPIC).add(
        {
            "properties": {"icaoId": "Z", "validTimeFrom": "2030-01-01T00:00:00Z"},
            "geometry": {"type": "Polygon", "coordinates": [[[1, 2], [3, 4], [1, 2]]]},
        }
    )
    config = jobs.JobConfig(
        f"{source}/*", f"{tmp_path}/tables", f"{tmp_path}/archive", f"{tmp_path}/checkpoints", "json", "earliest",
        table_trigger=ONCE, archive_trigger=ONCE, console_rows=5, dead_letters=f"{tmp_path}/dead",
    )
    airports = spark.createDataFrame([(1, "A", "NA"), (2, "B", "NB")], "id INT, icao_code STRING, country_iso2 STRING")
    places = spark.createDataFrame([(1, 0.0, 0.0, "GH"), (2, 50.0, 100.0, "MN")], "id BIGINT, lat DOUBLE, lon DOUBLE, country STRING")
    queries = jobs.run_flight_job(spark, config, airports, places) + jobs.run_weather_job(spark, config)
    jobs.await_all(spark, config)
    config.log.leave(spark)
    assert len(queries) == 9 and len({q.name for q in queries}) == 9 and not any(q.exception() for q in queries)
    # One subscription feeds the tables without state, one the archives; a query with state reads its own topic.
    assert [len(q.lastProgress.sources) for q in queries] == [1] * 9

    def table(name):
        return tables.current_view(spark, jobs.table_of(config, name))

    assert rows(table("aircrafts_by_icao24")) == [("a", None, 1.0, 1.0), ("b", None, 1.0, 1.0)]
    assert table("aircraftstates_by_icao24").count() == 2
    assert rows(table("aircrafts_by_cell_minute").select("minute_bucket", "icao24")) == [(60, "a")]
    assert rows(table("activeaircraft_by_country_hour")) == [("GH", 0, 1), ("GLOBAL", 0, 1)]
    assert rows(table("departures_by_country_hour")) == [("GLOBAL", 0, 1), ("NA", 0, 1)]
    assert rows(table("arrivals_by_country_hour")) == [("GLOBAL", 0, 1), ("NB", 0, 1)]
    assert rows(table("metar_latest_by_station").select("temp")) == [(2,)]
    assert table("metar_history_by_station").count() == 2
    assert table("sigmet_by_validtime").count() == 1 and table("taf_by_station").count() == 1
    observed = spark.read.parquet(f"{tmp_path}/archive/weather_metar")
    assert rows(observed.select("year", "month", "day", "temp")) == [(2024, 1, 1, 1), (2024, 1, 1, 2)]
    assert spark.read.parquet(f"{tmp_path}/archive/flight_tracks").count() == 1
    assert spark.read.parquet(f"{tmp_path}/archive/flight_raw").count() == 3
    dead = spark.read.parquet(f"{tmp_path}/dead/{schemas.FLIGHT_STATES_TOPIC}")
    assert sorted(r.value for r in dead.collect()) == ['{"time_position": "abc"}', "{broken"]
    log = spark.read.parquet(config.batch_log)
    assert {r["query"] for r in log.select("query").collect()} == {q.name for q in queries}
    line = log.filter("query = 'flight_archives'").agg(*[F.sum(c) for c in ("consumed", "processed", "failed")]).first()
    assert tuple(line) == (8, 6, 2)
    assert log.filter("query = 'weather_tables'").agg(F.sum("consumed")).first()[0] == 4


def test_key_conditions_reach_the_files(spark, tmp_path):
    table = tables.KeyedTable(str(tmp_path / "w"), ["hour_bucket", "icao_id"], ["ingest"], hidden=["ingest"])
    rows = spark.range(100).selectExpr(
        "id * 3600 AS hour_bucket", "'Z' AS icao_id", "id * 3600 AS valid_from", "id * 3600 + 7200 AS valid_to", "id AS ingest"
    )
    tables.append_changes(table, rows, 0)
    tables.compact(spark, table)
    tables.append_changes(table, rows.filter("ingest > 90"), 1)
    active = serving.active_sigmets(tables.current_view(spark, table), 36000)
    plan = active._jdf.queryExecution().executedPlan().toString()
    pushed = [part.split("]")[0] for part in plan.split("PushedFilters: [")[1:]]
    assert len(pushed) == 2 and all("hour_bucket" in conditions for conditions in pushed)
    assert active.count() == 3


def test_steps_of_several_files_are_one_batch_each(spark, tmp_path, monkeypatch):
    """A step has as many files as its rows need, one of them at least empty here, and is one micro-batch in order."""
    monkeypatch.setattr(streams, "FILE_BYTES", 1)
    monkeypatch.setattr(streams, "estimated_bytes", lambda rows: 7)

    def made(spark, sf_dir):
        return spark.range(0, 40, 1, 8).filter("id < 3 OR id > 30").select(
            F.col("id").cast("string").alias("key"), F.lit("{}").alias("value"), F.lit("t").alias("topic"),
            F.lit(0).alias("partition"), F.col("id").alias("offset"), F.timestamp_seconds("id").alias("timestamp"),
        )

    seen = []
    stream = streams.stream_of(spark, "", made, "t")
    handle = lambda batch, n: seen.append(sorted(r["offset"] for r in batch.collect()))
    sinks.for_each_message_batch(stream, handle, "h", f"{tmp_path}/c", ONCE).awaitTermination()
    assert seen == [[0, 1, 2], [], [], [*range(31, 40)]]
