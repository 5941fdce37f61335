"""Streaming queries: messages are written as files, read as a stream to the end, and the result is compared."""

from __future__ import annotations

import datetime
import time
from contextlib import contextmanager

from pyspark.sql import functions as F

from checks import fixtures, inputs
from checks.flights import (
    ACTIVE,
    AIRCRAFT,
    AIRLINE_BY_CODE,
    ARRIVALS,
    ARRIVING,
    BY_MINUTE,
    DENSITY,
    DEPARTURES,
    LEAVING,
    LOCATED,
    METAR_HISTORY,
    METAR_LATEST,
    SIGMETS,
    SKETCH_ERROR,
    TAFS,
    TRANSITIONS,
    closely,
    counted,
    with_exact,
    with_global,
)
from checks.parsing import AIRPORTS, INFO, METAR, SIGMET, STATES, TAF, WAYPOINT_FIELDS, WAYPOINTS
from checks.registry import query
from skyflow.operators import activity, enrich, positions, weather
from skyflow.plans.joins import estimated_bytes
from skyflow.plans.staging import new_folder, remove, staged
from skyflow.sources import messages, parse, schemas
from skyflow.sources.archive import day_folders, read_archive
from skyflow.streaming import jobs, monitor, sinks, tables, transitions

ONCE = {"availableNow": True}


#: Steps a stream reads one after another, each in a micro-batch of its own.
FILES = 4
#: Stored messages for each file of a step; a file has no more of them even if one step has all.
FILE_BYTES = 32 * 1024 * 1024


def in_order(df, by, files=FILES):
    """``df`` with the step its rows go to, by the place of ``by`` between its least and greatest value."""
    low, high = df.agg(F.min(by), F.max(by)).first()
    return df.withColumn("_file", F.floor((by - F.lit(low)) * files / F.lit((high or 0) - (low or 0) + 1)))


def files_per_step(rows):
    """Files that every step of the staged ``rows`` is written to, so that no task holds a whole step."""
    return max(1, -(-estimated_bytes(rows) // FILE_BYTES))


def write_files(rows, folder, numbers, files):
    """Messages with a column ``_file``, all topics together: a folder of so many files per number, one after another.

    A micro-batch takes as many files as a step has, so a step with fewer gets empty ones.
    """
    for number in numbers:
        path = f"{folder}/{number}"
        part = rows.filter(F.col("_file") == number).drop("_file")
        (part.repartition(files) if files > 1 else part.coalesce(1)).write.parquet(path)
        for _ in range(files - len(rows.sparkSession.read.schema(part.schema).parquet(path).inputFiles())):
            part.limit(0).coalesce(1).write.mode("append").parquet(path)


def stream_of(spark, sf_dir, made, topic, by=None):
    """Messages of one topic, written as files in the order of ``by``, by default the offset, and read back as a stream."""
    path = new_folder(spark, topic)
    rows = staged(made(spark, sf_dir), "messages")
    files = files_per_step(rows)
    write_files(in_order(rows, F.col("offset") if by is None else by), path, range(FILES), files)
    stream = messages.read_stream(
        spark, "parquet", topic, location=f"{path}/*", position="earliest", options={"maxFilesPerTrigger": str(files)}
    )
    return messages.with_message_metadata(stream)


def first_seen():
    return F.get_json_object("value", "$.firstSeen").cast("long")


def in_time(source: str, clock: str, end: str, delay: int, by: str = "seq", where: str = "true") -> str:
    """SQL for the rows of ``source`` that are not too late for the window that ends at ``end``.

    Rows come in the files that ``in_order`` makes of ``by``. A micro-batch drops rows whose window
    had ended by the watermark of the micro-batch before, which had seen all files before its own.
    """
    return f"""(SELECT * EXCLUDE (_file, _seen) FROM (
        SELECT *, max(_newest) OVER (ORDER BY _file RANGE BETWEEN UNBOUNDED PRECEDING AND 2 PRECEDING) AS _seen FROM (
            SELECT *, max({clock}) OVER (PARTITION BY _file) AS _newest FROM (
                SELECT *, ({by} - min({by}) OVER ()) * {FILES} // (max({by}) OVER () - min({by}) OVER () + 1) AS _file
                FROM {source}) f WHERE {where}) n) m
        WHERE _seen IS NULL OR {clock} IS NULL OR {end} > _seen - {delay})"""


@contextmanager
def few_partitions(spark):
    """A stream keeps the number of state partitions it started with; on one machine, one per core."""
    setting = "spark.sql.shuffle.partitions"
    before = spark.conf.get(setting)
    if spark.sparkContext.master.startswith("local"):
        spark.conf.set(setting, spark.sparkContext.defaultParallelism)
    try:
        yield
    finally:
        spark.conf.set(setting, before)


def stored(spark, stream, keys, order=(), hidden=()):
    """Run a stream into a keyed table until its input ends, and return the table."""
    table = tables.KeyedTable(new_folder(spark, "table"), list(keys), list(order), list(hidden))
    with few_partitions(spark):
        tables.upsert_sink(stream, table, "feed", new_folder(spark, "checkpoint"), ONCE).awaitTermination()
    return tables.current_view(spark, table)


def state_stream(spark, sf_dir):
    return parse.parse_flight_states(stream_of(spark, sf_dir, fixtures.flight_state_messages, schemas.FLIGHT_STATES_TOPIC))


def info_stream(spark, sf_dir):
    """Flights in the order they were first seen; their offsets have nothing to do with time."""
    return parse.parse_flight_info(
        stream_of(spark, sf_dir, fixtures.flight_info_messages, schemas.FLIGHT_INFO_TOPIC, first_seen())
    )


def with_ingest(df):
    return df.withColumn("ingest", F.col("_metadata.offset")).drop("_metadata")


def closed(result: str, rows: str, bucket: str, width: int, delay: int, clock: str, by: str = "seq", where: str = "true") -> str:
    """SQL for the windows of ``result``, made of ``rows``, that a watermark has passed, without late rows."""
    end = f"{clock} // {width} * {width} + {width}" if width > 1 else f"{clock} + 1"
    kept = in_time(rows, clock, end, delay, by, where)
    return (
        f"SELECT * FROM {result.replace(rows, kept)} "
        f"WHERE {bucket} + {width} <= (SELECT max({clock}) FROM {rows} WHERE {where}) - {delay}"
    )


def at_once(result: str, rows: str, bucket: str, width: int, delay: int, clock: str) -> str:
    """SQL for the windows that a watermark has passed, where no row comes late."""
    return f"SELECT * FROM {result} WHERE {bucket} + {width} <= (SELECT max({clock}) FROM {rows}) - {delay}"


@query("s7_read_stream", f"""SELECT icao24 AS key, seq AS "offset" FROM {STATES}""")
def s7(spark, sf_dir):
    stream = stream_of(spark, sf_dir, fixtures.flight_state_messages, schemas.FLIGHT_STATES_TOPIC)
    return stored(spark, stream.select("key", "offset"), ["offset"])


@query("a1_stream_latest_by_minute", closed(BY_MINUTE, STATES, "minute_bucket", 60, 10, "time_position"))
def a1_stream(spark, sf_dir):
    return stored(spark, positions.latest_by_minute(state_stream(spark, sf_dir)), ["minute_bucket", "icao24"])


@query("a2_stream_active_by_country_hour", closed(ACTIVE, STATES, "hour_bucket", 3600, 600, "time_position"))
def a2_stream(spark, sf_dir):
    counts = activity.active_by_country_hour(state_stream(spark, sf_dir), inputs.place_index(spark, sf_dir))
    return stored(spark, counts, ["country_code", "hour_bucket"])


@query(
    "a3_stream_departures_from_sketches",
    closely(
        counted(
            "(SELECT * FROM "
            + with_global("(" + closed(f"(SELECT *, firstSeen // 60 * 60 AS minute FROM {LEAVING})", INFO, "minute", 60, 86400, "firstSeen", "firstSeen") + ")")
            + ")",
            "firstSeen",
            "departures_cnt",
        )
    ),
)
def a3_stream_sketches(spark, sf_dir):
    """Sketches of closed minutes, fed into a table by a stream; hours are rolled up from the table."""
    airports = inputs.airports(spark, sf_dir)
    sketches = activity.departure_sketches(info_stream(spark, sf_dir), airports, delay="24 hours")
    table = stored(spark, sketches, ["country_code", "minute_bucket"])
    near = activity.counts_from_sketches(table, ["country_code"], "departures_cnt", with_global=True)
    info = inputs.info(spark, sf_dir)
    last = info.agg(F.max("firstSeen")).first()[0] - 86400
    ended = info.filter(F.floor(F.col("firstSeen") / 60) * 60 + 60 <= last)
    exact = activity.departures_by_country_hour(ended, airports, with_global=True)
    return with_exact(near, exact, "departures_cnt", SKETCH_ERROR)


@query(
    "a5_stream_departures_with_global",
    closed(counted(with_global(LEAVING), "firstSeen", "departures_cnt"), INFO, "hour_bucket", 3600, 600, "firstSeen", "firstSeen"),
)
def a5_stream(spark, sf_dir):
    counts = activity.departures_by_country_hour(
        info_stream(spark, sf_dir), inputs.airports(spark, sf_dir), with_global=True
    )
    return stored(spark, counts, ["country_code", "hour_bucket"])


@query(
    "a3_stream_departures_by_country_hour",
    closed(DEPARTURES, INFO, "hour_bucket", 3600, 86400, "firstSeen", "firstSeen"),
)
def a3_stream(spark, sf_dir):
    counts = activity.departures_by_country_hour(
        info_stream(spark, sf_dir), inputs.airports(spark, sf_dir), delay="24 hours"
    )
    return stored(spark, counts, ["country_code", "hour_bucket"])


@query("a4_stream_arrivals_by_country_hour", closed(ARRIVALS, INFO, "hour_bucket", 3600, 600, "lastSeen", "firstSeen"))
def a4_stream(spark, sf_dir):
    counts = activity.arrivals_by_country_hour(info_stream(spark, sf_dir), inputs.airports(spark, sf_dir))
    return stored(spark, counts, ["country_code", "hour_bucket"])


@query(
    "a6_stream_traffic_density",
    closed(DENSITY, STATES, "minute_bucket", 60, 10, "time_position", where="latitude IS NOT NULL"),
)
def a6_stream(spark, sf_dir):
    density = activity.traffic_density_by_cell_minute(state_stream(spark, sf_dir), 5.0)
    return stored(spark, density, ["cell_lat", "cell_lon", "minute_bucket"])


@query("a9_stream_ground_transitions", closed(TRANSITIONS, STATES, "time", 1, 10, "time_position"))
def a9_stream(spark, sf_dir):
    return stored(spark, transitions.ground_transitions_stream(state_stream(spark, sf_dir)), ["icao24", "time"])


#: Days without a flag after which an aircraft is forgotten, and the changes then: a first flag after a gap is none.
GAP = 2 * 86400
SHORT_MEMORY = TRANSITIONS.replace(
    "WHERE before <> on_ground", f"WHERE before <> on_ground AND time_position - last_seen <= {GAP}"
).replace("AS before", "AS before, lag(time_position) OVER (PARTITION BY icao24 ORDER BY time_position) AS last_seen")


@query("a9_stream_restart", at_once(SHORT_MEMORY, STATES, "time", 1, 10, "time_position"))
def a9_restart(spark, sf_dir):
    """Half of the time read, the query started again over the other half; aircraft are forgotten after two days."""
    folder, checkpoint = new_folder(spark, "topics"), new_folder(spark, "checkpoint")
    made = staged(fixtures.flight_state_messages(spark, sf_dir), "states")
    rows = staged(in_order(made, F.get_json_object("value", "$.last_contact").cast("long")), "states")
    files = files_per_step(rows)
    table = tables.KeyedTable(new_folder(spark, "table"), ["icao24", "time"])
    with few_partitions(spark):
        for numbers in (range(2), range(2, FILES)):
            write_files(rows, folder, numbers, files)
            stream = messages.read_stream(
                spark, "parquet", schemas.FLIGHT_STATES_TOPIC, location=f"{folder}/*", position="earliest", options={"maxFilesPerTrigger": str(files)}
            )
            states = parse.parse_flight_states(messages.with_message_metadata(stream))
            changes = transitions.ground_transitions_stream(states, forget_after=GAP)
            tables.upsert_sink(changes, table, "feed", checkpoint, ONCE).awaitTermination()
    return tables.current_view(spark, table)


@query("k1_upsert_sink_metar_latest", f"SELECT * FROM {METAR_LATEST}")
def k1(spark, sf_dir):
    metar = parse.parse_metar(stream_of(spark, sf_dir, fixtures.metar_messages, schemas.METAR_TOPIC))
    return stored(spark, with_ingest(weather.metar_latest_rows(metar)), ["station_id"], ["obs_time", "ingest"], ["ingest"])


@query("k1_upsert_sink_metar_history", f"SELECT * FROM {METAR_HISTORY}")
def k1_history(spark, sf_dir):
    metar = parse.parse_metar(stream_of(spark, sf_dir, fixtures.metar_messages, schemas.METAR_TOPIC))
    keys = schemas.TABLE_KEYS["metar_history_by_station"]
    return stored(spark, with_ingest(weather.metar_history_rows(metar)), keys, ["ingest"], ["ingest"])


@query("k1_upsert_sink_sigmet", f"SELECT * FROM {SIGMETS}")
def k1_sigmet(spark, sf_dir):
    sigmet = parse.parse_sigmet(stream_of(spark, sf_dir, fixtures.sigmet_messages, schemas.SIGMET_TOPIC))
    keys = schemas.TABLE_KEYS["sigmet_by_validtime"]
    return stored(spark, with_ingest(weather.sigmet_rows(sigmet)), keys, ["ingest"], ["ingest"])


@query("k1_upsert_sink_aircraft", f"SELECT * FROM {AIRCRAFT}")
def k1_aircraft(spark, sf_dir):
    flights = with_ingest(state_stream(spark, sf_dir))
    current = flights.select(
        "icao24", "callsign", F.col("latitude").alias("lat"), F.col("longitude").alias("lon"), "time_position", "ingest"
    )
    return stored(spark, current, ["icao24"], ["time_position", "ingest"], ["time_position", "ingest"])


@query("k1_upsert_sink_taf", f"SELECT * FROM {TAFS}")
def k1_taf(spark, sf_dir):
    taf = parse.parse_taf(stream_of(spark, sf_dir, fixtures.taf_messages, schemas.TAF_TOPIC))
    keys = schemas.TABLE_KEYS["taf_by_station"]
    return stored(spark, with_ingest(weather.taf_rows(taf)), keys, ["ingest"], ["ingest"])


@query("k1_upsert_sink_tracks", f"SELECT {WAYPOINT_FIELDS} FROM {WAYPOINTS} QUALIFY row_number() OVER (PARTITION BY icao24, starttime, time ORDER BY seq DESC) = 1")
def k1_tracks(spark, sf_dir):
    tracks = parse.parse_flight_tracks(stream_of(spark, sf_dir, fixtures.flight_track_messages, schemas.FLIGHT_TRACKS_TOPIC))
    keys = schemas.TABLE_KEYS["aircraftstates_by_icao24"]
    return stored(spark, with_ingest(positions.track_waypoints(tracks)), keys, ["ingest"], ["ingest"])


@query(
    "k2_archive_sink",
    f"""SELECT station_id, obs_time, raw_ob, CAST(year(t) AS INTEGER) AS year, CAST(month(t) AS INTEGER) AS month,
        CAST(day(t) AS INTEGER) AS day FROM (SELECT *, to_timestamp(obs_time) AT TIME ZONE 'UTC' AS t FROM {METAR})
        WHERE t >= TIMESTAMP '2024-01-10' AND t < TIMESTAMP '2024-01-20'""",
)
def k2(spark, sf_dir):
    path, checkpoint = new_folder(spark, "archive"), new_folder(spark, "checkpoint")
    metar = parse.parse_metar(stream_of(spark, sf_dir, fixtures.metar_messages, schemas.METAR_TOPIC)).drop("_metadata")
    sinks.archive_sink(metar, path, "timestamp", "archive", checkpoint, ONCE).awaitTermination()
    days = read_archive(spark, path, datetime.date(2024, 1, 10), datetime.date(2024, 1, 19))
    return days.select("station_id", "obs_time", "raw_ob", "year", "month", "day")


@query("k1_upsert_sink_new_checkpoint", f"SELECT * FROM {METAR_HISTORY}")
def k1_new_checkpoint(spark, sf_dir):
    """Halves of the messages fed by two queries with checkpoints of their own, compacted in between."""
    keys = schemas.TABLE_KEYS["metar_history_by_station"]
    table = tables.KeyedTable(new_folder(spark, "table"), keys, ["ingest"], ["ingest"], compact_every=2)
    for half in (0, 1):

        def made(spark, sf_dir, half=half):
            return fixtures.metar_messages(spark, sf_dir).filter(F.col("offset") % 2 == half)

        metar = parse.parse_metar(stream_of(spark, sf_dir, made, schemas.METAR_TOPIC))
        rows = with_ingest(weather.metar_history_rows(metar))
        tables.upsert_sink(rows, table, f"feed_{half}", new_folder(spark, "checkpoint"), ONCE).awaitTermination()
        if half == 0:
            tables.compact(spark, table)
            tables.vacuum(spark, table)
    return tables.current_view(spark, table)


@query("k2_archive_new_checkpoint", f"""SELECT seq AS "offset", station_id, raw_ob FROM {METAR}""")
def k2_new_checkpoint(spark, sf_dir):
    """Halves of the messages archived by two queries with checkpoints of their own."""
    path = new_folder(spark, "archive")
    for half in (0, 1):

        def made(spark, sf_dir, half=half):
            return fixtures.metar_messages(spark, sf_dir).filter(F.col("offset") % 2 == half)

        metar = parse.parse_metar(stream_of(spark, sf_dir, made, schemas.METAR_TOPIC))
        rows = metar.withColumn("offset", F.col("_metadata.offset")).drop("_metadata")
        sinks.archive_sink(rows, path, "timestamp", "archive", new_folder(spark, "checkpoint"), ONCE).awaitTermination()
    return spark.read.parquet(path).select("offset", "station_id", "raw_ob")


def metar_archive(spark, sf_dir):
    """The observations archived in ten batches, as a path."""
    path = new_folder(spark, "archive")
    metar = staged(parse.parse_metar(messages.with_message_metadata(fixtures.metar_messages(spark, sf_dir))), "metar")
    for number in range(10):
        batch = metar.filter(F.col("_metadata.offset") % 10 == number).drop("_metadata")
        sinks.write_archive(batch, number, path, "timestamp", "feed")
    return path


DAYS = [datetime.date(2024, 1, 10) + datetime.timedelta(n) for n in range(10)]


@query(
    "k2_archive_merged",
    f"""SELECT stage, station_id, obs_time, raw_ob, CASE WHEN stage = 'after' THEN 1 ELSE 0 END AS merged
        FROM {METAR}, (SELECT unnest(['before', 'during', 'after', 'late']) AS stage) s
        WHERE to_timestamp(obs_time) AT TIME ZONE 'UTC' >= TIMESTAMP '2024-01-10'
        AND to_timestamp(obs_time) AT TIME ZONE 'UTC' < TIMESTAMP '2024-01-20' AND (stage <> 'late' OR seq % 10 = 3)""",
)
def k2_merged(spark, sf_dir):
    """Ten days read before a merge, with merged and replaced folders side by side, and after the replaced ones are gone.

    ``merged`` tells that a day is one folder. Late rows are a batch that runs once more, which must not count again, and one
    that is new: it has the rows of batch 3.
    """
    path = metar_archive(spark, sf_dir)
    read = lambda: read_archive(spark, path, DAYS[0], DAYS[-1]).select("station_id", "obs_time", "raw_ob")
    seen = {"before": staged(read(), "seen")}
    sinks.merge_days(spark, path, DAYS)
    seen["during"] = staged(read(), "seen")
    sinks.drop_merged(spark, path, DAYS)
    seen["after"] = staged(read(), "seen")
    one = all(len(found) == 1 for found in day_folders(spark, path, DAYS).values())
    again = parse.parse_metar(messages.with_message_metadata(fixtures.metar_messages(spark, sf_dir)))
    third = again.filter(F.col("_metadata.offset") % 10 == 3).drop("_metadata")
    sinks.write_archive(third, 3, path, "timestamp", "feed")
    sinks.write_archive(third, 11, path, "timestamp", "feed")
    seen["late"] = read().exceptAll(seen["after"])
    found = None
    for stage, rows in seen.items():
        merged = F.lit(int(stage == "after" and one))
        part = rows.select(F.lit(stage).alias("stage"), "station_id", "obs_time", "raw_ob", merged.alias("merged"))
        found = part if found is None else found.unionByName(part)
    return found


# --- Tables that live long: what a compaction rewrites, what a key reads, what expiry drops.

def bucket_sql(key: str, buckets: int) -> str:
    """SQL for ``tables.bucket_of``."""
    return f"CAST(('0x' || substr(md5({key}), 1, 7))::BIGINT % {buckets} AS INTEGER)"


def part_files(spark, table):
    """Rows (bucket, files) of the state in force: names of the data files of each bucket."""
    rows = spark.read.parquet(*[f"{table.path}/base/{part.folder}" for part in tables.parts_in_force(spark, table)])
    named = rows.select(F.input_file_name().alias("file")).distinct()
    bucket = F.regexp_extract("file", "bucket=([0-9]+)", 1).cast("int")
    return named.groupBy(bucket.alias("bucket")).agg(F.sort_array(F.collect_set("file")).alias("files"))


SOME = "seq % 100 = 7"


@query(
    "k1_compaction_by_bucket",
    f"""SELECT {bucket_sql('icao24', 32)} AS bucket, count(*) AS aircraft,
        bool_or(icao24 IN (SELECT icao24 FROM {STATES} WHERE {SOME})) AS rewritten FROM {AIRCRAFT} GROUP BY 1""",
)
def k1_buckets(spark, sf_dir):
    """All aircraft stored and compacted, then those of one message in a hundred fed again; what the second compaction rewrote."""
    table = tables.KeyedTable(new_folder(spark, "table"), ["icao24"], ["time_position", "ingest"], ["time_position", "ingest"])
    states = with_ingest(inputs.states(spark, sf_dir)).select("icao24", "callsign", "latitude", "longitude", "time_position", "ingest")
    tables.append_changes(table, states, 0)
    tables.compact(spark, table)
    before = staged(part_files(spark, table).withColumnRenamed("files", "before"), "files")
    tables.append_changes(table, states.filter(F.col("ingest") % 100 == 7), 1)
    tables.compact(spark, table)
    after = staged(part_files(spark, table), "files")
    tables.vacuum(spark, table)
    view = tables.current_view(spark, table).select(tables.bucket_of(table, F.col("icao24")).alias("bucket"))
    counted_ = view.groupBy("bucket").agg(F.count("*").alias("aircraft"))
    same = counted_.join(before, "bucket").join(after, "bucket")
    return same.select("bucket", "aircraft", (F.col("files") != F.col("before")).alias("rewritten"))


STATIONS = ("K003", "K017", "K999")


@query(
    "q5_key_read",
    f"""SELECT station_id, obs_time, raw_ob, true AS fewer_files FROM {METAR_HISTORY} WHERE station_id IN {STATIONS}""",
)
def q5_key_read(spark, sf_dir):
    """Three stations read from the stored history: only the files of their buckets."""
    table = tables.KeyedTable(new_folder(spark, "table"), schemas.TABLE_KEYS["metar_history_by_station"], ["ingest"], ["ingest"])
    tables.append_changes(table, with_ingest(weather.metar_history_rows(inputs.metar(spark, sf_dir))), 0)
    tables.compact(spark, table)
    view, everything = tables.key_view(spark, table, [*STATIONS]), tables.current_view(spark, table)
    fewer = 0 < len(view.inputFiles()) < len(everything.inputFiles())
    return view.select("station_id", "obs_time", "raw_ob", F.lit(fewer).alias("fewer_files"))


TTL, FIRST = 259200, 1_700_000_000 // 32400 * 32400


@query(
    "w8_expired_parts",
    f"""SELECT {FIRST} // 32400 + seq % 8 AS slot, count(*) AS row_count, count(DISTINCT {bucket_sql('station_id', 16)}) AS folders,
        0::BIGINT AS rewritten FROM {METAR} WHERE seq % 8 >= 4 GROUP BY 1""",
)
def w8_expired(spark, sf_dir):
    """A history written in eight spans of time, four of which expire: rows and folders left by span, and files written anew."""
    table = tables.KeyedTable(new_folder(spark, "table"), ["station_id", "seq"], ttl_seconds=TTL, buckets=16, slots=8)
    rows = staged(fixtures.rows(spark, sf_dir, "metar").select("station_id", "seq", "raw_ob"), "rows")
    for slot in range(8):
        at = FIRST + slot * 32400 + 100
        tables.append_changes(table, rows.filter(F.col("seq") % 8 == slot), slot, written_at=at)
        tables.compact(spark, table, at)
    tables.vacuum(spark, table)
    before = {part.folder for part in tables.parts_in_force(spark, table)}
    now = FIRST + TTL + 4 * 32400
    tables.compact(spark, table, now)
    tables.vacuum(spark, table)
    left = tables.parts_in_force(spark, table)
    new = sum(part.folder not in before for part in left)
    view = tables.current_view(spark, table, now).groupBy((F.col("seq") % 8 + FIRST // 32400).alias("slot")).agg(F.count("*").alias("row_count"))
    parts = spark.createDataFrame([(part.slot, part.bucket) for part in left], "slot BIGINT, bucket INT")
    counted_ = parts.groupBy("slot").agg(F.count("*").alias("folders"))
    return view.join(counted_, "slot", "full").withColumn("rewritten", F.lit(new).cast("long"))


@query(
    "k3_to_messages",
    f"""SELECT concat(icao24, '-', firstSeen) AS key, concat('{{"icao24":"', icao24, '","firstSeen":', firstSeen,
        CASE WHEN estDepartureAirport IS NULL THEN '' ELSE concat(',"estDepartureAirport":"', estDepartureAirport, '"') END,
        ',"lastSeen":', lastSeen, '}}') AS value FROM {INFO}""",
)
def k3(spark, sf_dir):
    rows = fixtures.rows(spark, sf_dir, "flight_info").select("icao24", "firstSeen", "estDepartureAirport", "lastSeen")
    return sinks.to_messages(rows, ["icao24", "firstSeen"])


@query("k5_for_each_message_batch", f"""SELECT icao_id AS key, seq AS "offset" FROM {SIGMET}""")
def k5(spark, sf_dir):
    path = new_folder(spark, "handled")

    def handle(batch, batch_id):
        batch.select("key", "offset").write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    stream = stream_of(spark, sf_dir, fixtures.sigmet_messages, schemas.SIGMET_TOPIC)
    sinks.for_each_message_batch(stream, handle, "handler", new_folder(spark, "checkpoint"), ONCE).awaitTermination()
    return spark.read.parquet(path).drop("batch_id")


@query(
    "e1_stream_enrich_airline",
    f"""SELECT s.seq, a.airline_name, a.country_name AS airline_country, a.fleet_size AS airline_fleet_size FROM {STATES} s LEFT JOIN {AIRLINE_BY_CODE} a ON substr(s.callsign, 1, 3) = a.icao_code""",
)
def e1_stream(spark, sf_dir):
    flights = state_stream(spark, sf_dir).select(F.col("_metadata.offset").alias("seq"), "callsign")
    named = enrich.enrich_airline(flights, inputs.airlines(spark, sf_dir)).drop("callsign")
    return stored(spark, named, ["seq"])


@query(
    "e2_stream_enrich_airports",
    f"""SELECT i.seq, d.airport_name AS dep_airport_name, a.country_iso2 AS arr_country_iso2
        FROM {INFO} i LEFT JOIN {AIRPORTS} d ON i.estDepartureAirport = d.icao_code
        LEFT JOIN {AIRPORTS} a ON i.estArrivalAirport = a.icao_code""",
)
def e2_stream(spark, sf_dir):
    flights = info_stream(spark, sf_dir).withColumn("seq", F.col("_metadata.offset")).drop("_metadata")
    detailed = enrich.enrich_airports(flights, inputs.airports(spark, sf_dir))
    return stored(spark, detailed.select("seq", "dep_airport_name", "arr_country_iso2"), ["seq"])


# --- The two jobs, and what watches them.

#: Files of a job's messages before its stop, and after.
JOB_FILES = ([0, 1], [2])
#: One message in so many of the first topic of a job is cut off after so many characters.
BROKEN, CUT = 101, 20


def written(spark, sf_dir, folder, made, cut=False):
    """Messages written to a folder of files; with ``cut`` some of them broken."""
    rows = made(spark, sf_dir)
    if cut:
        rows = broken(rows)
    rows.write.mode("append").parquet(folder)
    return folder


def broken(rows):
    value = F.when(F.col("offset") % BROKEN == 0, F.substring("value", 1, CUT)).otherwise(F.col("value"))
    return rows.withColumn("value", value)


def job_config(spark, folder):
    path = new_folder(spark, "job")
    return jobs.JobConfig(
        f"{folder}/*", f"{path}/tables", f"{path}/archive", f"{path}/checkpoints", "parquet", "earliest",
        table_trigger=ONCE, archive_trigger=ONCE, most_files=1, console_rows=1,
    )


def remove_last_commit(spark, config, name):
    """As if the job had died before it noted that the last micro-batch of a query was done."""
    marks = f"{config.checkpoints}/{name}/commits"
    path = spark._jvm.org.apache.hadoop.fs.Path(marks)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    numbers = [s.getPath().getName() for s in system.listStatus(path) if s.getPath().getName().isdigit()]
    remove(spark, f"{marks}/{max(numbers, key=int)}")


def run_with_restart(spark, config, folder, rows, start, replayed):
    """Run a job over its first files, then, from its checkpoints, over all; the last batch of some queries runs twice."""
    rows = staged(rows, "messages")
    config.most_files = files_per_step(rows)
    with few_partitions(spark):
        for numbers in JOB_FILES:
            write_files(rows, folder, numbers, config.most_files)
            start()
            jobs.await_all(spark, config)
            if numbers is JOB_FILES[0]:
                for name in replayed:
                    remove_last_commit(spark, config, name)
    config.log.leave(spark)


def as_text(column, kind):
    """A value as text that does not hang on how an engine writes fractions."""
    return F.floor(column * 64).cast("string") if kind == "double" else column.cast("string")


def content(name, df, columns):
    """One row for a table: number of rows, and a sum over the digests of the rows."""
    kinds = dict(df.dtypes)
    text = F.concat_ws("|", *[F.coalesce(as_text(F.col(c), kinds[c]), F.lit("~")) for c in columns])
    digest = F.conv(F.substring(F.md5(text.cast("binary")), 1, 7), 16, 10).cast("long")
    return df.agg(F.count("*").alias("row_count"), F.coalesce(F.sum(digest), F.lit(0)).alias("digest")).select(
        F.lit(name).alias("table"), "row_count", "digest"
    )


def content_sql(name, source, columns):
    """SQL for ``content``."""
    text = ", ".join(
        f"coalesce(CASE WHEN typeof({c}) = 'DOUBLE' THEN CAST(CAST(floor(TRY_CAST({c} AS DOUBLE) * 64) AS BIGINT) AS VARCHAR) "
        f"ELSE CAST({c} AS VARCHAR) END, '~')"
        for c in columns
    )
    return f"""SELECT '{name}' AS "table", count(*) AS row_count,
        CAST(coalesce(sum(('0x' || substr(md5(concat_ws('|', {text})), 1, 7))::BIGINT), 0) AS BIGINT) AS digest FROM ({source}) r"""


def contents(spark, config, stored_tables, archives, dead):
    """``content`` of tables, archives and dead letters, and the sums of the batch log of the query that archives."""
    parts = [content(n, tables.current_view(spark, jobs.table_of(config, n)), c) for n, c in stored_tables.items()]
    parts += [content(n, spark.read.parquet(f"{config.archive}/{n}"), c) for n, c in archives.items()]
    parts.append(content("dead_letters", spark.read.parquet(f"{config.archive}/dead_letters/{dead}"), ["value"]))
    log = spark.read.parquet(config.batch_log).filter(F.col("query").endswith("_archives"))
    # A batch that runs again is logged again; its last run counts.
    log = log.groupBy("query", "batch_id").agg(*[F.max(c).alias(c) for c in ("consumed", "processed", "failed")])
    for name in ("consumed", "processed", "failed"):
        parts.append(log.agg(F.sum(name).alias("row_count")).select(F.lit(f"log {name}").alias("table"), "row_count", F.lit(0).cast("long").alias("digest")))
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    return found


def contents_sql(stored_tables, archives, dead, log):
    """SQL for ``contents``: sources and columns of tables and archives, the broken messages, and counts."""
    lines = [content_sql(name, source, columns) for name, (source, columns) in (stored_tables | archives).items()]
    lines.append(content_sql("dead_letters", dead, ["value"]))
    lines += [f"""SELECT 'log {name}' AS "table", CAST(({count}) AS BIGINT) AS row_count, 0::BIGINT AS digest""" for name, count in log.items()]
    return " UNION ALL ".join(lines)


def names(text):
    return text.replace(",", " ").split()


def whole(source: str) -> str:
    """SQL for ``source`` made of the messages that are not broken."""
    return source.replace(STATES, GOOD_STATES).replace(METAR, GOOD_METAR)


GOOD_STATES = f"(SELECT * FROM {STATES} WHERE seq % {BROKEN} <> 0)"
GOOD_METAR = f"(SELECT * FROM {METAR} WHERE seq % {BROKEN} <> 0)"
#: Flights of a job come at this pace: seven years in 40 days, which an archive has folders for.
PACE = 64
FAST_INFO = f"(SELECT * REPLACE (firstSeen // {PACE} AS firstSeen, lastSeen // {PACE} AS lastSeen) FROM {INFO})"
FAST_WAYPOINTS = f"""(SELECT * REPLACE (starttime // {PACE} AS starttime, starttime // {PACE} + time - starttime AS time,
    starttime // {PACE} + endtime - starttime AS endtime) FROM {WAYPOINTS})"""
FAST_LEAVING, FAST_ARRIVING = LEAVING.replace(INFO, FAST_INFO), ARRIVING.replace(INFO, FAST_INFO)
TRACKS = f"(SELECT DISTINCT seq, icao24, starttime, endtime, callsign FROM {FAST_WAYPOINTS})"
FLIGHT_TABLES = {
    "aircrafts_by_icao24": names("icao24 callsign lat lon"),
    "aircraftstates_by_icao24": names(WAYPOINT_FIELDS),
    "aircrafts_by_cell_minute": names("minute_bucket icao24 last_seen_ts lat lon geo_altitude velocity true_track"),
    "activeaircraft_by_country_hour": names("country_code hour_bucket active_aircraft_cnt"),
    "departures_by_country_hour": names("country_code hour_bucket departures_cnt"),
    "arrivals_by_country_hour": names("country_code hour_bucket arrivals_cnt"),
}
FLIGHT_ARCHIVES = {
    "flight_raw": names("icao24 callsign time_position last_contact latitude longitude on_ground velocity squawk"),
    "flight_data": names("icao24 firstSeen lastSeen estDepartureAirport estArrivalAirport callsign"),
    "flight_tracks": names("icao24 startTime endTime callsign"),
}
_FLIGHT_SOURCES = [
    f"SELECT * FROM {whole(AIRCRAFT)}",
    f"SELECT * FROM {FAST_WAYPOINTS} QUALIFY row_number() OVER (PARTITION BY icao24, starttime, time ORDER BY seq DESC) = 1",
    at_once(whole(BY_MINUTE), GOOD_STATES, "minute_bucket", 60, 10, "time_position"),
    at_once(
        whole(counted(with_global(LOCATED), "time_position", "active_aircraft_cnt")), GOOD_STATES, "hour_bucket", 3600, 600, "time_position"
    ),
    at_once(counted(with_global(FAST_LEAVING), "firstSeen", "departures_cnt"), FAST_INFO, "hour_bucket", 3600, 86400, "firstSeen"),
    at_once(counted(with_global(FAST_ARRIVING), "lastSeen", "arrivals_cnt"), FAST_INFO, "hour_bucket", 3600, 86400, "lastSeen"),
    f"SELECT * FROM {GOOD_STATES}",
    f"SELECT * FROM {FAST_INFO}",
    f"SELECT * FROM {TRACKS}",
]


@query(
    "k6_run_flight_job",
    contents_sql(
        {name: (source, columns) for (name, columns), source in zip(FLIGHT_TABLES.items(), _FLIGHT_SOURCES)},
        {name: (source, columns) for (name, columns), source in zip(FLIGHT_ARCHIVES.items(), _FLIGHT_SOURCES[6:])},
        f"""SELECT '{{"icao24":"' || icao24 || '","' AS value FROM {STATES} WHERE seq % {BROKEN} = 0""",
        {
            "consumed": f"(SELECT count(*) FROM {STATES}) + (SELECT count(*) FROM {INFO}) + (SELECT count(*) FROM {TRACKS})",
            "processed": f"(SELECT count(*) FROM {GOOD_STATES}) + (SELECT count(*) FROM {INFO}) + (SELECT count(*) FROM {TRACKS})",
            "failed": f"SELECT count(*) FROM {STATES} WHERE seq % {BROKEN} = 0",
        },
    ),
)
def k6(spark, sf_dir):
    """The flight job, stopped after some of its micro-batches and started again; everything it has stored, by content."""
    folder = new_folder(spark, "topics")
    config = job_config(spark, folder)
    airports, places = inputs.airports(spark, sf_dir), inputs.places(spark, sf_dir)
    seconds = lambda name: F.get_json_object("value", f"$.{name}").cast("long")
    # In the order of time, so that no row is late.
    states = in_order(staged(fixtures.flight_state_messages(spark, sf_dir), "states"), seconds("last_contact"), 3)
    info = in_order(staged(fixtures.flight_info_messages(spark, sf_dir, PACE), "info"), first_seen(), 3)
    tracks = in_order(staged(fixtures.flight_track_messages(spark, sf_dir, PACE), "tracks"), seconds("startTime"), 3)
    rows = broken(states).unionByName(info).unionByName(tracks)
    start = lambda: jobs.run_flight_job(spark, config, airports, places)
    run_with_restart(spark, config, folder, rows, start, ["flight_tables", "flight_archives", "aircrafts_by_cell_minute"])
    return contents(spark, config, FLIGHT_TABLES, FLIGHT_ARCHIVES, schemas.FLIGHT_STATES_TOPIC)


WEATHER_TABLES = {
    "metar_latest_by_station": weather.METAR_LATEST,
    "metar_history_by_station": weather.METAR_HISTORY,
    "sigmet_by_validtime": weather.SIGMET,
    "taf_by_station": weather.TAF,
}
WEATHER_ARCHIVES = {
    "weather_metar": names("station_id obs_time raw_ob temp wspd fltcat visib altim"),
    "weather_taf": names("station_id issue_time time_group valid_from valid_to raw_taf wspd fltcat"),
    "weather_isigmet": names("icao_id series_id valid_from valid_to hazard base top raw_sigmet"),
}


@query(
    "k7_run_weather_job",
    contents_sql(
        {
            "metar_latest_by_station": (f"SELECT * FROM {whole(METAR_LATEST)}", weather.METAR_LATEST),
            "metar_history_by_station": (f"SELECT * FROM {whole(METAR_HISTORY)}", weather.METAR_HISTORY),
            "sigmet_by_validtime": (f"SELECT * FROM {SIGMETS}", weather.SIGMET),
            "taf_by_station": (f"SELECT * FROM {TAFS}", weather.TAF),
        },
        {
            name: (f"SELECT * FROM {source}", columns)
            for (name, columns), source in zip(WEATHER_ARCHIVES.items(), (GOOD_METAR, TAF, SIGMET))
        },
        f"""SELECT '{{"type":"Feature","p' AS value FROM {METAR} WHERE seq % {BROKEN} = 0""",
        {
            "consumed": f"(SELECT count(*) FROM {METAR}) + (SELECT count(*) FROM {TAF}) + (SELECT count(*) FROM {SIGMET})",
            "processed": f"(SELECT count(*) FROM {GOOD_METAR}) + (SELECT count(*) FROM {TAF}) + (SELECT count(*) FROM {SIGMET})",
            "failed": f"SELECT count(*) FROM {METAR} WHERE seq % {BROKEN} = 0",
        },
    ),
)
def k7(spark, sf_dir):
    """The weather job, stopped after some of its micro-batches and started again; everything it has stored, by content."""
    folder = new_folder(spark, "topics")
    config = job_config(spark, folder)
    made = [fixtures.metar_messages, fixtures.taf_messages, fixtures.sigmet_messages]
    metar, taf, sigmet = [in_order(staged(f(spark, sf_dir), "messages"), F.col("offset"), 3) for f in made]
    rows = broken(metar).unionByName(taf).unionByName(sigmet)
    start = lambda: jobs.run_weather_job(spark, config)
    run_with_restart(spark, config, folder, rows, start, ["weather_tables", "weather_archives"])
    return contents(spark, config, WEATHER_TABLES, WEATHER_ARCHIVES, schemas.METAR_TOPIC)


@query("k4_console_sink", f"SELECT count(*) AS row_count FROM {SIGMET}")
def k4(spark, sf_dir):
    stream = stream_of(spark, sf_dir, fixtures.sigmet_messages, schemas.SIGMET_TOPIC).select("key", "offset")
    query_ = sinks.console_sink(stream, 1, "shown", new_folder(spark, "checkpoint"), ONCE)
    query_.awaitTermination()
    return monitor.batch_stats(query_).agg(F.sum("consumed").alias("row_count"))


@query(
    "k8_stream_lag",
    f"""SELECT batch_id, 'flights_raw' AS topic, partition, max(seq) FILTER (seq // (high // 3 + 1) <= batch_id) + 1 AS current_offset,
        max(seq) + 1 AS high_offset, max(seq) - max(seq) FILTER (seq // (high // 3 + 1) <= batch_id) AS lag,
        max(seq) - max(seq) FILTER (seq // (high // 3 + 1) <= batch_id) < 10000 AS ok
        FROM (SELECT seq, CAST(seq % 4 AS INTEGER) AS partition, max(seq) OVER () AS high FROM {STATES}) s,
            (SELECT unnest([0, 1, 2])::BIGINT AS batch_id) b GROUP BY batch_id, partition""",
)
def k8(spark, sf_dir):
    """Lag after each of three micro-batches over four partitions, as the listener of a job takes it down.

    There is no broker here, so the progress reports are texts in the form a broker's source writes, with the offsets of the
    given messages: what a batch has reached is the offset after the last message of its third of all offsets.
    """
    offsets = fixtures.flight_state_messages(spark, sf_dir).select("topic", F.col("offset"), (F.col("offset") % 4).alias("partition"))
    high = offsets.agg(F.max("offset")).first()[0]
    third = F.floor(F.col("offset") / F.lit(high // 3 + 1))
    log = monitor.BatchLog()
    for number in range(3):
        reached = F.max(F.when(third <= number, F.col("offset"))) + 1
        ends = offsets.groupBy("topic", "partition").agg(reached.alias("reached"), (F.max("offset") + 1).alias("newest")).collect()
        end, latest = {}, {}
        for row in ends:
            end.setdefault(row["topic"], {})[str(row["partition"])] = row["reached"]
            latest.setdefault(row["topic"], {})[str(row["partition"])] = row["newest"]
        source = {"description": "KafkaV2[Subscribe[flights_raw]]", "endOffset": end, "latestOffset": latest, "numInputRows": 0}
        log.take({"name": "reader", "batchId": number, "sources": [source]})
    path = new_folder(spark, "log")
    log.store(spark, path)
    return spark.read.parquet(f"{path}-lag").drop("query")


@query(
    "k9_batch_stats",
    f"""SELECT count(*)::BIGINT AS consumed, (count(*) FILTER (seq % 101 <> 0))::BIGINT AS processed,
        (count(*) FILTER (seq % 101 = 0))::BIGINT AS failed FROM {STATES}""",
)
def k9(spark, sf_dir):
    folder = written(spark, sf_dir, new_folder(spark, "cut"), fixtures.flight_state_messages, cut=True)
    raw = messages.read_stream(spark, "parquet", schemas.FLIGHT_STATES_TOPIC, location=folder, position="earliest")
    counted_ = monitor.with_message_counters(raw, schemas.FLIGHT_STATE)
    handle = lambda batch, batch_id: batch.write.format("noop").mode("overwrite").save()
    query_ = sinks.for_each_message_batch(counted_, handle, "counted", new_folder(spark, "checkpoint"), ONCE)
    query_.awaitTermination()
    sums = [F.sum(c).alias(c) for c in ("consumed", "processed", "failed")]
    return monitor.batch_stats(query_).agg(*sums)


@query(
    "k10_start_position",
    f"""SELECT 'earliest' AS position, count(*) AS row_count FROM {STATES}
        UNION ALL SELECT 'later', count(*) FROM {STATES} WHERE seq % 2 = 1""",
)
def k10(spark, sf_dir):
    """Rows read from the start, and from a time between two writes."""
    folder, parts = new_folder(spark, "twice"), {}
    for half in (0, 1):
        if half:
            time.sleep(1.1)
            between = datetime.datetime.now(datetime.UTC).isoformat()
            time.sleep(1.1)
        half_of = lambda s, d, half=half: fixtures.flight_state_messages(s, d).filter(F.col("offset") % 2 == half)
        written(spark, sf_dir, folder, half_of)
    for name, position in (("earliest", "earliest"), ("later", between)):
        stream = messages.read_stream(spark, "parquet", schemas.FLIGHT_STATES_TOPIC, location=folder, position=position)
        rows = stored(spark, stream.select("offset"), ["offset"])
        parts[name] = rows.agg(F.lit(name).alias("position"), F.count("*").alias("row_count"))
    return parts["earliest"].unionByName(parts["later"])
