"""Keyed tables on plain Parquet: a change log per micro-batch, a base in parts, a current view.

Layout below the table path::

    log/writer=ab12/batch_id=7/             rows of one micro-batch of one query, newest per key
    base/run=3-9f0c/bucket=5/slot=0/        a part: rows of some keys, written in some span of time
    state/through=3/by=9f0c/                the third state: parts in force, last batch of each writer in them

A writer is a streaming query with its checkpoint. A query that starts over with a new checkpoint
counts its batches from 0 again, but as another writer, so it neither overwrites nor hides what was
there. A batch that runs again replaces its own folder. A folder counts once its ``_SUCCESS`` marker
is there, so readers never see half a write and a job that dies while compacting leaves the old
state in force.

Rows belong to a bucket by their first key and, in tables whose rows expire, to a slot by the time they
were written. A compaction rewrites the parts that new rows fall into and keeps all others as they are; what
has expired is left out part by part. A state names its parts and the batches in them together, so two
writers that compact at the same time make two complete states, of which one is in force.
"""

from __future__ import annotations

import json
import time
import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from skyflow.plans.ordering import latest_by_key
from skyflow.plans.staging import committed, folders, remove

WRITTEN_AT = "written_at"
WRITER, BATCH = "writer", "batch_id"
BUCKET, SLOT = "bucket", "slot"
#: Writer of batches that no streaming query wrote.
NO_QUERY = "none"
STATE = f"{BUCKET} INT, {SLOT} BIGINT, folder STRING, {WRITER} STRING, {BATCH} BIGINT, columns STRING"


@dataclass(frozen=True)
class KeyedTable:
    """Where a table lives, what identifies a row and which row of a key is the newest.

    ``order`` names columns of the rows written; what was written later breaks ties. Columns in
    ``hidden`` only serve the order and do not show in the current view. With
    ``ttl_seconds`` rows expire that long after they were written. A sink compacts the table
    after every ``compact_every`` batches, so that its log stays short. The base has
    ``buckets`` buckets of the first key, and ``slots`` spans of time per ``ttl_seconds``.
    """

    path: str
    keys: list[str]
    order: list[str] = field(default_factory=list)
    hidden: list[str] = field(default_factory=list)
    ttl_seconds: int | None = None
    compact_every: int | None = 50
    buckets: int = 32
    slots: int = 8

    def slot_seconds(self) -> int | None:
        """Length of a slot; None if rows do not expire."""
        return None if self.ttl_seconds is None else max(1, self.ttl_seconds // self.slots)


def bucket_of(table: KeyedTable, key: Column) -> Column:
    """Bucket of a first key, from the digest of its text, so that it is the same for every type and engine."""
    digits = F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), 1, 7), 16, 10)
    return (digits.cast("long") % table.buckets).cast("int")


def slot_of(table: KeyedTable, written_at: Column) -> Column:
    """Slot of a time of writing."""
    width = table.slot_seconds()
    return F.lit(0).cast("long") if width is None else F.floor(written_at / F.lit(width)).cast("long")


@dataclass(frozen=True)
class Part:
    """A folder of the base, by its path below ``base``."""

    bucket: int
    slot: int
    folder: str


def _value(folder: str, name: str) -> str:
    """The value of the folder level ``name=value``."""
    return next(x.split("=", 1)[1] for x in folder.split("/") if x.startswith(f"{name}="))


def _states(spark: SparkSession, table: KeyedTable) -> list[tuple[int, str, str]]:
    """Number, author and folder of the states, the one in force last."""
    found = [folder for folder, _ in committed(spark, f"{table.path}/state/through=*/by=*")]
    return sorted((int(_value(folder, "through")), _value(folder, "by"), folder) for folder in found)


def _read_state(spark: SparkSession, folder: str) -> tuple[list[Part], dict[str, int], str]:
    """Parts of a state, the last batch of each writer in them, and the table's columns.

    There are at most ``buckets`` parts for each of ``slots`` and one, and a row per writer that ever fed the table.
    """
    rows = spark.read.schema(STATE).json(folder).collect()
    parts = [Part(r[BUCKET], r[SLOT], r["folder"]) for r in rows if r["folder"] is not None]
    merged = {r[WRITER]: r[BATCH] for r in rows if r[WRITER] is not None}
    return parts, merged, next(r["columns"] for r in rows if r["columns"] is not None)


def _log(spark: SparkSession, table: KeyedTable) -> dict[tuple[str, int], tuple[str, int]]:
    """Folders of the log by writer and batch, with the time each was written."""
    found = committed(spark, f"{table.path}/log/{WRITER}=*/{BATCH}=*")
    return {(_value(folder, WRITER), int(_value(folder, BATCH))): (folder, at) for folder, at in found}


def writer_of(batch: DataFrame) -> str:
    """The streaming query that a micro-batch belongs to; the id stays the same for a checkpoint."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or NO_QUERY


def append_changes(
    table: KeyedTable, batch: DataFrame, batch_id: int, writer: str | None = None, written_at: int | None = None
) -> None:
    """Write one micro-batch to the log; writing it again replaces it. ``written_at`` is now unless it is given."""
    writer = writer or writer_of(batch)
    newest = latest_by_key(batch, table.keys, table.order) if table.order else batch
    clock = F.unix_timestamp(F.current_timestamp()) if written_at is None else F.lit(written_at).cast("long")
    stamped = newest.withColumn(WRITTEN_AT, clock)
    stamped.write.mode("overwrite").parquet(f"{table.path}/log/{WRITER}={writer}/{BATCH}={batch_id}")


@dataclass(frozen=True)
class _State:
    """What a read of the table consists of."""

    number: int
    parts: list[Part]
    expired: list[Part]
    log: list[str]
    through: dict[str, int]
    columns: str | None


def _state(spark: SparkSession, table: KeyedTable, now: int | None) -> _State:
    states = _states(spark, table)
    number, parts, merged, columns = -1, [], {}, None
    if states:
        number, _, folder = states[-1]
        parts, merged, columns = _read_state(spark, folder)
    log = {key: found for key, found in _log(spark, table).items() if key[1] > merged.get(key[0], -1)}
    if not states and not log:
        raise FileNotFoundError(f"no committed rows below {table.path}")
    through = dict(merged)
    for writer, batch_id in log:
        through[writer] = max(batch_id, through.get(writer, -1))
    read, expired = [folder for folder, _ in log.values()], []
    if table.ttl_seconds is not None:
        # Rows of a folder were written before its marker, those of a part before the end of its slot.
        oldest = (time.time() if now is None else now) - table.ttl_seconds
        expired = [p for p in parts if (p.slot + 1) * table.slot_seconds() <= oldest]
        parts = [p for p in parts if p not in expired]
        if log:
            newest = max(log.values(), key=lambda found: found[1])[0]
            # Without a state the newest is read in any case, for the columns.
            read = [folder for folder, at in log.values() if at > oldest or (not states and folder == newest)]
    return _State(number, parts, expired, read, through, columns)


def _rows(spark: SparkSession, table: KeyedTable, parts: list[Part], log: list[str]) -> DataFrame:
    read = []
    if parts:
        read.append(spark.read.parquet(*[f"{table.path}/base/{p.folder}" for p in parts]))
    if log:
        read.append(spark.read.option("basePath", f"{table.path}/log").parquet(*log))
    rows = read[0] if len(read) == 1 else read[0].unionByName(read[1])
    return rows.withColumns({BATCH: F.col(BATCH).cast("long"), WRITER: F.col(WRITER).cast("string")})


def _newest(table: KeyedTable, rows: DataFrame, now: int | None) -> DataFrame:
    if table.ttl_seconds is not None:
        clock = F.unix_timestamp(F.current_timestamp()) if now is None else F.lit(now)
        rows = rows.filter(F.col(WRITTEN_AT) > clock - table.ttl_seconds)
    return latest_by_key(rows, table.keys, [*table.order, WRITTEN_AT, BATCH])


def _view(spark: SparkSession, table: KeyedTable, parts: list[Part], state: _State, now: int | None) -> DataFrame:
    if parts or state.log:
        rows = _newest(table, _rows(spark, table, parts, state.log), now)
    else:
        rows = spark.createDataFrame([], T.StructType.fromJson(json.loads(state.columns)))
    return rows.drop(*table.hidden, WRITTEN_AT, WRITER, BATCH)


def current_view(spark: SparkSession, table: KeyedTable, now: int | None = None) -> DataFrame:
    """One row per key: the newest one written so far; expired rows do not count."""
    state = _state(spark, table, now)
    return _view(spark, table, state.parts, state, now)


def key_view(spark: SparkSession, table: KeyedTable, values: list, now: int | None = None) -> DataFrame:
    """The rows of ``current_view`` whose first key is one of ``values``, read from their buckets and the log only."""
    state = _state(spark, table, now)
    wanted = spark.range(1).select(F.explode(F.array(*[bucket_of(table, F.lit(v)) for v in values])).alias(BUCKET))
    buckets = {row[BUCKET] for row in wanted.collect()}
    parts = [p for p in state.parts if p.bucket in buckets]
    return _view(spark, table, parts, state, now).filter(F.col(table.keys[0]).isin(*values))


def parts_in_force(spark: SparkSession, table: KeyedTable) -> list[Part]:
    """The parts that the newest state names."""
    states = _states(spark, table)
    return _read_state(spark, states[-1][2])[0] if states else []


def compact(spark: SparkSession, table: KeyedTable, now: int | None = None) -> None:
    """Merge the log into the parts of the base that its rows fall into, and leave out parts that have expired.

    Rows of a part are sorted by key, so that lookups skip row groups. Other parts keep their files. In a table whose rows
    expire, an older row of a key may stay in the part of an older slot; it does not count, and goes with its part.
    Replaced folders stay for readers that have them open; ``vacuum`` removes them.
    """
    state = _state(spark, table, now)
    if not state.log and not state.expired:
        return
    author = uuid.uuid4().hex
    number = state.number + 1
    parts, run, columns = list(state.parts), f"run={number}-{author}", state.columns
    if state.log:
        place = {BUCKET: bucket_of(table, F.col(table.keys[0])), SLOT: slot_of(table, F.col(WRITTEN_AT))}
        fed = _rows(spark, table, [], state.log).select(*[value.alias(name) for name, value in place.items()])
        # At most as many as the table has parts.
        touched = {(row[BUCKET], row[SLOT]) for row in fed.distinct().collect()}
        merged = [p for p in parts if (p.bucket, p.slot) in touched]
        parts = [p for p in parts if (p.bucket, p.slot) not in touched]
        rows = _newest(table, _rows(spark, table, merged, state.log), now).withColumns(place)
        columns = rows.drop(BUCKET, SLOT).schema.json()
        ordered = rows.hint("rebalance", BUCKET, SLOT).sortWithinPartitions(BUCKET, SLOT, *table.keys)
        ordered.write.partitionBy(BUCKET, SLOT).parquet(f"{table.path}/base/{run}")
        for folder in folders(spark, f"{table.path}/base/{run}/{BUCKET}=*/{SLOT}=*"):
            bucket, slot = int(_value(folder, BUCKET)), int(_value(folder, SLOT))
            parts.append(Part(bucket, slot, f"{run}/{BUCKET}={bucket}/{SLOT}={slot}"))
    lines = [(p.bucket, p.slot, p.folder, None, None, None) for p in parts]
    lines += [(None, None, None, writer, batch_id, None) for writer, batch_id in sorted(state.through.items())]
    lines.append((None, None, None, None, None, columns))
    # With its marker the state is in force.
    spark.createDataFrame(lines, STATE).coalesce(1).write.json(f"{table.path}/state/through={number}/by={author}")


def vacuum(spark: SparkSession, table: KeyedTable, keep: int = 1) -> None:
    """Remove what the newest ``keep`` states do not need: older states, parts in none of them, log folders that all hold.

    Where several writers compact, keep two or more: what a state started from has to stay until it is written.
    """
    states = _states(spark, table)
    numbers = sorted({number for number, _, _ in states})[-keep:]
    if not numbers:
        return
    kept = [_read_state(spark, folder) for number, _, folder in states if number >= numbers[0]]
    needed = {part.folder for parts, _, _ in kept for part in parts}
    for (writer, batch_id), (folder, _) in _log(spark, table).items():
        if all(batch_id <= merged.get(writer, -1) for _, merged, _ in kept):
            remove(spark, folder)
    runs: dict[str, bool] = {}
    for folder in folders(spark, f"{table.path}/base/run=*/{BUCKET}=*/{SLOT}=*"):
        run = _value(folder, "run")
        part = f"run={run}/{BUCKET}={_value(folder, BUCKET)}/{SLOT}={_value(folder, SLOT)}"
        # A run with this or a later number may be writing still.
        gone = part not in needed and int(run.split("-")[0]) < numbers[0]
        runs[run] = runs.get(run, False) or not gone
        if gone:
            remove(spark, folder)
    for run, used in runs.items():
        if not used:
            remove(spark, f"{table.path}/base/run={run}")
    for number in {number for number, _, _ in states if number < numbers[0]}:
        remove(spark, f"{table.path}/state/through={number}")


def maintain(spark: SparkSession, table: KeyedTable, batch_id: int) -> None:
    """Keep the table's log short: compact it when ``batch_id`` is the last of ``compact_every``.

    The state before the last compaction stays for readers that have it open.
    """
    due = table.compact_every and batch_id % table.compact_every == table.compact_every - 1
    if due and (_states(spark, table) or _log(spark, table)):
        compact(spark, table)
        vacuum(spark, table, keep=2)


def feed(table: KeyedTable, batch: DataFrame, batch_id: int) -> None:
    """Write one micro-batch, and keep the table's log short."""
    append_changes(table, batch, batch_id)
    maintain(batch.sparkSession, table, batch_id)


def upsert_sink(
    stream: DataFrame,
    table: KeyedTable,
    name: str,
    checkpoint: str,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Feed a stream into a keyed table under a fixed name and checkpoint."""
    return (
        stream.writeStream.queryName(name)
        .option("checkpointLocation", f"{checkpoint}/{name}")
        .outputMode("append")
        .trigger(**(trigger or {"processingTime": "0 seconds"}))
        .foreachBatch(lambda batch, batch_id: feed(table, batch, batch_id))
        .start()
    )
