"""Take-offs and landings on a stream."""

from __future__ import annotations

import json
from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from skyflow.operators.transitions import event_name
from skyflow.plans.ordering import ingest_order

CHANGES = "icao24 STRING, time BIGINT, on_ground BOOLEAN"
#: State of a bucket: a JSON object with the last flag of each aircraft and when it was seen.
LAST = "aircraft STRING"
#: Groups that aircraft share a state in: a group costs about ten calls between Python and the state store per micro-batch.
BUCKETS = 1024
#: Seconds after which an aircraft that is not seen is forgotten.
FORGET_AFTER = 30 * 86400


class FlagChanges(StatefulProcessor):
    """Seconds at which the flag of an aircraft differs from the one before.

    The state of a bucket has the last flag of its aircraft and when they were seen. A timer on event time removes those that
    have not been seen for ``forget_after`` seconds; there is one timer per bucket, moved to the next aircraft when it fires.
    """

    def __init__(self, forget_after: int):
        self._forget_after = forget_after

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._last = handle.getValueState("last", LAST)

    def _due(self, seen: int) -> int:
        return (seen + self._forget_after) * 1000 + 1

    def _wake(self, known: dict) -> None:
        self._handle.registerTimer(self._due(min(seen for _, seen in known.values())))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        stored = self._last.get()
        known = json.loads(stored[0]) if stored else {}
        for time, icao24, on_ground in sorted((row["time"], row["icao24"], row["on_ground"]) for row in rows):
            flag, seen = known.get(icao24, (None, None))
            if flag is not None and time - seen <= self._forget_after and flag != on_ground:
                yield Row(icao24=icao24, time=time, on_ground=on_ground)
            known[icao24] = (on_ground, time)
        self._last.update((json.dumps(known),))
        if not stored:
            self._wake(known)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        stored = self._last.get()
        if stored:
            now = expiredTimerInfo.getExpiryTimeInMs()
            known = {icao24: last for icao24, last in json.loads(stored[0]).items() if self._due(last[1]) > now}
            if known:
                self._last.update((json.dumps(known),))
                self._wake(known)
            else:
                self._last.clear()
        return iter([])

    def close(self) -> None:
        pass


def ground_transitions_stream(flights: DataFrame, delay: str = "10 seconds", forget_after: int = FORGET_AFTER) -> DataFrame:
    """``ground_transitions`` for a stream, with the same rows once the watermark has passed.

    An aggregation first settles the flag of each aircraft and second. It combines copies
    before the shuffle and gives seconds out only when they are closed, so each aircraft's
    flags reach the stateful step in time order over all micro-batches, whatever the order
    of arrival within ``delay``. That step keeps one flag per aircraft seen in the last ``forget_after`` seconds, those of a
    bucket together; the first flag after a longer gap is no change. It sorts the seconds a bucket has in one
    micro-batch, so bound those with the source's ``maxOffsetsPerTrigger`` or
    ``maxFilesPerTrigger``, as the jobs do. It needs the RocksDB state store.
    """
    known = flights.filter(F.col("icao24").isNotNull() & F.col("on_ground").isNotNull())
    order = ingest_order(known)
    if order is None:
        order = F.struct("last_contact", "on_ground")
    seconds = (
        known.withWatermark("timestamp", delay)
        .groupBy(F.window("timestamp", "1 second").alias("w"), "icao24")
        .agg(F.max_by("on_ground", order).alias("on_ground"))
        .select("icao24", F.unix_seconds("w.start").alias("time"), "on_ground", F.window_time("w").alias("at"))
    )
    bucketed = seconds.withColumn("bucket", F.pmod(F.xxhash64("icao24"), F.lit(BUCKETS)))
    changes = bucketed.groupBy("bucket").transformWithState(FlagChanges(forget_after), CHANGES, "Append", "EventTime")
    return changes.select("icao24", "time", event_name(F.col("on_ground")).alias("event"))
