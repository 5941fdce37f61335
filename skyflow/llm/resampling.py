"""Importance resampling of documents towards a target distribution.

Features are hashed to buckets. The logarithm of how much more frequent a bucket is in the target
than in all documents is its gain, kept in one array; a document's weight is the sum over its
features, and with Gumbel noise drawn from its id it becomes a score whose highest values are a
sample without replacement. The threshold is found by a distributed quickselect on unique composite
keys: rows are counted below, at and above random pivots, and only the part with the wanted key goes
on. The winners alone are sorted and ranked.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyflow.llm import common
from skyflow.plans import staging

BUCKETS = 10_000
#: Consecutive words of the longest feature.
LONGEST_RUN = 1
SEED = 2024
#: Documents with fewer words are never drawn.
LEAST_WORDS = 20
PERCENT = 10
#: Keys that a round of the selection compares all rows with.
PIVOTS = 31
#: Bytes of a text that are split into words at a time.
PIECE = 1 << 20
#: Features whose buckets a task remembers.
REMEMBERED = 200_000
#: Bits of ``monotonically_increasing_id`` that number the rows of a partition.
ROW_BITS = 33


class _Buckets(dict):
    """The bucket of each feature, remembered for the most recent ones."""

    def __init__(self, buckets: int):
        super().__init__()
        self.buckets = buckets

    def __missing__(self, feature: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        found = self[feature] = zlib.crc32(feature) % self.buckets
        return found


def word_pieces(data: bytes) -> Iterator[list[bytes]]:
    """Lower-cased words of a text in lists of about ``PIECE`` bytes."""
    text, start = data.translate(common.LOWER_WORDS), 0
    while start < len(text):
        end = text.find(b" ", start + PIECE)
        end = len(text) if end < 0 else end
        yield text[start:end].split()
        start = end


def features(data: bytes, longest: int = LONGEST_RUN) -> Iterator[tuple[int, list[bytes]]]:
    """Pieces of a text: the number of its words, and its runs of 1 to ``longest`` words that end in it."""
    before: list[bytes] = []
    for words in word_pieces(data):
        found = list(words)
        joined = before + words
        for size in range(2, longest + 1):
            first = max(len(before) - size + 1, 0)
            found += [b" ".join(joined[i : i + size]) for i in range(first, len(joined) - size + 1)]
        before = joined[len(joined) - longest + 1 :] if longest > 1 else []
        yield len(words), found


def bucket_counts(texts: DataFrame, *, text_col: str = "text", longest: int = LONGEST_RUN, buckets: int = BUCKETS) -> DataFrame:
    """Rows (bucket, n): how many features of all texts fall into each bucket that has any."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, total = _Buckets(buckets), np.zeros(buckets, np.int64)
        for batch in common.slices(batches):
            for data in common.as_bytes(batch["text"]):
                for _, found in features(data, longest):
                    total += np.bincount(np.array([numbers[x] for x in found], np.int64), minlength=buckets)
        there = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(there), pa.array(total[there])], ["bucket", "n"])

    text = texts.select(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    found = text.mapInArrow(common.releasing(run), "bucket long, n long")
    return found.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(docs: DataFrame, target: DataFrame, *, text_col: str = "text", longest: int = LONGEST_RUN, buckets: int = BUCKETS) -> np.ndarray:
    """The gain of every bucket, an array of ``buckets`` numbers.

    With S features in all documents, s of them in a bucket, and T and t in the target, a gain is
    floor(1000 ln((t + 1)(S + buckets) / ((s + 1)(T + buckets)))).
    """
    options = {"text_col": text_col, "longest": longest, "buckets": buckets}
    s = bucket_counts(docs, **options).withColumnRenamed("n", "s")
    t = bucket_counts(target, **options).withColumnRenamed("n", "t")
    both = docs.sparkSession.range(buckets).withColumnRenamed("id", "bucket").join(s, "bucket", "left").join(t, "bucket", "left")
    # One row per bucket, a number that the caller chose.
    rows = both.select("bucket", *[F.coalesce(c, F.lit(0)).cast("double").alias(c) for c in "st"])
    sums = rows.agg(F.sum("s").alias("all_s"), F.sum("t").alias("all_t"))
    ratio = ((F.col("t") + 1) * (F.col("all_s") + buckets)) / ((F.col("s") + 1) * (F.col("all_t") + buckets))
    found = rows.join(F.broadcast(sums)).select("bucket", F.floor(F.log(ratio) * 1000).alias("gain"))
    table = np.zeros(buckets, np.int64)
    for row in found.collect():
        table[row["bucket"]] = row["gain"]
    return table


def weights(docs: DataFrame, gain: np.ndarray, *, id_col: str = "doc_id", text_col: str = "text", longest: int = LONGEST_RUN) -> DataFrame:
    """Rows (doc_id, n_words, n_features, weight), one per row of ``docs``; a text without words weighs 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = _Buckets(len(gain))
        for batch in common.slices(batches):
            rows = []
            for data in common.as_bytes(batch["text"]):
                n_words = n_features = weight = 0
                for words, found in features(data, longest):
                    n_words, n_features = n_words + words, n_features + len(found)
                    weight += int(gain[np.array([numbers[x] for x in found], np.int64)].sum())
                rows.append((n_words, n_features, weight))
            columns = np.array(rows, np.int64).reshape(-1, 3).T
            yield pa.RecordBatch.from_arrays([batch["doc_id"], *map(pa.array, columns)], ["doc_id", "n_words", "n_features", "weight"])

    kept = common.id_and_text(docs, id_col, text_col)
    return kept.mapInArrow(common.releasing(run), "doc_id long, n_words long, n_features long, weight long")


def noise(id_text: Column, seed: int = SEED) -> Column:
    """floor(-1000 ln(-ln(u))) with u from the first 32 bits of the SHA-256 of ``seed:id``."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), id_text).cast("binary"), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(F.log(-F.log((h + 0.5) / 4294967296.0)) * -1000)


#: What orders candidates, best first: highest score, smallest id, rows without id last, place in the table.
KEY = ["down", "nameless", "known", "row"]


def _literal(key: tuple) -> Column:
    return F.struct(*[F.lit(value).cast("long").alias(name) for name, value in zip(KEY, key)])


def kth_key(keys: DataFrame, k: int) -> tuple:
    """The ``k``-th smallest of unique keys, counted from 1; columns ``KEY``, all long.

    Each round takes random pivots among the rows left, counts the rows between them and at them
    exactly, and writes the rows of the part that holds the k-th to the shared folder for the next
    round. So a round handles about a ``PIVOTS``-th of the rows of the one before.
    """
    spark, key = keys.sparkSession, F.struct(*KEY)
    left, path, round_number = keys.select(*KEY), None, 0
    while True:
        chosen = left.orderBy(F.xxhash64(*KEY, F.lit(round_number)), *KEY).limit(PIVOTS)
        pivots = sorted(tuple(row) for row in chosen.collect())
        literals = F.array(*[_literal(p) for p in pivots])
        below = F.size(F.filter(literals, lambda p: p < key))
        # Even numbers lie between pivots, odd ones at a pivot.
        part = below * 2 + F.exists(literals, lambda p: p == key).cast("int")
        counts = dict(left.groupBy(part.alias("part")).count().collect())
        for number in range(2 * len(pivots) + 1):
            if k <= counts.get(number, 0):
                break
            k -= counts.get(number, 0)
        if number % 2:
            if path:
                staging.remove(spark, path)
            return pivots[number // 2]
        at = number // 2
        if at > 0:
            left = left.filter(key > _literal(pivots[at - 1]))
        if at < len(pivots):
            left = left.filter(key < _literal(pivots[at]))
        old, path, round_number = path, staging.new_folder(spark, "select"), round_number + 1
        left = staging.staged(left, "select", path)
        if old:
            staging.remove(spark, old)


def ranked(winners: DataFrame) -> DataFrame:
    """``winners`` with their rank by ``KEY`` from 1, by a distributed sort and the sizes of its parts."""
    place = F.monotonically_increasing_id().alias("place")
    ordered = staging.staged(winners.repartitionByRange(*KEY).sortWithinPartitions(*KEY).select("*", place), "winners")
    part = F.shiftright("place", ROW_BITS)
    sizes = sorted(ordered.groupBy(part.alias("part")).count().collect())  # one row per task of the sort
    starts = list(accumulate((n for _, n in sizes), initial=0))
    offsets = winners.sparkSession.createDataFrame([(p, s) for (p, _), s in zip(sizes, starts)], "part long, start long")
    within = F.col("place").bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    found = ordered.withColumn("part", part).join(F.broadcast(offsets), "part")
    return found.withColumn("rank", F.col("start") + within + 1).drop("part", "start", "place")


def resample(
    docs: DataFrame,
    target: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    longest: int = LONGEST_RUN,
    buckets: int = BUCKETS,
    percent: int = PERCENT,
    least_words: int = LEAST_WORDS,
    seed: int = SEED,
) -> DataFrame:
    """Rows (doc_id, n_features, weight, score, rank), one per row of ``docs``.

    Of the N documents with ``least_words`` words or more, floor(percent N / 100) are drawn: the highest
    scores, ties to the smaller id. ``rank`` numbers them from 1 and is null for all others. Null texts
    are empty, weigh 0 and are not drawn; very long ones are split in pieces. A null id counts as an empty
    text in the noise and comes after all ids in a tie. Repeated rows take part one by one, each with a
    rank of its own. Without documents there are no rows, without target texts all gains come from the documents.
    """
    gain = gains(docs, target, text_col=text_col, longest=longest, buckets=buckets)
    weighed = weights(docs, gain, id_col=id_col, text_col=text_col, longest=longest)
    id_text = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    score = F.col("weight") + noise(id_text, seed)
    # Numbers of rows stay the same once they are written, so that keys are unique and equal rows spread.
    rows = staging.staged(
        weighed.select("*", score.alias("score"), F.monotonically_increasing_id().alias("row")), "resampling"
    )
    rows = rows.withColumns(
        {
            "down": -F.col("score"),
            "nameless": F.col("doc_id").isNull().cast("long"),
            "known": F.coalesce("doc_id", F.lit(0).cast("long")),
        }
    )
    candidates = rows.filter(F.col("n_words") >= least_words)
    wanted = candidates.count() * percent // 100
    columns = ["doc_id", "n_features", "weight", "score", "rank"]
    if not wanted:
        return rows.withColumn("rank", F.lit(None).cast("long")).select(*columns)
    last = _literal(kth_key(candidates, wanted))
    drawn = (F.col("n_words") >= least_words) & (F.struct(*KEY) <= last)
    others = rows.filter(~drawn).withColumn("rank", F.lit(None).cast("long"))
    return ranked(rows.filter(drawn)).select(*columns).union(others.select(*columns))
