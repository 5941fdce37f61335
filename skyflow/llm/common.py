"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Bytes of words after A-Z is lower-cased are 0-9, a-z and all of non-ASCII.
_WORD_BYTES = b"0123456789abcdefghijklmnopqrstuvwxyz" + bytes(range(128, 256))

#: Lower-cases A-Z and turns every byte outside words into a space, for ``bytes.translate``.
LOWER_WORDS = bytes(
    c + 32 if 65 <= c <= 90 else c if c in _WORD_BYTES else 32 for c in range(256)
)
#: Lower-cases A-Z only, for ``bytes.translate``.
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))

#: Documents handled at a time inside a task.
SLICE = 256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the folder ``sf_dir``."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The two columns text operators read; null texts are empty, whatever else ``docs`` holds."""
    return docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"),
        F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"),
    )


def slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE) -> Iterator[pa.RecordBatch]:
    """Batches of at most ``rows`` rows, so that long texts are not all decoded at once."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def releasing(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``run`` for a task's batches, handing memory back when it ends.

    Python workers wait for further tasks, also of other operators, and would keep what they have.
    """

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()

    return wrapped


def as_bytes(column: pa.Array) -> list[bytes]:
    """A string column as UTF-8 bytes; nulls are empty."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [x or b"" for x in column.cast(kind).to_pylist()]


def as_text(column: pa.Array) -> list[str]:
    """A string column as Python strings; nulls are empty."""
    return pc.fill_null(column, "").to_pylist()


#: A key with more than one in so many of all rows is hot; there are no more such keys.
HOT_SHARE = 1000
#: Values that stand in for the keys of rows already looked up.
SPREAD = 4096


def hot_lookup(rows: DataFrame, lookup: DataFrame, key: str, columns: dict[str, str], count: str) -> DataFrame:
    """Left join of ``rows`` with ``lookup``, which is unique on the string ``key`` and has in ``count`` how many rows a key has.

    Keys with more than one in ``HOT_SHARE`` of the counted rows, at most ``HOT_SHARE`` of them, are sent to every task;
    their rows then go to the shuffle of all others under stand-in keys, spread evenly. ``columns`` maps columns of
    ``lookup`` to their names in the result.
    """
    total = lookup.agg(F.coalesce(F.sum(count), F.lit(0)).alias("total")).first()["total"]
    found = F.struct(*[F.col(source).alias(name) for source, name in columns.items()])
    is_hot = F.col(count) * HOT_SHARE > F.lit(total)
    hot = lookup.filter(is_hot).select(F.col(key).alias("_hot_key"), found.alias("_hot"))
    rest = lookup.filter(~is_hot).select(F.col(key).alias("_rest_key"), found.alias("_rest"))
    marked = rows.join(F.broadcast(hot), F.col(key) == F.col("_hot_key"), "left")
    # The stand-in hangs on the row's place, so that equal rows are spread too.
    stand_in = F.concat(F.lit("#"), F.pmod(F.monotonically_increasing_id(), F.lit(SPREAD)))
    keyed = marked.withColumn("_key", F.when(F.col("_hot_key").isNull(), F.col(key)).otherwise(stand_in))
    joined = keyed.join(rest, F.col("_key") == F.col("_rest_key"), "left")
    values = [F.coalesce(f"_hot.{name}", f"_rest.{name}").alias(name) for name in columns.values()]
    return joined.select(*[F.col(f"`{name}`") for name in rows.columns], *values)


def fold(column, parts: int):
    """CRC32 of a number's decimal text modulo ``parts``, which assigns rows to folds."""
    return F.pmod(F.crc32(column.cast("string")), F.lit(parts))
