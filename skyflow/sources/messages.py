"""Reading topics as raw messages, and telling good messages from bad ones."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyflow.sources.parse import METADATA
from skyflow.sources.schemas import RAW_MESSAGE

START_POSITIONS = ("earliest", "latest")


def starting_offsets(position: str) -> str:
    """Check a start position: ``earliest`` replays, ``latest`` tails, JSON names exact offsets."""
    if position in START_POSITIONS or position.lstrip().startswith("{"):
        return position
    raise ValueError(f"start position must be one of {START_POSITIONS} or offsets as JSON: {position!r}")


def _modified_from(position: str) -> datetime.datetime | None:
    """The time from which a file stream takes files; None for all of them."""
    if position == "earliest":
        return None
    try:
        at = datetime.datetime.fromisoformat(position)
    except ValueError:
        raise ValueError(f"a file stream starts at earliest or at a time in ISO format, not at {position!r}") from None
    return at if at.tzinfo else at.replace(tzinfo=datetime.UTC)


def read_topics(
    spark: SparkSession,
    source: str,
    topics: list[str],
    *,
    location: str,
    position: str = "latest",
    fail_on_data_loss: bool = True,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """Subscribe to several topics at once; key and value arrive as text.

    ``source`` is a streaming format. For ``kafka``, ``location`` holds the bootstrap
    servers. For a file format (``json`` or ``parquet``) it is a folder with rows of
    ``RAW_MESSAGE``; there the position is ``earliest`` or a time in ISO format, from which
    on a file must have been written. A time holds over restarts, which ``latest`` could not.
    """
    reader = spark.readStream.format(source).options(**(options or {}))
    if source == "kafka":
        messages = (
            reader.option("kafka.bootstrap.servers", location)
            .option("subscribe", ",".join(topics))
            .option("startingOffsets", starting_offsets(position))
            .option("failOnDataLoss", str(fail_on_data_loss).lower())
            .load()
        )
    else:
        start = _modified_from(position)
        messages = reader.schema(RAW_MESSAGE).load(location).filter(F.col("topic").isin(*topics))
        if start is not None:
            messages = messages.filter(F.col("_metadata.file_modification_time") >= F.lit(start))
    return messages.select(
        F.col("key").cast("string"),
        F.col("value").cast("string"),
        "topic",
        "partition",
        "offset",
        "timestamp",
    )


def read_stream(spark: SparkSession, source: str, topic: str, **settings) -> DataFrame:
    """Subscribe to one topic, with the settings of ``read_topics``."""
    return read_topics(spark, source, [topic], **settings)


def route_by_topic(raw: DataFrame, topic: str) -> DataFrame:
    """The messages of one topic, tagged with ``_source_topic``."""
    return raw.filter(F.col("topic") == topic).withColumn("_source_topic", F.col("topic"))


def with_message_metadata(raw: DataFrame) -> DataFrame:
    """Attach topic, partition, offset, key and message time (epoch ms) as one struct."""
    return raw.withColumn(
        METADATA,
        F.struct(
            "topic",
            "partition",
            "offset",
            "key",
            F.unix_millis("timestamp").alias("timestamp"),
        ),
    )


def is_malformed(schema: str | None = None) -> Column:
    """True for a message whose ``value`` is not a JSON object, or has a field of another type than ``schema`` says."""
    # Without fields, the corrupt column alone checks the syntax and builds nothing.
    fields = f"{schema}, _corrupt STRING" if schema else "_corrupt STRING"
    parsed = F.from_json("value", fields, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    return F.col("value").isNull() | parsed["_corrupt"].isNotNull()


def split_malformed(raw: DataFrame, schema: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Messages that are JSON objects with fields as in ``schema``, and messages that cannot be decoded."""
    return raw.filter(~is_malformed(schema)), raw.filter(is_malformed(schema))


def decoding_counts(raw: DataFrame, schema: str | None = None) -> DataFrame:
    """One row with the messages consumed, processed and failed."""
    return raw.withColumn("_fault", is_malformed(schema)).agg(
        F.count("*").alias("consumed"),
        F.count_if(~F.col("_fault")).alias("processed"),
        F.count_if("_fault").alias("failed"),
    )
