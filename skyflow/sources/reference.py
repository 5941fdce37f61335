"""Airport, airline and city tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyflow.functions.columns import trim_strings
from skyflow.sources.arrays import array_elements
from skyflow.sources.schemas import REFERENCE_NUMBERS, REFERENCE_SCHEMAS


def read_reference(spark: SparkSession, path: str, kind: str, multi_line: bool = False) -> DataFrame:
    """Read ``airports``, ``airlines`` or ``cities`` from JSON lines, which Spark splits.

    The files hold text only: text is stripped and numbers are cast, bad ones to null.
    With ``multi_line`` a file is one JSON array, whose elements are found by as many tasks as lines would be.
    """
    schema = REFERENCE_SCHEMAS[kind]
    if multi_line:
        read = array_elements(spark, path).select(F.inline(F.array(F.from_json("value", schema))))
    else:
        read = spark.read.schema(schema).json(path)
    rows = trim_strings(read)
    return rows.withColumns(
        {name: F.col(name).try_cast(target) for name, target in REFERENCE_NUMBERS[kind].items()}
    )
