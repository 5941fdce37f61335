"""Elements of JSON arrays that are too large for one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Whether a block of a file may begin outside or inside a quoted text.
STARTS = (0, 1)


def _opened(bare: Column, inside: int) -> Column:
    """Opening braces outside quoted texts, in a piece without escapes that begins outside or inside one."""
    plain = F.regexp_replace(F.concat(F.lit('"' * inside), bare), r'"[^"]*+(?:"|\z)', "")
    return F.length(F.regexp_replace(plain, r"[^{]++", ""))


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """The text between closing braces, with its file, block and place, and what it does to quotes and depth.

    ``closes_0`` and ``depth_0`` hold if the block begins outside a quoted text, the others if inside: whether the
    brace after the piece counts, and the braces still open then, counted from the block's start.
    """
    file = F.col("_metadata")
    rows = spark.read.option("lineSep", "}").text(path).select(
        file["file_path"].alias("file"), file["file_block_start"].alias("block"), F.monotonically_increasing_id().alias("place"), "value"
    )
    bare = F.regexp_replace("value", r"(?s)\\.", "")
    rows = rows.withColumns(
        {"quotes": F.length(F.regexp_replace(bare, r'[^"]++', "")), **{f"opened_{s}": _opened(bare, s) for s in STARTS}}
    )
    # No block is larger than spark.sql.files.maxPartitionBytes, so one task can hold it.
    order = Window.partitionBy("file", "block").orderBy("place")
    rows = rows.withColumn("before", F.coalesce(F.sum("quotes").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    for start in STARTS:
        inside = (F.col("before") + start) % 2 == 1
        opened = F.when(inside, F.col("opened_1")).otherwise(F.col("opened_0"))
        rows = rows.withColumn(f"closes_{start}", (F.col("before") + F.col("quotes") + start) % 2 == 0)
        step = opened - F.col(f"closes_{start}").cast("int")
        rows = rows.withColumn(f"depth_{start}", F.sum(step).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return rows.drop("before", "opened_0", "opened_1")


def _blocks(pieces: DataFrame) -> DataFrame:
    """One row per block of a file: the quotes and braces open at its start, and the elements that end before it.

    An element ends where no brace is left open, which is as low as a block's depth can get.
    """
    block = Window.partitionBy("file", "block")
    lowest = lambda s: F.min(F.when(F.col(f"closes_{s}"), F.col(f"depth_{s}"))).over(block)
    sums = [F.sum("quotes").alias("quotes")]
    for s in STARTS:
        sums += [
            F.max_by(f"depth_{s}", "place").alias(f"net_{s}"),
            F.first(f"low_{s}").alias(f"low_{s}"),
            F.count_if(F.col(f"closes_{s}") & (F.col(f"depth_{s}") == F.col(f"low_{s}"))).alias(f"ends_{s}"),
        ]
    found = pieces.withColumns({f"low_{s}": lowest(s) for s in STARTS}).groupBy("file", "block").agg(*sums)
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    total = lambda column: F.coalesce(F.sum(column).over(earlier), F.lit(0))
    true = lambda name: F.when(F.col("inside"), F.col(f"{name}_1")).otherwise(F.col(f"{name}_0"))
    return (
        found.withColumn("inside", total("quotes") % 2 == 1)
        .withColumn("open", total(true("net")))
        .withColumn("ended", F.when(true("low") == -F.col("open"), true("ends")).otherwise(0))
        .select("file", "block", "inside", "open", total("ended").alias("ended"))
    )


def array_elements(spark: SparkSession, path: str) -> DataFrame:
    """One ``value`` per object of the JSON arrays in the files of ``path``, as text; each file holds one array.

    Files are cut at closing braces, in as many tasks as lines would be. Whether a brace stands in a text, and how
    deep, follows from sums over the pieces of a block and then over the blocks of a file. Elements that are no
    objects are left out; of an array that breaks off, the last element is not whole.
    """
    pieces = _pieces(spark, path)
    placed = pieces.join(_blocks(pieces), ["file", "block"])
    true = lambda name: F.when(F.col("inside"), F.col(f"{name}_1")).otherwise(F.col(f"{name}_0"))
    is_end = (true("closes") & (F.col("open") + true("depth") == 0)).cast("int")
    order = Window.partitionBy("file", "block").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    number = F.col("ended") + F.coalesce(F.sum("is_end").over(order), F.lit(0))
    elements = (
        placed.withColumn("is_end", is_end)
        .withColumn("number", number)
        .groupBy("file", "number")
        .agg(F.sort_array(F.collect_list(F.struct("block", "place", "value"))).alias("parts"))
    )
    text = F.regexp_replace(F.array_join(F.col("parts.value"), "}"), r"^[^{]++", "")
    return elements.select(text.alias("value")).filter("value LIKE '{%'").select(F.concat("value", F.lit("}")).alias("value"))
