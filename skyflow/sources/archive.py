"""Reading the date-partitioned archive.

A day holds a folder ``writer=.../batch_id=...`` per micro-batch. A finished day may be merged: a folder of the writer
``MERGED`` then stands for others, which a mark below ``MARKS`` names. Marks count once their run is complete.
"""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession

from skyflow.plans.staging import committed, folders

#: Writer of merged rows, and folder of the marks; Spark's readers pass over names that begin like this one.
MERGED = "merged"
MARKS = "_merged"


def day_folder(path: str, day: datetime.date) -> str:
    """Folder of a day."""
    return f"{path}/year={day.year}/month={day.month}/day={day.day}"


def _marks(spark: SparkSession, path: str, days: list[datetime.date]) -> tuple[set[str], set[str]]:
    """Merged folders of the days that have their mark, and folders they stand for, as paths below ``path``.

    The marks of a day are read only if it has any, and have as many rows as it had batches.
    """
    runs = {folder.rsplit("/", 1)[1] for folder, _ in committed(spark, f"{path}/{MARKS}/run=*")}
    merged, read = set(), []
    for day in days if runs else []:
        below = day_folder("", day)
        for folder in folders(spark, f"{path}/{MARKS}/run=*{below}"):
            run = folder.removesuffix(below).rsplit("/", 1)[1]
            if run in runs:
                merged.add(f"{below}/writer={MERGED}/batch_id={run.removeprefix('run=')}")
                read.append(folder)
    rows = spark.read.schema("folder STRING").json(read).collect() if read else []
    return merged, {row["folder"] for row in rows}


def day_folders(spark: SparkSession, path: str, days: list[datetime.date]) -> dict[datetime.date, list[str]]:
    """Folders of each day whose rows count, as paths below ``path``: batches that are not merged, and merged ones with a mark."""
    merged, replaced = _marks(spark, path, days)
    found = {}
    for day in days:
        below = day_folder("", day)
        there = [f"{below}/" + "/".join(f.rsplit("/", 2)[1:]) for f in folders(spark, f"{path}{below}/writer=*/batch_id=*")]
        counted = [f for f in there if f not in replaced and (f in merged or f"/writer={MERGED}/" not in f)]
        if counted:
            found[day] = counted
    return found


def replaced_folders(spark: SparkSession, path: str, days: list[datetime.date]) -> set[str]:
    """Folders of the days that merged ones stand for, as paths below ``path``."""
    return _marks(spark, path, days)[1]


def read_archive(
    spark: SparkSession,
    path: str,
    date_from: datetime.date,
    date_to: datetime.date,
) -> DataFrame:
    """Archived rows of the days ``date_from`` to ``date_to``, both included.

    Only the folders of those days are listed. Rows without an event time are in no day and are
    left out. Days without a folder have no rows; without any, the archive gives the columns.
    """
    days = [date_from + datetime.timedelta(n) for n in range((date_to - date_from).days + 1)]
    read = [f"{path}{folder}" for found in day_folders(spark, path, days).values() for folder in found]
    reader = spark.read.option("basePath", path)
    rows = reader.parquet(*read) if read else reader.parquet(path).limit(0)
    return rows.drop("writer", "batch_id")
