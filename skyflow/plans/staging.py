"""Tables written once and read several times."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

_chosen: dict[str, str] = {}


def use_folder(spark: SparkSession, folder: str) -> None:
    """Name the shared folder of a session whose cluster names none, as in local runs."""
    _chosen[spark.sparkContext.applicationId] = folder


def has_folder(spark: SparkSession) -> bool:
    """Whether ``shared_folder`` has an answer."""
    return bool(spark.conf.get("spark.checkpoint.dir", None)) or spark.sparkContext.applicationId in _chosen


def shared_folder(spark: SparkSession) -> str:
    """Folder all executors can reach: ``spark.checkpoint.dir`` of the session."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or _chosen.get(spark.sparkContext.applicationId)
    if not folder:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return folder.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that nothing uses yet."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage in a way that survives lost executors, and gives the optimizer the
    real size of the table instead of an estimate multiplied through its joins. A caller that
    gives a ``path`` of ``new_folder`` can remove the table when nothing reads it any more.
    """
    path = path or new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder, a staged table or another."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def committed(spark: SparkSession, pattern: str) -> list[tuple[str, int]]:
    """Folders that match ``pattern`` and have a success marker, with the marker's time in seconds."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{pattern}/_SUCCESS")
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    statuses = system.globStatus(path) or []
    return [(s.getPath().getParent().toString(), s.getModificationTime() // 1000) for s in statuses]


def folders(spark: SparkSession, pattern: str) -> list[str]:
    """Folders that match ``pattern``."""
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(s.getPath().toString() for s in system.globStatus(path) or [] if s.isDirectory())
