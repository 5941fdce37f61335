"""Session settings the library is written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Settings that results depend on, or that large inputs need. Parallelism, memory and
# storage are left to whoever submits the job.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(app_name: str, **settings: str) -> SparkSession:
    """A session with ``SETTINGS``; further settings use ``__`` for the dots."""
    builder = SparkSession.builder.appName(app_name)
    extra = {name.replace("__", "."): value for name, value in settings.items()}
    for name, value in {**SETTINGS, **extra}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def apply_settings(spark: SparkSession) -> None:
    """Set ``SETTINGS`` on a session that someone else has built."""
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
