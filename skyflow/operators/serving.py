"""Reads over the stored tables: maps, series, timelines and comparisons.

Each narrows by the table's key or time bucket first, so on Parquet the condition reaches
the scan; sorting applies to the narrowed rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyflow.functions.columns import HOUR
from skyflow.plans.ordering import first_per_key

# Steps under which forecast periods are listed, and for each step the longest period that uses it.
# Forecasts are valid for 30 hours at most; longer periods are faulty but kept.
PERIOD_STEPS = {HOUR: 30 * HOUR, 1_000 * HOUR: None}


def live_map(positions: DataFrame, minute: int) -> DataFrame:
    """Aircraft positions of one minute bucket."""
    return positions.filter(F.col("minute_bucket") == F.lit(minute))


def aircraft_state(current: DataFrame, icao24: str) -> DataFrame:
    """The current row of one aircraft."""
    return current.filter(F.col("icao24") == icao24)


def flight_track(waypoints: DataFrame, icao24: str, starttime: int) -> DataFrame:
    """Waypoints of one flight in time order."""
    return waypoints.filter((F.col("icao24") == icao24) & (F.col("starttime") == starttime)).orderBy("time")


def country_series(table: DataFrame, country_code: str, start: int, end: int) -> DataFrame:
    """Hourly series of a country or of ``GLOBAL``, both ends included."""
    inside = (F.col("country_code") == country_code) & F.col("hour_bucket").between(start, end)
    return table.filter(inside).orderBy("hour_bucket")


def metar_for_stations(latest: DataFrame, stations: list[str] | DataFrame) -> DataFrame:
    """Latest observations of the stations in view, given as a list or as a table with ``station_id``."""
    if isinstance(stations, DataFrame):
        return latest.join(stations.select("station_id"), "station_id", "left_semi")
    return latest.filter(F.col("station_id").isin(stations))


def newest_per_station(history: DataFrame, n: int = 1) -> DataFrame:
    """The newest ``n`` observations of every station."""
    return first_per_key(history, ["station_id"], [F.desc("obs_time")], n)


def metar_range(history: DataFrame, station: str, start: int, end: int) -> DataFrame:
    """Observations of a station in a time range, newest first."""
    inside = (F.col("station_id") == station) & F.col("obs_time").between(start, end)
    return history.filter(inside).orderBy(F.desc("obs_time"))


def active_sigmets(sigmets: DataFrame, at: int, longest_hours: int | None = None) -> DataFrame:
    """Warnings in force at ``at``, however long ago they began.

    If no stored warning is valid for more than ``longest_hours``, naming that limit leaves older
    hours unread; warnings that are valid for longer are then missed.
    """
    in_force = (F.col("valid_from") <= at) & (F.col("valid_to") >= at) & (F.col("hour_bucket") <= at)
    if longest_hours is not None:
        in_force = in_force & (F.col("hour_bucket") >= at - at % HOUR - longest_hours * HOUR)
    return sigmets.filter(in_force)


def at_altitude(sigmets: DataFrame, feet: int) -> DataFrame:
    """Warnings whose vertical extent holds an altitude."""
    return sigmets.filter((F.col("base") <= feet) & (F.col("top") >= feet))


def latest_taf(taf: DataFrame, station: str) -> DataFrame:
    """All periods of the newest bulletin of a station, in period order."""
    newest = F.rank().over(Window.partitionBy("station_id").orderBy(F.desc("issue_time")))
    periods = taf.filter(F.col("station_id") == station).withColumn("_rank", newest)
    return periods.filter("_rank = 1").drop("_rank").orderBy("time_group", "valid_from")


def taf_window(taf: DataFrame, station: str, issue_time: int, start: int, end: int) -> DataFrame:
    """Periods of one bulletin that lie inside a time window."""
    bulletin = (F.col("station_id") == station) & (F.col("issue_time") == issue_time)
    return taf.filter(bulletin & (F.col("valid_from") >= start) & (F.col("valid_to") <= end))


def compare_forecast(history: DataFrame, taf: DataFrame) -> DataFrame:
    """Each observation beside the forecast that was valid then, and whether the category agrees.

    Of the periods of bulletins issued by then that hold the observation time (start in,
    end out), the newest bulletin counts, then the latest period in it. Observations
    without such a period are left out.

    Periods are listed under each step they touch, and meet observations of that step, so the
    range condition runs inside a station and step and not over a station's whole history. The
    step is an hour, and wider for periods that would touch too many; observations are listed
    under every width, so one join serves all.
    """
    length = F.col("valid_to") - F.col("valid_from")
    step = F.lit(None).cast("long")
    for width, longest in reversed(PERIOD_STEPS.items()):
        own = F.lit(width).cast("long")
        step = own if longest is None else F.when(length <= longest, own).otherwise(step)
    periods = taf.filter(F.col("valid_from") < F.col("valid_to")).select(
        "station_id",
        "issue_time",
        "time_group",
        "valid_from",
        "valid_to",
        F.col("fltcat").alias("forecast_fltcat"),
        step.alias("_step"),
    )
    touched = F.sequence(F.floor(F.col("valid_from") / F.col("_step")), F.floor((F.col("valid_to") - 1) / F.col("_step")))
    listed = periods.withColumn("_place", F.explode(touched))
    observed = history.select(
        "station_id",
        "obs_time",
        F.col("fltcat").alias("observed_fltcat"),
        F.explode(F.array(*[F.lit(width).cast("long") for width in PERIOD_STEPS])).alias("_step"),
    ).withColumn("_place", F.floor(F.col("obs_time") / F.col("_step")))
    valid = (
        (F.col("obs_time") >= F.col("valid_from"))
        & (F.col("obs_time") < F.col("valid_to"))
        & (F.col("issue_time") <= F.col("obs_time"))
    )
    pairs = observed.join(listed, ["station_id", "_step", "_place"]).filter(valid)
    chosen = pairs.groupBy("station_id", "obs_time", "observed_fltcat").agg(
        F.max(F.struct("issue_time", "time_group", "valid_from", "valid_to", "forecast_fltcat")).alias("f")
    )
    return chosen.select(
        "station_id",
        "obs_time",
        "observed_fltcat",
        "f.issue_time",
        "f.time_group",
        "f.forecast_fltcat",
        (F.col("observed_fltcat") == F.col("f.forecast_fltcat")).alias("match"),
    )


def share_by(df: DataFrame, dimension: str) -> DataFrame:
    """Rows per value of a dimension."""
    return df.groupBy(dimension).agg(F.count("*").alias("cnt"))


def timeline(df: DataFrame, time: str, dimension: str, metric: Column, name: str) -> DataFrame:
    """A metric per time bucket and dimension, in time order."""
    return df.groupBy(time, dimension).agg(metric.alias(name)).orderBy(time, dimension)


def departures_vs_arrivals(departures: DataFrame, arrivals: DataFrame, keys: list[str]) -> DataFrame:
    """Both counts side by side per key, 0 where one side has none.

    One aggregation over both tables takes the place of a full outer join.
    """
    nothing = F.lit(0).cast("long")
    both = departures.select(*keys, "departures_cnt", nothing.alias("arrivals_cnt")).unionByName(
        arrivals.select(*keys, nothing.alias("departures_cnt"), "arrivals_cnt")
    )
    return both.groupBy(*keys).agg(
        F.sum("departures_cnt").alias("departures_cnt"), F.sum("arrivals_cnt").alias("arrivals_cnt")
    )


def table_profile(df: DataFrame, key: list[str]) -> DataFrame:
    """One row: number of rows, and distinct non-null keys."""
    return df.agg(F.count("*").alias("row_count"), F.count_distinct(*key).alias("distinct_keys"))


def table_sample(df: DataFrame, order: list[str], limit: int) -> DataFrame:
    """The first ``limit`` rows by ``order`` to look at; every task keeps that many, nothing is sorted in full."""
    return df.orderBy(*order).limit(limit)
