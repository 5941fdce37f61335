"""Take-offs and landings from consecutive on-ground flags."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyflow.functions.columns import DAY, bucket
from skyflow.plans.ordering import ingest_order


def state_per_second(flights: DataFrame) -> DataFrame:
    """The on-ground flag of each aircraft at each second it reported one.

    Of several reports of one second the last by ingest order counts. Copies are combined
    inside each task, and after this step an aircraft has at most 86,400 rows a day.
    """
    known = flights.filter(
        F.col("icao24").isNotNull() & F.col("time_position").isNotNull() & F.col("on_ground").isNotNull()
    )
    order = ingest_order(known)
    if order is None:
        order = F.struct("last_contact", "on_ground")
    return known.groupBy("icao24", "time_position").agg(F.max_by("on_ground", order).alias("on_ground"))


def event_name(on_ground: Column) -> Column:
    """What a change to this flag means."""
    return F.when(on_ground, "arrival").otherwise("departure")


def ground_transitions(flights: DataFrame) -> DataFrame:
    """``icao24, time, event``: a departure or arrival at the first second with the new flag.

    Days of an aircraft are compared inside themselves and then with one another, so no
    task sorts the whole history of one aircraft.
    """
    states = state_per_second(flights).withColumn("_day", bucket(F.col("time_position"), DAY))
    within = Window.partitionBy("icao24", "_day").orderBy("time_position")
    inside = states.select("icao24", "time_position", "on_ground", F.lag("on_ground").over(within).alias("_before"))

    edges = states.groupBy("icao24", "_day").agg(
        F.min("time_position").alias("time_position"),
        F.min_by("on_ground", "time_position").alias("on_ground"),
        F.max_by("on_ground", "time_position").alias("_last"),
    )
    days = Window.partitionBy("icao24").orderBy("_day")
    between = edges.select("icao24", "time_position", "on_ground", F.lag("_last").over(days).alias("_before"))

    changes = inside.unionByName(between).filter(F.col("_before") != F.col("on_ground"))
    return changes.select("icao24", F.col("time_position").alias("time"), event_name(F.col("on_ground")).alias("event"))
