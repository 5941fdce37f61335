"""Parsed rows and lookup tables for the queries: messages made from the given tables, then parsed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import fixtures
from skyflow.operators.places import PlaceIndex, build_place_index
from skyflow.sources import parse
from skyflow.sources.messages import with_message_metadata


def states(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse.parse_flight_states(with_message_metadata(fixtures.flight_state_messages(spark, sf_dir)))


def info(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse.parse_flight_info(with_message_metadata(fixtures.flight_info_messages(spark, sf_dir)))


def tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse.parse_flight_tracks(with_message_metadata(fixtures.flight_track_messages(spark, sf_dir)))


def metar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse.parse_metar(with_message_metadata(fixtures.metar_messages(spark, sf_dir)))


def taf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse.parse_taf(with_message_metadata(fixtures.taf_messages(spark, sf_dir)))


def sigmet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse.parse_sigmet(with_message_metadata(fixtures.sigmet_messages(spark, sf_dir)))


def airports(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.rows(spark, sf_dir, "airports").withColumnRenamed("seq", "id")


def airlines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.rows(spark, sf_dir, "airlines").withColumnRenamed("seq", "id")


def cities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.rows(spark, sf_dir, "cities").withColumnRenamed("seq", "id")


def places(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cities(spark, sf_dir).select(
        "id", F.col("latitude").alias("lat"), F.col("longitude").alias("lon"), F.col("country_iso2").alias("country")
    )


def place_index(spark: SparkSession, sf_dir: str) -> PlaceIndex:
    return build_place_index(places(spark, sf_dir))
