"""Checks that stored tables are filled and make sense."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyflow.functions.geo import is_position

# Tables that hold positions, and tables with a country code.
POSITIONS = "aircraftstates_by_icao24"
ACTIVITY = "activeaircraft_by_country_hour"
DEPARTURES = "departures_by_country_hour"
ARRIVALS = "arrivals_by_country_hour"


def quality_report(tables: dict[str, DataFrame], country: str = "VN") -> DataFrame:
    """Checks as rows ``check, table, value, ok``.

    Every table must hold rows; activity must include ``country``; waypoints must include
    valid positions; departures and arrivals must both name two-letter countries. Each
    table is read once, by one aggregate whose checks become rows.
    """
    iso2 = F.col("country_code").rlike("^[A-Z]{2}$")
    extra = {
        ACTIVITY: [("country_present", F.count_if(F.col("country_code") == country))],
        POSITIONS: [("valid_positions", F.count_if(is_position(F.col("lat"), F.col("lon"))))],
        DEPARTURES: [("countries", F.count_distinct(F.when(iso2, F.col("country_code"))))],
        ARRIVALS: [("countries", F.count_distinct(F.when(iso2, F.col("country_code"))))],
    }

    def checked(name: str, df: DataFrame) -> DataFrame:
        measures = [("rows", F.count("*")), *extra.get(name, [])]
        totals = df.agg(*[value.alias(check) for check, value in measures])
        lines = F.array(*[F.struct(F.lit(check).alias("check"), F.col(check).alias("value")) for check, _ in measures])
        return totals.select(F.explode(lines).alias("line")).select(
            "line.check", F.lit(name).alias("table"), "line.value", (F.col("line.value") > 0).alias("ok")
        )

    return reduce(DataFrame.unionByName, [checked(name, df) for name, df in tables.items()])
