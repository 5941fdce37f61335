"""Adding airline, airport and city details to flights."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyflow.plans.joins import lookup_join, unique_lookup

# Details taken from each reference table, with the name each gets.
AIRLINE_DETAILS = {"airline_name": "airline_name", "country_name": "airline_country", "fleet_size": "airline_fleet_size"}
AIRPORT_DETAILS = ["airport_name", "country_iso2", "country_name", "city_iata_code", "latitude", "longitude", "timezone"]
CITY_DETAILS = {"city_name": "city_name", "country_iso2": "city_country_iso2"}


def _present(df: DataFrame, names) -> list[str]:
    return [name for name in names if name in df.columns]


def enrich_airline(flights: DataFrame, airlines: DataFrame, order: str = "id") -> DataFrame:
    """Airline of the callsign's three-letter prefix; a flight without a match keeps nulls."""
    details = _present(airlines, AIRLINE_DETAILS)
    lookup = unique_lookup(airlines, F.upper("icao_code"), details, order)
    prefix = F.upper(F.substring("callsign", 1, 3))
    return lookup_join(flights, prefix, lookup, {name: AIRLINE_DETAILS[name] for name in details})


def enrich_airports(info: DataFrame, airports: DataFrame, order: str = "id") -> DataFrame:
    """Details of the departure (``dep_``) and arrival (``arr_``) airport."""
    details = _present(airports, AIRPORT_DETAILS)
    lookup = unique_lookup(airports, F.upper("icao_code"), details, order)
    for column, prefix in (("estDepartureAirport", "dep_"), ("estArrivalAirport", "arr_")):
        info = lookup_join(info, F.upper(F.col(column)), lookup, {name: prefix + name for name in details})
    return info


def enrich_city(airports: DataFrame, cities: DataFrame, order: str = "id") -> DataFrame:
    """City of each airport by city code; of cities that share a code the first by ``order``."""
    details = _present(cities, CITY_DETAILS)
    lookup = unique_lookup(cities, F.upper("iata_code"), details, order)
    return lookup_join(airports, F.upper("city_iata_code"), lookup, {name: CITY_DETAILS[name] for name in details})
