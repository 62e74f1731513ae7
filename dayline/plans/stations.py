"""Placing stations in municipalities and choosing the ones to follow."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from dayline.operators.aggregates import availability, best_per_key
from dayline.operators.joins import written
from dayline.operators.spatial import best_through_polygons, match_through_polygons
from dayline.schemas import conform

# Measures of a station and the flags that say they are available.
MEASURES = {
    "precipitation_total": "precipitation_available",
    "temperature_mean": "temperature_available",
    "humidity_mean": "humidity_available",
    "wind_speed_mean": "wind_speed_available",
    "atmospheric_pressure_mean": "atmospheric_pressure_available",
    "solar_rad_total": "solar_rad_available",
}
ELEVATION_LIMIT = 1600


def place_stations(stations: DataFrame, municipalities: DataFrame, vertices: DataFrame,
                   cell: float) -> DataFrame:
    """Stations with the code of the municipality whose polygon holds both of them."""
    sites = stations.withColumns({"x": F.col("lon"), "y": F.col("lat")})
    towns = municipalities.select("code", F.col("lon").alias("x"), F.col("lat").alias("y"))
    carry = [c for c in stations.columns if c != "station_id"]
    placed = match_through_polygons(sites, towns, vertices, cell, "station_id", "code",
                                    carry=carry)
    return placed.drop("poly_id").withColumnRenamed("code", "mun_code")


class Placed(NamedTuple):
    """Stations once each, and where they meet municipalities: what a station table is the join of."""
    stations: DataFrame
    municipalities: DataFrame
    vertices: DataFrame
    cell: float


def station_table(stations: DataFrame, readings: DataFrame, municipalities: DataFrame,
                  vertices: DataFrame, cell: float, lo=None, hi=None,
                  measures: Mapping[str, str] = MEASURES, joined: bool = True) -> DataFrame | Placed:
    """Placed stations with the availability of their sensors in ``[lo, hi]``.

    A station is in the table once for each municipality and polygon that holds both, so where polygons
    overlap the table is many times as long as its sources. Without ``joined`` the stations are
    written once each and their municipalities are left to :func:`link_stations`.
    """
    seen = availability(stations, readings, "station_id", measures, "date", lo, hi)
    if joined:
        return conform(place_stations(seen, municipalities, vertices, cell), "weather_station")
    towns = conform(municipalities, StructType.fromDDL("code smallint, lat double, lon double"))
    return Placed(written(conform(seen, "weather_station").drop("mun_code"), "stations"), towns, vertices, cell)


def max_sensors_min_elevation(stations: DataFrame | Placed, elevation_limit: int = ELEVATION_LIMIT
                              ) -> DataFrame:
    """Per municipality the low-lying stations with most sensors, then lowest; ties stay."""
    usable, order = (F.col("elev") < elevation_limit) & (F.col("n_sensors") > 0), {"n_sensors": "desc", "elev": "asc"}
    if isinstance(stations, Placed):
        sites = stations.stations.filter(usable).withColumns({"x": F.col("lon"), "y": F.col("lat")})
        towns = stations.municipalities.select("code", F.col("lon").alias("x"), F.col("lat").alias("y"))
        best = best_through_polygons(sites, towns, stations.vertices, stations.cell, "station_id", "code", order)
        return best.select(F.col("code").alias("municipality_code"), "station_id")
    best = best_per_key(stations.filter(usable), ["mun_code"], order)
    return best.select(F.col("mun_code").alias("municipality_code"), "station_id")


RULES: dict[str, Callable[..., DataFrame]] = {"max_sensors_min_elevation": max_sensors_min_elevation}


def link_stations(table: DataFrame | Placed, rule: str = "max_sensors_min_elevation", **options
                  ) -> DataFrame:
    """The chosen links. ``table`` is read twice, so pass the stored station table, or what it is the join of."""
    if rule not in RULES:
        raise ValueError(f"unknown rule {rule!r}")
    return conform(RULES[rule](table, **options), "municipality_station_link")
