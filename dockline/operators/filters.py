"""Filters and lists over one snapshot."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockline.functions import station

LIST_FULL = ("stationcode", "name", "numbikesavailable", "arrondissement")
LIST_EMPTY = ("stationcode", "name", "numdocksavailable", "arrondissement")
TABLE = ("stationcode", "name", "numbikesavailable", "numdocksavailable", "arrondissement")


def full_stations(df: DataFrame) -> DataFrame:
    """Stations flagged full; unknown dock counts are left out."""
    return df.where(F.col("is_full"))


def empty_stations(df: DataFrame) -> DataFrame:
    return df.where(station.is_empty())


def active_stations(df: DataFrame) -> DataFrame:
    return df.where(station.is_active())


def map_filter(df: DataFrame, choice: str = "all") -> DataFrame:
    """Stations shown on the map: `all`, `full` (no free dock) or `empty` (no bike)."""
    if choice == "all":
        return df
    return df.where({"full": station.is_full, "empty": station.is_empty}[choice]())


def list_full(df: DataFrame) -> DataFrame:
    return full_stations(df).select(*LIST_FULL)


def list_empty(df: DataFrame) -> DataFrame:
    return empty_stations(df).select(*LIST_EMPTY)


def project_existing(df: DataFrame, wanted: Sequence[str] = TABLE) -> DataFrame:
    """The wanted columns that df has, in the wanted order."""
    return df.select(*[c for c in wanted if c in df.columns])


def fill_area(df: DataFrame) -> DataFrame:
    return df.withColumn("arrondissement", station.area_or_default())


def stations_table(df: DataFrame) -> DataFrame:
    """All stations by area.

    The station code as second key makes the order total and lets the range
    partitioning cut through an area that holds many rows.
    """
    return project_existing(df).orderBy(F.asc_nulls_last("arrondissement"), "stationcode")
