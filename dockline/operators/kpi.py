"""Availability indicators, all from one aggregate pass over one snapshot."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockline.functions import station
from dockline.functions.text import percent_text


def _counters() -> dict[str, Column]:
    """Additive measures: summing them over groups gives the overall value."""
    return {
        "nb_stations": F.count(F.lit(1)),
        "nb_full": F.count_if(station.is_full()),
        "nb_empty": F.count_if(station.is_empty()),
        "nb_active": F.count_if(station.is_active()),
        "total_ebike": F.sum("ebike"),
        "total_mechanical": F.sum("mechanical"),
        "total_docks": F.sum("numdocksavailable"),
        "total_bikes": F.sum("numbikesavailable"),
    }


def counters(df: DataFrame, *by: str) -> DataFrame:
    """The additive measures, overall or by the given columns."""
    return df.groupBy(*by).agg(*[c.alias(name) for name, c in _counters().items()])


def combine(partial: DataFrame) -> DataFrame:
    """Overall measures from grouped ones."""
    return partial.agg(*[F.sum(name).alias(name) for name in _counters()])


def _share(part: str) -> Column:
    total = F.col("nb_stations")
    return F.when(total > 0, F.col(part) / total).otherwise(F.lit(0.0))


def indicators(measures: DataFrame) -> DataFrame:
    """All indicators from the measures; no stations give zeros."""
    names = list(_counters())
    return measures.select(
        *[c for c in measures.columns if c not in names],
        *[F.coalesce(F.col(c), F.lit(0).cast("long")).alias(c) for c in names],
    ).withColumns({
        "nb_inactive": F.col("nb_stations") - F.col("nb_active"),
        "full_rate": _share("nb_full"),
        "empty_rate": _share("nb_empty"),
        "pct_full": _share("nb_full") * 100.0,
        "pct_empty": _share("nb_empty") * 100.0,
    })


def kpis(df: DataFrame) -> DataFrame:
    """One row with every indicator; columns not selected are not computed."""
    return indicators(counters(df))


def kpi_text(kpi: DataFrame) -> DataFrame:
    return kpi.select(
        percent_text(F.col("pct_full")).alias("full_text"),
        percent_text(F.col("pct_empty")).alias("empty_text"),
    )


def sum_by_area(df: DataFrame) -> DataFrame:
    """Bike totals by area; stations without an area form their own group."""
    return df.groupBy("arrondissement").agg(
        F.sum("numbikesavailable").alias("sum_bikes"),
        F.sum("mechanical").alias("sum_mechanical"),
        F.sum("ebike").alias("sum_ebike"),
    )


def bike_split(kpi: DataFrame) -> DataFrame:
    """Electric and mechanical totals with their share, one row per type."""
    total = F.col("total_ebike") + F.col("total_mechanical")
    rows = F.array(*[
        F.struct(F.lit(kind).alias("bike_type"), F.col(column).alias("bikes"))
        for kind, column in (("electrique", "total_ebike"), ("mecanique", "total_mechanical"))
    ])
    return kpi.select(total.alias("total"), F.inline(rows)).select(
        "bike_type", "bikes",
        F.when(F.col("total") > 0, F.col("bikes") / F.col("total")).otherwise(F.lit(0.0)).alias("share"),
    )
