"""Station rows to the JSON messages the feed delivers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockline import schemas

# Fixed value: stations of one page, as the feed limits them.
PAGE_SIZE = 100


def station_struct(df: DataFrame) -> Column:
    """Nest a flat station row into the feed's record; absent columns are left out."""
    # Feed fields built from other columns.
    nested = {
        "coordonnees_geo": ({"lat", "lon"}, F.struct("lon", "lat")),
        "nom_arrondissement_communes": ({"arrondissement"}, F.col("arrondissement")),
    }
    fields = []
    for name in schemas.STATION.names:
        needs, column = nested.get(name, ({name}, F.col(name)))
        if needs <= set(df.columns):
            fields.append(column.alias(name))
    return F.struct(*fields)


def single_envelopes(df: DataFrame, *keep: str) -> DataFrame:
    """One message per station row. Row-wise, so it also streams."""
    envelope = F.struct(F.lit(1).cast("long").alias("total_count"), F.array(station_struct(df)).alias("results"))
    return df.select(*keep, F.to_json(envelope).alias("value"))


def make_envelopes(df: DataFrame, page: Column, total: Column | None = None) -> DataFrame:
    """One message per page of stations, with the columns `page` and `value`.

    `page` must hold few rows each, as the feed's pages do: all rows of a page
    meet in one task. `total` is the feed's overall station count; it defaults
    to the count of the page.
    """
    paged = df.select(
        page.alias("page"), station_struct(df).alias("station"),
        (F.lit(None) if total is None else total).cast("long").alias("total"),
    )
    count = F.coalesce(F.max("total"), F.count("*"))
    return paged.groupBy("page").agg(
        F.to_json(F.struct(count.alias("total_count"), F.collect_list("station").alias("results")))
        .alias("value")
    )


def page_of(key: Column, size: int = PAGE_SIZE) -> Column:
    """Page number of a dense integer key."""
    return F.call_function("div", key.cast("long"), F.lit(size))
