"""Address to coordinates through a table of known addresses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def normalized_address(address: Column) -> Column:
    """Lower case, single spaces, no space at either end."""
    return F.lower(F.trim(F.regexp_replace(address, r"\s+", " ")))


def geocode(searches: DataFrame, gazetteer: DataFrame, rank: str | None = None) -> DataFrame:
    """Add `ulat` and `ulon` to each search whose address is known; drop the rest.

    `gazetteer` has `address`, `lat`, `lon`. Of several entries for an address
    the one with the smallest `rank` column, then the smallest coordinates,
    wins. Entries are reduced to one per address before the join, so a join
    key repeats on the search side only, where AQE can split it.
    """
    order = [rank] if rank else []
    best = F.min(F.struct(*order, "lat", "lon")).alias("best")
    known = (
        gazetteer.where(F.col("lat").isNotNull() & F.col("lon").isNotNull())
        .groupBy(normalized_address(F.col("address")).alias("_address")).agg(best)
        .select("_address", F.col("best.lat").alias("ulat"), F.col("best.lon").alias("ulon"))
    )
    return (
        searches.withColumn("_address", normalized_address(F.col("address")))
        .join(known, "_address").drop("_address")
    )
