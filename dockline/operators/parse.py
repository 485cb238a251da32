"""Raw messages to flat station rows. No actions, so every step also streams."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from dockline import schemas
from dockline.functions import station
from dockline.operators.enrich import enrich_names


def parse_json(
    messages: DataFrame, schema: StructType = schemas.ENVELOPE_PARSED, keep: Sequence[str] = ()
) -> DataFrame:
    """Parse the `value` column into the struct `data`.

    Permissive: a malformed message gives a null struct and a value of the
    wrong type a null field. `keep` names columns carried along, such as the
    topic offset.
    """
    return messages.select(*keep, F.from_json(F.col("value").cast("string"), schema).alias("data"))


def explode_results(parsed: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """One row per station; null or empty results give none."""
    return parsed.select(*keep, F.explode("data.results").alias("station"))


def parse_station(exploded: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Flatten the station struct into its 15 output columns."""
    # Source fields whose output name differs.
    source = {
        "lat": "coordonnees_geo.lat",
        "lon": "coordonnees_geo.lon",
        "arrondissement": "nom_arrondissement_communes",
    }
    return exploded.select(
        *[F.col(f"station.{source.get(c, c)}").alias(c) for c in schemas.STATION_FLAT.names], *keep
    )


def derive(stations: DataFrame, ingest_time: Column | None = None) -> DataFrame:
    """Add ingest time, the full flag and the dominant bike type."""
    return stations.withColumns({
        "timestamp": F.current_timestamp() if ingest_time is None else ingest_time,
        "is_full": station.is_full(),
        "type_dominant": station.type_dominant(),
    })


# Columns by which rows of one poll are told from those of another.
POLL_KEY = "^[0-9]{1,18}:[0-9]{1,18}$"
POLL = ("polled_at", "page_offset", "total_count", "page_stations")


def poll_identity(messages: DataFrame) -> DataFrame:
    """Add when the message's page was polled, where the page starts, and how many stations poll and page have.

    The first two come from the key that the poll job writes; with another key
    or none they are null.
    """
    key = F.col("key").cast("string")
    part = lambda i: F.when(key.rlike(POLL_KEY), F.get(F.split(key, ":"), F.lit(i))).cast("bigint")
    value = F.col("value").cast("string")
    total = F.get_json_object(value, "$.total_count").try_cast("bigint")
    stations = F.json_array_length(F.get_json_object(value, "$.results")).cast("bigint")
    return messages.withColumns(dict(zip(POLL, (part(0), part(1), total, stations), strict=True)))


def transform(
    messages: DataFrame,
    code_lookup: DataFrame | None = None,
    ingest_time: Column | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Raw messages to output rows: parse, flatten, derive, name.

    `keep` columns follow the output columns. Without a lookup, `name_custom`
    is null.
    """
    rows = parse_station(explode_results(parse_json(messages, keep=keep), keep), keep)
    rows = derive(rows, ingest_time)
    if code_lookup is None:
        rows = rows.withColumn("name_custom", F.lit(None).cast("string"))
    else:
        rows = enrich_names(rows, code_lookup)
    return rows.select(*schemas.STATION_OUT.names, *keep)
