"""Lookups: code to name, name to department.

The joins carry no hint. Spark broadcasts a lookup whose size is below
spark.sql.autoBroadcastJoinThreshold, before the job from file statistics or
during it from measured shuffle sizes. A larger lookup is shuffled, and AQE
splits the partition of a station that holds too many rows, which a left join
allows on the station side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockline.functions.station import UNKNOWN_DEPARTMENT


def enrich_names(stations: DataFrame, code_lookup: DataFrame) -> DataFrame:
    """Left join on `stationcode`; codes match exactly and are not trimmed.

    A station stays one row: of a code's lookup rows the smallest counts.
    """
    return stations.join(one_per_key(code_lookup, "stationcode"), ["stationcode"], "left")


def enrich_department(stations: DataFrame, department_lookup: DataFrame) -> DataFrame:
    """Add `department` by station name, `Unknown` where the lookup has none.

    A station stays one row: of a name's lookup rows the smallest counts.
    """
    joined = stations.join(one_per_key(department_lookup, "name"), ["name"], "left")
    return joined.select(
        *stations.columns,
        F.coalesce("department", F.lit(UNKNOWN_DEPARTMENT)).alias("department"),
    )


def one_per_key(lookup: DataFrame, key: str) -> DataFrame:
    """The smallest row of each key; in a lookup of one value column a null gives way to any value.

    Grouped by the key and its hash: a join by the key then shuffles the
    result again, and only a side that sits on a shuffle leaves AQE free to
    split a hot key of the other.
    """
    values = [c for c in lookup.columns if c != key]
    groups = lookup.groupBy(F.xxhash64(key).alias("_hash"), key)
    if len(values) == 1:
        return groups.agg(F.min(values[0]).alias(values[0])).drop("_hash")
    return groups.agg(F.min(F.struct(*values)).alias("_row")).select(key, "_row.*")


# A raw line break cannot be part of a JSON string, so it is one between objects.
BETWEEN_OBJECTS = r"(?<=\})\s*\n\s*(?=\{)"


def _objects(lookups: DataFrame, *keep: str) -> DataFrame:
    """One row per object of `value`, with its entries; null entries where it cannot be read.

    An object with more text behind it on its line is an error, as that text
    would be lost. A map column keeps a wide object away from the schema and
    the driver.
    """
    objects = lookups.select(*keep, F.explode(F.split("value", BETWEEN_OBJECTS)).alias("object"))
    objects = objects.where(F.trim("object") != "")
    whole = F.from_json(F.concat(F.lit("["), "object", F.lit("]")), "array<map<string,string>>")
    first = F.from_json(F.col("object"), "map<string,string>")
    lost = F.raise_error(F.lit("a lookup has text behind its first object")).cast("array<map<string,string>>")
    return objects.withColumn("entries", F.when(whole.isNotNull(), whole).when(first.isNotNull(), lost))


def lookup_to_rows(objects: DataFrame, key: str = "stationcode", value: str = "name_custom") -> DataFrame:
    """JSON objects in column `value`, one row per entry.

    A value may hold several objects, on lines of their own. Each is read by
    itself: one that cannot be read gives no rows and takes no other with it;
    unreadable_objects lists it.
    """
    return _objects(objects).select(F.explode("entries").alias("_entries")).select(F.explode("_entries").alias(key, value))


def unreadable_objects(objects: DataFrame, *keep: str) -> DataFrame:
    """The objects in column `value` that cannot be read, with the columns `keep`."""
    return _objects(objects, *keep).where("entries IS NULL").select(*keep, "object")
