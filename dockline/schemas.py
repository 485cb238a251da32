"""Schemas of messages, lookups, topics and station rows.

Every reader states its schema: inference would need a second pass over the
data, and JSON files leave out null fields, so an all-null column would vanish.
"""

from pyspark.sql import types as T

_S, _I, _D = T.StringType(), T.IntegerType(), T.DoubleType()

POINT = T.StructType([T.StructField("lon", _D), T.StructField("lat", _D)])

# Field names and types of the public availability feed (fixed values).
STATION = T.StructType([
    T.StructField("stationcode", _S),
    T.StructField("name", _S),
    T.StructField("is_installed", _S),
    T.StructField("capacity", _I),
    T.StructField("numdocksavailable", _I),
    T.StructField("numbikesavailable", _I),
    T.StructField("mechanical", _I),
    T.StructField("ebike", _I),
    T.StructField("is_renting", _S),
    T.StructField("is_returning", _S),
    T.StructField("duedate", _S),
    T.StructField("coordonnees_geo", POINT),
    T.StructField("nom_arrondissement_communes", _S),
    T.StructField("code_insee_commune", _S),
    T.StructField("station_opening_hours", _S),
])


def envelope(station: T.StructType = STATION) -> T.StructType:
    """Schema of one API response holding stations of the given schema."""
    return T.StructType([
        T.StructField("total_count", T.LongType()),
        T.StructField("results", T.ArrayType(station)),
    ])


ENVELOPE = envelope()

# Catalyst does not prune a from_json schema below an explode, so the parser
# declares only the fields it selects.
ENVELOPE_PARSED = envelope(
    T.StructType([f for f in STATION.fields if f.name != "station_opening_hours"])
)

# The flat station row, in output order (fixed values).
STATION_FLAT = T.StructType([
    T.StructField("stationcode", _S),
    T.StructField("name", _S),
    T.StructField("numbikesavailable", _I),
    T.StructField("numdocksavailable", _I),
    T.StructField("capacity", _I),
    T.StructField("mechanical", _I),
    T.StructField("ebike", _I),
    T.StructField("is_installed", _S),
    T.StructField("is_renting", _S),
    T.StructField("is_returning", _S),
    T.StructField("duedate", _S),
    T.StructField("lat", _D),
    T.StructField("lon", _D),
    T.StructField("arrondissement", _S),
    T.StructField("code_insee_commune", _S),
])

STATION_OUT = T.StructType(STATION_FLAT.fields + [
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("is_full", T.BooleanType()),
    T.StructField("type_dominant", _S),
    T.StructField("name_custom", _S),
])

# Columns a Kafka read returns; the file-backed topic log has the same ones.
TOPIC_LOG = T.StructType([
    T.StructField("key", T.BinaryType()),
    T.StructField("value", T.BinaryType()),
    T.StructField("topic", _S),
    T.StructField("partition", _I),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
])

CODE_LOOKUP = T.StructType([T.StructField("stationcode", _S), T.StructField("name_custom", _S)])
DEPARTMENT_LOOKUP = T.StructType([T.StructField("name", _S), T.StructField("department", _S)])

# Station rows on disk with the poll they come from, and the stations that their page holds.
SNAPSHOT = T.StructType(STATION_OUT.fields + [
    T.StructField(name, T.LongType()) for name in ("polled_at", "page_offset", "total_count", "page_stations")
])
