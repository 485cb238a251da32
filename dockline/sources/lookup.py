"""Lookup tables: JSON objects in files, and literals."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from dockline import schemas
from dockline.operators.enrich import lookup_to_rows, unreadable_objects

# A JSON string, and an entry whose value is one or a literal. Possessive, so that long texts need no stack.
STRING = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"'
ENTRY = rf'{STRING}\s*+:\s*+(?:{STRING}|null|true|false|-?[0-9][0-9.eE+-]*+)'


def read_lookup(
    spark: SparkSession,
    path: str,
    key: str = "stationcode",
    value: str = "name_custom",
    multiline: bool = False,
) -> DataFrame:
    """Rows of `{key: value}` objects in text files.

    One object per line, or with `multiline` objects over several lines each,
    every entry on one line and an object beginning on a line of its own. Files
    are split by lines in both cases, so a large file or object is many tasks.
    An object that cannot be read gives no rows and takes no other with it;
    lookup_errors lists it. A text that goes on after an object on the same
    line is an error, as its rest would be lost.
    """
    if not multiline:
        return lookup_to_rows(spark.read.text(path), key, value)
    lines = _numbered(_lines(spark, path))
    broken = _broken(lines).select("file", "object_nr")
    good = lines.join(broken, ["file", "object_nr"], "left_anti")
    entries = F.from_json(F.concat(F.lit("{"), F.array_join("entries", ","), F.lit("}")), "map<string,string>")
    return good.where(F.size("entries") > 0).select(F.explode(entries).alias(key, value))


def lookup_errors(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """The objects that read_lookup leaves out: file, object_nr, text.

    `text` is the object, or with `multiline` its first line that shows the
    fault, empty where the object only lacks an end. Objects are numbered from
    1 per file; without `multiline` the number is null.
    """
    if not multiline:
        lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"))
        return unreadable_objects(lines, "file").select("file", F.lit(None).cast("bigint").alias("object_nr"), F.col("object").alias("text"))
    return _broken(_numbered(_lines(spark, path)))


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Every line with its place, its entries, and what is left of it without them."""
    lines = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"),
    )
    # strings that are no entry keep their quotes only, so that the braces left are those of objects
    rest = F.trim(F.regexp_replace(F.regexp_replace("value", ENTRY, ""), STRING, '""'))
    lines = lines.select("*", F.regexp_extract_all("value", F.lit(ENTRY), 0).alias("entries"), rest.alias("rest"))
    # text behind an object is refused, not left out
    behind = F.col("rest").rlike(r"^[^\"]*\}\s*[^\s,\"][^\"]*$")
    refused = F.raise_error(F.lit("a lookup has text behind its first object")).cast("string")
    return lines.withColumn("rest", F.when(behind, refused).otherwise(F.col("rest"))).withColumns({
        "starts": F.col("value").rlike(r"^\s*\{").cast("int"),
        "depth": F.length(F.regexp_replace("rest", r"[^{]", "")) - F.length(F.regexp_replace("rest", r"[^}]", "")),
        "fault": ~F.col("rest").rlike(r"^\{?[\s,]*\}?\s*,?$"),
    })


def _numbered(lines: DataFrame) -> DataFrame:
    """Add the number of the object that a line belongs to, counted per file.

    Running counts go within the blocks into which Spark splits a file, and
    over the blocks of a file, so no window holds a whole file.
    """
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = lines.groupBy("file", "block").agg(F.sum("starts").alias("starts"))
    blocks = blocks.select("file", "block", F.coalesce(F.sum("starts").over(before), F.lit(0)).alias("earlier"))
    within = Window.partitionBy("file", "block").orderBy("line").rowsBetween(Window.unboundedPreceding, 0)
    numbered = lines.withColumn("object_nr", F.sum("starts").over(within)).join(blocks, ["file", "block"])
    return numbered.withColumn("object_nr", F.col("object_nr") + F.col("earlier")).drop("earlier")


def _broken(lines: DataFrame) -> DataFrame:
    """Objects with a line that is no entry, without an end or a beginning."""
    objects = lines.where("trim(value) <> ''").groupBy("file", "object_nr").agg(
        F.sum("depth").alias("open"), F.max("fault").alias("fault"),
        F.min_by("value", F.when(F.col("fault"), F.col("line"))).alias("text"),
    )
    return objects.where("fault OR open <> 0 OR object_nr = 0").select("file", "object_nr", F.coalesce("text", F.lit("")).alias("text"))


def literal_lookup(
    spark: SparkSession, entries: Mapping[str, str], schema: StructType = schemas.CODE_LOOKUP
) -> DataFrame:
    """A lookup given in code; for tables that stay small."""
    return spark.createDataFrame(list(entries.items()), schema)


def lookup_objects(
    lookup: DataFrame,
    key: str = "stationcode",
    value: str = "name_custom",
    objects: int = 1,
) -> DataFrame:
    """JSON objects in column `value`: one, which one task then gathers, or as many as asked for.

    Several objects are lines of their own, and keys are spread over them by
    hash; a large lookup needs them. A key that occurs twice keeps its
    smallest value, as an object holds a key once.
    """
    if objects < 1:
        raise ValueError("at least one object is written")
    unique = lookup.groupBy(key).agg(F.min(value).alias(value))
    return (
        unique.where(F.col(key).isNotNull())
        .groupBy(F.pmod(F.xxhash64(key), F.lit(objects)).alias("object_nr"))
        .agg(F.to_json(F.map_from_entries(F.collect_list(F.struct(key, value)))).alias("value"))
        .select("value")
    )


def write_lookup(lookup: DataFrame, path: str, **options) -> None:
    lookup_objects(lookup, **options).write.text(path)
