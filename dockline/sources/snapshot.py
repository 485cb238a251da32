"""Station rows on disk and the newest snapshot among them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from dockline import schemas
from dockline.session import materialize


def read_snapshots(
    spark: SparkSession, path: str, schema: StructType = schemas.STATION_OUT
) -> DataFrame:
    """JSON station rows in a folder; a folder without files gives no rows.

    Spark reads only the files a stream has committed if the folder has the
    commit log of a stream.
    """
    try:
        return spark.read.schema(schema).json(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def write_snapshots(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


def latest_snapshot(
    df: DataFrame, time: str = "timestamp", tiebreak: Sequence[str] = ()
) -> DataFrame:
    """The rows of the newest poll.

    The maximum is a scalar subquery: it runs first over the one column, and
    its value reaches the scan as a filter, which skips older files and row
    groups. Over a history partitioned by day, filter df to the last days
    before the call.

    All polls of one micro-batch share their time. `tiebreak` names columns,
    such as the topic offset, by which only the newest row per station stays.
    """
    newest = df.where(F.col(time) == df.agg(F.max(time)).scalar())
    return newest_per_station(newest, tiebreak) if tiebreak else newest


def polls(df: DataFrame) -> DataFrame:
    """Every poll of the rows: polled_at, pages and stations seen, total as the poll states it, complete.

    Pages are counted, not codes: a page states how many stations it holds, so
    a code that is missing or listed twice does not matter, nor does a page
    that came twice. Rows that do not say so count themselves.
    """
    seen = F.coalesce(F.max("page_stations") if "page_stations" in df.columns else F.lit(None), F.count(F.lit(1)))
    pages = df.where("polled_at IS NOT NULL").groupBy("polled_at", "page_offset").agg(
        seen.alias("stations"), F.max("total_count").alias("total"))
    return pages.groupBy("polled_at").agg(
        F.count(F.lit(1)).alias("pages"), F.sum("stations").alias("stations"), F.max("total").alias("total"),
    ).withColumn("complete", F.coalesce(F.col("stations") >= F.col("total"), F.lit(False)))


def incomplete_polls(df: DataFrame) -> DataFrame:
    """Polls newer than the newest complete one, which a board does not show; a feed that never fills up is seen here."""
    seen = polls(df)
    newest = F.coalesce(seen.where("complete").agg(F.max("polled_at")).scalar(), F.lit(-1))
    return seen.where(F.col("polled_at") > newest).drop("complete")


def newest_poll(df: DataFrame) -> DataFrame:
    """The rows of the newest complete poll, one per station.

    A poll is complete once its pages hold as many stations as it states, be
    they written by one micro-batch or several. Rows without a poll count for
    nothing; without a complete poll there are none. The polls are counted in
    one pass over four columns, and the newest is a filter on the second.
    """
    newest = polls(df).where("complete").agg(F.max("polled_at")).scalar()
    return newest_per_station(df.where(F.col("polled_at") == newest), ["page_offset", "timestamp"])


def newest(df: DataFrame) -> DataFrame:
    """The newest complete poll, or the newest snapshot of a history that names no polls."""
    return latest_snapshot(df) if df.where("polled_at IS NOT NULL").isEmpty() else newest_poll(df)


def days(spark: SparkSession, path: str) -> list[str]:
    """The days of a history partitioned by ingest_date, newest first, from the names of its folders."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [x.getPath().getName() for x in files.listStatus(folder)] if files.exists(folder) else []
    return sorted((n.partition("=")[2] for n in names if n.startswith("ingest_date=")), reverse=True)


def read_newest(spark: SparkSession, path: str, schema: StructType = schemas.SNAPSHOT) -> DataFrame:
    """The newest complete poll of a history on disk, or its newest snapshot.

    Of a history partitioned by day only the newest day is read, and each file
    of it once: the rows are kept in the shared folder, which finding the poll
    and its rows then read. Earlier days follow one by one only while no poll
    is complete, as after midnight. Without partitions all is read.
    """
    rows = read_snapshots(spark, path, schema)
    known = days(spark, path)
    if not known:
        return newest(rows)
    dated = read_snapshots(spark, path, StructType([*schema.fields, StructField("ingest_date", StringType())]))
    kept = None
    for day in known:
        own = materialize(dated.where(F.col("ingest_date") == day).select(*rows.columns), "day")
        kept = own if kept is None else kept.unionByName(own)
        named = not kept.where("polled_at IS NOT NULL").isEmpty()
        if not named and not kept.isEmpty():
            return latest_snapshot(kept)
        if named and not polls(kept).where("complete").isEmpty():
            break
    return newest_poll(kept)


def newest_per_station(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """The row with the greatest `order` columns of each station.

    An aggregate rather than a window: it combines before the shuffle, so a
    station with very many rows sends one row per task.
    """
    rest = [c for c in df.columns if c != "stationcode"]
    newest = F.max_by(F.struct(*rest), F.struct(*order)).alias("row")
    return df.groupBy("stationcode").agg(newest).select(
        *[F.col(f"row.{c}").alias(c) if c != "stationcode" else c for c in df.columns]
    )


def latest_file(df: DataFrame) -> DataFrame:
    """The rows of the newest file of a file scan; ties keep all newest files."""
    modified = F.col("_metadata.file_modification_time")
    newest = df.select(modified.alias("modified")).agg(F.max("modified")).scalar()
    return df.where(modified == newest)
