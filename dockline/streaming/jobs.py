"""Streaming jobs.

Each function returns a DataStreamWriter or takes one, so the caller chooses
the trigger: `availableNow` to drain what is there, a processing time to run
until stopped.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from dockline.operators import kpi
from dockline.operators.parse import POLL, POLL_KEY, poll_identity, transform
from dockline.sources.snapshot import latest_snapshot

POLL_SECONDS = 10


def drain(writer: DataStreamWriter) -> StreamingQuery:
    """Process all input that is there now, then stop."""
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def run(writer: DataStreamWriter, seconds: int | None = None) -> StreamingQuery:
    """Start a job that runs until stopped, at most one batch per interval."""
    if seconds is not None:
        writer = writer.trigger(processingTime=f"{seconds} seconds")
    return writer.start()


def to_json_files(
    rows: DataFrame, path: str, checkpoint: str, partition_by: Sequence[str] = ()
) -> DataStreamWriter:
    """Append rows to JSON files; each row lands exactly once."""
    writer = (
        rows.writeStream.format("json").outputMode("append")
        .option("path", path).option("checkpointLocation", checkpoint)
    )
    return writer.partitionBy(*partition_by) if partition_by else writer


def with_ingest_date(rows: DataFrame) -> DataFrame:
    """Add the partition column for a sink whose readers look for the newest day."""
    return rows.withColumn("ingest_date", F.to_date("timestamp"))


def write_kpis(
    rows: DataFrame, path: str, checkpoint: str,
    snapshot_time: str | None = None, tiebreak: Sequence[str] = (),
) -> DataStreamWriter:
    """Per micro-batch, area measures and indicators, for feeds whose messages name no poll.

    Writes Parquet to `<path>/area/batch_id=N` and `<path>/kpi/batch_id=N`. A
    batch that runs again overwrites its own folders. With `snapshot_time`
    only the newest poll of a batch counts, told apart by `tiebreak` where a
    batch holds several of the same time. The batch is read once: the
    indicators are summed from the few area rows just written.
    """

    def each(batch: DataFrame, batch_id: int) -> None:
        if snapshot_time is not None:
            batch = latest_snapshot(batch, snapshot_time, tiebreak)
        area, total = (f"{path}/{kind}/batch_id={batch_id}" for kind in ("area", "kpi"))
        measures = kpi.counters(batch, "arrondissement")
        measures.write.mode("overwrite").parquet(area)
        written = batch.sparkSession.read.schema(measures.schema).parquet(area)
        kpi.indicators(kpi.combine(written)).write.mode("overwrite").parquet(total)

    return rows.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)


# How long a poll waits for its pages, and how long a page may come again.
PAGE_DELAY = "1 minute"
REPEAT_DELAY = "10 minutes"


def unique_pages(messages: DataFrame, delay: str = REPEAT_DELAY) -> DataFrame:
    """The messages with the columns of poll_identity and poll_time, each page of a poll once.

    A producer that runs a batch again sends its pages again, with the same
    keys. Messages of no poll are told apart by their place in the topic. Of a
    stream, repeats are dropped that come within `delay`, by the time of the
    poll, so the state does not grow with the history.
    """
    place = F.concat_ws(":", *(c for c in ("topic", "partition", "offset") if c in messages.columns))
    page = F.concat_ws(":", "polled_at", "page_offset")
    arrived = F.col("timestamp") if "timestamp" in messages.columns else F.current_timestamp()
    pages = poll_identity(messages).withColumns({
        "poll_time": F.coalesce(F.timestamp_millis("polled_at"), arrived),
        "_page": F.when(F.col("polled_at").isNotNull(), page).otherwise(F.concat(F.lit("@"), place)),
    })
    if not messages.isStreaming:
        return pages.dropDuplicates(["_page"]).drop("_page")
    return pages.withWatermark("poll_time", delay).dropDuplicatesWithinWatermark(["_page"]).drop("_page")


def poll_areas(messages: DataFrame, delay: str = PAGE_DELAY) -> DataFrame:
    """Area measures of every poll: polled_at, poll_time, arrondissement, total_count and the measures.

    Takes messages with the poll job's key. Time is that of the poll, not of
    the batch: a poll whose pages come in several batches is one poll, a page
    that comes again within the delay counts once, and a poll's rows appear
    once, when no page can follow any more. A page later than that is dropped.
    Messages of no poll count for nothing. A batch gives all polls at once.
    """
    polled = messages.where(F.col("key").cast("string").rlike(POLL_KEY))
    pages = unique_pages(polled, delay)
    rows = transform(pages, keep=[*POLL, "poll_time"])
    return kpi.counters(rows, "poll_time", "polled_at", "arrondissement", "total_count")


def write_poll_areas(messages: DataFrame, path: str, checkpoint: str, delay: str = PAGE_DELAY) -> DataStreamWriter:
    """Append the area measures of every finished poll to Parquet files, once."""
    return (
        poll_areas(messages, delay).writeStream.format("parquet").outputMode("append")
        .option("path", path).option("checkpointLocation", checkpoint)
    )


def read_poll_areas(spark: SparkSession, path: str) -> DataFrame:
    """What write_poll_areas has written so far."""
    return spark.read.parquet(path)


def poll_indicators(areas: DataFrame) -> DataFrame:
    """One row per poll with every indicator, summed from its area rows, and whether all its stations came."""
    measures = [c for c in areas.columns if c not in ("poll_time", "polled_at", "arrondissement", "total_count")]
    polls = areas.groupBy("poll_time", "polled_at").agg(
        F.max("total_count").alias("total_count"), *(F.sum(c).alias(c) for c in measures))
    complete = F.coalesce(F.col("nb_stations") >= F.col("total_count"), F.lit(False))
    return kpi.indicators(polls).withColumn("complete", complete)
