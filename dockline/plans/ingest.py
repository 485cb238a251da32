"""From the polled API through a topic to station rows on disk."""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from dockline.operators.parse import POLL, transform
from dockline.sources import poll, topic
from dockline.streaming import jobs


def poll_to_kafka(
    spark: SparkSession, url: str, servers: str, to: str, checkpoint: str,
    seconds: int = jobs.POLL_SECONDS, errors_path: str | None = None, **poll_options,
) -> StreamingQuery:
    """Poll the API at a fixed interval and send each page to a topic.

    A page that fails is reported as a JSON row in `errors_path`, by default
    beside the checkpoint, and asked for again with the next poll.
    """
    base = checkpoint.rstrip("/")
    poll_options.setdefault("state", f"{base}-missing")
    polled = poll.poll(spark, stream=True, url=url, **poll_options)
    send = functools.partial(topic.write_kafka, servers=servers, topic=to)
    return jobs.run(split_polled(polled, send, errors_path or f"{base}-errors", checkpoint), seconds)


def split_polled(polled: DataFrame, send, errors_path: str, checkpoint: str) -> DataStreamWriter:
    """A stream that gives the messages of each poll to `send` and appends its errors to a folder.

    The batch is kept for both, or else the second would poll again. If it
    fails in between, the same poll is sent again with the same keys;
    jobs.unique_pages on the reading side keeps each page once.
    """
    def write(batch: DataFrame, number: int) -> None:
        batch = batch.persist()
        try:
            send(poll.messages(batch))
            poll.errors(batch).write.mode("overwrite").json(f"{errors_path.rstrip('/')}/batch={number}")
        finally:
            batch.unpersist()

    return polled.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)


def messages_to_json(
    messages: DataFrame, path: str, checkpoint: str, code_lookup: DataFrame | None = None,
    ingest_time: Column | None = None, by_date: bool = False, keep: Sequence[str] = (),
) -> DataStreamWriter:
    """Parse, derive, name and append to JSON files.

    `by_date` partitions the files by ingest day, so that a reader of the
    newest snapshot lists one day instead of the whole history.
    """
    rows = transform(messages, code_lookup, ingest_time, keep)
    if by_date:
        rows = jobs.with_ingest_date(rows)
    return jobs.to_json_files(rows, path, checkpoint, ["ingest_date"] if by_date else ())


def kafka_to_json(
    spark: SparkSession, servers: str, topic_name: str, path: str, checkpoint: str,
    code_lookup: DataFrame | None = None, seconds: int | None = None, by_date: bool = False,
    **kafka_options,
) -> StreamingQuery:
    """Read a topic and keep station rows, with the poll they come from, on disk until stopped.

    A page that the producer sent twice is kept once.
    """
    log = jobs.unique_pages(topic.kafka_stream(spark, servers=servers, topic=topic_name, **kafka_options))
    return jobs.run(messages_to_json(log, path, checkpoint, code_lookup, by_date=by_date, keep=POLL), seconds)


def kafka_to_indicators(
    spark: SparkSession, servers: str, topic_name: str, path: str, checkpoint: str,
    seconds: int | None = None, delay: str = jobs.PAGE_DELAY, **kafka_options,
) -> StreamingQuery:
    """Read a topic and keep the area measures of every finished poll until stopped."""
    log = topic.kafka_stream(spark, servers=servers, topic=topic_name, **kafka_options)
    return jobs.run(jobs.write_poll_areas(log, path, checkpoint, delay), seconds)
