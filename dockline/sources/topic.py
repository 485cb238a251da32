"""Message topics: Kafka, and a file-backed log with the same columns.

The log is a Parquet table with Kafka's read columns. It serves where no
broker is at hand, such as replays and tests.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dockline import schemas


# -- Kafka ------------------------------------------------------------------


def kafka_read_options(
    servers: str,
    topic: str | None = None,
    pattern: str | None = None,
    starting_offsets: str | None = None,
    fail_on_data_loss: bool = False,
    min_partitions: int | None = None,
    max_offsets_per_trigger: int | None = None,
) -> dict[str, str]:
    """Options of a Kafka read; topics by list or by pattern.

    `min_partitions` splits topic partitions into more tasks and
    `max_offsets_per_trigger` bounds a micro-batch when a job catches up.
    """
    if (topic is None) == (pattern is None):
        raise ValueError("give either topic or pattern")
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "subscribePattern": pattern,
        "startingOffsets": starting_offsets,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
        "minPartitions": min_partitions,
        "maxOffsetsPerTrigger": max_offsets_per_trigger,
    }
    return {k: str(v) for k, v in options.items() if v is not None}


def kafka_stream(spark: SparkSession, **options) -> DataFrame:
    return spark.readStream.format("kafka").options(**kafka_read_options(**options)).load()


def kafka_batch(spark: SparkSession, **options) -> DataFrame:
    return spark.read.format("kafka").options(**kafka_read_options(**options)).load()


def kafka_write_options(servers: str, topic: str | None = None) -> dict[str, str]:
    """Options of a Kafka write; without `topic` the rows name their topic."""
    options = {"kafka.bootstrap.servers": servers, "topic": topic}
    return {k: v for k, v in options.items() if v is not None}


def kafka_columns(messages: DataFrame) -> DataFrame:
    """The columns a Kafka write takes, of those that are there."""
    wanted = [c for c in ("key", "value", "topic", "partition", "headers") if c in messages.columns]
    return messages.select(*[F.col(c).cast("string") if c == "value" else c for c in wanted])


def write_kafka(messages: DataFrame, servers: str, topic: str | None = None) -> None:
    kafka_columns(messages).write.format("kafka").options(**kafka_write_options(servers, topic)).save()


def stream_to_kafka(messages: DataFrame, servers: str, checkpoint: str, topic: str | None = None):
    """A stream writer; the caller sets the trigger and starts it."""
    return (
        kafka_columns(messages).writeStream.format("kafka")
        .options(**kafka_write_options(servers, topic)).option("checkpointLocation", checkpoint)
    )


# -- file-backed log --------------------------------------------------------


def log_columns(
    messages: DataFrame, topic: str | None = None, timestamp: Column | None = None
) -> DataFrame:
    """Shape messages into log rows; columns that are absent become null."""
    given = set(messages.columns)
    defaults = {
        "topic": F.lit(topic),
        "timestamp": F.current_timestamp() if timestamp is None else timestamp,
    }
    columns = []
    for field in schemas.TOPIC_LOG.fields:
        name = field.name
        override = name in defaults and (name not in given or (name == "topic" and topic is not None))
        column = defaults[name] if override else F.col(name) if name in given else F.lit(None)
        if name in ("key", "value"):
            column = column.cast("string").cast("binary")
        columns.append(column.cast(field.dataType).alias(name))
    return messages.select(*columns)


def write_log(messages: DataFrame, path: str, topic: str | None = None) -> None:
    log_columns(messages, topic).write.mode("append").parquet(path)


def stream_to_log(messages: DataFrame, path: str, checkpoint: str, topic: str | None = None):
    """A stream writer; the caller sets the trigger and starts it."""
    return (
        log_columns(messages, topic).writeStream.format("parquet").outputMode("append")
        .option("path", path).option("checkpointLocation", checkpoint)
    )


def read_log(spark: SparkSession, path: str, topic: str | None = None) -> DataFrame:
    return _only(spark.read.schema(schemas.TOPIC_LOG).parquet(path), topic)


def stream_log(spark: SparkSession, path: str, topic: str | None = None) -> DataFrame:
    return _only(spark.readStream.schema(schemas.TOPIC_LOG).parquet(path), topic)


def _only(log: DataFrame, topic: str | None) -> DataFrame:
    return log if topic is None else log.where(F.col("topic") == topic)


# -- operators on topic rows ------------------------------------------------


def message_text(log: DataFrame, *keep: str) -> DataFrame:
    """The message as text."""
    return log.select(*keep, F.col("value").cast("string").alias("value"))


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    """Stream of the lines of the text files in a folder, as messages."""
    return spark.readStream.text(path)


def stream_to_text(log: DataFrame, path: str, checkpoint: str):
    """A stream writer of one line per message."""
    return (
        message_text(log).where(F.col("value").isNotNull()).writeStream.format("text")
        .option("path", path).option("checkpointLocation", checkpoint)
    )


def mirror(log: DataFrame, source: str, target: str, topics: str = ".*") -> DataFrame:
    """Rows to copy from cluster `source` to cluster `target`.

    Topics that match the pattern as a whole get the source's name as prefix.
    Topics that came from the target are not sent back. Partition and order
    within it stay; the target assigns offsets of its own.
    """
    chosen = F.col("topic").rlike(f"^(?:{topics})$") & ~F.col("topic").startswith(f"{target}.")
    return log.where(chosen).withColumn("topic", F.concat(F.lit(f"{source}."), "topic"))


def topic_offsets(log: DataFrame) -> DataFrame:
    """First offset and next offset of every topic partition."""
    return log.groupBy("topic", "partition").agg(
        F.min("offset").alias("first_offset"), (F.max("offset") + 1).alias("next_offset")
    )


# Offsets that one window looks at.
GAP_BLOCK = 1_000_000


def topic_gaps(log: DataFrame, read_to: DataFrame | None = None, block: int = GAP_BLOCK) -> DataFrame:
    """Offsets that a topic partition lacks: topic, partition, from_offset, to_offset, the first and last of each gap.

    With `read_to`, the next offset a reader wanted of each topic partition
    (topic, partition, next_offset), also what was deleted before the reader
    came to it; that is what a stream skips when it tolerates lost offsets. A
    partition of the log that is gone altogether is not a gap. Offsets are
    looked at in blocks, so a hot partition is many tasks.
    """
    key = ["topic", "partition"]
    placed = log.select(*key, "offset", F.floor(F.col("offset") / block).alias("_block"))
    inside = placed.withColumn("_next", F.lead("offset").over(Window.partitionBy(*key, "_block").orderBy("offset")))
    ends = placed.groupBy(*key, "_block").agg(F.min("offset").alias("_first"), F.max("offset").alias("offset"))
    across = ends.withColumn("_next", F.lead("_first").over(Window.partitionBy(*key).orderBy("_block")))
    steps = inside.select(*key, "offset", "_next").unionByName(across.select(*key, "offset", "_next"))
    if read_to is not None:
        first = ends.groupBy(*key).agg(F.min("_first").alias("_next"))
        wanted = read_to.select(*key, (F.col("next_offset") - 1).alias("offset"))
        steps = steps.unionByName(wanted.join(first, key).select(*key, "offset", "_next"))
    return steps.where("_next > offset + 1").select(
        *key, (F.col("offset") + 1).alias("from_offset"), (F.col("_next") - 1).alias("to_offset"))
