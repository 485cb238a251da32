import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from dockline import schemas
from dockline.sources import topic
from dockline.streaming import jobs


def test_kafka_read_options():
    assert topic.kafka_read_options("h:1", topic="t") == {
        "kafka.bootstrap.servers": "h:1", "subscribe": "t", "failOnDataLoss": "false"
    }
    options = topic.kafka_read_options(
        "h:1", pattern="a.*", starting_offsets="earliest", fail_on_data_loss=True,
        min_partitions=64, max_offsets_per_trigger=1000)
    assert options == {
        "kafka.bootstrap.servers": "h:1", "subscribePattern": "a.*", "startingOffsets": "earliest",
        "failOnDataLoss": "true", "minPartitions": "64", "maxOffsetsPerTrigger": "1000",
    }
    for wrong in ({}, {"topic": "t", "pattern": "p"}):
        with pytest.raises(ValueError):
            topic.kafka_read_options("h:1", **wrong)


def test_kafka_write_options_and_columns(spark):
    assert topic.kafka_write_options("h:1", "t") == {"kafka.bootstrap.servers": "h:1", "topic": "t"}
    assert topic.kafka_write_options("h:1") == {"kafka.bootstrap.servers": "h:1"}
    df = spark.createDataFrame([(b"k", b"v", "t", 0, 9)], "key binary, value binary, topic string, partition int, offset long")
    assert topic.kafka_columns(df).dtypes == [
        ("key", "binary"), ("value", "string"), ("topic", "string"), ("partition", "int")
    ]


def test_kafka_needs_its_package(spark):
    with pytest.raises(AnalysisException, match="(?i)kafka"):
        topic.write_kafka(spark.createDataFrame([("v",)], "value string"), "localhost:1", "t")


def test_log_round_trip(spark, tmp_path):
    path = str(tmp_path / "log")
    for part in (["a", None], ["c"]):
        topic.write_log(spark.createDataFrame([(v,) for v in part], "value string"), path, "t")
    topic.write_log(spark.createDataFrame([("x", "u")], "value string, topic string"), path)
    log = topic.read_log(spark, path)
    assert log.schema == schemas.TOPIC_LOG
    assert {r.value for r in topic.message_text(topic.read_log(spark, path, "t")).collect()} == {"a", None, "c"}
    assert log.where("timestamp is null").isEmpty()


def test_mirror(spark):
    log = spark.createDataFrame([("stations",), ("stations2",), ("B.stations",), ("other",)], "topic string")
    def names(df):
        return {r.topic for r in df.collect()}

    assert names(topic.mirror(log, "A", "B")) == {"A.stations", "A.stations2", "A.other"}
    assert names(topic.mirror(log, "A", "B", "stations")) == {"A.stations"}
    assert names(topic.mirror(log, "A", "B", "stations|other")) == {"A.stations", "A.other"}


def test_offsets(spark):
    log = spark.createDataFrame(
        [("t", 0, 5), ("t", 0, 9), ("t", 1, 0), ("u", 0, 3)], "topic string, partition int, offset long")
    assert {tuple(r) for r in topic.topic_offsets(log).collect()} == {
        ("t", 0, 5, 10), ("t", 1, 0, 1), ("u", 0, 3, 4)
    }


def test_lines_to_topic_to_lines(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("one\n\ntwo é\n")
    log, out = str(tmp_path / "log"), str(tmp_path / "out")
    jobs.drain(topic.stream_to_log(topic.text_lines(spark, str(tmp_path / "in")), log, f"{log}-ck", "t"))
    jobs.drain(topic.stream_to_text(topic.stream_log(spark, log, "t"), out, f"{out}-ck"))
    assert sorted(r.value for r in spark.read.text(out).collect()) == ["", "one", "two é"]
    assert topic.read_log(spark, log).where(F.col("topic") == "t").count() == 3


def test_gaps(spark):
    log = spark.createDataFrame(
        [("t", 0, n) for n in (3, 4, 7, 12, 13, 25)] + [("t", 1, 5), ("u", 0, 0)], "topic string, partition int, offset long")
    read = spark.createDataFrame([("t", 0, 1), ("t", 1, 5), ("u", 0, 0), ("gone", 0, 3)], "topic string, partition int, next_offset long")
    for block in (1, 5, 1000):
        gaps = {tuple(r) for r in topic.topic_gaps(log, block=block).collect()}
        assert gaps == {("t", 0, 5, 6), ("t", 0, 8, 11), ("t", 0, 14, 24)}
        assert {tuple(r) for r in topic.topic_gaps(log, read, block).collect()} == gaps | {("t", 0, 1, 2)}
    assert topic.topic_gaps(log.limit(0), read).isEmpty()
