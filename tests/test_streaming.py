import json
import os
import re

import pytest
from pyspark.sql import functions as F

from dockline import schemas
from dockline.operators import kpi
from dockline.operators.envelope import single_envelopes
from dockline.operators.parse import transform
from dockline.plans import ingest
from dockline.sources import poll, snapshot, topic
from dockline.streaming import jobs

NO_TIME = [c for c in schemas.STATION_OUT.names if c != "timestamp"]


def same(left, right):
    return left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()


@pytest.fixture
def log(spark, stations, tmp_path):
    path = str(tmp_path / "log")
    messages = single_envelopes(stations, "stationcode").withColumn("offset", F.col("stationcode").cast("long"))
    return path, messages.drop("stationcode")


def test_stream_equals_batch_and_restarts(spark, log, tmp_path):
    path, messages = log
    lookup = spark.createDataFrame([("1", "one"), ("5", "five")], schemas.CODE_LOOKUP)
    out = str(tmp_path / "out")
    for part in ("offset <= 3", "offset > 3", "false"):
        topic.write_log(messages.where(part), path, "t")
        jobs.drain(ingest.messages_to_json(topic.stream_log(spark, path), out, f"{out}-ck", lookup))
    got = snapshot.read_snapshots(spark, out).select(NO_TIME)
    assert same(got, transform(topic.read_log(spark, path), lookup).select(NO_TIME))
    # A file that no batch committed does not count.
    with open(os.path.join(out, "stray.json"), "w") as f:
        f.write(json.dumps({"stationcode": "99"}) + "\n")
    assert snapshot.read_snapshots(spark, out).count() == 8


def test_files_by_day(spark, log, tmp_path):
    path, messages = log
    topic.write_log(messages, path, "t")
    out = str(tmp_path / "out")
    day = F.lit("2024-05-06 12:00:00").cast("timestamp")
    jobs.drain(ingest.messages_to_json(topic.stream_log(spark, path), out, f"{out}-ck", ingest_time=day, by_date=True))
    assert "ingest_date=2024-05-06" in os.listdir(out)
    assert snapshot.read_snapshots(spark, out).count() == 8


def test_kpis_per_batch_and_again(spark, log, stations, tmp_path):
    path, messages = log
    out = str(tmp_path / "out")
    for part in ("offset <= 3", "offset > 3"):
        topic.write_log(messages.where(part), path, "t")
        rows = transform(topic.stream_log(spark, path))
        jobs.drain(jobs.write_kpis(rows, out, f"{out}-ck"))
    result = spark.read.parquet(f"{out}/kpi")
    assert {r.batch_id: r.nb_stations for r in result.collect()} == {0: 3, 1: 5}
    whole = kpi.indicators(kpi.combine(result)).first()
    assert whole == kpi.kpis(stations).first()
    # Losing the commit of the last batch runs it again; its folder is replaced.
    (tmp_path / "out-ck" / "commits" / "1").unlink()
    (tmp_path / "out-ck" / "commits" / ".1.crc").unlink(missing_ok=True)
    jobs.drain(jobs.write_kpis(transform(topic.stream_log(spark, path)), out, f"{out}-ck"))
    again = spark.read.parquet(f"{out}/kpi")
    assert {r.batch_id: r.nb_stations for r in again.collect()} == {0: 3, 1: 5}
    assert spark.read.parquet(f"{out}/area").agg(F.sum("nb_stations")).first()[0] == 8


def test_kpis_of_the_newest_poll_only(spark, log, tmp_path):
    path, messages = log
    topic.write_log(messages, path, "t")
    polled = F.timestamp_seconds(F.when(F.col("offset") <= 3, 100).otherwise(200))
    rows = transform(topic.stream_log(spark, path), ingest_time=polled, keep=["offset"])
    out = str(tmp_path / "out")
    jobs.drain(jobs.write_kpis(rows, out, f"{out}-ck", "timestamp", ["offset"]))
    assert spark.read.parquet(f"{out}/kpi").first().nb_stations == 5


def test_latest(spark, stations, tmp_path):
    timed = stations.withColumn("timestamp", F.timestamp_seconds(F.col("stationcode").cast("int") % 3))
    assert {r.stationcode for r in snapshot.latest_snapshot(timed).collect()} == {"2", "5", "8"}
    assert snapshot.latest_snapshot(timed.limit(0)).isEmpty()
    path = tmp_path / "files"
    path.mkdir()
    for n, when in (("a", 1000), ("b", 3000), ("c", 2000)):
        (path / f"{n}.json").write_text(json.dumps({"stationcode": n}))
        os.utime(path / f"{n}.json", (when, when))
    newest = snapshot.latest_file(snapshot.read_snapshots(spark, str(path)))
    assert [r.stationcode for r in newest.select("stationcode").collect()] == ["b"]


def test_newest_row_per_station(spark):
    rows = spark.createDataFrame([
        ("1", 10, 0, 5, None), ("1", 10, 0, 7, 1), ("2", 10, 0, 6, 3), ("1", 9, 1, 99, 4), (None, 10, 0, 1, 5)
    ], "stationcode string, timestamp int, partition int, offset int, ebike int")
    got = snapshot.latest_snapshot(rows, tiebreak=["partition", "offset"])
    assert got.columns == rows.columns
    assert {(r.stationcode, r.offset, r.ebike) for r in got.collect()} == {("1", 7, 1), ("2", 6, 3), (None, 1, 5)}


def test_no_input(spark, tmp_path):
    for path in (tmp_path, tmp_path / "missing"):
        rows = snapshot.read_snapshots(spark, str(path))
        assert rows.schema == schemas.STATION_OUT and rows.isEmpty()


def test_null_columns_come_back(spark, tmp_path):
    rows = spark.createDataFrame([("1",)], "stationcode string")
    rows.withColumn("ebike", F.lit(None).cast("int")).write.json(str(tmp_path / "out"))
    row = snapshot.read_snapshots(spark, str(tmp_path / "out")).first()
    assert row.ebike is None and row.arrondissement is None


def poll_rows(spark, polls):
    """(polled_at, total, stations) to rows as the sink keeps them."""
    rows = [(code, "t", at, n, total) for at, total, codes in polls for n, code in enumerate(codes)]
    return spark.createDataFrame(rows, "stationcode string, timestamp string, polled_at long, page_offset long, total_count long")


def test_newest_complete_poll(spark):
    split = poll_rows(spark, [(1, 4, "ab"), (1, 4, "cd")])
    assert sorted(r.stationcode for r in snapshot.newest_poll(split).collect()) == ["a", "b", "c", "d"]
    double = poll_rows(spark, [(1, 4, "abcd"), (2, 4, "abcd"), (3, 4, "ab")])
    assert sorted((r.stationcode, r.polled_at) for r in snapshot.newest_poll(double).collect()) == [(c, 2) for c in "abcd"]
    assert snapshot.newest_poll(poll_rows(spark, [(3, 4, "ab")])).isEmpty()
    assert snapshot.newest_poll(poll_rows(spark, [(3, 4, "abcd"), (3, 4, "a")])).count() == 4


def test_poll_errors_are_kept_by_the_running_job(spark, tmp_path):
    sent = []
    (tmp_path / "0.json").write_text('{"total_count": 20, "results": []}')
    polled = poll.poll(spark, stream=True, url=str(tmp_path) + "/{offset}.json", limit=10)
    writer = ingest.split_polled(polled, lambda m: sent.extend(m.collect()), str(tmp_path / "errors"), str(tmp_path / "ck"))
    jobs.drain(writer)
    assert len(sent) == 1 and sent[0].key.endswith(":0")
    assert [r.page_offset for r in spark.read.json(str(tmp_path / "errors")).collect()] == [10]


def history(spark, polls):
    """(polled_at, page_offset, page_stations, total, codes) to rows as the sink keeps them."""
    rows = [(code, "2024-01-01T00:00:00Z", at, page, total, size) for at, page, size, total, codes in polls for code in codes]
    return spark.createDataFrame(
        rows, "stationcode string, timestamp string, polled_at long, page_offset long, total_count long, page_stations long")


def test_a_code_listed_twice_or_missing_completes_a_poll(spark):
    rows = history(spark, [(1, 0, 2, 3, ["a", "a"]), (1, 2, 1, 3, ["b"]), (2, 0, 2, 3, [None, "a"]), (2, 2, 1, 3, ["b"]),
                           (3, 0, 2, 3, ["a", "b"]), (3, 0, 2, 3, ["a", "b"])])
    assert {(r.polled_at, r.pages, r.stations, r.complete) for r in snapshot.polls(rows).collect()} == {
        (1, 2, 3, True), (2, 2, 3, True), (3, 1, 2, False)}
    assert {(r.stationcode, r.polled_at) for r in snapshot.newest_poll(rows).collect()} == {(None, 2), ("a", 2), ("b", 2)}
    assert {r.stationcode for r in snapshot.newest_poll(rows.where("polled_at = 1")).collect()} == {"a", "b"}
    assert [(r.polled_at, r.pages) for r in snapshot.incomplete_polls(rows).collect()] == [(3, 1)]
    assert snapshot.incomplete_polls(rows.where("polled_at = 3")).count() == 1


def test_only_the_newest_day_is_read_and_once(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "rows")
    days = {"2024-01-01": [(1, 0, 1, 1, ["old"])], "2024-01-02": [(2, 0, 1, 2, ["x"]), (3, 0, 1, 1, ["b"])], "2024-01-03": [(2, 1, 1, 2, ["y"])]}
    for day, polls in days.items():
        history(spark, polls).coalesce(1).withColumn("ingest_date", F.lit(day)).write.mode("append").partitionBy("ingest_date").json(path)
    read = []
    keep = snapshot.materialize
    seen = lambda df: re.findall(r"PartitionFilters: .*ingest_date#\d+ = ([0-9-]+)", df._jdf.queryExecution().executedPlan().toString())
    monkeypatch.setattr(snapshot, "materialize", lambda df, tag: read.append(seen(df)) or keep(df, tag))
    assert snapshot.days(spark, path) == sorted(days, reverse=True)
    # the newest day has no complete poll of its own, so the one before is read too
    assert [r.stationcode for r in snapshot.read_newest(spark, path).collect()] == ["b"]
    assert read == [["2024-01-03"], ["2024-01-02"]]
    history(spark, [(4, 0, 1, 1, ["z"])]).coalesce(1).withColumn("ingest_date", F.lit("2024-01-04")).write.mode("append").partitionBy("ingest_date").json(path)
    read.clear()
    assert [r.stationcode for r in snapshot.read_newest(spark, path).collect()] == ["z"]
    assert read == [["2024-01-04"]]
    assert snapshot.read_newest(spark, str(tmp_path / "missing")).isEmpty()


def test_a_batch_that_runs_again_doubles_nothing(spark, tmp_path):
    """The job fails after it has sent a poll; it is sent again, and the reader keeps each page once."""
    for offset in (0, 10):
        (tmp_path / f"{offset}.json").write_text(json.dumps({"total_count": 20, "results": [{"stationcode": str(offset)}]}))
    log, rows = str(tmp_path / "log"), str(tmp_path / "rows")

    def job():
        polled = poll.poll(spark, stream=True, url=str(tmp_path) + "/{offset}.json", limit=10)
        send = lambda messages: topic.write_log(messages, log, "t")
        jobs.drain(ingest.split_polled(polled, send, str(tmp_path / "errors"), str(tmp_path / "ck")))

    (tmp_path / "errors").write_text("a file where the folder of errors should be")
    with pytest.raises(Exception):
        job()
    (tmp_path / "errors").rename(tmp_path / "moved")
    job()
    sent = topic.read_log(spark, log)
    assert sent.count() == 4 and sent.select("key").distinct().count() == 2
    jobs.drain(ingest.messages_to_json(jobs.unique_pages(topic.stream_log(spark, log)), rows, f"{rows}-ck", keep=("polled_at", "page_offset")))
    kept = spark.read.json(rows)
    assert kept.count() == 2 and kept.select("polled_at", "page_offset").distinct().count() == 2
    assert jobs.unique_pages(sent).count() == 2


def test_messages_without_a_poll_are_told_apart_by_their_place(spark):
    log = spark.createDataFrame([(None, "{}", "t", 0, n) for n in (1, 1, 2)], "key binary, value string, topic string, partition int, offset long")
    assert jobs.unique_pages(log).count() == 2
    assert jobs.poll_areas(log).isEmpty()


def test_indicators_of_an_incomplete_poll(spark, stations):
    page = single_envelopes(stations.where("stationcode < '4'"), "stationcode").select(F.concat(F.lit("5:"), "stationcode").alias("key"), F.regexp_replace("value", '"total_count":1', '"total_count":8').alias("value"))
    row = jobs.poll_indicators(jobs.poll_areas(page)).first()
    assert (row.polled_at, row.nb_stations, row.total_count, row.complete) == (5, 3, 8, False)
