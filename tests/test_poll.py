import json
import urllib.error
import urllib.request

import pytest

from dockline.operators.parse import transform
from dockline.sources import poll


def save_pages(folder, total, limit, skip=()):
    """Pages named by their offset, as a paged API would answer."""
    for offset in range(0, total, limit):
        if offset in skip:
            continue
        rows = [{"stationcode": str(i)} for i in range(offset, min(total, offset + limit))]
        (folder / f"{offset}.json").write_text(json.dumps({"total_count": total, "results": rows}))
    return str(folder) + "/{offset}.json"


def test_all_pages_are_read(spark, tmp_path):
    url = save_pages(tmp_path, 1447, 100)
    for scheme in ("", "file://"):
        pages = poll.poll(spark, url=scheme + url)
        assert pages.count() == 15
    assert pages.rdd.getNumPartitions() == 15
    codes = {r.stationcode for r in transform(poll.messages(pages)).collect()}
    assert codes == {str(i) for i in range(1447)}
    assert poll.poll(spark, url=url, pages_per_task=4).rdd.getNumPartitions() == 4


def test_missing_page_is_reported_and_the_rest_kept(spark, tmp_path):
    pages = poll.poll(spark, url=save_pages(tmp_path, 50, 10, skip={20}), limit=10)
    assert [r.page_offset for r in poll.errors(pages).collect()] == [20]
    assert poll.messages(pages).count() == 4


def test_first_page_missing_gives_one_error(spark, tmp_path):
    rows = poll.poll(spark, url=save_pages(tmp_path, 50, 10, skip={0}), limit=10).collect()
    assert [(r.page_offset, r.value) for r in rows] == [(0, None)]
    assert "FileNotFoundError" in rows[0]._error


def test_http_answers_and_errors(monkeypatch):
    asked = []

    class Answer:
        def __init__(self, url):
            self.url = url

        def __enter__(self):
            return self

        def __exit__(self, *_):
            pass

        def read(self):
            return b'{"total_count": 250, "results": []}'

    def urlopen(url, timeout):
        asked.append((url, timeout))
        if "offset=100" in url:
            raise urllib.error.URLError("down")
        return Answer(url)

    monkeypatch.setattr(urllib.request, "urlopen", urlopen)
    reader = poll.PollReader({"url": "https://example.org/r?limit={limit}&offset={offset}", "timeout": "3"})
    rows = [row for p in reader.partitions() for row in reader.read(p)]
    assert [(r[0], r[1] is None) for r in rows] == [(0, False), (100, True), (200, False)]
    assert "down" in rows[1][2]
    assert asked[0] == ("https://example.org/r?limit=100&offset=0", 3.0)


def test_saved_responses(spark, tmp_path):
    for n in range(3):
        (tmp_path / f"part-{n}.txt").write_text('{"total_count":1}\n\n{"total_count":2}\n')
    (tmp_path / "_SUCCESS").write_text("")
    pages = poll.poll(spark, path=str(tmp_path))
    assert poll.messages(pages).count() == 6
    assert pages.rdd.getNumPartitions() == 3
    assert poll.poll(spark, path=str(tmp_path / "nothing")).count() == 0


def test_saved_responses_need_no_python(spark, tmp_path):
    (tmp_path / "a.txt").write_text('{"total_count":1}\n')
    plan = poll.messages(poll.poll(spark, path=str(tmp_path)))._jdf.queryExecution().executedPlan().toString()
    assert "FileScan text" in plan and "Python" not in plan and "BatchScan" not in plan


def test_missing_pages_are_asked_for_again(monkeypatch, tmp_path):
    """A page is noted when it fails, asked for under its own poll, and given up after three tries."""
    down = {100}

    def fetch(address, timeout):
        if int(address) in down:
            raise OSError("down")
        return json.dumps({"total_count": 250, "results": []})

    monkeypatch.setattr(poll, "fetch", fetch)
    reader = poll.PollStreamReader({"url": "{offset}", "state": str(tmp_path / "missing")})
    start, asked, first = reader.initialOffset(), [], None
    for _ in range(4):
        end = json.loads(json.dumps(reader.latestOffset()))
        first = first or end["polled_at"]
        for _ in range(2):  # a batch that runs again asks for the same pages of the same polls
            rows = [row for p in reader.partitions(start, end) for row in reader.read(p)]
        asked.append([r[0] for r in rows if r[3] == first and r[0] == 100])
        reader.commit(end)
        start, end = end, None
        monkeypatch.setattr(poll.time, "time_ns", lambda now=start["polled_at"]: (now + 10_000) * 1_000_000)
    assert [len(x) for x in asked] == [1, 1, 1, 0]
    down.clear()
    end = reader.latestOffset()
    assert {p[1] for p in end["retry"]} == {100}
    rows = [row for p in reader.partitions(start, end) for row in reader.read(p)]
    assert all(r[2] is None for r in rows) and len(rows) == 3 + len(end["retry"])
    reader.commit(end)
    assert reader.latestOffset()["retry"] == []


def test_options_are_checked(spark):
    with pytest.raises(Exception, match="either the option url or the option path"):
        poll.poll(spark).count()


def test_stream_polls_once_per_trigger(spark, tmp_path):
    (tmp_path / "pages").mkdir()
    url = save_pages(tmp_path / "pages", 20, 10)
    pages = poll.poll(spark, stream=True, url=url, limit=10)

    def drain():
        query = (
            pages.writeStream.format("parquet").option("path", str(tmp_path / "out"))
            .option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
        )
        query.awaitTermination()

    drain()
    first = spark.read.parquet(str(tmp_path / "out")).count()
    drain()
    assert (first, spark.read.parquet(str(tmp_path / "out")).count()) == (2, 4)


def test_failed_planning_never_shortens_a_poll(monkeypatch):
    """The first request fails once, then always: 15 pages, or one error row."""
    left = [1]

    def fetch(address, timeout):
        if left[0] > 0:
            left[0] -= 1
            raise OSError("down")
        return json.dumps({"total_count": 1447, "results": []})

    monkeypatch.setattr(poll, "fetch", fetch)
    options = {"url": "https://example.org/r?limit={limit}&offset={offset}"}
    reader = poll.PollReader(options)
    rows = [row for p in reader.partitions() for row in reader.read(p)]
    assert [r[0] for r in rows] == list(range(0, 1447, 100)) and all(r[2] is None for r in rows)
    left[0] = poll.PLAN_TRIES
    rows = [row for p in reader.partitions() for row in reader.read(p)]
    assert len(rows) == 1 and rows[0][:2] == (0, None) and "down" in rows[0][2]
