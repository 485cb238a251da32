"""Polling source for a paged station API, as a Spark Python data source.

    spark.dataSource.register(StationPoll)
    spark.read.format("station_poll").option("url", template).load()
    spark.readStream.format("station_poll").option("url", template).load()

Options
    url             address template with the placeholders {limit} and {offset};
                    http, https, or any file system address that pyarrow opens
    limit           stations per page, default 100
    pages_per_task  pages one task fetches, default 1
    timeout         seconds per request, default 10
    state           streams only: a folder that all machines share, where pages
                    that failed are noted to be asked for again
    page_tries      how often a page of one poll is asked for, default 3

Rows are (page_offset, value, _error, polled_at); all pages of one poll share
their polled_at, in milliseconds, which saved responses lack. A page that cannot be read gives one
row with `_error` set and a null `value`; the other pages are not affected. If
the first page does not state the count of stations in PLAN_TRIES requests, the
poll is one such row for page 0.

A stream polls once per trigger. Its offset names the poll, the stations it has
and the pages of earlier polls that are still missing, so a batch that runs
again is the same poll with the same keys. With `state`, a page that failed is
part of the next batch, under the poll it belongs to.
"""

from __future__ import annotations

import json
import sys
import time
import urllib.request
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

from pyspark import cloudpickle
from pyspark.errors import AnalysisException
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    DataSourceStreamReader,
    InputPartition,
)

FORMAT = "station_poll"
SCHEMA = "page_offset bigint, value string, _error string, polled_at bigint"

# Requests for the page count before a poll is given up.
PLAN_TRIES = 3

# Executors get the classes by value and need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


@dataclass
class PagesPartition(InputPartition):
    offsets: Sequence[int]
    polled_at: int | None = None
    tried: int = 0


@dataclass
class FailedPlan(InputPartition):
    error: str
    polled_at: int | None = None


def _open(address: str):
    """File system and path of an address; a bare path is a local one."""
    from pyarrow import fs

    if address.startswith("file:"):
        address = address.removeprefix("file:").removeprefix("//")
    return fs.FileSystem.from_uri(address) if "://" in address else (fs.LocalFileSystem(), address)


def _files(address: str):
    """File system and data files at an address; a folder stands for its files."""
    from pyarrow import fs

    system, path = _open(address)
    info = system.get_file_info(path)
    if info.type == fs.FileType.NotFound:
        raise FileNotFoundError(address)
    if info.type == fs.FileType.File:
        return system, [path]
    found = system.get_file_info(fs.FileSelector(path, recursive=True))
    names = [i.path for i in found if i.type == fs.FileType.File and i.base_name[0] not in "._"]
    if not names:
        raise FileNotFoundError(address)
    return system, sorted(names)


def fetch(address: str, timeout: float) -> str:
    """The whole response at an address."""
    if address.startswith(("http://", "https://")):
        with urllib.request.urlopen(address, timeout=timeout) as response:
            return response.read().decode("utf-8")
    system, names = _files(address)
    parts = []
    for name in names:
        with system.open_input_stream(name) as stream:
            parts.append(stream.read().decode("utf-8"))
    return "".join(parts).strip()


class _Pages:
    """What the batch and the stream reader share."""

    def __init__(self, options):
        self.url = options.get("url")
        if not self.url:
            raise ValueError("give either the option url or the option path")
        self.limit = int(options.get("limit", 100))
        self.pages_per_task = int(options.get("pages_per_task", 1))
        self.timeout = float(options.get("timeout", 10))
        self.state = options.get("state")
        self.page_tries = int(options.get("page_tries", 3))

    def count(self) -> tuple[int | None, str | None]:
        """The count of stations that the first page states, or why it is unknown."""
        for left in reversed(range(PLAN_TRIES)):
            try:
                first = fetch(self.url.format(limit=self.limit, offset=0), self.timeout)
                return int(json.loads(first)["total_count"]), None
            except Exception as error:
                # Without the count the pages are unknown; reading the first alone would lose the others unseen.
                if not left:
                    return None, f"no page count: {type(error).__name__}: {error}"

    def plan(self, polled_at: int, total: int | None, error: str | None) -> list[InputPartition]:
        """All pages of a poll."""
        if total is None:
            return [FailedPlan(error, polled_at)]
        offsets = range(0, max(total, 1), self.limit)
        step = self.pages_per_task
        return [PagesPartition(offsets[i:i + step], polled_at) for i in range(0, len(offsets), step)]

    def rows(self, partition: InputPartition) -> Iterator[tuple]:
        if isinstance(partition, FailedPlan):
            yield 0, None, partition.error, partition.polled_at
            return
        for offset in partition.offsets:
            try:
                yield offset, fetch(self.url.format(limit=self.limit, offset=offset), self.timeout), None, partition.polled_at
            except Exception as error:
                if self.state and partition.tried + 1 < self.page_tries:
                    self._note(partition.polled_at, offset, partition.tried + 1)
                yield offset, None, f"{type(error).__name__}: {error}", partition.polled_at

    # -- pages to ask for again, one empty file each in the folder `state` --

    def _note(self, *page: int) -> None:
        system, path = _open(self.state)
        system.create_dir(path, recursive=True)
        with system.open_output_stream(f"{path}/" + "_".join(map(str, page))) as stream:
            stream.write(b"")

    def missing(self) -> list[list[int]]:
        """Pages to ask for again: time of the poll, page and tries so far."""
        from pyarrow import fs

        system, path = _open(self.state)
        found = system.get_file_info(fs.FileSelector(path, allow_not_found=True))
        return sorted([int(x) for x in f.base_name.split("_")] for f in found if f.base_name[0].isdigit())

    def forget(self, pages: Sequence[Sequence[int]]) -> None:
        from pyarrow import fs

        system, path = _open(self.state)
        for page in pages:
            name = f"{path}/" + "_".join(map(str, page))
            if system.get_file_info(name).type == fs.FileType.File:
                system.delete_file(name)


class PollReader(DataSourceReader):
    def __init__(self, options):
        self.pages = _Pages(options)

    def partitions(self):
        return self.pages.plan(time.time_ns() // 1_000_000, *self.pages.count())

    def read(self, partition):
        return self.pages.rows(partition)


class PollStreamReader(DataSourceStreamReader):
    """One poll of all pages per trigger, and pages that earlier polls lack.

    All that a batch asks for follows from its end offset. A batch that is run
    again after a failure asks anew, as the API keeps no history, but for the
    same pages under the same poll; who reads by poll and page sees each once.
    """

    def __init__(self, options):
        self.pages = _Pages(options)

    def initialOffset(self):
        return {"polled_at": 0}

    def latestOffset(self):
        now = time.time_ns() // 1_000_000
        total, error = self.pages.count()
        retry = self.pages.missing() if self.pages.state else []
        return {"polled_at": now, "total": total, "error": error, "retry": retry}

    def partitions(self, start, end):
        # Offsets of an earlier version name the time alone.
        total, error = (end.get("total"), end.get("error")) if "total" in end else self.pages.count()
        again = [PagesPartition([offset], polled_at, tried) for polled_at, offset, tried in end.get("retry", [])]
        return again + self.pages.plan(end["polled_at"], total, error)

    def read(self, partition):
        return self.pages.rows(partition)

    def commit(self, end):
        # Those that failed once more are noted anew, with one more try.
        if self.pages.state:
            self.pages.forget(end.get("retry", []))


class StationPoll(DataSource):
    @classmethod
    def name(cls):
        return FORMAT

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return PollReader(self.options)

    def streamReader(self, schema):
        return PollStreamReader(self.options)


def poll(spark, stream: bool = False, path: str | None = None, **options):
    """The poll source as a DataFrame; options as in the module text.

    `path` instead of `url` names a folder of saved responses, one per line;
    a plain text scan reads them, and a folder that is not there gives none.
    """
    if path is not None and "url" not in options:
        return _saved(spark, path, stream)
    if path is not None:
        raise ValueError("give either the option url or the option path")
    spark.dataSource.register(StationPoll)
    reader = (spark.readStream if stream else spark.read).format(FORMAT)
    return reader.options(**{k: str(v) for k, v in options.items()}).load()


def _saved(spark, path: str, stream: bool):
    try:
        lines = (spark.readStream if stream else spark.read).text(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], SCHEMA)
    return lines.where("trim(value) <> ''").selectExpr(
        "cast(null AS bigint) page_offset", "value", "cast(null AS string) _error", "cast(null AS bigint) polled_at")


def messages(polled):
    """The pages that were read, as messages; their key names the poll and the page."""
    return polled.where("_error IS NULL").selectExpr("concat_ws(':', polled_at, page_offset) AS key", "value")


def errors(polled):
    """The pages that were not."""
    return polled.where("_error IS NOT NULL").select("polled_at", "page_offset", "_error")
