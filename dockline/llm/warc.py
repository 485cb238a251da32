"""WARC archives: records written from pages, and a salvage reader.

Archives are WARC/1.1 files with a gzip member per record, so that damage
costs the records it touches. They are written through Spark's text writer, so
any file system that Spark knows will do.
The reader checks every record (version line, length, record end, digest).
After a failed check it looks for the next version line, or in compressed
archives for the next member that inflates, reads on from there and reports
the bytes in between as a gap.
"""

from __future__ import annotations

import gzip
import hashlib
import re
import zlib
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockline.session import scratch_dir

# Fixed values of the format.
VERSION = "WARC/1.1"
END = "\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

# Payloads below this size are always stored.
MIN_REVISIT_BYTES = 100
# Records and bytes of one archive file (a larger record has its own); they bound what a writing or reading task holds.
ARCHIVE_RECORDS = 1000
ARCHIVE_BYTES = 16 << 20

RECORD_SCHEMA = """file string, kind string, start bigint, stop bigint, page_id bigint, url string,
    record_type string, refers_to bigint, payload_digest string, payload binary, reason string"""


def records(pages: DataFrame) -> DataFrame:
    """Per page its payload digest, its record type and, for a revisit, the page it refers to.

    A null html counts as empty. Of equal payloads of MIN_REVISIT_BYTES or
    more, the smallest page_id is the response; rows that repeat that page_id
    are responses too, and rows without a page_id never are referred to.
    """
    base = pages.select(
        pages["page_id"].cast("bigint").alias("page_id"), pages["url"].cast("string").alias("url"),
        F.coalesce(pages["html"].cast("string"), F.lit("")).alias("html"),
    ).withColumn("payload_digest", F.sha2("html", 256)).withColumn("payload_bytes", F.octet_length("html").cast("bigint"))
    # grouped by a hash too: the join then shuffles these rows again, which leaves AQE free to split a digest of many pages
    first = base.where(F.col("payload_bytes") >= MIN_REVISIT_BYTES).groupBy(
        F.xxhash64("payload_digest").alias("_hash"), "payload_digest"
    ).agg(F.min("page_id").alias("_first"), F.count(F.lit(1)).alias("_copies")).where(
        "_copies > 1 and _first is not null").drop("_copies", "_hash")
    revisit = F.col("_first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("_first"))
    return base.join(first, "payload_digest", "left").select(
        "page_id", "url", "html", "payload_digest", "payload_bytes",
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("_first")).alias("refers_to"),
    )


def record_text(row: DataFrame) -> Column:
    """Header and block of a record, without the record end."""
    revisit = F.col("record_type") == "revisit"
    block = F.when(revisit, "").otherwise(F.col("html"))
    number = F.coalesce(F.col("page_id").cast("string"), F.lit("none"))
    # a line break in a url would end the header line, so it is written as in urls
    url = F.replace(F.replace(F.coalesce("url", F.lit("")), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    lines = [
        F.lit(VERSION),
        F.concat(F.lit("WARC-Type: "), F.col("record_type")),
        F.concat(F.lit("WARC-Record-ID: <urn:page:"), number, F.lit(">")),
        F.lit("WARC-Date: 1970-01-01T00:00:00Z"),
        F.when(F.col("url").isNotNull(), F.concat(F.lit("WARC-Target-URI: "), url)),
        F.concat(F.lit("WARC-Payload-Digest: sha256:"), F.col("payload_digest")),
        F.when(~revisit, F.concat(F.lit("WARC-Block-Digest: sha256:"), F.col("payload_digest"))),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To: <urn:page:"), F.col("refers_to").cast("string"), F.lit(">"))),
        F.when(revisit, F.lit(f"WARC-Profile: {REVISIT_PROFILE}")),
        F.lit("Content-Type: application/octet-stream"),
        F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string")),
    ]
    return F.concat(F.concat_ws("\r\n", *lines), F.lit(END), block)


# A gzip member that holds nothing: the line end of an archive that is written as one line.
_NOTHING = gzip.compress(b"", mtime=0)


def write_archives(pages: DataFrame, path: str, compression: str = "gzip") -> None:
    """Write a record per row, to archives of ARCHIVE_RECORDS records and ARCHIVE_BYTES at most.

    Every record is a gzip member of its own, or plain with compression "none".
    """
    out = records(pages)
    text = out.select(record_text(out).alias("value"))
    if compression == "none":
        text.write.mode("errorifexists").option("lineSep", END).option("maxRecordsPerFile", ARCHIVE_RECORDS).text(path)
        return

    def pack(batches):
        import pyarrow as pa

        held: list[bytes] = []
        size = 0
        for batch in batches:
            for value in batch.column(0):
                member = gzip.compress(value.as_py() + END.encode(), 6, mtime=0)
                if held and (len(held) == ARCHIVE_RECORDS or size + len(member) > ARCHIVE_BYTES):
                    yield pa.RecordBatch.from_pydict({"value": [b"".join(held)]})
                    held, size = [], 0
                held.append(member)
                size += len(member)
        if held:
            yield pa.RecordBatch.from_pydict({"value": [b"".join(held)]})

    # the writer puts bytes out as they are; an archive is one line, and a file has one line
    text.select(F.col("value").cast("binary")).mapInArrow(pack, "value binary").select(F.col("value").cast("string")).write.mode(
        "errorifexists").option("encoding", "ISO-8859-1").option("lineSep", _NOTHING.decode("latin-1")).option(
        "compression", "none").option("maxRecordsPerFile", 1).text(path)


def read_archives(spark, path: str) -> DataFrame:
    """Every record of the archives, and every gap that had to be skipped (kind 'gap')."""

    def run(batches):
        import pandas as pd

        for batch in batches:
            for file, content in zip(batch["path"], batch["content"], strict=True):
                rows: list[tuple] = []
                held = 0
                for row in salvage(bytes(content)):
                    rows.append((file, *row))
                    held += len(row[8] or b"")
                    if held > ARCHIVE_BYTES:
                        yield pd.DataFrame(rows, columns=names)
                        rows, held = [], 0
                yield pd.DataFrame(rows, columns=names)

    names = [x.split()[0] for x in RECORD_SCHEMA.split(",")]
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInPandas(run, RECORD_SCHEMA)


# a version line with a header line after it; after a cut it may follow any byte
_LINE = re.compile(rb"WARC/\d\.\d\r\n(?=[A-Za-z-]+:)")
_GZIP = b"\x1f\x8b\x08"


def salvage(data: bytes) -> Iterator[tuple]:
    """Records and gaps of one archive, in order: (kind, start, stop, page_id, url, type, refers_to, digest, payload, reason).

    Offsets of a compressed archive are those of the members that hold the
    record.
    """
    if data[:3] == _GZIP:
        yield from _members(data)
    elif _GZIP in data and not _LINE.match(data):
        # the start is damaged, so the reading that finds more records counts
        yield from max(list(_plain(data, 0, len(data))), list(_members(data)), key=lambda rows: sum(r[0] == "record" for r in rows))
    else:
        yield from _plain(data, 0, len(data))


def _plain(data: bytes, at: int, end: int) -> Iterator[tuple]:
    broken = why = None
    while at < end:
        record, stop, reason = _record(data, at, end)
        if record is None:
            broken, why = (at, reason) if broken is None else (broken, why)
            found = _LINE.search(data, at + 1, end)
            at = found.start() if found else end
            continue
        if broken is not None:
            yield _gap(broken, at, why)
            broken = None
        yield ("record", at, stop, *record, None)
        at = stop
    if broken is not None:
        yield _gap(broken, end, why)


def _members(data: bytes) -> Iterator[tuple]:
    at, broken, why = 0, None, None
    while at < len(data):
        plain, stop, whole = _inflate(data, at)
        rows = list(_plain(plain, 0, len(plain)))
        if not whole:
            rows = [r for r in rows if r[0] == "record"]
            if broken is None or rows:
                if broken is not None:
                    yield _gap(broken, at, why)
                broken, why = at, "member does not inflate" if not rows else "member breaks off"
            found = data.find(_GZIP, at + 1)
            stop = found if found >= 0 else len(data)
        elif broken is not None:
            yield _gap(broken, at, why)
            broken = None
        for row in rows:
            yield (row[0], at, stop, *row[3:])
        at = stop
    if broken is not None:
        yield _gap(broken, len(data), why)


def _inflate(data: bytes, at: int, step: int = 1 << 16) -> tuple[bytes, int, bool]:
    """What the member that starts at `at` holds, where it stops, and whether it is whole."""
    inflater, parts, view, start = zlib.decompressobj(31), [], memoryview(data), at
    while at < len(data) and not inflater.eof:
        piece = view[at : at + step]
        try:
            parts.append(inflater.decompress(piece))
        except zlib.error:
            return b"".join([*parts, _before_error(view, start, at, step)]), at, False
        at += len(piece) - len(inflater.unused_data)
    return b"".join(parts), at, inflater.eof


def _before_error(view: memoryview, start: int, at: int, step: int) -> bytes:
    """What the piece at `at`, which does not inflate, gives before its error, read byte by byte."""
    inflater, parts = zlib.decompressobj(31), []
    for i in range(start, at, step):
        inflater.decompress(view[i : i + step])
    try:
        for i in range(at, min(at + step, len(view))):
            parts.append(inflater.decompress(view[i : i + 1]))
    except zlib.error:
        pass
    return b"".join(parts)


def _gap(start: int, stop: int, why: str) -> tuple:
    return ("gap", start, stop, None, None, None, None, None, None, why)


def _record(data: bytes, at: int, end: int) -> tuple[tuple | None, int, str]:
    """The record that starts at `at`, or why there is none."""
    if not _LINE.match(data, at):
        return None, at, "no version line"
    body = data.find(b"\r\n\r\n", at, end)
    if body < 0:
        return None, at, "header does not end"
    head = {}
    for line in data[at:body].split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            return None, at, "header line without a name"
        if name.strip().lower() in head:
            return None, at, "header field twice"
        head[name.strip().lower()] = value.strip().decode("utf-8", errors="replace")
    size = head.get(b"content-length", "")
    if not size.isdigit():
        return None, at, "no length"
    start, stop = body + 4, body + 4 + int(size)
    if stop + 4 > end or data[stop : stop + 4] != b"\r\n\r\n":
        return None, at, "record end is not where the length says"
    payload = data[start:stop]
    digest = head.get(b"warc-block-digest", "").removeprefix("sha256:")
    if digest and hashlib.sha256(payload).hexdigest() != digest:
        return None, at, "digest differs"
    number = lambda name: _page(head.get(name, ""))
    return (
        number(b"warc-record-id"), head.get(b"warc-target-uri"), head.get(b"warc-type"),
        number(b"warc-refers-to"), head.get(b"warc-payload-digest", "").removeprefix("sha256:") or None, payload,
    ), stop + 4, ""


def _page(urn: str) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?\d+)>", urn)
    return int(found[1]) if found else None


def archive_pages(pages: DataFrame) -> DataFrame:
    """Write the pages to archives in the shared folder, read them back, and say what was found.

    Per page: page_id, url, payload_bytes, payload_digest (both of the full
    payload; a revisit has them from the response it refers to), record_type,
    refers_to. Records are checked on reading; bytes of an archive that could
    not be read back are a row of record_type 'gap', with their place and the
    reason as url and their number as payload_bytes.
    """
    spark = pages.sparkSession
    path = scratch_dir(spark, "warc")
    write_archives(pages, path)
    return restored(read_archives(spark, path))


def restored(found: DataFrame) -> DataFrame:
    """The pages, and the gaps, of what `read_archives` found.

    A revisit whose response was lost stays, with the digest it names and
    payload_bytes null.
    """
    gap = F.col("kind") == "gap"
    read = found.select(
        "page_id", F.when(gap, F.concat_ws(" ", "file", "start", "stop", "reason")).otherwise(F.col("url")).alias("url"),
        F.when(gap, "gap").otherwise(F.col("record_type")).alias("record_type"), "refers_to", F.col("payload_digest").alias("_named"),
        F.when(gap, F.col("stop") - F.col("start")).otherwise(F.octet_length("payload").cast("bigint")).alias("_bytes"),
        F.sha2("payload", 256).alias("_digest"),
    )
    stored = read.where("record_type = 'response'").select(
        F.col("page_id").alias("_page"), F.col("_bytes").alias("_full"), F.col("_digest").alias("_whole")
    ).where("_page is not null").dropDuplicates(["_page", "_whole"])
    revisit = read.where("record_type = 'revisit'")
    return revisit.join(
        stored, (revisit["refers_to"] == stored["_page"]) & (revisit["_named"] == stored["_whole"]), "left"
    ).select(
        "page_id", "url", F.col("_full").alias("payload_bytes"), F.col("_named").alias("payload_digest"), "record_type", "refers_to"
    ).unionByName(read.where("record_type in ('response', 'gap')").select(
        "page_id", "url", F.col("_bytes").alias("payload_bytes"), F.col("_digest").alias("payload_digest"), "record_type", "refers_to"
    ))
