import gzip
import hashlib
import random
from pathlib import Path

import pytest

from dockline.llm import warc
from dockline.session import scratch_dir


def plain_record(page, payload):
    digest = hashlib.sha256(payload).hexdigest()
    head = f"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:{page}>\r\nWARC-Block-Digest: sha256:{digest}\r\n"
    return f"{head}Content-Length: {len(payload)}\r\n\r\n".encode() + payload + b"\r\n\r\n"


PAGES = [plain_record(i, f"<p>page {i}</p>".encode() * (i + 1)) for i in range(6)]


def found(data):
    rows = list(warc.salvage(data))
    return [r[3] for r in rows if r[0] == "record"], [(r[1], r[2]) for r in rows if r[0] == "gap"]


def test_reads_whole_archives():
    assert found(b"".join(PAGES)) == ([0, 1, 2, 3, 4, 5], [])
    assert found(b"".join(map(gzip.compress, PAGES))) == ([0, 1, 2, 3, 4, 5], [])
    assert found(gzip.compress(b"".join(PAGES))) == ([0, 1, 2, 3, 4, 5], [])
    assert found(b"") == ([], [])


@pytest.mark.parametrize("damage", [
    lambda r: r.replace(b"Content-Length: ", b"Content-Length: 9"),
    lambda r: r.replace(b"WARC/1.1", b"WARX/1.1"),
    lambda r: r.replace(b"page 2", b"pagE 2"),
    lambda r: r[: len(r) // 2],
    lambda r: b"\x00" * len(r),
])
def test_skips_a_broken_record(damage):
    parts = [*PAGES[:2], damage(PAGES[2]), *PAGES[3:]]
    start = len(PAGES[0]) + len(PAGES[1])
    assert found(b"".join(parts)) == ([0, 1, 3, 4, 5], [(start, start + len(parts[2]))])


def test_skips_a_broken_member():
    members = [gzip.compress(p, mtime=0) for p in PAGES]
    members[2] = members[2][:20] + b"\xff" * (len(members[2]) - 20)
    start = len(members[0]) + len(members[1])
    assert found(b"".join(members)) == ([0, 1, 3, 4, 5], [(start, start + len(members[2]))])


def test_keeps_what_a_cut_member_still_holds():
    data = gzip.compress(b"".join(PAGES * 50))
    pages, gaps = found(data[: len(data) - 40])
    assert 0 < len(pages) < 300 and gaps == [(0, len(data) - 40)]


def test_cut_tail_is_a_gap():
    data = b"".join(PAGES)
    cut = len(data) - len(PAGES[5])
    assert found(data[:-3]) == ([0, 1, 2, 3, 4], [(cut, len(data) - 3)])


def test_version_line_inside_a_payload():
    inner = plain_record(9, b"x\nWARC/1.1\r\nfoo")
    assert found(PAGES[0] + inner + PAGES[1]) == ([0, 9, 1], [])


def pages_of(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string, payload_digest string")


def test_archives_round_trip(spark):
    long = "<p>é</p>" * 30
    rows = [
        (3, "http://a", long, "x"), (1, "http://b\nWARC/1.1", long, None), (2, None, None, None), (4, "u", "", None),
        (5, "u", "short", None), (6, "u", "short", None), (None, "u", long, None), (1, "again", long, None),
        (7, "u", "\r\n\r\nWARC/1.1\r\n" * 20, None),
    ]
    got = {}
    for r in warc.archive_pages(pages_of(spark, rows)).collect():
        got.setdefault(r.page_id, []).append(r)
    digest = hashlib.sha256(long.encode()).hexdigest()
    assert [r.record_type for r in got[1]] == ["response", "response"]
    assert (got[3][0].record_type, got[3][0].refers_to, got[3][0].payload_digest) == ("revisit", 1, digest)
    assert (got[None][0].record_type, got[None][0].refers_to) == ("revisit", 1)
    assert got[3][0].payload_bytes == len(long.encode())
    assert (got[2][0].payload_bytes, got[4][0].payload_bytes) == (0, 0)
    assert {got[i][0].record_type for i in (2, 4, 5, 6, 7)} == {"response"}
    assert sum(map(len, got.values())) == len(rows)


def test_empty_table(spark):
    assert warc.archive_pages(pages_of(spark, [])).count() == 0


def test_plain_archives_and_gaps(spark):
    path = scratch_dir(spark, "plain")
    warc.write_archives(pages_of(spark, [(i, "u", f"text {i}", None) for i in range(5)]), path, "none")
    files = warc.read_archives(spark, path)
    assert sorted(r.page_id for r in files.where("kind = 'record'").collect()) == [0, 1, 2, 3, 4]
    assert files.where("kind = 'gap'").count() == 0


def test_a_flipped_byte_costs_one_record(spark):
    path = scratch_dir(spark, "flipped")
    rnd = random.Random(7)
    rows = [(i, "u", "".join(rnd.choice("abcdefgh <>") for _ in range(300)), None) for i in range(60)]
    warc.write_archives(pages_of(spark, rows).coalesce(1), path)
    (file,) = Path(path).glob("part-*")
    data = file.read_bytes()
    whole = {r[3]: r[1:3] for r in warc.salvage(data)}
    assert sorted(whole) == list(range(60)) and gzip.decompress(data).count(b"Content-Length") == 60
    for at in (0, *rnd.sample(range(len(data) - 20), 40)):
        broken = data[:at] + bytes([data[at] ^ 0x55]) + data[at + 1 :]
        pages, gaps = found(broken)
        hit = {i for i, (start, stop) in whole.items() if start <= at < stop}
        assert set(range(60)) - hit <= set(pages) and len(pages) == len(set(pages)), at
        assert all(start <= at < stop for start, stop in gaps) and len(gaps) <= 1
        assert gaps or len(pages) == 60
    Path(file).write_bytes(data[:1000] + bytes([data[1000] ^ 0x55]) + data[1001:])
    (Path(path) / f".{file.name}.crc").unlink(missing_ok=True)
    got = warc.restored(warc.read_archives(spark, path)).collect()
    (gap,) = [r for r in got if r.record_type == "gap"]
    assert len(got) >= 60 and gap.payload_bytes > 0 and file.name in gap.url


def test_a_damaged_member_keeps_the_records_before_the_damage():
    rnd = random.Random(8)
    pages = [plain_record(i, bytes(rnd.choice(b"abcdefgh") for _ in range(400))) for i in range(40)]
    data = gzip.compress(b"".join(pages))
    assert len(data) < 1 << 16
    at = len(data) // 2
    kept, gaps = found(data[:at] + b"\xff" * 30 + data[at + 30 :])
    assert kept[:15] == list(range(15)) and gaps == [(0, len(data))]


def test_archives_are_bounded_by_bytes(spark, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 5000)
    path, rnd = scratch_dir(spark, "bounded"), random.Random(9)
    rows = [(i, "u", "".join(chr(rnd.randint(33, 1000)) for _ in range(600)), None) for i in range(30)]
    warc.write_archives(pages_of(spark, rows).coalesce(1), path)
    assert all(f.stat().st_size < 5100 for f in Path(path).glob("part-*"))
    assert warc.read_archives(spark, path).where("kind = 'record'").count() == 30


def test_a_revisit_stays_when_its_response_is_lost(spark):
    rows = [("f", "record", 0, 9, 5, "u", "revisit", 4, "d", b"", None)]
    (got,) = warc.restored(spark.createDataFrame(rows, warc.RECORD_SCHEMA)).collect()
    assert (got.page_id, got.payload_bytes, got.payload_digest, got.refers_to) == (5, None, "d", 4)


def test_hot_payload_is_split(spark, conf):
    """A third of all pages have one payload: AQE cuts that partition of the join by digest."""
    for key, value in {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }.items():
        conf(key, value)
    pages = spark.range(0, 60_000, 1, 16).selectExpr(
        "id page_id", "concat('http://a/', md5(cast(id as string))) url", "if(id % 3 = 0, repeat('same', 40), cast(id as string)) html")
    kinds = warc.records(pages).groupBy().agg({"refers_to": "count", "url": "max", "html": "max"})
    assert kinds.collect()[0]["count(refers_to)"] == 19_999
    assert "skew=true" in kinds._jdf.queryExecution().executedPlan().toString()
