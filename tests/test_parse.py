import datetime
import json

from pyspark.sql import functions as F

from dockline import schemas
from dockline.operators import parse
from dockline.operators.envelope import make_envelopes, single_envelopes


def message(*stations, total=None):
    return json.dumps({"total_count": total or len(stations), "results": list(stations)})


def frame(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_output_schema(spark):
    lookup = spark.createDataFrame([], schemas.CODE_LOOKUP)
    rows = parse.transform(frame(spark, message({"stationcode": "1"})), lookup)
    assert [(f.name, f.dataType) for f in rows.schema] == [
        (f.name, f.dataType) for f in schemas.STATION_OUT
    ]
    assert len(rows.columns) == 19


def test_unreadable_messages_give_no_rows(spark):
    good = message({"stationcode": "1"})
    bad = frame(spark, "", "no json", good[:-4], None, "{}", '{"results": null}', message(), "[]", "7")
    assert parse.transform(bad).count() == 0
    assert parse.transform(bad.union(frame(spark, good))).count() == 1


def test_wrong_types_become_null_and_spare_the_rest(spark):
    station = {
        "stationcode": 16107, "name": "x", "capacity": "7", "numdocksavailable": 3.5,
        "numbikesavailable": 4, "duedate": 12.5, "coordonnees_geo": {"lon": 2.5, "lat": 48},
        "unknown_field": [1],
    }
    second = {"stationcode": "2", "numbikesavailable": 9}
    rows = {r.stationcode: r for r in parse.transform(frame(spark, message(station, second))).collect()}
    first = rows["16107"]
    assert (first.name, first.capacity, first.numdocksavailable, first.numbikesavailable) == ("x", None, None, 4)
    assert (first.duedate, first.lat, first.lon, first.is_full) == ("12.5", 48.0, 2.5, None)
    assert rows["2"].numbikesavailable == 9


def test_binary_value_and_kept_columns(spark):
    log = frame(spark, message({"stationcode": "1"}, {"stationcode": "2"})).select(
        F.col("value").cast("binary").alias("value"), F.lit(7).cast("long").alias("offset")
    )
    rows = parse.transform(log, keep=["offset"]).collect()
    assert [(r.stationcode, r.offset) for r in rows] == [("1", 7), ("2", 7)]


def test_ingest_time(spark):
    source = frame(spark, message({"stationcode": "1"}, {"stationcode": "2"}))
    assert parse.transform(source).select("timestamp").distinct().count() == 1
    fixed = F.lit("2024-05-06 07:08:09").cast("timestamp")
    row = parse.transform(source, ingest_time=fixed).first()
    assert row.timestamp == datetime.datetime(2024, 5, 6, 7, 8, 9)


def test_names_match_exactly_and_keep_spaces(spark):
    source = frame(spark, message(*[{"stationcode": c} for c in ("1", "01", "2", "3")]))
    lookup = spark.createDataFrame([("1", "one "), ("2", "two  words")], schemas.CODE_LOOKUP)
    rows = parse.transform(source, lookup).collect()
    assert {r.stationcode: r.name_custom for r in rows} == {
        "1": "one ", "01": None, "2": "two  words", "3": None
    }


def test_envelopes_round_trip(spark, stations):
    located = stations.withColumns({"lat": F.lit(48.5), "lon": F.lit(2.5)})
    columns = located.columns
    expected = located.select(columns)
    for messages in (single_envelopes(located), make_envelopes(located, F.col("stationcode").cast("int") % 3)):
        back = parse.transform(messages).select(columns)
        assert back.exceptAll(expected).isEmpty() and expected.exceptAll(back).isEmpty()


def test_envelope_total(spark, stations):
    pages = make_envelopes(stations, F.col("stationcode").cast("int") % 3, F.lit(8))
    bodies = [json.loads(r.value) for r in pages.collect()]
    assert [b["total_count"] for b in bodies] == [8, 8, 8]
    assert sum(len(b["results"]) for b in bodies) == 8
