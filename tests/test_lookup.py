import json

import pytest
from pyspark.sql import functions as F

from dockline import schemas
from dockline.operators import enrich
from dockline.sources import lookup

ENTRIES = {"9020": "Toits - Gare", "1": "trailing ", "2": "double  space", "3": 'quote "é"'}


def rows(df):
    return {tuple(r) for r in df.collect()}


def test_read_one_line_and_pretty_printed(spark, tmp_path):
    one, many = tmp_path / "one.json", tmp_path / "many.json"
    one.write_text(json.dumps(ENTRIES))
    many.write_text(json.dumps(ENTRIES, indent=2, ensure_ascii=False))
    assert rows(lookup.read_lookup(spark, str(one))) == set(ENTRIES.items())
    assert rows(lookup.read_lookup(spark, str(many), multiline=True)) == set(ENTRIES.items())


def test_further_objects_are_read_or_refused(spark, tmp_path):
    (tmp_path / "two.json").write_text('{"1": "a } {"}\n\n{"2": "b",\n "3": "c"}\n')
    assert rows(lookup.read_lookup(spark, str(tmp_path / "two.json"), multiline=True)) == {("1", "a } {"), ("2", "b"), ("3", "c")}
    (tmp_path / "one.json").write_text('{"1": "a"} {"2": "b"}')
    for multiline in (False, True):
        with pytest.raises(Exception, match="behind its first object"):
            lookup.read_lookup(spark, str(tmp_path / "one.json"), multiline=multiline).collect()


@pytest.mark.parametrize("objects", [1, 4])
def test_large_lookup_round_trips(spark, tmp_path, objects):
    table = spark.range(30_000).selectExpr("cast(id as string) stationcode", "concat('n', id) name_custom")
    lookup.write_lookup(table, str(tmp_path / "out"), objects=objects)
    for multiline in (False, True):
        assert lookup.read_lookup(spark, str(tmp_path / "out"), multiline=multiline).exceptAll(table).isEmpty()
        assert lookup.read_lookup(spark, str(tmp_path / "out"), multiline=multiline).count() == 30_000


def test_repeated_keys_keep_one_row_per_station(spark):
    stations = spark.createDataFrame([("1", "x"), ("2", "y")], "stationcode string, name string")
    codes = spark.createDataFrame([("1", "b"), ("1", "a"), ("1", None)], schemas.CODE_LOOKUP)
    assert rows(enrich.enrich_names(stations, codes).select("stationcode", "name_custom")) == {("1", "a"), ("2", None)}
    names = spark.createDataFrame([("x", "92"), ("x", "75")], schemas.DEPARTMENT_LOOKUP)
    out = enrich.enrich_department(stations, names)
    assert out.count() == 2 and rows(out.select("stationcode", "department")) == {("1", "75"), ("2", "Unknown")}


def test_unreadable_object_gives_no_rows(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"1": "x"')
    assert rows(lookup.read_lookup(spark, str(tmp_path))) == set()


def test_lookup_is_one_object_by_default(spark, tmp_path):
    table = lookup.literal_lookup(spark, ENTRIES)
    lookup.write_lookup(table, str(tmp_path / "out"))
    objects = [json.loads(r.value) for r in spark.read.text(str(tmp_path / "out")).collect()]
    assert objects == [ENTRIES]


def test_large_lookup_is_spread(spark):
    table = spark.range(1000).select(
        F.col("id").cast("string").alias("stationcode"), F.lit("n").alias("name_custom"))
    objects = lookup.lookup_objects(table, objects=10)
    sizes = [len(json.loads(r.value)) for r in objects.collect()]
    assert sum(sizes) == 1000 and len(sizes) == 10 and max(sizes) < 200
    assert enrich.lookup_to_rows(objects).exceptAll(table).isEmpty()


def test_repeated_and_null_keys(spark):
    table = spark.createDataFrame([("1", "b"), ("1", "a"), (None, "x"), ("2", None)], schemas.CODE_LOOKUP)
    back = enrich.lookup_to_rows(lookup.lookup_objects(table))
    assert rows(back) <= {("1", "a"), ("2", None)} and ("1", "a") in rows(back)


def test_empty_lookup(spark, tmp_path):
    empty = spark.createDataFrame([], schemas.CODE_LOOKUP)
    lookup.write_lookup(empty, str(tmp_path / "out"))
    assert lookup.read_lookup(spark, str(tmp_path / "out")).isEmpty()


def test_department_default(spark, stations, by_code):
    table = lookup.literal_lookup(spark, {"full": "75", "empty": "92"}, schemas.DEPARTMENT_LOOKUP)
    out = enrich.enrich_department(stations, table)
    assert out.columns == stations.columns + ["department"]
    assert by_code(out, "department") == {c: {"2": "75", "3": "92"}.get(c, "Unknown") for c in "12345678"}


def test_unreadable_object_takes_no_other_with_it(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"1": "a", "2": }\n{"3": "c"}\n{"4": "d"\n')
    for multiline in (False, True):
        assert rows(lookup.read_lookup(spark, str(tmp_path), multiline=multiline)) == {("3", "c")}
        errors = lookup.lookup_errors(spark, str(tmp_path), multiline=multiline).collect()
        assert len(errors) == 2 and all(r.file.endswith("a.json") for r in errors)
    values = spark.createDataFrame([('{"1": "a", "2": }\n{"3": "c"}',), (None,), ("",)], "value string")
    assert rows(enrich.lookup_to_rows(values)) == {("3", "c")}
    assert [r.object for r in enrich.unreadable_objects(values).collect()] == ['{"1": "a", "2": }']


def test_large_object_is_many_tasks(spark, tmp_path, conf):
    """30,000 entries in three objects of one file, one of them broken, cut into many splits."""
    whole = {str(i): 'n } { "%d"\\' % i for i in range(30_000)}
    items = list(whole.items())
    texts = [json.dumps(dict(items[a:a + 10_000]), indent=1) for a in (0, 10_000, 20_000)]
    texts[1] = texts[1].replace('"15000":', '"15000"')
    (tmp_path / "names.json").write_text("\n".join(texts))
    conf("spark.sql.files.maxPartitionBytes", "64k")
    read = lookup.read_lookup(spark, str(tmp_path), multiline=True)
    assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 5
    assert rows(read) == set(items[:10_000] + items[20_000:])
    error = lookup.lookup_errors(spark, str(tmp_path), multiline=True).collect()
    assert [(r.object_nr, r.text.strip()[:7]) for r in error] == [(2, '"15000"')]
