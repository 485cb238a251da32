import pytest
from pyspark.sql import functions as F

from dockline.functions import station, text


def test_flags(stations, by_code):
    rows = stations.withColumns({
        "full": station.is_full(), "active": station.is_active(), "kind": station.type_dominant()
    })
    assert by_code(rows, "full") == {
        "1": True, "2": True, "3": False, "4": False, "5": False, "6": None, "7": False, "8": None
    }
    assert by_code(rows, "kind") == {
        "1": "egal", "2": "electrique", "3": "egal", "4": "mecanique", "5": "electrique",
        "6": "egal", "7": "egal", "8": "egal",
    }


def test_color(stations, by_code):
    rows = stations.withColumn("color", station.station_color(stations))
    colors = {k: tuple(v) for k, v in by_code(rows, "color").items()}
    assert colors == {
        "1": station.RED, "2": station.RED, "3": station.BLUE, "4": station.ORANGE,
        "5": station.GREEN, "6": station.GREEN, "7": station.GREEN, "8": station.GREEN,
    }
    without = stations.drop("numdocksavailable")
    assert {tuple(r[0]) for r in without.select(station.station_color(without)).collect()} == {station.GREEN}


def test_tooltip(stations, by_code):
    rows = stations.withColumn("tooltip", station.station_tooltip(stations))
    tips = by_code(rows, "tooltip")
    assert tips["2"] == "<b>full</b><br/>Vélos dispo : 7<br/>Bornes libres : 0<br/>Arrondissement : A"
    assert tips["6"] == "<b>docks unknown</b><br/>Vélos dispo : 2<br/>Bornes libres : <br/>Arrondissement : "
    without = stations.drop("arrondissement")
    assert {r[0] for r in without.select(station.station_tooltip(without)).collect()} == {""}


def test_percent_text_rounds_as_python_does(spark):
    pairs = spark.range(1, 401).select(F.col("id").alias("n")).join(
        spark.range(0, 401).select(F.col("id").alias("a")), F.expr("a <= n")
    ).withColumn("pct", F.col("a") / F.col("n") * 100.0)
    more = spark.createDataFrame([(9.45,), (9.55,), (9.65,), (0.25,), (0.75,), (99.95,), (12.25,), (0.05,)], "pct double")
    for rows in (pairs.select("pct"), more):
        for r in rows.select("pct", text.percent_text(F.col("pct")).alias("t")).collect():
            assert r.t == f"{r.pct:.1f}%", r


def test_texts(spark):
    row = spark.range(1).select(
        text.nearest_label(F.lit("Gare"), F.lit(129.99)).alias("label"),
        text.directions_url(F.lit(48.5), F.lit(2.25), F.lit(48.75), F.lit(2.5)).alias("url"),
        text.clock_text(F.lit("2024-02-03 04:05:06.7").cast("timestamp")).alias("clock"),
    ).first()
    assert row.label == "Station la plus proche : Gare à 129 m"
    assert row.url == "https://www.google.com/maps/dir/48.5,2.25/48.75,2.5"
    assert row.clock == "03/02/2024 04:05:06"


@pytest.mark.parametrize("value", [0.0, 100.0])
def test_percent_ends(spark, value):
    assert spark.range(1).select(text.percent_text(F.lit(value))).first()[0] == f"{value:.1f}%"


def test_links_and_labels_at_the_edges(spark):
    row = spark.range(1).select(
        text.directions_url(F.lit(51.4779), F.lit(-0.0005), F.lit(51.5), F.lit(0.00012)).alias("url"),
        text.directions_url(F.lit(0.0), F.lit(2.0), F.lit(1e-7), F.lit(-180.0)).alias("zero"),
        text.nearest_label(F.lit(None).cast("string"), F.lit(5.0)).alias("label"),
    ).first()
    assert row.url.endswith("/51.4779,-0.0005/51.5,0.00012")
    assert row.zero.endswith("/0.0,2.0/0.0000001,-180.0")
    assert row.label == "Station la plus proche :  à 5 m"
