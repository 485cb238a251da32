from pyspark.sql import functions as F

from dockline.functions import station
from dockline.plans import board


def test_board(stations):
    placed = stations.withColumns({
        "is_full": station.is_full(),
        "lat": F.lit(48.0) + F.col("stationcode").cast("int") / 100, "lon": F.lit(2.0),
    })
    parts = board.board(placed, "full", user=(48.031, 2.0))
    assert {r.stationcode for r in parts["map"].collect()} == {"1", "2"}
    assert parts["kpi_text"].first() == ("25.0%", "25.0%")
    assert {r.stationcode for r in parts["full"].collect()} == {"1", "2"}
    assert {r.stationcode for r in parts["empty"].collect()} == {"1", "3"}
    assert parts["stations"].count() == 8
    near = parts["nearest"].first()
    assert near.stationcode == "3"
    assert near.message == "Station la plus proche : empty à 111 m"
    assert near.url == "https://www.google.com/maps/dir/48.031,2.0/48.03,2.0"
    assert near.route == [[2.0, 48.031], [2.0, 48.03]]
    assert {(r.lat, r.lon, r.label) for r in parts["points"].collect()} == {
        (48.031, 2.0, board.USER_LABEL), (48.03, 2.0, board.NEAREST_LABEL)
    }
    assert set(board.board(placed)) == set(parts) - {"nearest", "points"}
