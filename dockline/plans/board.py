"""Everything a station board shows, from one snapshot."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockline.functions import geo, station, text
from dockline.operators import filters, kpi, nearest

# Labels of the two points on the map.
USER_LABEL = "Vous êtes ici"
NEAREST_LABEL = "Station la plus proche"


def map_rows(snapshot: DataFrame, choice: str = "all") -> DataFrame:
    """Markers with colour and tooltip, for all, full or empty stations."""
    rows = filters.map_filter(filters.fill_area(snapshot), choice)
    return rows.withColumns({"color": station.station_color(rows), "tooltip": station.station_tooltip(rows)})


def search_result(nearest_rows: DataFrame) -> DataFrame:
    """Message, directions link and route for points with their nearest station."""
    here, there = (F.col("ulat"), F.col("ulon")), (F.col("lat"), F.col("lon"))
    return nearest_rows.withColumns({
        "message": text.nearest_label(F.col("name"), F.col("distance_m")),
        "url": text.directions_url(*here, *there),
        "route": geo.route_geometry(*here, *there),
    })


def labelled_points(nearest_rows: DataFrame, *keep: str) -> DataFrame:
    """Two rows per search: the user's point and the nearest station."""
    pair = F.array(
        F.struct(F.col("ulat").alias("lat"), F.col("ulon").alias("lon"), F.lit(USER_LABEL).alias("label")),
        F.struct("lat", "lon", F.lit(NEAREST_LABEL).alias("label")),
    )
    return nearest_rows.select(*keep, F.inline(pair))


def board(
    snapshot: DataFrame, choice: str = "all", user: tuple[float, float] | None = None
) -> dict[str, DataFrame]:
    """The parts of the board by name; each is computed only when used."""
    filled = filters.fill_area(snapshot)
    indicators = kpi.kpis(snapshot)
    parts = {
        "map": map_rows(snapshot, choice),
        "kpis": indicators,
        "kpi_text": kpi.kpi_text(indicators),
        "bike_split": kpi.bike_split(indicators),
        "areas": kpi.sum_by_area(snapshot),
        "full": filters.list_full(filled),
        "empty": filters.list_empty(filled),
        "stations": filters.stations_table(filled),
    }
    if user is not None:
        found = nearest.nearest_to_point(snapshot, *user).withColumns(
            {"ulat": F.lit(float(user[0])), "ulon": F.lit(float(user[1]))}
        )
        parts["nearest"] = search_result(found)
        parts["points"] = labelled_points(found)
    return parts
