"""Column expressions over one station row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Marker colours (RGBA) and default area names.
RED = (255, 0, 0, 160)
BLUE = (0, 100, 255, 160)
ORANGE = (255, 140, 0, 160)
GREEN = (0, 255, 127, 160)
UNKNOWN_AREA = "Inconnu"
UNKNOWN_DEPARTMENT = "Unknown"

LOW_DOCKS = 3


def is_full() -> Column:
    """True when no dock is free; null when the dock count is unknown."""
    return F.col("numdocksavailable") == 0


def is_empty() -> Column:
    """True when no bike is available; null when the bike count is unknown."""
    return F.col("numbikesavailable") == 0


def is_active() -> Column:
    return (F.col("is_installed") == "OUI") & (F.col("is_renting") == "OUI")


def type_dominant() -> Column:
    """Which bike type prevails; ties and unknown counts are `egal`."""
    ebike, mechanical = F.col("ebike"), F.col("mechanical")
    return (
        F.when(ebike > mechanical, "electrique")
        .when(ebike < mechanical, "mecanique")
        .otherwise("egal")
    )


def area_or_default(column: str = "arrondissement") -> Column:
    return F.coalesce(F.col(column), F.lit(UNKNOWN_AREA))


def _rgba(colour: tuple[int, ...]) -> Column:
    return F.array(*[F.lit(c) for c in colour])


def station_color(df: DataFrame) -> Column:
    """Marker colour; full wins over empty, and unknown counts fall through.

    Without both count columns every station gets the default colour.
    """
    if not {"numdocksavailable", "numbikesavailable"} <= set(df.columns):
        return _rgba(GREEN)
    return (
        F.when(is_full(), _rgba(RED))
        .when(is_empty(), _rgba(BLUE))
        .when(F.col("numdocksavailable") <= LOW_DOCKS, _rgba(ORANGE))
        .otherwise(_rgba(GREEN))
    )


def station_tooltip(df: DataFrame) -> Column:
    """HTML tooltip; unknown values show as empty text.

    Without all four source columns the tooltip is an empty string.
    """
    # Label text and the column shown behind it.
    parts = [
        ("<b>", "name", "</b>"),
        ("<br/>Vélos dispo : ", "numbikesavailable", ""),
        ("<br/>Bornes libres : ", "numdocksavailable", ""),
        ("<br/>Arrondissement : ", "arrondissement", ""),
    ]
    if not {name for _, name, _ in parts} <= set(df.columns):
        return F.lit("")
    pieces = []
    for before, name, after in parts:
        pieces += [F.lit(before), F.coalesce(F.col(name).cast("string"), F.lit("")), F.lit(after)]
    return F.concat(*pieces)
