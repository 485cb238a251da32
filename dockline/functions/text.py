"""Text shown to the user."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _text(column: Column) -> Column:
    return column.cast("string")


def _degrees(column: Column) -> Column:
    """A coordinate in plain decimals; near 0 a cast to string has an exponent."""
    small = F.rtrim(column.cast("decimal(38,15)").cast("string"), F.lit("0"))
    return F.when(_text(column).contains("E"), small).otherwise(_text(column))


def directions_url(ulat: Column, ulon: Column, lat: Column, lon: Column) -> Column:
    """Link to directions from the user's point to the station."""
    # Fixed value: the address that the board links to.
    return F.concat(
        F.lit("https://www.google.com/maps/dir/"),
        _degrees(ulat), F.lit(","), _degrees(ulon), F.lit("/"), _degrees(lat), F.lit(","), _degrees(lon),
    )


def nearest_label(name: Column, distance: Column) -> Column:
    """Message naming the nearest station, by nothing if it has no name; metres are cut, not rounded."""
    return F.concat(
        F.lit("Station la plus proche : "), F.coalesce(name, F.lit("")), F.lit(" à "),
        _text(distance.cast("long")), F.lit(" m"),
    )


def percent_text(value: Column) -> Column:
    """A percentage in [0, 100] with one decimal and a % sign.

    Rounds the exact binary value, ties to even. format_string and bround
    round the shortest decimal form instead and turn 9.45, whose binary value
    lies below the tie, into 9.5 or 9.4 by the digit alone.
    """
    # value * 2^46 splits into a whole part and an exact remainder, so the
    # comparison with the tie runs in integers.
    unit = 1 << 46
    scaled = value.cast("double") * F.lit(float(unit))
    whole = F.floor(scaled)
    tenths = F.shiftright(whole * 10, 46)
    above_tie = (
        (whole * 10 - F.shiftleft(tenths, 46) - (unit >> 1)).cast("double")
        + (scaled - whole.cast("double")) * 10.0
    )
    rounded = (
        F.when(above_tie > 0, tenths + 1)
        .when(above_tie < 0, tenths)
        .otherwise(tenths + F.pmod(tenths, F.lit(2)))
    )
    return F.format_string("%d.%d%%", F.floor(rounded / 10), F.pmod(rounded, F.lit(10)))


def clock_text(ts: Column) -> Column:
    return F.date_format(ts, "dd/MM/yyyy HH:mm:ss")
