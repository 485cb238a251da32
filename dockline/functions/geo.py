"""Geodesic distance on the WGS-84 ellipsoid as native column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# WGS-84 equatorial radius in metres and flattening.
EQUATOR_M = 6378137.0
FLATTENING = 1 / 298.257223563

# Smallest radius of curvature of the ellipsoid, along a meridian at the
# equator. No distance is below that on a sphere of this radius, latitudes
# taken as they are.
MIN_CURVATURE_M = EQUATOR_M * (1 - FLATTENING) ** 2

# Slack of reach_degrees for the error of geodesic_m, relative and in metres.
# Near the antipode it stops relying on it: from FLOOR_ANGLE on anything is in reach.
BOUND_SLACK, BOUND_SLACK_M = 1e-4, 1e-3
FLOOR_ANGLE = 2.8

# Slack of the bounds of box_bounds for rounding, in metres and relative.
ROUNDING_M, ROUNDING = 1e-3, 1e-9

# How fast the flattening term of geodesic_m changes with the second point, per
# radian, up to the given angle. The steepest found are 2.52 and 5.45; beyond
# the last angle the term is only known to be at most twice the angle.
SLOPES = ((2.3, 3.0), (2.7, 6.0))


def geodesic_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Andoyer-Lambert distance in metres between two points in degrees.

    Closed form. The relative error is about 1.4e-6 up to a quarter of the way
    round the earth and 5e-5 at 172 degrees. Towards the antipode the formula
    breaks down; there the correction is held within its exact bounds, which
    leaves an error of at most 0.34 %.
    """
    u1 = F.atan(F.tan(F.radians(lat1)) * (1 - FLATTENING))
    u2 = F.atan(F.tan(F.radians(lat2)) * (1 - FLATTENING))
    p, q = (u1 + u2) / 2, (u2 - u1) / 2
    sin_q = F.sin(q)
    sin_dlon = F.sin((F.radians(lon2) - F.radians(lon1)) / 2)
    # h = sin^2(sigma / 2)
    h = F.least(sin_q * sin_q + F.cos(u1) * F.cos(u2) * sin_dlon * sin_dlon, F.lit(1.0))
    sigma = F.asin(F.sqrt(h)) * 2
    sin_sigma = F.sqrt(h * (1 - h)) * 2
    x_angle = F.sin(p) * F.cos(q)
    y_angle = F.cos(p) * sin_q
    x = (sigma - sin_sigma) * (x_angle * x_angle) / (1 - h)
    y = (sigma + sin_sigma) * (y_angle * y_angle) / h
    # The distance lies between those on spheres of the polar and the
    # equatorial radius, taken at reduced latitudes.
    correction = F.least(F.greatest((x + y) * (FLATTENING / 2), F.lit(0.0)), sigma * FLATTENING)
    return (
        F.when(h == 0, F.lit(0.0))
        .when(h == 1, sigma * EQUATOR_M)
        .otherwise((sigma - correction) * EQUATOR_M)
    )


def reduced(lat: str) -> str:
    """SQL for the reduced latitude, in radians, of a latitude in degrees."""
    return f"atan(tan(radians({lat})) * {1 - FLATTENING}D)"


# Columns that box_bounds takes: a point as reduced latitude with its sine and
# cosine and longitude, all in radians.
POINT = (("u", "{u}"), ("sin_u", "sin({u})"), ("cos_u", "cos({u})"), ("lam", "radians({lon})"))


def point_columns(lat: str, lon: str) -> list[str]:
    """SQL for the columns of a point that box_bounds takes, from degrees."""
    return [f"{sql.format(u=reduced(lat), lon=lon)} {name}" for name, sql in POINT]


def _half_angle(u: str, cos_u: str, dlon: str) -> str:
    """SQL for the squared sine of half the angle between the point and another."""
    return f"least(pow(sin(({u} - u) / 2), 2) + cos_u * {cos_u} * pow(sin(({dlon}) / 2), 2), 1D)"


def sphere_ceiling_m(members: Sequence[str]) -> str:
    """SQL for a distance that geodesic_m from the point to the nearest member does not exceed.

    Takes the columns of box_bounds; up to a 298th part too great, but cheap:
    flattening only shortens distances on the sphere of reduced latitudes.
    """
    nearest = ", ".join(_half_angle(f"{m}.u", f"{m}.cos_u", f"{m}.lam - lam") for m in members)
    return f"2 * asin(sqrt(least({nearest}))) * {EQUATOR_M * (1 + ROUNDING)}D + {ROUNDING_M}D"


def box_bounds(df: DataFrame, keep: Sequence[str], members: Sequence[str]) -> DataFrame:
    """Columns `keep`, and bounds on geodesic_m from the point to the nearest place in a box.

    The point is given by the columns of point_columns, the box by u_min,
    u_max, lon_min and lon_max, and `members` name structs of some places of
    the box (u, sin_u, cos_u, lam); all angles are in radians and latitudes
    reduced. `ceiling` is the distance to the nearest member. For `floor`, the
    angle to the box on the sphere of reduced latitudes is exact: its nearest
    point lies on the nearer bounding meridian, at the foot of the
    perpendicular or at a corner, or straight north or south. The flattening
    term of geodesic_m changes little within a small box, so it is the
    members' term and what the size of the box may add to it.
    """
    turn = "(2 * pi())"
    gap = (
        f"if(pmod(lam - lon_min, {turn}) <= lon_max - lon_min, 0D, "
        f"least(pmod(lon_min - lam, {turn}), pmod(lam - lon_max, {turn})))"
    )
    size = "u_max - u_min + (lon_max - lon_min) * if(u_min <= 0 and u_max >= 0, 1D, greatest(cos(u_min), cos(u_max)))"

    step = df.selectExpr(
        *keep, *members, "u", "sin_u", "cos_u", "u_min", "u_max", f"{gap} _gap", f"{size} _size",
        *(f"{_half_angle(f'{m}.u', f'{m}.cos_u', f'{m}.lam - lam')} _h_{m}" for m in members),
    ).selectExpr(
        "*", "greatest(least(atan2(sin_u, cos_u * cos(_gap)), u_max), u_min) _foot",
        *(f"2 * asin(sqrt(_h_{m})) _a_{m}" for m in members),
    )
    nearest = ", ".join(_half_angle(v, f"cos({v})", "_gap") for v in ("u_min", "u_max", "_foot"))
    terms = []
    for m in members:
        h, angle, chord = f"_h_{m}", f"_a_{m}", f"2 * sqrt(_h_{m} * (1 - _h_{m}))"
        x = f"if({h} = 1, 0D, ({angle} - {chord}) * pow((sin_u + {m}.sin_u) / 2, 2) / (1 - {h}))"
        y = f"if({h} = 0, 0D, ({angle} + {chord}) * pow(({m}.sin_u - sin_u) / 2, 2) / {h})"
        # near the antipode the term is mostly rounding; without it the distance is greatest
        terms.append(f"if({angle} > {SLOPES[-1][0]}D, 0D, greatest(least({x} + {y}, 2 * {angle}), 0D)) _g_{m}")
    step = step.selectExpr("*", f"2 * asin(sqrt(least({nearest}))) _angle", *terms)
    distances = ", ".join(f"_a_{m} - _g_{m} * {FLATTENING / 2}D" for m in members)
    first = members[0]
    known = " ".join(f"when _a_{first} + _size <= {limit}D then least(2 * _angle, _g_{first} + {slope}D * _size)" for limit, slope in SLOPES)
    low = f"_angle - {FLATTENING / 2}D * case {known} else 2 * _angle end"
    # A filter on the bounds stays above the generator; pushed through the steps it would repeat all of them.
    return step.selectExpr(*keep, f"""inline(array(named_struct(
        'floor', ({low}) * {EQUATOR_M * (1 - ROUNDING)}D - {ROUNDING_M}D,
        'ceiling', least({distances}) * {EQUATOR_M * (1 + ROUNDING)}D + {ROUNDING_M}D)))""")


def reach_degrees(metres: str, cos_lat: str) -> tuple[str, str]:
    """SQL for the gaps in latitude and longitude, in degrees, beyond which
    geodesic_m exceeds the given metres. 180 or more means anywhere.

    On the sphere of the smallest curvature radius, the gap in latitude and
    the distance to the nearer meridian each bound the angle from below.
    """
    angle = f"(({metres} + {BOUND_SLACK_M}D) / {MIN_CURVATURE_M * (1 - BOUND_SLACK)}D * {1 + 1e-9}D)"
    sine = f"sin(least({angle}, pi() / 2))"
    dlat = f"if({angle} >= {FLOOR_ANGLE}D, 360D, degrees({angle}))"
    dlon = f"if({sine} >= {cos_lat}, 360D, degrees(asin({sine} / {cos_lat})))"
    return dlat, dlon


def route_geometry(ulat: Column, ulon: Column, lat: Column, lon: Column) -> Column:
    """Straight route as [[lon, lat], [lon, lat]], user first."""
    return F.array(F.array(ulon, ulat), F.array(lon, lat))
