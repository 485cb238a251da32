import math
import random

import pytest
from pyspark.sql import functions as F

from dockline.functions import geo
from dockline.operators import geocode, nearest

STATIONS = "stationcode string, name string, lat double, lon double"
POINTS = "user_id int, ulat double, ulon double"


def vincenty(lat1, lon1, lat2, lon2):
    """Independent reference: Vincenty's inverse iteration on WGS-84."""
    a, f = 6378137.0, 1 / 298.257223563
    b = a * (1 - f)
    u1, u2 = (math.atan((1 - f) * math.tan(math.radians(x))) for x in (lat1, lat2))
    big_l = lam = math.radians(lon2 - lon1)
    for _ in range(200):
        x = math.cos(u2) * math.sin(lam)
        y = math.cos(u1) * math.sin(u2) - math.sin(u1) * math.cos(u2) * math.cos(lam)
        sin_s = math.hypot(x, y)
        if sin_s == 0:
            return 0.0
        cos_s = math.sin(u1) * math.sin(u2) + math.cos(u1) * math.cos(u2) * math.cos(lam)
        s = math.atan2(sin_s, cos_s)
        sin_a = math.cos(u1) * math.cos(u2) * math.sin(lam) / sin_s
        cos2_a = 1 - sin_a ** 2
        cos_2m = cos_s - 2 * math.sin(u1) * math.sin(u2) / cos2_a if cos2_a else 0.0
        c = f / 16 * cos2_a * (4 + f * (4 - 3 * cos2_a))
        last, lam = lam, big_l + (1 - c) * f * sin_a * (
            s + c * sin_s * (cos_2m + c * cos_s * (2 * cos_2m ** 2 - 1)))
        if abs(lam - last) < 1e-13:
            break
    k = cos2_a * (a * a - b * b) / (b * b)
    big_a = 1 + k / 16384 * (4096 + k * (-768 + k * (320 - 175 * k)))
    big_b = k / 1024 * (256 + k * (-128 + k * (74 - 47 * k)))
    d = big_b * sin_s * (cos_2m + big_b / 4 * (cos_s * (2 * cos_2m ** 2 - 1) - big_b / 6 * cos_2m
                         * (4 * sin_s ** 2 - 3) * (4 * cos_2m ** 2 - 3)))
    return b * big_a * (s - d)


def random_pairs(n, seed, spread):
    rng = random.Random(seed)
    for _ in range(n):
        lat, lon = rng.uniform(-85, 85), rng.uniform(-180, 180)
        yield lat, lon, max(-89.0, min(89.0, lat + rng.uniform(-spread, spread))), lon + rng.uniform(-spread, spread)


def antipodes(n, seed):
    """Pairs at and around the antipode."""
    rng = random.Random(seed)
    pairs = [(0.0, 0.0, 0.0, 180.0), (90.0, 0.0, -90.0, 0.0), (45.0, 10.0, -45.0, -170.0)]
    for _ in range(n):
        lat, lon, off = rng.uniform(-89, 89), rng.uniform(-180, 180), 10 ** rng.uniform(-6, 1.2)
        pairs.append((lat, lon, max(-90.0, min(90.0, -lat + rng.uniform(-off, off))), lon + 180 + rng.uniform(-off, off)))
    return pairs


@pytest.mark.parametrize("spread, tolerance", [(0.3, 2e-6), (40, 2e-5)])
def test_distance_against_vincenty(spark, spread, tolerance):
    pairs = list(random_pairs(2000, 1, spread))
    df = spark.createDataFrame(pairs, "a double, b double, c double, d double")
    got = df.select("*", geo.geodesic_m(*map(F.col, "abcd")).alias("m")).collect()
    for r in got:
        want = vincenty(r.a, r.b, r.c, r.d)
        assert r.m == pytest.approx(want, rel=tolerance, abs=1e-3)


def test_same_point_is_zero(spark):
    row = spark.range(1).select(geo.geodesic_m(*[F.lit(x) for x in (48.5, 2.5, 48.5, 2.5)])).first()
    assert row[0] == 0.0


def test_bounds_hold(spark):
    """Boxes of metres to degrees around places near and far, at the date line and at the antipode."""
    rng = random.Random(2)
    pairs = list(random_pairs(3000, 2, 1)) + list(random_pairs(3000, 3, 120)) + [
        (48.871, 2.351, 48.870999999999995, 2.351), (10.0, 179.999, 10.0, -179.999), (0.0, 0.0, 0.0, 0.0),
    ] + antipodes(2000, 6)
    rows = []
    for n, (a, b, c, d) in enumerate(pairs):
        size = 10 ** rng.uniform(-5, 1)
        places = [(max(-90.0, min(90.0, c + rng.uniform(0, size))), d + rng.uniform(0, size)) for _ in range(5)]
        rows += [(n, a, b, *p) for p in places]
    df = spark.createDataFrame(rows, "n int, ulat double, ulon double, lat double, lon double")
    struct = "struct(" + ", ".join(x.rsplit(" ", 1)[0] + " as " + x.rsplit(" ", 1)[1] for x in geo.point_columns("lat", "lon")) + ")"
    placed = df.withColumn("m", geo.geodesic_m(*map(F.col, ("ulat", "ulon", "lat", "lon")))).selectExpr("*", f"{struct} p")
    boxes = placed.groupBy("n", "ulat", "ulon").agg(
        F.expr("min(m) m"), F.expr("min(p.u) u_min"), F.expr("max(p.u) u_max"), F.expr("min(p.lam) lon_min"),
        F.expr("max(p.lam) lon_max"), F.expr("min_by(p, lat) one"), F.expr("max_by(p, lon) two"),
        F.expr("max(lat) - min(lat) + max(lon) - min(lon) size"))
    got = geo.box_bounds(boxes.selectExpr("*", *geo.point_columns("ulat", "ulon")), ["m", "size"], ["one", "two"]).collect()
    assert len(got) == len(pairs)
    for r in got:
        assert r.floor <= r.m <= r.ceiling, r
        # as tight as the box is small, far away too
        assert r.m > 1.4e7 or r.ceiling - r.floor <= 1.6e5 * r["size"] + 0.1, r


def brute(points, stations):
    """All pairs on the driver, with the library's own distance."""
    pairs = points.crossJoin(stations).withColumn(
        "distance_m", geo.geodesic_m(*[F.col(c) for c in ("ulat", "ulon", "lat", "lon")])
    ).where("distance_m is not null and not isnan(distance_m)")
    best = {}
    for r in pairs.collect():
        key = (r.distance_m, r.stationcode)
        best[r.user_id] = min(best.get(r.user_id, key), key)
    return best


def check(points, stations, leaf_size):
    got = nearest.nearest_station(points, stations, leaf_size).collect()
    assert {r.user_id: (r.distance_m, r.stationcode) for r in got} == brute(points, stations)
    return got


def make(spark, stations, points):
    return (
        spark.createDataFrame([(f"{i:05d}", f"s{i}", *p) for i, p in enumerate(stations)], STATIONS),
        spark.createDataFrame([(i, *p) for i, p in enumerate(points)], POINTS),
    )


@pytest.mark.parametrize("leaf_size", [2, 64, 10_000])
def test_city(spark, leaf_size):
    rng = random.Random(4)
    stations = [(rng.uniform(48.8, 48.9), rng.uniform(2.25, 2.42)) for _ in range(800)]
    points = [(rng.uniform(48.7, 49.0), rng.uniform(2.1, 2.6)) for _ in range(120)] + stations[:10]
    s, p = make(spark, stations, points)
    check(p, s, leaf_size)


def test_crowded_cell_and_repeated_places(spark):
    """A third of the stations within metres, a third at one place, the rest world-wide."""
    rng = random.Random(5)
    crowd = [(48.85 + rng.uniform(0, 3e-5), 2.35 + rng.uniform(0, 3e-5)) for _ in range(300)]
    same = [(48.86, 2.36)] * 300
    world = [(rng.uniform(-80, 80), rng.uniform(-180, 180)) for _ in range(300)]
    points = (
        [(48.85 + rng.uniform(-1e-4, 1e-4), 2.35 + rng.uniform(-1e-4, 1e-4)) for _ in range(60)]
        + [(48.86, 2.36)] * 30
        + [(rng.uniform(-85, 85), rng.uniform(-180, 180)) for _ in range(60)]
    )
    s, p = make(spark, crowd + same + world, points)
    check(p, s, 8)


def test_points_at_the_other_end_of_the_earth(spark):
    rng = random.Random(7)
    stations = [(48.8 + rng.uniform(0, 0.2), 2.3 + rng.uniform(0, 0.2)) for _ in range(200)]
    points = [(-48.9 + rng.uniform(-d, d), -177.6 + rng.uniform(-d, d)) for d in (0.01, 0.3, 5, 30) for _ in range(20)]
    s, p = make(spark, stations, points)
    check(p, s, 4)


@pytest.mark.parametrize("shift", [(0.35, 0.45), (9.0, 0.0), (-48.85, -2.35), (-60.0, 100.0)])
def test_far_points_are_compared_with_few_stations(spark, shift):
    """Diagonally off the area, 1,000 km away, near 0/0 and further: a fraction of 4,000 stations is compared."""
    rng = random.Random(8)
    stations = [(48.8 + rng.uniform(0, 0.1), 2.25 + rng.uniform(0, 0.17)) for _ in range(4000)]
    points = [(48.85 + shift[0] + rng.uniform(0, 0.05), 2.33 + shift[1] + rng.uniform(0, 0.05)) for _ in range(30)]
    s, p = make(spark, stations, points)
    check(p, s, 64)
    places = s.select("lat", "lon", "stationcode", "name")
    tree = nearest._build_tree(places, 64)
    compared = nearest._compared(nearest._walk(p.select("ulat", "ulon"), tree), tree)
    assert max(r["count"] for r in compared.groupBy("ulat", "ulon").count().collect()) < 300


def test_date_line(spark):
    stations = [(10.0, 179.9), (10.0, -179.95), (10.0, 0.0), (12.0, 170.0), (-5.0, -170.0)]
    s, p = make(spark, stations, [(10.0, 179.99), (10.0, -179.8), (0.0, 179.0), (11.0, 181.0)])
    check(p, s, 1)


def test_ties_and_unknown_coordinates(spark):
    s = spark.createDataFrame([
        ("9", "late", 48.0, 2.0), ("10", "same place, lower code", 48.0, 2.0),
        ("1", "no place", None, 2.0), ("2", "nan", float("nan"), 2.0),
    ], STATIONS)
    p = spark.createDataFrame([(1, 48.1, 2.1), (2, None, 2.0), (3, 48.1, 2.1)], POINTS)
    got = nearest.nearest_station(p, s).collect()
    assert {(r.user_id, r.stationcode, r.name) for r in got} == {
        (1, "10", "same place, lower code"), (3, "10", "same place, lower code")
    }
    one = nearest.nearest_to_point(s, 48.1, 2.1).collect()
    assert [r.stationcode for r in one] == ["10"]


def test_no_stations(spark):
    s, p = spark.createDataFrame([], STATIONS), spark.createDataFrame([(1, 48.0, 2.0)], POINTS)
    assert nearest.nearest_station(p, s).collect() == []
    assert nearest.nearest_to_point(s, 48.0, 2.0).collect() == []


def test_geocode(spark):
    gazetteer = spark.createDataFrame([
        (2, "11 rue Réaumur, Paris", 48.0, 2.0), (1, " 11  RUE réaumur, paris ", 49.0, 3.0),
        (0, "11 rue Réaumur, Paris", None, 3.0), (0, None, 1.0, 1.0),
    ], "rank int, address string, lat double, lon double")
    searches = spark.createDataFrame(
        [(1, "11 RUE RÉAUMUR,\tParis"), (2, "nowhere"), (3, None)], "user_id int, address string")
    got = geocode.geocode(searches, gazetteer, "rank").collect()
    assert [(r.user_id, r.ulat, r.ulon) for r in got] == [(1, 49.0, 3.0)]
    got = geocode.geocode(searches, gazetteer).collect()
    assert [(r.user_id, r.ulat, r.ulon) for r in got] == [(1, 48.0, 2.0)]
