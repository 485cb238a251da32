"""Distance to stations and the nearest station.

For many points the stations form a tree of square cells: each cell that holds
more than LEAF_SIZE places is cut into 8 x 8 smaller ones, and knows the box
around its places and the outermost of them. A point first looks up the cells
it lies in or next to, which bounds the distance to its nearest place. Then
all points walk down the tree together, one equi-join per level and one row
per point and cell, into the cells within that bound. At the end each point
opens its most promising small cell, and then only those that may still hold a
nearer place. The bounds are as tight far away as nearby, so the work per point
depends on the depth of the tree, not on how many stations share a cell or how
far away they are, and no step pairs all points of a cell with all of its
stations. The result is exact.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dockline.functions.geo import box_bounds, geodesic_m, point_columns, reach_degrees, sphere_ceiling_m
from dockline.session import materialize

LEAF_SIZE = 64
GRID_BITS = 30
LEVEL_BITS = 3
MAX_LEVEL = GRID_BITS // LEVEL_BITS
GRID_MAX = (1 << GRID_BITS) - 1
OUTERMOST = (("min", "u"), ("max", "u"), ("min", "lam"), ("max", "lam"))
MEMBERS = tuple(f"{end}_{axis}" for end, axis in OUTERMOST)
BOX = ("u_min", "u_max", "lon_min", "lon_max", *MEMBERS)
BEST = ("distance_m", "stationcode", "name", "lat", "lon")


def with_distance(stations: DataFrame, ulat: float, ulon: float) -> DataFrame:
    """Distance in metres from one point to every station."""
    return stations.withColumn(
        "distance_m", geodesic_m(F.lit(float(ulat)), F.lit(float(ulon)), F.col("lat"), F.col("lon"))
    )


def nearest_to_point(stations: DataFrame, ulat: float, ulon: float) -> DataFrame:
    """The nearest station to one point; ties go to the lowest code.

    Stations without coordinates have no distance and cannot win.
    """
    best = F.min(F.struct(*BEST)).alias("best")
    return (
        _located(with_distance(stations, ulat, ulon), "lat", "lon").agg(best)
        .where(F.col("best").isNotNull()).select("best.*")
    )


def _located(df: DataFrame, lat: str, lon: str) -> DataFrame:
    known = [F.col(c).isNotNull() & ~F.isnan(c) for c in (lat, lon)]
    return df.where(known[0] & known[1])


def nearest_station(points: DataFrame, stations: DataFrame, leaf_size: int = LEAF_SIZE) -> DataFrame:
    """Each point (`ulat`, `ulon`) with its nearest station; ties go to the lowest code.

    Points without coordinates are dropped, and stations without them cannot
    win. Stations at the same place are reduced to the lowest code and points
    at the same place to one before the search.
    """
    places = (
        _located(stations, "lat", "lon").groupBy("lat", "lon")
        .agg(F.min(F.struct("stationcode", "name")).alias("s"))
        .select("lat", "lon", "s.stationcode", "s.name")
    )
    places = materialize(places, "places")
    spots = _located(points, "ulat", "ulon").select("ulat", "ulon").distinct()
    tree = _build_tree(places, leaf_size)
    if tree is None:
        types = ("double", "string", "string", "double", "double")
        best = spots.limit(0).withColumns({c: F.lit(None).cast(t) for c, t in zip(BEST, types)})
    else:
        best = _nearest_of(_compared(_walk(spots, tree), tree))
    return points.join(best, ["ulat", "ulon"])


# -- the tree ---------------------------------------------------------------


@dataclass
class _Tree:
    places: DataFrame
    levels: list[DataFrame]
    lat: tuple[float, float]
    lon: tuple[float, float]

    def grid(self, axis: str, degrees: str) -> str:
        """SQL for the grid position of a coordinate, one beyond the grid if outside."""
        start, end = getattr(self, axis)
        scale = GRID_MAX / (end - start) if end > start else 0.0
        return f"floor(least(greatest(({degrees} - {start}D) * {scale}D, -1D), {GRID_MAX + 1}D))"


def _cell(level: int, x: str = "gx", y: str = "gy") -> str:
    """SQL for the number of the cell at a level that holds a grid position."""
    shift = GRID_BITS - LEVEL_BITS * level
    return _pair(f"shiftright({x}, {shift})", f"shiftright({y}, {shift})")


def _pair(x: str, y: str) -> str:
    # Functions, as the parser takes >> after an array( for the end of a type.
    return f"(shiftleft({x}, {GRID_BITS}) | {y})"


def _build_tree(places: DataFrame, leaf_size: int) -> _Tree | None:
    """One table of cells per level; a level holds the children of crowded cells.

    The driver sees one row of bounds, and per level whether it still has
    crowded cells.
    """
    bounds = places.selectExpr("min(lat)", "max(lat)", "min(lon)", "max(lon)").first()
    if bounds[0] is None:
        return None
    tree = _Tree(places, [], tuple(bounds[:2]), tuple(bounds[2:]))
    tree.places = places.selectExpr("*", f"{tree.grid('lon', 'lon')} gx", f"{tree.grid('lat', 'lat')} gy")
    remaining = tree.places
    for level in range(1, MAX_LEVEL + 1):
        placed = remaining.selectExpr(f"{_cell(level)} cell", *point_columns("lat", "lon"))
        cells = placed.groupBy("cell").agg(
            (F.expr(f"count(*) <= {leaf_size}") | F.lit(level == MAX_LEVEL)).alias("leaf"),
            F.expr("min(u) u_min"), F.expr("max(u) u_max"), F.expr("min(lam) lon_min"), F.expr("max(lam) lon_max"),
            # The outermost places of the cell.
            *(F.expr(f"{end}_by(struct(u, sin_u, cos_u, lam), {axis}) {end}_{axis}") for end, axis in OUTERMOST),
        )
        cells = materialize(cells, f"cells-{level}")
        tree.levels.append(cells)
        crowded = cells.where("not leaf").select("cell")
        if crowded.isEmpty():
            break
        remaining = (
            tree.places.withColumn("cell", F.expr(_cell(level)))
            .join(crowded, "cell", "left_semi").drop("cell")
        )
    return tree


# -- the search -------------------------------------------------------------

POINT = point_columns("ulat", "ulon")


def _walk(spots: DataFrame, tree: _Tree) -> DataFrame:
    """Rows of a point and a small cell that may hold its nearest place.

    `reach` bounds the distance to the nearest place, `floor` that to any place
    of the cell, and `nr` numbers the cells of a point by it.
    """
    state = _first_reach(spots, tree).selectExpr(
        "ulat", "ulon", "reach", "0L cell", "cast(null as int) leaf_level", "0D floor")
    for level in range(1, len(tree.levels) + 1):
        # Written per level, so that neither the plan nor what a lost executor
        # costs grows with the depth.
        state = materialize(_descend(state, tree, level), f"points-{level}")
    return state


def _first_reach(spots: DataFrame, tree: _Tree) -> DataFrame:
    """Bound the distance to the nearest place by the outermost places of the
    top cells and of each deeper cell that holds the point, or lies at the
    border next to it."""
    # A single row with at most 64 cells.
    top = tree.levels[0].groupBy(F.lit(0).alias("root")).agg(F.collect_list(F.struct(*MEMBERS)).alias("cells"))
    angles = spots.selectExpr("ulat", "ulon", *POINT)
    seen = angles.withColumn("root", F.lit(0)).join(F.broadcast(top), "root").selectExpr(*angles.columns, "inline(cells)")
    if len(tree.levels) > 1:
        inside = [
            f"greatest(least({tree.grid(axis, f'u{axis}')}, {GRID_MAX}), 0)" for axis in ("lon", "lat")
        ]
        own = ", ".join(
            f"named_struct('level', {level}, 'cell', {_cell(level)})"
            for level in range(2, len(tree.levels) + 1)
        )
        deeper = None
        for level, cells in enumerate(tree.levels[1:], start=2):
            part = cells.select(F.lit(level).alias("level"), "cell", *MEMBERS)
            deeper = part if deeper is None else deeper.unionByName(part)
        path = angles.selectExpr("*", f"{inside[0]} gx", f"{inside[1]} gy").selectExpr(
            *angles.columns, f"inline(array({own}))"
        )
        seen = seen.unionByName(path.join(deeper, ["level", "cell"]).select(*angles.columns, *MEMBERS))
    seen = seen.select("ulat", "ulon", F.expr(sphere_ceiling_m(MEMBERS)).alias("reach"))
    return seen.groupBy("ulat", "ulon").agg(F.min("reach").alias("reach"))


def _children_in_reach(tree: _Tree, level: int) -> str:
    """SQL for the numbers of the children of `parent` that the reach of a point
    touches, from its grid range `y` and its grid ranges `xs`."""
    shift, side = GRID_BITS - LEVEL_BITS * level, 1 << LEVEL_BITS

    def within(span: str, parent: str) -> str:
        first = f"shiftleft({parent}, {LEVEL_BITS})"
        low = f"greatest(shiftright({span}.low, {shift}), {first})"
        high = f"least(shiftright({span}.high, {shift}), {first} + {side - 1})"
        return f"if({low} <= {high}, sequence({low}, {high}), array())"

    xs = within("r", f"shiftright(parent, {GRID_BITS})")
    ys = within("y", f"parent & {GRID_MAX}")
    return f"""array_distinct(flatten(transform(xs, r -> flatten(
        transform({xs}, a -> transform({ys}, b -> {_pair("a", "b")}))))))"""


def _descend(state: DataFrame, tree: _Tree, level: int) -> DataFrame:
    """Replace each open cell by those of its children that are in reach."""
    dlat, dlon = reach_degrees("reach", "cos(radians(ulat))")

    def span(axis: str, centre: str, width: str) -> str:
        # One grid step more on either side for rounding.
        low = f"greatest({tree.grid(axis, f'{centre} - {width}')} - 1, 0)"
        high = f"least({tree.grid(axis, f'{centre} + {width}')} + 1, {GRID_MAX})"
        return f"named_struct('low', {low}, 'high', {high})"

    # East and west may reach around the earth.
    around = f"""filter(transform(array(-360D, 0D, 360D), turn -> {span('lon', 'ulon + turn', 'dlon')}),
        r -> r.low <= r.high)"""
    everywhere = f"array(named_struct('low', 0L, 'high', {GRID_MAX}L))"
    opened = (
        state.where("leaf_level is null").selectExpr("ulat", "ulon", "reach", "cell parent", f"{dlat} dlat", f"{dlon} dlon")
        .selectExpr(
            "ulat", "ulon", "reach", "parent", f"{span('lat', 'ulat', 'dlat')} y",
            f"if(dlon >= 180, {everywhere}, {around}) xs",
        )
        .selectExpr("ulat", "ulon", "reach", f"explode({_children_in_reach(tree, level)}) cell")
    )
    joined = opened.join(tree.levels[level - 1], "cell").selectExpr("ulat", "ulon", "reach", "cell", "leaf", *BOX, *POINT)
    seen = box_bounds(joined, ["ulat", "ulon", "reach", "cell", "leaf"], MEMBERS).where("floor <= reach").selectExpr(
        "ulat", "ulon", "least(reach, ceiling) reach", "cell", f"if(leaf, {level}, null) leaf_level", "floor")
    own = Window.partitionBy("ulat", "ulon")
    return seen.unionByName(state.where("leaf_level is not null").select(*seen.columns)).withColumns({
        "nr": F.row_number().over(own.orderBy("floor", "leaf_level", "cell")),
        "reach": F.min("reach").over(own),
    }).where("floor <= reach")


def _compared(state: DataFrame, tree: _Tree) -> DataFrame:
    """Distances of each point to the places of its best cell, then of those cells that may hold a nearer one."""
    members = None
    for level, cells in enumerate(tree.levels, start=1):
        in_leaf = (
            tree.places.withColumn("cell", F.expr(_cell(level)))
            .join(cells.where("leaf").select("cell"), "cell", "left_semi")
            .select(F.lit(level).alias("leaf_level"), "cell", "stationcode", "name", "lat", "lon")
        )
        members = in_leaf if members is None else members.unionByName(in_leaf)
    distance = geodesic_m(F.col("ulat"), F.col("ulon"), F.col("lat"), F.col("lon"))

    def measured(rows: DataFrame) -> DataFrame:
        return rows.join(members, ["leaf_level", "cell"]).select(
            "ulat", "ulon", *(distance.alias(c) if c == "distance_m" else c for c in BEST))

    first = materialize(_nearest_of(measured(state.where("nr = 1"))), "points-first")
    known = first.select("ulat", "ulon", F.col("distance_m").alias("known"))
    rest = state.where("nr > 1").join(known, ["ulat", "ulon"]).where("floor <= known")
    return first.unionByName(measured(rest))


def _nearest_of(compared: DataFrame) -> DataFrame:
    best = F.min(F.struct(*BEST)).alias("best")
    return compared.groupBy("ulat", "ulon").agg(best).select("ulat", "ulon", "best.*")
