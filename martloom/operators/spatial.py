"""Point-to-centre joins: degree box, and nearest centre."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.functions.geo import (
    EARTH_RADIUS_KM,
    chord_rank,
    degree_cell,
    haversine_km,
    unit_vector,
    usable_position,
)
from martloom.session import materialise

# Up to this many centres are listed by cell in a broadcast table; more are joined by grid cell.
LISTED_CENTRES = 200
# More centres stand in a tree of cells of 45 degrees, each cut into 4 x 4 as long as it holds more than a few, down to five metres.
_TREE_DEGREES, _TREE_LEVELS, _FEW_CENTRES = 45.0, 10, 16
# A cell's number: its level, row and column.
_LEVEL_STEP, _ROW_STEP = 1 << 46, 1 << 23
# Above the grain of ``chord_rank`` (1e-15 of a squared chord), so that equal ranks are never cut off.
_TIE = 1e-7


def box_join(
    points: DataFrame, centres: DataFrame, degrees: float, how: str = "inner", inclusive: bool = True,
    lat: str = "lat", lon: str = "lon", centre_lat: str = "c_lat", centre_lon: str = "c_lon",
) -> DataFrame:
    """Pairs whose latitudes and longitudes each differ by at most (or less than) ``degrees``.

    Each centre is listed in its own and the eight neighbouring grid cells, so the join is an
    equi-join on the cell with the exact test on top.
    """
    near = [F.lit(i).cast("long") for i in (-1, 0, 1)]
    listed = (
        centres.withColumn("_dy", F.explode(F.array(*near)))
        .withColumn("_dx", F.explode(F.array(*near)))
        .withColumn("_cy", degree_cell(F.col(centre_lat), degrees) + F.col("_dy"))
        .withColumn("_cx", degree_cell(F.col(centre_lon), degrees) + F.col("_dx"))
        .drop("_dy", "_dx")
    )
    placed = points.withColumn("_py", degree_cell(F.col(lat), degrees)).withColumn("_px", degree_cell(F.col(lon), degrees))
    d_lat, d_lon = F.abs(F.col(lat) - F.col(centre_lat)), F.abs(F.col(lon) - F.col(centre_lon))
    exact = (d_lat <= degrees) & (d_lon <= degrees) if inclusive else (d_lat < degrees) & (d_lon < degrees)
    same_cell = (F.col("_py") == F.col("_cy")) & (F.col("_px") == F.col("_cx"))
    return placed.join(listed, same_cell & exact, how).drop("_py", "_px", "_cy", "_cx")


def _in_box(lat: Column, lon: Column, c_lat: Column, c_lon: Column, degrees: float, inclusive: bool) -> Column:
    d_lat, d_lon = F.abs(lat - c_lat), F.abs(lon - c_lon)
    return (d_lat <= degrees) & (d_lon <= degrees) if inclusive else (d_lat < degrees) & (d_lon < degrees)


def nearest_centre(
    points: DataFrame,
    centres: DataFrame,
    centre_id: str,
    payload: list[str],
    box_degrees: float | None = None,
    inclusive: bool = True,
    keep_unmatched: bool = False,
    distance: str | None = None,
    lat: str = "lat",
    lon: str = "lon",
    centre_lat: str = "c_lat",
    centre_lon: str = "c_lon",
    list_limit: int = LISTED_CENTRES,
) -> DataFrame:
    """Each point with the ``payload`` columns of its nearest centre; equal distances go to the smaller id.

    ``box_degrees`` limits the search to a degree box. The number of centres is checked: up to
    ``list_limit`` of them become a broadcast table of grid cells with the few centres that can win
    there, so that a point costs one hash probe, stays in its partition and is never multiplied. More
    centres are met by distinct position, through degree cells or down a tree of the cells that hold centres, and the result is joined back to the
    points by position. Both give each point one row, whatever its other columns. Points without a usable position never match.
    """
    listed = centres.where(usable_position(F.col(centre_lat), F.col(centre_lon))).select(
        F.col(centre_id).alias("id"), F.col(centre_lat).cast("double").alias("lat"),
        F.col(centre_lon).cast("double").alias("lon"), *[F.col(p).alias(f"p_{p}") for p in payload],
    )
    listed = _with_vector(listed)
    place = F.col(lat), F.col(lon)
    if listed.limit(list_limit + 1).count() <= list_limit:
        if box_degrees is not None:
            cells = _box_cells(listed, box_degrees)
            cell = F.struct(degree_cell(place[0], box_degrees).alias("y"), degree_cell(place[1], box_degrees).alias("x"))
        else:
            cells = _sphere_cells(listed)
            cell = _lookup_cell(*place)
        # At most nine cells per listed centre, or the fixed number of cells of the sphere.
        x, y, z = unit_vector(*place)
        located = points.withColumns({"_cell": F.when(usable_position(*place), cell), "_x": x, "_y": y, "_z": z})
        probed = located.join(F.broadcast(cells), "_cell", "left")
        best = _nearest_of(F.col("_near"), place, box_degrees, inclusive)
        # A generator, so that the choice is computed once however often its fields are read.
        matched = probed.withColumn("_best", (F.explode_outer if keep_unmatched else F.explode)(best))
    else:
        usable = points.where(usable_position(*place)).select(lat, lon).distinct()
        if box_degrees is not None:
            chosen = _match_in_box(usable, listed, box_degrees, inclusive, lat, lon)
        else:
            chosen = _match_by_descent(usable, listed, lat, lon)
        chosen = chosen.select(lat, lon, F.struct(F.col("_c").alias("centre")).alias("_best"))
        matched = points.join(chosen, [lat, lon], "left" if keep_unmatched else "inner")
    extra = [haversine_km(*place, F.col("_best.centre.lat"), F.col("_best.centre.lon")).alias(distance)] if distance else []
    return matched.select(*points.columns, *[F.col(f"_best.centre.p_{p}").alias(p) for p in payload], *extra)


def _nearest_of(near: Column, place: tuple[Column, Column], box_degrees: float | None, inclusive: bool) -> Column:
    """Array with the nearest of the listed centres, empty when none qualifies."""
    if box_degrees is not None:
        near = F.filter(near, lambda c: _in_box(*place, c["lat"], c["lon"], box_degrees, inclusive))
    vector = F.col("_x"), F.col("_y"), F.col("_z")
    ranked = F.transform(
        near,
        lambda c: F.struct(
            chord_rank(vector, (c["x"], c["y"], c["z"])).alias("rank"), c["id"].alias("id"), c.alias("centre")
        ),
    )
    return F.filter(F.array(F.array_min(ranked)), lambda r: r.isNotNull())


def _with_vector(centres: DataFrame) -> DataFrame:
    x, y, z = unit_vector(F.col("lat"), F.col("lon"))
    return centres.withColumns({"x": x, "y": y, "z": z})


def _box_cells(listed: DataFrame, degrees: float) -> DataFrame:
    """Degree cells around the centres with the centres whose box can reach into them."""
    steps = F.array(*[F.lit(i).cast("long") for i in (-1, 0, 1)])
    around = (
        listed.select(F.struct("*").alias("c"))
        .withColumn("dy", F.explode(steps)).withColumn("dx", F.explode(steps))
    )
    cell = F.struct(
        (degree_cell(F.col("c.lat"), degrees) + F.col("dy")).alias("y"),
        (degree_cell(F.col("c.lon"), degrees) + F.col("dx")).alias("x"),
    )
    return around.groupBy(cell.alias("_cell")).agg(F.collect_list("c").alias("_near"))


# The sphere in cells of two degrees; a cell's farthest point is its corner, under this many km
# from its middle.
_CELL_DEGREES = 2
_CELL_ROWS, _CELL_COLUMNS = 180 // _CELL_DEGREES, 360 // _CELL_DEGREES
_CELL_REACH_KM = 158.0


def _folded(lat: Column, lon: Column) -> tuple[Column, Column]:
    """The position with coordinates beyond the poles or the date line folded back."""
    x, y, z = unit_vector(lat, lon)
    plain = (F.abs(lat) <= 90) & (F.abs(lon) <= 180)
    return F.when(plain, lat).otherwise(F.degrees(F.asin(z))), F.when(plain, lon).otherwise(F.degrees(F.atan2(y, x)))


def _lookup_cell(lat: Column, lon: Column) -> Column:
    """Number of the two-degree cell."""
    true_lat, true_lon = _folded(lat, lon)
    row = F.least(F.floor((true_lat + 90) / _CELL_DEGREES), F.lit(_CELL_ROWS - 1))
    column = F.least(F.floor((true_lon + 180) / _CELL_DEGREES), F.lit(_CELL_COLUMNS - 1))
    return (row * _CELL_COLUMNS + column).cast("int")


def _sphere_cells(listed: DataFrame) -> DataFrame:
    """Every cell of the sphere with the centres that can be nearest to some point in it.

    A centre can win only if, from the middle of the cell, it is no farther than the nearest centre
    by more than twice the cell's reach.
    """
    every = listed.agg(F.collect_list(F.struct("*")).alias("centres")).scalar()
    cells = listed.sparkSession.range(_CELL_ROWS * _CELL_COLUMNS).select(F.col("id").cast("int").alias("_cell"))
    lat = F.floor(F.col("_cell") / _CELL_COLUMNS) * _CELL_DEGREES - 90 + _CELL_DEGREES / 2
    lon = (F.col("_cell") % _CELL_COLUMNS) * _CELL_DEGREES - 180 + _CELL_DEGREES / 2
    x, y, z = unit_vector(lat, lon)
    middle = F.col("_x"), F.col("_y"), F.col("_z")

    def apart(c: Column) -> Column:
        """Squared chord between the middle of the cell and a centre."""
        return sum(((p - c[n]) * (p - c[n]) for p, n in zip(middle, "xyz")), F.lit(0.0))

    measured = cells.withColumns({"_x": x, "_y": y, "_z": z, "_centres": every}).withColumn(
        "_all", F.transform("_centres", lambda c: F.struct(apart(c).alias("apart"), c.alias("c")))
    )
    nearest = F.sqrt(F.array_min(F.transform("_all", lambda m: m["apart"])))
    angle = F.asin(F.least(nearest / 2, F.lit(1.0))) + F.lit(_CELL_REACH_KM / EARTH_RADIUS_KM)
    limit = F.pow(2 * F.sin(F.least(angle, F.lit(math.pi / 2))), F.lit(2.0)) * (1 + 1e-9)
    # A lambda variable holds the limit, so that it is computed once per cell and not per centre.
    can_win = F.transform(F.array(limit), lambda reach: F.filter("_all", lambda m: m["apart"] <= reach))[0]
    return measured.select("_cell", F.transform(can_win, lambda m: m["c"]).alias("_near"))


def _pick(joined: DataFrame, lat: str, lon: str) -> DataFrame:
    rank = chord_rank(unit_vector(F.col(lat), F.col(lon)), unit_vector(F.col("_c.lat"), F.col("_c.lon")))
    best = F.min(F.struct(rank.alias("rank"), F.col("_c.id").alias("id"), F.col("_c").alias("c")))
    return joined.groupBy(lat, lon).agg(best.alias("_m")).select(lat, lon, F.col("_m.c").alias("_c"))


def _match_in_box(points, listed, degrees, inclusive, lat, lon):
    boxed = listed.select(F.col("lat").alias("c_lat"), F.col("lon").alias("c_lon"), F.struct("*").alias("_c"))
    return _pick(box_join(points, boxed, degrees, "inner", inclusive, lat, lon), lat, lon)


def _cell_tree(listed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Cells that hold centres, as a tree: (node, kids, members), and the topmost cells (kid).

    A cell of more than a few centres has the cells it is cut into as ``kids``, each with its middle, its reach and one of its
    centres; any other cell lists its centres as ``members``. Of centres at one place only the least id is there.
    """
    lat, lon = _folded(F.col("lat"), F.col("lon"))
    finest = 4**_TREE_LEVELS
    edge = _TREE_DEGREES / finest
    row = F.least(F.floor((lat + 90) / edge), F.lit(int(180 / _TREE_DEGREES) * finest - 1)).cast("long")
    column = F.least(F.floor((lon + 180) / edge), F.lit(int(360 / _TREE_DEGREES) * finest - 1)).cast("long")

    def node(level: int) -> Column:
        cut = 2 * (_TREE_LEVELS - level)
        return F.lit(level * _LEVEL_STEP) + F.shiftright("_row", cut) * _ROW_STEP + F.shiftright("_column", cut)

    def place(level: int) -> Column:
        parent = node(level - 1) if level else F.lit(-1).cast("long")
        return F.struct(F.lit(level).alias("level"), node(level).alias("node"), parent.alias("parent"))

    spots = listed.groupBy("lat", "lon").agg(F.min(F.struct("id", F.struct(*listed.columns).alias("c"))).alias("least"))
    placed = materialise(spots.select(row.alias("_row"), column.alias("_column"), F.col("least.c").alias("c")), "centres")
    within = placed.select("c", F.inline(F.array(*[place(i) for i in range(_TREE_LEVELS + 1)])))
    one = F.min(F.struct("c.x", "c.y", "c.z")).alias("one")
    cells = materialise(within.groupBy("level", "node", "parent").agg(F.count("*").alias("n"), one), "centre-cells")
    crowded = cells.where((F.col("n") > _FEW_CENTRES) & (F.col("level") < _TREE_LEVELS)).select("node")
    roots, below = cells.where("level = 0"), cells.join(crowded.toDF("parent"), "parent", "left_semi")
    width, in_level = F.lit(_TREE_DEGREES) / F.pow(F.lit(4.0), "level"), F.col("node") % _LEVEL_STEP
    middle = unit_vector((F.floor(in_level / _ROW_STEP) + 0.5) * width - 90, (in_level % _ROW_STEP + 0.5) * width - 180)
    # The straight way in degrees is never shorter than the way on the sphere, nor that than the chord.
    reach = F.radians(width) * (math.sqrt(0.5) * (1 + 1e-9))
    kid = F.struct("node", F.struct(*[m.alias(n) for m, n in zip(middle, "xyz")]).alias("middle"), reach.alias("reach"), "one").alias("kid")
    kids = below.select("parent", kid).groupBy(F.col("parent").alias("node")).agg(F.collect_list("kid").alias("kids"))
    last = roots.select("node").union(below.select("node")).join(crowded, "node", "left_anti")
    members = within.join(last, "node", "left_semi").groupBy("node").agg(F.collect_list("c").alias("members"))
    return materialise(kids.unionByName(members, allowMissingColumns=True), "centre-tree"), roots.select(kid)


def _match_by_descent(points, listed, lat, lon):
    """All points go down the tree together, a level in a round. Every cell a point meets tells it of one centre, so it keeps only
    the cells that may hold one as near as the nearest it knows of; it is settled when no cell is left."""
    tree, roots = _cell_tree(listed)
    vector = {f"_{n}": v for n, v in zip("xyz", unit_vector(F.col(lat), F.col(lon)))}

    def chord(c: Column) -> Column:
        return F.sqrt(sum(((F.col(f"_{n}") - c[n]) * (F.col(f"_{n}") - c[n]) for n in "xyz"), F.lit(0.0)))

    def met(kids: Column) -> Column:
        """The least distance to each cell, that to its one centre, and its number."""
        return F.transform(kids, lambda k: F.struct((chord(k["middle"]) - k["reach"]).alias("low"), chord(k["one"]).alias("high"), k["node"].alias("node")))

    def ranked(members: Column) -> Column:
        near = tuple(F.col(f"_{n}") for n in "xyz")
        return F.array_min(F.transform(members, lambda c: F.struct(chord_rank(near, (c["x"], c["y"], c["z"])).alias("rank"), c["id"].alias("id"), c.alias("c"))))

    def highest(cells: Column) -> Column:
        return F.array_min(F.transform(cells, lambda k: k["high"]))

    def left(cells: Column) -> Column:
        return F.transform(F.filter(cells, lambda k: k["low"] <= F.col("_limit") + _TIE), lambda k: k["node"])

    # No more than 32 cells stand on top. The generators hold what filters read once for each element.
    top = roots.agg(F.collect_list("kid").alias("kids")).scalar()
    first = points.withColumns({**vector, "_top": top}).withColumn("_met", F.explode(F.array(met(F.col("_top"))))).withColumn("_limit", F.explode(F.array(highest(F.col("_met")))))
    pending = materialise(first.select(lat, lon, left(F.col("_met")).alias("_open"), "_limit"), "positions")
    best = ranked(F.col("members"))
    # Rows of points without any centre are dropped.
    settled, known = None, None
    for _ in range(_TREE_LEVELS + 1):
        step = pending.withColumn("node", F.explode("_open")).join(tree, "node").withColumns(vector)
        step = step.select(lat, lon, *([known] if known else []), "_limit", met(F.col("kids")).alias("_met"), best.alias("_found"))
        found = F.array_min(F.array("_found", known)) if known else F.col("_found")
        # The rank of a centre is a squared chord.
        low = F.least("_limit", highest(F.col("_met")), F.sqrt(F.col("_found.rank") / 1e15) + _TIE)
        state = step.groupBy(lat, lon).agg(F.min(low).alias("_limit"), F.min(found).alias("_best"), F.flatten(F.collect_list("_met")).alias("_met"))
        state = materialise(state.select(lat, lon, "_limit", "_best", left(F.col("_met")).alias("_open")), "descent")
        done = state.where("size(_open) = 0").select(lat, lon, F.col("_best.c").alias("_c"))
        settled = done if settled is None else settled.unionByName(done)
        pending, known = state.where("size(_open) > 0"), "_best"
        if pending.isEmpty():
            break
    return settled
