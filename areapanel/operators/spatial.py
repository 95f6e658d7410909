"""Points, polygons and neighbours without a geometry library.

Theta joins are rewritten as equi-joins on grid cells with an exact filter
after them, so nothing is compared with everything.
"""

from __future__ import annotations

import math
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import haversine, mercator_x, mercator_y
from ..shared import save

DEGREE_M = 111_000.0
#: A degree of a great circle of the globe with radius 6,371,000 m.
METRES = math.pi * 6_371_000.0 / 180


def _cell(col: Column, size: float) -> Column:
    return F.floor(col / size).cast("long")


def tag_areas(points: DataFrame, edges: DataFrame, cell: float = 0.01, lat: str = "lat", lon: str = "lon", key: str = "point_id", nearest_fallback: bool = False, max_distance: float | None = None) -> DataFrame:
    """The area whose polygon holds each point: ``point_id`` and ``area_id`` (the least, if polygons overlap; null if none).

    ``edges``: ``area_id, x1, y1, x2, y2`` of all rings, holes included (x is
    longitude).  A point is inside if a ray to the right crosses an odd number
    of edges.  Edges are dealt to the rows of cells that they span, and points
    to their row, so a point only meets edges of areas near its latitude.

    With ``nearest_fallback`` a point outside all polygons gets the area whose
    centroid is nearest (the least of those at one distance, to a digit of a
    metre).  With ``max_distance`` (metres) it gets the area whose boundary is
    nearest instead, if one is within that distance; see :func:`nearest_area`.
    ``point_id`` is unique then.
    """
    box = edges.groupBy("area_id").agg(F.min(F.least("x1", "x2")).alias("w"), F.max(F.greatest("x1", "x2")).alias("e"), F.min(F.least("y1", "y2")).alias("s"), F.max(F.greatest("y1", "y2")).alias("n"))
    cells = box.select("area_id", F.explode(F.sequence(_cell(F.col("w"), cell), _cell(F.col("e"), cell))).alias("cx"), "s", "n").select("area_id", "cx", F.explode(F.sequence(_cell(F.col("s"), cell), _cell(F.col("n"), cell))).alias("cy"))
    spans = edges.where("y1 <> y2").select("area_id", "x1", "y1", "x2", "y2", F.explode(F.sequence(_cell(F.least("y1", "y2"), cell), _cell(F.greatest("y1", "y2"), cell))).alias("cy"))
    near = points.select(key, F.col(lat).alias("py"), F.col(lon).alias("px"), _cell(F.col(lon), cell).alias("cx"), _cell(F.col(lat), cell).alias("cy")).join(cells, ["cx", "cy"])
    crosses = ((F.col("y1") > F.col("py")) != (F.col("y2") > F.col("py"))) & (F.col("px") < (F.col("x2") - F.col("x1")) * (F.col("py") - F.col("y1")) / (F.col("y2") - F.col("y1")) + F.col("x1"))
    hits = near.join(spans, ["area_id", "cy"]).where(crosses).groupBy(key, "area_id").agg(F.count(F.lit(1)).alias("c")).where("c % 2 = 1")
    tagged = points.select(key).join(hits.groupBy(key).agg(F.min("area_id").alias("area_id")), key, "left")
    if max_distance is not None:
        missed = points.select(key, lat, lon).join(tagged.where("area_id is null").select(key), key, "left_semi")
        close = nearest_area(missed, edges, max_distance, lat, lon, key).select(key, F.col("area_id").alias("_near"))
        return tagged.join(close, key, "left").select(key, F.coalesce("area_id", "_near").alias("area_id"))
    if not nearest_fallback:
        return tagged
    tagged = save(tagged, "tagged-areas")  # the search for the nearest runs jobs over it
    outside = points.select(F.col(key).alias("src_id"), F.col(lat).alias("lat"), F.col(lon).alias("lon")).join(tagged.where("area_id is null").select(F.col(key).alias("src_id")), "src_id", "left_semi")
    middles = centroids(edges).select(F.col("area_id").alias("dst_id"), F.col("lat").alias("dst_lat"), F.col("lon").alias("dst_lon"))
    close = nearest(outside, middles).select(F.col("src_id").alias(key), F.col("dst_id").alias("_near"))
    return tagged.join(close, key, "left").select(key, F.coalesce("area_id", "_near").alias("area_id"))


def extract_point(df: DataFrame, lat: str = "latitude", lon: str = "longitude", text: str = "location") -> DataFrame:
    """``lat`` and ``lon`` from columns, JSON (``coordinates``), WKT or ``a, b`` text (the larger magnitude is the longitude)."""
    t = F.col(text)
    json_lon, json_lat = F.get_json_object(t, "$.coordinates[0]").try_cast("double"), F.get_json_object(t, "$.coordinates[1]").try_cast("double")
    number = r"(-?[0-9]+\.?[0-9]*)"
    wkt = rf"POINT\s*\(\s*{number}\s+{number}\s*\)"
    pair = rf"^\s*\(?\s*{number}\s*,\s*{number}\s*\)?\s*$"
    a, b = F.regexp_extract(t, pair, 1).try_cast("double"), F.regexp_extract(t, pair, 2).try_cast("double")
    big, small = F.when(F.abs(a) >= F.abs(b), a).otherwise(b), F.when(F.abs(a) >= F.abs(b), b).otherwise(a)
    return df.withColumns({"lat": F.coalesce(F.col(lat).try_cast("double"), json_lat, F.regexp_extract(t, wkt, 2).try_cast("double"), small), "lon": F.coalesce(F.col(lon).try_cast("double"), json_lon, F.regexp_extract(t, wkt, 1).try_cast("double"), big)})


def _distance(metric: str, lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    if metric == "haversine":
        return haversine(lat1, lon1, lat2, lon2)
    return F.sqrt(F.pow(mercator_x(lon1) - mercator_x(lon2), 2) + F.pow(mercator_y(lat1) - mercator_y(lat2), 2))


def _lon_cell(lon: Column, row: Column, height: float, radius: float) -> tuple[Column, Column]:
    """Cell of a longitude in a row of cells ``height`` degrees high, and the number of cells around the globe there.

    A cell is as wide as any two points within the radius (in radians) can be
    apart in that row; a row near a pole is one cell.
    """
    top = F.greatest(F.abs(row * height), F.abs((row + 1) * height))
    ratio = math.sin(radius) / F.cos(F.radians(top))
    whole = (top >= 90) | (ratio >= 1) | F.lit(radius >= math.pi / 2)
    n = F.when(whole, F.lit(1)).otherwise(F.greatest(F.lit(1), F.floor(360 / (F.degrees(F.asin(ratio)) * 1.01)))).cast("long")
    return F.pmod(F.floor((lon + 180) / 360 * n).cast("long"), n), n


def near_pairs(src: DataFrame, dst: DataFrame, radius_m: float, metric: str = "haversine") -> DataFrame:
    """Pairs within ``radius_m`` of ``src`` (src_id, lat, lon) and ``dst`` (dst_id, dst_lat, dst_lon, ...), and their ``distance``.

    Both sides meet in cells a radius wide or more: on the globe, rows of
    latitude whose cells widen towards the poles and close at 180 degrees; under
    ``webmercator``, squares of the plane.  Rows with a null coordinate have no
    pairs.  A radius of 0 pairs rows of one place.
    """
    reach = max(radius_m, 1.0)  # cells have an extent even if the radius has none
    here, there = (F.col("lat"), F.col("lon")), (F.col("dst_lat"), F.col("dst_lon"))
    steps = F.array(*[F.lit(i) for i in (-1, 0, 1)])
    if metric == "haversine":
        height, radius = reach / DEGREE_M * 1.01, reach / 6_371_000.0 * 1.001
        left = src.withColumn("cy", _cell(F.col("lat"), height))
        left = left.withColumn("cx", _lon_cell(F.col("lon"), F.col("cy"), height, radius)[0])
        right = dst.withColumn("oy", F.explode(steps)).withColumn("cy", _cell(F.col("dst_lat"), height) + F.col("oy")).drop("oy")
        x, n = _lon_cell(F.col("dst_lon"), F.col("cy"), height, radius)
        right = right.withColumn("cx", F.explode(F.array_distinct(F.transform(steps, lambda i: F.pmod(x + i, n)))))
    else:
        left = src.withColumns({"cx": _cell(mercator_x(here[1]), reach), "cy": _cell(mercator_y(here[0]), reach)})
        right = dst.withColumn("ox", F.explode(steps)).withColumn("oy", F.explode(steps))
        right = right.withColumns({"cx": _cell(mercator_x(there[1]), reach) + F.col("ox"), "cy": _cell(mercator_y(there[0]), reach) + F.col("oy")}).drop("ox", "oy")
    return left.join(right, ["cx", "cy"]).withColumn("distance", _distance(metric, *here, *there)).where(F.col("distance") <= radius_m).drop("cx", "cy")


def _place(lat: Column, lon: Column, metric: str) -> list[Column]:
    """Coordinates in which straight distances order as the metric does: on the globe's unit sphere, or in the Mercator plane."""
    if metric == "haversine":
        phi, lam = F.radians(lat), F.radians(lon)
        return [F.cos(phi) * F.cos(lam), F.cos(phi) * F.sin(lam), F.sin(phi)]
    return [mercator_x(lon), mercator_y(lat)]


def _known(lat: Column, lon: Column, metric: str) -> Column:
    """Whether both coordinates are numbers that the metric has a place for; false or null if not."""
    parts = [F.abs(c) < float("inf") for c in _place(lat, lon, metric)]
    return reduce(and_, parts)


def _pyramid(dst: DataFrame, names: list[Column], axes: list[str], most: int) -> DataFrame:
    """Occupied cells of all levels: ``level, cell, n, lo, hi`` (box of what is in them), ``parent``.

    ``names``: name of a row's cell by level.  A cell of more than ``most``
    destinations is cut in 4 along each axis, down to the last level; the box of
    a cell is that of its destinations.
    """
    box = [F.array(*[F.min(a) for a in axes]).alias("lo"), F.array(*[F.max(a) for a in axes]).alias("hi")]
    levels, rows = None, dst.withColumn("parent", F.lit("-"))
    for k, name in enumerate(names):
        rows = rows.withColumn("cell", name)
        cells = save(rows.groupBy("parent", "cell").agg(F.count(F.lit(1)).alias("n"), *box).withColumn("level", F.lit(k)), "nearest-cells")
        levels = cells if levels is None else levels.unionByName(cells)
        full = cells.where(F.col("n") > most)
        if k == len(names) - 1 or not full.limit(1).count():
            return levels
        rows = rows.drop("parent").join(full.select("cell"), "cell", "left_semi").withColumnRenamed("cell", "parent")
    return levels


def _bounds(axes: list[str]) -> tuple[Column, Column]:
    """Squares of the least and the greatest distance from the source to a box."""
    gap = [F.greatest(F.get("lo", F.lit(i)) - F.col(a), F.col(a) - F.get("hi", F.lit(i)), F.lit(0.0)) for i, a in enumerate(axes)]
    far = [F.greatest(F.abs(F.get("lo", F.lit(i)) - F.col(a)), F.abs(F.get("hi", F.lit(i)) - F.col(a))) for i, a in enumerate(axes)]
    total = lambda parts: sum((x * x for x in parts[1:]), parts[0] * parts[0])
    return total(gap), total(far)


def _descend(src: DataFrame, dst: DataFrame, metric: str, best: Column, leaf: int, deepest: int) -> DataFrame:
    """``lat``, ``lon`` (different in each row of ``src``) and the best destination, by going down a pyramid of occupied cells.

    Every source keeps a saved frontier: the cells whose least possible distance
    is not more than the least of the greatest possible ones.  Only these are
    opened, level by level, so that a source meets a few cells at each level and
    the destinations of a few leaves, however far or dense they lie.
    """
    axes = ["_x", "_y", "_z"] if metric == "haversine" else ["_x", "_y"]
    put = lambda df, lat, lon: df.withColumns(dict(zip(axes, _place(F.col(lat), F.col(lon), metric), strict=True)))
    there = save(put(dst, "dst_lat", "dst_lon"), "nearest-destinations")
    span = there.agg(*[f(a) for a in axes for f in (F.min, F.max)]).first()
    low, high = span[::2], span[1::2]
    top = max([1e-9, *(h - l for l, h in zip(low, high, strict=True))]) / 2  # up to 3 cells along each axis at the top
    names = [F.concat_ws("_", *[_cell(F.col(a) - l, top / 4**k).cast("string") for a, l in zip(axes, low, strict=True)]) for k in range(deepest + 1)]
    cells = _pyramid(there, names, axes, leaf)
    least, most = _bounds(axes)
    # Rounding: distances are compared to a digit of a metre, so boxes get twice that more.
    slack = F.lit(0.2 if metric != "haversine" else 0.2 / 6_371_000.0)
    here, place = put(src, "lat", "lon"), ["lat", "lon"]
    frontier, leaves = here.withColumn("at", F.lit("-")), None
    depth = cells.agg(F.max("level")).first()[0]
    for k in range(depth + 1):
        level = cells.where(F.col("level") == k).select(F.col("parent").alias("at"), "cell", "n", "lo", "hi")
        if k == 0:
            level = F.broadcast(level)  # at most 3 cells along each axis
        opened = frontier.join(level, "at").withColumns({"least": least, "most": most})
        reach = opened.select(*place, "most")
        if leaves is not None:
            reach = reach.unionByName(leaves.select(*place, "most"))
        reach = reach.groupBy(*place).agg(F.min("most").alias("reach"))
        kept = opened.join(reach, place).where(F.sqrt("least") <= F.sqrt("reach") + slack).select(*place, *axes, F.col("cell").alias("at"), "n", "least", "most", F.lit(k).alias("level"))
        kept = save(kept, "nearest-frontier")
        end = kept if k == depth else kept.where(F.col("n") <= leaf)
        leaves = end if leaves is None else leaves.unionByName(end)
        frontier = kept.where(F.col("n") > leaf).select(*place, *axes, "at")
    reach = leaves.groupBy(*place).agg(F.min("most").alias("reach"))
    wanted = leaves.join(reach, place).where(F.sqrt("least") <= F.sqrt("reach") + slack).select(*place, "level", "at")
    inside = None
    for k, name in enumerate(names[: depth + 1]):
        part = there.withColumn("at", name).withColumn("level", F.lit(k)).select("level", "at", "dst_id", "dst_lat", "dst_lon")
        ends = cells.where((F.col("level") == k) & ((F.col("n") <= leaf) | F.lit(k == depth))).select(F.col("cell").alias("at"))
        part = part.join(ends, "at", "left_semi")
        inside = part if inside is None else inside.unionByName(part)
    pairs = wanted.join(inside, ["level", "at"]).withColumn("distance", _distance(metric, F.col("lat"), F.col("lon"), F.col("dst_lat"), F.col("dst_lon")))
    return pairs.groupBy(*place).agg(F.min(best).alias("best"))


def _scan_all(src: DataFrame, dst: DataFrame, metric: str) -> DataFrame:
    """``src`` and the ``best`` of all destinations, from a broadcast array of them."""
    all_ = dst.agg(F.collect_list(F.struct("dst_id", "dst_lat", "dst_lon")).alias("ps"))
    each = F.transform("ps", lambda p: F.struct(F.round(_distance(metric, F.col("lat"), F.col("lon"), p["dst_lat"], p["dst_lon"]), 1).alias("distance"), p["dst_id"].alias("dst_id")))
    return src.crossJoin(F.broadcast(all_)).select(*src.columns, F.when(_known(F.col("lat"), F.col("lon"), metric), F.array_min(each)).alias("best"))


def nearest(src: DataFrame, dst: DataFrame, metric: str = "haversine", most: int = 10_000, leaf: int = 64, deepest: int = 14, pairs: int = 8_000_000) -> DataFrame:
    """``src_id``, the ``dst_id`` nearest to it (the least of those at one distance) and their ``distance`` in metres, rounded to one digit.

    Rows that share a place share the search: of destinations at one place only
    the least id can be the answer, and each different place of the sources is
    searched once.  Up to ``leaf`` places of destinations every source scans a
    broadcast array of them; up to ``most`` every place of the sources does, if
    that makes no more than ``pairs`` comparisons.  Beyond that they are searched
    through a pyramid of occupied cells, whose leaves hold up to ``leaf`` places
    (more only where they lie within a metre or so, ``deepest`` levels down), so
    work does not grow with sources times destinations.  All ways are exact and
    give the same rows: one for each source (``src_id`` is unique), with nulls
    where it or every destination has no coordinates (NaN and infinities are
    none).  Counting the places, and each level of the search, is an action
    while the plan is made.
    """
    placed = dst.where(_known(F.col("dst_lat"), F.col("dst_lon"), metric)).groupBy("dst_lat", "dst_lon").agg(F.min("dst_id").alias("dst_id"))
    n = placed.limit(most + 1).count()
    if n <= min(leaf, most):
        return _scan_all(src.select("src_id", "lat", "lon"), placed, metric).select("src_id", "best.dst_id", "best.distance")
    places = save(src.where(_known(F.col("lat"), F.col("lon"), metric)).select("lat", "lon").distinct(), "nearest-sources")
    if n <= most and n * places.count() <= pairs:
        found = _scan_all(places.repartition(places.sparkSession.sparkContext.defaultParallelism), placed, metric)
    else:
        found = _descend(places, placed, metric, F.struct(F.round("distance", 1).alias("distance"), "dst_id"), leaf, deepest)
    return src.select("src_id", "lat", "lon").join(found, ["lat", "lon"], "left").select("src_id", "best.dst_id", "best.distance")


def nearest_distance(src: DataFrame, dst: DataFrame, metric: str = "haversine", most: int = 10_000, pairs: int = 8_000_000) -> DataFrame:
    """``src_id`` and the distance to the nearest row of ``dst``; see :func:`nearest`."""
    return nearest(src, dst, metric, most, pairs=pairs).select("src_id", "distance")


def count_within(src: DataFrame, dst: DataFrame, radii: list[float], weight: str | None = None) -> DataFrame:
    """For each source the number of destinations within each radius (``within_<r>``), and their summed weights (``sum_<r>``); one join.

    Rows that share a place are counted and summed before the join, and each
    different place of the sources is joined once, so what is joined are pairs of
    places.
    """
    text = {r: f"{r:g}".replace(".", "_") for r in radii}
    places = src.where(_known(F.col("lat"), F.col("lon"), "haversine")).select("lat", "lon").distinct()
    sums = [F.count(F.lit(1)).alias("_n")] + ([F.sum(weight).alias("_w")] if weight else [])
    there = dst.where(_known(F.col("dst_lat"), F.col("dst_lon"), "haversine")).groupBy("dst_lat", "dst_lon").agg(*sums)
    aggs = [F.sum(F.when(F.col("distance") <= r, F.col("_n"))).alias(f"within_{text[r]}") for r in radii]
    if weight:
        kind = there.schema["_w"].dataType
        aggs += [F.coalesce(F.sum(F.when(F.col("distance") <= r, F.col("_w"))).cast(kind), F.lit(0)).alias(f"sum_{text[r]}") for r in radii]
    names = [f"within_{text[r]}" for r in radii] + ([f"sum_{text[r]}" for r in radii] if weight else [])
    found = near_pairs(places, there, max(radii)).groupBy("lat", "lon").agg(*aggs)
    return src.select("src_id", "lat", "lon").join(found, ["lat", "lon"], "left").select("src_id", *names).fillna(0, subset=names)


def neighbor_sum(edges: DataFrame, facts: DataFrame, value: str, keys: list[str], area: str = "area_id") -> DataFrame:
    """Sum over neighbouring areas, by the other keys: ``edges`` has ``area_id, neighbor``."""
    side = facts.groupBy(F.col(area).alias("neighbor"), *keys).agg(F.sum(value).alias("_v"))
    return edges.join(side, "neighbor").groupBy(area, *keys).agg(F.sum("_v").alias(f"neighbor_{value}"))


def _crossed_cells(edges: DataFrame, cell: float, margin: float) -> DataFrame:
    """Edges by the grid cells that they cross (``cx``, ``cy``), cells within ``margin`` of them included."""
    low, high = F.least("y1", "y2"), F.greatest("y1", "y2")
    rows = edges.withColumn("cy", F.explode(F.sequence(_cell(low - margin, cell), _cell(high + margin, cell))))
    # The part of the edge in this row of cells: a share of its way from the lower to the upper end.
    flat = F.col("y1") == F.col("y2")
    share = lambda y: F.when(flat, F.lit(None)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), (y - F.col("y1")) / (F.col("y2") - F.col("y1")))))
    at = lambda y: F.col("x1") + share(y) * (F.col("x2") - F.col("x1"))
    a, b = F.coalesce(at(F.col("cy") * cell - margin), F.col("x1")), F.coalesce(at((F.col("cy") + 1) * cell + margin), F.col("x2"))
    return rows.withColumn("cx", F.explode(F.sequence(_cell(F.least(a, b) - margin, cell), _cell(F.greatest(a, b) + margin, cell))))


def _off(px: Column, py: Column, x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    """Square of the distance from a point to a segment."""
    dx, dy = x2 - x1, y2 - y1
    t = F.coalesce(F.try_divide((px - x1) * dx + (py - y1) * dy, dx * dx + dy * dy), F.lit(0.0))
    t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), t))
    ex, ey = px - (x1 + t * dx), py - (y1 + t * dy)
    return ex * ex + ey * ey


def build_adjacency(edges: DataFrame, cell: float = 0.01, tolerance: float = 1e-9) -> DataFrame:
    """Pairs of areas whose boundaries meet, both ways: ``area_id, neighbor``.

    A corner, part of a side, a crossing or a corner on another's side will do;
    ends may miss a side by ``tolerance``, in the unit of the coordinates (1e-9
    degrees are a tenth of a millimetre).  Sides meet in the grid cells that they
    cross, so only sides of one cell are compared: they cross if each separates
    the other's ends, and touch if an end of one lies on the other.  Choose
    ``cell`` near the length of the longer sides.
    """
    e = _crossed_cells(edges.select("area_id", "x1", "y1", "x2", "y2"), cell, 2 * tolerance)
    other = e.select("cx", "cy", F.col("area_id").alias("neighbor"), F.col("x1").alias("u1"), F.col("y1").alias("v1"), F.col("x2").alias("u2"), F.col("y2").alias("v2"))
    boxes = (F.least("x1", "x2") <= F.greatest("u1", "u2") + tolerance) & (F.least("u1", "u2") <= F.greatest("x1", "x2") + tolerance) & (F.least("y1", "y2") <= F.greatest("v1", "v2") + tolerance) & (F.least("v1", "v2") <= F.greatest("y1", "y2") + tolerance)
    p, q = [tuple(map(F.col, c)) for c in (("x1", "y1"), ("x2", "y2"))], [tuple(map(F.col, c)) for c in (("u1", "v1"), ("u2", "v2"))]
    side = lambda s, r: F.signum((s[1][0] - s[0][0]) * (r[1] - s[0][1]) - (s[1][1] - s[0][1]) * (r[0] - s[0][0]))
    crosses = (side(p, q[0]) * side(p, q[1]) < 0) & (side(q, p[0]) * side(q, p[1]) < 0)
    touches = F.least(*[_off(*r, *p[0], *p[1]) for r in q], *[_off(*r, *q[0], *q[1]) for r in p]) <= tolerance * tolerance
    pairs = e.join(other, ["cx", "cy"]).where((F.col("area_id") < F.col("neighbor")) & boxes & (crosses | touches)).select("area_id", "neighbor").distinct()
    return pairs.unionByName(pairs.select(F.col("neighbor").alias("area_id"), F.col("area_id").alias("neighbor")))


def nearest_area(points: DataFrame, edges: DataFrame, max_distance: float, lat: str = "lat", lon: str = "lon", key: str = "point_id") -> DataFrame:
    """``key``, ``area_id`` and ``distance`` (metres, to a digit) of the area whose boundary is nearest, for points with one within ``max_distance``.

    Distances are to the sides, on the plane that touches the globe's parallel at
    the point; fine for up to some kilometres.  Sides are dealt to the cells from
    which they can be reached: rows ``max_distance`` high, whose cells widen
    towards the poles.  No side crosses the 180th meridian.  The least area of
    those at one distance is taken.
    """
    height = max_distance / DEGREE_M * 1.01
    top = lambda row: F.least(F.lit(89.9), F.greatest(F.abs(row * height), F.abs((row + 1) * height)) + height)
    width = lambda row: F.lit(height) / F.cos(F.radians(top(row)))
    low, high = F.least("y1", "y2"), F.greatest("y1", "y2")
    sides = edges.select("area_id", "x1", "y1", "x2", "y2").withColumn("cy", F.explode(F.sequence(_cell(low - height, height), _cell(high + height, height))))
    share = lambda y: F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.try_divide(y - F.col("y1"), F.col("y2") - F.col("y1"))))
    at = lambda y, flat: F.when(F.col("y1") == F.col("y2"), F.col(flat)).otherwise(F.col("x1") + share(y) * (F.col("x2") - F.col("x1")))
    a, b = at((F.col("cy") - 1) * height, "x1"), at((F.col("cy") + 2) * height, "x2")
    w = width(F.col("cy"))
    sides = sides.withColumn("cx", F.explode(F.sequence(F.floor(F.least(a, b) / w).cast("long") - 1, F.floor(F.greatest(a, b) / w).cast("long") + 1)))
    here = points.where(F.col(lat).isNotNull() & F.col(lon).isNotNull()).select(F.col(key).alias("_key"), F.col(lat).alias("_py"), F.col(lon).alias("_px"), _cell(F.col(lat), height).alias("cy"))
    here = here.withColumn("cx", F.floor(F.col("_px") / width(F.col("cy"))).cast("long"))
    east, north = F.cos(F.radians("_py")) * METRES, F.lit(METRES)
    x = lambda c: (F.col(c) - F.col("_px")) * east
    y = lambda c: (F.col(c) - F.col("_py")) * north
    off = F.sqrt(_off(F.lit(0.0), F.lit(0.0), x("x1"), y("y1"), x("x2"), y("y2")))
    near = here.join(sides, ["cx", "cy"]).withColumn("_off", off).where(F.col("_off") <= max_distance)
    best = near.groupBy("_key").agg(F.min(F.struct(F.round("_off", 1).alias("distance"), "area_id")).alias("best"))
    return best.select(F.col("_key").alias(key), "best.area_id", "best.distance")


def radius_adjacency(centroids: DataFrame, radius_m: float) -> DataFrame:
    """Pairs of areas whose centroids lie within the radius, both ways."""
    src = centroids.select(F.col("area_id").alias("src_id"), "lat", "lon")
    dst = centroids.select(F.col("area_id").alias("neighbor"), F.col("lat").alias("dst_lat"), F.col("lon").alias("dst_lon"))
    return near_pairs(src, dst, radius_m).where("src_id <> neighbor").select(F.col("src_id").alias("area_id"), "neighbor")


def centroids(edges: DataFrame) -> DataFrame:
    """Area centroids by the shoelace sums: ``area_id, lon, lat``.

    Coordinates count from a corner of the area: in sums of whole degrees a side
    of 0.01 degrees would lose centimetres.  An area without extent has the
    middle of its sides.
    """
    corner = edges.groupBy("area_id").agg(F.min("x1").alias("_x"), F.min("y1").alias("_y"))
    own = edges.join(corner, "area_id").select("area_id", "_x", "_y", *[(F.col(c) - F.col("_x" if c[0] == "x" else "_y")).alias(c) for c in ("x1", "y1", "x2", "y2")])
    cross, length = F.col("x1") * F.col("y2") - F.col("x2") * F.col("y1"), F.hypot(F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1"))
    x, y = F.col("x1") + F.col("x2"), F.col("y1") + F.col("y2")
    sums = own.groupBy("area_id", "_x", "_y").agg(F.sum(cross).alias("a"), F.sum(x * cross).alias("sx"), F.sum(y * cross).alias("sy"), F.sum(length).alias("l"), F.sum(x * length).alias("lx"), F.sum(y * length).alias("ly"))
    middle = lambda c: (F.coalesce(F.try_divide(f"s{c}", 3 * F.col("a")), F.try_divide(f"l{c}", 2 * F.col("l")), F.lit(0.0)) + F.col(f"_{c}"))
    return sums.select("area_id", middle("x").alias("lon"), middle("y").alias("lat"))


def event_centroids(df: DataFrame, area: str = "area_id") -> DataFrame:
    return df.groupBy(area).agg(F.avg("lat").alias("lat"), F.avg("lon").alias("lon"))


def fill_coords(df: DataFrame, known: DataFrame, area: str = "area_id") -> DataFrame:
    """Own coordinates, else the area's centroid, else the mean of the area's own rows."""
    c = known.select(area, F.col("lat").alias("_clat"), F.col("lon").alias("_clon"))
    m = df.groupBy(area).agg(F.avg("lat").alias("_mlat"), F.avg("lon").alias("_mlon"))
    out = df.join(c, area, "left").join(m, area, "left")
    return out.withColumns({x: F.coalesce(x, f"_c{x}", f"_m{x}") for x in ("lat", "lon")}).drop("_clat", "_clon", "_mlat", "_mlon")


def best_key_overlap(keys: DataFrame, layers: dict[str, DataFrame], length: int) -> DataFrame:
    """``layer``, ``side``, ``overlap`` of the layer and truncation that match the most keys."""
    own = keys.select("key").distinct()
    parts = [own.intersect(layer.select(cut(F.col("key"), F.lit(length)).alias("key"))).agg(F.count(F.lit(1)).alias("overlap")).select(F.lit(name).alias("layer"), F.lit(side).alias("side"), "overlap") for name, layer in layers.items() for side, cut in (("left", F.left), ("right", F.right))]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.orderBy(F.desc("overlap"), "layer", "side").limit(1)


def poi_category(df: DataFrame, tags: str = "tags", keys: tuple[str, ...] = ("amenity", "shop", "leisure")) -> DataFrame:
    """Category (the first key there), subcategory (its value) and name of JSON tags."""
    m = F.from_json(tags, "map<string,string>")
    return df.withColumns({"poi_category": F.coalesce(*[F.when(F.element_at(m, k).isNotNull(), F.lit(k)) for k in keys]), "poi_subcategory": F.coalesce(*[F.element_at(m, k) for k in keys]), "poi_name": F.element_at(m, "name")})
