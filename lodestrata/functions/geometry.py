"""Plane geometry as Column expressions.

A polygon column ``rings`` is array<array<struct<x,y>>>: closed rings, filled by the even-odd rule, so
holes and several parts need no marks. Predicates work on ``edges(rings)``, which callers compute once
per polygon, before a join.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

RINGS = "array<array<struct<x:double,y:double>>>"


def ring(*points: tuple[Column, Column]) -> Column:
    """A closed ring of the given corners."""
    cells = [F.struct(x.cast("double").alias("x"), y.cast("double").alias("y")) for x, y in points]
    return F.array(*cells, cells[0])


def bound(value: Column, function) -> Column:
    """function(value) with the value worked out once: what a lambda takes from outside is worked out anew for every element."""
    return F.element_at(F.transform(F.array(value), function), 1)


def ring_edges(r: Column) -> Column:
    n = F.greatest(F.size(r) - 1, F.lit(0))
    pairs = F.arrays_zip(F.slice(r, F.lit(1), n).alias("a"), F.slice(r, F.lit(2), n).alias("b"))
    return F.transform(pairs, lambda p: F.struct(p["a"]["x"].alias("x1"), p["a"]["y"].alias("y1"), p["b"]["x"].alias("x2"), p["b"]["y"].alias("y2")))


def edges(rings: Column) -> Column:
    return F.flatten(F.transform(rings, ring_edges))


def _cross(e: Column, x: Column, y: Column) -> Column:
    return (e["x2"] - e["x1"]) * (y - e["y1"]) - (e["y2"] - e["y1"]) * (x - e["x1"])


def on_one_edge(e: Column, x: Column, y: Column) -> Column:
    inside = x.between(F.least(e["x1"], e["x2"]), F.greatest(e["x1"], e["x2"])) & y.between(F.least(e["y1"], e["y2"]), F.greatest(e["y1"], e["y2"]))
    return (_cross(e, x, y) == 0) & inside


def on_edge(es: Column, x: Column, y: Column) -> Column:
    return F.exists(es, lambda e: on_one_edge(e, x, y))


def edge_crosses(e: Column, x: Column, y: Column) -> Column:
    """Whether a ray to the right meets the edge. Sides are told by cross products, which are exact for whole numbers."""
    up = e["y2"] > e["y1"]
    left = F.when(up, _cross(e, x, y) > 0).otherwise(_cross(e, x, y) < 0)
    return ((e["y1"] > y) != (e["y2"] > y)) & left


def in_fill(es: Column, x: Column, y: Column) -> Column:
    """Even-odd rule, without regard to edges."""
    return F.size(F.filter(es, lambda e: edge_crosses(e, x, y))) % 2 == 1


def covers(es: Column, x: Column, y: Column) -> Column:
    """Inside or on the boundary."""
    return in_fill(es, x, y) | on_edge(es, x, y)


def contains(es: Column, x: Column, y: Column) -> Column:
    """Inside, not on the boundary."""
    return in_fill(es, x, y) & ~on_edge(es, x, y)


def edge_distance(e: Column, x: Column, y: Column) -> Column:
    dx, dy = e["x2"] - e["x1"], e["y2"] - e["y1"]
    t = F.coalesce(F.try_divide((x - e["x1"]) * dx + (y - e["y1"]) * dy, dx * dx + dy * dy), F.lit(0.0))
    t = F.least(F.greatest(t, F.lit(0.0)), F.lit(1.0))
    return F.hypot(x - e["x1"] - t * dx, y - e["y1"] - t * dy)


def distance_to_edges(es: Column, x: Column, y: Column) -> Column:
    return F.array_min(F.transform(es, lambda e: edge_distance(e, x, y)))


def edge_meets(a: Column, b: Column) -> Column:
    """Whether two edges share a point."""

    def side(e: Column, x: Column, y: Column) -> Column:
        return F.signum(_cross(e, x, y))

    proper = (side(a, b["x1"], b["y1"]) * side(a, b["x2"], b["y2"]) < 0) & (side(b, a["x1"], a["y1"]) * side(b, a["x2"], a["y2"]) < 0)
    return proper | on_one_edge(a, b["x1"], b["y1"]) | on_one_edge(a, b["x2"], b["y2"]) | on_one_edge(b, a["x1"], a["y1"]) | on_one_edge(b, a["x2"], a["y2"])


def edges_follow(a: Column, b: Column) -> Column:
    """Whether one edge starts where the other ends."""
    return ((a["x2"] == b["x1"]) & (a["y2"] == b["y1"])) | ((b["x2"] == a["x1"]) & (b["y2"] == a["y1"]))


def edges_cross(a: Column, b: Column) -> Column:
    """Whether two edges cross at an inner point of both."""
    side = lambda e, x, y: F.signum(_cross(e, x, y))
    return (side(a, b["x1"], b["y1"]) * side(a, b["x2"], b["y2"]) < 0) & (side(b, a["x1"], a["y1"]) * side(b, a["x2"], a["y2"]) < 0)


def polygons_intersect(one: Column, two: Column) -> Column:
    """Whether two edge arrays' polygons share a point: an edge meets another, or a ring of one lies inside the other."""
    meet = F.exists(one, lambda a: F.exists(two, lambda b: edge_meets(a, b)))
    holds = lambda es, of: F.exists(of, lambda e: in_fill(es, e["x1"], e["y1"]))
    return meet | holds(one, two) | holds(two, one)


def interiors_overlap(one: Column, two: Column) -> Column:
    """Whether two polygons share more than boundary: edges cross, a corner or edge midpoint lies strictly inside, or both are equal."""
    cross = F.exists(one, lambda a: F.exists(two, lambda b: edges_cross(a, b)))

    def inside(es: Column, of: Column) -> Column:
        return F.exists(of, lambda e: contains(es, e["x1"], e["y1"]) | contains(es, (e["x1"] + e["x2"]) / 2, (e["y1"] + e["y2"]) / 2))

    return cross | inside(one, two) | inside(two, one) | (F.array_sort(one) == F.array_sort(two))


def bounds(rings: Column) -> dict[str, Column]:
    points = F.flatten(rings)
    xs, ys = F.transform(points, lambda p: p["x"]), F.transform(points, lambda p: p["y"])
    return {"minx": F.array_min(xs), "miny": F.array_min(ys), "maxx": F.array_max(xs), "maxy": F.array_max(ys)}


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, v: a + v)


def ring_area(r: Column) -> Column:
    """Signed, counter-clockwise positive."""
    return _sum(F.transform(ring_edges(r), lambda e: (e["x1"] * e["y2"] - e["x2"] * e["y1"]) / 2))


def _signs(rings: Column) -> Column:
    """1 for each ring at an even depth, -1 for holes: how many other rings hold a corner of it that is not on them."""

    def depth(r: Column, i: Column) -> Column:
        def held(es: Column) -> Column:
            free = F.filter(r, lambda p: ~on_edge(es, p["x"], p["y"]))
            return F.exists(F.slice(free, 1, 1), lambda p: in_fill(es, p["x"], p["y"]))

        return F.size(F.filter(rings, lambda other, j: (i != j) & bound(ring_edges(other), held)))

    return F.when(F.size(rings) == 1, F.array(F.lit(1))).otherwise(F.transform(rings, lambda r, i: F.when(depth(r, i) % 2 == 0, 1).otherwise(-1)))


def area(rings: Column) -> Column:
    """Of all parts, less their holes."""
    return _sum(F.zip_with(rings, _signs(rings), lambda r, sign: sign * F.abs(ring_area(r))))


def perimeter(rings: Column) -> Column:
    return _sum(F.transform(edges(rings), lambda e: F.hypot(e["x2"] - e["x1"], e["y2"] - e["y1"])))


def centroid(rings: Column) -> dict[str, Column]:
    """Area centroid of all parts less their holes, taken about the first corner, which keeps large coordinates exact."""
    first = F.element_at(F.element_at(rings, 1), 1)
    x0, y0 = first["x"], first["y"]
    w = lambda e: e["x1"] * e["y2"] - e["x2"] * e["y1"]

    def moments(r: Column, sign: Column) -> Column:
        def sums(es: Column) -> Column:
            of = (F.transform(es, w), F.transform(es, lambda e: w(e) * (e["x1"] + e["x2"])), F.transform(es, lambda e: w(e) * (e["y1"] + e["y2"])))
            return F.struct(*[_sum(v).alias(k) for k, v in zip("axy", of, strict=True)])

        moved = lambda c: ring_edges(F.transform(r, lambda p: F.struct((p["x"] - c["x"]).alias("x"), (p["y"] - c["y"]).alias("y"))))
        return bound(bound(bound(first, moved), sums), lambda m: F.struct(*[(sign * F.signum(m["a"]) * m[k]).alias(k) for k in "axy"]))

    each = F.zip_with(rings, _signs(rings), moments)
    total, sum_x, sum_y = (_sum(each[k]) for k in "axy")
    return {"cx": x0 + F.try_divide(sum_x, 3 * total), "cy": y0 + F.try_divide(sum_y, 3 * total)}


def interior_point(rings: Column) -> Column:
    """struct<x,y> strictly inside: the middle of the widest filled interval of a line across the polygon.

    The line runs halfway between two neighbouring corner heights, so it meets no corner: those nearest the middle one
    between which the polygon has an edge, as parts may leave a gap there.
    """
    between = lambda heights, k: (F.element_at(heights, k) + F.element_at(heights, k + 1)) / 2

    def level(es: Column, heights: Column) -> Column:
        at = F.floor(F.size(heights) / 2).cast("int")
        filled = lambda k: bound(between(heights, k), lambda y: F.exists(es, lambda e: (e["y1"] > y) != (e["y2"] > y)))
        others = F.filter(F.sequence(F.lit(1), F.size(heights) - 1), filled)
        nearest = F.array_min(F.transform(others, lambda k: F.struct(F.abs(k - at).alias("far"), k.alias("k"))))["k"]
        return between(heights, F.when(filled(at), at).otherwise(nearest))

    def widest(es: Column, y: Column) -> Column:
        hit = F.filter(es, lambda e: (e["y1"] > y) != (e["y2"] > y))
        crossings = F.sort_array(F.transform(hit, lambda e: e["x1"] + (y - e["y1"]) * (e["x2"] - e["x1"]) / (e["y2"] - e["y1"])))
        gap = lambda xs: lambda i: F.struct((F.element_at(xs, i + 1) - F.element_at(xs, i)).alias("w"), ((F.element_at(xs, i + 1) + F.element_at(xs, i)) / 2).alias("x"))
        gaps = bound(crossings, lambda xs: F.transform(F.sequence(F.lit(1), F.size(xs) - 1, F.lit(2)), gap(xs)))
        return F.struct(F.array_max(gaps)["x"].alias("x"), y.alias("y"))

    corners = F.sort_array(F.array_distinct(F.transform(F.flatten(rings), lambda p: p["y"])))
    return bound(edges(rings), lambda es: bound(bound(corners, lambda heights: level(es, heights)), lambda y: widest(es, y)))


def unusable_reason(rings: Column) -> Column:
    """null, empty, degenerate or self_intersecting; null for a polygon that can be used."""
    reach = lambda a, b, v: (F.least(a[f"{v}1"], a[f"{v}2"]) <= F.greatest(b[f"{v}1"], b[f"{v}2"])) & (F.least(b[f"{v}1"], b[f"{v}2"]) <= F.greatest(a[f"{v}1"], a[f"{v}2"]))
    # the boxes of edges are compared first, as few edges of a polygon come near each other
    meets = lambda a, b: reach(a, b, "x") & reach(a, b, "y") & (a != b) & ~edges_follow(a, b) & edge_meets(a, b)
    bad = bound(edges(rings), lambda es: F.exists(es, lambda a: F.exists(es, lambda b: meets(a, b))))
    return (
        F.when(rings.isNull(), "null")
        .when((F.size(rings) == 0) | F.exists(rings, lambda r: F.size(r) < 4), "empty")
        .when(F.exists(rings, lambda r: ring_area(r) == 0), "degenerate")
        .when(bad, "self_intersecting")
    )


def _over_rings(rings: Column, function, *args) -> Column:
    """function(ring, *args) of every ring, each bound to a variable: expressions that use it often do not repeat it."""
    return F.transform(rings, lambda r: function(r, *args))


def clip_to_box(rings: Column, box: tuple[float, float, float, float]) -> Column:
    """Rings clipped to (minx, miny, maxx, maxy), one side after another; rings that vanish are dropped."""
    minx, miny, maxx, maxy = box

    def side(r: Column, axis: str, bound: float, keep_above: bool) -> Column:
        keeps = lambda v: v >= bound if keep_above else v <= bound

        def step(e: Column) -> Column:
            a, b = e[f"{axis}1"], e[f"{axis}2"]
            t = (F.lit(bound) - a) / (b - a)
            cut = F.array(F.struct((e["x1"] + t * (e["x2"] - e["x1"])).alias("x"), (e["y1"] + t * (e["y2"] - e["y1"])).alias("y")))
            end = F.array(F.struct(e["x2"].alias("x"), e["y2"].alias("y")))
            none = F.array().cast("array<struct<x:double,y:double>>")
            return F.when(keeps(a) & keeps(b), end).when(keeps(a), cut).when(keeps(b), F.concat(cut, end)).otherwise(none)

        out = F.flatten(F.transform(ring_edges(r), step))
        return F.when(F.size(out) > 0, F.concat(out, F.slice(out, 1, 1))).otherwise(out)

    for one in (("x", minx, True), ("x", maxx, False), ("y", miny, True), ("y", maxy, False)):
        rings = _over_rings(rings, side, *one)
    return F.filter(rings, lambda r: (F.size(r) >= 4) & (F.abs(ring_area(r)) > 0))


# Albers equal-area on the GRS80 ellipsoid; standard parallels -18 and -36, origin (132, 0).
_A, _FLAT = 6378137.0, 1 / 298.257222101
_E2 = _FLAT * (2 - _FLAT)
_E = math.sqrt(_E2)


def _q(s: float) -> float:
    return (1 - _E2) * (s / (1 - _E2 * s * s) - math.log((1 - _E * s) / (1 + _E * s)) / (2 * _E))


def _m(phi: float) -> float:
    return math.cos(phi) / math.sqrt(1 - _E2 * math.sin(phi) ** 2)


_P1, _P2 = math.radians(-18), math.radians(-36)
_N = (_m(_P1) ** 2 - _m(_P2) ** 2) / (_q(math.sin(_P2)) - _q(math.sin(_P1)))
_C = _m(_P1) ** 2 + _N * _q(math.sin(_P1))
_RHO0 = _A * math.sqrt(_C - _N * _q(0.0)) / _N


def to_albers(lon: Column, lat: Column, crs: str = "EPSG:4283") -> dict[str, Column]:
    """x, y in EPSG:3577, whose datum is GDA94: places of another datum are shifted first."""
    at = shift_datum(lon, lat, crs, "EPSG:4283")
    lon, lat = at["lon"], at["lat"]
    s = F.sin(F.radians(lat))
    q = (1 - _E2) * (s / (1 - _E2 * s * s) - F.ln((1 - _E * s) / (1 + _E * s)) / (2 * _E))
    rho = _A * F.sqrt(F.lit(_C) - _N * q) / _N
    theta = _N * F.radians(lon - 132)
    return {"x": rho * F.sin(theta), "y": _RHO0 - rho * F.cos(theta)}


def from_albers(x: Column, y: Column) -> dict[str, Column]:
    """The inverse, by five steps of the usual latitude series."""
    flip = -1.0 if _N < 0 else 1.0
    rho = F.hypot(x, F.lit(_RHO0) - y)
    theta = F.atan2(flip * x, flip * (F.lit(_RHO0) - y))
    q = (F.lit(_C) - (rho * _N / _A) ** 2) / _N

    def step(phi: Column, q: Column) -> Column:
        s = F.sin(phi)
        w = 1 - _E2 * s * s
        return phi + w * w / (2 * F.cos(phi)) * (q / (1 - _E2) - s / w + F.ln((1 - _E * s) / (1 + _E * s)) / (2 * _E))

    phi = F.aggregate(F.array_repeat(q, 5), F.asin(q / 2), step)
    return {"lon": 132 + F.degrees(theta) / _N, "lat": F.degrees(phi)}


# The published seven parameters from GDA94 to GDA2020 (metres, seconds of arc, parts per million), coordinate frame rotation.
_SHIFT = (0.06155, -0.01087, -0.04019)
_TURN = (-0.0394924, -0.0327221, -0.0328979)
_SCALE = -0.009994


def to_geocentric(lon: Column, lat: Column) -> dict[str, Column]:
    """Earth-centred metres of a place on the GRS80 ellipsoid."""
    s = F.sin(F.radians(lat))
    n = _A / F.sqrt(1 - _E2 * s * s)
    flat = n * F.cos(F.radians(lat))
    return {"gx": flat * F.cos(F.radians(lon)), "gy": flat * F.sin(F.radians(lon)), "gz": n * (1 - _E2) * s}


def from_geocentric(x: Column, y: Column, z: Column) -> dict[str, Column]:
    """Degrees of a place near the ellipsoid, in closed form; within a micrometre there."""
    p = F.hypot(x, y)
    b = _A * (1 - _FLAT)
    u = F.atan2(z * _A, p * b)
    lat = F.atan2(z + (_A * _A - b * b) / b * F.sin(u) ** 3, p - _E2 * _A * F.cos(u) ** 3)
    return {"lon": F.degrees(F.atan2(y, x)), "lat": F.degrees(lat)}


def shift_datum(lon: Column, lat: Column, source: str, target: str) -> dict[str, Column]:
    """lon, lat of a place in another datum: EPSG:4283 (GDA94; EPSG:4326 counts as it) and EPSG:7844 (GDA2020), some 1.8 m apart.

    The way back has the parameters' signs turned, which is exact to a tenth of a millimetre.
    """
    known = {"EPSG:4283": 0, "EPSG:4326": 0, "EPSG:7844": 1}
    if source not in known or target not in known:
        raise ValueError(f"no shift from {source} to {target}")
    way = known[target] - known[source]
    if way == 0:
        return {"lon": lon, "lat": lat}
    g = to_geocentric(lon, lat)
    tx, ty, tz = (way * t for t in _SHIFT)
    rx, ry, rz = (way * math.radians(r / 3600) for r in _TURN)
    k = 1 + way * _SCALE * 1e-6
    x, y, z = g["gx"], g["gy"], g["gz"]
    return from_geocentric(tx + k * (x + rz * y - ry * z), ty + k * (y - rz * x + rx * z), tz + k * (z + ry * x - rx * y))
