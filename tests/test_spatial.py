"""Grid joins against plain point tests: crowded cells, polygons of many corners, refused ids."""

import math
import random

import pytest
from pyspark.sql import functions as F

from lodestrata.operators import spatial as X
from lodestrata.operators.contracts import Refused

RINGS = "id string, rings array<array<struct<x:double,y:double>>>"


def star(n, cx, cy, r):
    """A closed ring of n corners that swings in and out."""
    out = [(cx + r * (1 - 0.5 * (i % 2)) * math.cos(2 * math.pi * i / n), cy + r * (1 - 0.5 * (i % 2)) * math.sin(2 * math.pi * i / n)) for i in range(n)]
    return [*out, out[0]]


def inside(rings, x, y):
    odd = False
    for ring in rings:
        for (x1, y1), (x2, y2) in zip(ring, ring[1:], strict=False):
            if (y1 > y) != (y2 > y) and x < x1 + (y - y1) * (x2 - x1) / (y2 - y1):
                odd = not odd
    return odd


def distance(rings, x, y):
    if inside(rings, x, y):
        return 0.0
    best = math.inf
    for ring in rings:
        for (x1, y1), (x2, y2) in zip(ring, ring[1:], strict=False):
            dx, dy = x2 - x1, y2 - y1
            t = min(max(((x - x1) * dx + (y - y1) * dy) / (dx * dx + dy * dy), 0), 1)
            best = min(best, math.hypot(x - x1 - t * dx, y - y1 - t * dy))
    return best


def made(spark, polygons):
    return spark.createDataFrame([(k, [[{"x": a, "y": b} for a, b in ring] for ring in rings]) for k, rings in polygons.items()], RINGS)


POLYGONS = {"star": [star(40, 520, 480, 400)], "holed": [star(30, 1500, 300, 300), star(12, 1500, 300, 90)], "parts": [star(20, 300, 1500, 200), star(20, 900, 1500, 150)], "small": [star(8, 510, 500, 20)]}


@pytest.mark.parametrize("crowd", [10**6, 40, 1])
def test_points_meet_the_same_polygons_however_cells_are_split(spark, crowd):
    rng = random.Random(1)
    places = [(i, rng.uniform(-100, 2000), rng.uniform(-100, 1900)) for i in range(600)] + [(1000 + i, rng.uniform(480, 540), rng.uniform(470, 530)) for i in range(300)]
    points = spark.createDataFrame([*places, (5000, None, 1.0), (5001, float("nan"), 1.0)], "k int, x double, y double")
    got = sorted((r.k, r.id) for r in X.points_in_polygons(points, made(spark, POLYGONS), "id", 250.0, crowd=crowd).collect())
    assert got == sorted((k, name) for k, x, y in places for name, rings in POLYGONS.items() if inside(rings, x, y))
    near = {(r.k, r.id): r.distance_m for r in X.within_distance(points, made(spark, POLYGONS), "id", 120.0, 250.0, crowd).collect()}
    want = {(k, name): d for k, x, y in places for name, rings in POLYGONS.items() if (d := distance(rings, x, y)) <= 120}
    assert near.keys() == want.keys() and all(abs(near[k] - want[k]) < 1e-9 for k in want)


def test_crowded_cells_become_small(spark):
    """One cell with all points: after the split no part of it holds more than a sixtieth, and none lists half of the edges of a large polygon."""
    n = 40_000
    points = spark.range(n).select(F.col("id").alias("k"), (F.col("id") % 200 / 200 * 1000).alias("x"), (F.floor(F.col("id") / 200) / 200 * 1000).alias("y"))
    large = made(spark, {"large": [star(20_000, 500, 500, 490)]})
    joined = X.grid_join(points, large, "id", 1000.0, crowd=1000)
    per = joined.groupBy("_gx", "_gy", "_sx", "_sy").agg(F.count("*").alias("n"), F.max(F.size("_edges")).alias("edges")).collect()
    assert sum(r.n for r in per) == n and len(per) == 64 and max(r.n for r in per) <= n / 60 and max(r.edges for r in per) < 20_000 / 2


def test_crosswalk_refuses_null_and_repeated_ids(spark):
    points = spark.createDataFrame([("a", 520.0, 480.0)], "site_id string, x double, y double")
    polygons = made(spark, POLYGONS)
    assert {r.id for r in X.crosswalk(points, polygons, "id", 250.0).collect()} == {"star"}
    for bad_points, bad_polygons, said in (
        (points, polygons.unionByName(polygons.filter("id = 'star'")), "duplicate_polygon_id: 1"),
        (points, polygons.withColumn("id", F.when(F.col("id") != "star", F.col("id"))), "null_polygon_id: 1"),
        (points.unionByName(points), polygons, "duplicate_site_id: 1"),
        (points.withColumn("site_id", F.lit(None).cast("string")), polygons, "null_site_id: 1"),
    ):
        with pytest.raises(Refused, match=said):
            X.crosswalk(bad_points, bad_polygons, "id", 250.0)


def test_covered_subset_and_the_rest(spark):
    regions = made(spark, {"r": [[(0.0, 0.0), (10.0, 0.0), (10.0, 10.0), (0.0, 10.0), (0.0, 0.0)]]}).withColumnRenamed("id", "region_name")
    points = spark.createDataFrame([(1, 5.0, 5.0, "p"), (2, 10.0, 5.0, "on the boundary"), (3, 11.0, 5.0, "out"), (4, None, 5.0, "nowhere")], "row_no int, x double, y double, note string")
    covered, rest = X.split_uncovered(points, regions, 5.0)
    assert sorted(r.note for r in covered.collect()) == ["on the boundary", "p"] and sorted(r.row_no for r in rest.collect()) == [3, 4]


def plain_meet(one, two):
    """Whether two polygons share a point, by every edge of both and a corner of every ring."""
    edges = lambda rings: [e for r in rings for e in zip(r, r[1:], strict=False)]

    def cross(e, p):
        (x1, y1), (x2, y2) = e
        return (x2 - x1) * (p[1] - y1) - (y2 - y1) * (p[0] - x1)

    def meets(a, b):
        return cross(a, b[0]) * cross(a, b[1]) < 0 and cross(b, a[0]) * cross(b, a[1]) < 0

    return any(meets(a, b) for a in edges(one) for b in edges(two)) or any(inside(two, *r[0]) for r in one) or any(inside(one, *r[0]) for r in two)


@pytest.mark.parametrize("cell", [500.0])
def test_polygons_of_many_corners_meet(spark, cell):
    """Polygons whose edges meet in one of many cells only, or that lie within another, in its hole or apart."""
    rng = random.Random(4)
    one = {f"a{i}": [star(rng.choice([6, 24]), rng.uniform(0, 2000), rng.uniform(0, 2000), rng.uniform(20, 500))] for i in range(12)} | {"ring": [star(60, 1000, 1000, 900), star(50, 1000, 1000, 400)]}
    two = {f"b{i}": [star(rng.choice([6, 24]), rng.uniform(0, 2000), rng.uniform(0, 2000), rng.uniform(20, 500))] for i in range(12)} | {"in_hole": [star(20, 1000, 1000, 50)], "far": [star(20, 9000, 9000, 50)]}
    got = sorted(tuple(r) for r in X.polygon_pairs(made(spark, one).withColumnRenamed("id", "a"), made(spark, two).withColumnRenamed("id", "b"), "a", "b", cell).collect())
    assert got == sorted((k, n) for k, p in one.items() for n, q in two.items() if plain_meet(p, q))


def test_copies_of_places_and_shapes_are_matched_once(spark, monkeypatch):
    """Forty points of one place in thirty copies of one polygon: one pair is tested, and no link is lost."""
    tested, join = [], X.grid_join

    def watched(points, polygons, *args, **named):
        tested.append((points.count(), polygons.count()))
        return join(points, polygons, *args, **named)

    monkeypatch.setattr(X, "grid_join", watched)
    points = spark.createDataFrame([(i, f"s{i}", 5.0, 5.0) for i in range(40)] + [(40, "far", 12.0, 5.0), (41, "none", None, 5.0)], "row_no int, site_id string, x double, y double")
    square = [[(0, 0), (10, 0), (10, 10), (0, 10), (0, 0)]]
    polygons = made(spark, {f"p{i:02}": [[(float(a), float(b)) for a, b in square[0]]] for i in range(30)})
    assert len(X.points_in_polygons(points, polygons, "id", 20.0).collect()) == 1200
    counts = {r.row_no: r.n for r in X.count_intersecting(points, polygons, "id", 20.0).collect()}
    assert counts == {**dict.fromkeys(range(40), 30), 40: 0, 41: None}
    rows = X.crosswalk(points.filter("x IS NOT NULL"), polygons, "id", 20.0, 5.0).collect()
    assert len(rows) == 41 * 30 and {(r.stage, r.distance_m, r.confidence, r.ambiguity_n, r.shared_by_n) for r in rows} == {("containment", 0.0, "high", 30, 41), ("proximity", 2.0, "low", 30, 41)}
    firsts = {r.site_id: (r.id, r.confidence) for r in X.first_matches(points, polygons, "id", 20.0, 5.0).collect()}
    assert firsts == {**{f"s{i}": ("p00", "high") for i in range(40)}, "far": ("p00", "low"), "none": (None, "none")}
    assert max(tested) == (2, 1)
    assert X.overlapping_pairs(polygons, "id", 20.0).count() == 30 * 29 // 2
    fires = polygons.withColumn("fire_year", F.lit(2000))
    assert {(r.fire_year, r.n) for r in X.fire_year_counts(polygons.withColumnRenamed("id", "footprint_id"), fires, 20.0).collect()} == {(2000, 30)}
