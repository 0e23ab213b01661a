"""Geometry of polygons with holes and parts by plain arithmetic, dealt out over tasks."""

from pyspark.sql import functions as F

from lodestrata.functions import geometry as G
from lodestrata.plans.fixtures import compound_polygons, footprint_polygons
from tests.conftest import SF
from tests.test_spatial import made


def box(x1, y1, x2, y2):
    return [(float(x), float(y)) for x, y in ((x1, y1), (x2, y1), (x2, y2), (x1, y2), (x1, y1))]


def test_measures_and_reasons(spark):
    shapes = {"holed": [box(0, 0, 10, 10), box(2, 2, 4, 4)], "island": [box(0, 0, 10, 10), box(2, 2, 8, 8), box(4, 4, 5, 5)], "apart": [box(20, 20, 22, 22), box(0, 0, 2, 2)], "bow": [[(0.0, 0.0), (4.0, 4.0), (4.0, 0.0), (0.0, 6.0), (0.0, 0.0)]]}
    rings = F.col("rings")
    centre = G.centroid(rings)
    p = made(spark, shapes).withColumns({"p": G.interior_point(rings), "reason": G.unusable_reason(rings)})
    got = {r.id: r for r in p.select("id", G.area(rings).alias("a"), centre["cx"].alias("cx"), centre["cy"].alias("cy"), "reason", G.contains(G.edges(rings), F.col("p.x"), F.col("p.y")).alias("inside")).collect()}
    assert {k: (r.a, r.reason) for k, r in got.items() if k != "bow"} == {"holed": (96.0, None), "island": (65.0, None), "apart": (8.0, None)}
    assert got["bow"].reason == "self_intersecting" and all(r.inside for k, r in got.items() if k != "bow")
    assert abs(got["holed"].cx - (500 - 4 * 3) / 96) < 1e-9 and abs(got["apart"].cx - 11) < 1e-9
    assert abs(got["island"].cx - (500 - 36 * 5 + 4.5) / 65) < 1e-9


def test_polygons_are_dealt_out_over_tasks(spark):
    assert footprint_polygons(spark, SF).rdd.getNumPartitions() == compound_polygons(spark, SF).rdd.getNumPartitions() == 4
