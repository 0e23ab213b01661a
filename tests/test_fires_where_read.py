"""Fires are counted where they are read: copies of a shape are not shuffled."""

from pyspark.sql import functions as F

from lodestrata.functions import geometry as G
from lodestrata.operators import spatial as X
from lodestrata.plans import fixtures
from tests.conftest import SF
from tests.test_meeting import _polygons


def test_copies_of_fires_and_shapes_go_before_the_shuffle(spark, monkeypatch):
    """Rows that are kept for the blocks carry their years, and no plan that makes them sorts for first rings or deals fires out."""
    plans, cut = [], X.cut
    monkeypatch.setattr(X, "cut", lambda df: plans.append(df._jdf.queryExecution().toString()) or cut(df))
    assert "RepartitionByExpression" not in fixtures.fire_polygons(spark, SF)._jdf.queryExecution().toString()
    ours, fires = _polygons(spark, 20, 3, ("box", "frame")), _polygons(spark, 30, 4, ("box",))
    assert X.fire_year_counts(ours.withColumnRenamed("id", "footprint_id").drop("fire_year"), fires, 10.0).count() > 0
    assert len(plans) == 2 and "_years" in plans[1]
    assert not any("SortAggregate" in plan or "first(rings" in plan for plan in plans)


def test_zeros_of_either_sign_are_one_shape(spark):
    """A grouping by rings takes -0.0 for 0.0, so their digest does too; else polygons would lose their shape."""
    corner = lambda x, y: {"x": x, "y": y}
    ring = lambda z: [[corner(z, z), corner(10.0, z), corner(10.0, 10.0), corner(-0.05, 10.0), corner(z, z)]]
    polygons = spark.createDataFrame([("a", ring(0.0)), ("b", ring(-0.0))], f"footprint_id string, rings {G.RINGS}")
    fires = spark.createDataFrame([(ring(-0.0), 1990), (ring(0.0), 1990)], f"rings {G.RINGS}, fire_year long")
    assert sorted(map(tuple, X.fire_year_counts(polygons, fires, 10.0).collect())) == [("a", 1990, 2), ("b", 1990, 2)]


def test_geometry_stays_above_the_dealing(spark):
    """Filters on rings, boxes and digests, given or inferred, go below the shuffle that deals polygons out, into the few tasks that read them."""
    marked = X.shaped(fixtures.compound_polygons(spark, SF), ["compound_id"])
    listed = X._listed(X.shapes(marked), 7500.0).join(marked.select("compound_id", F.col("_shape").alias("_id")), "_id")
    below = listed._jdf.queryExecution().optimizedPlan().toString().split("RepartitionByExpression")[1:]
    assert len(below) == 2
    for part in below:
        text = part[: part.index("parquet")]
        assert not any(name in text for name in ("flatten", "lambda", "sha2", "sequence"))


def test_polygons_without_a_box_are_in_no_cell(spark):
    polygons = spark.createDataFrame([("none", []), ("hollow", [[]]), ("null", None), ("box", [[{"x": 1.0, "y": 1.0}, {"x": 2.0, "y": 1.0}, {"x": 2.0, "y": 2.0}, {"x": 1.0, "y": 1.0}]])], f"id string, rings {G.RINGS}")
    for whole in (True, False):
        assert [(r.id, r._gx, r._gy) for r in X.polygons_by_cell(polygons, "id", 10.0, whole=whole).collect()] == [("box", 0, 0)]
