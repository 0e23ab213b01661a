"""Steps that must not grow with copies: digests by shape, windows by pixel; thresholds without cells."""

from pyspark.sql import functions as F

from lodestrata.operators import pixels as P
from lodestrata.operators import threshold as T
from tests.test_spatial import POLYGONS, made


def test_no_cells_no_threshold(spark):
    assert T.evaluate(spark.createDataFrame([], "support_px int, name string, passed boolean")).collect() == []
    assert T.evaluate(spark.createDataFrame([(144, "a", True)], "support_px int, name string, passed boolean")).collect() == []
    assert [tuple(r) for r in T.evaluate(spark.createDataFrame([(9, "a", False)], "support_px int, name string, passed boolean")).collect()] == [(144, False, 9, "a")]


def test_digests_by_shape_are_those_of_listed_members(spark):
    polygons = made(spark, {**POLYGONS, "again": POLYGONS["star"], "west": [[(-90.0, -70.0), (35.0, -70.0), (35.0, 40.0), (-90.0, 40.0), (-90.0, -70.0)]]})
    args = ("id", 0.0, 0.0, 30.0, 4)
    want = P.member_digests(P.pixel_members(polygons, *args), "id")
    assert sorted(map(tuple, P.pixel_digests(polygons, *args).collect())) == sorted(map(tuple, want.collect()))


def test_points_of_one_pixel_share_its_window(spark, monkeypatch):
    pixels = spark.range(100).select(F.lit(1).alias("tile"), F.floor(F.col("id") / 10).cast("int").alias("prow"), (F.col("id") % 10).cast("int").alias("pcol"), F.when(F.col("id") != 11, F.col("id").cast("double")).alias("v"))
    points = spark.createDataFrame([(i, 1, 1, 1) for i in range(50)] + [(50, 1, 0, 0), (51, 2, 5, 5)], "key int, tile int, prow int, pcol int")
    got = {r.key: (r.n_member, r.n_valid, r.value) for r in P.window_sample(pixels, points, 3, "v").collect()}
    assert got == {**dict.fromkeys(range(50), (9, 8, 11.0)), 50: (4, 3, 11 / 3), 51: (0, 0, None)}
