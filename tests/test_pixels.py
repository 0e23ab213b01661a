"""Runs of grid columns against a test of every point."""

import pytest
from pyspark.sql import functions as F

from lodestrata.functions import geometry as G
from lodestrata.operators import pixels as P
from lodestrata.operators.contracts import Refused
from tests.test_spatial import made, star

SHAPES = {
    "star": [star(14, 50.3, 49.1, 40)],
    "holed": [[(0.0, 0.0), (40.0, 0.0), (40.0, 40.0), (0.0, 40.0), (0.0, 0.0)], [(10.0, 10.0), (30.0, 10.0), (30.0, 30.0), (10.0, 30.0), (10.0, 10.0)]],
    "diamond": [[(60.0, 20.0), (80.0, 40.0), (60.0, 60.0), (40.0, 40.0), (60.0, 20.0)]],
    "tooth": [[(0.0, 60.0), (10.0, 80.0), (20.0, 60.0), (30.0, 80.0), (40.0, 60.0), (40.0, 90.0), (0.0, 90.0), (0.0, 60.0)]],
    "sliver": [[(5.2, 5.2), (5.4, 5.2), (5.4, 5.4), (5.2, 5.2)]],
}


@pytest.mark.parametrize("strict", [True, False])
@pytest.mark.parametrize(("x0", "step"), [(0.0, 5.0), (0.5, 1.0), (0.1, 0.7)])
def test_runs_hold_what_points_do(spark, strict, x0, step):
    shapes = made(spark, SHAPES)
    n = int(100 / step)
    test = G.contains if strict else G.covers
    grid = spark.range(n * n).select((F.col("id") % n).alias("ix"), F.floor(F.col("id") / n).alias("iy")).withColumns({"x": x0 + F.col("ix") * step, "y": x0 + F.col("iy") * step})
    want = grid.join(shapes.withColumn("e", G.edges(F.col("rings"))), test(F.col("e"), F.col("x"), F.col("y"))).select("id", "ix", "iy").collect()
    got = P.build_assignment(shapes, "id", x0, x0, step, step, n, n, strict).select("id", "ix", "iy").collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want)) and len(got) > 30


def test_members_out_of_bounds_and_missing_tiles_are_refused(spark):
    pixels = spark.createDataFrame([("t", 0, 0, 1.0)], "tile string, prow int, pcol int, v double")
    tiles = spark.createDataFrame([("t", 2, 3)], "tile string, height int, width int")
    ask = lambda *rows: P.read_member_values(pixels, spark.createDataFrame(list(rows), "tile string, prow int, pcol int"), ["tile", "prow", "pcol"], tiles)
    assert sorted((r.prow, r.v) for r in ask(("t", 0, 0), ("t", 1, 2)).collect()) == [(0, 1.0), (1, None)]
    for row, said in ((("t", 2, 0), "out_of_bounds: 1"), (("t", 0, 3), "out_of_bounds: 1"), (("t", -1, 0), "out_of_bounds: 1"), (("u", 0, 0), "missing_tile: 1")):
        with pytest.raises(Refused, match=said):
            ask(row)
