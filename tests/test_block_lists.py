"""Pairs that are given out come from lists: each once, and none is shuffled."""

import random

import pytest
from pyspark.sql import functions as F

from lodestrata.functions import geometry as G
from lodestrata.operators import meeting as M
from lodestrata.operators import spatial as X
from lodestrata.plans import registry
from tests.conftest import SF
from tests.test_first_matches import KINDS, _rows
from tests.test_meeting import _polygons


def _above_blocks(df):
    """The part of a plan that lies above the meeting of blocks."""
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapGroupsInArrow" in text
    return text.split("FlatMapGroupsInArrow")[0]


def _points(spark, n=300):
    rng = random.Random(6)
    rows = [(i, None if i % 50 == 7 else float(rng.randrange(-10, 70)), float("nan") if i % 50 == 9 else float(rng.randrange(-10, 70))) for i in range(n)]
    return spark.createDataFrame([*rows, *[(n + i, 5.0, 5.0) for i in range(9)]], "k long, x double, y double")


@pytest.mark.parametrize("strict", (False, True))
def test_points_and_polygons_meet_as_lists(spark, monkeypatch, strict):
    """As a test of every pair has them, in one block and many, with lists and batches of any length."""
    polygons = _polygons(spark, 40, 5, KINDS).select("id", "rings").dropDuplicates(["id"])
    polygons = polygons.unionByName(polygons.limit(9).withColumn("id", F.concat(F.lit("again"), "id"))).unionByName(polygons.limit(3).withColumn("id", F.lit(None).cast("string")))
    points, es = _points(spark), G.edges(F.col("rings"))
    test = (G.contains if strict else G.covers)(F.col("_e"), F.col("x"), F.col("y"))
    want = _rows(points.filter("x IS NOT NULL AND NOT isnan(y)").crossJoin(polygons.withColumn("_e", es).filter(F.size("_e") > 0)).filter(test).select("k", "x", "y", "id"))
    assert len(want) > 200
    for block, members, listed in ((8192, 1024, 1 << 18), (7, 2, 3)):
        monkeypatch.setattr(X, "MEMBERS", members)
        monkeypatch.setattr(M, "LISTED", listed)
        assert _rows(X.points_in_polygons(points, polygons, "id", 10.0, strict, block=block)) == want


@pytest.mark.parametrize("name", ("j02_multipart_covered_by", "p32_high_confidence"))
def test_no_pair_of_points_is_shuffled(spark, monkeypatch, name):
    monkeypatch.setattr(X, "crosswalk_matches", lambda *a, **k: 1 / 0)
    assert "Exchange" not in _above_blocks(registry.QUERIES[name](spark, SF))


def _overlaps(polygons):
    a, b = (polygons.select(F.col("id").alias(n), G.edges(F.col("rings")).alias(f"_{n}")).filter(F.size(f"_{n}") > 0) for n in "ab")
    return a.join(b, F.col("a") < F.col("b")).filter(G.interiors_overlap(F.col("_a"), F.col("_b"))).select("a", "b")


def test_overlaps_come_from_lists_and_counts(spark, monkeypatch):
    """Pairs and their summary are those of a test of every pair; neither lists a pair of shapes for a shuffle."""
    polygons = _polygons(spark, 60, 9, KINDS).select("id", "rings").dropDuplicates(["id"])
    polygons = polygons.unionByName(polygons.limit(12).withColumn("id", F.concat("id", F.lit("0")))).localCheckpoint()
    pairs = _overlaps(polygons)
    want, text = _rows(pairs), F.concat_ws("|", "a", "b")
    total = _rows(pairs.agg(F.count("*"), F.min(text), F.max(text)))
    assert len(want) > 200
    monkeypatch.setattr(X, "polygon_pairs", lambda *a, **k: 1 / 0)
    assert "Exchange" not in _above_blocks(X.overlapping_pairs(polygons, "id", 10.0))
    for block, members, listed in ((8192, 1024, 1 << 18), (9, 2, 3)):
        monkeypatch.setattr(X, "MEMBERS", members)
        monkeypatch.setattr(M, "LISTED", listed)
        assert _rows(X.overlapping_pairs(polygons, "id", 10.0, block)) == want
    monkeypatch.setattr(X, "overlapping_pairs", lambda *a, **k: 1 / 0)
    assert _rows(X.overlap_summary(polygons, "id", 10.0, 9)) == total
    assert _rows(X.overlap_summary(polygons.limit(1), "id", 10.0)) == ["(0, None, None)"]
    monkeypatch.undo()
    barred = polygons.withColumn("id", F.concat("id", F.lit("|")))
    assert _rows(X.overlap_summary(barred, "id", 10.0)) == _rows(_overlaps(barred).agg(F.count("*"), F.min(text), F.max(text)))


def test_regions_are_judged_by_shape_and_pairs_are_not_listed(spark, monkeypatch):
    """Region checks test each shape's geometry once, where no filter can take it back to the rows that are read, and only count pairs."""
    kept, cut = [], X.cut
    monkeypatch.setattr(X, "cut", lambda df: kept.append(cut(df)) or kept[-1])
    monkeypatch.setattr(X, "overlapping_pairs", lambda *a, **k: 1 / 0)
    monkeypatch.setattr(X, "_overlapping", lambda *a, **k: 1 / 0)
    checks = registry.QUERIES["v11_region_checks"](spark, SF)
    assert {r.check: r.n > 0 for r in checks.collect()} == dict.fromkeys(("null_name", "unusable", "missing_region", "duplicate_name"), True) | {"overlap": False}
    assert kept[0].columns == ["_shape", "rings", "_bad"] and kept[0].select("_shape").distinct().count() == kept[0].count()
    assert "lambda" not in checks._jdf.queryExecution().optimizedPlan().toString()
