"""First matches by blocks and regions by place: the same rows as from all matches."""

import random

from pyspark.sql import functions as F

from lodestrata.operators import register as R
from lodestrata.operators import spatial as X
from tests.test_meeting import _polygons

KINDS = ("box", "turned", "diamond", "frame", "two", "wedge", "flat", "none")


def _rows(df):
    return sorted(map(str, map(tuple, df.collect())))


def test_first_matches_are_the_crosswalks_first_rows(spark, monkeypatch):
    polygons = _polygons(spark, 30, 5, KINDS).dropDuplicates(["id"])
    polygons = polygons.unionByName(polygons.limit(7).withColumn("id", F.concat(F.lit("again"), "id")))  # shapes that come twice
    rng = random.Random(6)
    points = spark.createDataFrame([(f"S{i}", float(rng.randrange(-30, 90)), float(rng.randrange(-30, 90))) for i in range(400)] + [(f"T{i}", 5.0, 5.0) for i in range(5)], "site_id string, x double, y double")
    want = X.crosswalk(points, polygons, "id", 10.0, 9.0).groupBy("site_id").agg(F.min("id"), F.min("confidence"), F.min("ambiguity_n").cast("long"))
    want = _rows(want)
    assert {w for r in want for w in ("high", "medium", "low", "none") if w in r} == {"high", "medium", "low", "none"}
    monkeypatch.setattr(X, "crosswalk_matches", lambda *a, **k: 1 / 0)  # no match is listed
    for block in (8192, 11):
        assert _rows(X.first_matches(points, polygons, "id", 10.0, 9.0, block)) == want


def test_included_sites_are_the_populations(spark):
    nan = float("nan")
    sites = spark.createDataFrame([("a", 1.0, 2.0), ("b", 1.0, 2.0), ("b", None, None), (None, 1.0, 1.0), ("c", None, 1.0), ("d", nan, 1.0), ("e", 0.0, 0.0)], "site_id string, x double, y double")
    assert _rows(R.included_sites(sites)) == _rows(R.crosswalk_population(sites).filter("included").select("site_id", "x", "y")) != []


def test_regions_are_found_by_place(spark):
    """Points of one place share their region; those without a place have none."""
    regions = spark.createDataFrame([("west", 0.0, 5.0), ("mid", 5.0, 9.0)], "region_name string, a double, b double")
    corner = lambda x, y: f"named_struct('x', {x}, 'y', {y})"
    regions = regions.withColumn("rings", F.expr(f"array(array({corner('a', '0D')}, {corner('b', '0D')}, {corner('b', '9D')}, {corner('a', '9D')}, {corner('a', '0D')}))"))
    points = spark.createDataFrame([(1, 5.0, 1.0), (2, 5.0, 1.0), (3, 1.0, 1.0), (4, 50.0, 1.0), (5, None, 1.0)], "row_no long, x double, y double")
    got = X.assign_region(points, regions, {"mid": "m"}, "other", 20.0)
    assert sorted(map(tuple, got.collect())) == [(1, "mid", "m", 2), (2, "mid", "m", 2), (3, "west", "other", 1), (4, None, None, 0), (5, None, None, 0)]
