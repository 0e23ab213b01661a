"""Polygons that meet in blocks: the same as geometry's predicate, on every kind of pair."""

import random

import numpy as np
from pyspark.sql import functions as F

from lodestrata.functions import geometry as G
from lodestrata.operators import meeting as M
from lodestrata.operators import spatial as X


def _ring(kind, x, y, w, h):
    box = lambda x, y, w, h: [(x - w, y - h), (x + w, y - h), (x + w, y + h), (x - w, y + h), (x - w, y - h)]
    return {
        "box": [box(x, y, w, h)],
        "turned": [box(x, y, w, h)[::-1]],
        "diamond": [[(x + w, y), (x, y + h), (x - w, y), (x, y - h), (x + w, y)]],
        "frame": [box(x, y, w, h), box(x, y, w / 2, h / 2)],
        "two": [box(x, y, w, h), box(x + 2 * w, y + 2 * h, w / 2, h / 2)],
        "wedge": [[(x - w, y - h), (x + w, y - h), (x + w, y + h), (x, y), (x - w, y - h)]],
        "flat": [[(x - w, y), (x + w, y), (x + w, y), (x - w, y), (x - w, y)]],
        "none": [],
    }[kind]


def _polygons(spark, n, seed, kinds):
    rng = random.Random(seed)
    rows = [(f"{seed}-{i}", _ring(rng.choice(kinds), *(float(rng.randrange(0, 40)) for _ in "xy"), *(float(rng.randrange(2, 14)) for _ in "wh")), rng.choice([None, 1990, 1991, 1993])) for i in range(n)]
    return spark.createDataFrame([*rows, *rows[:9], (f"{seed}-null", None, 1990)], f"id string, rings {G.RINGS}, fire_year long")


def test_counts_by_blocks_are_those_of_all_pairs(spark):
    """All kinds of pairs, null years, repeated and null polygons, one block and many."""
    kinds = ("box", "turned", "diamond", "frame", "two", "wedge", "flat", "none")
    ours, fires = _polygons(spark, 60, 1, kinds).withColumnRenamed("id", "footprint_id").drop("fire_year").distinct(), _polygons(spark, 80, 2, kinds)
    a, b = ours.select("footprint_id", G.edges(F.col("rings")).alias("a")), fires.select("fire_year", G.edges(F.col("rings")).alias("b"))
    want = a.crossJoin(b).filter((F.size("a") > 0) & (F.size("b") > 0) & G.polygons_intersect(F.col("a"), F.col("b"))).groupBy("footprint_id", "fire_year").count()
    want = sorted(map(str, map(tuple, want.collect())))
    assert len(want) > 100
    for block in (8192, 7):
        assert sorted(map(str, map(tuple, X.fire_year_counts(ours, fires, 10.0, block).collect()))) == want


def test_no_pair_is_listed_for_counts(spark, monkeypatch):
    """Pairs are neither tested one by one in lambdas nor shuffled."""
    monkeypatch.setattr(X, "polygon_pairs", lambda *a, **k: 1 / 0)
    fires = _polygons(spark, 20, 3, ("box",))
    assert X.fire_year_counts(fires.withColumnRenamed("id", "footprint_id").drop("fire_year"), fires, 10.0).count() > 0


def test_pieces_hold_all_rows(monkeypatch):
    monkeypatch.setattr(M, "EDGES", 10)
    for size in ([4] * 9, [40, 1, 1, 1], [], [0, 0, 25, 3]):
        assert [int(k) for p in M._pieces(np.arange(len(size)), np.array(size, int)) for k in p] == list(range(len(size)))
