"""Coverage and volumes from many items of few tiles."""

from lodestrata.operators import catalogue as K


def test_items_meet_sets_of_tiles_and_not_footprints(spark, monkeypatch):
    tiles = spark.createDataFrame([(f"f{i}", t, 0) for i in range(50) for t in ((0, 1) if i % 2 else (0,))], "footprint_id string, tx int, ty int")
    items = spark.createDataFrame([("a", 0, 0, 2000 + i % 2) for i in range(300)] + [("a", 1, 0, 2000), ("b", 1, 0, 2005), ("b", 9, 9, 2005), ("b", 0, 0, None)], "source_id string, tx int, ty int, item_year int")
    joined, inner = [], K._items_of_sets
    monkeypatch.setattr(K, "_items_of_sets", lambda *args: joined.append(inner(*args).count()) or inner(*args))
    got = {(r.footprint_id, r.source_id): r.n_years for r in K.footprint_epochs(tiles, items).collect()}
    assert got == {(f"f{i}", s): n for i in range(50) for s, n in ((("a", 2), ("b", 1)) if i % 2 else (("a", 2), ("b", 0)))}
    years = sorted(tuple(r) for r in K.epoch_covered_years(tiles, items).filter("footprint_id IN ('f0', 'f1')").collect())
    assert years == [("f0", 2000), ("f0", 2001), ("f1", 2000)]
    assert joined == [8, 8]  # 300 items and 50 footprints are two tile-years and two sets
    assert K.touched_items(tiles, items).count() == 5


def test_sites_of_one_place_are_covered_alike(spark):
    sites = spark.createDataFrame([(i, 10.0, 5.0) for i in range(30)] + [(30, 25.0, 5.0), (31, None, 5.0), (32, 2.0, None)], "row_no int, x double, y double")
    items = spark.createDataFrame([("a", 2000, x, 0.0, x + 10, 10.0) for x in (0.0, 10.0)] + [("a", 2001, 10.0, 0.0, 20.0, 10.0), ("b", 2000, 0.0, 0.0, 10.0, 10.0), ("b", None, 0.0, 0.0, 10.0, 10.0)], "source_id string, item_year int, minx double, miny double, maxx double, maxy double")
    got = {r.row_no: (r.a, r.b) for r in K.epoch_coverage(sites, items, ("a", "b"), 10.0).collect()}
    assert got == {**dict.fromkeys(range(30), (2, 1)), 30: (0, 0), 31: (None, None), 32: (None, None)}
