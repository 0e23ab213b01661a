"""Hand-computed values, boundary cases, refusals, sinks and scans."""

import hashlib
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from lodestrata.functions import geometry as G
from lodestrata.functions import scalars as S
from lodestrata.operators import contracts as C
from lodestrata.operators import context as K
from lodestrata.operators import export as E
from lodestrata.operators import spatial as X
from lodestrata.operators import subsample as U
from lodestrata.operators import threshold as T
from lodestrata.operators import trajectory as J
from lodestrata.sources import tables as W


def column(spark, values, kind, expr):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r.o for r in df.select("i", expr(F.col("v")).alias("o")).orderBy("i").collect()]


def test_format_pct(spark):
    given = ["50.00", "0", "0.0", "007.10", ".5", "Unknown", " ", None, "1e2", "12.3.4", "+5", "100", "33.333333333333333333333"]
    assert column(spark, given, "string", S.format_pct) == ["50", "0", "0", "7.1", "0.5", None, None, None, "100", "12.3.4", "5", "100", "33.333333333333333333333"]


def test_commodity_first_rule_wins(spark):
    assert column(spark, ["Au, Fe", "au", "Auriferous", " ", None, "zrn"], "string", S.classify_commodity) == ["iron_ore", "gold", "other", None, None, "mineral_sands"]


def test_shape_boundaries(spark):
    assert column(spark, [0.19, 0.2, 0.4999, 0.5, 1.0, 1.1, 0.0, float("nan"), None], "double", S.shape_class) == ["elongated", "intermediate", "intermediate", "compact", "compact", None, None, None, None]


def test_geometry_values(spark):
    assert column(spark, ["POINT (1 2)", " srid=4326;polygon((0 0))", "MULTIPOINT EMPTY", "a POINT (1 2)", None], "string", S.is_wkt) == [True, True, True, False, False]
    assert S.has_geometry_name("Geom_wkb") and S.has_geometry_name("LON") and not S.has_geometry_name("longest")


def square(x, y, half):
    x, y, half = float(x), float(y), float(half)
    return [[(x - half, y - half), (x + half, y - half), (x + half, y + half), (x - half, y + half), (x - half, y - half)]]


def test_cover_boundary_and_hole(spark):
    hole = square(0, 0, 10) + square(0, 0, 5)
    df = spark.createDataFrame([(hole, float(x), float(y)) for x, y in [(10, 0), (10, 10), (7, 0), (0, 0), (5, 0), (11, 0)]], f"rings {G.RINGS}, x double, y double")
    es = G.edges(F.col("rings"))
    rows = df.select(G.covers(es, F.col("x"), F.col("y")).alias("c"), G.contains(es, F.col("x"), F.col("y")).alias("k"), G.area(F.col("rings")).alias("a")).collect()
    assert [r.c for r in rows] == [True, True, True, False, True, False]
    assert [r.k for r in rows] == [False, False, True, False, False, False]
    assert rows[0].a == 300


def _box(x1, y1, x2, y2):
    return [(x1, y1), (x2, y1), (x2, y2), (x1, y2), (x1, y1)]


def _polygons(spark, *rings):
    return spark.createDataFrame([(i, r) for i, r in enumerate(rings)], f"id long, rings {G.RINGS}")


def test_several_parts_holes_and_islands(spark):
    two = [_box(0.0, 0.0, 2.0, 2.0), _box(10.0, 0.0, 14.0, 4.0)]
    island = [_box(4.0, 4.0, 6.0, 6.0), _box(0.0, 0.0, 10.0, 10.0), _box(2.0, 2.0, 8.0, 8.0)]  # in a hole, in any order
    touching = [_box(0.0, 0.0, 4.0, 4.0), [(0.0, 0.0), (2.0, 0.5), (2.0, 2.0), (0.0, 0.0)]]  # the hole shares a corner
    c = G.centroid(F.col("rings"))
    rows = _polygons(spark, two, island, touching).select("id", G.area(F.col("rings")).alias("a"), c["cx"].alias("cx"), c["cy"].alias("cy")).orderBy("id").collect()
    assert (rows[0].a, rows[0].cx, rows[0].cy) == (20.0, pytest.approx((4 * 1 + 16 * 12) / 20), pytest.approx((4 * 1 + 16 * 2) / 20))
    assert (rows[1].a, rows[1].cx, rows[1].cy) == (100.0 - 36 + 4, 5.0, 5.0)
    assert rows[2].a == 16.0 - 1.5


def test_polygons_meet_by_any_part(spark):
    two, hole = [_box(0.0, 0.0, 2.0, 2.0), _box(10.0, 0.0, 14.0, 4.0)], [_box(0.0, 0.0, 10.0, 10.0), _box(2.0, 2.0, 8.0, 8.0)]
    meets = lambda a, b: _polygons(spark, a).select(G.polygons_intersect(G.edges(F.col("rings")), G.edges(F.lit(None).cast(G.RINGS) if b is None else F.array(*[F.array(*[F.struct(F.lit(x).alias("x"), F.lit(y).alias("y")) for x, y in r]) for r in b]))).alias("m")).first().m
    assert meets(two, [_box(11.0, 1.0, 12.0, 2.0)]) and meets([_box(9.0, -1.0, 20.0, 5.0)], two) and meets([_box(-1.0, -1.0, 3.0, 3.0)], two)
    assert not meets(two, [_box(4.0, 0.0, 6.0, 2.0)]) and not meets(hole, [_box(3.0, 3.0, 4.0, 4.0)]) and meets(hole, [_box(1.0, 1.0, 1.5, 1.5)])


def test_interior_point_of_a_ring_shape(spark):
    df = spark.createDataFrame([(square(0, 0, 10) + square(0, 0, 5),)], f"rings {G.RINGS}").withColumn("p", G.interior_point(F.col("rings")))
    assert df.select(G.contains(G.edges(F.col("rings")), F.col("p.x"), F.col("p.y"))).first()[0]


def test_unusable(spark):
    bow = [[(0.0, 0.0), (2.0, 2.0), (2.0, 0.0), (0.0, 3.0), (0.0, 0.0)]]
    df = spark.createDataFrame([(1, None), (2, []), (3, [[(0.0, 0.0), (1.0, 1.0), (2.0, 2.0), (0.0, 0.0)]]), (4, bow), (5, square(0, 0, 1))], f"i int, rings {G.RINGS}")
    assert [r.o for r in df.select("i", G.unusable_reason(F.col("rings")).alias("o")).orderBy("i").collect()] == ["null", "empty", "degenerate", "self_intersecting", None]


def test_touching_regions_do_not_overlap(spark):
    df = spark.createDataFrame([("a", square(0, 0, 10)), ("b", square(20, 0, 10)), ("c", square(25, 0, 10)), ("d", square(0, 0, 10))], f"region_name string, rings {G.RINGS}")
    assert {(r.a, r.b) for r in X.overlapping_pairs(df, "region_name", 50.0).collect()} == {("b", "c"), ("a", "d")}


def test_albers_origin_and_probe(spark):
    df = spark.createDataFrame([(132.0, 0.0), (116.0, -32.0)], "lon double, lat double")
    got = df.select(*[v.alias(k) for k, v in G.to_albers(F.col("lon"), F.col("lat")).items()]).collect()
    assert got[0].x == pytest.approx(0, abs=1e-6) and got[0].y == pytest.approx(0, abs=1e-6)
    assert (got[1].x, got[1].y) == (pytest.approx(-1494548.47, abs=0.01), pytest.approx(-3581042.45, abs=0.01))


def test_crosswalk_confidences(spark):
    polygons = spark.createDataFrame([("A", square(0, 0, 100)), ("B", square(1000, 0, 100)), ("C", square(0, 0, 50))], f"footprint_id string, rings {G.RINGS}")
    points = spark.createDataFrame([("in", 0.0, 0.0), ("edge", 100.0, 0.0), ("two", 500.0, 0.0), ("one", 3000.0, 0.0), ("limit", 3100.0, 0.0), ("far", 9000.0, 0.0)], "site_id string, x double, y double")
    rows = X.crosswalk(points, polygons, "footprint_id", 500.0).collect()
    got = {(r.site_id, r.footprint_id): (r.confidence, r.ambiguity_n) for r in rows}
    assert got[("in", "A")] == ("high", 2) and got[("in", "C")] == ("high", 2) and got[("edge", "A")] == ("high", 1)
    assert got[("two", "A")] == ("low", 3) and got[("one", "B")] == ("medium", 1)
    assert got[("limit", "B")] == ("medium", 1)  # exactly 2000 m
    assert got[("far", None)] == ("none", 0)
    shuffled = X.crosswalk(points.repartition(7), polygons.repartition(3), "footprint_id", 500.0).collect()
    assert sorted(map(str, rows)) == sorted(map(str, shuffled))


def test_spearman(spark):
    rows = [("a", 1.0, 10.0), ("a", 2.0, 20.0), ("a", 2.0, 30.0), ("b", 1.0, 1.0), ("b", 1.0, 2.0), ("c", 1.0, 1.0)]
    got = {r.k: r for r in U.spearman_by_group(spark.createDataFrame(rows, "k string, x double, y double"), ["k"], "x", "y").collect()}
    assert got["a"].rho == pytest.approx(0.8660254) and got["b"].rho is None and got["b"].constant and got["c"].rho is None and not got["c"].constant


def test_eligibility_order(spark):
    register = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (4, "d"), (5, None)], "row_no int, site_id string")
    cross = spark.createDataFrame([("a", "F", "high"), ("b", "F", "low"), ("c", None, "none"), ("d", "G", "high")], "site_id string, footprint_id string, confidence string")
    support = spark.createDataFrame([("F", 100)], "footprint_id string, support_px long")
    got = lambda *a: {r.row_no: (r.trajectory_status, r.eligible, r.threshold_px) for r in T.assign_eligibility(register, cross, support, *a).collect()}
    passed = got(50, True)
    assert passed[1] == ("eligible", True, 50) and passed[2][0] == "crosswalk_not_high_confidence"
    assert passed[3][0] == passed[4][0] == passed[5][0] == "no_usable_footprint"
    assert got(150, True)[1] == ("insufficient_pixel_support", False, 150)
    assert got(144, False)[1] == ("threshold_not_computed", False, 144)
    with pytest.raises(ValueError):
        T.assign_eligibility(register, cross, support, 144, True, True)


def test_transition_gap_is_no_change(spark):
    rows = [("k", "gm5", 1990), ("k", "gm5", 1991), ("k", "gm7", 1993), ("k", "gm7", 1994), ("k", "gm8", 1995), ("k", "gm5", 1999), ("k", "gm7", 1999)]
    got = {r.year: r.adjacent for r in J.transition_years(spark.createDataFrame(rows, "key string, source_id string, year int")).collect()}
    assert got == {1990: False, 1991: False, 1993: False, 1994: True, 1995: True, 1999: True}


def test_fire_outside_window_is_still_recorded(spark):
    pairs = spark.createDataFrame([("s", "F")], "site_id string, footprint_id string")
    counts = spark.createDataFrame([("F", 2001, 2)], "footprint_id string, fire_year int, n long")
    none = spark.createDataFrame([], "footprint_id string, no_footprint_reason string")
    got = {r.year: (r.fire_status, r.fire_record_count, r.fire_coverage_status) for r in K.fire_context(pairs, counts, none, (1999, 2002), 2001).collect()}
    assert got == {1999: ("not_recorded", 0, "covered"), 2000: ("not_recorded", 0, "covered"), 2001: ("recorded", 2, "outside_window"), 2002: ("unknown", None, "outside_window")}


def test_enforce(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "i int, v string")
    with pytest.raises(C.Refused, match="no_v: 1"):
        C.enforce(C.violations(df, {"no_v": F.col("v").isNull(), "fine": F.lit(False)}, F.col("i")))
    C.enforce(C.violations(df, {"fine": F.lit(False)}))


def test_export_gate_fails_closed(spark):
    df = spark.createDataFrame([(1, "POINT (1 2)", 3.0, True), (2, "text", 4.0, True)], "i int, note string, lat double, redistribute_public boolean")
    out, dropped = E.export_public(df)
    assert out.columns == ["i"] and dropped == ["note", "lat"]
    for bad in (None, False):
        with pytest.raises(C.Refused):
            E.export_public(df.unionByName(spark.createDataFrame([(3, "", 0.0, bad)], df.schema)))
    with pytest.raises(C.Refused):
        E.export_public(df.drop("redistribute_public"))


def test_csv_codes_and_mark(spark, tmp_path):
    (tmp_path / "a.csv").write_text("﻿Code,Lat\n007,-31.5\n08,\n", encoding="utf-8")
    rows = W.scan_coded_csv(spark, str(tmp_path / "a.csv"), ["Code"]).orderBy("Code").collect()
    assert [(r.Code, r.Lat) for r in rows] == [("007", -31.5), ("08", None)]
    with pytest.raises(C.Refused):
        W.scan_coded_csv(spark, str(tmp_path / "a.csv"), ["Other"])


def test_geojson_features(spark, tmp_path):
    part = [[[0, 0], [4, 0], [4, 4], [0, 4], [0, 0]]]
    features = [{"type": "Feature", "properties": {"name": n}, "geometry": {"type": t, "coordinates": c}} for n, t, c in (("p", "Polygon", part), ("m", "MultiPolygon", [part, part]))]
    (tmp_path / "f.geojson").write_text(json.dumps({"type": "FeatureCollection", "features": features}, indent=1))
    rows = {r["name"]: r for r in W.scan_features(spark, str(tmp_path / "f.geojson"), "name", "EPSG:3577").collect()}
    assert len(rows["p"].rings) == 1 and len(rows["m"].rings) == 2 and rows["p"].maxx == 4.0
    with pytest.raises(C.Refused):
        W.scan_features(spark, str(tmp_path / "f.geojson"), "name", "EPSG:9999")


def test_catalogue_pages(spark, tmp_path):
    (tmp_path / "gm5").mkdir()
    page = {"features": [{"id": "a", "bbox": [0, 0, 1, 1], "properties": {"datetime": "2001-01-01"}, "assets": {"nir": {"href": "h"}}}, {"id": "b", "bbox": [0, 0, 1, 1], "properties": {}, "assets": {}}]}
    (tmp_path / "gm5" / "page1.json").write_text(json.dumps(page, indent=1))
    rows = W.scan_catalogue_pages(spark, f"{tmp_path}/*/*.json").collect()
    assert {(r.source_id, r.id) for r in rows} == {("gm5", "a"), ("gm5", "b")}


SCHEMA = StructType([StructField("b", DoubleType(), True), StructField("a", StringType(), False)])


def test_declared_tables(spark, tmp_path):
    df = spark.createDataFrame([("x", 1)], "a string, b int")
    W.write_declared(df, f"{tmp_path}/t", SCHEMA)
    assert spark.read.parquet(f"{tmp_path}/t").columns == ["b", "a"]
    for bad in (df.drop("b"), df.withColumn("c", F.lit(1)), df.withColumn("a", F.lit(None).cast("string"))):
        with pytest.raises(C.Refused):
            W.write_declared(bad, f"{tmp_path}/bad", SCHEMA)
    W.publish(spark, {"one": (df, SCHEMA), "two": (df, SCHEMA)}, f"{tmp_path}/all")
    assert spark.read.parquet(f"{tmp_path}/all/two").count() == 1
    with pytest.raises(C.Refused):
        W.publish(spark, {"one": (df, SCHEMA)}, f"{tmp_path}/all")


def test_append_versions(spark, tmp_path):
    df = spark.createDataFrame([("fc", 2000, 1), ("fc", 2001, 2)], "collection_id string, year int, v int")
    assert W.append_partition(df, f"{tmp_path}/p") == {("fc", 2000): 1, ("fc", 2001): 1}
    W.append_partition(df.filter("year = 2001"), f"{tmp_path}/p")
    assert {(r.year, r.part_version) for r in spark.read.parquet(f"{tmp_path}/p").collect()} == {(2000, 0), (2001, 0), (2001, 1)}
    with pytest.raises(C.Refused):
        W.append_partition(df.limit(0), f"{tmp_path}/p")


def test_file_digests(spark, tmp_path):
    (tmp_path / "a").write_bytes(b"one")
    (tmp_path / "b").write_bytes(b"two")
    sums = spark.createDataFrame([("a", hashlib.sha256(b"one").hexdigest()), ("b", "0" * 64), ("c", "1" * 64)], "name string, sha256 string")
    r = W.verify_file_digests(spark, str(tmp_path), sums).first()
    assert (r.n_ok, r.n_bad, r.n_missing) == (1, 1, 1)


def test_partition_digest_ignores_order(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    one, two = (W.data_digest(W.partition_digest(d, ["k"], ["id"]), ["k"]).first() for d in (df, df.orderBy(F.desc("id")).repartition(5)))
    assert one == two and one != W.data_digest(W.partition_digest(df.filter("id > 0"), ["k"], ["id"]), ["k"]).first()


def test_binary_geometry_and_lineage(spark):
    from lodestrata.operators import export as E

    rows = [(1, "a.bin", bytes.fromhex("0103000000") + b"x"), (2, "a.md", bytes.fromhex("0103000000")), (3, "a.json", b"OwnerName"), (4, "a.json", b"ownername"), (5, "b/a", b"see MINEDEX"), (6, "a.py", b"/home/x"), (7, "a.html", b"/home/x \xff"), (8, "x", bytes.fromhex("0108000000"))]
    got = E.audit_text(spark.createDataFrame(rows, "k int, name string, text binary"), "k", "text", "name").collect()
    assert sorted((r.k, r.rule) for r in got) == [(1, "wkb"), (3, "lineage"), (5, "lineage"), (7, "local_path")]


def test_places_in_an_order(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("v")).repartition(5)
    rows = C.numbered(df.orderBy("v"), "place").collect()
    assert sorted((r.place, r.v) for r in rows) == [(i, i) for i in range(1000)]


def test_stream_refuses_strays(spark, tmp_path):
    from lodestrata.streaming.incremental import stream_trajectories

    spark.createDataFrame([("fc", 2000, 1)], "collection_id string, year int, v int").write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema("collection_id string, year int, v int").parquet(f"{tmp_path}/in")
    expected = spark.createDataFrame([("fc", 2001)], "collection_id string, year int")
    with pytest.raises(Exception, match="nobody expects"):
        stream_trajectories(stream, expected, f"{tmp_path}/out", f"{tmp_path}/check")


def test_datum_shift_of_a_published_station(spark):
    """Alice Springs in both datums, to the centimetre."""
    degrees = lambda d, m, s: d + m / 60 + s / 3600
    old, new = (degrees(133, 53, 7.847844), -degrees(23, 40, 12.446019)), (degrees(133, 53, 7.87779), -degrees(23, 40, 12.39650))
    for (lon, lat), (x, y), way in ((old, new, ("EPSG:4283", "EPSG:7844")), (new, old, ("EPSG:7844", "EPSG:4326"))):
        r = spark.range(1).select(*[v.alias(k) for k, v in G.shift_datum(F.lit(lon), F.lit(lat), *way).items()]).first()
        assert abs(r.lon - x) * 102_000 < 0.01 and abs(r.lat - y) * 111_000 < 0.01


def test_library_does_not_need_the_subpackage():
    import pathlib

    root = pathlib.Path(__file__).parent.parent / "lodestrata"
    for f in root.rglob("*.py"):
        if "llm" not in f.parts:
            assert "llm" not in f.read_text(), f


def test_entry_without_the_subpackage(tmp_path):
    """A copy without the operators' folders still imports and has all other queries."""
    import pathlib
    import shutil
    import subprocess
    import sys

    here = pathlib.Path(__file__).parent.parent
    shutil.copytree(here, tmp_path / "r", ignore=shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "__pycache__"))
    code = "import __spark_entry__ as e; q = e.queries(); assert len(q) > 130 and not any(n.startswith('op') or n == 'pipeline' for n in q) and set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path / "r", check=True)
