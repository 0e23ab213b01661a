"""Column functions over the fixture views."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import geometry as G
from ..functions import scalars as S
from .fixtures import footprint_polygons, view, with_views
from .registry import query

STAGE_SQL = """CASE stage WHEN 'Operating' THEN 'operating' WHEN 'Care and Maintenance' THEN 'care_and_maintenance' WHEN 'Shut' THEN 'closed'
 WHEN 'Undeveloped' THEN 'deposit' WHEN 'Proposed' THEN 'prospect' ELSE 'other' END"""
GROUP_SQL = """CASE trim(commodity) WHEN 'Fe' THEN 'iron_ore' WHEN 'hem-mio' THEN 'iron_ore' WHEN 'Au, Ag' THEN 'gold' WHEN 'Bx' THEN 'bauxite_alumina'
 WHEN 'Ni, Co' THEN 'nickel' WHEN 'HM, Ilm' THEN 'mineral_sands' ELSE 'other' END"""
PCT_SQL = """CASE WHEN holding_pct IS NULL OR trim(holding_pct) = '' OR lower(trim(holding_pct)) = 'unknown' THEN NULL
 ELSE regexp_replace(regexp_replace(trim(holding_pct), '(\\.[0-9]*?)0+$', '\\1'), '\\.$', '') END"""
NAME_SQL = "CASE WHEN owner_name IS NULL OR trim(owner_name) = '' THEN '(owner name not stated)' ELSE trim(owner_name) END"
SORT_SQL = "lower(trim(regexp_replace(coalesce(owner_name, ''), '\\s+', ' ', 'g')))"
AREA_SQL = "CASE kind WHEN 'diamond' THEN 2 * hx * hy ELSE 4 * hx * hy END"
PERIMETER_SQL = "CASE kind WHEN 'diamond' THEN 4 * sqrt(hx * hx + hy * hy) ELSE 4 * (hx + hy) END"
COMPACT_SQL = f"(4 * pi() * ({AREA_SQL}) / (({PERIMETER_SQL}) * ({PERIMETER_SQL})))"
SHAPE_SQL = f"CASE WHEN {COMPACT_SQL} < 0.20 THEN 'elongated' WHEN {COMPACT_SQL} < 0.50 THEN 'intermediate' ELSE 'compact' END"


@query("p01_p07_site_classes", f"{with_views('sites')} SELECT row_no, {STAGE_SQL} AS inclusion_status, {GROUP_SQL} AS commodity_group FROM sites")
def site_classes(spark, sf):
    return view(spark, sf, "sites").select("row_no", S.classify_stage(F.col("stage")).alias("inclusion_status"), S.classify_commodity(F.col("commodity")).alias("commodity_group"))


@query(
    "p02_current_owners",
    f"{with_views('owners')} SELECT row_no, end_date IS NULL OR trim(end_date) = '' AS is_current, coalesce(trim(project_code), '') <> '' AS has_project FROM owners",
)
def current_owners(spark, sf):
    return view(spark, sf, "owners").select("row_no", S.is_blank(F.col("end_date")).alias("is_current"), (~S.is_blank(F.col("project_code"))).alias("has_project"))


@query(
    "p03_p06_owner_texts",
    f"{with_views('owners')} SELECT row_no, {SORT_SQL} AS sort_name, {NAME_SQL} AS owner, {PCT_SQL} AS pct, "
    f"concat({NAME_SQL}, CASE WHEN ({PCT_SQL}) IS NULL THEN ' (holding not stated)' ELSE concat(' (', {PCT_SQL}, '%)') END) AS rendered FROM owners",
)
def owner_texts(spark, sf):
    name, pct = F.col("owner_name"), F.col("holding_pct")
    return view(spark, sf, "owners").select("row_no", S.sort_name(name).alias("sort_name"), S.format_owner_name(name).alias("owner"), S.format_pct(pct).alias("pct"), S.render_owner(name, pct).alias("rendered"))


@query(
    "p08_p09_p27_footprint_shapes",
    f"{with_views('footprints')} SELECT footprint_id, round({AREA_SQL}, 6) AS area, round({PERIMETER_SQL}, 6) AS perimeter, round({COMPACT_SQL}, 6) AS compactness, {SHAPE_SQL} AS shape, "
    "cx - hx AS minx, cy - hy AS miny, cx + hx AS maxx, cy + hy AS maxy, round(cx, 6) AS cx, round(cy, 6) AS cy FROM footprints",
)
def footprint_shapes(spark, sf):
    rings = F.col("rings")
    a, p = F.round(G.area(rings), 6), F.round(G.perimeter(rings), 6)
    polygons = footprint_polygons(spark, sf).select("footprint_id", "rings", a.alias("area"), p.alias("perimeter"))
    compact = S.compactness(F.col("area"), F.col("perimeter"))
    middle = G.centroid(rings)
    return polygons.select(
        "footprint_id", "area", "perimeter", F.round(compact, 6).alias("compactness"), S.shape_class(compact).alias("shape"),
        *[v.alias(k) for k, v in G.bounds(rings).items()], *[F.round(v, 6).alias(k) for k, v in middle.items()],
    )


@query(
    "p10_p13_pixel_values",
    f"{with_views('pixels')} SELECT tile, prow, pcol, yr, CASE WHEN nir <> -999 THEN nir / 10000.0 END AS nir_value, CASE WHEN swir1 <> -999 THEN swir1 / 10000.0 END AS swir_value, "
    "CASE WHEN bs <> 255 THEN CAST(bs AS DOUBLE) END AS bare, bs <> 255 AND bs > 100 AS beyond, nir <> -999 AND swir1 <> -999 AND nir + swir1 <> 0 AS is_valid, "
    "CASE WHEN nir <> -999 AND swir1 <> -999 THEN round((nir / 10000.0 - swir1 / 10000.0) / (nir / 10000.0 + swir1 / 10000.0), 6) END AS ndmi FROM pixels",
)
def pixel_values(spark, sf):
    p = view(spark, sf, "pixels").withColumns({"n": S.decode_index_band(F.col("nir")), "s": S.decode_index_band(F.col("swir1")), "bare": S.decode_share(F.col("bs"))})
    return p.select(
        "tile", "prow", "pcol", "yr", F.col("n").cast("double").alias("nir_value"), F.col("s").cast("double").alias("swir_value"), "bare", S.out_of_range(F.col("bare")).alias("beyond"),
        S.valid_index_pixel(F.col("n"), F.col("s")).alias("is_valid"), F.round(S.norm_diff(F.col("n"), F.col("s")), 6).alias("ndmi"),
    )


@query(
    "p14_normalised_dates",
    "SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 1 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 2 THEN strftime(o_orderdate, '%Y-%m-%d') ELSE 'not a date' END AS d FROM orders",
)
def normalised_dates(spark, sf):
    day = F.col("o_orderdate").cast("timestamp")
    text = F.when(F.col("o_orderkey") % 4 == 0, F.date_format(day, "d/M/yyyy")).when(F.col("o_orderkey") % 4 == 1, F.date_format(day, "dd-MM-yyyy")).when(F.col("o_orderkey") % 4 == 2, F.date_format(day, "yyyy-MM-dd")).otherwise("not a date")
    return spark.read.parquet(f"{sf}/orders.parquet").select("o_orderkey", S.normalise_date(text).alias("d"))


@query("p15_p20_fire_codes", f"{with_views('fires')} SELECT event_id, upper(trim(fire_type)) AS code, fire_year BETWEEN 1937 AND 1999 AS in_window FROM fires")
def fire_codes(spark, sf):
    return view(spark, sf, "fires").select("event_id", S.normalise_code(F.col("fire_type")).alias("code"), S.in_coverage_window(F.col("fire_year"), 2000).alias("in_window"))


@query(
    "p16_p21_years",
    "SELECT o_orderkey, CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE year(o_orderdate) END AS item_year, CASE WHEN year(o_orderdate) % 4 = 0 THEN 366 ELSE 365 END AS days FROM orders",
)
def years(spark, sf):
    stamp = F.when(F.col("o_orderkey") % 9 == 0, "n/a").otherwise(F.date_format(F.col("o_orderdate").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss"))
    return spark.read.parquet(f"{sf}/orders.parquet").select("o_orderkey", S.item_year(stamp).alias("item_year"), S.expected_days(F.year("o_orderdate")).alias("days"))


@query(
    "p22_p25_keys",
    f"{with_views('footprints')} SELECT footprint_id, printf('%.3f_%.3f', -cy / 1000, cx / 1000) AS cell, greatest(CAST(ceil((2 * hx + 600) / 30.0) AS BIGINT) + 1, 67) AS side, "
    "CASE WHEN ceil((2 * hx + 600) / 30.0) + 1 > 67 THEN 'footprint' ELSE 'floor' END AS basis, concat_ws(':', kind, footprint_id) AS stratum, substring(sha256(footprint_id), 1, 12) AS content FROM footprints",
)
def keys(spark, sf):
    span = 2 * F.col("hx")
    return view(spark, sf, "footprints").select(
        "footprint_id", S.cell_id(-F.col("cy") / 1000, F.col("cx") / 1000).alias("cell"), S.window_side(span).alias("side"), S.window_basis(span).alias("basis"),
        S.stratum_key(F.col("kind"), F.col("footprint_id")).alias("stratum"), S.content_id(F.col("footprint_id")).alias("content"),
    )


def _albers_sql(lon: str, lat: str) -> tuple[str, str]:
    e2 = "(2.0/298.257222101 - 1.0/(298.257222101*298.257222101))"
    e = f"sqrt({e2})"
    q = lambda s: f"((1-{e2})*(({s})/(1-{e2}*({s})*({s})) - ln((1-{e}*({s}))/(1+{e}*({s})))/(2*{e})))"
    m2 = lambda d: f"(power(cos(radians({d})),2)/(1-{e2}*power(sin(radians({d})),2)))"
    n = f"(({m2(-18)}-{m2(-36)})/({q('sin(radians(-36))')}-{q('sin(radians(-18))')}))"
    c = f"({m2(-18)}+{n}*{q('sin(radians(-18))')})"
    rho = f"(6378137.0*sqrt({c}-{n}*{q(f'sin(radians({lat}))')})/{n})"
    theta = f"({n}*radians({lon}-132))"
    return f"{rho}*sin({theta})", f"6378137.0*sqrt({c})/{n} - {rho}*cos({theta})"


_X, _Y = _albers_sql("(112 + c_custkey % 40)", "(-12 - c_custkey % 24)")


@query("p26_albers", f"SELECT c_custkey, round({_X}, 3) AS x, round({_Y}, 3) AS y, CAST(112 + c_custkey % 40 AS DOUBLE) AS lon, CAST(-12 - c_custkey % 24 AS DOUBLE) AS lat FROM customer")
def albers(spark, sf):
    c = spark.read.parquet(f"{sf}/customer.parquet").select("c_custkey", (112 + F.col("c_custkey") % 40).cast("double").alias("a"), (-12 - F.col("c_custkey") % 24).cast("double").alias("b"))
    c = c.select("c_custkey", *[v.alias(k) for k, v in G.to_albers(F.col("a"), F.col("b")).items()])
    back = G.from_albers(F.col("x"), F.col("y"))
    return c.select("c_custkey", F.round("x", 3).alias("x"), F.round("y", 3).alias("y"), *[F.round(v, 6).alias(k) for k, v in back.items()])


_TURNS = [f"radians({v} / 3600)" for v in ("-0.0394924::DOUBLE", "-0.0327221::DOUBLE", "-0.0328979::DOUBLE")]


@query(
    "p26_shifted_datums",
    f"""WITH c AS (SELECT c_custkey, radians(CAST(112 + c_custkey % 40 AS DOUBLE)) AS l, radians(CAST(-12 - c_custkey % 24 AS DOUBLE)) AS f, 1 / 298.257222101::DOUBLE AS fl, 6378137.0::DOUBLE AS a FROM customer), e AS (SELECT *, fl * (2 - fl) AS e2, a * (1 - fl) AS b FROM c),
g AS (SELECT *, a / sqrt(1 - e2 * sin(f) * sin(f)) AS n FROM e), h AS (SELECT *, n * cos(f) * cos(l) AS x, n * cos(f) * sin(l) AS y, n * (1 - e2) * sin(f) AS z FROM g), s AS (SELECT *, 1 - 0.009994::DOUBLE * 0.000001::DOUBLE AS k FROM h),
t AS (SELECT *, 0.06155::DOUBLE + k * (x + {_TURNS[2]} * y - {_TURNS[1]} * z) AS p, -0.01087::DOUBLE + k * (y - {_TURNS[2]} * x + {_TURNS[0]} * z) AS q, -0.04019::DOUBLE + k * (z + {_TURNS[1]} * x - {_TURNS[0]} * y) AS r FROM s),
u AS (SELECT *, sqrt(p * p + q * q) AS d, atan2(r * a, sqrt(p * p + q * q) * b) AS w FROM t)
SELECT c_custkey, round(degrees(atan2(q, p)), 8) AS lon, round(degrees(atan2(r + (a * a - b * b) / b * power(sin(w), 3), d - e2 * a * power(cos(w), 3))), 8) AS lat, 0.0 AS lost FROM u""",
)
def shifted_datums(spark, sf):
    """GDA2020 of whole degrees of GDA94, and how far the way back misses them, to the tenth of a millimetre (1e-9 degrees)."""
    lon, lat = (112 + F.col("c_custkey") % 40).cast("double"), (-12 - F.col("c_custkey") % 24).cast("double")
    to = G.shift_datum(lon, lat, "EPSG:4283", "EPSG:7844")
    there = spark.read.parquet(f"{sf}/customer.parquet").select("c_custkey", lon.alias("lon0"), lat.alias("lat0"), to["lon"].alias("lon"), to["lat"].alias("lat"))
    back = G.shift_datum(F.col("lon"), F.col("lat"), "EPSG:7844", "EPSG:4283")
    return there.select("c_custkey", F.round("lon", 8).alias("lon"), F.round("lat", 8).alias("lat"), F.round(F.greatest(F.abs(back["lon"] - F.col("lon0")), F.abs(back["lat"] - F.col("lat0"))), 8).alias("lost"))


@query(
    "p30_pixel_centres",
    f"{with_views('pixels')} SELECT DISTINCT tile, prow, pcol, tile * 96000.0 + (pcol + 0.5) * 30 AS x, (tile + 1) * 96000.0 - (prow + 0.5) * 30 AS y FROM pixels",
)
def pixel_centres(spark, sf):
    from ..operators.pixels import pixel_centre

    name = F.format_string("x%dy%d", F.col("tile").cast("int"), F.col("tile").cast("int"))
    p = view(spark, sf, "pixels").select("tile", "prow", "pcol").distinct().withColumn("name", name)
    return p.select("tile", "prow", "pcol", *[v.alias(k) for k, v in pixel_centre(F.col("name"), F.col("prow"), F.col("pcol")).items()])


@query(
    "p31_geometry_values",
    f"{with_views('footprints')} SELECT footprint_id, part_no % 3 = 0 AS wkt, part_no % 2 = 0 AS wkb FROM footprints",
)
def geometry_values(spark, sf):
    text = F.when(F.col("part_no") % 3 == 0, F.concat(F.lit("SRID=3577;POINT ("), F.col("cx").cast("string"), F.lit(" 0)"))).otherwise(F.concat(F.lit("a point of "), F.col("kind")))
    raw = F.when(F.col("part_no") % 2 == 0, F.unhex(F.lit("01030000000100"))).otherwise(F.unhex(F.lit("0203000000")))
    return view(spark, sf, "footprints").select("footprint_id", S.is_wkt(text).alias("wkt"), S.is_wkb(raw).alias("wkb"))


@query(
    "p33_sources",
    f"{with_views('catalogue')} SELECT source_id, CASE source_id WHEN 'gm5' THEN 'sensor 5' WHEN 'gm7' THEN 'sensor 7' WHEN 'gm8' THEN 'sensors 8 and 9' END AS sensor, "
    "CASE source_id WHEN 'fc' THEN 'share' ELSE 'index' END AS kind, count(*) AS n FROM catalogue GROUP BY 1",
)
def sources(spark, sf):
    c = view(spark, sf, "catalogue").groupBy("source_id").agg(F.count("*").alias("n"))
    return c.select("source_id", S.sensor_for(F.col("source_id")).alias("sensor"), S.kind_of(F.col("source_id")).alias("kind"), "n")
