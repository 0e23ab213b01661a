"""Catalogue queries. An item's box is its tile of 10 km."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import catalogue as K
from ..operators import contracts as C
from .fixtures import planted, planted_sql, view, with_views
from .registry import query

_BOX = "CAST(tx * 10000 AS DOUBLE) AS minx, CAST(ty * 10000 AS DOUBLE) AS miny, CAST(tx * 10000 + 10000 AS DOUBLE) AS maxx, CAST(ty * 10000 + 10000 AS DOUBLE) AS maxy"
_ITEMS = f"items AS (SELECT *, {_BOX} FROM catalogue)"
SOURCES = ("fc", "gm5", "gm7", "gm8")


def items(spark, sf):
    return view(spark, sf, "catalogue").selectExpr("*", *_BOX.split(", CAST")[:1], *[f"CAST{x}" for x in _BOX.split(", CAST")[1:]])


def nested_items(spark, sf):
    """Items as a catalogue page has them: box array, properties struct, map of assets."""
    c = view(spark, sf, "catalogue")
    asset = lambda name: F.struct(F.concat(F.lit(f"s3://pixels/{name}/"), F.col("item_no").cast("string")).alias("href"), F.when(F.col("item_no") % 5 != 0, F.array(F.lit(3200), F.lit(3200))).alias("shape"), F.when(F.col("item_no") % 7 != 0, F.array(F.lit(512), F.lit(512))).alias("blocks"), F.when(F.col("item_no") % 3 == 0, "uint8").when(F.col("item_no") % 3 == 1, "int16").alias("data_type"))
    return c.select(
        "source_id", F.concat(F.lit("i"), F.col("item_no").cast("string")).alias("id"),
        F.array(*[(F.col(v) * 10000 + add).cast("double") for v, add in (("tx", 0), ("ty", 0), ("tx", 10000), ("ty", 10000))]).alias("bbox"),
        F.struct(F.concat(F.col("item_year").cast("string"), F.lit("-01-01T00:00:00Z")).alias("datetime"), F.format_string("x%dy%d", F.col("tx").cast("int"), F.col("ty").cast("int")).alias("region_code"), F.lit("1.0").alias("dataset_version")).alias("properties"),
        F.when(F.col("item_no") % 2 == 0, F.create_map(F.lit("swir1"), asset("swir1"), F.lit("nir"), asset("nir"))).otherwise(F.create_map(F.lit("nir"), asset("nir"))).alias("assets"),
    )


@query("p17_flattened_items", f"{with_views('catalogue')}, {_ITEMS} SELECT source_id, concat('i', item_no) AS item_id, minx, miny, maxx, maxy, concat(item_year, '-01-01T00:00:00Z') AS datetime, concat('x', tx, 'y', ty) AS tile_id, '1.0' AS version, CASE WHEN item_no % 2 = 0 THEN 'nir|swir1' ELSE 'nir' END AS asset_identity, CASE WHEN item_no % 2 = 0 THEN 2 ELSE 1 END AS n_assets FROM items")
def flattened_items(spark, sf):
    return K.flatten_items(nested_items(spark, sf))


_ASSETS = f"""{with_views("catalogue")}, assets AS (SELECT source_id, item_no, unnest(CASE WHEN item_no % 2 = 0 THEN ['swir1', 'nir'] ELSE ['nir'] END) AS asset FROM catalogue),
flat AS (SELECT source_id, concat('i', item_no) AS item_id, asset, concat('s3://pixels/', asset, '/', item_no) AS href, CASE WHEN item_no % 5 <> 0 THEN 3200 END AS rows, CASE WHEN item_no % 5 <> 0 THEN 3200 END AS cols,
 CASE WHEN item_no % 7 <> 0 THEN 512 END AS block_rows, CASE WHEN item_no % 7 <> 0 THEN 512 END AS block_cols, CASE item_no % 3 WHEN 0 THEN 'uint8' WHEN 1 THEN 'int16' END AS data_type, CASE item_no % 3 WHEN 0 THEN 1 WHEN 1 THEN 2 END AS sample_bytes FROM assets)"""


@query("p18_flattened_assets", f"{_ASSETS} SELECT * FROM flat")
def flattened_assets(spark, sf):
    return K.flatten_assets(nested_items(spark, sf))


@query("p19_band_hrefs", f"{with_views('catalogue')} SELECT source_id, concat('i', item_no) AS item_id, concat('s3://pixels/nir/', item_no) AS nir, CASE WHEN item_no % 2 = 0 THEN concat('s3://pixels/swir1/', item_no) END AS swir1, CASE WHEN item_no % 2 = 0 THEN '' ELSE 'swir1' END AS missing FROM catalogue")
def band_hrefs(spark, sf):
    return K.select_band_hrefs(nested_items(spark, sf), ["nir", "swir1"]).select("source_id", "item_id", F.col("hrefs")[0].alias("nir"), F.col("hrefs")[1].alias("swir1"), "missing")


@query("a09_asset_disclosures", f"{_ASSETS} SELECT source_id, count(*) AS assets, count(*) FILTER (rows IS NULL) AS no_rows, count(*) FILTER (block_rows IS NULL) AS no_block_rows, count(*) FILTER (sample_bytes IS NULL) AS no_sample_bytes FROM flat GROUP BY 1")
def asset_disclosures(spark, sf):
    return K.asset_disclosures(K.flatten_assets(nested_items(spark, sf)))


_BAD_ITEMS = {
    "no_box": ("item_no % 17 = 0", "bbox", "array(1.0D)"),
    "no_assets": ("item_no % 19 = 0", "assets", "NULL"),
    "missing_asset": ("(item_no % 2 <> 0 AND source_id IN ('gm5', 'gm7')) OR (item_no % 19 = 0 AND source_id <> 'gm8')", "", ""),
    "no_datetime": ("item_no % 11 = 0", "properties", "named_struct('datetime', NULL, 'region_code', properties.region_code, 'dataset_version', properties.dataset_version)"),
    "unreadable_datetime": ("item_no % 13 = 0 AND item_no % 11 <> 0", "properties", "named_struct('datetime', 'soon', 'region_code', properties.region_code, 'dataset_version', properties.dataset_version)"),
    "unknown_source": ("source_id = 'gm8'", "", ""),
    "duplicate_id": ("item_no % 50 = 3", "", ""),
}
_ALL_ITEMS = "every AS (SELECT source_id, item_no FROM catalogue UNION ALL SELECT source_id, item_no FROM catalogue WHERE item_no % 50 = 3)"


@query(
    "v08_item_checks",
    f"""{with_views("catalogue")}, {_ALL_ITEMS} {planted_sql("every", {k: v for k, v in _BAD_ITEMS.items() if k != "duplicate_id"}, "concat('i', item_no)")} UNION ALL {planted_sql("catalogue", {"duplicate_id": _BAD_ITEMS["duplicate_id"]}, "concat(source_id, '|i', item_no)")} UNION ALL SELECT 'empty_source', 1, 'gm9,gm9'""",
)
def item_checks(spark, sf):
    n = nested_items(spark, sf).withColumn("item_no", F.substring("id", 2, 20).cast("long"))
    n = planted(n.unionByName(n.filter("item_no % 50 = 3")), {k: v for k, v in _BAD_ITEMS.items() if v[1]}).drop("item_no")
    return K.item_violations(K.flatten_items(n), {"fc": ("nir",), "gm5": ("nir", "swir1"), "gm7": ("nir", "swir1"), "gm9": ("nir",)})


_COVER = f"""{with_views("sites", "catalogue")}, {_ITEMS}, b AS (SELECT DISTINCT source_id, item_year, minx, miny, maxx, maxy FROM items),
h AS (SELECT row_no, source_id, count(DISTINCT item_year) AS n FROM sites, b WHERE x BETWEEN minx AND maxx AND y BETWEEN miny AND maxy GROUP BY 1, 2),
cover AS (SELECT s.row_no, """ + ", ".join(f"CASE WHEN any_value(s.x) IS NOT NULL THEN coalesce(max(n) FILTER (source_id = '{s}'), 0) END AS {s}" for s in SOURCES) + " FROM sites s LEFT JOIN h ON s.row_no = h.row_no GROUP BY 1)"


@query("j07_epoch_coverage", f"{_COVER} SELECT * FROM cover")
def epoch_coverage(spark, sf):
    return K.epoch_coverage(view(spark, sf, "sites"), items(spark, sf), SOURCES, 10000.0)


@query("j16_register_with_coverage", f"{_COVER} SELECT s.row_no, site_id, fc, gm5, gm7, gm8 FROM sites s JOIN cover c ON s.row_no = c.row_no")
def register_with_coverage(spark, sf):
    return K.append_aligned(view(spark, sf, "sites").select("row_no", "site_id"), epoch_coverage(spark, sf))


@query("j16_misaligned", f"{with_views('sites')} SELECT count(*) FILTER (row_no % 3 = 0 AND row_no % 2 <> 0) AS only_register, count(*) FILTER (row_no % 3 <> 0 AND row_no % 2 = 0) AS only_extra, 0 AS repeated FROM sites")
def misaligned(spark, sf):
    s = view(spark, sf, "sites")
    return K.misaligned(s.filter("row_no % 3 = 0"), s.filter("row_no % 2 = 0"))


_RANGES = {"fc": (1995, 1998), "gm5": (1994, 1997), "gm7": (1992, 1996), "gm8": (1996, 1998)}
_RANGE_SQL = "ranges AS (SELECT * FROM (VALUES " + ", ".join(f"('{s}', {a}, {b})" for s, (a, b) in _RANGES.items()) + ") t(source_id, first_year, last_year))"


@query(
    "j08_touched_tile_years",
    f"""{with_views("sites", "catalogue")}, {_ITEMS}, {_RANGE_SQL}, t AS (SELECT DISTINCT source_id, tx, ty, item_year, minx, miny, maxx, maxy FROM items), w AS (SELECT DISTINCT x, y FROM sites WHERE x IS NOT NULL),
h AS (SELECT * FROM t WHERE EXISTS (SELECT 1 FROM w WHERE x BETWEEN minx AND maxx AND y BETWEEN miny AND maxy)) SELECT source_id, count(*) FILTER (item_year BETWEEN first_year AND last_year) AS tile_years, count(*) FILTER (item_year NOT BETWEEN first_year AND last_year) AS outside_range FROM h JOIN ranges USING (source_id) GROUP BY 1""",
)
def touched_tile_years(spark, sf):
    ranges = spark.createDataFrame([(s, a, b) for s, (a, b) in _RANGES.items()], "source_id string, first_year int, last_year int")
    return K.touched_tile_years(view(spark, sf, "sites"), items(spark, sf), ranges)


@query("j27_selected_items", f"{with_views('catalogue')} SELECT source_id, tx, ty, item_year, min(item_no) AS item_no, count(*) AS n_items FROM catalogue WHERE tx % 2 = 0 GROUP BY 1, 2, 3, 4")
def selected_items(spark, sf):
    c = view(spark, sf, "catalogue")
    return K.select_items(c, c.filter("tx % 2 = 0").select("tx", "ty").distinct())


@query("u1_match_stages", f"{with_views('catalogue')} SELECT source_id, item_year, count(*) AS n FROM (SELECT * FROM catalogue WHERE tx < 5 UNION ALL SELECT * FROM catalogue WHERE tx >= 5) GROUP BY 1, 2")
def match_stages(spark, sf):
    c = view(spark, sf, "catalogue")
    return C.together(c.filter("tx < 5"), c.filter("tx >= 5")).groupBy("source_id", "item_year").agg(F.count("*").alias("n"))


_TILES = "ft AS (SELECT footprint_id, CAST(floor((cx - hx) / 10000) AS BIGINT) + i AS tx, CAST(floor(cy / 10000) AS BIGINT) AS ty FROM footprints, range(2) r(i) WHERE i = 0 OR floor((cx - hx) / 10000) < floor((cx + hx) / 10000))"
_COVERED = f"""{with_views("footprints", "catalogue")}, {_TILES}, need AS (SELECT footprint_id, count(*) AS n_tiles FROM ft GROUP BY 1),
have AS (SELECT footprint_id, source_id, item_year, count(DISTINCT (tx, ty)) AS n FROM ft JOIN catalogue USING (tx, ty) GROUP BY 1, 2, 3), ok AS (SELECT DISTINCT footprint_id, item_year FROM have JOIN need USING (footprint_id) WHERE n = n_tiles)"""


def footprint_tiles(spark, sf):
    f = view(spark, sf, "footprints")
    return f.select("footprint_id", F.explode(F.sequence(F.floor((F.col("cx") - F.col("hx")) / 10000), F.floor((F.col("cx") + F.col("hx")) / 10000))).alias("tx"), F.floor(F.col("cy") / 10000).alias("ty"))


@query("a19_u3_epoch_covered_years", f"{_COVERED} SELECT * FROM ok")
def epoch_covered_years(spark, sf):
    return K.epoch_covered_years(footprint_tiles(spark, sf), view(spark, sf, "catalogue"))


@query(
    "a32_coverage_rates",
    f"""{_COVERED}, y AS (SELECT DISTINCT item_year FROM catalogue), c AS (SELECT y.item_year, n_tiles > 1 AS several, ok.item_year IS NOT NULL AS covered FROM need CROSS JOIN y LEFT JOIN ok ON need.footprint_id = ok.footprint_id AND y.item_year = ok.item_year)
SELECT item_year, CASE WHEN several THEN 'several' ELSE 'one' END AS tiles, count(*) AS n, round(avg(covered::INT), 6) AS rate FROM c GROUP BY 1, 2 UNION ALL SELECT item_year, 'all', count(*), round(avg(covered::INT), 6) FROM c GROUP BY 1""",
)
def coverage_rates(spark, sf):
    tiles, cat = footprint_tiles(spark, sf), view(spark, sf, "catalogue")
    need = tiles.groupBy("footprint_id").agg((F.count("*") > 1).alias("several"))
    years = cat.select("item_year").distinct()
    ok = K.epoch_covered_years(tiles, cat).withColumn("covered", F.lit(True))
    c = need.crossJoin(F.broadcast(years)).join(ok, ["footprint_id", "item_year"], "left").select("item_year", "several", F.coalesce("covered", F.lit(False)).alias("covered"))
    return K.coverage_rates(c).withColumn("rate", F.round("rate", 6))


@query(
    "a10_volume_estimate",
    f"""{_COVERED}, e AS (SELECT footprint_id, source_id, count(DISTINCT item_year) AS n_years FROM ft JOIN catalogue USING (tx, ty) GROUP BY 1, 2), px AS (SELECT footprint_id, power(greatest(CAST(ceil((2 * greatest(hx, hy) + 600) / 30.0) AS BIGINT) + 1, 67), 2)::BIGINT AS window_px FROM footprints),
a AS (SELECT * FROM (VALUES ('fc', 3, 1), ('gm5', 2, 2), ('gm7', 2, 2), ('gm8', 2, NULL)) t(source_id, n_assets, sample_bytes)),
r AS (SELECT source_id, CAST(sum(window_px * n_years) AS BIGINT) AS px_years, CAST(sum(n_years) AS BIGINT) AS footprint_years FROM e JOIN px USING (footprint_id) GROUP BY 1)
SELECT source_id, px_years, footprint_years, CASE WHEN sample_bytes IS NOT NULL THEN 'observed' ELSE 'assumed' END AS bytes_basis, px_years * n_assets * coalesce(sample_bytes, 2) AS raw_bytes, CAST(floor(px_years * n_assets * coalesce(sample_bytes, 2) * CAST(0.6 AS DOUBLE)) AS BIGINT) AS estimated_bytes FROM r JOIN a USING (source_id)""",
)
def volume_estimate(spark, sf):
    epochs = K.footprint_epochs(footprint_tiles(spark, sf), view(spark, sf, "catalogue"))
    assets = spark.createDataFrame([("fc", 3, 1), ("gm5", 2, 2), ("gm7", 2, 2), ("gm8", 2, None)], "source_id string, n_assets int, sample_bytes int")
    side = S.window_side(2 * F.greatest("hx", "hy"))
    f = view(spark, sf, "footprints")
    return K.volume_estimate(f, epochs, assets, side)


_BOUNDS = f"""{_COVERED}, e AS (SELECT footprint_id, source_id, count(DISTINCT item_year) AS n_years FROM ft JOIN catalogue USING (tx, ty) GROUP BY 1, 2), px AS (SELECT footprint_id, greatest(CAST(ceil((2 * greatest(hx, hy) + 600) / 30.0) AS BIGINT) + 1, 67) AS side FROM footprints),
a AS (SELECT * FROM (VALUES ('fc', 3, 1, 512, 256), ('gm5', 2, 2, 512, 512), ('gm7', 2, 2, 256, 512), ('gm8', 2, NULL, NULL, 512), ('gm9', 2, 2, NULL, NULL)) t(source_id, n_assets, sample_bytes, block_w, block_h)),
r AS (SELECT source_id, CAST(sum(side * side * n_years * n_assets * coalesce(sample_bytes, 2)) AS BIGINT) AS raw_bytes, CASE WHEN count(*) FILTER (block_w IS NULL OR block_h IS NULL) = 0 THEN CAST(sum(ceil(side / block_w) * ceil(side / block_h) * n_years * n_assets) AS BIGINT) END AS requests FROM e JOIN px USING (footprint_id) JOIN a USING (source_id) GROUP BY 1),
t AS (SELECT source_id, count(*) AS n FROM (SELECT DISTINCT source_id, tx, ty, item_year FROM ft JOIN catalogue USING (tx, ty) WHERE item_year BETWEEN 1993 AND 1997) GROUP BY 1),
bounds AS (SELECT a.source_id, coalesce(raw_bytes, 0) AS raw_bytes, CAST(floor(coalesce(raw_bytes, 0) * CAST(0.6 AS DOUBLE)) AS BIGINT) AS estimated_bytes, CASE WHEN raw_bytes IS NULL THEN 0 ELSE requests END AS requests, coalesce(n, 0) AS n_tile_years, coalesce(n, 0) * 3200 * 3200 * n_assets * coalesce(sample_bytes, 2) AS upper_bound_bytes FROM a LEFT JOIN r USING (source_id) LEFT JOIN t USING (source_id))"""


def _volume_bounds(spark, sf):
    tiles, cat = footprint_tiles(spark, sf), view(spark, sf, "catalogue")
    rows = [("fc", 3, 1, 512, 256), ("gm5", 2, 2, 512, 512), ("gm7", 2, 2, 256, 512), ("gm8", 2, None, None, 512), ("gm9", 2, 2, None, None)]
    assets = spark.createDataFrame(rows, "source_id string, n_assets int, sample_bytes int, block_w int, block_h int")
    return K.volume_bounds(view(spark, sf, "footprints"), K.footprint_epochs(tiles, cat), assets, K.touched_items(tiles, cat.filter("item_year BETWEEN 1993 AND 1997")), S.window_side(2 * F.greatest("hx", "hy")), 3200)


@query("a10_volume_bounds", f"{_BOUNDS} SELECT * FROM bounds")
def volume_bounds(spark, sf):
    return _volume_bounds(spark, sf)


@query("a10_volume_totals", f"{_BOUNDS} SELECT CAST(floor(sum(raw_bytes) * CAST(0.6 AS DOUBLE)) AS BIGINT) AS estimated_bytes, CASE WHEN count(*) FILTER (requests IS NULL) = 0 THEN CAST(sum(requests) AS BIGINT) END AS requests, CAST(sum(upper_bound_bytes) AS BIGINT) AS upper_bound_bytes FROM bounds")
def volume_totals(spark, sf):
    return K.volume_totals(_volume_bounds(spark, sf))
