"""Pixel queries. The pixel view's third index band is derived from its second."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import pixels as P
from .fixtures import footprint_polygons, view, with_views
from .q_spatial import COVERED_SQL
from .registry import query

_V = f"""{with_views("pixels")}, v AS (SELECT tile, prow, pcol, yr, CASE WHEN nir <> -999 THEN nir / 10000.0 END AS nir, CASE WHEN swir1 <> -999 THEN swir1 / 10000.0 END AS swir1, CASE WHEN swir1 <> -999 THEN (swir1 + 100) / 10000.0 END AS swir2,
 CASE WHEN bs <> 255 THEN CAST(bs AS DOUBLE) END AS bare, CASE WHEN bs <> 255 THEN CAST(bs + 1 AS DOUBLE) END AS pv, prow // 10 AS site FROM pixels),
w AS (SELECT *, nir IS NOT NULL AND swir1 IS NOT NULL AND nir + swir1 <> 0 AND nir + swir2 <> 0 AS ok, bare IS NOT NULL AS ok_share FROM v)"""
_REASON = "CASE WHEN n_valid = 0 THEN 'zero_valid_pixels' WHEN n_valid < ceil(round(n_member * 0.95, 9)) THEN 'insufficient_valid_fraction' END"
KEYS = ["tile", "site", "yr"]


def values(spark, sf):
    p = view(spark, sf, "pixels")
    fill = F.col("swir1") == S.FILL_INDEX
    return p.select(
        "tile", "prow", "pcol", "yr", S.decode_index_band(F.col("nir")).alias("nir"), S.decode_index_band(F.col("swir1")).alias("swir1"), F.when(~fill, (F.col("swir1") + 100) / 10000.0).alias("swir2"),
        S.decode_share(F.col("bs")).alias("bare"), (S.decode_share(F.col("bs")) + 1).alias("pv"), F.floor(F.col("prow") / 10).alias("site"),
    )


@query(
    "a13_p34_index_site_years",
    f"""{_V}, g AS (SELECT tile, site, yr, count(*) AS n_member, count(*) FILTER (ok) AS n_valid, avg((nir - swir2) / (nir + swir2)) FILTER (ok) AS nbr, avg((nir - swir1) / (nir + swir1)) FILTER (ok) AS ndmi FROM w GROUP BY 1, 2, 3), r AS (SELECT *, {_REASON} AS reason FROM g)
SELECT tile, site, yr, metric, round(CASE WHEN reason IS NULL THEN v END, 6) AS value, n_member, n_valid, reason IS NULL AS computable, reason FROM (SELECT *, 'nbr' AS metric, nbr AS v FROM r UNION ALL SELECT *, 'ndmi', ndmi FROM r)""",
)
def index_site_years(spark, sf):
    return P.index_site_years(values(spark, sf), KEYS).withColumn("value", F.round("value", 6))


@query(
    "a14_share_site_years",
    f"""{_V}, g AS (SELECT tile, site, yr, count(*) AS n_member, count(*) FILTER (ok_share) AS n_valid, avg(bare) AS bare, avg(pv) AS pv, count(*) FILTER (bare > 100) AS b1, count(*) FILTER (pv > 100) AS b2 FROM w GROUP BY 1, 2, 3), r AS (SELECT *, {_REASON} AS reason FROM g)
SELECT tile, site, yr, metric, round(CASE WHEN reason IS NULL THEN v END, 6) AS value, beyond, n_member, n_valid, reason IS NULL AS computable, reason FROM (SELECT *, 'bare' AS metric, bare AS v, b1 AS beyond FROM r UNION ALL SELECT *, 'pv', pv, b2 FROM r)""",
)
def share_site_years(spark, sf):
    return P.share_site_years(values(spark, sf), KEYS, ("bare", "pv")).withColumn("value", F.round("value", 6))


@query("a12_zonal_stats", f"{_V} SELECT tile, round(avg(bare), 6) AS mean, round(sum(bare), 6) AS sum, min(bare) AS min, max(bare) AS max, count(bare) AS n FROM v WHERE bare IS NOT NULL GROUP BY 1")
def zonal_stats(spark, sf):
    z = P.zonal_stats(values(spark, sf), "tile", "bare")
    return z.select("tile", F.round("mean", 6).alias("mean"), F.round("sum", 6).alias("sum"), "min", "max", "n")


@query("s05_member_values", f"{_V} SELECT m.tile, m.prow, m.pcol, v.yr, v.bare FROM (SELECT DISTINCT tile, prow, pcol FROM v UNION SELECT DISTINCT tile, prow, pcol + 100 FROM v) m LEFT JOIN v ON m.tile = v.tile AND m.prow = v.prow AND m.pcol = v.pcol")
def member_values(spark, sf):
    v = values(spark, sf)
    there = v.select("tile", "prow", "pcol").distinct()
    members = there.unionByName(there.withColumn("pcol", F.col("pcol") + 100))  # and some that have no pixel
    return P.read_member_values(v, members, ["tile", "prow", "pcol"]).select("tile", "prow", "pcol", "yr", "bare")


@query(
    "s05_member_refusals",
    f"""{_V}, m AS (SELECT DISTINCT tile, prow, pcol FROM v UNION SELECT DISTINCT tile, prow, pcol + 100 FROM v WHERE tile < 4 UNION SELECT DISTINCT tile + 100, prow, pcol FROM v WHERE tile < 2), x AS (SELECT m.*, t.tile IS NULL AS gone, prow >= 40 OR pcol >= 40 AS beyond, concat_ws(',', m.tile, prow, pcol) AS shown FROM m LEFT JOIN (SELECT DISTINCT tile FROM v) t ON m.tile = t.tile)
SELECT 'missing_tile' AS "check", count(*) FILTER (gone) AS n, concat_ws(',', min(shown) FILTER (gone), max(shown) FILTER (gone)) AS examples FROM x UNION ALL SELECT 'out_of_bounds', count(*) FILTER (beyond AND NOT gone), concat_ws(',', min(shown) FILTER (beyond AND NOT gone), max(shown) FILTER (beyond AND NOT gone)) FROM x""",
)
def member_refusals(spark, sf):
    """Members of which some are beyond their tile's bounds and some of a tile that is not there."""
    there = values(spark, sf).select("tile", "prow", "pcol").distinct()
    members = there.unionByName(there.filter("tile < 4").withColumn("pcol", F.col("pcol") + 100)).unionByName(there.filter("tile < 2").withColumn("tile", F.col("tile") + 100))
    tiles = there.select("tile", F.lit(40).alias("height"), F.lit(40).alias("width")).distinct()
    return P.member_checks(members, tiles)


_MEMBERS = f"""{with_views("footprints")}, f AS (SELECT *, CAST(ceil((cx - hx - 15) / 30) AS BIGINT) AS x1, CAST(floor((cx + hx - 15) / 30) AS BIGINT) AS x2, CAST(ceil((cy - hy - 15) / 30) AS BIGINT) AS y1, CAST(floor((cy + hy - 15) / 30) AS BIGINT) AS y2 FROM footprints),
p AS (SELECT * FROM (SELECT f.*, unnest(range(x1, x2 + 1)) AS gx FROM f)), q AS (SELECT p.*, unnest(range(y1, y2 + 1)) AS gy FROM p), c AS (SELECT *, gx * 30 + 15.0 AS x, gy * 30 + 15.0 AS y FROM q),
m AS (SELECT footprint_id, CAST(floor(gx / 40.0) AS BIGINT) AS tile_x, CAST(floor(gy / 40.0) AS BIGINT) AS tile_y, 39 - (gy - 40 * CAST(floor(gy / 40.0) AS BIGINT)) AS prow, gx - 40 * CAST(floor(gx / 40.0) AS BIGINT) AS pcol FROM c WHERE {COVERED_SQL})"""


@query("j11_pixel_members", f"{_MEMBERS} SELECT footprint_id, count(*) AS support_px, sha256(string_agg(concat(tile_x, ',', tile_y, ',', prow, ',', pcol), ';' ORDER BY concat(tile_x, ',', tile_y, ',', prow, ',', pcol))) AS members_sha256 FROM m GROUP BY 1")
def pixel_members(spark, sf):
    return P.pixel_digests(footprint_polygons(spark, sf), "footprint_id", 0.0, 0.0, 30.0, 40)


@query(
    "a20_full_support_years",
    f"""{_V}, g AS (SELECT tile, site, yr, count(*) AS n_member, count(*) FILTER (ok) AS ni, count(*) FILTER (ok_share) AS ns FROM w GROUP BY 1, 2, 3), c AS (SELECT concat_ws(':', tile, site) AS id, yr, ni >= ceil(round(n_member * 0.95, 9)) AS i, ns >= ceil(round(n_member * 0.95, 9)) AS s FROM g)
SELECT id, count(*) FILTER (i AND s) AS n_full_support_years, count(*) AS n_years FROM c GROUP BY 1""",
)
def full_support_years(spark, sf):
    v = values(spark, sf)
    rows = P.index_site_years(v, KEYS).select(*KEYS, F.lit("index").alias("kind"), "computable").unionByName(P.share_site_years(v, KEYS, ("bare", "pv")).select(*KEYS, F.lit("share").alias("kind"), "computable"))
    return P.full_support_years(rows.select(F.concat_ws(":", "tile", "site").alias("id"), F.col("yr").alias("year"), "kind", "computable"), "id")


@query(
    "a33_invalid_contiguity",
    f"""{_V}, g AS (SELECT tile, yr, count(*) AS n, count(*) FILTER (NOT ok) AS bad, min(prow) AS r1, max(prow) AS r2, min(pcol) AS c1, max(pcol) AS c2, min(prow) FILTER (NOT ok) AS b1, max(prow) FILTER (NOT ok) AS b2, min(pcol) FILTER (NOT ok) AS d1, max(pcol) FILTER (NOT ok) AS d2 FROM w GROUP BY 1, 2)
SELECT tile, yr, n, bad, round(bad * 1.0 / ((b2 - b1 + 1) * (d2 - d1 + 1)), 6) AS density, round((b2 - b1 + 1) * (d2 - d1 + 1) * 1.0 / ((r2 - r1 + 1) * (c2 - c1 + 1)), 6) AS span, b1 = r1 OR b2 = r2 OR d1 = c1 OR d2 = c2 AS touches_edge FROM g WHERE bad > 0""",
)
def invalid_contiguity(spark, sf):
    v = values(spark, sf).withColumn("ok", S.valid_index_pixel(F.col("nir"), F.col("swir1"), F.col("swir2")))
    return P.invalid_contiguity(v, ["tile", "yr"]).withColumns({"density": F.round("density", 6), "span": F.round("span", 6)})


@query(
    "a34_window_sample",
    f"""{_V}, pt AS (SELECT p_partkey AS key, p_partkey % 10 AS tile, (p_partkey * 7) % 40 AS prow, (p_partkey * 13) % 40 AS pcol FROM part), x AS (SELECT * FROM v), y AS (SELECT DISTINCT yr FROM v)
SELECT key, y.yr, count(x.tile) AS n_member, count(x.bare) AS n_valid, round(avg(x.bare), 6) AS value FROM pt CROSS JOIN y LEFT JOIN x ON x.yr = y.yr AND x.tile = pt.tile AND x.prow BETWEEN pt.prow - 1 AND pt.prow + 1 AND x.pcol BETWEEN pt.pcol - 1 AND pt.pcol + 1 GROUP BY 1, 2""",
)
def window_sample(spark, sf):
    k = F.col("p_partkey")
    points = spark.read.parquet(f"{sf}/part.parquet").select(k.alias("key"), (k % 10).alias("tile"), ((k * 7) % 40).alias("prow"), ((k * 13) % 40).alias("pcol"))
    v = values(spark, sf)
    points = points.join(F.broadcast(v.select("yr").distinct()))  # the years of a range
    by_year = lambda df: df.withColumn("tile", F.struct("tile", "yr"))
    got = P.window_sample(by_year(v), by_year(points).withColumn("key", F.struct("key", "yr")), 3, "bare")
    return got.select("key.key", "key.yr", "n_member", "n_valid", F.round("value", 6).alias("value"))


_BREAK = f"""{_V}, b AS (SELECT tile, site, yr, count(*) AS n_member, count(*) FILTER (NOT ok) AS n_invalid, count(*) FILTER (NOT ok) * 1.0 / count(*) AS invalid_share, count(*) FILTER (nir IS NULL) AS null_nir, count(*) FILTER (swir1 IS NULL) AS null_swir1, count(*) FILTER (swir2 IS NULL) AS null_swir2,
 count(*) FILTER (nir + swir1 = 0) AS zero_swir1, count(*) FILTER (nir + swir2 = 0) AS zero_swir2 FROM w GROUP BY 1, 2, 3)"""


@query("a37_invalid_breakdown", f"{_BREAK} SELECT * REPLACE (round(invalid_share, 6) AS invalid_share) FROM b")
def invalid_breakdown(spark, sf):
    return P.invalid_breakdown(values(spark, sf), KEYS, ("nir", "swir1", "swir2")).withColumn("invalid_share", F.round("invalid_share", 6))


@query(
    "a37_invalid_rates",
    f"""{_BREAK}, f AS (SELECT *, CASE WHEN n_member - n_invalid < ceil(round(n_member * 0.95, 9)) THEN invalid_share END AS failing FROM b) SELECT tile, yr, count(*) AS n, count(failing) AS n_failing, round(quantile_cont(failing, 0.5), 6) AS median, round(quantile_cont(failing, 0.9), 6) AS p90, round(max(failing), 6) AS most FROM f GROUP BY 1, 2""",
)
def invalid_rates(spark, sf):
    r = P.invalid_rates(P.invalid_breakdown(values(spark, sf), KEYS, ("nir", "swir1", "swir2")), ["tile", "yr"])
    return r.withColumns({c: F.round(c, 6) for c in ("median", "p90", "most")})
