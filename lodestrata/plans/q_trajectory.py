"""Trajectory queries. A fixture footprint is a tile's band of ten rows; two sites share every third one."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import contracts as C
from ..operators import pixels as P
from ..operators import trajectory as T
from ..operators.lineage import cut
from .fixtures import planted, planted_sql, view, with_views
from .q_pixels import _REASON, _V, values
from .registry import query

_ROUND = "round(CASE WHEN reason IS NULL THEN v END, 6)"
TRAJ = f"""{_V}, gi AS (SELECT tile, site, yr, count(*) AS n_member, count(*) FILTER (ok) AS n_valid, avg((nir - swir2) / (nir + swir2)) FILTER (ok) AS nbr, avg((nir - swir1) / (nir + swir1)) FILTER (ok) AS ndmi FROM w GROUP BY 1, 2, 3), ri AS (SELECT *, {_REASON} AS reason FROM gi),
gs AS (SELECT tile, site, yr, count(*) AS n_member, count(*) FILTER (ok_share) AS n_valid, avg(bare) AS bare, avg(pv) AS pv FROM w GROUP BY 1, 2, 3), rs AS (SELECT *, {_REASON} AS reason FROM gs),
per AS (SELECT concat('f', tile, '_', site) AS footprint_id, yr AS year, metric, {_ROUND} AS value, collection_id, n_member, n_valid, reason IS NULL AS computable, reason FROM (
 SELECT *, 'nbr' AS metric, nbr AS v, 'gm5' AS collection_id FROM ri WHERE yr <= 1995 UNION ALL SELECT *, 'ndmi', ndmi, 'gm5' FROM ri WHERE yr <= 1995 UNION ALL SELECT *, 'nbr', nbr, 'gm7' FROM ri WHERE yr >= 1995 UNION ALL SELECT *, 'ndmi', ndmi, 'gm7' FROM ri WHERE yr >= 1995)
 UNION ALL SELECT concat('f', tile, '_', site), yr, metric, {_ROUND}, 'fc', n_member, n_valid, reason IS NULL, reason FROM (SELECT *, 'bare' AS metric, bare AS v FROM rs UNION ALL SELECT *, 'pv', pv FROM rs)),
links AS (SELECT DISTINCT concat('s', tile, '_', site, '_', k) AS site_id, concat('f', tile, '_', site) AS footprint_id, tile = 3 AS forced FROM w, range(2) r(k) WHERE k = 0 OR (tile + site) % 3 = 0),
shared AS (SELECT footprint_id, count(*) AS shared_sites FROM links GROUP BY 1),
traj AS (SELECT site_id, per.*, shared_sites, forced FROM per JOIN shared USING (footprint_id) JOIN links USING (footprint_id))"""


def footprint_rows(spark, sf):
    v = values(spark, sf)
    keys = ["tile", "site", "yr"]
    index, share = P.index_site_years(v, keys), P.share_site_years(v, keys, ("bare", "pv")).drop("beyond")
    rows = C.together(index.filter("yr <= 1995").withColumn("collection_id", F.lit("gm5")), index.filter("yr >= 1995").withColumn("collection_id", F.lit("gm7")), share.withColumn("collection_id", F.lit("fc")))
    name = F.concat(F.lit("f"), F.col("tile").cast("string"), F.lit("_"), F.col("site").cast("string"))
    return rows.select(name.alias("footprint_id"), F.col("yr").alias("year"), "metric", F.round("value", 6).alias("value"), "collection_id", "n_member", "n_valid", "computable", "reason")


def links(spark, sf):
    v = values(spark, sf).select("tile", "site").distinct()
    text = lambda *cs: F.concat(*[F.lit(c) if c in ("s", "f", "_") else F.col(c).cast("string") for c in cs])
    many = F.when((F.col("tile") + F.col("site")) % 3 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return v.withColumn("k", F.explode(many)).select(text("s", "tile", "_", "site", "_", "k").alias("site_id"), text("f", "tile", "_", "site").alias("footprint_id"), (F.col("tile") == 3).alias("forced"))


def trajectories(spark, sf):
    l = links(spark, sf)
    return T.fan_out(footprint_rows(spark, sf), l).join(l.select("site_id", "forced"), "site_id")


def stored_trajectories(spark, sf):
    """The trajectories made once, as a run leaves them: what looks at them several times reads a table and does not reduce pixels anew."""
    return cut(trajectories(spark, sf))


COLUMNS = ["site_id", "footprint_id", "year", "metric", "value", "collection_id", "n_member", "n_valid", "computable", "reason", "shared_sites"]


@query("j22_fan_out", f"{TRAJ} SELECT {', '.join(COLUMNS)} FROM traj")
def fan_out(spark, sf):
    return trajectories(spark, sf).select(*COLUMNS)


@query("w5_transition_years", f"{with_views('catalogue')}, c AS (SELECT DISTINCT concat(tx, '_', ty) AS key, source_id, item_year AS year FROM catalogue WHERE source_id <> 'fc'), s AS (SELECT key, year, list_sort(list(source_id)) AS s FROM c GROUP BY 1, 2) SELECT a.key, a.year, len(a.s) > 1 OR coalesce(a.s <> p.s, false) OR coalesce(a.s <> n.s, false) AS adjacent FROM s a LEFT JOIN s p ON a.key = p.key AND p.year = a.year - 1 LEFT JOIN s n ON a.key = n.key AND n.year = a.year + 1")
def transition_years(spark, sf):
    c = view(spark, sf, "catalogue").filter("source_id <> 'fc'")
    return T.transition_years(c.select(F.concat_ws("_", F.col("tx").cast("string"), F.col("ty").cast("string")).alias("key"), "source_id", F.col("item_year").alias("year")))


@query("j15_many_to_one", f"{with_views('sites')} SELECT 'missing_key' AS \"check\", count(DISTINCT project_code) AS n, concat(min(project_code), ',', max(project_code)) AS examples FROM sites WHERE project_code NOT IN (SELECT concat('P', c_custkey) FROM customer WHERE c_custkey % 5 <> 0) UNION ALL SELECT 'duplicate_key', 0, ''")
def many_to_one(spark, sf):
    customers = spark.read.parquet(f"{sf}/customer.parquet").filter("c_custkey % 5 <> 0").select(F.concat(F.lit("P"), F.col("c_custkey").cast("string")).alias("project_code"), "c_name")
    return T.many_to_one_checks(view(spark, sf, "sites").filter("project_code IS NOT NULL"), customers, "project_code")


@query(
    "j21_compared_series",
    f"""{TRAJ}, a AS (SELECT site_id, year, metric, value, computable, n_member AS n_pixels FROM traj WHERE collection_id = 'fc' AND year <> 1999),
b AS (SELECT site_id, year, metric, CASE WHEN year = 1996 THEN value + 0.01 WHEN year = 1997 THEN value + 0.2 ELSE value END AS value, CASE WHEN year = 1998 THEN NOT computable ELSE computable END AS computable, CASE WHEN year = 1995 THEN n_member + 1 ELSE n_member END AS n_pixels FROM traj WHERE collection_id = 'fc' AND year <> 2000),
j AS (SELECT coalesce(a.site_id, b.site_id) AS site_id, coalesce(a.year, b.year) AS year, coalesce(a.metric, b.metric) AS metric, round(abs(a.value - b.value), 6) AS difference,
 CASE WHEN a.computable IS NULL THEN 'missing_in_extracted' WHEN b.computable IS NULL THEN 'missing_in_reference' WHEN a.computable <> b.computable THEN 'computability_differs' WHEN NOT a.computable THEN NULL WHEN a.n_pixels <> b.n_pixels THEN 'pixel_count_differs' WHEN abs(a.value - b.value) > 0.1 THEN 'out_of_tolerance' END AS reason FROM a FULL JOIN b ON a.site_id = b.site_id AND a.year = b.year AND a.metric = b.metric)
SELECT * FROM j WHERE reason IS NOT NULL""",
)
def compared_series(spark, sf):
    t = trajectories(spark, sf).filter("collection_id = 'fc'").select("site_id", "year", "metric", "value", "computable", F.col("n_member").alias("n_pixels"))
    y = F.col("year")
    other = t.filter(y != 2000).withColumns({"value": F.when(y == 1996, F.col("value") + 0.01).when(y == 1997, F.col("value") + 0.2).otherwise(F.col("value")), "computable": F.when(y == 1998, ~F.col("computable")).otherwise(F.col("computable")), "n_pixels": F.when(y == 1995, F.col("n_pixels") + 1).otherwise(F.col("n_pixels"))})
    return T.compare_series(t.filter(y != 1999), other, {"bare": 0.1}, 0.1)


@query("a30_reason_counts", f"{TRAJ} SELECT reason, count(*) AS n FROM traj WHERE NOT computable GROUP BY 1")
def reason_counts(spark, sf):
    return T.reason_counts(trajectories(spark, sf))


_RULES = ["null_in_required", "unknown_metric", "unknown_reason", "computable_without_value", "value_without_computable", "reason_with_computable", "no_reason", "share_below_one", "duplicate_key"]


_BAD_ROWS = {
    "null_in_required": ("year = 1995 AND metric = 'nbr'", "footprint_id", "NULL"),
    "unknown_metric": ("year = 1996 AND metric = 'pv'", "metric", "'odd'"),
    "unknown_reason": ("year = 2001 AND NOT computable", "reason", "'odd'"),
    "computable_without_value": ("year = 1997 AND metric = 'bare' AND computable", "value", "NULL"),
    "value_without_computable": ("year = 1998 AND NOT computable", "value", "0.5"),
    "reason_with_computable": ("year = 1999 AND computable", "reason", "'zero_valid_pixels'"),
    "no_reason": ("year = 2000 AND NOT computable", "reason", "NULL"),
    "share_below_one": ("year = 1997 AND metric = 'ndmi'", "shared_sites", "0"),
}
_TWICE = "year = 1996 AND metric = 'bare'"
_KEY_TEXT = "concat_ws('|', site_id, year, metric, collection_id)"


@query("v01_trajectory_checks", f"{TRAJ} {planted_sql('traj', _BAD_ROWS, 'site_id')} UNION ALL {planted_sql('traj', {'duplicate_key': (_TWICE, '', '')}, _KEY_TEXT)}")
def trajectory_checks(spark, sf):
    t = trajectories(spark, sf)
    return T.trajectory_checks(planted(t, _BAD_ROWS).unionByName(t.filter(_TWICE)))


_CLAIMS = "SELECT collection_id, year, count(*) + CASE WHEN year = 1997 THEN 1 ELSE 0 END AS rows, count(*) FILTER (WHERE NOT computable) + CASE WHEN year = 1996 THEN 2 ELSE 0 END AS not_computable FROM {} GROUP BY 1, 2"


@query(
    "v05_claimed_totals",
    f"""{TRAJ}, c AS ({_CLAIMS.format("traj")}), d AS (SELECT count(*) FILTER (year = 1997) AS a, count(*) FILTER (year = 1996) AS b FROM c), t AS (SELECT count(*) AS n, count(*) FILTER (NOT computable) AS k FROM traj)
SELECT 'partition_rows' AS "check", a AS n, CAST(NULL AS BIGINT) AS claimed, CAST(NULL AS BIGINT) AS found FROM d UNION ALL SELECT 'partition_not_computable', b, NULL, NULL FROM d UNION ALL SELECT 'total_rows', 1, t.n + a, t.n FROM d, t UNION ALL SELECT 'total_not_computable', 1, k + 2 * b, k FROM d, t
UNION ALL SELECT 'sites', 2, count(DISTINCT site_id), count(DISTINCT site_id) FROM traj""",
)
def claimed_totals(spark, sf):
    t = stored_trajectories(spark, sf)
    sites = t.select("site_id").distinct()
    wrong = F.min("site_id").alias("site_id")  # the claim has one site under another name
    claimed = sites.join(F.broadcast(sites.agg(wrong)), "site_id", "left_anti").unionByName(sites.agg(F.concat(F.min("site_id"), F.lit("x")).alias("site_id")))
    return T.claimed_totals(t, spark.sql(_CLAIMS.format("{t}"), t=t), claimed)


@query("v05_paths", f"{with_views('catalogue')} SELECT 'key_against_path' AS \"check\", count(*) FILTER (item_no % 9 = 0) AS n, concat_ws(',', min(source_id || '/' || item_year) FILTER (item_no % 9 = 0), max(source_id || '/' || item_year) FILTER (item_no % 9 = 0)) AS examples FROM catalogue UNION ALL SELECT 'no_key_in_path', count(*) FILTER (item_no % 9 = 1), concat_ws(',', min(source_id || '/' || item_year) FILTER (item_no % 9 = 1), max(source_id || '/' || item_year) FILTER (item_no % 9 = 1)) FROM catalogue")
def paths(spark, sf):
    k = F.col("item_no") % 9
    year = F.when(k == 0, F.col("item_year") + 1).otherwise(F.col("item_year")).cast("string")
    path = F.concat(F.lit("s3://t/source_id="), "source_id", F.when(k == 1, "/").otherwise("/item_year="), year, F.lit("/part-0.parquet"))
    return T.path_checks(view(spark, sf, "catalogue").withColumn("path", path), ("source_id", "item_year"), "path")


@query("v05_bracket", f"{with_views('catalogue')} SELECT source_id, item_year, CASE WHEN item_year = 1996 THEN 'vanished' WHEN item_year = 1997 THEN 'new' ELSE 'changed' END AS verdict FROM (SELECT source_id, item_year, count(*) FILTER (item_no % 50 = 7) AS k FROM catalogue GROUP BY 1, 2) WHERE item_year IN (1996, 1997) OR k > 0")
def bracket(spark, sf):
    from ..sources.tables import partition_digest

    c, keys = view(spark, sf, "catalogue"), ["source_id", "item_year"]
    digest = lambda df: partition_digest(df, keys, ["item_no", "tx", "ty"])
    after = c.withColumn("tx", F.when(F.col("item_no") % 50 == 7, F.col("tx") + 1).otherwise(F.col("tx")))
    return T.digest_bracket(digest(c.filter("item_year <> 1997")), digest(after.filter("item_year <> 1996")), keys)


@query(
    "v05_acceptance",
    f"""{TRAJ}, dropped AS (SELECT * FROM traj WHERE NOT (collection_id = 'fc' AND year = 1996) AND site_id NOT LIKE 's3\\_%\\_0' ESCAPE '\\'), p AS (SELECT collection_id, year, count(*) AS rows, count(DISTINCT site_id) AS ns, count(DISTINCT metric) AS nm FROM dropped GROUP BY 1, 2),
n AS (SELECT count(DISTINCT site_id) AS total FROM links), same AS (SELECT footprint_id, year, metric, collection_id, count(DISTINCT site_id) AS k, min(shared_sites) AS lo FROM dropped GROUP BY 1, 2, 3, 4)
SELECT unnest({_RULES}) AS "check", 0 AS n UNION ALL SELECT 'missing_partition', 1 UNION ALL SELECT 'stray_partition', 0 UNION ALL SELECT 'rows_per_partition', count(*) FILTER (rows <> ns * nm) FROM p UNION ALL SELECT 'metric_set', count(*) FILTER (nm <> 2) FROM p
UNION ALL SELECT 'site_set', count(*) FILTER (ns <> total) FROM p, n UNION ALL SELECT unnest(['unknown_site', 'footprint', 'forced_flag', 'shared_value', 'shared_reason']), 0 UNION ALL SELECT 'shared_count', count(*) FILTER (lo <> k) FROM same""",
)
def acceptance(spark, sf):
    t, l = stored_trajectories(spark, sf), cut(links(spark, sf))
    expected = t.select("collection_id", "year").distinct().withColumn("kind_metrics", F.lit(2))
    kept = t.filter("NOT (collection_id = 'fc' AND year = 1996)").filter(~F.col("site_id").rlike("^s3_.*_0$"))
    return T.acceptance(kept, l, expected)
