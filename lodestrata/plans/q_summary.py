"""Site summaries over the trajectory fixture; its context rows are derived from years and sites."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import summary as Y
from .fixtures import planted, planted_sql, view, with_views
from .q_trajectory import TRAJ, stored_trajectories, trajectories
from .registry import query

METRICS = ("bare", "pv", "nbr", "ndmi")
_N = "CAST(regexp_extract(site_id, '^s([0-9]+)_', 1) AS INTEGER)"
CTX = f"""{TRAJ}, ctx0 AS (SELECT DISTINCT site_id, year, {_N} AS k FROM traj), ctx AS (SELECT site_id, year, CASE WHEN year = 1995 THEN 'no_context_row' ELSE 'joined' END AS context_row_status,
 CASE WHEN year = 1995 THEN NULL WHEN (year + k) % 4 = 0 AND k <> 2 THEN 'recorded' WHEN year = 1998 THEN 'unknown' ELSE 'not_recorded' END AS fire_status, CASE WHEN year = 1995 THEN NULL WHEN (year + k) % 5 = 0 THEN 'not_computable' ELSE 'computed' END AS climate_status,
 CASE WHEN year <> 1995 AND (year + k) % 5 <> 0 THEN CAST(year % 7 * 100 + k AS DOUBLE) END AS annual_rainfall_mm, coalesce(year <> 1995 AND year <> 1998 AND (year + k) % 5 <> 0, false) AS context_complete FROM ctx0)"""


def context(t):
    y, k = F.col("year"), F.regexp_extract("site_id", "^s([0-9]+)_", 1).cast("int")
    rows = t.select("site_id", "year").distinct()
    gone, dry = y == 1995, (y + k) % 5 == 0
    return rows.select(
        "site_id", "year", F.when(gone, "no_context_row").otherwise("joined").alias("context_row_status"),
        F.when(gone, None).when(((y + k) % 4 == 0) & (k != 2), "recorded").when(y == 1998, "unknown").otherwise("not_recorded").alias("fire_status"), F.when(gone, None).when(dry, "not_computable").otherwise("computed").alias("climate_status"),
        F.when(~gone & ~dry, (y % 7 * 100 + k).cast("double")).alias("annual_rainfall_mm"), (~gone & (y != 1998) & ~dry).alias("context_complete"),
    )


_COVER = f"""{CTX}, cov AS (SELECT site_id, min(year) AS year_min, max(year) AS year_max, count(DISTINCT year) AS years_observed, count(DISTINCT year) FILTER (computable) AS years_computable FROM traj GROUP BY 1),
cc AS (SELECT site_id, count(DISTINCT year) FILTER (context_complete) AS c FROM ctx GROUP BY 1)"""


@query("a27_coverage_summary", f"{_COVER} SELECT cov.*, years_observed - years_computable AS years_not_computable, coalesce(c, 0) AS context_complete_years FROM cov LEFT JOIN cc USING (site_id)")
def coverage_summary(spark, sf):
    t = trajectories(spark, sf)
    return Y.coverage_summary(t, context(t))


_LATEST = f"{CTX}, l AS (SELECT site_id, metric, max(year) AS latest_year FROM traj WHERE computable GROUP BY 1, 2), latest AS (SELECT l.site_id, l.metric, latest_year, count(DISTINCT collection_id) AS n_collections, CASE WHEN count(DISTINCT collection_id) = 1 THEN min(value) END AS value FROM l JOIN traj t ON t.site_id = l.site_id AND t.metric = l.metric AND t.year = latest_year AND computable GROUP BY 1, 2, 3)"


@query("w6_latest_per_metric", f"{_LATEST} SELECT * FROM latest")
def latest_per_metric(spark, sf):
    return Y.latest_per_metric(trajectories(spark, sf))


@query("a28_fire_summary", f"{CTX} SELECT site_id, arg_max(fire_status, year) AS fire_status_latest, count(DISTINCT year) FILTER (fire_status = 'recorded') AS fire_years_recorded, max(year) FILTER (fire_status = 'recorded') AS last_recorded_fire_year FROM ctx WHERE context_row_status = 'joined' GROUP BY 1")
def fire_summary(spark, sf):
    return Y.fire_summary(context(trajectories(spark, sf)))


@query("a29_climate_summary", f"{CTX} SELECT site_id, round(avg(annual_rainfall_mm), 6) AS rainfall_annual_mean, arg_max(annual_rainfall_mm, year) AS rainfall_latest, max(year) AS rainfall_latest_year FROM ctx WHERE climate_status = 'computed' GROUP BY 1")
def climate_summary(spark, sf):
    return Y.climate_summary(context(trajectories(spark, sf))).withColumn("rainfall_annual_mean", F.round("rainfall_annual_mean", 6))


def _wide(m: str) -> str:
    return f"max(value) FILTER (metric = '{m}') AS {m}_latest, max(latest_year) FILTER (metric = '{m}') AS {m}_latest_year, max(n_collections) FILTER (metric = '{m}') AS {m}_latest_collections"


@query(
    "a27_a29_site_summary",
    f"""{_COVER.replace(CTX, _LATEST)}, wide AS (SELECT site_id, {", ".join(map(_wide, METRICS))} FROM latest GROUP BY 1),
fs AS (SELECT site_id, arg_max(fire_status, year) AS fire_status_latest, count(DISTINCT year) FILTER (fire_status = 'recorded') AS fire_years_recorded, max(year) FILTER (fire_status = 'recorded') AS last_recorded_fire_year FROM ctx WHERE context_row_status = 'joined' GROUP BY 1),
cs AS (SELECT site_id, round(avg(annual_rainfall_mm), 6) AS rainfall_annual_mean, arg_max(annual_rainfall_mm, year) AS rainfall_latest, max(year) AS rainfall_latest_year FROM ctx WHERE climate_status = 'computed' GROUP BY 1)
SELECT cov.*, years_observed - years_computable AS years_not_computable, coalesce(c, 0) AS context_complete_years, wide.* EXCLUDE (site_id), fire_status_latest, coalesce(fire_years_recorded, 0) AS fire_years_recorded, last_recorded_fire_year, cs.* EXCLUDE (site_id)
FROM cov LEFT JOIN cc USING (site_id) LEFT JOIN wide USING (site_id) LEFT JOIN fs USING (site_id) LEFT JOIN cs USING (site_id)""",
)
def site_summary(spark, sf):
    t = stored_trajectories(spark, sf)
    return Y.site_summary(t, context(t), METRICS).withColumn("rainfall_annual_mean", F.round("rainfall_annual_mean", 6))


_CHECKS = ["null_required", "years_disagree", "fire_vocabulary", "last_fire_year", *[f"{m}_overlap_resolved" for m in METRICS]]


_BAD_SITES = {
    "null_required": ("site_id LIKE 's0%'", "year_min", "NULL"),
    "years_disagree": ("site_id LIKE 's1%'", "years_computable", "years_computable + 1"),
    "fire_vocabulary": ("site_id LIKE 's2%' AND fire_status_latest IS NOT NULL", "fire_status_latest", "'odd'"),
    "last_fire_year": ("site_id LIKE 's3%'", "last_recorded_fire_year", "CASE WHEN last_recorded_fire_year IS NULL THEN 1990 END"),
}
_OVERLAPS = {f"{m}_overlap_resolved": f"site_id LIKE 's{4 + i}%'" for i, m in enumerate(METRICS)}


@query("v04_summary_checks", f"{TRAJ}, latest AS (SELECT DISTINCT site_id, max(year) FILTER (context_ok) OVER (PARTITION BY site_id) AS y FROM (SELECT site_id, year, year <> 1995 AS context_ok FROM traj)), s AS (SELECT site_id, CASE WHEN y IS NOT NULL THEN 'some' END AS fire_status_latest, 0 AS year_min, 0 AS years_computable, 0 AS last_recorded_fire_year FROM latest) {planted_sql('s', _BAD_SITES, 'site_id')} UNION ALL {planted_sql('s', {k: (w, '', '') for k, w in _OVERLAPS.items()}, 'site_id')}")
def summary_checks(spark, sf):
    t = stored_trajectories(spark, sf)
    s = planted(Y.site_summary(t, context(t), METRICS), _BAD_SITES)
    for m, where in zip(METRICS, _OVERLAPS.values(), strict=True):
        s = planted(s, {"a": (where, f"{m}_latest", "0.5"), "b": (where, f"{m}_latest_collections", "2")})
    return Y.summary_checks(s, METRICS)


_LAYER = f"{with_views('sites')}, m AS (SELECT DISTINCT site_id FROM sites WHERE site_id IS NOT NULL AND row_no % 2 = 0), p AS (SELECT site_id, x, y FROM sites WHERE x IS NOT NULL QUALIFY row_number() OVER (PARTITION BY site_id ORDER BY row_no) = 1)"


@query("s12_eligible_layer", f"{_LAYER} SELECT m.site_id, x, y FROM m JOIN p ON m.site_id = p.site_id")
def eligible_layer(spark, sf):
    s = view(spark, sf, "sites")
    return Y.located_layers(s.filter("site_id IS NOT NULL AND row_no % 2 = 0").select("site_id").distinct(), s)[1]


@query("s12_unlocated", f"{_LAYER} SELECT count(*) AS unlocated FROM m LEFT JOIN p ON m.site_id = p.site_id WHERE x IS NULL")
def unlocated(spark, sf):
    s = view(spark, sf, "sites")
    return Y.located_layers(s.filter("site_id IS NOT NULL AND row_no % 2 = 0").select("site_id").distinct(), s)[2]
