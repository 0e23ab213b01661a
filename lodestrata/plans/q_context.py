"""Context queries over high-confidence pairs; fires by footprint, rain by two cells."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import context as K
from ..operators import spatial as X
from ..operators.lineage import cut
from .fixtures import fire_polygons, footprint_polygons, planted, planted_sql, view, with_views
from .q_spatial import CELL, CROSSWALK, first_matches, population
from .registry import query

YEARS, ALL_YEARS, BASE, SNAPSHOT = (1994, 2001), (1992, 2001), (1996, 2000), 2000
_DAYS = "CASE WHEN year % 4 = 0 THEN 366 ELSE 365 END"
RAIN = f"""rain AS (SELECT cell, d, rain_mm FROM ({with_views("daily_rain").split("AS (", 1)[1][:-1]})), g AS (SELECT cell, year(d) AS year, sum(CAST(rain_mm AS DOUBLE)) AS t, count(*) FILTER (CAST(rain_mm AS DOUBLE) >= 1.0) AS k, count(*) AS n FROM rain GROUP BY 1, 2),
annual AS (SELECT cell, year, CASE WHEN n = {_DAYS} THEN t END AS total_mm, CASE WHEN n = {_DAYS} THEN k END AS rain_days, CASE WHEN n <> {_DAYS} THEN concat({_DAYS} - n, ' missing days') END AS reason FROM g),
base AS (SELECT c.cell, CASE WHEN count(a.total_mm) = 5 THEN avg(a.total_mm) END AS baseline_mm, CASE WHEN count(a.total_mm) < 5 THEN concat('baseline lacks ', string_agg(CAST(y.y AS VARCHAR), ',' ORDER BY y.y) FILTER (a.total_mm IS NULL)) END AS gap FROM (SELECT DISTINCT cell FROM annual) c CROSS JOIN range(1996, 2001) y(y) LEFT JOIN annual a ON a.cell = c.cell AND a.year = y.y GROUP BY 1),
anomaly AS (SELECT a.cell, a.year, CASE WHEN coalesce(gap, reason) IS NULL THEN total_mm END AS total_mm, CASE WHEN coalesce(gap, reason) IS NULL THEN rain_days END AS rain_days, CASE WHEN coalesce(gap, reason) IS NULL THEN total_mm - baseline_mm END AS anomaly_mm, coalesce(gap, reason) AS reason FROM annual a JOIN base b ON a.cell = b.cell)"""
FIRE_COUNTS = with_views("fires").split("AS (", 1)[1][:-1]
CONTEXT = f"""{CROSSWALK}, fires AS ({FIRE_COUNTS}), pairs AS (SELECT site_id, min(footprint_id) AS footprint_id FROM crosswalk WHERE confidence = 'high' GROUP BY 1), {RAIN},
fc AS (SELECT footprint_id, fire_year, count(*) AS n FROM (SELECT footprint_id, kind, f.cx AS fx, f.cy AS fy, p.cx, p.cy, hx, hy, half, fire_year FROM footprints p, fires f WHERE abs(f.cx - p.cx) <= half + hx AND abs(f.cy - p.cy) <= half + hy) WHERE kind = 'rect' OR greatest(abs(fx - cx) - half, 0) * hy + greatest(abs(fy - cy) - half, 0) * hx <= hx * hy GROUP BY 1, 2),
sc AS (SELECT site_id, pairs.footprint_id, part_no, y.y AS year FROM pairs JOIN footprints USING (footprint_id) CROSS JOIN range(1994, 2002) y(y)),
fire AS (SELECT site_id, sc.footprint_id, year, CASE WHEN part_no % 17 = 0 THEN 'unknown' WHEN n > 0 THEN 'recorded' WHEN year BETWEEN 1937 AND 1999 THEN 'not_recorded' ELSE 'unknown' END AS fire_status,
 CAST(CASE WHEN part_no % 17 = 0 THEN NULL WHEN n > 0 THEN n WHEN year BETWEEN 1937 AND 1999 THEN 0 END AS INTEGER) AS fire_record_count, CASE WHEN part_no % 17 = 0 THEN 'no_footprint' WHEN year BETWEEN 1937 AND 1999 THEN 'covered' ELSE 'outside_window' END AS fire_coverage_status,
 CASE WHEN part_no % 17 = 0 THEN 'null' WHEN coalesce(n, 0) = 0 AND year > 1999 THEN 'outside_coverage_window' END AS fire_reason FROM sc LEFT JOIN fc ON sc.footprint_id = fc.footprint_id AND sc.year = fc.fire_year),
climate AS (SELECT site_id, sc.footprint_id, sc.year, part_no % 2 AS cell, total_mm AS annual_rainfall_mm, rain_days AS rain_days_ge_1mm, anomaly_mm AS rainfall_anomaly_mm, coalesce(gap, reason, CASE WHEN total_mm IS NULL THEN 'no daily values' END) AS climate_reason
 FROM sc LEFT JOIN base ON base.cell = part_no % 2 LEFT JOIN anomaly a ON a.cell = part_no % 2 AND a.year = sc.year),
context AS (SELECT f.site_id, f.footprint_id, f.year, fire_status, fire_record_count, fire_coverage_status, fire_reason, cell, annual_rainfall_mm, rain_days_ge_1mm, rainfall_anomaly_mm, CASE WHEN climate_reason IS NULL THEN 'computed' ELSE 'not_computable' END AS climate_status, climate_reason, 'joined' AS context_row_status, NULL AS no_context_row_reason,
 fire_coverage_status = 'covered' AND climate_reason IS NULL AS context_complete FROM fire f JOIN climate c ON f.site_id = c.site_id AND f.year = c.year
 UNION ALL SELECT site_id, footprint_id, y.y, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, 'no_context_row', concat('no context for ', y.y, ': it begins in 1994'), false FROM pairs CROSS JOIN range(1992, 1994) y(y))"""


def pairs(spark, sf):
    return first_matches(spark, sf).filter("confidence = 'high'").select("site_id", "footprint_id")


def annual(spark, sf):
    return K.annual_rain(view(spark, sf, "daily_rain"))


def _none(spark, sf):
    return view(spark, sf, "footprints").filter("part_no % 17 = 0").select("footprint_id", F.lit("null").alias("no_footprint_reason"))


def _cells(spark, sf):
    return view(spark, sf, "footprints").select("footprint_id", (F.col("part_no") % 2).alias("cell"))


def fire(spark, sf, of):
    return K.fire_context(of, X.fire_year_counts(footprint_polygons(spark, sf), fire_polygons(spark, sf), CELL), _none(spark, sf), YEARS, SNAPSHOT)


def climate(spark, sf, of=None):
    return K.climate_context(pairs(spark, sf) if of is None else of, _cells(spark, sf), annual(spark, sf), BASE, YEARS)


def high_places(spark, sf):
    """Places of high confidence with their first footprint, its fires by year and its cell, kept: what is asked of pairs depends on their place alone."""
    per = X.first_matches_of_places(population(spark, sf), footprint_polygons(spark, sf), "footprint_id", CELL)
    at = cut(per.filter("confidence = 'high'").select("x", "y", "footprint_id"))
    ours = at.select("footprint_id").distinct()
    counts = X.fire_year_counts(footprint_polygons(spark, sf).join(ours, "footprint_id", "left_semi"), fire_polygons(spark, sf), CELL)
    return cut(K.with_fires(at, counts, _none(spark, sf), YEARS).join(_cells(spark, sf).join(ours, "footprint_id", "left_semi"), "footprint_id", "left"))


def at_places(spark, sf, at):
    """Pairs with what is known of their place; dealt by site, as the population is."""
    return K.on_places(population(spark, sf), at)


def context(spark, sf, at):
    return K.context_rows(at_places(spark, sf, at), annual(spark, sf), BASE, YEARS, ALL_YEARS, SNAPSHOT)


@query("a15_annual_rain", f"WITH {RAIN} SELECT cell, year, round(total_mm, 6) AS total_mm, rain_days, reason FROM annual")
def annual_rain(spark, sf):
    return annual(spark, sf).withColumn("total_mm", F.round("total_mm", 6))


@query("a16_rain_anomaly", f"WITH {RAIN} SELECT cell, year, round(total_mm, 6) AS total_mm, rain_days, round(anomaly_mm, 6) AS anomaly_mm, reason FROM anomaly")
def rain_anomaly(spark, sf):
    return K.rain_anomaly(annual(spark, sf), BASE).withColumns({c: F.round(c, 6) for c in ("total_mm", "anomaly_mm")})


@query("s04_daily_cells", f"WITH {RAIN} SELECT cell, CAST(d AS VARCHAR) AS d, round(CAST(rain_mm AS DOUBLE), 6) AS rain_mm FROM rain WHERE cell = 1")
def daily_cells(spark, sf):
    from ..sources.tables import scan_daily_grid

    wanted = spark.range(1, 2).select(F.col("id").alias("cell"))
    got = scan_daily_grid(view(spark, sf, "daily_rain").withColumn("rain_mm", F.col("rain_mm").cast("double")), wanted, ["cell"], "rain_mm")
    return got.select("cell", F.col("d").cast("string").alias("d"), F.round("rain_mm", 6).alias("rain_mm"))


@query("j17_scaffold", f"{CONTEXT} SELECT site_id, footprint_id, year FROM sc")
def scaffold(spark, sf):
    return K.scaffold(pairs(spark, sf), YEARS)


@query("j18_fire_context", f"{CONTEXT} SELECT * FROM fire")
def fire_context(spark, sf):
    return K.fire_years(at_places(spark, sf, high_places(spark, sf)), YEARS, SNAPSHOT)


_ROUNDED = {"annual_rainfall_mm", "rainfall_anomaly_mm"}


@query("j19_climate_context", f"{CONTEXT} SELECT site_id, footprint_id, year, cell, round(annual_rainfall_mm, 6) AS annual_rainfall_mm, rain_days_ge_1mm, round(rainfall_anomaly_mm, 6) AS rainfall_anomaly_mm, CASE WHEN climate_reason IS NULL THEN 'computed' ELSE 'not_computable' END AS climate_status, climate_reason FROM climate")
def climate_context(spark, sf):
    return climate(spark, sf).withColumns({c: F.round(c, 6) for c in _ROUNDED})


@query("j20_context_join", f"{CONTEXT} SELECT * REPLACE (round(annual_rainfall_mm, 6) AS annual_rainfall_mm, round(rainfall_anomaly_mm, 6) AS rainfall_anomaly_mm) FROM context")
def context_join(spark, sf):
    return context(spark, sf, high_places(spark, sf)).withColumns({c: F.round(c, 6) for c in _ROUNDED})


_CHECKS = ["unknown_row_status", "payload_on_absent", "absent_without_reason", "joined_with_reason", "joined_without_status", "unknown_with_count", "computed_without_total", "complete_flag", "year_outside_range", "years_per_site", "duplicate_key"]


_BAD_ROWS = {
    "payload_on_absent": ("year = 1992", "fire_status", "'recorded'"),
    "absent_without_reason": ("year = 1993", "no_context_row_reason", "NULL"),
    "joined_with_reason": ("year = 1994", "no_context_row_reason", "'why'"),
    "joined_without_status": ("year = 1995 AND NOT context_complete", "climate_status", "NULL"),
    "unknown_with_count": ("year = 1996 AND fire_status = 'unknown'", "fire_record_count", "1"),
    "computed_without_total": ("year = 1997 AND climate_status = 'computed'", "annual_rainfall_mm", "NULL"),
    "complete_flag": ("year = 1998", "context_complete", "NOT context_complete"),
    "year_outside_range": ("year = 1999", "year", "2099"),
    "unknown_row_status": ("year = 2001", "context_row_status", "'odd'"),
}
_GONE, _TWICE = "year = 2000 AND site_id LIKE '%1'", "year = 2000 AND site_id LIKE '%2'"


@query(
    "v03_context_checks",
    f"""{CONTEXT} {planted_sql("context", _BAD_ROWS, "site_id")} UNION ALL SELECT 'years_per_site', count(*) FILTER (site_id LIKE '%1' OR site_id LIKE '%2'), '' FROM pairs UNION ALL SELECT 'duplicate_key', count(*), concat_ws(',', min(concat(site_id, '|2000')), max(concat(site_id, '|2000'))) FROM context WHERE {_TWICE}
UNION ALL SELECT 'forbidden_name', 1, 'fire_cause'""",
)
def context_checks(spark, sf):
    at = high_places(spark, sf)
    # the second copies are made where their rows are, as a union would have to be dealt by site anew
    c = context(spark, sf, at).filter(f"NOT ({_GONE})").withColumn("_copy", F.explode(F.expr(f"IF({_TWICE}, array(0, 1), array(0))")))
    rows = planted(c, {k: (f"_copy = 0 AND {where}", column, value) for k, (where, column, value) in _BAD_ROWS.items()}).drop("_copy").withColumn("fire_cause", F.lit(None).cast("string"))
    return K.context_checks(rows, at_places(spark, sf, at), ALL_YEARS)


@query(
    "v03_status_reconciliation",
    f"""{CONTEXT}, k AS (SELECT 'fire_status' AS status, fire_status AS value, count(*) AS n_source, count(*) FILTER (site_id NOT LIKE '%1') AS n_joined FROM fire GROUP BY 1, 2 UNION ALL
 SELECT 'climate_status', CASE WHEN climate_reason IS NULL THEN 'computed' ELSE 'not_computable' END, count(*), count(*) FILTER (site_id NOT LIKE '%1') FROM climate GROUP BY 1, 2) SELECT *, n_source = n_joined AS agree FROM k""",
)
def status_reconciliation(spark, sf):
    at = high_places(spark, sf)
    of = at_places(spark, sf, at)
    return K.status_reconciliation(context(spark, sf, at).filter("site_id NOT LIKE '%1'"), {"fire_status": K.fire_years(of, YEARS, SNAPSHOT), "climate_status": K.climate_years(of.filter("cell IS NOT NULL"), annual(spark, sf), BASE, YEARS)})


@query("v03_join_checks", f"{CONTEXT}, x AS (SELECT count(*) AS n, concat(min(site_id), ',', max(site_id)) AS e FROM fire WHERE year = 1994) SELECT 'only_in_fire' AS \"check\", n, e AS examples FROM x UNION ALL SELECT unnest(['only_in_climate', 'footprint_disagrees', 'year_outside_range', 'duplicate_fire', 'duplicate_climate']), 0, ''")
def join_checks(spark, sf):
    of = cut(pairs(spark, sf))  # both read them
    return K.join_checks(fire(spark, sf, of), climate(spark, sf, of).filter("year > 1994"), ALL_YEARS)


@query("v09_fire_record_checks", f"{with_views('fires')} SELECT 'unknown_code' AS \"check\", count(*) AS n, concat(min(CAST(event_id AS VARCHAR)), ',', max(CAST(event_id AS VARCHAR))) AS examples FROM fires WHERE upper(trim(fire_type)) NOT IN ('WF', 'PB') UNION ALL SELECT 'null_year', 0, '' UNION ALL SELECT 'year_outside', count(*), concat(min(CAST(event_id AS VARCHAR)), ',', max(CAST(event_id AS VARCHAR))) FROM fires WHERE fire_year > 2000")
def fire_record_checks(spark, sf):
    return K.fire_record_checks(view(spark, sf, "fires"), ("WF", "PB"), 1900, 2000)


@query("v10_daily_grid_checks", f"WITH {RAIN}, e AS (SELECT * FROM (SELECT DISTINCT cell FROM g) CROSS JOIN (SELECT DISTINCT year FROM g)) SELECT e.cell, e.year, coalesce(n, 0) AS n_days, {_DAYS.replace('year', 'e.year')} - coalesce(n, 0) AS missing_days FROM e LEFT JOIN g ON e.cell = g.cell AND e.year = g.year WHERE {_DAYS.replace('year', 'e.year')} <> coalesce(n, 0)")
def daily_grid_checks(spark, sf):
    return K.daily_grid_checks(view(spark, sf, "daily_rain"))


@query("v10_grid_spacing", "WITH v AS (SELECT DISTINCT CAST(CASE l_discount WHEN 0.05 THEN 0.2 ELSE l_discount END AS DOUBLE) AS v FROM lineitem), n AS (SELECT v, lead(v) OVER (ORDER BY v) AS w FROM v) SELECT count(*) AS n_values, count(*) FILTER (round(w - v, 6) <> 0.01) AS n_gaps FROM n")
def grid_spacing(spark, sf):
    v = F.col("l_discount").cast("double")  # one value is moved away, which leaves two gaps
    return K.spacing_checks(spark.read.parquet(f"{sf}/lineitem.parquet").select(F.when(v == 0.05, 0.2).otherwise(v).alias("v0")), "v0", 0.01)


@query(
    "v10_grid_cover",
    """WITH c AS (SELECT min(CAST(l_tax AS DOUBLE)) AS x1, max(CAST(l_tax AS DOUBLE)) AS x2, min(CAST(l_discount AS DOUBLE)) AS y1, max(CAST(l_discount AS DOUBLE)) AS y2 FROM lineitem)
SELECT 'short_west' AS "check", CAST(x1 - 0.005 > 0.004 AS BIGINT) AS n, '' AS examples FROM c UNION ALL SELECT 'short_south', CAST(y1 - 0.005 > -0.02 AS BIGINT), CAST(y1 + 0.0 AS VARCHAR) FROM c UNION ALL SELECT 'short_east', CAST(x2 + 0.005 < 0.084 AS BIGINT), '' FROM c UNION ALL SELECT 'short_north', CAST(y2 + 0.005 < 0.2 AS BIGINT), CAST(y2 AS VARCHAR) FROM c""",
)
def grid_cover(spark, sf):
    """A grid that reaches two sides of the box that it must cover, and not the other two."""
    cells = spark.read.parquet(f"{sf}/lineitem.parquet").select(F.col("l_tax").cast("double").alias("lon"), F.col("l_discount").cast("double").alias("lat"))
    return K.cover_checks(cells, "lon", "lat", (0.004, -0.02, 0.084, 0.2), 0.01)


@query("v14_context_holes", f"{with_views('catalogue')} SELECT year, CASE WHEN year >= 1996 THEN 'hole' ELSE 'absent' END AS verdict FROM (SELECT DISTINCT item_year AS year FROM catalogue) WHERE year NOT IN (1996, 1997, 1999)")
def context_holes(spark, sf):
    c = view(spark, sf, "catalogue").select(F.col("item_year").alias("year"))
    return K.context_holes(c, c.filter("year IN (1996, 1997, 1999)"))


@query("v15_row_counts", f"{CONTEXT} SELECT (SELECT count(*) FROM fire) AS rows, (SELECT count(*) * 8 FROM pairs) AS expected, (SELECT count(*) FROM fire) AS by_status, true AS agree")
def row_counts(spark, sf):
    of = at_places(spark, sf, high_places(spark, sf))
    return K.row_count_checks(K.fire_years(of, YEARS, SNAPSHOT), of, 8, "fire_status")
