"""Register queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import contracts as C
from ..operators import register as R
from .fixtures import view, with_views
from .q_scalars import NAME_SQL, PCT_SQL, SORT_SQL, STAGE_SQL
from .registry import query

_CURRENT = f"""{with_views("sites", "owners")},
cur AS (SELECT * FROM owners WHERE (end_date IS NULL OR trim(end_date) = '') AND coalesce(trim(project_code), '') <> ''),
one AS (SELECT * FROM cur QUALIFY row_number() OVER (PARTITION BY project_code, owner_code ORDER BY row_no, owner_name NULLS FIRST, holding_pct NULLS FIRST, end_date NULLS FIRST) = 1),
by_project AS (SELECT project_code, string_agg(concat({NAME_SQL}, CASE WHEN ({PCT_SQL}) IS NULL THEN ' (holding not stated)' ELSE concat(' (', {PCT_SQL}, '%)') END), '; ' ORDER BY {SORT_SQL}, owner_code) AS owners,
  count(*) AS n_owners, count(*) FILTER (trim(owner_name) = '') AS n_unnamed, count(*) FILTER (({PCT_SQL}) IS NULL) AS n_unstated FROM one GROUP BY 1)"""


@query("a01_w1_owners_by_project", f"{_CURRENT} SELECT * FROM by_project")
def owners_by_project(spark, sf):
    return R.owners_by_project(view(spark, sf, "owners"))


@query("a01_owner_disclosures", f"{_CURRENT} SELECT CAST(sum(n) AS BIGINT) AS current_rows, count(*) AS pairs, CAST(sum(n - 1) AS BIGINT) AS repeated_rows, count(DISTINCT project_code) AS projects FROM (SELECT project_code, owner_code, count(*) AS n FROM cur GROUP BY 1, 2)")
def owner_disclosures(spark, sf):
    return R.owner_disclosures(view(spark, sf, "owners"))


_JOINED = f"{_CURRENT}, joined AS (SELECT s.*, b.owners, b.n_owners FROM sites s LEFT JOIN by_project b ON s.project_code = b.project_code AND trim(s.project_code) <> '')"


@query("j13_sites_with_owners", f"{_JOINED} SELECT row_no, site_id, project_code, owners, n_owners FROM joined")
def sites_with_owners(spark, sf):
    return R.join_owners(view(spark, sf, "sites"), R.owners_by_project(view(spark, sf, "owners"))).select("row_no", "site_id", "project_code", "owners", "n_owners")


@query(
    "a02_owner_join_disclosures",
    f"""{_JOINED} SELECT count(*) AS sites, count(*) FILTER (coalesce(trim(project_code), '') = '') AS sites_without_project, count(*) FILTER (owners IS NOT NULL) AS sites_with_owner,
 count(*) FILTER (coalesce(trim(project_code), '') <> '' AND owners IS NULL) AS sites_without_owner, count(*) FILTER (n_owners > 1) AS sites_with_several_owners,
 (SELECT count(*) FROM by_project WHERE project_code NOT IN (SELECT project_code FROM sites WHERE project_code IS NOT NULL)) AS projects_without_site FROM joined""",
)
def owner_join_disclosures(spark, sf):
    return R.owner_join_disclosures(view(spark, sf, "sites"), R.owners_by_project(view(spark, sf, "owners")))


@query("a03_owner_row_composition", f"{with_views('owners')} SELECT count(*) AS total, count(*) FILTER (trim(end_date) = '') AS current, count(*) FILTER (trim(end_date) <> '') AS ended FROM owners")
def owner_row_composition(spark, sf):
    return R.owner_row_composition(view(spark, sf, "owners"))


@query("a05_duplicate_sites", f"{with_views('sites')} SELECT count(*) AS values, CAST(coalesce(sum(n), 0) AS BIGINT) AS rows FROM (SELECT site_id, count(*) AS n FROM sites WHERE site_id IS NOT NULL GROUP BY 1 HAVING count(*) > 1)")
def duplicate_sites(spark, sf):
    return R.duplication_counts(view(spark, sf, "sites"), "site_id")


_STATUS = f"""{with_views("sites")}, c AS (SELECT {STAGE_SQL} AS name, count(*) AS n FROM sites GROUP BY 1),
d AS (SELECT unnest(['operating', 'care_and_maintenance', 'closed', 'deposit', 'prospect', 'other']) AS name)"""


@query("a06_status_counts", f"{_STATUS} SELECT name, coalesce(n, 0) AS n FROM d LEFT JOIN c USING (name) UNION ALL SELECT 'total', CAST(sum(n) AS BIGINT) FROM c")
def status_counts(spark, sf):
    return R.status_counts(view(spark, sf, "sites"))


@query("a35_stage_counts", f"{with_views('sites')} SELECT stage AS value, count(*) AS n FROM sites GROUP BY 1")
def stage_counts(spark, sf):
    return R.value_counts(view(spark, sf, "sites"), "stage")


_POP = f"""{with_views("sites")}, p AS (SELECT *, site_id IS NULL AS null_id, site_id IS NOT NULL AND count(*) OVER (PARTITION BY site_id) > 1 AS duplicate_id, x IS NULL OR y IS NULL AS no_place FROM sites)"""


@query(
    "v12_crosswalk_population",
    f"{_POP} SELECT count(*) AS rows, count(*) FILTER (null_id) AS null_id, count(*) FILTER (duplicate_id) AS duplicate_id, count(*) FILTER (no_place) AS no_place, "
    "count(*) FILTER (NOT (null_id OR duplicate_id OR no_place)) AS included, count(*) FILTER (null_id OR duplicate_id OR no_place) AS excluded FROM p",
)
def crosswalk_population(spark, sf):
    return R.population_counts(view(spark, sf, "sites"))


@query(
    "j23_reconciled_codes",
    f"""{with_views("sites")}, a AS (SELECT DISTINCT site_id FROM sites WHERE site_id IS NOT NULL AND row_no % 3 <> 0 AND x IS NOT NULL), b AS (SELECT site_id, x FROM sites WHERE site_id IS NOT NULL AND row_no % 7 <> 0),
r AS (SELECT site_id, bool_or(x IS NOT NULL) AS placed FROM b WHERE site_id NOT IN (SELECT site_id FROM a) GROUP BY 1)
SELECT 'only_in_a' AS "check", count(*) AS n FROM a WHERE site_id NOT IN (SELECT site_id FROM b) UNION ALL SELECT 'only_in_b_no_place', count(*) FILTER (NOT placed) FROM r UNION ALL SELECT 'only_in_b_unexplained', count(*) FILTER (placed) FROM r""",
)
def reconciled_codes(spark, sf):
    s = view(spark, sf, "sites").filter("site_id IS NOT NULL")
    return R.reconcile_codes(s.filter("row_no % 3 <> 0 AND x IS NOT NULL"), s.filter("row_no % 7 <> 0"), "site_id", "x")


@query("v16_register_reconciliation", f"{_STATUS} SELECT (SELECT count(*) FROM orders) AS source_rows, (SELECT count(*) FROM sites) AS register_rows, CAST(sum(n) AS BIGINT) AS categories, (SELECT count(*) FROM orders) = sum(n) AS reconciled FROM c")
def register_reconciliation(spark, sf):
    return R.register_reconciliation(view(spark, sf, "sites"), spark.read.parquet(f"{sf}/orders.parquet"))


@query(
    "v06_code_bundle",
    f"""{with_views("sites", "owners")}, codes AS (SELECT DISTINCT project_code FROM sites WHERE coalesce(trim(project_code), '') <> '')
SELECT 'sites' AS "check", count(*) AS n FROM sites UNION ALL SELECT 'null_site_id', count(*) FROM sites WHERE site_id IS NULL UNION ALL SELECT 'null_stage', count(*) FROM sites WHERE stage IS NULL
UNION ALL SELECT 'blank_project', count(*) FROM sites WHERE coalesce(trim(project_code), '') = '' UNION ALL SELECT 'no_place', count(*) FROM sites WHERE x IS NULL OR y IS NULL
UNION ALL SELECT 'unmapped_stage', count(*) FROM sites WHERE stage = 'Mothballed'
UNION ALL SELECT 'duplicated_site_ids', count(*) FROM (SELECT site_id FROM sites WHERE site_id IS NOT NULL GROUP BY 1 HAVING count(*) > 1)
UNION ALL SELECT 'owner_codes_without_site', count(*) FROM (SELECT DISTINCT project_code FROM owners) WHERE project_code NOT IN (SELECT project_code FROM codes)
UNION ALL SELECT 'site_codes_without_owner', count(*) FROM codes WHERE project_code NOT IN (SELECT project_code FROM owners)""",
)
def code_bundle(spark, sf):
    return R.code_bundle_checks(view(spark, sf, "sites"), view(spark, sf, "owners"))


_BUNDLE = f"""{with_views("sites", "owners")}, layer AS (SELECT site_id, row_no FROM sites WHERE row_no % 7 <> 3 AND site_id IS NOT NULL UNION ALL SELECT site_id, row_no FROM sites WHERE row_no % 53 = 0)"""


def _layer(spark, sf):
    """A second layer of sites: some are not in it, some are twice."""
    s = view(spark, sf, "sites").select("site_id", "row_no")
    return s.filter("row_no % 7 <> 3 AND site_id IS NOT NULL").unionByName(s.filter("row_no % 53 = 0"))


@query(
    "v06_bundle_totals",
    f"""{_BUNDLE} SELECT 'rows_of_duplicated_ids' AS total, coalesce(CAST(sum(n) AS BIGINT), 0) AS n FROM (SELECT count(*) AS n FROM sites WHERE site_id IS NOT NULL GROUP BY site_id HAVING count(*) > 1)
UNION ALL SELECT 'projects', count(DISTINCT project_code) FROM sites WHERE trim(project_code) <> '' UNION ALL SELECT 'projects_with_current_owner', count(DISTINCT project_code) FROM owners WHERE coalesce(trim(end_date), '') = '' AND trim(project_code) <> ''
UNION ALL SELECT 'owner_rows_current', count(*) FROM owners WHERE coalesce(trim(end_date), '') = '' UNION ALL SELECT 'owner_rows_ended', count(*) FROM owners WHERE coalesce(trim(end_date), '') <> ''
UNION ALL SELECT 'sites_absent_from_layer', count(DISTINCT site_id) FROM sites WHERE site_id IS NOT NULL AND site_id NOT IN (SELECT site_id FROM layer WHERE site_id IS NOT NULL) UNION ALL SELECT 'layer_rows', count(*) FROM layer""",
)
def bundle_totals(spark, sf):
    return R.bundle_totals(view(spark, sf, "sites"), view(spark, sf, "owners"), _layer(spark, sf))


@query(
    "v06_bundle_refusals",
    f"""{_BUNDLE}, dates AS (SELECT DISTINCT 'sites' AS name, CASE WHEN row_no % 1009 = 1 THEN '2026-08-15' ELSE '2026-08-14' END AS date FROM sites UNION SELECT 'owners', '2026-08-14' FROM owners UNION SELECT 'layer', '2026-08-13' FROM layer),
d AS (SELECT site_id FROM layer WHERE site_id IS NOT NULL GROUP BY 1 HAVING count(*) > 1) SELECT 'extract_dates' AS "check", count(DISTINCT date) - 1 AS n, concat_ws(',', min(concat(name, '=', date)), max(concat(name, '=', date))) AS examples FROM dates UNION ALL SELECT 'duplicate_layer_id', count(*), concat_ws(',', min(site_id), max(site_id)) FROM d""",
)
def bundle_refusals(spark, sf):
    """Dates of three tables of which one is of another day and one of two; ids of a layer of which some come twice."""
    sites = view(spark, sf, "sites").withColumn("date", F.when(F.col("row_no") % 1009 == 1, "2026-08-15").otherwise("2026-08-14"))
    owners, layer = view(spark, sf, "owners").withColumn("date", F.lit("2026-08-14")), _layer(spark, sf)
    return R.bundle_refusals({"sites": (sites, "date"), "owners": (owners, "date"), "layer": (layer.withColumn("date", F.lit("2026-08-13")), "date")}, layer)


@query("w8_single_status", f"{with_views('sites')} SELECT project_code, count(DISTINCT stage) AS n_values, min(stage) AS stage FROM sites WHERE project_code IS NOT NULL GROUP BY 1")
def single_status(spark, sf):
    return C.single_value(view(spark, sf, "sites").filter("project_code IS NOT NULL"), ["project_code"], "stage")


@query(
    "t3_violation_examples",
    f"""{with_views("sites")} SELECT 'null_stage' AS "check", count(*) AS n, concat(min(CAST(row_no AS VARCHAR)), ',', max(CAST(row_no AS VARCHAR))) AS examples FROM sites WHERE stage IS NULL
UNION ALL SELECT 'no_place', count(*), concat(min(CAST(row_no AS VARCHAR)), ',', max(CAST(row_no AS VARCHAR))) FROM sites WHERE x IS NULL""",
)
def violation_examples(spark, sf):
    return C.violations(view(spark, sf, "sites"), {"null_stage": F.col("stage").isNull(), "no_place": F.col("x").isNull()}, F.col("row_no"))


@query(
    "u2_domain_diff",
    f"""{with_views("sites")}, a AS (SELECT DISTINCT site_id FROM sites WHERE row_no % 2 = 0 AND site_id IS NOT NULL), b AS (SELECT DISTINCT site_id FROM sites WHERE row_no % 3 = 0 AND site_id IS NOT NULL)
SELECT 'only_left' AS side, count(*) AS n, min(site_id) AS first, max(site_id) AS last FROM (SELECT * FROM a EXCEPT SELECT * FROM b) UNION ALL SELECT 'only_right', count(*), min(site_id), max(site_id) FROM (SELECT * FROM b EXCEPT SELECT * FROM a)""",
)
def domain_diff(spark, sf):
    s = view(spark, sf, "sites").filter("site_id IS NOT NULL")
    return C.domain_diff(s.filter("row_no % 2 = 0"), s.filter("row_no % 3 = 0"), ["site_id"])


@query(
    "u4_multiset_diff",
    f"""{with_views("sites")}, a AS (SELECT stage, commodity FROM sites WHERE row_no % 2 = 0), b AS (SELECT stage, commodity FROM sites WHERE row_no % 3 = 0)
SELECT 'only_left' AS side, stage, commodity, count(*) AS n FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b) GROUP BY 2, 3 UNION ALL SELECT 'only_right', stage, commodity, count(*) FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a) GROUP BY 2, 3""",
)
def multiset_diff(spark, sf):
    s = view(spark, sf, "sites").select("row_no", "stage", "commodity")
    return C.multiset_diff(s.filter("row_no % 2 = 0").drop("row_no"), s.filter("row_no % 3 = 0").drop("row_no"))
