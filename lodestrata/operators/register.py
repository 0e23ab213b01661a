"""The site register: owners, joins, counts and reconciliation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S
from .contracts import counts_with_total, duplicates, keep_first, together


def owners_by_project(owners: DataFrame) -> DataFrame:
    """One row per project with current owners: their list, in name order, and how many.

    Rows with an end date have ended. Of several rows of a (project, owner) pair the first in source order counts.
    """
    current = owners.filter(S.is_blank(F.col("end_date")) & ~S.is_blank(F.col("project_code")))
    one = keep_first(current, ["project_code", "owner_code"], ["row_no"])
    entry = F.struct(S.sort_name(F.col("owner_name")).alias("name"), "owner_code", S.render_owner(F.col("owner_name"), F.col("holding_pct")).alias("text"))
    return one.groupBy("project_code").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(entry)), lambda e: e["text"]), "; ").alias("owners"),
        F.count("*").alias("n_owners"),
        F.count_if(S.is_blank(F.col("owner_name"))).alias("n_unnamed"),
        F.count_if(S.format_pct(F.col("holding_pct")).isNull()).alias("n_unstated"),
    )


def owner_disclosures(owners: DataFrame) -> DataFrame:
    """How many current rows there are, how many repeat a pair, and over how many projects."""
    current = owners.filter(S.is_blank(F.col("end_date")) & ~S.is_blank(F.col("project_code")))
    pairs = current.groupBy("project_code", "owner_code").agg(F.count("*").alias("n"))
    return pairs.agg(F.sum("n").alias("current_rows"), F.count("*").alias("pairs"), F.sum(F.col("n") - 1).alias("repeated_rows"), F.count_distinct("project_code").alias("projects"))


def owner_row_composition(owners: DataFrame) -> DataFrame:
    ended = ~S.is_blank(F.col("end_date"))
    return owners.agg(F.count("*").alias("total"), F.count_if(~ended).alias("current"), F.count_if(ended).alias("ended"))


def join_owners(sites: DataFrame, by_project: DataFrame) -> DataFrame:
    """Every site; owners are null without a project code or without a current owner."""
    code = F.when(~S.is_blank(F.col("project_code")), F.col("project_code"))
    keyed = by_project.withColumnRenamed("project_code", "_project")
    return sites.join(keyed, code == F.col("_project"), "left").drop("_project")


def owner_join_disclosures(sites: DataFrame, by_project: DataFrame) -> DataFrame:
    """Counts over sites, over sites with a project code, and over projects."""
    joined = join_owners(sites, by_project)
    has = ~S.is_blank(F.col("project_code"))
    found = F.col("owners").isNotNull()
    over_sites = joined.agg(
        F.count("*").alias("sites"),
        F.count_if(~has).alias("sites_without_project"),
        F.count_if(has & found).alias("sites_with_owner"),
        F.count_if(has & ~found).alias("sites_without_owner"),
        F.count_if(F.coalesce(F.col("n_owners") > 1, F.lit(False))).alias("sites_with_several_owners"),
    )
    used = sites.filter(has).select("project_code").distinct()
    over_projects = by_project.join(used, "project_code", "left_anti").agg(F.count("*").alias("projects_without_site"))
    return over_sites.crossJoin(over_projects)  # one row each


def duplication_counts(df: DataFrame, key: str) -> DataFrame:
    """Distinct values that repeat and the rows that have them; null is no value."""
    many = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n")).filter("n > 1")
    return many.agg(F.count("*").alias("values"), F.coalesce(F.sum("n"), F.lit(0)).alias("rows"))


def status_counts(sites: DataFrame) -> DataFrame:
    return counts_with_total(sites, S.classify_stage(F.col("stage")), S.STATUSES)


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per value, null included; they add up to all rows."""
    return df.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))


def crosswalk_population(sites: DataFrame) -> DataFrame:
    """Every site with the reasons that keep it out: no id, an id that repeats (all its copies), no place."""
    known = F.col("site_id").isNotNull()
    many = sites.filter(known).groupBy("site_id").agg((F.count("*") > 1).alias("_many"))
    # rows without an id never meet in one task: they stay out of the join
    rows = sites.filter(known).join(many, "site_id").select(*sites.columns, "_many").unionByName(sites.filter(~known).withColumn("_many", F.lit(False)))
    return rows.withColumns(
        {
            "null_id": ~known,
            "duplicate_id": F.col("_many"),
            "no_place": F.col("x").isNull() | F.col("y").isNull() | F.coalesce(F.isnan("x") | F.isnan("y"), F.lit(False)),
        }
    ).drop("_many").withColumn("included", ~(F.col("null_id") | F.col("duplicate_id") | F.col("no_place")))


def included_sites(sites: DataFrame) -> DataFrame:
    """(site_id, x, y) of the rows that crosswalk_population() includes, from one grouping by id."""
    one = sites.filter(F.col("site_id").isNotNull()).groupBy("site_id").agg(F.count("*").alias("_n"), F.first("x").alias("x"), F.first("y").alias("y"))
    return one.filter("_n = 1 AND x IS NOT NULL AND y IS NOT NULL AND NOT isnan(x) AND NOT isnan(y)").drop("_n")


def population_counts(sites: DataFrame) -> DataFrame:
    p = crosswalk_population(sites)
    return p.agg(F.count("*").alias("rows"), *[F.count_if(c).alias(c) for c in ("null_id", "duplicate_id", "no_place", "included")], F.count_if(~F.col("included")).alias("excluded"))


def reconcile_codes(a: DataFrame, b: DataFrame, key: str, place: str) -> DataFrame:
    """(check, n): codes only in a; codes only in b that a missing place explains, and that nothing does."""
    only_a = a.select(key).distinct().join(b.select(key).distinct(), key, "left_anti").agg(F.lit("only_in_a").alias("check"), F.count("*").alias("n"))
    rest = b.join(a.select(key).distinct(), key, "left_anti").groupBy(key).agg(F.max(F.col(place).isNotNull()).alias("placed"))
    explained = rest.agg(F.lit("only_in_b_no_place").alias("check"), F.count_if(~F.col("placed")).alias("n"))
    return only_a.unionByName(explained).unionByName(rest.agg(F.lit("only_in_b_unexplained").alias("check"), F.count_if("placed").alias("n")))


def register_reconciliation(sites: DataFrame, source_rows: DataFrame) -> DataFrame:
    """One verdict row: source rows, register rows and the categories' total must agree."""
    total = status_counts(sites).agg(F.sum(F.when(F.col("name") != "total", F.col("n"))).alias("categories"))
    one = source_rows.agg(F.count("*").alias("source_rows")).crossJoin(sites.agg(F.count("*").alias("register_rows"))).crossJoin(total)
    return one.withColumn("reconciled", (F.col("source_rows") == F.col("register_rows")) & (F.col("register_rows") == F.col("categories")))


def code_bundle_checks(sites: DataFrame, owners: DataFrame) -> DataFrame:
    """(check, n): counts over the sites and owners tables as they come."""
    ids = sites.filter(F.col("site_id").isNotNull())
    repeated = ids.groupBy("site_id").count().filter("count > 1").agg(F.lit("duplicated_site_ids").alias("check"), F.count("*").alias("n"))
    codes = sites.filter(~S.is_blank(F.col("project_code"))).select("project_code").distinct()
    orphans = owners.select("project_code").distinct().join(codes, "project_code", "left_anti").agg(F.lit("owner_codes_without_site").alias("check"), F.count("*").alias("n"))
    unowned = codes.join(owners.select("project_code").distinct(), "project_code", "left_anti").agg(F.lit("site_codes_without_owner").alias("check"), F.count("*").alias("n"))
    extra = {
        "sites": F.lit(True), "null_site_id": F.col("site_id").isNull(), "null_stage": F.col("stage").isNull(), "blank_project": S.is_blank(F.col("project_code")), "no_place": F.col("x").isNull() | F.col("y").isNull(),
        "unmapped_stage": F.col("stage").isNotNull() & ~F.col("stage").isin(*S.STAGES),
    }
    counted = sites.agg(*[F.count_if(c).alias(k) for k, c in extra.items()])
    flat = counted.select(F.explode(F.array(*[F.struct(F.lit(k).alias("check"), F.col(k).alias("n")) for k in extra])).alias("c")).select("c.*")
    return flat.unionByName(repeated).unionByName(orphans).unionByName(unowned)


def bundle_totals(sites: DataFrame, owners: DataFrame, layer: DataFrame) -> DataFrame:
    """(total, n): what is told of a bundle and not refused, of its sites, owners and the layer (site_id) that comes beside them."""
    repeated = sites.filter(F.col("site_id").isNotNull()).groupBy("site_id").count().filter("count > 1")
    current = S.is_blank(F.col("end_date"))
    known = ~S.is_blank(F.col("project_code"))
    absent = sites.select("site_id").dropna().distinct().join(layer.select("site_id").dropna().distinct(), "site_id", "left_anti")
    frames = [
        repeated.agg(F.coalesce(F.sum("count"), F.lit(0)).alias("rows_of_duplicated_ids")),
        sites.agg(F.count_distinct(F.when(known, F.col("project_code"))).alias("projects")),
        owners.agg(F.count_distinct(F.when(known & current, F.col("project_code"))).alias("projects_with_current_owner"), F.count_if(current).alias("owner_rows_current"), F.count_if(~current).alias("owner_rows_ended")),
        absent.agg(F.count("*").alias("sites_absent_from_layer")),
        layer.agg(F.count("*").alias("layer_rows")),
    ]
    return together(*[f.select(F.explode(F.array(*[F.struct(F.lit(c).alias("total"), F.col(c).cast("long").alias("n")) for c in f.columns])).alias("x")).select("x.*") for f in frames])


def bundle_refusals(tables: dict[str, tuple[DataFrame, str]], layer: DataFrame) -> DataFrame:
    """(check, n, examples): extract dates beyond the one that all tables (name -> frame, its date column) must share, and repeated ids of the layer."""
    dates = together(*[df.select(F.col(c).cast("string").alias("date")).dropna().distinct().withColumn("name", F.lit(name)) for name, (df, c) in tables.items()])
    shown = F.concat_ws("=", "name", "date")
    one = dates.agg(F.lit("extract_dates").alias("check"), F.abs(F.count_distinct("date") - 1).alias("n"), F.concat_ws(",", F.min(shown), F.max(shown)).alias("examples"))
    return one.unionByName(duplicates(layer.filter(F.col("site_id").isNotNull()), ["site_id"], "duplicate_layer_id"))
