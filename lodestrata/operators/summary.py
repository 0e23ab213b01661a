"""One row per site: coverage, latest metrics, event and rainfall summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .contracts import keep_first, violations


def coverage_summary(t: DataFrame, context: DataFrame) -> DataFrame:
    a = t.groupBy("site_id").agg(
        F.min("year").alias("year_min"), F.max("year").alias("year_max"), F.count_distinct("year").alias("years_observed"), F.count_distinct(F.when(F.col("computable"), F.col("year"))).alias("years_computable")
    )
    c = context.groupBy("site_id").agg(F.count_distinct(F.when(F.col("context_complete"), F.col("year"))).alias("c"))
    return a.join(c, "site_id", "left").select("site_id", "year_min", "year_max", "years_observed", "years_computable", (F.col("years_observed") - F.col("years_computable")).alias("years_not_computable"), F.coalesce("c", F.lit(0)).alias("context_complete_years"))


def latest_per_metric(t: DataFrame) -> DataFrame:
    """(site_id, metric, latest_year, n_collections, value) at the latest computable year; several collections there leave no value."""
    ok = t.filter("computable")
    g = ok.groupBy("site_id", "metric", "year").agg(F.count_distinct("collection_id").alias("n"), F.min("value").alias("v"))
    top = g.groupBy("site_id", "metric").agg(F.max_by(F.struct("year", "n", "v"), "year").alias("x"))
    return top.select("site_id", "metric", F.col("x.year").alias("latest_year"), F.col("x.n").alias("n_collections"), F.when(F.col("x.n") == 1, F.col("x.v")).alias("value"))


def latest_wide(t: DataFrame, metrics: tuple[str, ...]) -> DataFrame:
    """latest_per_metric with three columns a metric."""
    cells = {"latest": "value", "latest_year": "latest_year", "latest_collections": "n_collections"}
    return latest_per_metric(t).groupBy("site_id").agg(*[F.max(F.when(F.col("metric") == m, F.col(c))).alias(f"{m}_{n}") for m in metrics for n, c in cells.items()])


def fire_summary(context: DataFrame) -> DataFrame:
    joined = context.filter("context_row_status = 'joined'")
    recorded = F.when(F.col("fire_status") == "recorded", F.col("year"))
    return joined.groupBy("site_id").agg(F.max_by("fire_status", "year").alias("fire_status_latest"), F.count_distinct(recorded).alias("fire_years_recorded"), F.max(recorded).alias("last_recorded_fire_year"))


def climate_summary(context: DataFrame) -> DataFrame:
    ok = context.filter("context_row_status = 'joined' AND climate_status = 'computed'")
    return ok.groupBy("site_id").agg(F.avg("annual_rainfall_mm").alias("rainfall_annual_mean"), F.max_by("annual_rainfall_mm", "year").alias("rainfall_latest"), F.max("year").alias("rainfall_latest_year"))


def site_summary(t: DataFrame, context: DataFrame, metrics: tuple[str, ...]) -> DataFrame:
    """One row per site of the trajectories. All four parts are aggregates by site, so their joins reuse one partitioning."""
    out = coverage_summary(t, context).join(latest_wide(t, metrics), "site_id", "left").join(fire_summary(context), "site_id", "left").join(climate_summary(context), "site_id", "left")
    return out.withColumn("fire_years_recorded", F.coalesce("fire_years_recorded", F.lit(0)))


def summary_checks(s: DataFrame, metrics: tuple[str, ...]) -> DataFrame:
    c = F.col
    rules = {
        "null_required": c("site_id").isNull() | c("year_min").isNull() | c("years_observed").isNull() | c("fire_years_recorded").isNull(),
        "years_disagree": c("years_computable") + c("years_not_computable") != c("years_observed"),
        "fire_vocabulary": c("fire_status_latest").isNotNull() & ~c("fire_status_latest").isin("recorded", "not_recorded", "unknown"),
        "last_fire_year": (c("fire_years_recorded") == 0) != c("last_recorded_fire_year").isNull(),
    }
    for m in metrics:
        rules[f"{m}_overlap_resolved"] = (c(f"{m}_latest_collections") > 1) & c(f"{m}_latest").isNotNull()
    return violations(s, rules, c("site_id"))


def located_layers(summary: DataFrame, register: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """All located sites; one located row per summary site; and the count of summary sites without a place, which refuses the layers."""
    place = F.col("x").isNotNull() & F.col("y").isNotNull()
    sites = register.filter(place)
    one = keep_first(sites.filter(F.col("site_id").isNotNull()), ["site_id"], ["row_no"]).select("site_id", "x", "y")
    layer = summary.join(one, "site_id", "left")
    return sites, layer.filter(place), layer.agg(F.count_if(~place).alias("unlocated"))
