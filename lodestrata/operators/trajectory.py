"""Site-year metric rows: sensor transitions, fan-out to sites, comparison, contracts and acceptance."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .contracts import duplicates, together, violations

REASONS = ("zero_member_pixels", "zero_valid_pixels", "insufficient_valid_fraction", "read_failed", "item_missing")
METRICS = ("bare", "pv", "npv", "nbr", "ndmi")
KEY = ["site_id", "year", "metric", "collection_id"]


def transition_years(covered: DataFrame) -> DataFrame:
    """(key, year, adjacent) of rows (key, source_id, year): more than one source, or a neighbouring year with other sources.

    A year without any source is no change. Years, not rows, are neighbours, so gaps count.
    """
    sets = covered.groupBy("key", "year").agg(F.array_sort(F.collect_set("source_id")).alias("s"))  # as many as there are sources
    beside = sets.select("key", F.explode(F.array(F.col("year") - 1, F.col("year") + 1)).alias("year"), F.col("s").alias("t"))
    changed = sets.join(beside, ["key", "year"], "left").groupBy("key", "year").agg(F.bool_or(F.coalesce(F.col("s") != F.col("t"), F.lit(False))).alias("changed"), F.max(F.size("s")).alias("n"))
    return changed.select("key", "year", (F.col("changed") | (F.col("n") > 1)).alias("adjacent"))


def join_many_to_one(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    return left.join(right, key)


def many_to_one_checks(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    missing = left.select(key).distinct().join(right, key, "left_anti")
    return missing.agg(F.lit("missing_key").alias("check"), F.count("*").alias("n"), F.concat_ws(",", F.min(key), F.max(key)).alias("examples")).unionByName(duplicates(right, [key]))


def fan_out(rows: DataFrame, links: DataFrame) -> DataFrame:
    """Rows computed once per footprint, for every site that shares it, with how many do. Sites are counted before the join."""
    sites = links.select("site_id", "footprint_id").distinct()
    shared = sites.groupBy("footprint_id").agg(F.count("*").alias("shared_sites"))
    return rows.join(shared, "footprint_id").join(sites, "footprint_id")


def compare_series(extracted: DataFrame, reference: DataFrame, tolerance: dict[str, float], default: float) -> DataFrame:
    """Failures (site_id, year, metric, reason) of rows (site_id, year, metric, value, computable, n_pixels) on either side.

    Values that neither side has agree. The full outer join is by key, so nothing is compared twice.
    """
    limit = F.coalesce(F.try_element_at(F.create_map(*[F.lit(v) for pair in tolerance.items() for v in pair]), F.col("metric")), F.lit(default))
    a, b = extracted.alias("a"), reference.alias("b")
    j = a.join(b, ["site_id", "year", "metric"], "full")
    av, bv = F.col("a.value"), F.col("b.value")
    reason = (
        F.when(F.col("a.computable").isNull(), "missing_in_extracted")
        .when(F.col("b.computable").isNull(), "missing_in_reference")
        .when(F.col("a.computable") != F.col("b.computable"), "computability_differs")
        .when(~F.col("a.computable"), F.lit(None).cast("string"))
        .when(F.col("a.n_pixels") != F.col("b.n_pixels"), "pixel_count_differs")
        .when(F.abs(av - bv) > limit, "out_of_tolerance")
    )
    return j.select("site_id", "year", "metric", reason.alias("reason"), F.round(F.abs(av - bv), 6).alias("difference")).filter(F.col("reason").isNotNull())


def trajectory_checks(t: DataFrame) -> DataFrame:
    """The row contract as (check, n, examples)."""
    c = F.col
    rules = {
        "null_in_required": c("site_id").isNull() | c("footprint_id").isNull() | c("year").isNull() | c("metric").isNull() | c("collection_id").isNull() | c("computable").isNull(),
        "unknown_metric": ~c("metric").isin(*METRICS),
        "unknown_reason": c("reason").isNotNull() & ~c("reason").isin(*REASONS),
        "computable_without_value": c("computable") & c("value").isNull(),
        "value_without_computable": ~c("computable") & c("value").isNotNull(),
        "reason_with_computable": c("computable") & c("reason").isNotNull(),
        "no_reason": ~c("computable") & c("reason").isNull(),
        "share_below_one": c("shared_sites") < 1,
    }
    return violations(t, rules, c("site_id")).unionByName(duplicates(t, KEY))


def reason_counts(t: DataFrame) -> DataFrame:
    return t.filter(~F.col("computable")).groupBy("reason").agg(F.count("*").alias("n"))


def acceptance(t: DataFrame, sites: DataFrame, expected: DataFrame) -> DataFrame:
    """(check, n): how many things each named check finds wrong; a report, never an error.

    sites: (site_id, footprint_id, forced); expected: (collection_id, year, kind_metrics) of all partitions that must be there.
    """
    per = t.groupBy("collection_id", "year").agg(F.count("*").alias("rows"), F.count_distinct("site_id").alias("n_sites"), F.count_distinct("metric").alias("n_metrics"))
    parts = per.join(expected, ["collection_id", "year"], "full")
    total = sites.agg(F.count_distinct("site_id").alias("total"))
    inventory = parts.crossJoin(F.broadcast(total)).agg(
        F.count_if(F.col("rows").isNull()).alias("missing_partition"),
        F.count_if(F.col("kind_metrics").isNull()).alias("stray_partition"),
        F.count_if(F.col("rows") != F.col("n_sites") * F.col("n_metrics")).alias("rows_per_partition"),
        F.count_if(F.col("n_metrics") != F.col("kind_metrics")).alias("metric_set"),
        F.count_if(F.col("n_sites") != F.col("total")).alias("site_set"),
    )
    linked = t.join(sites.select("site_id", F.col("footprint_id").alias("_f"), F.col("forced").alias("_forced")), "site_id", "left").agg(
        F.count_if(F.col("_f").isNull()).alias("unknown_site"),
        F.count_if(F.col("footprint_id") != F.col("_f")).alias("footprint"),
        F.count_if(~F.col("forced").eqNullSafe(F.col("_forced"))).alias("forced_flag"),
    )
    same = t.groupBy("footprint_id", "year", "metric", "collection_id").agg(
        F.count_distinct(F.coalesce(F.col("value").cast("string"), F.lit("-"))).alias("values"), F.count_distinct(F.coalesce("reason", F.lit("-"))).alias("reasons"), F.count_distinct("site_id").alias("n"), F.min("shared_sites").alias("lo"), F.max("shared_sites").alias("hi")
    )
    identity = same.agg(F.count_if(F.col("values") > 1).alias("shared_value"), F.count_if(F.col("reasons") > 1).alias("shared_reason"), F.count_if((F.col("lo") != F.col("n")) | (F.col("hi") != F.col("n"))).alias("shared_count"))

    def flat(one: DataFrame) -> DataFrame:
        return one.select(F.explode(F.array(*[F.struct(F.lit(c).alias("check"), F.col(c).alias("n")) for c in one.columns])).alias("x")).select("x.*")

    return together(flat(inventory), flat(linked), flat(identity), trajectory_checks(t).select("check", "n"))


def claimed_totals(t: DataFrame, claims: DataFrame, sites: DataFrame) -> DataFrame:
    """(check, n, claimed, found): rows against what the run that wrote them claims.

    claims: (collection_id, year, rows, not_computable) by partition; sites: (site_id). n is the number of partitions, totals or sites that differ.
    """
    per = t.groupBy("collection_id", "year").agg(F.count("*").alias("f_rows"), F.count_if(~F.col("computable")).alias("f_not"))
    both = per.join(claims, ["collection_id", "year"], "full").na.fill(0, ["rows", "not_computable", "f_rows", "f_not"])  # a row for each partition
    names = t.select("site_id").distinct().withColumn("_t", F.lit(True)).join(sites.select("site_id").distinct().withColumn("_s", F.lit(True)), "site_id", "full")
    total = lambda a, b: F.struct((F.sum(a) != F.sum(b)).cast("long").alias("n"), F.sum(a).alias("claimed"), F.sum(b).alias("found"))
    differ = lambda a, b: F.struct(F.count_if(F.col(a) != F.col(b)).alias("n"), F.lit(None).cast("long").alias("claimed"), F.lit(None).cast("long").alias("found"))
    parts = both.agg(differ("rows", "f_rows").alias("partition_rows"), differ("not_computable", "f_not").alias("partition_not_computable"), total("rows", "f_rows").alias("total_rows"), total("not_computable", "f_not").alias("total_not_computable"))
    seen = names.agg(F.struct(F.count_if(F.col("_t").isNull() | F.col("_s").isNull()).alias("n"), F.count("_s").alias("claimed"), F.count("_t").alias("found")).alias("sites"))

    def flat(one: DataFrame) -> DataFrame:
        return one.select(F.explode(F.array(*[F.struct(F.lit(c).alias("check"), F.col(c)["n"].alias("n"), F.col(c)["claimed"].alias("claimed"), F.col(c)["found"].alias("found")) for c in one.columns])).alias("x")).select("x.*")

    return together(flat(parts), flat(seen))


def path_checks(rows: DataFrame, keys: tuple[str, ...], path: str) -> DataFrame:
    """Key columns of rows against the key=value folders of the files that hold them."""
    said = [F.regexp_extract(F.col(path), f"(?:^|/){k}=([^/]*)/", 1) for k in keys]
    lacks, differs = (reduce(Column.__or__, x) for x in ([v == "" for v in said], [(v != "") & (v != F.col(k).cast("string")) for k, v in zip(keys, said, strict=True)]))
    return violations(rows, {"key_against_path": differs, "no_key_in_path": lacks}, F.concat_ws("/", *[F.col(k).cast("string") for k in keys]))


def digest_bracket(before: DataFrame, after: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, verdict): partitions whose digest is not the same after as before a run: changed, vanished or new."""
    both = before.withColumnRenamed("digest", "_a").join(after.withColumnRenamed("digest", "_b"), keys, "full")
    verdict = F.when(F.col("_b").isNull(), "vanished").when(F.col("_a").isNull(), "new").when(F.col("_a") != F.col("_b"), "changed")
    return both.select(*keys, verdict.alias("verdict")).filter(F.col("verdict").isNotNull())
