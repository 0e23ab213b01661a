"""Yearly event and rainfall context: absence is a statement of its own, never a guess."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S
from .contracts import duplicates, together, violations  # noqa: F401
from .lineage import cut

#: Parts of names that no column may have, for context is no cause.
FORBIDDEN = ("caus", "attribut", "driver", "explan")
PAYLOAD = (
    "fire_status", "fire_record_count", "fire_coverage_status", "fire_reason", "cell", "annual_rainfall_mm", "rain_days_ge_1mm", "rainfall_anomaly_mm", "climate_status", "climate_reason",
)
#: So many annual rows of rain may be broadcast.
FEW_ANNUAL = 200_000
#: So many places, with a footprint and its counts by year, may be broadcast: some 40 MB.
FEW_PLACES = 200_000


def scaffold(pairs: DataFrame, years: tuple[int, int]) -> DataFrame:
    """Every pair in every year of the closed range, once, with the pair's other columns."""
    rest = [c for c in pairs.columns if c not in ("site_id", "footprint_id")]
    return pairs.select("site_id", "footprint_id", *rest, F.explode(F.sequence(F.lit(years[0]), F.lit(years[1]))).alias("year"))


def fire_context(pairs: DataFrame, counts: DataFrame, no_footprint: DataFrame, years: tuple[int, int], snapshot_year: int) -> DataFrame:
    """One row per site and year: no footprint, else recorded, else not recorded inside the covered years, else unknown."""
    return fire_years(with_fires(pairs, counts, no_footprint, years), years, snapshot_year)


def with_fires(pairs: DataFrame, counts: DataFrame, no_footprint: DataFrame, years: tuple[int, int]) -> DataFrame:
    """Rows that have a footprint_id with no_footprint_reason and _counts: its counts side by side, one for each year of the range, so rows and not their years meet them."""
    span = range(years[0], years[1] + 1)
    per = counts.groupBy("footprint_id").agg(*[F.sum(F.when(F.col("fire_year") == y, F.col("n"))).alias(f"_n{y}") for y in span])
    per = per.select("footprint_id", F.array(*[f"_n{y}" for y in span]).alias("_counts"))
    return pairs.join(no_footprint, "footprint_id", "left").join(per, "footprint_id", "left")


def fire_years(pairs: DataFrame, years: tuple[int, int], snapshot_year: int) -> DataFrame:
    """fire_context() of pairs with_fires()."""
    return scaffold(pairs, years).select("site_id", "footprint_id", "year", *_fire(years, snapshot_year))


def _fire(years: tuple[int, int], snapshot_year: int) -> list[Column]:
    n = F.get("_counts", F.col("year") - years[0])
    inside = S.in_coverage_window(F.col("year"), snapshot_year)
    none, some = F.col("no_footprint_reason").isNotNull(), F.coalesce(n > 0, F.lit(False))
    return [
        F.when(none, "unknown").when(some, "recorded").when(inside, "not_recorded").otherwise("unknown").alias("fire_status"),
        F.when(none, None).when(some, n).when(inside, F.lit(0)).cast("int").alias("fire_record_count"),
        F.when(none, "no_footprint").when(inside, "covered").otherwise("outside_window").alias("fire_coverage_status"),
        F.when(none, F.col("no_footprint_reason")).when(~some & ~inside, "outside_coverage_window").alias("fire_reason"),
    ]


def annual_rain(daily: DataFrame) -> DataFrame:
    """(cell, year, total_mm, rain_days, reason) of rows (cell, d, rain_mm): any missing day makes the year not computable."""
    rain = F.when(~F.isnan(F.col("rain_mm").cast("double")), F.col("rain_mm").cast("double"))
    g = daily.withColumn("r", rain).groupBy("cell", F.year("d").alias("year")).agg(F.sum("r").alias("t"), F.count_if(F.col("r") >= 1.0).alias("k"), F.count("r").alias("n"))
    missing = S.expected_days(F.col("year")) - F.col("n")
    whole = missing == 0
    return g.select("cell", "year", F.when(whole, F.col("t")).alias("total_mm"), F.when(whole, F.col("k")).alias("rain_days"), F.when(~whole, F.concat(missing.cast("string"), F.lit(" missing days"))).alias("reason"))


def baselines(annual: DataFrame, years: tuple[int, int]) -> DataFrame:
    """(cell, baseline_mm, gap): the mean over the baseline years; if any lacks a total there is none, and gap lists them."""
    first, last = years
    have = F.array_sort(F.collect_set(F.when(F.col("total_mm").isNotNull() & F.col("year").between(first, last), F.col("year"))))  # at most the baseline's years
    g = annual.groupBy("cell").agg(F.avg(F.when(F.col("year").between(first, last), F.col("total_mm"))).alias("m"), have.alias("have"))
    gap = F.array_except(F.sequence(F.lit(first), F.lit(last)), F.col("have"))
    return g.select("cell", F.when(F.size(gap) == 0, F.col("m")).alias("baseline_mm"), F.when(F.size(gap) > 0, F.concat(F.lit("baseline lacks "), F.array_join(gap, ","))).alias("gap"))


def rain_anomaly(annual: DataFrame, years: tuple[int, int]) -> DataFrame:
    """Annual rows with the total less the baseline; a baseline gap voids every year of its cell, and comes first as the reason."""
    b = baselines(annual, years)
    a = annual.join(b, "cell")
    reason = F.coalesce("gap", "reason")
    ok = reason.isNull()
    return a.select("cell", "year", F.when(ok, F.col("total_mm")).alias("total_mm"), F.when(ok, F.col("rain_days")).alias("rain_days"), F.when(ok, F.col("total_mm") - F.col("baseline_mm")).alias("anomaly_mm"), reason.alias("reason"))


def climate_context(pairs: DataFrame, cells: DataFrame, annual: DataFrame, base_years: tuple[int, int], years: tuple[int, int]) -> DataFrame:
    """One row per site and year with its footprint's cell (footprint_id, cell); a year without daily rows is not computable.

    Cells are few beside pairs, and many pairs share one: up to FEW_ANNUAL annual rows are broadcast, so no pair is shuffled by cell.
    """
    return climate_years(pairs.join(cells, "footprint_id"), annual, base_years, years)


def climate_years(pairs: DataFrame, annual: DataFrame, base_years: tuple[int, int], years: tuple[int, int]) -> DataFrame:
    """climate_context() of pairs with their cell."""
    return _with_climate(pairs, annual, base_years, years).select("site_id", "footprint_id", "year", "cell", *_climate())


def _with_climate(pairs: DataFrame, annual: DataFrame, base_years: tuple[int, int], years: tuple[int, int]) -> DataFrame:
    annual = cut(annual)
    a, gaps = rain_anomaly(annual, base_years), baselines(annual, base_years).select("cell", "gap")
    if annual.count() <= FEW_ANNUAL:
        a, gaps = F.broadcast(a), F.broadcast(gaps)
    return scaffold(pairs.join(gaps, "cell", "left"), years).join(a, ["cell", "year"], "left")


def _climate() -> list[Column]:
    reason = F.coalesce("gap", "reason", F.when(F.col("total_mm").isNull(), "no daily values"))
    return [
        F.col("total_mm").alias("annual_rainfall_mm"), F.col("rain_days").cast("int").alias("rain_days_ge_1mm"), F.col("anomaly_mm").alias("rainfall_anomaly_mm"),
        F.when(reason.isNull(), "computed").otherwise("not_computable").alias("climate_status"), reason.alias("climate_reason"),
    ]


def context_rows(pairs: DataFrame, annual: DataFrame, base_years: tuple[int, int], years: tuple[int, int], all_years: tuple[int, int], snapshot_year: int) -> DataFrame:
    """context_join() of the fire_years() and climate_years() of pairs, which have a site once: made of one row a pair, so neither a pair's years nor its fire and climate rows are shuffled."""
    first, last = min(years[0], all_years[0]), max(years[1], all_years[1])
    year = F.col("year")
    ours, wanted = year.between(*years), year.between(*all_years)
    joined = ours & F.col("cell").isNotNull()
    rows = _with_climate(pairs, annual, base_years, (first, last)).filter(joined | (~ours & wanted))
    payload = [*_fire(years, snapshot_year), F.col("cell"), *_climate()]
    names = ("fire_status", "fire_record_count", "fire_coverage_status", "fire_reason", "cell", "annual_rainfall_mm", "rain_days_ge_1mm", "rainfall_anomaly_mm", "climate_status", "climate_reason")
    reason = F.concat(F.lit("no context for "), year.cast("string"), F.lit(f": it begins in {years[0]}"))
    out = rows.select("site_id", "year", "footprint_id", *[F.when(ours, c).alias(n) for n, c in zip(names, payload, strict=True)], F.when(ours, "joined").otherwise("no_context_row").alias("context_row_status"), F.when(~ours, reason).alias("no_context_row_reason"))
    return out.withColumn("context_complete", _complete())


def _complete() -> Column:
    return F.coalesce((F.col("context_row_status") == "joined") & (F.col("fire_coverage_status") == "covered") & (F.col("climate_status") == "computed"), F.lit(False))


def on_places(sites: DataFrame, places: DataFrame) -> DataFrame:
    """Sites with the columns of their place (x, y), for those that are among ``places``, which are kept rows. Up to FEW_PLACES of these are broadcast, so sites stay where they are."""
    few = places.count() <= FEW_PLACES
    return sites.join(F.broadcast(places) if few else places, ["x", "y"]).drop("x", "y")


def context_join(fire: DataFrame, climate: DataFrame, years: tuple[int, int]) -> DataFrame:
    """One row per site and year of the range; years before the context's become rows that say so. join_checks() tells whether the inputs may be joined."""
    joined = fire.join(climate.drop("footprint_id"), ["site_id", "year"]).withColumns({"context_row_status": F.lit("joined"), "no_context_row_reason": F.lit(None).cast("string")})
    start = fire.agg(F.min("year").alias("context_start"))
    known = fire.select("year").distinct()
    wanted = fire.sparkSession.range(years[0], years[1] + 1).select(F.col("id").cast("int").alias("year")).join(known, "year", "left_anti")
    absent = fire.select("site_id", "footprint_id").distinct().crossJoin(F.broadcast(wanted.crossJoin(start)))  # the years of a range are few
    reason = F.concat(F.lit("no context for "), F.col("year").cast("string"), F.lit(": it begins in "), F.col("context_start").cast("string"))
    absent = absent.select("site_id", "footprint_id", "year", F.lit("no_context_row").alias("context_row_status"), reason.alias("no_context_row_reason"))
    out = joined.unionByName(absent, allowMissingColumns=True)
    return out.withColumn("context_complete", _complete())


def join_checks(fire: DataFrame, climate: DataFrame, years: tuple[int, int]) -> DataFrame:
    """What keeps fire and climate rows from being joined.

    Rows of both sides are shuffled once, by site and year, and counted by footprint: a key with F fire and G climate rows
    has F * G joined ones, if both are there and the key has no null, else F + G.
    """
    keys, c = ["site_id", "year"], F.col
    side = lambda df, f, g: df.select(*keys, "footprint_id", F.lit(f).alias("f"), F.lit(g).alias("g"))
    dealt = side(fire, 1, 0).unionByName(side(climate, 0, 1)).repartition(*keys)
    by = dealt.groupBy(*keys, "footprint_id").agg(F.sum("f").alias("f"), F.sum("g").alias("g"))
    none = c("footprint_id").isNull()
    per = by.groupBy(*keys).agg(
        F.sum("f").alias("f"), F.sum("g").alias("g"), F.sum(F.when(none, c("f")).otherwise(0)).alias("f0"), F.sum(F.when(none, c("g")).otherwise(0)).alias("g0"), F.sum(F.when(~none, c("f") * c("g")).otherwise(0)).alias("same")
    )
    met = (c("f") > 0) & (c("g") > 0) & c("site_id").isNotNull() & c("year").isNotNull()
    found = {
        "only_in_fire": F.when(met, c("f") * c("g0")).otherwise(c("f") + c("g0")),
        "only_in_climate": F.when(met, c("f0") * c("g")).otherwise(c("f0") + c("g")),
        "footprint_disagrees": F.when(met, (c("f") - c("f0")) * (c("g") - c("g0")) - c("same")).otherwise(0),
        "year_outside_range": F.when(F.coalesce(~c("year").between(*years), F.lit(False)), F.when(met, c("f") * c("g")).otherwise(c("f") + c("g"))).otherwise(0),
        "duplicate_fire": (c("f") > 1).cast("long"), "duplicate_climate": (c("g") > 1).cast("long"),
    }
    key = F.concat_ws("|", *[F.coalesce(c(k).cast("string"), F.lit("")) for k in keys])
    cells = []
    for k, (name, n) in enumerate(found.items()):
        shown = F.when(n > 0, key if name.startswith("duplicate") else c("site_id").cast("string"))
        cells.append(F.struct(F.lit(name).alias("check"), F.coalesce(F.sum(n), F.lit(0)).alias("n"), F.concat_ws(",", F.min(shown), F.max(shown)).alias("examples")).alias(f"c{k}"))
    return per.agg(*cells).select(F.explode(F.array(*[f"c{k}" for k in range(len(found))])).alias("c")).select("c.*")


def context_checks(c: DataFrame, sites: DataFrame, years: tuple[int, int]) -> DataFrame:
    """The joined rows' contract."""
    col, absent = F.col, F.col("context_row_status") == "no_context_row"
    payload = F.greatest(*[F.col(p).isNotNull() for p in PAYLOAD])
    rules = {
        "unknown_row_status": ~col("context_row_status").isin("joined", "no_context_row"),
        "payload_on_absent": absent & payload,
        "absent_without_reason": absent & col("no_context_row_reason").isNull(),
        "joined_with_reason": ~absent & col("no_context_row_reason").isNotNull(),
        "joined_without_status": ~absent & (col("fire_status").isNull() | col("climate_status").isNull() | col("fire_coverage_status").isNull()),
        "unknown_with_count": (col("fire_status") == "unknown") & col("fire_record_count").isNotNull(),
        "computed_without_total": (col("climate_status") == "computed") & col("annual_rainfall_mm").isNull(),
        "complete_flag": col("context_complete") != F.coalesce(~absent & (col("fire_coverage_status") == "covered") & (col("climate_status") == "computed"), F.lit(False)),
        "year_outside_range": ~col("year").between(*years),
    }
    n_years = years[1] - years[0] + 1
    # rows that come dealt by site are counted by key where they are
    hits = {name: F.coalesce(bad, F.lit(False)) for name, bad in rules.items()}
    by = c.groupBy("site_id", "year").agg(F.count("*").alias("_n"), *[F.count_if(hit).alias(f"_{name}") for name, hit in hits.items()])
    key = F.concat_ws("|", *[F.coalesce(col(k).cast("string"), F.lit("")) for k in ("site_id", "year")])
    counted = {name: (F.coalesce(F.sum(f"_{name}"), F.lit(0)), F.when(col(f"_{name}") > 0, col("site_id"))) for name in rules} | {"duplicate_key": (F.count_if(col("_n") > 1), F.when(col("_n") > 1, key))}
    cells = [F.struct(F.lit(name).alias("check"), n.alias("n"), F.concat_ws(",", F.min(shown), F.max(shown)).alias("examples")).alias(f"c{k}") for k, (name, (n, shown)) in enumerate(counted.items())]
    found = by.agg(*cells).select(F.explode(F.array(*[f"c{k}" for k in range(len(counted))])).alias("c")).select("c.*")
    short = sites.select("site_id").distinct().join(c.groupBy("site_id").agg(F.count("*").alias("n")), "site_id", "left").agg(F.lit("years_per_site").alias("check"), F.count_if(F.coalesce("n", F.lit(0)) != n_years).alias("n"), F.lit("").alias("examples"))
    named = sorted(name for name in c.columns if any(part in name.lower() for part in FORBIDDEN))
    names = c.sparkSession.createDataFrame([("forbidden_name", len(named), ",".join(named))], "check string, n long, examples string")
    return together(found, short, names)


def status_reconciliation(joined: DataFrame, sources: dict[str, DataFrame]) -> DataFrame:
    """(status, value, n_source, n_joined, agree): how often each status value stands in its source and in the joined rows."""

    def one(status: str, source: DataFrame) -> DataFrame:
        count = lambda df, name: df.groupBy(F.col(status).alias("value")).agg(F.count("*").alias(name))
        both = count(source, "n_source").join(count(joined.filter("context_row_status = 'joined'"), "n_joined"), "value", "full").na.fill(0, ["n_source", "n_joined"])
        return both.select(F.lit(status).alias("status"), "value", "n_source", "n_joined", (F.col("n_source") == F.col("n_joined")).alias("agree"))

    return together(*[one(status, source) for status, source in sources.items()])


def context_holes(trajectories: DataFrame, context: DataFrame) -> DataFrame:
    """(year, verdict): years of trajectories without context: a hole where context has begun, absent before that."""
    start = context.agg(F.min("year").alias("start"))
    years = trajectories.select("year").distinct().join(context.select("year").distinct(), "year", "left_anti")
    return years.crossJoin(F.broadcast(start)).select("year", F.when(F.col("year") >= F.col("start"), "hole").otherwise("absent").alias("verdict"))


def row_count_checks(rows: DataFrame, pairs: DataFrame, n_years: int, status: str) -> DataFrame:
    """One row: rows, pairs x years, the statuses' sum, and whether all agree."""
    total = rows.groupBy(status).agg(F.count("*").alias("n")).agg(F.sum("n").alias("by_status"))
    one = rows.agg(F.count("*").alias("rows")).crossJoin(pairs.agg((F.count("*") * n_years).alias("expected"))).crossJoin(total)
    return one.withColumn("agree", (F.col("rows") == F.col("expected")) & (F.col("rows") == F.col("by_status")))


def fire_record_checks(fires: DataFrame, vocabulary: tuple[str, ...], first: int, snapshot_year: int) -> DataFrame:
    code = S.normalise_code(F.col("fire_type"))
    return violations(fires, {"unknown_code": ~code.isin(*vocabulary), "null_year": F.col("fire_year").isNull(), "year_outside": ~F.col("fire_year").between(first, snapshot_year)}, F.col("event_id"))


def daily_grid_checks(daily: DataFrame) -> DataFrame:
    """(cell, year, n_days, missing_days) of incomplete cell-years, and years in which a cell of another year is absent (n_days 0)."""
    g = daily.groupBy("cell", F.year("d").alias("year")).agg(F.count_distinct("d").alias("n_days"))
    every = daily.select("cell").distinct().crossJoin(daily.select(F.year("d").alias("year")).distinct())  # cells of the grid by years
    full = every.join(g, ["cell", "year"], "left").select("cell", "year", F.coalesce("n_days", F.lit(0)).alias("n_days"))
    return full.withColumn("missing_days", S.expected_days(F.col("year")) - F.col("n_days")).filter("missing_days <> 0")


def cover_checks(cells: DataFrame, x: str, y: str, box: tuple[float, float, float, float], step: float) -> DataFrame:
    """(check, n, examples): sides of ``box`` (minx, miny, maxx, maxy) that a grid's outermost cells, half a step wide to either side, do not reach; all four of an empty grid."""
    half = step / 2 + 1e-6
    at = cells.agg(F.min(x).alias("x1"), F.min(y).alias("y1"), F.max(x).alias("x2"), F.max(y).alias("y2"))
    sides = {"west": ("x1", F.col("x1") - half <= box[0]), "south": ("y1", F.col("y1") - half <= box[1]), "east": ("x2", F.col("x2") + half >= box[2]), "north": ("y2", F.col("y2") + half >= box[3])}
    short = {side: ~F.coalesce(reached, F.lit(False)) for side, (_, reached) in sides.items()}
    rows = [F.struct(F.lit(f"short_{side}").alias("check"), short[side].cast("long").alias("n"), F.when(short[side], F.coalesce((F.col(c) + 0.0).cast("string"), F.lit(""))).otherwise("").alias("examples")) for side, (c, _) in sides.items()]
    return at.select(F.explode(F.array(*rows)).alias("c")).select("c.*")


def spacing_checks(axis: DataFrame, value: str, step: float) -> DataFrame:
    """One row: distinct values of a grid axis and how many gaps between neighbours differ from the step. Values are the grid's, not the table's, so one sort holds them."""
    v = axis.select(F.col(value).alias("v")).distinct()
    near = v.select((F.col("v") + step).alias("w")).join(v, F.round(F.col("w"), 6) == F.round(F.col("v"), 6), "left")
    last = v.agg(F.max("v").alias("last"), F.count("*").alias("n_values"))
    return near.crossJoin(F.broadcast(last)).agg(F.max("n_values").alias("n_values"), F.count_if(F.col("v").isNull() & (F.round(F.col("w") - step, 6) != F.round("last", 6))).alias("n_gaps"))
