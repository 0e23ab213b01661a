"""Pixel tables: membership, values, site-year metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geometry as G
from ..functions import scalars as S
from .contracts import enforce, violations
from .quantiles import exact_quantiles
from .spatial import shaped, shapes

PIXEL, TILE = 30.0, 96000.0
MIN_VALID = 0.95


def pixel_centre(tile: Column, row: Column, col: Column) -> dict[str, Column]:
    """Centre of a pixel of tile xAyB, whose lower left corner is (A, B) tile widths; null, a violation, for other names."""
    at = lambda k: F.regexp_extract(tile, r"^x(-?\d+)y(-?\d+)$", k)
    a, b = (F.when(at(k) != "", at(k).cast("int")) for k in (1, 2))
    return {"x": a * TILE + (col + 0.5) * PIXEL, "y": (b + 1) * TILE - (row + 0.5) * PIXEL}


def grid_spans(polygons: DataFrame, id_col: str, x0: float, y0: float, dx: float, dy: float, nx: int, ny: int, strict: bool = True) -> DataFrame:
    """(id, iy, y, first, last): runs of grid columns inside each polygon, row by row, by filling between a row's crossings.

    A polygon's grid rows are listed with the few edges that reach their height, and dealt out, so a large polygon is spread
    over tasks; the whole grid is never listed. Of a row the crossings are sorted and every second gap is filled. Columns
    within a millionth of a step of a crossing, a corner or a level edge are judged by the exact predicate instead, one
    by one; there are a few at most for each of those.
    """
    b = G.bounds(F.col("rings"))
    lo = lambda v, o, d: F.greatest(F.ceil((v - o) / d), F.lit(0).cast("long"))
    hi = lambda v, o, d, n: F.least(F.floor((v - o) / d), F.lit(n - 1).cast("long"))
    p = polygons.select(id_col, G.edges(F.col("rings")).alias("_e"), lo(b["minx"], x0, dx).alias("x1"), hi(b["maxx"], x0, dx, nx).alias("x2"), lo(b["miny"], y0, dy).alias("y1"), hi(b["maxy"], y0, dy, ny).alias("y2"))
    p = p.filter("x1 <= x2 and y1 <= y2").withColumn("iy", F.explode(F.sequence("y1", "y2"))).withColumn("y", y0 + F.col("iy") * dy)
    at = F.col("y")
    p = p.withColumn("_e", F.filter("_e", lambda e: at.between(F.least(e["y1"], e["y2"]), F.greatest(e["y1"], e["y2"])))).repartition(id_col, "iy")
    near = 1e-6
    column = lambda x: (x - x0) / dx
    crossed = F.filter("_e", lambda e: (e["y1"] > at) != (e["y2"] > at))
    crossings = F.array_sort(F.transform(crossed, lambda e: column(e["x1"] + (at - e["y1"]) * (e["x2"] - e["x1"]) / (e["y2"] - e["y1"]))))
    # where the fill is not to be trusted: at crossings, at corners on the row and along level edges
    level = F.filter("_e", lambda e: (e["y1"] == at) | (e["y2"] == at))
    one = lambda low, high: F.struct(F.ceil(low - near).alias("a"), F.floor(high + near).alias("b"))

    def touched(e: Column) -> Column:
        flat, corner = e["y1"] == e["y2"], F.when(e["y1"] == at, e["x1"]).otherwise(e["x2"])
        return F.when(flat, one(column(F.least(e["x1"], e["x2"])), column(F.greatest(e["x1"], e["x2"])))).otherwise(one(column(corner), column(corner)))

    p = p.withColumns({"_c": crossings, "_doubt": F.transform(level, touched)})
    doubted = F.filter(F.concat("_doubt", F.transform("_c", lambda c: one(c, c))), lambda d: d["a"] <= d["b"])
    columns = F.array_sort(F.array_distinct(F.flatten(F.transform(doubted, lambda d: F.sequence(d["a"], d["b"])))))
    p = p.withColumn("_doubt", F.filter(columns, lambda c: c.between(F.col("x1"), F.col("x2"))))
    pairs = F.filter(F.sequence(F.lit(0), F.floor(F.size("_c") / 2).cast("int")), lambda k: 2 * k + 1 < F.size("_c"))
    fill = F.transform(pairs, lambda k: F.struct(F.greatest(F.ceil(F.get("_c", 2 * k)), F.col("x1")).alias("first"), F.least(F.floor(F.get("_c", 2 * k + 1)), F.col("x2")).alias("last")))
    p = p.withColumn("_fill", F.filter(fill, lambda r: r["first"] <= r["last"]))

    def apart(r: Column) -> Column:
        """What a run leaves when the doubted columns are cut out of it."""
        cuts = F.filter("_doubt", lambda c: c.between(r["first"], r["last"]))
        starts, ends = F.concat(F.array(r["first"]), F.transform(cuts, lambda c: c + 1)), F.concat(F.transform(cuts, lambda c: c - 1), F.array(r["last"]))
        return F.filter(F.zip_with(starts, ends, lambda s, e: F.struct(s.alias("first"), e.alias("last"))), lambda x: x["first"] <= x["last"])

    test = G.contains if strict else G.covers
    judged = F.filter("_doubt", lambda c: test(F.col("_e"), x0 + c * dx, at))
    runs = F.concat(F.flatten(F.transform("_fill", apart)), F.transform(judged, lambda c: F.struct(c.alias("first"), c.alias("last"))))
    return p.select(id_col, "iy", "y", F.explode(runs).alias("r")).select(id_col, "iy", "y", "r.first", "r.last")


def build_assignment(polygons: DataFrame, id_col: str, x0: float, y0: float, dx: float, dy: float, nx: int, ny: int, strict: bool = True) -> DataFrame:
    """(id, ix, iy, x, y): grid points of a rectilinear grid inside each polygon, from runs of columns that are listed only here."""
    spans = grid_spans(polygons, id_col, x0, y0, dx, dy, nx, ny, strict)
    return spans.withColumn("ix", F.explode(F.sequence("first", "last"))).select(id_col, "ix", "iy", (x0 + F.col("ix") * dx).alias("x"), "y")


#: The grid of pixels has no end of its own: it is counted from here on.
_BIG = 10**7


def pixel_members(polygons: DataFrame, id_col: str, x0: float, y0: float, step: float, per_tile: int) -> DataFrame:
    """(id, tile_x, tile_y, prow, pcol): pixels whose centre a polygon covers, on every tile of per_tile x per_tile pixels that it touches."""
    m = build_assignment(polygons, id_col, x0 + step / 2 - _BIG * step, y0 + step / 2 - _BIG * step, step, step, 2 * _BIG, 2 * _BIG, strict=False)
    gx, gy = F.col("ix") - _BIG, F.col("iy") - _BIG
    tile = lambda g: F.floor(g / per_tile)
    return m.select(id_col, tile(gx).alias("tile_x"), tile(gy).alias("tile_y"), (per_tile - 1 - F.pmod(gy, F.lit(per_tile))).alias("prow"), F.pmod(gx, F.lit(per_tile)).alias("pcol"))


def member_digests(members: DataFrame, id_col: str) -> DataFrame:
    """Support and a digest of the sorted members of each polygon; a polygon's members are bounded by its area."""
    name = F.concat_ws(",", *[F.col(c).cast("string") for c in ("tile_x", "tile_y", "prow", "pcol")])
    return members.groupBy(id_col).agg(F.count("*").alias("support_px"), F.sha2(F.array_join(F.sort_array(F.collect_list(name)), ";"), 256).alias("members_sha256"))


def pixel_digests(polygons: DataFrame, id_col: str, x0: float, y0: float, step: float, per_tile: int) -> DataFrame:
    """member_digests() of pixel_members(), from runs of columns, which are listed only in the row that is digested; polygons of one shape share a digest."""
    marked = shaped(polygons, [id_col])
    spans = grid_spans(shapes(marked), "_shape", x0 + step / 2 - _BIG * step, y0 + step / 2 - _BIG * step, step, step, 2 * _BIG, 2 * _BIG, strict=False)
    text = lambda v: v.cast("string")
    gy, gx = F.col("iy") - _BIG, lambda ix: ix - _BIG
    row = F.concat(F.lit(","), text(F.floor(gy / per_tile)), F.lit(","), text(per_tile - 1 - F.pmod(gy, F.lit(per_tile))), F.lit(","))
    runs = spans.select("_shape", F.struct(row.alias("row"), "first", "last").alias("_r")).groupBy("_shape").agg(F.collect_list("_r").alias("_runs"))  # bounded by the shape's height
    name = lambda r: lambda ix: F.concat(text(F.floor(gx(ix) / per_tile)), r["row"], text(F.pmod(gx(ix), F.lit(per_tile))))
    names = runs.select("_shape", F.flatten(F.transform("_runs", lambda r: F.transform(F.sequence(r["first"], r["last"]), name(r)))).alias("_names"))
    digests = names.select("_shape", F.size("_names").cast("long").alias("support_px"), F.sha2(F.array_join(F.sort_array("_names"), ";"), 256).alias("members_sha256"))
    return marked.select(id_col, "_shape").join(digests, "_shape").drop("_shape")


def member_checks(members: DataFrame, tiles: DataFrame) -> DataFrame:
    """(check, n, examples): members (tile, prow, pcol) of a tile that is not among ``tiles`` (tile, height, width), and members beyond its bounds."""
    known = members.join(tiles.select("tile", "height", "width").distinct(), "tile", "left")
    beyond = (F.col("prow") < 0) | (F.col("pcol") < 0) | (F.col("prow") >= F.col("height")) | (F.col("pcol") >= F.col("width"))
    shown = F.concat_ws(",", *[F.col(c).cast("string") for c in ("tile", "prow", "pcol")])
    return violations(known, {"missing_tile": F.col("height").isNull(), "out_of_bounds": beyond}, shown)


def read_member_values(pixels: DataFrame, members: DataFrame, keys: list[str], tiles: DataFrame | None = None) -> DataFrame:
    """Pixel rows of exactly the members; members without a row keep null bands.

    With ``tiles`` (tile, height, width) members of missing tiles and members out of bounds are refused.
    """
    if tiles is not None:
        enforce(member_checks(members, tiles))
    return members.join(pixels, keys, "left")


def zonal_stats(values: DataFrame, id_col: str, value: str) -> DataFrame:
    """mean, sum, min, max and count of the valid values of each region; regions without any are absent."""
    v = F.col(value).cast("double")
    ok = values.filter(v.isNotNull() & ~F.isnan(v))
    return ok.groupBy(id_col).agg(F.avg(v).alias("mean"), F.sum(v).alias("sum"), F.min(v).alias("min"), F.max(v).alias("max"), F.count("*").alias("n"))


def reason(member: Column, valid: Column) -> Column:
    """Why a site-year can't be computed; null if it can. 95 % of the members, rounded up, must be valid."""
    needed = F.ceil(F.round(member * MIN_VALID, 9))
    return F.when(member == 0, "zero_member_pixels").when(valid == 0, "zero_valid_pixels").when(valid < needed, "insufficient_valid_fraction")


def _long(df: DataFrame, keys: list[str], metrics: list[str], extra: list[str]) -> DataFrame:
    """One row per metric; the value is null wherever the reason is not."""
    cells = F.array(*[F.struct(F.lit(m).alias("metric"), F.when(F.col("reason").isNull(), F.col(m)).alias("value"), *[F.col(f"{m}_{e}" if f"{m}_{e}" in df.columns else e).alias(e) for e in extra]) for m in metrics])
    return df.select(*keys, "n_member", "n_valid", "reason", F.explode(cells).alias("c")).select(*keys, "c.*", "n_member", "n_valid", F.col("reason").isNull().alias("computable"), "reason")


def index_site_years(values: DataFrame, keys: list[str]) -> DataFrame:
    """nbr and ndmi of rows (keys, nir, swir1, swir2) as decoded values: means over valid members."""
    v = values.withColumn("ok", S.valid_index_pixel(F.col("nir"), F.col("swir1"), F.col("swir2")))
    mean = lambda a, b: F.avg(F.when(F.col("ok"), S.norm_diff(F.col(a), F.col(b))))
    g = v.groupBy(*keys).agg(F.count("*").alias("n_member"), F.count_if("ok").alias("n_valid"), mean("nir", "swir2").alias("nbr"), mean("nir", "swir1").alias("ndmi"))
    return _long(g.withColumn("reason", reason(F.col("n_member"), F.col("n_valid"))), keys, ["nbr", "ndmi"], [])


def share_site_years(values: DataFrame, keys: list[str], bands: tuple[str, ...]) -> DataFrame:
    """Means of share bands over valid members, with how many values lie beyond 100."""
    v = values.withColumn("ok", S.finite(*[F.col(b) for b in bands]))
    aggs = [F.avg(F.when(F.col("ok"), F.col(b))).alias(b) for b in bands] + [F.count_if(F.col("ok") & S.out_of_range(F.col(b))).alias(f"{b}_beyond") for b in bands]
    g = v.groupBy(*keys).agg(F.count("*").alias("n_member"), F.count_if("ok").alias("n_valid"), *aggs)
    return _long(g.withColumn("reason", reason(F.col("n_member"), F.col("n_valid"))), keys, list(bands), ["beyond"])


def full_support_years(metrics: DataFrame, id_col: str) -> DataFrame:
    """Years in which the share product and any index product can be computed, per id, of rows (id, year, kind, computable)."""
    per = metrics.groupBy(id_col, "year").agg(F.bool_or((F.col("kind") == "share") & F.col("computable")).alias("share"), F.bool_or((F.col("kind") == "index") & F.col("computable")).alias("index"))
    return per.groupBy(id_col).agg(F.count_if(F.col("share") & F.col("index")).alias("n_full_support_years"), F.count("*").alias("n_years"))


def invalid_contiguity(members: DataFrame, keys: list[str]) -> DataFrame:
    """How densely invalid pixels fill their box, how much of the members' box that is, and whether it touches its edge; rows (keys, prow, pcol, ok)."""
    bad = lambda f, c: f(F.when(~F.col("ok"), F.col(c)))
    g = members.groupBy(*keys).agg(
        F.count("*").alias("n"), F.count_if(~F.col("ok")).alias("bad"), F.min("prow").alias("r1"), F.max("prow").alias("r2"), F.min("pcol").alias("c1"), F.max("pcol").alias("c2"),
        bad(F.min, "prow").alias("b1"), bad(F.max, "prow").alias("b2"), bad(F.min, "pcol").alias("d1"), bad(F.max, "pcol").alias("d2"),
    ).filter("bad > 0")
    box, whole = F.expr("(b2 - b1 + 1) * (d2 - d1 + 1)"), F.expr("(r2 - r1 + 1) * (c2 - c1 + 1)")
    return g.select(*keys, "n", "bad", (F.col("bad") / box).alias("density"), (box / whole).alias("span"), F.expr("b1 = r1 OR b2 = r2 OR d1 = c1 OR d2 = c2").alias("touches_edge"))


def window_sample(pixels: DataFrame, points: DataFrame, k: int, value: str) -> DataFrame:
    """Mean of the k x k pixels around each point (key, tile, prow, pcol), nulls left out, cut off at the tile's edge. Points of one pixel share its window."""
    half, at = k // 2, ["tile", "prow", "pcol"]
    offsets = F.sequence(F.lit(-half), F.lit(half))
    around = points.select(*at).distinct().withColumn("dr", F.explode(offsets)).withColumn("dc", F.explode(offsets))
    around = around.withColumns({"_row": F.col("prow") + F.col("dr"), "_col": F.col("pcol") + F.col("dc")})
    hit = around.join(pixels.select("tile", F.col("prow").alias("_row"), F.col("pcol").alias("_col"), F.col(value).alias("_v")), ["tile", "_row", "_col"])
    found = hit.groupBy(*at).agg(F.count("*").alias("n_member"), F.count("_v").alias("n_valid"), F.avg("_v").alias("value"))
    return points.select("key", *at).join(found, at, "left").select("key", F.coalesce("n_member", F.lit(0)).alias("n_member"), F.coalesce("n_valid", F.lit(0)).alias("n_valid"), "value")


def invalid_breakdown(values: DataFrame, keys: list[str], bands: tuple[str, ...]) -> DataFrame:
    """Members, invalid members and their share, nulls by band, and zero denominators of each group."""
    v = values.withColumn("ok", S.valid_index_pixel(*[F.col(b) for b in bands]))
    zero = [F.count_if(F.coalesce(F.col(bands[0]) + F.col(b) == 0, F.lit(False))).alias(f"zero_{b}") for b in bands[1:]]
    return v.groupBy(*keys).agg(F.count("*").alias("n_member"), F.count_if(~F.col("ok")).alias("n_invalid"), (F.count_if(~F.col("ok")) / F.count("*")).alias("invalid_share"), *[F.count_if(F.col(b).isNull()).alias(f"null_{b}") for b in bands], *zero)


def invalid_rates(breakdown: DataFrame, by: list[str]) -> DataFrame:
    """Over groups: how many there are, how many fail, and median, P90 and maximum of the failing ones' invalid share."""
    fails = F.col("n_invalid") > F.col("n_member") - F.ceil(F.round(F.col("n_member") * MIN_VALID, 9))
    share = F.when(fails, F.col("invalid_share"))
    sums = breakdown.groupBy(*by).agg(F.count("*").alias("n"), F.count_if(fails).alias("n_failing"), F.max(share).alias("most"))
    middle = exact_quantiles(breakdown.withColumn("_share", share), by, "_share", {"median": 0.5, "p90": 0.9})
    return sums.join(middle, by, "left").select(*by, "n", "n_failing", "median", "p90", "most")
