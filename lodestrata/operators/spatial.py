"""Spatial joins: equi-joins on grid cells, then the exact predicate.

Polygons are listed under every cell that their box touches, points under their own, so both sides are
shuffled by cell. A cell's listing of a polygon holds only the edges that can matter there: those that reach the cell's
heights and do not lie left of it, as the even-odd ray runs to the right. A point so tests the edges of its cell
and not the whole polygon. Cells that hold more than CROWD points are split into quarters of quarters by their
counts, points and polygons alike, so a crowded cell becomes many small ones; points that share one place stay
together, and AQE splits their side of the join. ``cell`` should be near the polygons' usual width.

Points of one place and polygons of the same rings can't be told apart by any predicate, so places and shapes are
matched, each once, and their points and polygons are joined to the matches afterwards, or only counted.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import BinaryType, DoubleType, LongType, StringType, StructField, StructType

from ..functions import geometry as G
from . import meeting
from .contracts import duplicates, enforce, summed_before, together, violations
from .lineage import cut

MATCH_METRES = 2000.0
#: Points of a cell that is not split; depth of a split; cells that are split at most, those of most points.
#: The cell of rank r holds no more than 1/r of all points, so those left whole hold no more than 1/MOST_SPLIT each.
CROWD, DEEPEST, MOST_SPLIT = 50_000, 6, 10_000
#: Edges that are kept with every cell as they are.
FEW_EDGES = 16
#: Shapes of a cell that meet at once in one task, of either side; such cells are so many times wider, as a group costs more than a pair.
BLOCK, WIDER = 8192, 3
#: Points of one place, or polygons of one shape, that stand in one list.
MEMBERS = 1024


def _reaching(edges: Column, low: Column, high: Column, left: Column) -> Column:
    """The edges that reach heights low to high and do not lie left of ``left``."""
    near = lambda e: (F.greatest(e["y1"], e["y2"]) >= low) & (F.least(e["y1"], e["y2"]) <= high) & (F.greatest(e["x1"], e["x2"]) >= left)
    return F.when(F.size(edges) <= FEW_EDGES, edges).otherwise(F.filter(edges, near))


def polygons_by_cell(polygons: DataFrame, id_col: str, cell: float, grow: float = 0.0, whole: bool = False, keep: tuple[str, ...] = ()) -> DataFrame:
    """id, columns ``keep``, box, grid cells and the edges that matter to points there (``whole``: all edges); empty and null polygons are in no cell. Rows of cells are cut out before cells of rows."""
    p = polygons.select(id_col, *keep, G.edges(F.col("rings")).alias("_edges"), *[v.alias(f"_{k}") for k, v in G.bounds(F.col("rings")).items()])
    # polygons without a box come out without a cell and go last: filters on rings, and those that Spark infers of a plain
    # explode, are worked out where the rows are read, before they are dealt out
    span = lambda lo, hi: F.explode_outer(F.sequence(F.floor((F.col(lo) - grow) / cell), F.floor((F.col(hi) + grow) / cell)))
    pad = grow + cell * 1e-6  # more than the rounding of a place's cell
    if whole:
        return p.withColumn("_gy", span("_miny", "_maxy")).withColumn("_gx", span("_minx", "_maxx")).filter("_gx IS NOT NULL")
    p = p.withColumn("_gy", span("_miny", "_maxy"))
    p = p.withColumn("_edges", _reaching(F.col("_edges"), F.col("_gy") * cell - pad, (F.col("_gy") + 1) * cell + pad, F.lit(float("-inf"))))
    p = p.withColumn("_gx", span("_minx", "_maxx")).filter("_gx IS NOT NULL")
    return p.withColumn("_edges", _reaching(F.col("_edges"), F.lit(float("-inf")), F.lit(float("inf")), F.col("_gx") * cell - pad))


def points_by_cell(points: DataFrame, cell: float) -> DataFrame:
    p = points.filter(F.col("x").isNotNull() & F.col("y").isNotNull() & ~F.isnan("x") & ~F.isnan("y"))
    return p.withColumns({"_gx": F.floor(F.col("x") / cell), "_gy": F.floor(F.col("y") / cell)})


def crowded_cells(placed: DataFrame, crowd: int) -> DataFrame:
    """_gx, _gy, _deep: how often the cells of most points are quartered, at most MOST_SPLIT of them."""
    counted = placed.groupBy("_gx", "_gy").agg(F.count("*").alias("_n")).filter(F.col("_n") > crowd).orderBy(F.desc("_n"), "_gx", "_gy").limit(MOST_SPLIT)
    return counted.select("_gx", "_gy", F.least(F.lit(DEEPEST), F.ceil(F.log2(F.col("_n") / crowd) / 2)).cast("int").alias("_deep"))


def grid_join(points: DataFrame, polygons: DataFrame, id_col: str, cell: float, grow: float = 0.0, crowd: int = CROWD) -> DataFrame:
    """Columns of points, id, box and _edges of the polygons that are listed in each point's cell."""
    placed, listed = points_by_cell(points, cell), polygons_by_cell(polygons, id_col, cell, grow)
    crowded = F.broadcast(crowded_cells(placed, crowd))
    parts = F.expr("shiftleft(1, coalesce(_deep, 0))")
    # the same growing function of a coordinate on both sides, so that no rounding parts a point from a box that holds it
    part = lambda v, g: F.least(F.greatest(F.floor((v - g * cell) / cell * parts), F.lit(0)), parts - 1)
    placed = placed.join(crowded, ["_gx", "_gy"], "left")
    placed = placed.withColumns({"_sx": part(F.col("x"), F.col("_gx")), "_sy": part(F.col("y"), F.col("_gy"))}).drop("_deep")
    listed = listed.join(crowded, ["_gx", "_gy"], "left")
    span = lambda lo, hi, g: F.sequence(part(F.col(lo) - grow, F.col(g)), part(F.col(hi) + grow, F.col(g)))
    listed = listed.withColumn("_sy", F.explode(span("_miny", "_maxy", "_gy"))).withColumn("_sx", F.explode(span("_minx", "_maxx", "_gx")))
    side, pad = cell / parts, grow + cell * 1e-6
    low, left = F.col("_gy") * cell + F.col("_sy") * side - pad, F.col("_gx") * cell + F.col("_sx") * side - pad
    listed = listed.withColumn("_edges", F.when(F.col("_deep").isNull(), F.col("_edges")).otherwise(_reaching(F.col("_edges"), low, low + side + 2 * pad, left))).drop("_deep")
    return placed.join(listed, ["_gx", "_gy", "_sx", "_sy"])


def places(points: DataFrame) -> DataFrame:
    """(x, y): the distinct places of points."""
    return points.filter(F.col("x").isNotNull() & F.col("y").isNotNull() & ~F.isnan("x") & ~F.isnan("y")).select("x", "y").distinct()


def _digest(rings: str) -> Column:
    """SHA-256 of rings, in which -0.0 is 0.0, as it is to a grouping by rings. Never null, as a filter for nulls would work it out once more, before polygons are dealt out."""
    text = F.replace(F.replace(F.to_json(rings), F.lit("-0.0,"), F.lit("0.0,")), F.lit("-0.0}"), F.lit("0.0}"))
    return F.coalesce(F.unhex(F.sha2(text, 256)), F.lit(b"")).alias("_shape")


def shaped(polygons: DataFrame, keep: list[str]) -> DataFrame:
    """keep..., rings, and the SHA-256 of the rings as _shape; empty, which is no shape's, without rings."""
    return polygons.select(*keep, "rings", _digest("rings"))


def shapes(marked: DataFrame) -> DataFrame:
    """(_shape, rings): the distinct shapes of shaped() polygons. Rings are keys, so copies go by hashing before the shuffle; a first value would be sorted for."""
    return marked.filter("rings IS NOT NULL").select("rings").distinct().select(_digest("rings"), "rings")


def covering(points: DataFrame, polygons: DataFrame, id_col: str, cell: float, strict: bool = False, crowd: int = CROWD) -> DataFrame:
    """All columns of points and the id of each polygon that covers (strictly: contains) it, by a test of every pair that shares a cell."""
    x, y = F.col("x"), F.col("y")
    near = grid_join(points, polygons, id_col, cell, crowd=crowd).filter(x.between(F.col("_minx"), F.col("_maxx")) & y.between(F.col("_miny"), F.col("_maxy")))
    test = G.contains if strict else G.covers
    return near.filter(test(F.col("_edges"), x, y)).select(*points.columns, id_col)


def points_in_polygons(points: DataFrame, polygons: DataFrame, id_col: str, cell: float, strict: bool = False, crowd: int = CROWD, block: int = BLOCK) -> DataFrame:
    """All columns of points and the id of each polygon that covers (strictly: contains) it; inner join.

    Each place meets each shape once, in the blocks of a cell (meeting). Lists of a place's points and of a shape's
    polygons go there with them, and what leaves a block are such lists, which become rows at last: no pair is shuffled.
    ``crowd`` is that of grid_join() and of no effect here.
    """
    marked, wide = shaped(polygons, [id_col]), cell * WIDER
    placed = points.filter(F.col("x").isNotNull() & F.col("y").isNotNull() & ~F.isnan("x") & ~F.isnan("y"))
    left = points_by_cell(_lists(placed, ["x", "y"], points.columns), wide).withColumnsRenamed({"x": "_minx", "y": "_miny"}).withColumns({"_maxx": F.col("_minx"), "_maxy": F.col("_miny"), "_edges": F.array().cast("array<double>")})
    right = _listed(shapes(marked), wide).join(_ids(marked, id_col), "_id")

    def pairs(one: pa.Table, two: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        return meeting.covered(meeting._floats(one["_minx"]), meeting._floats(one["_miny"]), meeting.Side(two), strict)

    met = _lists_of_blocks(left.withColumn("_id", F.xxhash64("_minx", "_miny")), right, pairs, block)
    rows = met.select(F.explode("_left").alias("_l"), "_right").select(*[F.col(f"_l.`{c}`") for c in points.columns], "_right")
    return rows.select(*points.columns, F.explode("_right").alias(id_col))


def count_intersecting(points: DataFrame, polygons: DataFrame, id_col: str, cell: float, key: str = "row_no") -> DataFrame:
    """key, n: polygons that touch each point; null without a place, 0 where there are none. Counted by place and shape, so no pair is listed."""
    marked = shaped(polygons, [id_col])
    many = marked.groupBy("_shape").agg(F.count("*").alias("_many"))
    counted = covering(places(points), shapes(marked), "_shape", cell).join(many, "_shape").groupBy("x", "y").agg(F.sum("_many").alias("_n"))
    placed = F.col("x").isNotNull() & F.col("y").isNotNull()
    return points.select(key, "x", "y").join(counted, ["x", "y"], "left").select(key, F.when(placed, F.coalesce("_n", F.lit(0))).alias("n"))


def within_distance(points: DataFrame, polygons: DataFrame, id_col: str, metres: float, cell: float, crowd: int = CROWD) -> DataFrame:
    """Columns of points, polygon id and exact distance (0 inside and on the boundary), for all polygons no farther than ``metres``.

    A cell holds all edges within ``metres`` of it, so a distance over them that is no greater is the polygon's. Edges are
    made rows, which are measured in compiled code (lambdas over arrays are not), and a pair's are put together again
    as its least distance and its crossings; a pair that comes several times has so many times its edges.
    """
    x, y = F.col("x"), F.col("y")
    off = lambda v, lo, hi: F.greatest(F.col(lo) - v, v - F.col(hi), F.lit(0.0))
    of_box = F.hypot(off(x, "_minx", "_maxx"), off(y, "_miny", "_maxy"))
    near = grid_join(points, polygons, id_col, cell, metres, crowd).filter(of_box <= metres)
    pair = [*points.columns, id_col]
    e = F.col("_e")
    each = near.select(*pair, F.size("_edges").alias("_n"), F.explode("_edges").alias("_e"))
    each = each.select(*pair, "_n", G.edge_distance(e, x, y).alias("_d"), G.edge_crosses(e, x, y).cast("int").alias("_c"), G.on_one_edge(e, x, y).alias("_on"))
    sums = each.groupBy(*pair).agg(F.min("_d").alias("_d"), F.sum("_c").alias("_c"), F.bool_or("_on").alias("_on"), (F.count("*") / F.min("_n")).cast("int").alias("_times"))
    inside = F.col("_on") | (F.col("_c") / F.col("_times") % 2 == 1)
    found = sums.select(*pair, "_times", F.when(inside, 0.0).otherwise(F.col("_d")).alias("distance_m")).filter(F.col("distance_m") <= metres)
    return found.withColumn("_times", F.explode(F.array_repeat(F.lit(True), F.col("_times")))).drop("_times")


def crosswalk_checks(points: DataFrame, polygons: DataFrame, id_col: str) -> DataFrame:
    """(check, n, examples): null and repeated ids of either side. A repeated one would multiply rows and counts, so crosswalk() refuses them."""
    def side(df: DataFrame, key: str, name: str) -> DataFrame:
        known, n = F.col(key).isNotNull(), F.col("_n")
        many = known & (n > 1)
        shown = F.when(many, F.col(key).cast("string"))
        rows = (("null", F.coalesce(F.sum(F.when(~known, n)), F.lit(0)), F.lit("")), ("duplicate", F.count_if(many), F.concat_ws(",", F.min(shown), F.max(shown))))
        cells = F.array(*[F.struct(F.lit(f"{what}_{name}_id").alias("check"), count.alias("n"), text.alias("examples")) for what, count, text in rows])
        return df.groupBy(key).agg(F.count("*").alias("_n")).agg(cells.alias("c")).select(F.explode("c").alias("c")).select("c.*")

    return side(points, "site_id", "site").unionByName(side(polygons, id_col, "polygon"))


def crosswalk_matches(points: DataFrame, polygons: DataFrame, id_col: str, cell: float, metres: float = MATCH_METRES) -> tuple[DataFrame, DataFrame]:
    """Matches (x, y, _shape, least, distance_m, stage, ambiguity_n, confidence) of places and shapes, and polygons (id, _shape); refuses null and repeated ids.

    Containment first; places in no polygon get all shapes within ``metres``; only they are looked at again for distances.
    ``least`` is the first id of a shape's polygons; all polygons of all shapes that a place matches count for its ambiguity_n.
    confidence, one for a place: high inside, medium near one polygon, low near several. The matches of either stage
    are read several times, so each is made once, by cut().
    """
    enforce(crosswalk_checks(points, polygons, id_col))
    at, marked = places(points), shaped(polygons, [id_col])
    kinds = shapes(marked)
    many = marked.groupBy("_shape").agg(F.count("*").alias("_many"), F.min(id_col).alias("least"))
    held = cut(covering(at, kinds, "_shape", cell)).withColumns({"distance_m": F.lit(0.0), "stage": F.lit("containment")})
    free = at.join(held.select("x", "y").distinct(), ["x", "y"], "left_anti")
    near = cut(within_distance(free, kinds, "_shape", metres, cell)).withColumn("stage", F.lit("proximity"))
    # in a window over the few shapes about a place
    matched = held.unionByName(near).join(many, "_shape").withColumn("ambiguity_n", F.sum("_many").over(Window.partitionBy("x", "y"))).drop("_many")
    confidence = F.when(F.col("stage") == "containment", "high").when(F.col("ambiguity_n") == 1, "medium").otherwise("low")
    return matched.withColumn("confidence", confidence), marked.select(id_col, "_shape")


def crosswalk(points: DataFrame, polygons: DataFrame, id_col: str, cell: float, metres: float = MATCH_METRES) -> DataFrame:
    """Rows (site_id, footprint, stage, distance, confidence, ambiguity_n, shared_by_n) of points (site_id, x, y) and crosswalk_matches(); points without a match have one unmatched row."""
    points = points.select("site_id", "x", "y")
    matched, members = crosswalk_matches(points, polygons, id_col, cell, metres)
    listed = matched.join(members.join(_sites_by_shape(points, matched), "_shape"), "_shape").drop("_shape", "least")
    rows = points.join(listed, ["x", "y"], "left")
    filled = {"stage": "unmatched", "confidence": "none", "ambiguity_n": 0, "shared_by_n": 1}
    return rows.select("site_id", id_col, *[F.coalesce(c, F.lit(filled[c])).alias(c) if c in filled else c for c in ("stage", "distance_m", "confidence", "ambiguity_n", "shared_by_n")])


def crosswalk_places(points: DataFrame, polygons: DataFrame, id_col: str, cell: float, metres: float = MATCH_METRES) -> DataFrame:
    """(site_id, id, place): the crosswalk's rows numbered from 0 by site and polygon id, nulls last. They come in no order: none is sorted, shuffled or kept.

    Sites are sorted, and a site's rows follow those of all sites before it, in the order of the ids that its place
    matches, which are ranked once a place. Site and rank meet in the last step, which only gives rows out.
    """
    matched, members = crosswalk_matches(points, polygons, id_col, cell, metres)
    many = matched.groupBy("x", "y").agg(F.first("ambiguity_n").alias("_n"))  # one for a place
    sites = points.select("site_id", "x", "y").join(many, ["x", "y"], "left").withColumn("_n", F.coalesce("_n", F.lit(1)))
    sites = summed_before(sites.orderBy(F.asc_nulls_last("site_id")), "_n", "_first")
    rank = F.row_number().over(Window.partitionBy("x", "y").orderBy(id_col)) - 1
    ranked = matched.select("x", "y", "_shape").join(members, "_shape").select("x", "y", id_col, rank.alias("_rank"))
    return sites.join(ranked, ["x", "y"], "left").select("site_id", id_col, (F.col("_first") + F.coalesce("_rank", F.lit(0))).alias("place"))


def held_by_polygons(points: DataFrame, polygons: DataFrame, id_col: str, cell: float) -> DataFrame:
    """(site_id, id): the crosswalk's rows of high confidence, those of points in polygons, without its other rows; refuses null and repeated ids."""
    enforce(crosswalk_checks(points, polygons, id_col))
    return points_in_polygons(points.select("site_id", "x", "y"), polygons, id_col, cell).select("site_id", id_col)


def _sites_by_shape(points: DataFrame, matched: DataFrame) -> DataFrame:
    """(_shape, shared_by_n): sites that match each shape, by the counts of places."""
    return matched.select("x", "y", "_shape").join(points.groupBy("x", "y").agg(F.count("*").alias("_n")), ["x", "y"]).groupBy("_shape").agg(F.sum("_n").alias("shared_by_n"))


def sites_by_polygon(points: DataFrame, polygons: DataFrame, id_col: str, cell: float, metres: float = MATCH_METRES) -> DataFrame:
    """(id, shared_by_n) of the polygons that the crosswalk matches, without its rows."""
    matched, members = crosswalk_matches(points, polygons, id_col, cell, metres)
    return members.join(_sites_by_shape(points, matched), "_shape").select(id_col, "shared_by_n")


def first_matches(points: DataFrame, polygons: DataFrame, id_col: str, cell: float, metres: float = MATCH_METRES, block: int = BLOCK) -> DataFrame:
    """(site_id, id, confidence, ambiguity_n): of each site the crosswalk's row of least polygon id, without its other rows, of the same confidence all."""
    per = first_matches_of_places(points, polygons, id_col, cell, metres, block)
    return points.join(per, ["x", "y"], "left").select("site_id", id_col, F.coalesce("confidence", F.lit("none")).alias("confidence"), F.coalesce("ambiguity_n", F.lit(0)).alias("ambiguity_n"))


def first_matches_of_places(points: DataFrame, polygons: DataFrame, id_col: str, cell: float, metres: float = MATCH_METRES, block: int = BLOCK) -> DataFrame:
    """(x, y, id, confidence, ambiguity_n): first_matches() of the places that have any, each once.

    Places and shapes of a cell meet in blocks (meeting), and only a place's counts and least ids leave a block, not its matches.
    """
    enforce(crosswalk_checks(points, polygons, id_col))
    marked, wide = shaped(polygons, [id_col]), cell * WIDER
    many = marked.groupBy(F.col("_shape").alias("_id")).agg(F.count("*").alias("_many"), F.min(id_col).alias("least"))
    a = cut(points_by_cell(places(points), wide).withColumn("_id", F.xxhash64("x", "y")))
    b = cut(_listed(shapes(marked), wide, metres))
    keys, kind = ["_gx", "_gy", "_ab", "_bb"], polygons.schema[id_col].dataType
    fields = StructType([StructField("x", DoubleType()), StructField("y", DoubleType()), StructField("held", LongType()), StructField("held_least", kind), StructField("near", LongType()), StructField("near_least", kind)])
    schema = to_arrow_schema(fields)

    def match(one: pa.Table, two: pa.Table) -> pa.Table:
        return meeting.place_matches(one, two, metres, schema)

    left, right = _in_blocks(a, b, "_ab", "_bb", block), _in_blocks(b, a, "_bb", "_ab", block).join(many, "_id")
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(match, fields)
    per = found.groupBy("x", "y").agg(F.sum("held").alias("_held"), F.min("held_least").alias("_h"), F.sum("near").alias("_near"), F.min("near_least").alias("_l"))
    held = F.col("_held") > 0
    confidence = F.when(held, "high").when(F.col("_near") == 1, "medium").otherwise("low")
    return per.select("x", "y", F.when(held, F.col("_h")).otherwise(F.col("_l")).alias(id_col), confidence.alias("confidence"), F.when(held, F.col("_held")).otherwise(F.col("_near")).alias("ambiguity_n"))


def ordered_crosswalk(rows: DataFrame, id_col: str) -> DataFrame:
    return rows.orderBy(F.asc_nulls_last("site_id"), F.asc_nulls_last(id_col))


def crosswalk_counts(rows: DataFrame) -> DataFrame:
    """Distinct sites and rows per confidence, over the fixed levels, and in all."""
    by = rows.groupBy("confidence").agg(F.count_distinct("site_id").alias("sites"), F.count("*").alias("rows"))
    levels = rows.sparkSession.createDataFrame([(x,) for x in ("high", "medium", "low", "none")], "confidence string")
    full = levels.join(by, "confidence", "left").select("confidence", F.coalesce("sites", F.lit(0)).alias("sites"), F.coalesce("rows", F.lit(0)).alias("rows"))
    return full.unionByName(rows.agg(F.lit("total").alias("confidence"), F.count_distinct("site_id").alias("sites"), F.count("*").alias("rows")))


def assign_region(points: DataFrame, regions: DataFrame, names: dict[str, str], other: str, cell: float, key: str = "row_no") -> DataFrame:
    """key, region_name, stratum, n_regions: the smallest name of the regions that cover the point; null, a violation, where none does."""
    hit = points_in_polygons(places(points), regions, "region_name", cell).groupBy("x", "y").agg(F.min("region_name").alias("region_name"), F.count("*").alias("n_regions"))
    table = F.create_map(*[F.lit(v) for pair in names.items() for v in pair])
    joined = points.select(key, "x", "y").join(hit, ["x", "y"], "left")
    stratum = F.when(F.col("region_name").isNotNull(), F.coalesce(F.try_element_at(table, F.col("region_name")), F.lit(other)))
    return joined.select(key, "region_name", stratum.alias("stratum"), F.coalesce("n_regions", F.lit(0)).cast("long").alias("n_regions"))


def uncovered(points: DataFrame, regions: DataFrame, ceiling: float, cell: float, key: str = "row_no") -> DataFrame:
    """One row: points, those that no region covers, their share, and whether that is within the ceiling."""
    hit = points_in_polygons(points.select(key, "x", "y"), regions, "region_name", cell).select(key).distinct()
    marked = points.select(key).join(hit.withColumn("_in", F.lit(True)), key, "left")
    out = marked.agg(F.count("*").alias("points"), F.count_if(F.col("_in").isNull()).alias("uncovered"))
    share = F.try_divide(F.col("uncovered").cast("double"), F.col("points"))
    return out.withColumn("share", share).withColumn("within_ceiling", F.col("share") <= ceiling)


def split_uncovered(points: DataFrame, regions: DataFrame, cell: float, key: str = "row_no") -> tuple[DataFrame, DataFrame]:
    """The points that a region covers, boundary included, with all their columns, and the keys of the others."""
    hit = points_in_polygons(points.select(key, "x", "y"), regions, "region_name", cell).select(key).distinct()
    return points.join(hit, key, "left_semi"), points.select(key).join(hit, key, "left_anti")


def polygon_pairs(one: DataFrame, two: DataFrame, one_id: str, two_id: str, cell: float, test=G.polygons_intersect, once_only: bool = False) -> DataFrame:
    """(one_id, two_id): pairs of polygons that pass a test of their edges, each once; with ``once_only`` only those whose ids do not descend.

    A pair that meets in several cells is kept in the cell of its boxes' common lower left corner only, so no distinct is needed.
    """
    a, b = polygons_by_cell(one, one_id, cell, whole=True), polygons_by_cell(two, two_id, cell, whole=True)  # edges may meet in another cell
    b = b.select("_gx", "_gy", two_id, F.col("_edges").alias("_edges2"), *[F.col(f"_{k}").alias(f"_{k}2") for k in ("minx", "miny", "maxx", "maxy")])
    near = a.join(b, ["_gx", "_gy"])
    near = near.filter(F.col(one_id) <= F.col(two_id)) if once_only else near
    c = F.col
    boxes = (c("_minx") <= c("_maxx2")) & (c("_minx2") <= c("_maxx")) & (c("_miny") <= c("_maxy2")) & (c("_miny2") <= c("_maxy"))
    once = (F.floor(F.greatest("_minx", "_minx2") / cell) == c("_gx")) & (F.floor(F.greatest("_miny", "_miny2") / cell) == c("_gy"))
    return near.filter(boxes & once & test(c("_edges"), c("_edges2"))).select(one_id, two_id)


def _in_blocks(listed: DataFrame, other: DataFrame, mine: str, theirs: str, block: int, by: tuple[str, ...] = ("_id",)) -> DataFrame:
    """Rows of cells dealt to blocks of some ``block`` rows of their cell (column ``mine``), each once for every block of the other side (``theirs``)."""
    parts = lambda df, name: df.groupBy("_gx", "_gy").agg(F.ceil(F.count("*") / block).cast("int").alias(name))
    rows = listed.join(parts(listed, "_p"), ["_gx", "_gy"]).join(parts(other, "_q"), ["_gx", "_gy"])
    return rows.withColumn(mine, F.pmod(F.xxhash64(*by), F.col("_p")).cast("int")).withColumn(theirs, F.explode(F.sequence(F.lit(0), F.col("_q") - 1))).drop("_p", "_q")


def _listed(kinds: DataFrame, cell: float, grow: float = 0.0, keep: tuple[str, ...] = ()) -> DataFrame:
    """_id, columns ``keep``, box and flat edges of shapes by the cells that their boxes, grown by ``grow``, touch."""
    flat = F.flatten(F.transform("_edges", lambda e: F.array(e["x1"], e["y1"], e["x2"], e["y2"])))
    return polygons_by_cell(kinds.withColumnRenamed("_shape", "_id"), "_id", cell, grow, True, keep).withColumn("_edges", flat)


def _lists(rows: DataFrame, keys: list[str], keep: list[str]) -> DataFrame:
    """keys..., _part, _members: columns ``keep`` of the rows that share keys, as lists of structs, of some MEMBERS rows at most."""
    crowded = rows.groupBy(*keys).agg(F.count("*").alias("_n")).filter(F.col("_n") > MEMBERS)
    part = F.pmod(F.xxhash64(*keep), F.coalesce(F.ceil(F.col("_n") / MEMBERS), F.lit(1)))
    # dealt by key once, for the join as for the lists
    return rows.join(crowded, keys, "left").withColumn("_part", part).groupBy(*keys, "_part").agg(F.collect_list(F.struct(*keep)).alias("_members"))


def _ids(marked: DataFrame, id_col: str) -> DataFrame:
    """_id, _part, _members: the ids of the shaped() polygons of each shape, in lists."""
    return _lists(marked, ["_shape"], [id_col]).withColumn("_members", F.transform("_members", lambda m: m[id_col])).withColumnRenamed("_shape", "_id")


_BOX = ["_minx", "_miny", "_maxx", "_maxy", "_edges"]


def _by_block(left: DataFrame, right: DataFrame, block: int, keep: list[str]) -> DataFrame:
    """Rows of both sides (_side 0 and 1) by cell and pair of blocks, with the columns ``keep``; dealt over as many tasks as a shuffle has, as AQE would go by bytes, which are few beside the pairs."""
    side = lambda df, mine, theirs, other, n: _in_blocks(df, other, mine, theirs, block, ("_id", "_part")).select("_gx", "_gy", "_ab", "_bb", F.lit(n).alias("_side"), *_BOX, *keep)
    rows = side(left, "_ab", "_bb", right, 0).unionByName(side(right, "_bb", "_ab", left, 1), allowMissingColumns=True)
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), "_gx", "_gy", "_ab", "_bb")


def _lists_of_blocks(left: DataFrame, right: DataFrame, pairs: Callable, block: int) -> DataFrame:
    """(_left, _right): lists of members whose products are those of all pairs of rows that ``pairs`` gives for the two sides of a block."""
    left, right = left.withColumnRenamed("_members", "_left"), right.withColumnRenamed("_members", "_right")
    kinds = {"_left": left.schema["_left"].dataType, "_right": right.schema["_right"].dataType}
    left = left.withColumn("_right", F.lit(None).cast(kinds["_right"]))
    right = right.withColumn("_left", F.lit(None).cast(kinds["_left"]))
    fields = StructType([StructField(k, v) for k, v in kinds.items()])
    schema = to_arrow_schema(fields)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one, two = _sides(batches)
        if one.num_rows and two.num_rows:
            yield from meeting.listed(pairs(one, two), meeting.members(one, "_left"), meeting.members(two, "_right"), schema)

    return _by_block(left, right, block, ["_left", "_right"]).groupBy("_gx", "_gy", "_ab", "_bb").applyInArrow(meet, fields)


def _sides(batches: Iterator[pa.RecordBatch]) -> tuple[pa.Table, pa.Table]:
    table = pa.Table.from_batches(list(batches)).combine_chunks()
    side = table["_side"].to_numpy()
    return table.filter(pa.array(side == 0)), table.filter(pa.array(side == 1))


def fire_year_counts(footprints: DataFrame, fires: DataFrame, cell: float, block: int = BLOCK) -> DataFrame:
    """(footprint_id, fire_year, n): fire polygons that share a point with each footprint, by year.

    Fires are counted by rings and year where they are read, so no fire is shuffled. Shapes are matched, each once. The
    shapes of a cell meet in blocks of at most some ``block`` rows a side, in numpy (meeting), and only a shape's counts
    by year leave a block, not its pairs. A pair counts in the cell of its boxes' common lower left corner only.
    """
    ours, cell = shaped(footprints, ["footprint_id"]), cell * WIDER
    yearly = fires.filter("rings IS NOT NULL").groupBy("rings", F.col("fire_year").cast("long").alias("fire_year")).agg(F.count("*").alias("_n"))
    # the years of a shape are few
    theirs = yearly.groupBy("rings").agg(F.collect_list(F.struct("fire_year", "_n")).alias("_y")).select("rings", _digest("rings"), F.transform("_y", lambda y: y["fire_year"]).alias("_years"), F.transform("_y", lambda y: y["_n"]).alias("_ns"))
    a, b = cut(_listed(shapes(ours), cell)), cut(_listed(theirs, cell, keep=("_years", "_ns")))
    left, right = _in_blocks(a, b, "_ab", "_bb", block), _in_blocks(b, a, "_bb", "_ab", block)
    keys = ["_gx", "_gy", "_ab", "_bb"]

    def count(one: pa.Table, two: pa.Table) -> pa.Table:
        return meeting.yearly_counts(one, two, cell)

    counted = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(count, "_shape binary, fire_year long, n long")
    counted = counted.groupBy("_shape", "fire_year").agg(F.sum("n").alias("n")).withColumn("fire_year", F.col("fire_year").cast(fires.schema["fire_year"].dataType))
    return ours.select("footprint_id", "_shape").join(counted, "_shape").select("footprint_id", "fire_year", "n")


def overlapping_pairs(regions: DataFrame, id_col: str, cell: float, block: int = BLOCK) -> DataFrame:
    """(a, b): regions whose interiors overlap, a before b; shared boundary alone is no overlap.

    Shapes meet in the blocks of a cell, either way round, with lists of their regions; lists become rows last, those with a before b.
    """
    marked = shaped(regions, [id_col])
    return _overlapping(marked, shapes(marked), id_col, cell * WIDER, block)


def _overlapping(marked: DataFrame, kinds: DataFrame, id_col: str, wide: float, block: int) -> DataFrame:
    side = cut(_listed(kinds, wide).join(_ids(marked, id_col), "_id"))
    met = _lists_of_blocks(side, side, lambda one, two: meeting.overlapping(one, two, wide), block)
    return met.select(F.explode("_left").alias("a"), "_right").select("a", F.explode("_right").alias("b")).filter("a < b")


def overlap_summary(regions: DataFrame, id_col: str, cell: float, block: int = BLOCK) -> DataFrame:
    """One row (n, least, greatest): how many overlapping_pairs() there are, and the least and greatest "a|b", of regions whose ids are there once.

    No pair is listed. A shape's partners are counted, and the greatest of their ids shows which of its regions come first in
    some pair; of these the one of least "a|" begins the least text (no id holds "|"; else pairs are listed), so only its partners are looked up.
    """
    marked = shaped(regions, [id_col])
    return _overlap_summary(marked, shapes(marked), id_col, cell * WIDER, block)


def _overlap_summary(marked: DataFrame, kinds: DataFrame, id_col: str, wide: float, block: int = BLOCK) -> DataFrame:
    key = F.concat(F.col(id_col), F.lit("|"))
    if not marked.filter(F.contains(id_col, F.lit("|"))).isEmpty():
        text = F.concat_ws("|", "a", "b")
        return _overlapping(marked, kinds, id_col, wide, block).agg(F.count("*").alias("n"), F.min(text).alias("least"), F.max(text).alias("greatest"))
    many = marked.groupBy("_shape").agg(F.count("*").alias("_many"), F.max(id_col).alias("_top"))
    side = cut(_listed(kinds, wide).join(many.withColumnRenamed("_shape", "_id"), "_id").withColumn("_part", F.lit(0)))
    fields = StructType([StructField("_shape", BinaryType()), StructField("n", LongType()), StructField("top", StringType())])
    schema = to_arrow_schema(fields)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one, two = _sides(batches)
        if one.num_rows and two.num_rows:
            yield from meeting.partners(one, two, wide, schema).to_batches()

    def met(two: DataFrame) -> DataFrame:
        return _by_block(side, two, block, ["_id", "_many", "_top"]).groupBy("_gx", "_gy", "_ab", "_bb").applyInArrow(meet, fields)

    found = met(side).groupBy("_shape").agg(F.sum("n").alias("n"), F.max("top").alias("top"))
    kinds = side.select(F.col("_id").alias("_shape"), "_many", "_top").distinct()  # those that have a box
    kinds = cut(kinds.join(found, "_shape", "left").select("_shape", "_many", F.coalesce("n", F.lit(0)).alias("n"), F.greatest("_top", "top").alias("top")))
    firsts = marked.join(kinds.select("_shape", "top"), "_shape").filter(F.col(id_col) < F.col("top"))
    best = firsts.agg(F.min_by(F.struct(F.col(id_col).alias("id"), "_shape"), key).alias("low"), F.max(F.concat(key, F.col("top"))).alias("greatest")).head()  # one row
    total = kinds.agg(F.coalesce((F.sum(F.col("_many") * F.col("n")) + F.sum(F.col("_many") * (F.col("_many") - 1))) / 2, F.lit(0)).cast("long").alias("n"))
    if best.low is None:
        return total.withColumns({"least": F.lit(None).cast("string"), "greatest": F.lit(None).cast("string")})
    # which shapes overlap that one: it meets them, and they come out as the left side
    one = side.filter(F.col("_id") == F.lit(best.low["_shape"]))
    own = met(one).select("_shape").unionByName(one.select(F.col("_id").alias("_shape"))).distinct()
    second = marked.join(own, "_shape").filter(F.col(id_col) > best.low["id"]).agg(F.min(id_col).alias("b"))
    return total.crossJoin(second.select(F.concat_ws("|", F.lit(best.low["id"]), "b").alias("least"), F.lit(best.greatest).alias("greatest")))


def nearest_cell(points: DataFrame, cells: DataFrame, x0: float, y0: float, step: float, key: str) -> DataFrame:
    """key, cell_x, cell_y, reason: the grid centre nearest each point, no farther than half a step on either axis; beyond that none.

    ``cells`` holds the centres that exist (cell_x, cell_y). Closed form: no distance is compared.
    """
    gx, gy = F.round((F.col("x") - x0) / step), F.round((F.col("y") - y0) / step)
    at = points.select(key, (F.lit(x0) + gx * step).alias("cell_x"), (F.lit(y0) + gy * step).alias("cell_y"))
    known = cells.select("cell_x", "cell_y").distinct().withColumn("_known", F.lit(True))
    out = at.join(known, ["cell_x", "cell_y"], "left")
    there = F.col("_known").isNotNull()
    reason = F.when(F.col("cell_x").isNull() | F.col("cell_y").isNull(), "no_place").when(~there, "outside_grid")
    return out.select(key, F.when(there, F.col("cell_x")).alias("cell_x"), F.when(there, F.col("cell_y")).alias("cell_y"), reason.alias("reason"))


def feature_checks(features: DataFrame, id_col: str, crs: str, expected_crs: str, required: tuple[str, ...], date_col: str | None = None, type_col: str | None = None) -> DataFrame:
    """(check, n, examples): ids, geometry and its type of a polygon layer, its one extract date, and whether it has its CRS and columns."""
    rules = {
        "null_id": F.col(id_col).isNull(),
        "unusable": G.unusable_reason(F.col("rings")).isNotNull(),
        "not_positive": G.area(F.col("rings")) <= 0,
    }
    if type_col:
        rules["not_polygonal"] = ~F.coalesce(F.col(type_col), F.lit("")).isin("Polygon", "MultiPolygon")
    missing = sorted(set(required) - set(features.columns))
    found = [("wrong_crs", int(crs != expected_crs), crs if crs != expected_crs else ""), ("missing_column", len(missing), ",".join(missing))]
    out = [violations(features, rules, F.col(id_col)), duplicates(features.filter(F.col(id_col).isNotNull()), [id_col], "duplicate_id"), features.sparkSession.createDataFrame(found, "check string, n long, examples string")]
    if date_col:  # one extract: no date more, and none fewer
        n = F.count_distinct(date_col)
        out.append(features.agg(F.lit("extract_dates").alias("check"), F.abs(n - 1).alias("n"), F.concat_ws(",", F.min(date_col).cast("string"), F.max(date_col).cast("string")).alias("examples")))
    return together(*out)


def region_checks(regions: DataFrame, required: tuple[str, ...], cell: float) -> DataFrame:
    """(check, n, examples) of regions (region_name, rings): names there, once and as required; geometry usable; interiors apart."""
    names = regions.sparkSession.createDataFrame([(r,) for r in required], "region_name string")
    absent = names.join(regions.select("region_name").distinct(), "region_name", "left_anti").agg(F.lit("missing_region").alias("check"), F.count("*").alias("n"), F.concat_ws(",", F.min("region_name"), F.max("region_name")).alias("examples"))
    # a shape is judged once; it and the names are kept, as every check reads them
    marked = shaped(regions, ["region_name"])
    kinds = cut(shapes(marked).withColumn("_bad", G.unusable_reason(F.col("rings")).isNotNull()))
    judged = cut(marked.select("region_name", "_shape").join(kinds.select("_shape", "_bad"), "_shape", "left").withColumn("_bad", F.coalesce("_bad", F.lit(True))))
    named = violations(judged, {"null_name": F.col("region_name").isNull(), "unusable": F.col("_bad")}, F.col("region_name"))
    one = cut(judged.filter("region_name IS NOT NULL AND NOT _bad").groupBy("region_name").agg(F.min("_shape").alias("_shape")))
    overlaps = _overlap_summary(one, kinds.filter("NOT _bad").drop("_bad"), "region_name", cell * WIDER).select(F.lit("overlap").alias("check"), "n", F.concat_ws(",", "least", "greatest").alias("examples"))
    return together(named, absent, duplicates(judged.filter("region_name IS NOT NULL"), ["region_name"], "duplicate_name"), overlaps)
