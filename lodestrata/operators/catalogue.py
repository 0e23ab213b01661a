"""Catalogue items: nested JSON flattened, coverage of sites, volumes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .contracts import duplicates, keep_first, together, violations

BYTES_OF = {"uint8": 1, "int16": 2, "uint16": 2, "float32": 4, "float64": 8}
ASSUMED_BYTES, COMPRESSION = 2, 0.6


def flatten_items(items: DataFrame) -> DataFrame:
    """One row per item (source_id, id, bbox, properties, assets): box, year text, tile, version and the sorted asset names, joined by bars."""
    p = F.col("properties")
    return items.select(
        "source_id", F.col("id").alias("item_id"), *[F.get(F.col("bbox"), F.lit(i)).alias(n) for i, n in enumerate(("minx", "miny", "maxx", "maxy"))],
        p["datetime"].alias("datetime"), p["region_code"].alias("tile_id"), p["dataset_version"].alias("version"),
        F.array_join(F.array_sort(F.map_keys("assets")), "|").alias("asset_identity"), F.size("assets").alias("n_assets"),
    )


def item_violations(flat: DataFrame, required: dict[str, tuple[str, ...]]) -> DataFrame:
    """(check, n, examples) of flattened items: each source must have items, each item its box, date and the source's required assets, and its id once."""
    wanted = F.create_map(*[x for s, names in required.items() for x in (F.lit(s), F.array(*map(F.lit, names)))])
    lacks = F.size(F.array_except(F.try_element_at(wanted, F.col("source_id")), F.split(F.coalesce("asset_identity", F.lit("")), r"\|"))) > 0
    rules = {
        "no_box": F.col("maxy").isNull(),
        "no_assets": F.coalesce("n_assets", F.lit(0)) <= 0,
        "missing_asset": lacks,
        "no_datetime": F.col("datetime").isNull(),
        "unreadable_datetime": F.col("datetime").isNotNull() & ~F.col("datetime").rlike("^[0-9]{4}"),
        "unknown_source": ~F.col("source_id").isin(*required),
    }
    names = flat.sparkSession.createDataFrame([(s,) for s in required], "source_id string")
    empty = names.join(flat.select("source_id").distinct(), "source_id", "left_anti").agg(F.lit("empty_source").alias("check"), F.count("*").alias("n"), F.concat_ws(",", F.min("source_id"), F.max("source_id")).alias("examples"))
    return together(violations(flat, rules, F.col("item_id")), empty, duplicates(flat, ["source_id", "item_id"], "duplicate_id"))


def flatten_assets(items: DataFrame) -> DataFrame:
    """One row per asset: shape, block, data type and bytes per sample; nothing that is not stated is filled in."""
    a = F.col("a.value")
    rows = items.select("source_id", F.col("id").alias("item_id"), F.explode(F.map_entries("assets")).alias("a"))
    bytes_of = F.create_map(*[F.lit(v) for pair in BYTES_OF.items() for v in pair])
    return rows.select(
        "source_id", "item_id", F.col("a.key").alias("asset"), a["href"].alias("href"), F.get(a["shape"], F.lit(0)).alias("rows"), F.get(a["shape"], F.lit(1)).alias("cols"),
        F.get(a["blocks"], F.lit(0)).alias("block_rows"), F.get(a["blocks"], F.lit(1)).alias("block_cols"), a["data_type"].alias("data_type"), F.try_element_at(bytes_of, a["data_type"]).alias("sample_bytes"),
    )


def select_band_hrefs(items: DataFrame, required: list[str]) -> DataFrame:
    """Per item: hrefs of the required assets, in their order, and the names of those missing."""
    want = F.array(*map(F.lit, required))
    return items.select("source_id", F.col("id").alias("item_id"), F.transform(want, lambda n: F.try_element_at("assets", n)["href"]).alias("hrefs"), F.array_join(F.array_except(want, F.map_keys("assets")), ",").alias("missing"))


def asset_disclosures(assets: DataFrame) -> DataFrame:
    return assets.groupBy("source_id").agg(F.count("*").alias("assets"), *[F.count_if(F.col(c).isNull()).alias(f"no_{c}") for c in ("rows", "block_rows", "sample_bytes")])


def epoch_coverage(sites: DataFrame, items: DataFrame, sources: tuple[str, ...], cell: float) -> DataFrame:
    """row_no and, by source, the distinct years with an item whose box covers the site; null without a place, 0 where none does.

    Items of one box are one row with the years of each source, and sites of one place are counted once, before the join, which is an equi-join on grid cells.
    """
    box = ["minx", "miny", "maxx", "maxy"]
    years = items.groupBy(*box).agg(*[F.collect_set(F.when(F.col("source_id") == s, F.col("item_year"))).alias(s) for s in sources])  # no more than there are years
    span = lambda lo, hi: F.explode(F.sequence(F.floor(F.col(lo) / cell), F.floor(F.col(hi) / cell)))
    boxes = years.withColumn("gx", span("minx", "maxx")).withColumn("gy", span("miny", "maxy"))
    there = F.col("x").isNotNull() & F.col("y").isNotNull()
    placed = sites.filter(there).select("x", "y").distinct().withColumns({"gx": F.floor(F.col("x") / cell), "gy": F.floor(F.col("y") / cell)})
    hit = placed.join(boxes, ["gx", "gy"]).filter("x BETWEEN minx AND maxx AND y BETWEEN miny AND maxy")
    counts = hit.groupBy("x", "y").agg(*[F.size(F.array_distinct(F.flatten(F.collect_list(s)))).cast("long").alias(s) for s in sources])
    return sites.select("row_no", "x", "y").join(counts, ["x", "y"], "left").select("row_no", *[F.when(there, F.coalesce(s, F.lit(0))).alias(s) for s in sources])


def touched_tile_years(sites: DataFrame, items: DataFrame, ranges: DataFrame) -> DataFrame:
    """By source: distinct tile-years whose box holds a site, within the source's declared years and outside them."""
    tiles = items.select("source_id", "tx", "ty", "item_year", "minx", "miny", "maxx", "maxy").distinct()
    places = sites.filter("x IS NOT NULL AND y IS NOT NULL").select("x", "y").distinct()
    cell = 10000.0
    span = lambda lo, hi: F.explode(F.sequence(F.floor(F.col(lo) / cell), F.floor(F.col(hi) / cell)))
    boxes = tiles.select("minx", "miny", "maxx", "maxy").distinct().withColumn("gx", span("minx", "maxx")).withColumn("gy", span("miny", "maxy"))
    held = boxes.join(places.select("x", "y", F.floor(F.col("x") / cell).alias("gx"), F.floor(F.col("y") / cell).alias("gy")), ["gx", "gy"])
    held = held.filter("x BETWEEN minx AND maxx AND y BETWEEN miny AND maxy").select("minx", "miny", "maxx", "maxy").distinct()
    touched = tiles.join(held, ["minx", "miny", "maxx", "maxy"], "left_semi").join(F.broadcast(ranges), "source_id")
    inside = F.col("item_year").between(F.col("first_year"), F.col("last_year"))
    return touched.groupBy("source_id").agg(F.count_if(inside).alias("tile_years"), F.count_if(~inside).alias("outside_range"))


def select_items(items: DataFrame, tiles: DataFrame) -> DataFrame:
    """One row per (source, tile, year) on the given tiles: the least item, and how many there are; over one is a violation."""
    return items.join(tiles, ["tx", "ty"], "left_semi").groupBy("source_id", "tx", "ty", "item_year").agg(F.min("item_no").alias("item_no"), F.count("*").alias("n_items"))


def first_seen(items: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The first row of each key in source order; the others are refused."""
    return keep_first(items, keys, [order])


def append_aligned(register: DataFrame, extra: DataFrame, key: str = "row_no") -> DataFrame:
    """Columns of extra beside the register's. Both must have the same keys, once each: misaligned() tells."""
    return register.join(extra, key)


def misaligned(register: DataFrame, extra: DataFrame, key: str = "row_no") -> DataFrame:
    """One row: keys only on one side, and keys that repeat."""
    a, b = (d.groupBy(key).agg(F.count("*").alias(n)) for d, n in ((register, "na"), (extra, "nb")))
    return a.join(b, key, "full").agg(F.count_if(F.col("nb").isNull()).alias("only_register"), F.count_if(F.col("na").isNull()).alias("only_extra"), F.count_if((F.coalesce("na", F.lit(0)) > 1) | (F.coalesce("nb", F.lit(0)) > 1)).alias("repeated"))


def volume_estimate(footprints: DataFrame, epochs: DataFrame, assets: DataFrame, side: Column) -> DataFrame:
    """By source: window pixels x epochs x assets x bytes, times the usual compression; observed bytes, else the assumed ones.

    footprints: (footprint_id, span); epochs: (footprint_id, source_id, n_years); assets: (source_id, n_assets, sample_bytes).
    """
    px = footprints.select("footprint_id", (side * side).alias("window_px"))
    rows = epochs.join(px, "footprint_id").groupBy("source_id").agg(F.sum(F.col("window_px") * F.col("n_years")).alias("px_years"), F.sum("n_years").alias("footprint_years"))
    out = rows.join(F.broadcast(assets), "source_id", "left")
    observed = F.col("sample_bytes").isNotNull()
    raw = F.col("px_years") * F.col("n_assets") * F.coalesce("sample_bytes", F.lit(ASSUMED_BYTES))
    return out.select("source_id", "px_years", "footprint_years", F.when(observed, "observed").otherwise("assumed").alias("bytes_basis"), raw.alias("raw_bytes"), F.floor(raw * F.lit(COMPRESSION)).cast("long").alias("estimated_bytes"))


def volume_bounds(footprints: DataFrame, epochs: DataFrame, assets: DataFrame, tile_years: DataFrame, side: Column, tile_side: int) -> DataFrame:
    """By source: raw and estimated bytes, range requests, tile-years and the bytes of whole tiles, which no read exceeds.

    As volume_estimate(), with assets also of (block_w, block_h) and tile_years of (source_id, tx, ty, item_year). A request reads
    one block of one asset; where a source with epochs has no block size, its requests are not known: null.
    """
    px = footprints.select("footprint_id", side.alias("side"))
    rows = epochs.join(px, "footprint_id").join(F.broadcast(assets), "source_id")  # assets: one row a source
    size, n = F.coalesce("sample_bytes", F.lit(ASSUMED_BYTES)), F.col("n_years") * F.col("n_assets")
    blocks = F.ceil(F.col("side") / F.col("block_w")) * F.ceil(F.col("side") / F.col("block_h"))
    read = rows.groupBy("source_id").agg(F.sum(F.col("side") * F.col("side") * n * size).alias("raw_bytes"), F.when(F.count_if((F.col("n_years") > 0) & (blocks * n).isNull()) == 0, F.coalesce(F.sum(blocks * n), F.lit(0))).alias("requests"))
    tiles = tile_years.select("source_id", "tx", "ty", "item_year").distinct().groupBy("source_id").agg(F.count("*").alias("n_tile_years"))
    out = assets.select("source_id", "n_assets", size.alias("_size")).join(read, "source_id", "left").join(tiles, "source_id", "left")
    raw, years = F.coalesce("raw_bytes", F.lit(0)), F.coalesce("n_tile_years", F.lit(0))
    requests = F.when(F.col("raw_bytes").isNull(), F.lit(0)).otherwise(F.col("requests"))
    return out.select("source_id", raw.alias("raw_bytes"), F.floor(raw * F.lit(COMPRESSION)).cast("long").alias("estimated_bytes"), requests.cast("long").alias("requests"), years.alias("n_tile_years"), (years * tile_side * tile_side * F.col("n_assets") * F.col("_size")).alias("upper_bound_bytes"))


def volume_totals(bounds: DataFrame) -> DataFrame:
    """One row over all sources: the raw bytes compressed once, not the sum of what was cut off by source; requests null if those of any source are."""
    requests = F.when(F.count_if(F.col("requests").isNull()) == 0, F.sum("requests"))
    return bounds.agg(F.floor(F.sum("raw_bytes") * F.lit(COMPRESSION)).cast("long").alias("estimated_bytes"), requests.alias("requests"), F.sum("upper_bound_bytes").alias("upper_bound_bytes"))


def tile_sets(footprint_tiles: DataFrame) -> DataFrame:
    """(footprint_id, tiles): the sorted distinct tiles that each footprint touches. Footprints of the same tiles have the same items."""
    return footprint_tiles.groupBy("footprint_id").agg(F.sort_array(F.collect_set(F.struct("tx", "ty"))).alias("tiles"))


def _items_of_sets(sets: DataFrame, items: DataFrame) -> DataFrame:
    """(tiles, tx, ty, source_id, item_year): the distinct items of each distinct set of tiles."""
    each = sets.select("tiles").distinct().select("tiles", F.explode("tiles").alias("t")).select("tiles", "t.tx", "t.ty")
    return each.join(items.select("source_id", "tx", "ty", "item_year").distinct(), ["tx", "ty"])


def footprint_epochs(footprint_tiles: DataFrame, items: DataFrame) -> DataFrame:
    """(footprint_id, source_id, n_years): the distinct years of each source's items on any tile that the footprint touches."""
    sets = tile_sets(footprint_tiles)
    years = _items_of_sets(sets, items).groupBy("tiles", "source_id").agg(F.count_distinct("item_year").alias("n_years"))
    per = years.groupBy("tiles").agg(F.collect_list(F.struct("source_id", "n_years")).alias("e"))  # a row for each source
    return sets.join(per, "tiles").select("footprint_id", F.inline("e"))


def touched_items(footprint_tiles: DataFrame, items: DataFrame) -> DataFrame:
    """(source_id, tx, ty, item_year): distinct tile-years on the tiles that any footprint touches."""
    return items.select("source_id", "tx", "ty", "item_year").distinct().join(footprint_tiles.select("tx", "ty").distinct(), ["tx", "ty"], "left_semi")


def epoch_covered_years(footprint_tiles: DataFrame, items: DataFrame) -> DataFrame:
    """(footprint_id, item_year): years in which some source has an item on every tile that the footprint touches."""
    sets = tile_sets(footprint_tiles)
    have = _items_of_sets(sets, items).groupBy("tiles", "source_id", "item_year").agg(F.count("*").alias("n")).filter("n = size(tiles)")
    per = have.groupBy("tiles").agg(F.collect_set("item_year").alias("years"))  # no more than there are years
    return sets.join(per, "tiles").select("footprint_id", F.explode("years").alias("item_year"))


def coverage_rates(covered: DataFrame) -> DataFrame:
    """Share of covered footprints by year, split by one or several tiles and in all, of rows (item_year, several, covered)."""
    g = covered.groupingSets([[F.col("item_year"), F.col("several")], [F.col("item_year")]], "item_year", "several").agg(F.count("*").alias("n"), F.avg(F.col("covered").cast("int")).alias("rate"), F.grouping("several").alias("g"))
    return g.select("item_year", F.when(F.col("g") == 1, "all").when(F.col("several"), "several").otherwise("one").alias("tiles"), "n", "rate")
