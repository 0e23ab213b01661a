"""Source and sink queries: each writes files made from a given table and scans them back."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from ..functions import geometry as G
from ..sources import tables as S
from .fixtures import compound_polygons, view, with_views
from .q_catalogue import nested_items
from .q_incremental import shared_folder
from .registry import query


@query("s01_coded_csv", "SELECT lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS code, concat('a \"b\", ', c_name) AS name, CASE WHEN c_custkey % 7 <> 0 THEN round(CAST(c_acctbal AS DOUBLE), 2) END AS balance FROM customer")
def coded_csv(spark, sf):
    path = f"{shared_folder(spark)}/customers.csv"
    c = spark.read.parquet(f"{sf}/customer.parquet")
    balance = F.when(F.col("c_custkey") % 7 == 0, "unknown").otherwise(F.round(F.col("c_acctbal").cast("double"), 2).cast("string"))
    code = F.lpad(F.col("c_custkey").cast("string"), 8, "0")
    c.select(code.alias("\ufeffcode"), F.concat(F.lit('a "b", '), "c_name").alias("name"), balance.alias("balance")).write.option("header", True).option("escape", '"').csv(path)
    return S.scan_coded_csv(spark, path, ["code"], {"balance": "double"})


_BOXES = "cx - hx AS minx, cy - hy AS miny, CASE kind WHEN 'frame' THEN cx + hx ELSE cx + 2.5 * hx END AS maxx, CASE kind WHEN 'frame' THEN cy + hy ELSE cy + 2.5 * hy END AS maxy"


@query("s02_features", f"{with_views('compounds')} SELECT compound_id, 2 AS n_rings, round(CASE kind WHEN 'frame' THEN 3 * hx * hy ELSE 5 * hx * hy END, 4) AS area, {_BOXES} FROM compounds")
def features(spark, sf):
    path = f"{shared_folder(spark)}/layer.geojsonl"
    points = lambda ring: F.transform(ring, lambda p: F.array(p["x"], p["y"]))
    rings = F.transform("rings", points)
    shape = lambda kind, at: F.to_json(F.struct(F.struct("compound_id").alias("properties"), F.struct(F.lit(kind).alias("type"), at.alias("coordinates")).alias("geometry")))
    line = F.when(F.col("kind") == "frame", shape("Polygon", rings)).otherwise(shape("MultiPolygon", F.transform(rings, lambda r: F.array(r))))
    compound_polygons(spark, sf).select(line.alias("value")).write.text(path)
    return S.scan_features(spark, path, "compound_id", "EPSG:3577").select("compound_id", F.size("rings").alias("n_rings"), F.round(G.area(F.col("rings")), 4).alias("area"), "minx", "miny", "maxx", "maxy")


@query("s03_catalogue_pages", f"{with_views('catalogue')} SELECT source_id, concat('i', item_no) AS id, CASE WHEN item_no % 2 = 0 THEN 2 ELSE 1 END AS n_assets, CAST(tx * 10000 AS DOUBLE) AS minx, concat(item_year, '-01-01T00:00:00Z') AS datetime FROM catalogue")
def catalogue_pages(spark, sf):
    root = f"{shared_folder(spark)}/pages"
    page = F.floor(F.substring("id", 2, 20).cast("long") / 100)  # a page has as many items as a catalogue sends at once
    pages = nested_items(spark, sf).groupBy("source_id", page.alias("page")).agg(F.to_json(F.struct(F.collect_list(F.struct("id", "bbox", "properties", "assets")).alias("features"))).alias("value"))
    pages.select("value", "source_id").write.option("lineSep", "\n").partitionBy("source_id").text(root)
    # a folder is named source_id=x where a capture's is named x
    got = S.scan_catalogue_pages(spark, f"{root}/*", one_line=True).withColumn("source_id", F.regexp_replace("source_id", "^source_id=", ""))
    return got.select("source_id", "id", F.size("assets").alias("n_assets"), F.get("bbox", F.lit(0)).alias("minx"), "properties.datetime")


_DECLARED = StructType([StructField("row_no", LongType(), False), StructField("site_id", StringType()), StructField("x", DoubleType()), StructField("y", DoubleType())])


@query("s07_declared_table", f"{with_views('sites')} SELECT row_no, site_id, x, y FROM sites")
def declared_table(spark, sf):
    root = f"{shared_folder(spark)}/published"
    sites = view(spark, sf, "sites").select("y", "x", "site_id", F.col("row_no").cast("string").alias("row_no"))
    S.publish(spark, {"sites": (sites, _DECLARED)}, root)
    return spark.read.parquet(f"{root}/sites")


@query("s13_file_digests", "SELECT count(DISTINCT l_linenumber) - 2 AS n_ok, 1 AS n_bad, 1 AS n_missing FROM lineitem")
def file_digests(spark, sf):
    """A file for each line number; of the recorded digests one is wrong, and one is of a file that is not there."""
    root = f"{shared_folder(spark)}/files"
    lines = spark.read.parquet(f"{sf}/lineitem.parquet").select(F.col("l_linenumber").alias("k"), F.col("l_orderkey").cast("string").alias("value"))
    lines.repartition("k").sortWithinPartitions("k", "value").write.partitionBy("k").text(root)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    name, k = F.regexp_extract("path", r"([^/]+)$", 1), F.regexp_extract("path", r"/k=(\d+)/", 1)
    return S.verify_file_digests(spark, root, files.select(F.when(k == "2", "gone").otherwise(F.concat_ws("/", F.concat(F.lit("k="), k), name)).alias("name"), F.when(k == "1", "0").otherwise(F.sha2("content", 256)).alias("sha256")), depth=2)
