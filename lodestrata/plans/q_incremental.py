"""Streaming queries over the given tables' files; results must equal the batch ones."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import functions as F

from ..streaming import incremental as I
from .fixtures import with_views
from .registry import query


def shared_folder(spark) -> str:
    """A new folder under the one that the cluster shares; a temporary one in a local session only."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not named and not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    named = named or tempfile.mkdtemp(prefix="spark-stream-")
    return f"{named.rstrip('/')}/stream-{uuid.uuid4().hex}"


def _orders(spark, sf):
    path = f"{sf}/orders.parquet"
    schema = spark.read.parquet(path).schema
    o = spark.readStream.schema(schema).parquet(path) if _is_folder(spark, path) else spark.readStream.schema(schema).option("pathGlobFilter", "orders.parquet").parquet(sf)
    source = F.when(F.col("o_custkey") % 4 == 0, "fc").when(F.col("o_custkey") % 4 == 1, "gm5").when(F.col("o_custkey") % 4 == 2, "gm7").otherwise("gm8")
    return o.select(source.alias("collection_id"), F.year("o_orderdate").alias("year"), F.col("o_orderkey").alias("item_no"))


def _is_folder(spark, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(p).isDirectory()


@query("x1_stream_item_index", f"{with_views('catalogue')} SELECT DISTINCT source_id, item_no AS item_id FROM catalogue")
def stream_item_index(spark, sf):
    root = shared_folder(spark)
    items = _orders(spark, sf).select(F.col("collection_id").alias("source_id"), F.col("item_no").alias("item_id"))
    items = items.unionByName(items)  # every item comes twice
    return I.stream_item_index(items, ["source_id", "item_id"], f"{root}/index", f"{root}/checkpoint")


def _in_files(spark, sf, root: str, files: int):
    """The orders as a stream of one file at a time; the files are dealt out, so a partition's rows come in several micro-batches."""
    path = f"{root}/arrived"
    orders = spark.read.parquet(f"{sf}/orders.parquet").select("o_orderkey", "o_custkey", "o_orderdate")
    orders.repartition(files).write.parquet(path)
    source = F.when(F.col("o_custkey") % 4 == 0, "fc").when(F.col("o_custkey") % 4 == 1, "gm5").when(F.col("o_custkey") % 4 == 2, "gm7").otherwise("gm8")
    stream = spark.readStream.schema(orders.schema).option("maxFilesPerTrigger", 1).parquet(path)
    return stream.select(source.alias("collection_id"), F.year("o_orderdate").alias("year"), F.col("o_orderkey").alias("item_no"))


@query("x2_s09_stream_trajectories", f"{with_views('catalogue')} SELECT source_id AS collection_id, item_year AS year, count(*) AS rows, 0 AS part_version FROM catalogue GROUP BY 1, 2")
def stream_trajectories(spark, sf):
    root = shared_folder(spark)
    expected = spark.read.parquet(f"{sf}/orders.parquet").select(F.explode(F.array(*map(F.lit, ("fc", "gm5", "gm7", "gm8")))).alias("collection_id"), F.year("o_orderdate").alias("year")).distinct()
    for delivery in ("a", "b"):  # the second delivery must change nothing
        parts = I.stream_trajectories(_in_files(spark, sf, f"{root}/{delivery}", 3), expected, f"{root}/parts", f"{root}/checkpoint-{delivery}", delivery=delivery)
    return parts.rows().groupBy("collection_id", "year").agg(F.count("*").alias("rows"), F.max("part_version").cast("int").alias("part_version"))


@query(
    "x1_refused_items",
    f"{with_views('catalogue')}, twice AS (SELECT source_id, item_no FROM catalogue UNION ALL SELECT source_id, item_no FROM catalogue WHERE item_no % 3 = 0) SELECT source_id, count(*) AS arrived, count(DISTINCT item_no) AS kept, count(*) - count(DISTINCT item_no) AS refused FROM twice GROUP BY 1",
)
def refused_items(spark, sf):
    root = shared_folder(spark)
    for delivery, again in (("a", "item_no % 3 <> 0 AND item_no % 2 = 0"), ("b", "item_no % 2 = 1 OR item_no % 3 = 0"), ("c", "item_no % 3 = 0")):
        items = _in_files(spark, sf, f"{root}/{delivery}", 2).filter(again).select(F.col("collection_id").alias("source_id"), F.col("item_no").alias("item_id"))
        known = I.index_items(items, "source_id", "item_id", f"{root}/index", f"{root}/checkpoint-{delivery}", delivery)
    return known.entries().groupBy("source_id").agg(*[F.sum(c).alias(c) for c in ("arrived", "kept", "refused")])
