"""Incremental operators as Structured Streaming: a replay gives what a batch gives."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .ledger import Deliveries


def stream_item_index(stream: DataFrame, keys: list[str], path: str, checkpoint: str) -> DataFrame:
    """First-seen items of a stream by key, written once each; runs until what is there now is read."""
    query = stream.dropDuplicates(keys).writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()
    return stream.sparkSession.read.parquet(path)


def _read_all(stream: DataFrame, put, checkpoint: str) -> None:
    stream.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


#: Folders over which the items of one source are dealt.
SHELVES = 64


def index_items(stream: DataFrame, source: str, item: str, root: str, checkpoint: str, delivery: str) -> Deliveries:
    """Keeps the first of each (source, item) of a stream, and counts by batch and source what arrived, was kept and was refused.

    The items that are known are the index itself, not state in memory: a batch is compared with those shelves of it
    (source, hash of the item) that hold items of the batch. An item without a source or id is refused.
    """
    kept = stream.select(source, item, F.lit(0).alias("shelf")).schema
    known = Deliveries(stream.sparkSession, root, kept, [source, "shelf"], [source], ("arrived", "kept", "refused"))
    if not known.begin(delivery):
        return known

    def put(batch: DataFrame, number: int) -> None:
        batch = batch.select(source, item, F.pmod(F.xxhash64(item), F.lit(SHELVES)).cast("int").alias("shelf")).persist()
        try:
            whole = batch.filter(F.col(source).isNotNull() & F.col(item).isNotNull()).distinct()
            earlier = known.own(delivery).filter(F.col("batch") != number).select(source, item, "shelf").unionByName(known.rows().select(source, item, "shelf"))
            shelves = F.broadcast(whole.select(source, "shelf").distinct())  # no more than sources x SHELVES
            fresh = whole.join(earlier.join(shelves, [source, "shelf"], "left_semi"), [source, "shelf", item], "left_anti").persist()
            arrived = batch.groupBy(source).agg(F.count("*").alias("arrived"))
            counts = arrived.join(fresh.groupBy(source).agg(F.count("*").alias("kept")), source, "left").withColumn("kept", F.coalesce("kept", F.lit(0)))
            known.commit(fresh, counts.withColumn("refused", F.col("arrived") - F.col("kept")), delivery, number)
            fresh.unpersist()
        finally:
            batch.unpersist()

    _read_all(stream, put, checkpoint)
    known.close(delivery)
    return known


def stream_trajectories(stream: DataFrame, expected: DataFrame, root: str, checkpoint: str, keys: tuple[str, ...] = ("collection_id", "year"), delivery: str = "first") -> Deliveries:
    """Appends the partitions of a delivery that no closed delivery has, whatever the micro-batches they come in.

    A partition belongs to the delivery that brings it first and takes all of that delivery's rows; it is closed, and
    read, when the delivery is. In a later delivery it is left alone, so a replay changes nothing. Rows of a partition that
    nobody expects stop the stream before any of their batch is written; what the delivery wrote until then stays open.
    """
    spark: SparkSession = stream.sparkSession
    parts = Deliveries(spark, root, stream.schema, list(keys))
    if not parts.begin(delivery):
        return parts
    cols = list(keys)
    wanted = expected.select(*cols).distinct()

    def put(batch: DataFrame, number: int) -> None:
        batch = batch.persist()
        try:
            stray = batch.select(*cols).distinct().join(wanted, cols, "left_anti").limit(5).collect()
            if stray:
                raise ValueError(f"partitions that nobody expects: {[tuple(r) for r in stray]}")
            taken = parts.entries().join(parts.closed(), "delivery").select(*cols).distinct()
            new = batch.join(taken, cols, "left_anti")
            parts.commit(new, new.groupBy(*cols).agg(F.count("*").alias("rows")), delivery, number)
        finally:
            batch.unpersist()

    _read_all(stream, put, checkpoint)
    parts.close(delivery)
    return parts
