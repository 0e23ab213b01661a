"""Deliveries: rows that arrive in micro-batches, committed once each and seen when their delivery is closed.

A root folder holds ``data`` (rows, by delivery, batch and keys), ``ledger`` (what each batch put there) and
``closed`` (deliveries that are whole). A batch first overwrites its own folder of ``data``, then writes its
entry; both depend on (delivery, batch) alone, so a batch that comes again, or that failed half-way, leaves what one
run of it leaves. Rows without an entry, and those of a delivery that is not closed, are not read. Entries have a row
for each partition or source of the batch, of which there are few.

One delivery writes at a time: while one is open, another is refused; it is resumed under its name, or abandoned.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ..operators.contracts import Refused

_OWN = [StructField("delivery", StringType()), StructField("batch", LongType())]


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


class Deliveries:
    """The deliveries under ``root``; ``schema`` is that of the rows, ``keys`` those of their columns that part them, ``counts`` the numbers of a ledger entry."""

    def __init__(self, spark: SparkSession, root: str, schema: StructType, keys: list[str], entry_keys: list[str] | None = None, counts: tuple[str, ...] = ("rows",)):
        self.spark, self.root, self.schema, self.keys, self.counts = spark, root.rstrip("/"), schema, list(keys), counts
        self.entry_keys = self.keys if entry_keys is None else entry_keys

    def _read(self, folder: str, fields: list[StructField]) -> DataFrame:
        schema, path = StructType([*fields, *_OWN]), f"{self.root}/{folder}"
        return self.spark.read.schema(schema).parquet(path) if _exists(self.spark, path) else self.spark.createDataFrame([], schema)

    def closed(self) -> DataFrame:
        """delivery, version: deliveries that are whole, numbered in the order in which they began."""
        return self._read("closed", [StructField("version", LongType())]).select("delivery", "version")

    def entries(self) -> DataFrame:
        """delivery, batch, entry keys and counts of every committed batch."""
        return self._read("ledger", [*(self.schema[k] for k in self.entry_keys), *(StructField(c, LongType()) for c in self.counts)])

    def rows(self) -> DataFrame:
        """The rows of closed deliveries with part_version, the number of theirs."""
        whole = self.entries().select("delivery", "batch").distinct().join(self.closed(), "delivery")
        return self._read("data", list(self.schema.fields)).join(F.broadcast(whole), ["delivery", "batch"]).select(*self.schema.names, F.col("version").alias("part_version"))

    def own(self, delivery: str) -> DataFrame:
        """The rows that an open delivery has committed so far, with their batch."""
        batches = self.entries().filter(F.col("delivery") == delivery).select("delivery", "batch").distinct()
        return self._read("data", list(self.schema.fields)).join(F.broadcast(batches), ["delivery", "batch"])

    def begin(self, delivery: str) -> bool:
        """Whether the delivery is to be read: it is new, or was begun and not closed. Refused while another one is open."""
        if not re.match(r"[A-Za-z0-9_.-]+\Z", delivery):
            raise Refused(f"a delivery's name is letters, digits and _.-, not {delivery!r}")
        whole = {r["delivery"] for r in self.closed().collect()}  # one row a delivery
        open_ = {r["delivery"] for r in self.entries().select("delivery").distinct().collect()} - whole - {delivery}
        if open_:
            raise Refused(f"deliveries that are not closed: {sorted(open_)}")
        return delivery not in whole

    def commit(self, rows: DataFrame, counts: DataFrame, delivery: str, batch: int) -> None:
        """Puts a batch's rows in place, then its entry; a batch without an entry's rows leaves none."""
        place = f"delivery={delivery}/batch={batch}"
        rows.select(*self.schema.names).repartition(*self.keys).write.mode("overwrite").partitionBy(*self.keys).parquet(f"{self.root}/data/{place}")
        counts.select(*self.entry_keys, *[F.col(c).cast("long").alias(c) for c in self.counts]).coalesce(1).write.mode("overwrite").parquet(f"{self.root}/ledger/{place}")

    def close(self, delivery: str) -> None:
        number = self.closed().agg(F.coalesce(F.max("version") + 1, F.lit(0)).cast("long").alias("version"))
        number.coalesce(1).write.mode("overwrite").parquet(f"{self.root}/closed/delivery={delivery}/batch=0")

    def abandon(self, delivery: str) -> None:
        """Forgets an open delivery: its entries go first, then its rows."""
        if self.closed().filter(F.col("delivery") == delivery).head(1):
            raise Refused(f"{delivery} is closed")
        jvm = self.spark.sparkContext._jvm
        for folder in ("ledger", "data"):
            path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{folder}/delivery={delivery}")
            path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
