"""Places in an order, by the partitions of one sort."""

from pyspark.sql import functions as F

from lodestrata.operators import contracts as C


def test_places_come_from_one_sort(spark, monkeypatch):
    """Counts and rows must come from the same partitions: the sort is kept, and both read what was kept."""
    kept, cut = [], C.cut
    monkeypatch.setattr(C, "cut", lambda df: kept.append(df) or cut(df))
    got = C.numbered(spark.range(5000).select((F.col("id") * 7919 % 5000).alias("v")).orderBy("v"), "place")
    assert len(kept) == 1 and got.filter("v <> place").count() == 0 and got.count() == 5000
