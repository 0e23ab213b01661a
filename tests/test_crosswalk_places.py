"""Places of the crosswalk's rows, without a sort of the rows."""

import duckdb
import pytest
from pyspark.sql import functions as F

from lodestrata.operators import contracts as C
from lodestrata.operators import spatial as X
from lodestrata.plans import registry

QUERY = "t1_ordered_crosswalk"


@pytest.fixture
def crowded(spark, tmp_path):
    """Orders and parts whose keys give the same places and boxes over and over, so that rows are many times the sites."""
    order, part = (F.col("id") % 40 + F.floor(F.col("id") / 40) * 100_000 for _ in range(2))
    spark.range(40 * 12).select(order.alias("o_orderkey"), F.lit("1-URGENT").alias("o_orderpriority"), F.lit("F").alias("o_orderstatus"), F.col("id").alias("o_custkey")).write.parquet(f"{tmp_path}/orders.parquet")
    spark.range(40 * 15).select(part.alias("p_partkey"), (F.col("id") % 50 + 1).cast("int").alias("p_size")).write.parquet(f"{tmp_path}/part.parquet")
    return str(tmp_path)


def test_only_sites_are_kept_and_numbered(spark, crowded, monkeypatch):
    """Sites and matches of places are kept; rows, which grow with sites x footprints, are not."""
    kept = []
    for module in (C, X):
        cut = module.cut
        monkeypatch.setattr(module, "cut", lambda df, cut=cut: kept.append(cut(df)) or kept[-1])
    rows = registry.QUERIES[QUERY](spark, crowded)
    got = sorted((r.place, r.site_id, r.footprint_id) for r in rows.collect())
    con = duckdb.connect()
    for t in ("orders", "part"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{crowded}/{t}.parquet/*.parquet'")
    want = con.execute(f"SELECT place, site_id, footprint_id FROM ({registry.ORACLES[QUERY]}) ORDER BY place").fetchall()
    sites = len({s for _, s, _ in got})
    assert got == want and len(got) > 3 * sites and any(f is None for _, _, f in got)
    assert max(df.count() for df in kept) <= sites


def test_sums_of_the_rows_before(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("v")).repartition(5)
    rows = C.summed_before(df.withColumn("n", F.col("v") % 4).orderBy("v"), "n", "before").collect()
    assert sorted((r.v, r.before) for r in rows) == [(v, sum(i % 4 for i in range(v))) for v in range(1000)]
    assert C.summed_before(df.filter("v < 0").withColumn("n", F.lit(1)).orderBy("v"), "n", "before").collect() == []
