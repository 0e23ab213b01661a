"""Exact quantiles of groups that need not fit one buffer.

A sketch of fixed size gives each group two values that hold the wanted rank between them; what lies below
them is counted and what lies between, a share of MARGIN of the group, is counted by distinct value. Both come
from one aggregation that combines before it shuffles. A running sum over those few values picks the
rank exactly; if a sketch ever missed it, the query fails instead of giving another value.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: The sketch's rank error is at most 1 / ACCURACY of a group; bounds are taken so far to either side of the rank.
ACCURACY, MARGIN = 10_000, 3e-4


def exact_quantiles(df: DataFrame, keys: list[str], value: str, wanted: dict[str, float]) -> DataFrame:
    """keys and, for each name, the linearly interpolated quantile of the group's finite values; groups without any are absent."""
    v = F.col(value).cast("double")
    rows = df.select(*keys, v.alias("_v")).filter(v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    names = list(wanted)
    edges = [min(max(q + side * MARGIN, 0.0), 1.0) for q in wanted.values() for side in (-1, 1)]
    sketch = rows.groupBy(*keys).agg(F.count("*").alias("_n"), F.min("_v").alias("_least"), F.max("_v").alias("_most"), F.percentile_approx("_v", edges, ACCURACY).alias("_edges"))
    # a group in which the margin is less than a few ranks is small, and all of it lies between
    few = F.col("_n") * MARGIN < 4
    edge = lambda k, end, last: F.col(end) if edges[k] == last else F.when(few, F.col(end)).otherwise(F.col("_edges")[k])
    parts = [F.struct(F.lit(i).alias("i"), edge(2 * i, "_least", 0.0).alias("lo"), edge(2 * i + 1, "_most", 1.0).alias("hi"), ((F.col("_n") - 1) * F.lit(q)).alias("at")) for i, q in enumerate(wanted.values())]
    bounds = sketch.select(*[F.col(k).alias(f"_k{j}") for j, k in enumerate(keys)], "_n", F.explode(F.array(*parts)).alias("_q"))
    same = [F.col(k).eqNullSafe(F.col(f"_k{j}")) for j, k in enumerate(keys)]
    below = F.col("_v") <= F.col("_q.hi")
    held = rows.join(bounds, [*same, below]) if keys else rows.join(F.broadcast(bounds), below)  # without keys the bounds are one row a quantile
    counted = held.groupBy(*keys, "_n", "_q", F.when(F.col("_v") >= F.col("_q.lo"), F.col("_v")).alias("_w")).agg(F.count("*").alias("_c"))
    order = Window.partitionBy(*keys, F.col("_q.i")).orderBy(F.col("_w").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    running = counted.withColumn("_upto", F.sum("_c").over(order))
    base = F.floor("_q.at")
    pick = lambda rank: F.min(F.when(F.col("_upto") > rank, F.struct("_upto", F.col("_w").alias("w"))))["w"]
    picked = running.groupBy(*keys, "_q", "_n").agg(pick(base).alias("_a"), pick(F.least(base + 1, F.col("_n") - 1)).alias("_b"))
    sure = F.when(F.col("_a").isNull() | F.col("_b").isNull(), F.raise_error(F.lit("a sketch missed the rank"))).otherwise(F.col("_a") + (F.col("_q.at") - base) * (F.col("_b") - F.col("_a")))
    return picked.select(*keys, "_q", sure.alias("_x")).groupBy(*keys).agg(*[F.max(F.when(F.col("_q.i") == i, F.col("_x"))).alias(name) for i, name in enumerate(names)])
