"""Refusals as data: checks return rows (check, n, examples); enforce() turns them into an error."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .lineage import cut

EXAMPLES = 5


class Refused(ValueError):
    """A contract that does not hold, with its checks and examples."""


def examples(values: Column, n: int = EXAMPLES) -> Column:
    """The first n of a group's distinct values, sorted, joined: an aggregate."""
    return F.array_join(F.slice(F.array_sort(F.collect_set(values.cast("string"))), 1, n), ",")


def violations(df: DataFrame, checks: dict[str, Column], example: Column | None = None) -> DataFrame:
    """(check, n, examples): rows for which each condition holds, all counted in one pass.

    Examples are the least and greatest value, so no group is collected.
    """
    shown = (example if example is not None else F.lit(None)).cast("string")
    cells = []
    for k, (name, bad) in enumerate(checks.items()):
        hit = F.coalesce(bad, F.lit(False))
        cells.append(F.struct(F.lit(name).alias("check"), F.count_if(hit).alias("n"), F.concat_ws(",", F.min(F.when(hit, shown)), F.max(F.when(hit, shown))).alias("examples")).alias(f"c{k}"))
    one = df.agg(*cells)
    return one.select(F.explode(F.array(*[f"c{k}" for k in range(len(checks))])).alias("c")).select("c.*")


def duplicates(df: DataFrame, keys: list[str], name: str = "duplicate_key") -> DataFrame:
    """(check, n, examples): number of keys with several rows."""
    key = F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys])
    return df.groupBy(*keys).count().filter("count > 1").agg(F.lit(name).alias("check"), F.count("*").alias("n"), F.concat_ws(",", F.min(key), F.max(key)).alias("examples"))


def together(*frames: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def enforce(checks: DataFrame) -> None:
    """One action; raises Refused if any check counts something. The report has a row per check, so it is small."""
    bad = checks.filter("n > 0").orderBy("check").collect()
    if bad:
        raise Refused("; ".join(f"{r['check']}: {r['n']} ({r['examples']})" for r in bad))


def column_gap(df: DataFrame, names: list[str]) -> tuple[list[str], list[str]]:
    """Missing and extra columns."""
    return sorted(set(names) - set(df.columns)), sorted(set(df.columns) - set(names))


def domain_diff(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """(side, n, first, last): keys of one side that the other lacks; nulls equal nulls."""
    key = F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys])

    def only(x: DataFrame, y: DataFrame, side: str) -> DataFrame:
        rest = x.select(*keys).subtract(y.select(*keys))
        return rest.agg(F.lit(side).alias("side"), F.count("*").alias("n"), F.min(key).alias("first"), F.max(key).alias("last"))

    return only(a, b, "only_left").unionByName(only(b, a, "only_right"))


def multiset_diff(a: DataFrame, b: DataFrame) -> DataFrame:
    """(side, n, columns...): rows that one side has more often than the other, with how often more."""
    left, right = a.exceptAll(b), b.exceptAll(a)
    return left.withColumn("side", F.lit("only_left")).unionByName(right.withColumn("side", F.lit("only_right"))).groupBy("side", *a.columns).agg(F.count("*").alias("n"))


def single_value(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Keys with the one value they have, and how many distinct values there are: over one is a violation."""
    return df.groupBy(*keys).agg(F.count_distinct(value).alias("n_values"), F.min(value).alias(value))


def keep_first(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key in a data order, nulls last; rows that tie are told apart by all their values.

    An aggregate, so a key with very many rows is reduced where its rows are.
    """
    whole = F.struct(*df.columns)
    row = F.min_by(whole, F.struct(*[c for name in order for c in (F.col(name).isNull(), F.col(name))], whole)).alias("_row")
    return df.groupBy(*[F.col(k).alias(f"_key_{k}") for k in keys]).agg(row).select("_row.*")


def counts_with_total(df: DataFrame, column: Column, domain: tuple[str, ...]) -> DataFrame:
    """(name, n): a row for each value of a fixed domain, zero included, and the total."""
    counted = df.groupBy(column.alias("name")).agg(F.count("*").alias("n"))
    names = df.sparkSession.createDataFrame([(d,) for d in domain], "name string")
    rows = F.broadcast(names).join(counted, "name", "left").select("name", F.coalesce("n", F.lit(0)).cast("long").alias("n"))
    return rows.unionByName(counted.agg(F.lit("total").alias("name"), F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("n")))


def tri_state_counts(df: DataFrame, value: str) -> DataFrame:
    """Computed, zero among these, and not computed."""
    return df.agg(F.count(value).alias("computed"), F.count_if(F.col(value) == 0).alias("zero"), F.count_if(F.col(value).isNull()).alias("not_computed"))


def numbered(ordered: DataFrame, name: str) -> DataFrame:
    """``ordered`` (an orderBy result) with a long column of places from 0, by partition counts: no window over all rows.

    The rows are kept by cut(), as a sort that is made anew for the counts draws another sample and so may part the rows elsewhere.
    """
    rows, before = _in_parts(ordered, F.count("*"))
    return rows.join(F.broadcast(before), "_part").withColumn(name, F.col("_before") + F.col("_at") - F.shiftleft("_part", 33)).drop("_at", "_part", "_before")


def summed_before(ordered: DataFrame, n: str, name: str) -> DataFrame:
    """``ordered`` (an orderBy result) with a long column of what column ``n`` sums up to over the rows before, by partition sums and within partitions."""
    rows, before = _in_parts(ordered, F.sum(n))
    own = F.sum(n).over(Window.partitionBy("_part").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1))
    summed = rows.withColumn("_own", F.coalesce(own, F.lit(0)))
    return summed.join(F.broadcast(before), "_part").withColumn(name, F.col("_before") + F.col("_own")).drop("_at", "_part", "_own", "_before")


def _in_parts(ordered: DataFrame, total: Column) -> tuple[DataFrame, DataFrame]:
    """The rows, kept, with _part and their order _at, and (_part, _before): the total over the partitions before each."""
    rows = cut(ordered.withColumn("_at", F.monotonically_increasing_id())).withColumn("_part", F.shiftright("_at", 33))
    per = rows.groupBy("_part").agg(total.alias("_n"))
    before = per.alias("b").join(per.alias("a"), F.col("a._part") < F.col("b._part"), "left").groupBy("b._part").agg(F.coalesce(F.sum("a._n"), F.lit(0)).alias("_before"))  # a row for each partition
    return rows, before
