"""Deterministic resampling of pixels at reduced sizes, and rank statistics.

A group is the pixels of one site and year. Samples of all replicates come from rows that are shuffled once,
by group: each task keeps, for every replicate, the members of least hash, as many as the largest size.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .lineage import cut

#: Members of a group whose hashes are held at once.
CHUNK = 4096


def hash_rank(df: DataFrame, keys: list[str], seed: str, replicate: Column, member: Column, name: str = "rank") -> DataFrame:
    """Adds the 1-based rank of each member by the SHA-256 of seed|replicate|member: one order for all sizes, whatever the row order."""
    code = F.unhex(F.sha2(F.concat_ws("|", F.lit(seed), replicate.cast("string"), member), 256))  # half as long as its text, in the same order
    w = Window.partitionBy(*keys).orderBy("_code", member)
    return df.withColumn("_code", code).withColumn(name, F.row_number().over(w)).drop("_code")


def sample_support(ranked: DataFrame, n: int) -> DataFrame:
    """The first n members of each group: samples of different sizes nest."""
    return ranked.filter(F.col("rank") <= n)


def average_rank(keys: list[str], value: str) -> Column:
    """1-based rank within the group; ties share the mean of their ranks. Both windows are along one order, so rows are sorted once."""
    w = Window.partitionBy(*keys).orderBy(value)
    return F.rank().over(w) + (F.count("*").over(w.rangeBetween(Window.currentRow, Window.currentRow)) - 1) / 2.0


def spread_ranks(df: DataFrame, keys: list[str], value: str, name: str = "rank") -> DataFrame:
    """Adds average_rank() for groups that are too large for one sort; ``value`` is not null.

    Distinct values are counted, and the counts dealt out in ranges of (keys, value). A value's rank follows from the counts
    before it within its range, and from the sums of the ranges before, of which there is one row for each key and range.
    """
    counts = df.groupBy(*keys, value).agg(F.count("*").alias("_n"))
    dealt = cut(counts.repartitionByRange(*keys, value).withColumn("_part", F.spark_partition_id()))
    within = Window.partitionBy(*keys, "_part").orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sums = dealt.groupBy(*keys, "_part").agg(F.sum("_n").alias("_sum")).withColumn("_base", F.coalesce(F.sum("_sum").over(before), F.lit(0)))
    at = [*keys, "_part"]
    placed = dealt.withColumn("_upto", F.sum("_n").over(within)).alias("d").join(sums.alias("s"), [F.col(f"d.{k}").eqNullSafe(F.col(f"s.{k}")) for k in at])
    ranks = placed.select(*[F.col(f"d.{k}").alias(k) for k in (*keys, value)], (F.col("_base") + F.col("_upto") - (F.col("_n") - 1) / 2.0).alias(name))
    return df.alias("l").join(ranks.alias("r"), [F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in (*keys, value)]).select("l.*", f"r.{name}")


class LeastHashes:
    """For every replicate the ``most`` members of least SHA-256 of seed|replicate|member, in that order; members come in any order and number."""

    def __init__(self, seed: str, replicates: int, most: int):
        self.prefixes, self.most = [f"{seed}|{r}|".encode() for r in range(replicates)], most
        self.codes, self.values = np.zeros((replicates, 0, 4), np.uint64), np.zeros((replicates, 0))
        self.waiting: list[bytes] = []
        self.numbers: list[float] = []
        self.n, self.total = 0, 0.0

    def add(self, members: list[str], values: list[float]) -> None:
        for at in range(0, len(members), CHUNK):
            self.waiting += [m.encode() for m in members[at : at + CHUNK]]
            self.numbers += values[at : at + CHUNK]
            if len(self.waiting) >= CHUNK:
                self.merge()

    def merge(self) -> None:
        if not self.waiting:
            return
        many, n = len(self.prefixes), len(self.waiting)
        code = b"".join([hashlib.sha256(p + m).digest() for p in self.prefixes for m in self.waiting])
        codes = np.concatenate([self.codes, np.frombuffer(code, ">u8").astype(np.uint64).reshape(many, n, 4)], axis=1)
        values = np.concatenate([self.values, np.broadcast_to(np.array(self.numbers), (many, n))], axis=1)
        order = np.argsort(codes[:, :, 0], axis=1, kind="stable")
        first = np.take_along_axis(codes[:, :, 0], order, axis=1)
        for r in np.flatnonzero((first[:, 1:] == first[:, :-1]).any(axis=1)):  # equal in 64 bits: all 256 decide
            order[r] = np.lexsort(codes[r].T[::-1])
        order = order[:, : self.most]
        self.codes = np.take_along_axis(codes, order[:, :, None], axis=1)
        self.values = np.take_along_axis(values, order, axis=1)
        self.n, self.total = self.n + n, self.total + sum(self.numbers)
        self.waiting, self.numbers = [], []

    def means(self, supports: tuple[int, ...]) -> tuple[list[int], np.ndarray, float]:
        """The sizes that the group has members for, the means of each replicate's first so many, and the mean of all."""
        self.merge()
        held = [s for s in supports if s <= self.n]
        sums = np.cumsum(self.values, axis=1)
        return held, np.stack([sums[:, s - 1] / s for s in held], axis=1) if held else np.zeros((len(self.prefixes), 0)), self.total / max(self.n, 1)


def subsample_errors(values: DataFrame, keys: list[str], member: Column, value: str, supports: tuple[int, ...], replicates: int, seed: str) -> DataFrame:
    """(keys, support_px, replicate, reduced, full, abs_error): the mean over the first n members in hash_rank() order against the mean over all.

    Rows are shuffled once, by group, and sorted, so a task reads one group after another in chunks; it holds ``replicates`` times the
    largest size, whatever the group's size. Groups with fewer members lack that size. Repeated members count as often as they come.
    """
    rows = values.filter(F.col(value).isNotNull()).select(*keys, member.alias("_member"), F.col(value).cast("double").alias("_v"))
    dealt = rows.repartition(*keys).sortWithinPartitions(*keys)
    fields = ", ".join(f"{k} {rows.schema[k].dataType.simpleString()}" for k in keys)
    sizes = tuple(sorted(set(supports)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state, kinds = None, None, None

        def closed() -> pa.RecordBatch:
            held, means, full = state.means(sizes)
            n = means.size
            columns = [pa.array([k] * n, t) for k, t in zip(key, kinds, strict=True)]
            reduced = means.reshape(-1)
            more = [np.tile(np.array(held, np.int32), replicates), np.repeat(np.arange(replicates, dtype=np.int32), len(held)), reduced, np.full(n, full), np.abs(reduced - full)]
            return pa.RecordBatch.from_arrays([*columns, *map(pa.array, more)], [*keys, "support_px", "replicate", "reduced", "full", "abs_error"])

        for batch in batches:
            kinds = kinds or [batch.schema.field(k).type for k in keys]
            names = list(zip(*(batch.column(k).to_pylist() for k in keys), strict=True))
            members, numbers = batch.column("_member").to_pylist(), batch.column("_v").to_pylist()
            at = 0
            while at < len(names):
                to = at + 1
                while to < len(names) and names[to] == names[at]:
                    to += 1
                if state is None or names[at] != key:
                    if state is not None:
                        yield closed()
                    key, state = names[at], LeastHashes(seed, replicates, max(sizes))
                state.add(members[at:to], numbers[at:to])
                at = to
        if state is not None:
            yield closed()

    return dealt.mapInArrow(run, f"{fields}, support_px int, replicate int, reduced double, full double, abs_error double")


def error_arrays(errors: DataFrame, keys: list[str]) -> DataFrame:
    """Sorted errors of all replicates in one array; there are as many as replicates."""
    return errors.groupBy(*keys, "support_px").agg(F.array_sort(F.collect_list("abs_error")).alias("replicate_abs_errors"))


def spearman_by_group(series: DataFrame, keys: list[str], a: str, b: str) -> DataFrame:
    """Rank correlation with averaged ties of two series in each group; null for fewer than two rows or a constant series."""
    ranked = series.withColumns({"_ra": average_rank(keys, a), "_rb": average_rank(keys, b)})
    g = ranked.groupBy(*keys).agg(F.count("*").alias("n"), F.covar_pop("_ra", "_rb").alias("_c"), F.var_pop("_ra").alias("_va"), F.var_pop("_rb").alias("_vb"))
    constant = (F.col("_va") == 0) | (F.col("_vb") == 0)
    rho = F.when((F.col("n") >= 2) & ~constant, F.col("_c") / F.sqrt(F.col("_va") * F.col("_vb")))
    return g.select(*keys, "n", rho.alias("rho"), ((F.col("n") >= 2) & constant).alias("constant"))
