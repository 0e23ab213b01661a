"""Exact quantiles, samples of least hashes and ranks, against plain versions."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestrata.operators import quantiles as Q
from lodestrata.operators import subsample as U


@pytest.mark.parametrize("accuracy", [10_000, 20])
def test_exact_quantiles(spark, monkeypatch, accuracy):
    """Also with a coarse sketch, whose bounds hold a tenth of a group and more."""
    monkeypatch.setattr(Q, "ACCURACY", accuracy)
    monkeypatch.setattr(Q, "MARGIN", 3 / accuracy)
    rng = np.random.default_rng(1)
    groups = {"even": rng.random(4001), "skewed": np.exp(rng.normal(0, 30, 3000)), "ties": rng.integers(0, 3, 5000).astype(float), "one": np.array([7.0]), "two": np.array([1.0, 2.0]), "same": np.full(900, 4.5), None: rng.random(50)}
    rows = [(k, float(x)) for k, xs in groups.items() for x in xs] + [("even", None), ("even", float("nan")), ("two", float("inf")), ("none", None)]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, "k string, v double").repartition(5)
    wanted = {"least": 0.0, "median": 0.5, "p90": 0.9, "most": 1.0}
    got = {r.k: tuple(r[n] for n in wanted) for r in Q.exact_quantiles(df, ["k"], "v", wanted).collect()}
    assert got.keys() == groups.keys()
    for k, xs in groups.items():
        assert np.allclose(got[k], np.quantile(xs, list(wanted.values())), rtol=1e-12)
    every = np.concatenate(list(groups.values()))
    r = Q.exact_quantiles(df, [], "v", wanted).collect()
    assert len(r) == 1 and np.allclose(tuple(r[0][n] for n in wanted), np.quantile(np.append(every, []), list(wanted.values())), rtol=1e-12)
    assert Q.exact_quantiles(df.limit(0), ["k"], "v", wanted).collect() == []


def plain_errors(rows, supports, replicates, seed):
    groups = {}
    for g, m, v in rows:
        if v is not None:
            groups.setdefault(g, []).append((m, v))
    out = {}
    for g, members in groups.items():
        whole = sum(v for _, v in members) / len(members)
        for r in range(replicates):
            order = sorted(members, key=lambda x: (hashlib.sha256(f"{seed}|{r}|{x[0]}".encode()).hexdigest(), x[0]))
            for s in supports:
                if s <= len(order):
                    reduced = sum(v for _, v in order[:s]) / s
                    out[g, s, r] = (reduced, whole, abs(reduced - whole))
    return out


@pytest.mark.parametrize("chunk", [4096, 10])
def test_samples_of_least_hashes(spark, monkeypatch, chunk):
    monkeypatch.setattr(U, "CHUNK", chunk)
    rng = random.Random(2)
    rows = [(g, f"{g},{i}", rng.choice([rng.random(), None]) if g == "holes" else rng.random()) for g, n in (("small", 3), ("large", 700), ("holes", 60), (None, 12)) for i in range(n)]
    df = spark.createDataFrame(rows, "g string, m string, v double").repartition(4)
    got = U.subsample_errors(df, ["g"], F.col("m"), "v", (4, 9, 25), 5, "s")
    have = {(r.g, r.support_px, r.replicate): (r.reduced, r.full, r.abs_error) for r in got.collect()}
    want = plain_errors(rows, (4, 9, 25), 5, "s")
    assert have.keys() == want.keys() and all(np.allclose(have[k], want[k]) for k in want)
    assert U.subsample_errors(df.limit(0), ["g"], F.col("m"), "v", (4,), 2, "s").collect() == []


def test_one_shuffle_whatever_the_replicates(spark):
    df = spark.range(100).select(F.lit("g").alias("g"), F.col("id").cast("string").alias("m"), F.rand(1).alias("v"))
    plan = U.subsample_errors(df, ["g"], F.col("m"), "v", (4, 81), 100, "s")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Window" not in plan


@pytest.mark.parametrize("parts", [1, 7])
def test_spread_ranks_are_average_ranks(spark, parts):
    rng = random.Random(3)
    rows = [(rng.choice(["a", "b", None]), rng.choice([rng.randint(0, 9), rng.randint(0, 1000)])) for _ in range(2000)]
    df = spark.createDataFrame(rows, "k string, v int")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        got = U.spread_ranks(df, ["k"], "v")
        want = df.withColumn("rank", U.average_rank(["k"], "v"))
        key = lambda r: (str(r.k), r.v, r["rank"])
        assert sorted(map(key, got.collect())) == sorted(map(key, want.collect()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
