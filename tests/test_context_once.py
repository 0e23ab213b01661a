"""Contexts by pairs and join checks by counts: the same rows as from all years and pairs."""

import random

from pyspark.sql import functions as F

from lodestrata.operators import context as K
from tests.test_first_matches import _rows


def _shuffled_years(df):
    """Exchanges of a plan that lie above its explosion into years."""
    text = df._jdf.queryExecution().executedPlan().toString().split("\n")
    at = next(k for k, line in enumerate(text) if "Generate explode(" in line)
    return [line for line in text[:at] if "Exchange hashpartitioning" in line]


def test_contexts_shuffle_pairs_and_not_their_years(spark):
    pairs = spark.createDataFrame([(f"S{i}", f"M{i % 3}") for i in range(9)], "site_id string, footprint_id string")
    counts = spark.createDataFrame([("M0", 1994, 3), ("M0", 1990, 1), ("M1", 1996, 2)], "footprint_id string, fire_year long, n long")
    none = spark.createDataFrame([("M1", "null")], "footprint_id string, no_footprint_reason string")
    fire = K.fire_context(pairs, counts, none, (1994, 1996), 1996)
    got = {(r.footprint_id, r.year): (r.fire_status, r.fire_record_count, r.fire_coverage_status, r.fire_reason) for r in fire.collect()}
    assert fire.count() == 27
    assert got == {
        **{("M1", y): ("unknown", None, "no_footprint", "null") for y in (1994, 1995, 1996)}, ("M0", 1994): ("recorded", 3, "covered", None), ("M0", 1995): ("not_recorded", 0, "covered", None), ("M2", 1994): ("not_recorded", 0, "covered", None),
        ("M2", 1995): ("not_recorded", 0, "covered", None), ("M0", 1996): ("unknown", None, "outside_window", "outside_coverage_window"), ("M2", 1996): ("unknown", None, "outside_window", "outside_coverage_window"),
    }
    cells = spark.createDataFrame([("M0", 0), ("M1", 1), ("M2", 7)], "footprint_id string, cell long")
    annual = spark.createDataFrame([(0, 1994, 10.0, 3, None), (0, 1995, 20.0, 4, None), (1, 1994, 5.0, 1, None)], "cell long, year int, total_mm double, rain_days long, reason string")
    climate = K.climate_context(pairs, cells, annual, (1994, 1995), (1994, 1996))
    got = {(r.footprint_id, r.year): (r.annual_rainfall_mm, r.rainfall_anomaly_mm, r.climate_reason) for r in climate.collect()}
    assert climate.count() == 27 and got[("M0", 1994)] == (10.0, -5.0, None) and got[("M0", 1996)] == got[("M2", 1994)] == (None, None, "no daily values") and got[("M1", 1994)] == (None, None, "baseline lacks 1995")
    assert _shuffled_years(fire) == _shuffled_years(climate) == []


def test_join_checks_count_what_a_full_join_has(spark):
    rng = random.Random(8)
    side = lambda n: spark.createDataFrame([(rng.choice(["a", "b", "c", "d", None]), rng.choice([1990, 1994, 1995, None]), rng.choice(["M", "N", None])) for _ in range(n)], "site_id string, year int, footprint_id string")
    for n, m in ((40, 30), (12, 4), (0, 5), (5, 0), (0, 0)):
        fire, climate = side(n), side(m)
        keys = ["site_id", "year"]
        both = fire.select(*keys, F.col("footprint_id").alias("f")).join(climate.select(*keys, F.col("footprint_id").alias("g")), keys, "full")
        rules = {"only_in_fire": F.col("g").isNull(), "only_in_climate": F.col("f").isNull(), "footprint_disagrees": F.col("f") != F.col("g"), "year_outside_range": ~F.col("year").between(1994, 1999)}
        want = K.together(K.violations(both, rules, F.col("site_id")), K.duplicates(fire, keys, "duplicate_fire"), K.duplicates(climate, keys, "duplicate_climate"))
        got = K.join_checks(fire, climate, (1994, 1999))
        assert _rows(got) == _rows(want)
        assert got._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0].count("Exchange hashpartitioning") <= 1


def test_pairs_are_matched_once_for_both_contexts(spark, monkeypatch):
    from lodestrata.plans import q_context as Q
    from tests.conftest import SF

    asked, pairs = [], Q.pairs
    monkeypatch.setattr(Q, "pairs", lambda *a: asked.append(a) or pairs(*a))
    assert {r.check: r.n > 0 for r in Q.join_checks(spark, SF).collect()} == {"only_in_fire": True, **dict.fromkeys(("only_in_climate", "footprint_disagrees", "year_outside_range", "duplicate_fire", "duplicate_climate"), False)}
    assert len(asked) == 1
