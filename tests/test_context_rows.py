"""Context rows from one row a pair: the same as the join of fire and climate rows, and none is shuffled."""

from pyspark.sql import functions as F

from lodestrata.operators import context as K
from tests.conftest import SF
from tests.test_first_matches import _rows


def test_context_rows_are_those_of_the_join(spark):
    pairs = spark.createDataFrame([(f"S{i}", f"M{i % 4}") for i in range(9)], "site_id string, footprint_id string")
    counts = spark.createDataFrame([("M0", 1994, 3), ("M0", 1990, 1), ("M1", 1996, 2)], "footprint_id string, fire_year long, n long")
    none = spark.createDataFrame([("M1", "null")], "footprint_id string, no_footprint_reason string")
    cells = spark.createDataFrame([("M0", 0), ("M1", 1), ("M2", 7)], "footprint_id string, cell long")  # M3 has none
    annual = spark.createDataFrame([(0, 1994, 10.0, 3, None), (0, 1995, 20.0, 4, None), (1, 1994, 5.0, 1, None)], "cell long, year int, total_mm double, rain_days long, reason string")
    years, wanted, base = (1994, 1996), (1992, 1995), (1994, 1995)
    fire, climate = K.fire_context(pairs, counts, none, years, 1996), K.climate_context(pairs, cells, annual, base, years)
    want = K.context_join(fire, climate, wanted)
    got = K.context_rows(K.with_fires(pairs, counts, none, years).join(cells, "footprint_id", "left"), annual, base, years, wanted, 1996)
    assert got.columns == want.columns and _rows(got) == _rows(want) and got.count() == 9 * 2 + 7 * 3
    checks = K.context_checks(got.unionByName(got.filter("year = 1994 AND site_id = 'S0'")), pairs, wanted)
    assert {r.check: (r.n, r.examples) for r in checks.collect() if r.n} == {"duplicate_key": (1, "S0|1994,S0|1994"), "year_outside_range": (7, "S0,S8"), "years_per_site": (9, "")}


def test_years_of_pairs_are_not_shuffled(spark):
    """Above the sites' grouping by id no row is shuffled by key, neither for contexts nor for their counts by site and year."""
    from lodestrata.plans import registry  # noqa: F401 - registers q_context, which can't come first
    from lodestrata.plans import q_context as Q

    at = Q.high_places(spark, SF)
    c = Q.context(spark, SF, at)
    for df in (c, c.groupBy("site_id", "year").agg(F.count("*").alias("n")), K.fire_years(Q.at_places(spark, SF, at), Q.YEARS, Q.SNAPSHOT)):
        text = df._jdf.queryExecution().executedPlan().toString()
        assert text.split("Generate explode(")[0].count("Exchange hashpartitioning") == 0
