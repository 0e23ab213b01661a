"""Deliveries in micro-batches: every row of a partition stays, replays and half-done batches change nothing."""

import pytest

from lodestrata.operators.contracts import Refused
from lodestrata.streaming import incremental as I
from lodestrata.streaming.ledger import Deliveries

SCHEMA = "collection_id string, year int, v int"


def arrive(spark, folder, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(str(folder))


def stream(spark, folder):
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(folder))


def expected(spark):
    return spark.createDataFrame([("fc", 2000), ("fc", 2001)], "collection_id string, year int")


def run(spark, tmp_path, delivery):
    return I.stream_trajectories(stream(spark, tmp_path / delivery), expected(spark), f"{tmp_path}/out", f"{tmp_path}/check-{delivery}", delivery=delivery)


def values(parts):
    return sorted((r.collection_id, r.year, r.v, r.part_version) for r in parts.rows().collect())


def test_a_partition_in_two_micro_batches_keeps_all_rows(spark, tmp_path):
    for rows in ([("fc", 2000, 1), ("fc", 2000, 2)], [("fc", 2000, 3)]):
        arrive(spark, tmp_path / "a", rows)
    parts = run(spark, tmp_path, "a")
    assert values(parts) == [("fc", 2000, v, 0) for v in (1, 2, 3)]
    assert sorted(r.rows for r in parts.entries().collect()) == [1, 2] and {r.batch for r in parts.entries().collect()} == {0, 1}


def test_later_deliveries_leave_closed_partitions_alone(spark, tmp_path):
    arrive(spark, tmp_path / "a", [("fc", 2000, 1)])
    run(spark, tmp_path, "a")
    arrive(spark, tmp_path / "b", [("fc", 2000, 1), ("fc", 2000, 9), ("fc", 2001, 4)])
    arrive(spark, tmp_path / "b", [("fc", 2001, 5)])
    parts = run(spark, tmp_path, "b")
    want = [("fc", 2000, 1, 0), ("fc", 2001, 4, 1), ("fc", 2001, 5, 1)]
    assert values(parts) == want
    arrive(spark, tmp_path / "a", [("fc", 2001, 7)])
    assert values(run(spark, tmp_path, "a")) == want  # a closed delivery is not read again


@pytest.mark.parametrize("fails", ["before the entry", "after the entry"])
def test_a_batch_that_failed_half_way_comes_again(spark, tmp_path, monkeypatch, fails):
    for v in (1, 2, 3):
        arrive(spark, tmp_path / "a", [("fc", 2000, v), ("fc", 2001, v)])
    commit = Deliveries.commit

    def torn(self, rows, counts, delivery, batch):
        if batch == 1:
            if fails == "after the entry":
                commit(self, rows, counts, delivery, batch)
            else:
                rows.limit(1).write.mode("overwrite").partitionBy(*self.keys).parquet(f"{self.root}/data/delivery={delivery}/batch={batch}")
            raise RuntimeError("lost")
        commit(self, rows, counts, delivery, batch)

    monkeypatch.setattr(Deliveries, "commit", torn)
    with pytest.raises(Exception, match="lost"):
        run(spark, tmp_path, "a")
    open_ = Deliveries(spark, f"{tmp_path}/out", spark.createDataFrame([], SCHEMA).schema, ["collection_id", "year"])
    assert values(open_) == []  # not closed, so not read
    monkeypatch.setattr(Deliveries, "commit", commit)
    arrive(spark, tmp_path / "b", [("fc", 2000, 9)])
    with pytest.raises(Refused, match="not closed"):
        run(spark, tmp_path, "b")
    assert values(run(spark, tmp_path, "a")) == sorted(("fc", y, v, 0) for y in (2000, 2001) for v in (1, 2, 3))


def test_an_open_delivery_can_be_abandoned(spark, tmp_path):
    arrive(spark, tmp_path / "a", [("fc", 2000, 1)])
    arrive(spark, tmp_path / "a", [("gm", 1990, 1)])
    with pytest.raises(Exception, match="nobody expects"):
        run(spark, tmp_path, "a")
    parts = Deliveries(spark, f"{tmp_path}/out", spark.createDataFrame([], SCHEMA).schema, ["collection_id", "year"])
    parts.abandon("a")
    arrive(spark, tmp_path / "b", [("fc", 2000, 2)])
    assert values(run(spark, tmp_path, "b")) == [("fc", 2000, 2, 0)]
    with pytest.raises(Refused, match="is closed"):
        parts.abandon("b")
    with pytest.raises(Refused, match="name"):
        parts.begin("a/b")


def test_refused_items_are_counted(spark, tmp_path):
    def index(delivery, files):
        for rows in files:
            arrive(spark, tmp_path / delivery, rows)
        return I.index_items(stream(spark, tmp_path / delivery).selectExpr("collection_id AS source", "v AS item"), "source", "item", f"{tmp_path}/index", f"{tmp_path}/check-{delivery}", delivery)

    index("a", [[("s", 0, 1), ("s", 0, 1), ("t", 0, 1)], [("s", 0, 1), ("s", 0, 2), (None, 0, 3), ("s", 0, None)]])
    known = index("b", [[("s", 0, 2), ("s", 0, 3)]])
    assert sorted((r.source, r.item) for r in known.rows().collect()) == [("s", 1), ("s", 2), ("s", 3), ("t", 1)]
    sums = {}
    for r in known.entries().collect():
        a, k, x = sums.get(r.source, (0, 0, 0))
        sums[r.source] = (a + r.arrived, k + r.kept, x + r.refused)
    assert sums == {"s": (7, 3, 4), "t": (1, 1, 0), None: (1, 0, 1)}
