"""The persistent hash index: exact answers, files read follow the batch, reruns and merges change nothing."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.store.hash_index import HashIndex
from tidemark.store.runs import Store


def _df(spark, values):
    return spark.createDataFrame([(v, i) for i, v in enumerate(values)], "row_hash string, n int")


def test_answers_equal_a_set(spark, tmpdir_fresh):
    rng = random.Random(1)
    index = HashIndex(Store(tmpdir_fresh), fan_in=3, bucket_keys=40)
    seen: set[str] = set()
    for run in range(1, 11):  # merges of two levels on the way
        values = [f"h{rng.randrange(900)}" for _ in range(70)] + [None]
        batch = _df(spark, values)
        new = index.unseen(batch, "row_hash", run)
        got = sorted(str(r.row_hash) for r in new.collect())
        assert got == sorted(str(v) for v in values if v not in seen)
        index.append(new, "row_hash", run)
        seen |= {v for v in values if v is not None}
    live = index.segments(spark, 11)
    assert sum(s["n"] for s in live) == len(seen) and max(s["level"] for s in live) == 2 and max(s["bits"] for s in live) > 1
    assert all(sum(s["level"] == k for s in live) < 3 for k in range(3))


def test_a_run_done_again_sees_only_earlier_runs(spark, tmpdir_fresh):
    index = HashIndex(Store(tmpdir_fresh), fan_in=2)
    index.append(_df(spark, ["a", "b"]), "row_hash", 1)
    for _ in range(2):  # the second time its own segments, merged ones included, are there already
        new = index.unseen(_df(spark, ["b", "c"]), "row_hash", 2)
        assert [r.row_hash for r in new.collect()] == ["c"]
        index.append(new, "row_hash", 2)
    assert index.unseen(_df(spark, ["a", "b", "c", "d"]), "row_hash", 3).count() == 1
    assert sum(s["n"] for s in index.segments(spark, 3)) == 3


def test_files_read_follow_the_batch_not_the_store(spark, tmpdir_fresh, monkeypatch):
    read = {"hashes": [], "filters": []}
    table = HashIndex._table

    def spy(self, spark_, kind, wanted):
        df = table(self, spark_, kind, wanted)
        # the plan (below) shows that the condition prunes partitions; these are the files that are left
        read[kind].append(df.select("_metadata.file_path").distinct().count())
        return df

    sizes = {}
    for rows in (4000, 32000):
        index = HashIndex(Store(f"{tmpdir_fresh}/{rows}"), bucket_keys=500)
        index.append(spark.range(rows).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("row_hash")), "row_hash", 1)
        monkeypatch.setattr(HashIndex, "_table", spy)
        fresh, old = _df(spark, [f"new{i}" for i in range(5)]), _df(spark, ["k1", "k2", "new7"])
        read["hashes"].clear(), read["filters"].clear()
        assert index.unseen(fresh, "row_hash", 2).count() == 5
        assert sum(read["hashes"]) <= 1 and sum(read["filters"]) <= 5  # no hash file but for a false positive
        read["hashes"].clear(), read["filters"].clear()
        assert [r.row_hash for r in index.unseen(old, "row_hash", 2).collect()] == ["new7"]
        sizes[rows] = (sum(read["hashes"]), sum(read["filters"]))
        monkeypatch.undo()
        plan = table(index, spark, "hashes", {"1-0": [3]})._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [" in plan and "bucket" in plan.split("PartitionFilters: [")[1]
        assert len(spark.read.parquet(f"{tmpdir_fresh}/{rows}/index-hashes").inputFiles()) >= rows // 500
    assert all(2 <= h <= 3 and f <= 3 for h, f in sizes.values())


def test_empty_batches_and_nulls(spark, tmpdir_fresh):
    index = HashIndex(Store(tmpdir_fresh))
    empty = _df(spark, [])
    assert index.unseen(empty, "row_hash", 1).count() == 0
    index.append(empty, "row_hash", 1)
    index.append(_df(spark, [None, None, "x"]), "row_hash", 2)
    assert index.unseen(empty, "row_hash", 3).count() == 0
    assert sorted(str(r.row_hash) for r in index.unseen(_df(spark, [None, "x", "y"]), "row_hash", 3).collect()) == ["None", "y"]


def test_store_shows_committed_runs_only(spark, tmpdir_fresh):
    store = Store(tmpdir_fresh)
    assert store.committed(spark) == 0 and store.read(spark, "t") is None
    store.write(_df(spark, ["a"]), "t", 1)
    assert store.read(spark, "t").count() == 0  # written, not committed
    store.write(_df(spark, ["a", "b"]), "t", 1)  # the attempt after a break
    store.commit(spark, 1)
    assert store.committed(spark) == 1 and store.read(spark, "t").count() == 2
    with pytest.raises(ValueError):
        store.commit(spark, 1)
    with pytest.raises(ValueError):
        store.commit(spark, 3)
