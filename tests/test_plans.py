"""Physical-plan properties the scale design relies on (checked with explain)."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from tidemark.operators import features as FE
from tidemark.operators import ingest as IG
from tidemark.operators.quantiles import exact_percentiles
from tidemark.sources import fixtures as fx


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_history_filter_is_pushed_to_parquet(spark):
    df = IG.history(fx.raw_table(spark, SF_SMALL), 40).select("batch_number", "price")
    plan = _plan(df)
    assert "EqualNullSafe(batch_number,40)" in plan
    assert "price" in plan and "house_size" not in plan  # column pruning reaches the scan


def test_split_read_prunes_partitions(spark, tmpdir_fresh):
    rec = fx.listings_records(spark, SF_SMALL).withColumn("split", F.when(F.col("batch_number") % 3 == 0, "val").otherwise("train"))
    FE.append_clean(rec, f"{tmpdir_fresh}/clean")
    df = FE.scan_split(spark.read.parquet(f"{tmpdir_fresh}/clean"), "val")
    plan = _plan(df)
    assert "PartitionFilters: [isnotnull(split" in plan and "(split#" in plan and "= val)" in plan


def test_global_rank_has_no_single_partition_over_rows(spark):
    ranked = FE.global_rank(fx.listings_records(spark, SF_SMALL), "listing_key")
    lines = _plan(ranked).splitlines()
    # rows are ranked per hash-prefix bucket ...
    assert any("Exchange hashpartitioning(_bucket" in ln for ln in lines)
    # ... and the only single-partition exchange feeds the broadcast offset table
    single = [i for i, ln in enumerate(lines) if "Exchange SinglePartition" in ln]
    bcast = [i for i, ln in enumerate(lines) if "BroadcastExchange" in ln]
    assert single and all(any(b < s for b in bcast) for s in single)


def test_exact_percentiles_never_use_exact_percentile_buffers(spark):
    df = fx.listings_records(spark, SF_SMALL)
    out = exact_percentiles(df.where(F.col("price") > 0), [("m", "price", 0.5)], by=["batch_number"])
    plan = _plan(out)
    assert "percentile_approx" in plan
    assert "percentile(" not in plan.replace("percentile_approx(", "")


def test_small_vocabulary_is_broadcast(spark):
    df = fx.listings_records(spark, SF_SMALL)
    vocab = FE.fit_vocabulary(df)
    plan = _plan(FE.encode(df, vocab))
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_batch_scoring_is_map_only(spark):
    import __spark_entry__ as E
    plan = _plan(E.queries()["M5_batch_score"](spark, SF_SMALL))
    assert "Exchange" not in plan  # parse, encode with the model's vocabulary, predict: no shuffle
