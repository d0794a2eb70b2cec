"""Percentiles from merged per-batch sketches equal numpy's."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import sketches as SK


def test_exact_from_merged_batches(spark):
    rng = np.random.default_rng(2)
    rows = [(int(i % 9), float(a), None if i % 5 == 0 else float(b), float("nan") if i % 3 else 7.0, None) for i, (a, b) in enumerate(zip(rng.lognormal(size=30000), rng.integers(0, 6, 30000)))]
    df = spark.createDataFrame(rows, "batch_number int, a double, b double, c double, d double").repartition(4)
    state = SK.sketch_state(df, ["a", "b", "c", "d"], k=200)
    assert state.count() == 9
    targets = [("m", "a", 0.5), ("p99", "a", 0.99), ("lo", "a", 0.0), ("hi", "a", 1.0), ("mb", "b", 0.5), ("mc", "c", 0.5), ("md", "d", 0.5)]
    got = SK.exact_from_sketches(df, state, targets, k=200).first()
    a, b = np.array([r[1] for r in rows]), np.array([r[2] for r in rows if r[2] is not None])
    assert [got[n] for n in ("m", "p99", "lo", "hi", "mb", "mc")] == pytest.approx([np.quantile(a, 0.5), np.quantile(a, 0.99), a.min(), a.max(), np.quantile(b, 0.5), 7.0], rel=1e-12)
    assert got["md"] is None
    # any set of batches: its states and its rows
    some = SK.exact_from_sketches(df.where("batch_number < 4"), state.where("batch_number < 4"), targets[:2], k=200).first()
    part = np.array([r[1] for r in rows if r[0] < 4])
    assert [some["m"], some["p99"]] == pytest.approx([np.quantile(part, 0.5), np.quantile(part, 0.99)], rel=1e-12)


def test_a_bracket_that_misses_is_widened(spark, monkeypatch):
    df = spark.range(5000).select(F.lit(1).alias("batch_number"), F.col("id").cast("double").alias("a"))
    passes, error = [], SK.rank_error
    monkeypatch.setattr(SK, "rank_error", lambda k: 1e-7)
    cut = SK.cut_lineage
    monkeypatch.setattr(SK, "cut_lineage", lambda x: passes.append(1) or cut(x))
    state = SK.sketch_state(df, ["a"], k=8)
    assert SK.exact_from_sketches(df, state, [("m", "a", 0.5)], k=8).first()["m"] == 2499.5 and len(passes) > 2
    assert error(4000) < error(200) < 0.05


def test_nothing_to_rank(spark):
    df = spark.createDataFrame([], "batch_number int, a double")
    assert SK.exact_from_sketches(df, SK.sketch_state(df, ["a"]), [("m", "a", 0.5)]).first()["m"] is None
