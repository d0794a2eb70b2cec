"""Evaluation metrics and candidate choice."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import cut_lineage

RUN_KEYS = ["line", "batch_number", "candidate", "ordinal"]


def regression_metrics(pred: DataFrame, keys: Sequence[str] = RUN_KEYS, split: str = "split",
                       actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    """MAE, RMSE, R^2 per (run, split) in one aggregation pass.

    R^2 = 1 - SSE / (n * var_pop(y)); a constant target gives 1.0 when SSE is 0
    else 0.0 (the usual finite convention).
    """
    e = F.col(predicted) - F.col(actual)
    agg = pred.groupBy(*keys, split).agg(
        F.count(F.lit(1)).alias("n"), F.avg(F.abs(e)).alias("mae"), F.avg(e * e).alias("_mse"),
        F.sum(e * e).alias("_sse"), F.var_pop(actual).alias("_var"))
    den = F.col("n") * F.col("_var")
    r2 = F.when(den != 0, F.lit(1.0) - F.col("_sse") / den).when(F.col("_sse") == 0, F.lit(1.0)).otherwise(F.lit(0.0))
    return agg.select(*keys, split, "n", "mae", F.sqrt("_mse").alias("rmse"), r2.alias("r2"))


def wide_metrics(metrics: DataFrame, keys: Sequence[str] = RUN_KEYS) -> DataFrame:
    """One row per run with val_/test_ metrics; test metrics NaN when test is empty."""
    nan = F.lit(float("nan"))
    out = metrics.groupBy(*keys).agg(*[
        F.max(F.when(F.col("split") == s, F.col(m))).alias(f"{s}_{m}") for s in ("val", "test") for m in ("mae", "rmse", "r2")],
        *[F.sum(F.when(F.col("split") == s, F.col("n"))).alias(f"{s}_size") for s in ("train", "val")])
    return out.withColumns({f"test_{m}": F.coalesce(F.col(f"test_{m}"), nan) for m in ("mae", "rmse", "r2")})


def best_candidate(wide: DataFrame, run: Sequence[str] = ("line", "batch_number"), metric: str = "val_mae") -> DataFrame:
    """Lowest ``metric`` (MAE) per run, first ordinal on ties; NaN never wins."""
    ok = wide.where(F.col(metric).isNotNull() & ~F.isnan(metric))
    cols = [c for c in wide.columns if c not in run]
    best = ok.groupBy(*run).agg(F.min_by(F.struct(*cols), F.struct(metric, "ordinal")).alias("_b"))
    return best.select(*run, "_b.*")


def drop_nan_metrics(m):
    """P10: metrics map without NaN values (nor nulls: a metric of an empty split is not logged)."""
    return F.map_filter(m, lambda k, v: v.isNotNull() & ~F.isnan(v))


#: groups (a model line and candidate each) up to which their ranges are broadcast
RANGE_GROUPS = 100_000


def _with_ranges(rows: DataFrame, ranges: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows with the range of their group.  There are few groups and many rows of each, so the counted ranges travel, not the rows."""
    ranges = cut_lineage(ranges)
    return rows.join(F.broadcast(ranges) if ranges.count() <= RANGE_GROUPS else ranges, list(keys))


def residual_histogram(pred: DataFrame, keys: Sequence[str] = ("line",), bins: int = 50,
                       actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    """``bins`` equal-width bins of predicted - actual per group (min/max pass + width_bucket)."""
    r = pred.withColumn("_r", F.col(predicted) - F.col(actual))
    mm = r.groupBy(*keys).agg(F.min("_r").alias("_lo"), F.max("_r").alias("_hi"))
    j = _with_ranges(r, mm, keys)
    width = (F.col("_hi") - F.col("_lo")) / bins
    b = F.when(F.col("_hi") == F.col("_lo"), F.lit(0)).otherwise(
        F.least(F.floor((F.col("_r") - F.col("_lo")) / width), F.lit(bins - 1))).cast("int")
    return (j.withColumn("bin", b).groupBy(*keys, "bin").agg(
        F.count(F.lit(1)).alias("count"), F.first("_lo").alias("range_lo"), F.first("_hi").alias("range_hi")))


def actual_vs_predicted(pred: DataFrame, keys: Sequence[str] = ("line",), bins: int = 20,
                        actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    """Common [min, max] range of both axes and 2-D binned counts in place of raw points."""
    mm = pred.groupBy(*keys).agg(F.least(F.min(actual), F.min(predicted)).alias("_lo"),
                                 F.greatest(F.max(actual), F.max(predicted)).alias("_hi"))
    j = _with_ranges(pred, mm, keys)
    width = (F.col("_hi") - F.col("_lo")) / bins

    def b(c):
        return F.when(F.col("_hi") == F.col("_lo"), F.lit(0)).otherwise(
            F.least(F.floor((F.col(c) - F.col("_lo")) / width), F.lit(bins - 1))).cast("int")
    return j.groupBy(*keys, b(actual).alias("actual_bin"), b(predicted).alias("predicted_bin")).agg(
        F.count(F.lit(1)).alias("count"), F.first("_lo").alias("range_lo"), F.first("_hi").alias("range_hi"))
