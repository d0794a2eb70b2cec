"""Serving-side aggregates over the inference log."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Fixed histogram bounds of the latency metric (seconds), +Inf implied.
LATENCY_BOUNDS = [0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5, 5.0]


def request_counters(log: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Requests and errors."""
    return log.groupBy(*by).agg(F.count(F.lit(1)).alias("requests"),
                                F.count_if(F.col("status") == "error").alias("errors"))


def latency_buckets(log: DataFrame, by: Sequence[str] = (), latency: str = "latency_s",
                    bounds: Sequence[float] = LATENCY_BOUNDS) -> DataFrame:
    """Cumulative counts ``le`` each bound and +Inf, one row per bucket.

    Counted in one aggregation (per-bound ``count_if``), then unpivoted; the
    counts are mergeable state for streaming windows (T3)."""
    aggs = [F.count_if(F.col(latency) <= b).alias(f"_b{i}") for i, b in enumerate(bounds)]
    aggs.append(F.count(F.lit(1)).alias(f"_b{len(bounds)}"))
    a = log.groupBy(*by).agg(*aggs)
    return bucket_rows(a, by, bounds)


def bucket_rows(agg: DataFrame, by: Sequence[str], bounds: Sequence[float] = LATENCY_BOUNDS) -> DataFrame:
    les = list(bounds) + [float("inf")]
    arr = F.array(*[F.struct(F.lit(i).alias("bucket"), F.lit(float(le)).alias("le"), F.col(f"_b{i}").alias("cum"))
                    for i, le in enumerate(les)])
    return agg.select(*by, F.inline(arr))


def histogram_quantile(buckets: DataFrame, qs: Sequence[float] = (0.5, 0.95, 0.99), by: Sequence[str] = ()) -> DataFrame:
    """Quantiles from cumulative buckets, the PromQL way: find the first
    bucket whose count reaches q * n, interpolate linearly inside it (lower
    bound 0 for the first), return the highest finite bound when it lands in
    +Inf; NaN when there are no observations."""
    w = Window.partitionBy(*by).orderBy("bucket")
    b = buckets.withColumns({"_prev_le": F.coalesce(F.lag("le").over(w), F.lit(0.0)),
                             "_prev_cum": F.coalesce(F.lag("cum").over(w), F.lit(0)),
                             "_n": F.max("cum").over(Window.partitionBy(*by)),
                             "_max_finite": F.max(F.when(F.col("le") != float("inf"), F.col("le"))).over(Window.partitionBy(*by))})
    out = []
    for i, q in enumerate(qs):
        rank = F.lit(q) * F.col("_n")
        hit = (F.col("cum") >= rank) & (F.col("_prev_cum") < rank) | ((F.col("bucket") == 0) & (F.col("cum") >= rank))
        val = (F.when(F.col("le") == float("inf"), F.col("_max_finite"))
               .when(F.col("cum") == F.col("_prev_cum"), F.col("le"))
               .otherwise(F.col("_prev_le") + (F.col("le") - F.col("_prev_le"))
                          * (rank - F.col("_prev_cum")) / (F.col("cum") - F.col("_prev_cum"))))
        out.append(F.min(F.when(hit, F.struct("bucket", val.alias("v")))).alias(f"_q{i}"))
    g = b.groupBy(*by).agg(F.max("_n").alias("_n"), *out)
    return g.select(*by, *[F.when(F.col("_n") > 0, F.col(f"_q{i}.v")).otherwise(F.lit(float("nan"))).alias(
        f"p{int(round(q * 100))}") for i, q in enumerate(qs)])


def exact_latency_quantiles(log: DataFrame, by: Sequence[str] = (), latency: str = "latency_s",
                            qs: Sequence[float] = (0.5, 0.95, 0.99)) -> DataFrame:
    """A18 exact twin: linear-interpolated percentiles of the raw latencies."""
    from tidemark.operators.quantiles import exact_percentiles
    return exact_percentiles(log, [(f"p{int(round(q * 100))}", latency, q) for q in qs], by)


def serving_status(log: DataFrame, by: Sequence[str] = (), ts: str = "request_ts",
                   version: str = "model_version") -> DataFrame:
    """Current (latest) model version; 'degraded' when none is loaded."""
    g = log.groupBy(*by).agg(F.max_by(version, ts).alias("model_version"))
    return g.select(*by, "model_version", F.col("model_version").isNotNull().alias("model_loaded"),
                    F.when(F.col("model_version").isNull(), F.lit("degraded")).otherwise(F.lit("healthy")).alias("health"))
