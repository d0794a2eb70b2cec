"""Exact percentiles without funnelling a whole column through one task.

Spark's exact ``percentile``/``median`` keeps every distinct value of a group
in one aggregation buffer.  Here the exact order statistic is found in two
passes:

1. one wide aggregation per group: for each target ``count``, ``min``,
   ``max`` and a ``percentile_approx`` bracket ``[q - d, q + d]``
   (d = 3 / accuracy) that surely contains rank ``q (n - 1)``;
2. values below the bracket are only counted (one wide aggregation), values
   inside it are grouped by value (hot values collapse map-side), values
   above are dropped.  A window over the band — at most about ``max_band``
   distinct values per group and target — finds the two neighbours of the
   rank, which are interpolated linearly (numpy / DuckDB ``quantile_cont`` /
   Spark ``percentile`` rule).

Groups smaller than about ``accuracy`` values skip the bracket (the whole
group is the band).  Ungrouped, the bracket is narrowed by further rounds
until it holds at most ``max_band`` distinct values; grouped, the sketch
accuracy is sized from the largest group.  Either way no task ranks more.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_ACCURACY = 10000


DEFAULT_MAX_BAND = 1_000_000
MAX_ACCURACY = 10_000_000


def _refine(x: DataFrame, row: dict, targets, d: float, accuracy: int, max_band: int, rounds: int = 6) -> dict:
    """Ungrouped case: narrow each bracket until it holds at most ``max_band``
    distinct values.  Each round is one scalar aggregation (counts) plus, for brackets
    still too wide, one ``percentile_approx`` over the bracket's rows only, at
    the local ranks of the target; a round shrinks a bracket about
    ``accuracy / 6`` times, so ``n = 10^12`` needs two rounds at the default."""
    row = dict(row)
    # a first bracket spans at most about 6 n / accuracy ranks: nothing to do
    if all((row[f"_n{i}"] or 0) * 8.0 / accuracy <= max_band for i in range(len(targets))):
        return row
    for _ in range(rounds):
        cnt = x.agg(*[F.count_if(F.col(f"_v{i}") < F.lit(row[f"_lo{i}"])).alias(f"_b{i}")
                      for i in range(len(targets)) if row[f"_lo{i}"] is not None],
                    *[F.count_if(F.col(f"_v{i}").between(F.lit(row[f"_lo{i}"]), F.lit(row[f"_hi{i}"]))).alias(f"_w{i}")
                      for i in range(len(targets)) if row[f"_lo{i}"] is not None],
                    # the band pass ranks *distinct* values (copies collapse), so that is the width
                    *[F.approx_count_distinct(F.when(F.col(f"_v{i}").between(F.lit(row[f"_lo{i}"]), F.lit(row[f"_hi{i}"])),
                                                     F.col(f"_v{i}"))).alias(f"_dw{i}")
                      for i in range(len(targets)) if row[f"_lo{i}"] is not None]).first()
        wide = [i for i in range(len(targets)) if row[f"_lo{i}"] is not None and cnt[f"_dw{i}"] > max_band]
        if not wide:
            return row
        aggs, qs = [], {}
        for i in wide:
            m = cnt[f"_w{i}"]
            r0 = math.floor(row[f"_pos{i}"]) - cnt[f"_b{i}"]
            r1 = math.ceil(row[f"_pos{i}"]) - cnt[f"_b{i}"]
            qs[i] = (max(r0 / (m - 1) - d, 0.0), min(r1 / (m - 1) + d, 1.0))
            inside = F.when(F.col(f"_v{i}").between(F.lit(row[f"_lo{i}"]), F.lit(row[f"_hi{i}"])), F.col(f"_v{i}"))
            aggs.append(F.percentile_approx(inside, F.array(F.lit(qs[i][0]), F.lit(qs[i][1])), accuracy).alias(f"_pa{i}"))
        pa = x.agg(*aggs).first()
        for i in wide:
            if qs[i][0] > 0:
                row[f"_lo{i}"] = pa[f"_pa{i}"][0]
            if qs[i][1] < 1:
                row[f"_hi{i}"] = pa[f"_pa{i}"][1]
    return row


def exact_percentiles(df: DataFrame, targets: Sequence[tuple[str, str, float]], by: Sequence[str] = (),
                      accuracy: int = DEFAULT_ACCURACY, max_band: int = DEFAULT_MAX_BAND) -> DataFrame:
    """Exact linear-interpolated percentiles.

    ``targets`` = [(output_name, column, q), ...]; nulls (and NaN) are ignored.
    Returns one row per group with one double column per output name (null
    when the group has no value).  Ungrouped, the bracket is refined until it
    holds at most ``max_band`` distinct values; grouped, the sketch accuracy is
    raised (up to ``MAX_ACCURACY``) so the largest group's band, about
    ``6 n_group / accuracy`` values, fits ``max_band``.
    """
    by = list(by)
    names = [name for name, _, _ in targets]
    vals = {name: F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")) for name, c, _ in targets}
    x = df.select(*by, *[vals[n].alias(f"_v{i}") for i, n in enumerate(names)])
    if by:
        # grouped: size the sketch so that the largest group's band stays
        # within max_band (one cheap count pass; groups stay parallel)
        biggest = x.groupBy(*by).count().agg(F.max("count")).first()[0] or 0
        accuracy = int(min(MAX_ACCURACY, max(accuracy, math.ceil(8.0 * biggest / max_band))))
    d = 3.0 / accuracy

    # 1. wide aggregation: count / min / max / approximate bracket per target
    aggs = []
    for i, (_, _, q) in enumerate(targets):
        v = F.col(f"_v{i}")
        lo_q, hi_q = max(q - d, 0.0), min(q + d, 1.0)
        aggs += [F.count(v).alias(f"_n{i}"), F.min(v).alias(f"_min{i}"), F.max(v).alias(f"_max{i}"),
                 F.percentile_approx(v, F.array(F.lit(lo_q), F.lit(hi_q)), accuracy).alias(f"_pa{i}")]
    stats = x.groupBy(*by).agg(*aggs)
    cols = []
    for i, (_, _, q) in enumerate(targets):
        n = F.col(f"_n{i}")
        small = n * d < 4
        cols += [n, (F.lit(q) * (n - 1)).alias(f"_pos{i}"),
                 F.when(small | (q - d <= 0), F.col(f"_min{i}")).otherwise(F.col(f"_pa{i}")[0]).alias(f"_lo{i}"),
                 F.when(small | (q + d >= 1), F.col(f"_max{i}")).otherwise(F.col(f"_pa{i}")[1]).alias(f"_hi{i}")]
    stats = stats.select(*by, *cols)
    stat_cols = [c for i in range(len(targets)) for c in (f"_n{i}", f"_pos{i}", f"_lo{i}", f"_hi{i}")]
    if not by:
        # ungrouped: the fitted bracket is a handful of per-run scalars
        row = _refine(x, stats.first().asDict(), targets, d, accuracy, max_band)
        lits = {c: F.lit(row[c]).cast("double" if not c.startswith("_n") else "bigint") for c in stat_cols}

        def attach(frame: DataFrame) -> DataFrame:
            return frame.withColumns(lits)
    else:
        def attach(frame: DataFrame) -> DataFrame:
            return frame.join(stats, by)

    # 2. below-bracket counts (one cheap wide aggregation) and the band itself:
    #    only values inside [lo, hi] are exploded and grouped by value
    j = attach(x)
    below = j.groupBy(*by).agg(*[F.count_if(F.col(f"_v{i}") < F.col(f"_lo{i}")).alias(f"_below{i}")
                                 for i in range(len(targets))])
    items = F.array(*[F.struct(F.lit(i).alias("t"), F.col(f"_v{i}").alias("v"), F.col(f"_lo{i}").alias("lo"),
                               F.col(f"_hi{i}").alias("hi")) for i in range(len(targets))])
    inside = F.filter(items, lambda e: (e["v"] >= e["lo"]) & (e["v"] <= e["hi"]))
    band = (j.select(*by, F.explode(inside).alias("_e")).select(*by, F.col("_e.t").alias("_t"), F.col("_e.v").alias("_k"))
            .groupBy(*by, "_t", "_k").agg(F.count(F.lit(1)).alias("_c")))
    w = Window.partitionBy(*by, "_t").orderBy("_k").rowsBetween(Window.unboundedPreceding, 0)
    band = band.withColumn("_cum", F.sum("_c").over(w))
    if by:
        band = band.join(below, by)
        below_cols = [F.col(f"_below{i}") for i in range(len(targets))]
    else:  # one row of per-run scalars
        brow = below.first()
        below_cols = [F.lit(int(brow[f"_below{i}"])) for i in range(len(targets))]
    below_of_t = F.element_at(F.array(*below_cols), (F.col("_t") + 1).cast("int"))
    band = band.withColumn("_cum", F.col("_cum") + below_of_t).withColumn("_start", F.col("_cum") - F.col("_c"))

    # 3. pick ranks floor(pos) and ceil(pos) and interpolate
    pos = F.element_at(F.array(*[F.col(f"_pos{i}") for i in range(len(targets))]), (F.col("_t") + 1).cast("int"))
    pick = attach(band).withColumn("_pos", pos).withColumns({"_r0": F.floor("_pos"), "_r1": F.ceil("_pos")})
    hit0 = (F.col("_start") <= F.col("_r0")) & (F.col("_r0") < F.col("_cum"))
    hit1 = (F.col("_start") <= F.col("_r1")) & (F.col("_r1") < F.col("_cum"))
    res = pick.groupBy(*by, "_t").agg(F.max(F.when(hit0, F.col("_k"))).alias("_x0"),
                                      F.max(F.when(hit1, F.col("_k"))).alias("_x1"), F.first("_pos").alias("_pos"))
    res = res.select(*by, "_t", (F.col("_x0") + (F.col("_x1") - F.col("_x0")) * (F.col("_pos") - F.floor("_pos"))).alias("_value"))
    out = res.groupBy(*by).pivot("_t", list(range(len(targets)))).agg(F.first("_value"))
    out = out.select(*by, *[F.col(str(i)).cast("double").alias(n) for i, n in enumerate(names)])
    # groups with no value at all still get a row (of nulls)
    if by:
        return stats.select(*by).join(out, by, "left")
    row = out.first()
    return df.sparkSession.createDataFrame([tuple(row[n] if row else None for n in names)],
                                           ", ".join(f"{n} double" for n in names))
