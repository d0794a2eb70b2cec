"""Exact percentiles from mergeable per-batch sketches (A10, A11, P4 over history).

A batch leaves one small row of KLL sketches, made in one pass when it lands.
Merged, they bracket any percentile of any set of batches; the exact value then
takes one more pass over the rows, which counts what lies below the bracket and
groups what lies inside it.  The bracket comes from the sketch's error bound and
is checked against the exact counts: should a rank fall outside (which the bound
makes rare), it is widened and the pass repeated, so the value is always exact.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.expr import to_double
from tidemark.session import cut_lineage

SKETCH_K = 4000


def rank_error(k: int) -> float:
    """About the 99 % bound of a KLL sketch's normalised rank error (1.33 % at k = 200, falling as k ** -0.9), three times over."""
    return 3 * 0.0133 * (200 / k) ** 0.9


def sketch_state(rows: DataFrame, columns: Sequence[str], by: Sequence[str] = ("batch_number",), k: int = SKETCH_K) -> DataFrame:
    """One row a batch: for each column its number of values and their sketch (nulls, NaN and unparsed texts left out)."""
    x = rows.select(*by, *[to_double(c).alias(c) for c in columns])
    return x.groupBy(*by).agg(*[a for c in columns for a in (F.count(c).alias(f"n_{c}"), F.kll_sketch_agg_double(c, F.lit(k)).alias(f"sketch_{c}"))])


def merge_sketches(states: DataFrame, columns: Sequence[str], k: int = SKETCH_K) -> DataFrame:
    """The state of the union of disjoint batches."""
    return states.agg(*[a for c in columns for a in (F.sum(f"n_{c}").alias(f"n_{c}"), F.kll_merge_agg_double(f"sketch_{c}", F.lit(k)).alias(f"sketch_{c}"))])


def exact_from_sketches(rows: DataFrame, states: DataFrame, targets: Sequence[tuple[str, str, float]], k: int = SKETCH_K) -> DataFrame:
    """One row with the exact, linearly interpolated percentiles ``targets`` = [(name, column, q)] of ``rows``, whose batches ``states``
    describe; null for a column without values."""
    columns = list(dict.fromkeys(c for _, c, _ in targets))
    merged = cut_lineage(merge_sketches(states, columns, k))
    counts = merged.first()  # numbers and a few kilobytes a column
    n = {c: counts[f"n_{c}"] or 0 for c in columns}
    wanted = {i: (c, q * (n[c] - 1)) for i, (_, c, q) in enumerate(targets) if n[c]}
    found: dict[int, float] = {}
    error = rank_error(k)
    while len(found) < len(wanted):
        open_ = [i for i in wanted if i not in found]
        ends = []
        for i in open_:
            c, q = targets[i][1], targets[i][2]
            for e, sign in ((max(q - error, 0.0), "lo"), (min(q + error, 1.0), "hi")):
                ends.append(F.kll_sketch_get_quantile_double(F.col(f"sketch_{c}"), F.lit(float(e))).alias(f"{sign}{i}"))
        b = merged.select(*ends).first()
        # at the ends of the data there is nothing to cut off
        span = {i: (-math.inf if targets[i][2] - error <= 0 else b[f"lo{i}"], math.inf if targets[i][2] + error >= 1 else b[f"hi{i}"]) for i in open_}
        x = rows.select(*[to_double(targets[i][1]).alias(f"v{i}") for i in open_])
        # one pass: everything below the bracket is one key, everything above it goes
        items = F.array(*[F.struct(F.lit(i).alias("t"), F.col(f"v{i}").alias("v"), F.lit(span[i][0]).alias("lo"), F.lit(span[i][1]).alias("hi")) for i in open_])
        kept = x.select(F.explode(F.filter(items, lambda e: e["v"] <= e["hi"])).alias("e"))
        band = cut_lineage(kept.select(F.col("e.t").alias("t"), F.when(F.col("e.v") >= F.col("e.lo"), F.col("e.v")).alias("v")).groupBy("t", "v").agg(F.count(F.lit(1)).alias("c")))
        before = Window.partitionBy("t").orderBy(F.asc_nulls_first("v")).rowsBetween(Window.unboundedPreceding, 0)
        ranked = band.withColumn("upto", F.sum("c").over(before)).withColumn("start", F.col("upto") - F.col("c"))
        pos = F.create_map(*[p for i in open_ for p in (F.lit(i), F.lit(float(wanted[i][1])))])[F.col("t")]
        hit = lambda r: F.max(F.when((F.col("start") <= r) & (r < F.col("upto")), F.col("v")))
        picked = ranked.withColumn("pos", pos).groupBy("t").agg(hit(F.floor("pos")).alias("x0"), hit(F.ceil("pos")).alias("x1"), F.first("pos").alias("pos"))
        for r in picked.collect():  # one row a target
            if r["x0"] is not None and r["x1"] is not None:
                found[r["t"]] = r["x0"] + (r["x1"] - r["x0"]) * (r["pos"] - math.floor(r["pos"]))
        error *= 4
    return rows.sparkSession.createDataFrame([tuple(found.get(i) for i in range(len(targets)))], ", ".join(f"{name} double" for name, _, _ in targets))
