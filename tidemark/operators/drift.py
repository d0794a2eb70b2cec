"""Numeric drift and new categories over all batches.

History of batch *b* = all earlier batches.  Per-batch partial sums and the
first batch in which each category value appeared are small tables; the
expanding windows run over them, never over raw rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.expr import py_list, relative_change, to_double
from tidemark.store.runs import stored

DRIFT_COLUMNS = ["price", "house_size", "bed", "bath"]
CATEGORICAL_COLUMNS = ["status", "city", "state"]
DRIFT_THRESHOLD = 0.1
NEW_CATEGORY_MIN = 5


def sum_count_aggs(columns: Sequence[str]) -> list[Column]:
    """Per-batch (sum, count) of coerced non-null values: mergeable mean state."""
    out = []
    for c in columns:
        v = to_double(c)
        out += [F.sum(v).alias(f"_sum_{c}"), F.count(v).alias(f"_cnt_{c}")]
    return out


def batch_means(df: DataFrame, by: str = "batch_number", columns: Sequence[str] = DRIFT_COLUMNS) -> DataFrame:
    """Mean of coerced non-null values per batch; null when no value."""
    s = df.groupBy(by).agg(*sum_count_aggs(columns))
    return s.select(by, *[(F.col(f"_sum_{c}") / F.col(f"_cnt_{c}")).alias(f"mean_{c}") for c in columns])


def expanding_means(sums: DataFrame, by: str = "batch_number", columns: Sequence[str] = DRIFT_COLUMNS,
                    partition: Sequence[str] = ()) -> DataFrame:
    """Mean over all *earlier* batches from the per-batch (sum, count) table.

    The window runs over one row per batch (per ``partition``), not over rows.
    """
    w = Window.partitionBy(*partition).orderBy(by).rowsBetween(Window.unboundedPreceding, -1)
    cols = []
    for c in columns:
        hs, hc = F.sum(f"_sum_{c}").over(w), F.sum(f"_cnt_{c}").over(w)
        cols += [F.when(hc > 0, hs / hc).alias(f"hist_{c}"), F.coalesce(hc, F.lit(0)).alias(f"_hcnt_{c}")]
    return sums.select(*partition, by, *cols,
                       *[(F.col(f"_sum_{c}") / F.col(f"_cnt_{c}")).alias(f"mean_{c}") for c in columns])


def hist_means(df: DataFrame, current, by: str = "batch_number", columns: Sequence[str] = DRIFT_COLUMNS) -> DataFrame:
    """Mean over rows whose batch is null-safe different from ``current``
    (an int or a Column, e.g. a scalar subquery)."""
    cur = current if isinstance(current, Column) else F.lit(current)
    h = df.where(~F.col(by).eqNullSafe(cur))
    return h.agg(*[F.avg(to_double(c)).alias(f"hist_{c}") for c in columns])


def category_values(df: DataFrame, by: str = "batch_number", columns: Sequence[str] = CATEGORICAL_COLUMNS) -> DataFrame:
    """Distinct non-null (batch, column, value)."""
    u = df.select(by, *[F.col(c).cast("string").alias(c) for c in columns]).unpivot(
        [by], list(columns), "column", "value")
    return u.where(F.col("value").isNotNull()).distinct()


def first_seen(df: DataFrame, by: str = "batch_number", columns: Sequence[str] = CATEGORICAL_COLUMNS) -> DataFrame:
    """First batch in which each (column, value) appeared.

    Map-side partial ``min`` collapses hot values before the shuffle.
    """
    u = df.select(by, *[F.col(c).cast("string").alias(c) for c in columns]).unpivot(
        [by], list(columns), "column", "value")
    return u.where(F.col("value").isNotNull()).groupBy("column", "value").agg(F.min(by).alias("first_batch"))


def batch_minus_history(df: DataFrame, by: str = "batch_number", columns: Sequence[str] = CATEGORICAL_COLUMNS) -> DataFrame:
    """U2 set form for every batch at once: its (column, value) set EXCEPT the
    values that appeared in an earlier batch (found by an equi-join on
    (column, value) with first-seen, never by pairing batches)."""
    vals = category_values(df, by, columns)
    seen_before = (vals.join(first_seen(df, by, columns), ["column", "value"])
                   .where(F.col("first_batch") < F.col(by)).select(by, "column", "value"))
    return vals.exceptAll(seen_before)


def category_diff(df: DataFrame, by: str = "batch_number", columns: Sequence[str] = CATEGORICAL_COLUMNS) -> DataFrame:
    """Per batch, values not seen in any earlier batch (exact set difference).

    Equi-join on (column, value) against first-seen, then keep values whose
    first appearance is this batch.
    """
    vals = category_values(df, by, columns)
    fs = first_seen(df, by, columns)
    return (vals.join(fs, ["column", "value"]).where(F.col("first_batch") >= F.col(by))
            .select(by, "column", "value"))


def new_category_counts(df: DataFrame, by: str = "batch_number", columns: Sequence[str] = CATEGORICAL_COLUMNS) -> DataFrame:
    """A9 via W4: per batch, number of (column, value) first seen there, and the
    number of distinct values known before it (for the no-history rule)."""
    fs = first_seen(df, by, columns).groupBy(F.col("first_batch").alias(by)).agg(F.count(F.lit(1)).alias("first_seen_count"))
    return fs


def drift_verdict(joined: DataFrame, by: str = "batch_number", columns: Sequence[str] = DRIFT_COLUMNS,
                  threshold: float = DRIFT_THRESHOLD, new_cat_min: int = NEW_CATEGORY_MIN) -> DataFrame:
    """Q3 from a per-batch table holding ``mean_c``, ``hist_c``, ``_hcnt_c``,
    ``first_seen_count`` (nullable) and ``hist_categories`` (count known before)."""
    drifted = F.filter(F.array(*[
        F.when(relative_change(F.col(f"mean_{c}"), F.col(f"hist_{c}")) > threshold, F.lit(c)) for c in sorted(columns)]),
        lambda x: x.isNotNull())
    has_hist = F.lit(False)
    for c in columns:
        has_hist = has_hist | (F.col(f"_hcnt_{c}") > 0)
    has_hist = has_hist | (F.col("hist_categories") > 0)
    newcats = F.when(has_hist, F.coalesce(F.col("first_seen_count"), F.lit(0))).otherwise(F.lit(0)).cast("bigint")
    out = joined.select(by, has_hist.alias("has_history"), F.when(has_hist, drifted).otherwise(
        F.array().cast("array<string>")).alias("drifted_columns"), newcats.alias("new_categories_count"))
    flag = F.when(F.col("new_categories_count") >= new_cat_min, F.lit("significant")).otherwise(F.lit("minor"))
    parts = F.filter(F.array(
        F.when(F.size("drifted_columns") > 0, F.concat(F.lit("numeric_drift: "), py_list("drifted_columns"))),
        F.when(F.col("new_categories_count") > 0, F.concat(F.lit("new_categories("), flag, F.lit("): "),
                                                            F.col("new_categories_count").cast("string")))),
        lambda x: x.isNotNull())
    details = (F.when(~F.col("has_history"), F.lit("no_history"))
               .when(F.size(parts) > 0, F.array_join(parts, "; ")).otherwise(F.lit("no_drift")))
    return out.select(by, (F.size("drifted_columns") > 0).alias("drift_detected"), "drifted_columns",
                      "new_categories_count", details.alias("drift_details"))


def detect_drift(df: DataFrame, by: str = "batch_number", drift_columns: Sequence[str] = DRIFT_COLUMNS,
                 categorical: Sequence[str] = CATEGORICAL_COLUMNS, threshold: float = DRIFT_THRESHOLD,
                 new_cat_min: int = NEW_CATEGORY_MIN, sums: DataFrame | None = None) -> DataFrame:
    """Q3 for every batch at once: A6 + W3 + W4 joined on batch.

    ``sums`` may carry precomputed per-batch (sum, count) columns (from the
    one-pass batch_signals aggregation) to avoid another scan.
    """
    if sums is None:
        sums = df.groupBy(by).agg(*sum_count_aggs(drift_columns))
    em = expanding_means(sums, by, drift_columns)
    nc = new_category_counts(df, by, categorical)
    j = em.join(nc, by, "left")
    w = Window.orderBy(by).rowsBetween(Window.unboundedPreceding, -1)
    j = j.withColumn("hist_categories", F.coalesce(F.sum(F.coalesce("first_seen_count", F.lit(0))).over(w), F.lit(0)))
    return drift_verdict(j, by, drift_columns, threshold, new_cat_min)


# ------------------------------------------------ incremental history -------
def update_history(new_rows: DataFrame, sums_path: str, first_seen_path: str, by: str = "batch_number",
                   drift_columns: Sequence[str] = DRIFT_COLUMNS,
                   categorical: Sequence[str] = CATEGORICAL_COLUMNS) -> None:
    """Keep the two small history tables current instead of re-scanning the
    raw store each run: per-batch ``(sum, count)`` of the drift columns, and
    the first batch of every ``(column, value)``.  Only the new rows are read;
    the category table gains only values it does not hold yet (``left_anti``).
    Re-running a batch is idempotent (its sums partition is overwritten).
    Batches are applied in batch order, as they land."""
    spark = new_rows.sparkSession
    sums = new_rows.groupBy(by).agg(*sum_count_aggs(drift_columns))
    (sums.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(by).parquet(sums_path))
    fresh_categories(new_rows, stored(spark, first_seen_path), by, categorical).write.mode("append").parquet(first_seen_path)


def batch_sums(rows: DataFrame, by: str = "batch_number", drift_columns: Sequence[str] = DRIFT_COLUMNS) -> DataFrame:
    """W3 state: per batch (sum, count) of the drift columns."""
    return rows.groupBy(by).agg(*sum_count_aggs(drift_columns))


def fresh_categories(rows: DataFrame, known: DataFrame | None, by: str = "batch_number",
                     categorical: Sequence[str] = CATEGORICAL_COLUMNS) -> DataFrame:
    """W4 state: (column, value, first_batch) of the values that ``known`` does not hold yet."""
    fresh = first_seen(rows, by, categorical)
    return fresh if known is None else fresh.join(known.select("column", "value"), ["column", "value"], "left_anti")


def drift_from_history(spark, sums_path: str, first_seen_path: str, by: str = "batch_number",
                       drift_columns: Sequence[str] = DRIFT_COLUMNS, threshold: float = DRIFT_THRESHOLD,
                       new_cat_min: int = NEW_CATEGORY_MIN) -> DataFrame:
    """Q3 for every stored batch from the history tables alone (no raw scan)."""
    return drift_from_tables(spark.read.parquet(sums_path), spark.read.parquet(first_seen_path), by, drift_columns, threshold, new_cat_min)


def drift_from_tables(sums: DataFrame, categories: DataFrame, by: str = "batch_number",
                      drift_columns: Sequence[str] = DRIFT_COLUMNS, threshold: float = DRIFT_THRESHOLD,
                      new_cat_min: int = NEW_CATEGORY_MIN) -> DataFrame:
    """Q3 from per-batch sums and first-seen categories."""
    em = expanding_means(sums, by, drift_columns)
    nc = categories.groupBy(F.col("first_batch").alias(by)).agg(F.count(F.lit(1)).alias("first_seen_count"))
    j = em.join(nc, by, "left")
    w = Window.orderBy(by).rowsBetween(Window.unboundedPreceding, -1)
    j = j.withColumn("hist_categories", F.coalesce(F.sum(F.coalesce("first_seen_count", F.lit(0))).over(w), F.lit(0)))
    return drift_verdict(j, by, drift_columns, threshold, new_cat_min)
