"""Training decision over all batches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.expr import fmt_fixed, row_hash
from tidemark.operators import drift as D
from tidemark.operators import quality as Q
from tidemark.session import cut_lineage
from tidemark.sources.fixtures import RECORD_COLUMNS

MIN_RECORDS = 1000
MIN_VOLUME_PCT = 0.10
MIN_NEW_CATEGORIES = 5
MIN_NEW_COLUMNS = 2


def running_total(per_batch: DataFrame, count_col: str = "inserted_records", by: str = "batch_number",
                  partition: Sequence[str] = ()) -> DataFrame:
    """Cumulative stored rows after each batch, over the per-batch table."""
    w = Window.partitionBy(*partition).orderBy(by).rowsBetween(Window.unboundedPreceding, 0)
    return per_batch.withColumn("total_records", F.sum(count_col).over(w).cast("bigint"))


def volume_share(inserted, total):
    """Inserted / total, 0 when total is 0."""
    return F.when(total > 0, inserted / total).otherwise(F.lit(0.0))


def decide_training(signals: DataFrame, min_volume_pct: float = MIN_VOLUME_PCT,
                    min_new_categories: int = MIN_NEW_CATEGORIES, min_new_columns: int = MIN_NEW_COLUMNS,
                    min_records: int = MIN_RECORDS, policy: str = "code") -> DataFrame:
    """Q4 as a ``when`` chain over the signals table.

    ``policy="code"``: volume below the threshold -> SKIP, otherwise TRAIN with the
    first matching reason (drift, new categories, new columns, volume).
    ``policy="documented"``: additionally SKIP on too few records or bad quality,
    and SKIP when no signal holds.
    """
    vol = F.col("volume_share")
    drift, ncat, ncol = F.col("drift_detected"), F.col("new_categories_count"), F.col("new_columns_count")
    code = (F.when(vol < min_volume_pct, F.lit("low_volume"))
            .when(drift, F.lit("drift"))
            .when(ncat >= min_new_categories, F.lit("new_categories"))
            .when(ncol >= min_new_columns, F.lit("new_columns"))
            .otherwise(F.lit("volume")))
    if policy == "documented":
        code = (F.when(F.col("total_records") < min_records, F.lit("insufficient_records"))
                .when(~F.col("quality_valid"), F.lit("bad_quality"))
                .when(drift, F.lit("drift")).when(vol >= min_volume_pct, F.lit("volume"))
                .when(ncat >= min_new_categories, F.lit("new_categories"))
                .when(ncol >= min_new_columns, F.lit("new_columns")).otherwise(F.lit("no_signal")))
    skip_codes = ["low_volume", "insufficient_records", "bad_quality", "no_signal"]
    reason = (F.when(F.col("reason_code") == "low_volume",
                     F.concat(F.lit("Insufficient new data volume: new share="), fmt_fixed(vol, 4),
                              F.lit(f" < min_volume_pct={min_volume_pct}.")))
              .when(F.col("reason_code") == "drift", F.lit("Drift detected in the numeric variables of the batch."))
              .when(F.col("reason_code") == "new_categories",
                    F.concat(F.lit("Enough new categories: new_categories_count="), ncat.cast("string"),
                             F.lit(f" >= min_new_categories={min_new_categories}.")))
              .when(F.col("reason_code") == "new_columns",
                    F.concat(F.lit("New columns in the schema: new_columns_count="), ncol.cast("string"),
                             F.lit(f" >= min_new_columns={min_new_columns}.")))
              .when(F.col("reason_code") == "volume",
                    F.concat(F.lit("Enough new data volume: new share="), fmt_fixed(vol, 4),
                             F.lit(f" >= min_volume_pct={min_volume_pct}.")))
              .when(F.col("reason_code") == "insufficient_records", F.lit("Insufficient records."))
              .when(F.col("reason_code") == "bad_quality", F.lit("Batch failed quality validation."))
              .otherwise(F.lit("No training signal.")))
    out = signals.withColumn("reason_code", code)
    return out.withColumns({
        "decision": F.when(F.col("reason_code").isin(*skip_codes), F.lit("SKIP")).otherwise(F.lit("TRAIN")),
        "reason": reason,
    }).withColumn("should_train", F.col("decision") == "TRAIN")


def batch_signals(raw: DataFrame, payload: DataFrame | None = None, by: str = "batch_number",
                  columns: Sequence[str] = RECORD_COLUMNS, hash_col: str | None = None,
                  batches: DataFrame | None = None) -> DataFrame:
    """Q7: one row per batch with every input of Q4, in few passes.

    * pass 1 — ``groupBy(batch)`` for the quality counters (A2-A5) and mean
      sums (A6), plus one ``groupBy(row_hash)`` giving each record's first
      batch (J1/W1 insert counts) and the batches holding it (distinct
      records per batch, hence A3 duplicates).
    * pass 2 — W4 first-seen categories (``groupBy(column, value)``).
    * pass 3 — Q1 over the landed JSON payload (when given; else the typed schema).
    All per-batch tables are tiny and joined on the batch number.
    """
    h = F.col(hash_col) if hash_col else row_hash(columns)
    # pass 1a: quality counters and mean sums per batch (map-side combined, tiny shuffle)
    per_batch = raw.groupBy(by).agg(*Q.quality_aggs(raw, columns), *D.sum_count_aggs(D.DRIFT_COLUMNS))
    # pass 1b: the only record-sized shuffle — one row per distinct record hash
    # with its first batch and the set of batches holding it (bounded by the
    # number of batches; copies collapse map-side, so a hash held by a third
    # of all rows is one partial-aggregate entry per task)
    # (an MD5 travels as its 16 bytes, any other hash as it is)
    short = F.when(F.regexp_like(h, F.lit("^[0-9a-f]{32}$")), F.unhex(h)).otherwise(F.concat(F.lit("t").cast("binary"), h.cast("binary")))
    per_hash = raw.select(by, short.alias("_h")).groupBy("_h").agg(
        F.min(by).alias("_first"), F.collect_set(by).alias("_in"))
    # one consumer of the hash aggregation: per batch, the distinct records it
    # holds and those it stored first (J1/W1 inserts)
    held = per_hash.select(F.explode("_in").alias(by), "_first")
    record_counts = held.groupBy(by).agg(F.count(F.lit(1)).alias("_distinct"),
                                         F.count_if(F.col(by) == F.col("_first")).alias("inserted_records"))
    per_batch = per_batch.join(record_counts, by, "left").withColumn(
        "duplicate_rows", F.col("records") - F.coalesce("_distinct", F.lit(0)))
    # one row per batch, read by three consumers: materialise it once so the
    # record-sized passes above run exactly once
    per_batch = cut_lineage(per_batch)
    quality = Q.quality_finish(per_batch, by, columns).select(
        by, "records", F.col("valid").alias("quality_valid"), "issues")
    inserted = per_batch.select(by, F.coalesce("inserted_records", F.lit(0)).alias("inserted_records"))
    drift = D.detect_drift(raw, by, sums=per_batch.select(by, *[c for c in per_batch.columns if c.startswith(("_sum_", "_cnt_"))]))
    if payload is not None:
        schema = Q.validate_schema(Q.received_schema(payload, by), by)
    else:
        schema = Q.validate_schema(Q.typed_received_schema(raw, by, columns), by)
    s = (quality.join(inserted, by, "left").na.fill(0, ["inserted_records"])
         .join(schema.select(by, F.col("valid").alias("schema_valid"), "new_columns_count"), by, "left")
         .join(drift, by, "left"))
    if batches is not None:
        s = batches.select(by).distinct().join(s, by, "left")
    s = running_total(s, "inserted_records", by)
    s = s.withColumn("volume_share", volume_share(F.col("inserted_records"), F.col("total_records")))
    return s.na.fill(0, ["new_columns_count", "new_categories_count"]).na.fill(False, ["drift_detected", "schema_valid"])
