"""Event tables: audit, experiment runs, inference log."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.expr import derive_error, derive_status, present_null, status_label, to_utc

AUDIT_COLUMNS = ["batch_number", "trained", "train_reason", "promoted", "promotion_reason", "best_model",
                 "best_val_mae", "run_id", "model_version", "code_commit", "logged_at"]

AUDIT_SCHEMA = T.StructType([
    T.StructField("batch_number", T.IntegerType()), T.StructField("trained", T.BooleanType()),
    T.StructField("train_reason", T.StringType()), T.StructField("promoted", T.BooleanType()),
    T.StructField("promotion_reason", T.StringType()), T.StructField("best_model", T.StringType()),
    T.StructField("best_val_mae", T.DoubleType()), T.StructField("run_id", T.StringType()),
    T.StructField("model_version", T.StringType()), T.StructField("code_commit", T.StringType()),
    T.StructField("logged_at", T.TimestampType()),
])

INFERENCE_SCHEMA = T.StructType([
    T.StructField("request_ts", T.TimestampType()), T.StructField("input_data", T.StringType()),
    T.StructField("prediction", T.DoubleType()), T.StructField("model_version", T.StringType()),
    T.StructField("status", T.StringType()), T.StructField("error", T.StringType()),
    T.StructField("latency_s", T.DoubleType()),
])


# ------------------------------------------------------------------- E1 -----
def build_audit(decisions: DataFrame, promotions: DataFrame | None, keys: Sequence[str] = ("batch_number",),
                code_commit: str | None = None, logged_at: Column | None = None) -> DataFrame:
    """Decision table (``should_train``, ``reason``) left-joined with the
    promotion table (``promote``, ``reason``, ``best_model``, ``best_val_mae``,
    ``run_id``, ``version``).

    Missing batch -> -1; empty model name -> null; skip branch -> all model
    fields null, promoted false, promotion reason ''.
    """
    d = decisions.select(*keys, F.col("should_train").alias("_trained"), F.col("reason").alias("_train_reason"),
                         *([logged_at.alias("_ts")] if logged_at is not None else []))
    j = d if promotions is None else d.join(
        promotions.select(*keys, F.col("promote").alias("_promote"), F.col("reason").alias("_preason"),
                          "best_model", "best_val_mae", F.col("run_id").alias("_run"), F.col("version").alias("_ver")),
        list(keys), "left")
    tr = F.coalesce(F.col("_trained"), F.lit(False))

    def model(c):
        return F.when(tr, c) if promotions is not None else F.lit(None)
    return j.select(
        *[k for k in keys if k != "batch_number"],
        F.coalesce(F.col("batch_number").cast("int"), F.lit(-1)).alias("batch_number"),
        tr.alias("trained"), F.coalesce("_train_reason", F.lit("")).alias("train_reason"),
        (tr & F.coalesce(model(F.col("_promote")), F.lit(False))).alias("promoted"),
        F.when(tr, F.coalesce(model(F.col("_preason")), F.lit(""))).otherwise(F.lit("")).alias("promotion_reason"),
        F.nullif(model(F.col("best_model")).cast("string"), F.lit("")).alias("best_model"),
        model(F.col("best_val_mae")).cast("double").alias("best_val_mae"),
        model(F.col("_run")).cast("string").alias("run_id"),
        model(F.col("_ver")).cast("string").alias("model_version"),
        F.lit(code_commit).cast("string").alias("code_commit"),
        (F.col("_ts") if logged_at is not None else F.current_timestamp()).alias("logged_at"))


def append_audit(rows: DataFrame, path: str) -> None:
    """Append; columns added later are merged into older files (mergeSchema on read)."""
    rows.write.mode("append").option("mergeSchema", "true").parquet(path)


def read_audit(spark, path: str) -> DataFrame:
    return spark.read.option("mergeSchema", "true").parquet(path)


def align_audit(old: DataFrame, new: DataFrame) -> DataFrame:
    """S9 migration: union an older audit table with newer rows, late columns null."""
    return old.unionByName(new, allowMissingColumns=True)


def scan_audit(audit: DataFrame) -> DataFrame:
    """The 11 audit columns, newest first."""
    return audit.select(*[c for c in AUDIT_COLUMNS if c in audit.columns]).orderBy(F.desc("logged_at"))


def history_summary(audit: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Rows, trained count, promoted count (null promoted -> false)."""
    return audit.groupBy(*by).agg(
        F.count(F.lit(1)).alias("total_batches"), F.count_if(F.coalesce("trained", F.lit(False))).alias("trained_count"),
        F.count_if(F.coalesce("promoted", F.lit(False))).alias("promoted_count"))


def history_view(audit: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """W5 + X15 + X16: display number (oldest = 1), status label, text placeholders."""
    w = Window.partitionBy(*by).orderBy("logged_at", "batch_number")
    out = audit.withColumn("display_number", F.row_number().over(w))
    out = out.withColumn("status_label", status_label("trained", "promoted"))
    for c in ("train_reason", "promotion_reason", "best_model", "run_id", "model_version", "code_commit"):
        out = out.withColumn(c, present_null(c))
    return out


# ------------------------------------------------------------------- E2 -----
def build_experiments(runs: DataFrame, batch_numbers: DataFrame, params: Column, code_commit: str | None = None,
                      keep: Sequence[str] = ()) -> DataFrame:
    """One row per candidate with batch numbers, params map, metrics
    map (NaN dropped, P10), commit and the further columns ``keep``.
    ``batch_numbers`` is a one-row A14 result."""
    metric_cols = [c for c in runs.columns if c.startswith(("val_", "test_", "train_size")) and c not in keep]
    metrics = F.map_from_arrays(F.array(*[F.lit(c) for c in metric_cols]),
                                F.array(*[F.col(c).cast("double") for c in metric_cols]))
    # P10: NaN metrics are not logged, and neither are metrics of an empty split (null)
    from tidemark.operators.metrics import drop_nan_metrics
    bn = batch_numbers.first()["batch_numbers"]  # one small scalar list per run
    return runs.withColumn("batch_numbers", F.array(*[F.lit(int(b)) for b in (bn or [])]).cast("array<int>")).select(
        *[c for c in ("line", "batch_number", "candidate") if c in runs.columns], *keep,
        "batch_numbers", F.array_join(F.transform("batch_numbers", lambda x: x.cast("string")), ",").alias("batch_numbers_text"),
        params.alias("params"), drop_nan_metrics(metrics).alias("metrics"), F.lit(code_commit).cast("string").alias("code_commit"))


# ------------------------------------------------------------------ E3/E4 ---
def normalise_inference(raw: DataFrame, tz: str | None = None) -> DataFrame:
    """UTC timestamps (X5), blank errors to null (X12), derived status and
    error invariants (X13).  Rows with an invalid status get ``valid=false``."""
    st = derive_status("status", "error")
    return raw.withColumns({
        "request_ts": to_utc("request_ts", tz),
        "status": st,
        "error": derive_error("status", "error"),
    }).withColumn("valid", F.col("status").isNotNull())


def events_to_json(df: DataFrame, kind: str) -> DataFrame:
    """One JSON text per event with its kind; timestamps as ISO-8601 with offset."""
    cols = [c for c in df.columns if c != "kind"]
    return df.select(F.lit(kind).alias("kind"), F.to_json(F.struct(*cols), {
        "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "ignoreNullFields": "false"}).alias("json"))


def events_from_json(df: DataFrame, schema: T.StructType, kind: str | None = None) -> DataFrame:
    """Parse back (generic dispatch: filter by kind, then the kind's schema)."""
    x = df if kind is None else df.where(F.col("kind") == kind)
    return x.select(F.from_json("json", schema, {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}).alias("e")).select("e.*")


def append_inference(events: DataFrame, path: str) -> None:
    """S11 batch form: append; a failed write raises only here, scoring output is already computed."""
    events.write.mode("append").parquet(path)
