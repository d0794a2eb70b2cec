"""One ingest → validate → decide → clean → train → promote → audit cycle over
stored tables, composed from the operators (the reference's scheduled run as a
Spark job over every document that landed since the last cycle).

Tables of the :class:`~tidemark.store.runs.Store` (folders of ``run=<k>``):

    files/           landed documents taken in by the run (S4)
    quarantine/      corrupt documents and refused records with their reason (S4)
    raw/             partitionBy(batch_number): typed columns, the whole record as received, row_hash (S5)
    index-*/         hash index of the raw rows (J1, S13)
    ledger/          one row per landed batch (S3)
    history_sums/    per-batch (sum, count) of the drift columns (W3 state)
    first_seen/      (column, value, first_batch) (W4 state)
    dictionary/      (column, value, code), append-only codes (J3)
    clean/           partitionBy(split): encoded, imputed rows (S7)
    gram/            per batch the sums from which ridge is solved (M1 state)
    processed/       (batch_number, row_hash) rows that were cleaned (S6)
    experiments/     one row per candidate: params, metrics, decision (S14)
    champions/       (version, run_id, mae, rmse, logged_at) promoted models
    models/<v>/      stored PipelineModels
    audit/           one row per landed batch (S9)
    commits/         one row per finished run

A run writes only its own partitions and is visible by its commit, which is
written last.  A run that was broken anywhere is done again under the same
number over the same partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import decision as DEC
from tidemark.operators import drift as D
from tidemark.operators import events as EV
from tidemark.operators import features as FE
from tidemark.operators import gram as GR
from tidemark.operators import ingest as IG
from tidemark.operators import metrics as ME
from tidemark.operators import promotion as PR
from tidemark.operators import quality as Q
from tidemark.operators import training as TR
from tidemark.session import cut_lineage
from tidemark.sources.fixtures import RECORD_COLUMNS
from tidemark.store.hash_index import HashIndex
from tidemark.store.runs import Store

__all__ = ["Store", "run_cycle", "training_rows"]


def run_cycle(spark: SparkSession, landing: str, store: Store, code_commit: str | None = None,
              candidates: tuple[str, ...] = ("ridge",)) -> DataFrame:
    """Process every document that no committed run has taken in; returns the audit rows written."""
    before = store.committed(spark)
    run = before + 1
    nothing = spark.createDataFrame([], EV.AUDIT_SCHEMA)

    # Only documents not taken in yet are opened; what cannot be read is recorded once, with its reason
    files = cut_lineage(IG.landed_files(spark, landing, store.read(spark, "files", before)))
    paths = [r["file"] for r in files.select("file").collect()]  # the reader needs their names anyway
    if not paths:
        return nothing
    landed = IG.read_landed(spark, paths)
    store.write(IG.quarantine(landed), "quarantine", run)
    landed = IG.accepted(landed)
    ledger = store.read(spark, "ledger", before)
    if ledger is not None:
        landed = landed.join(ledger.select("batch_number").distinct(), "batch_number", "left_anti")
    records = landed.where(F.col("payload").isNotNull()).select("batch_number", "day_used", "seq", "payload", "record.*")
    batches = cut_lineage(landed.select("batch_number").distinct())
    store.write(files, "files", run)
    if batches.isEmpty():
        store.commit(spark, run, "no new batch")
        return nothing

    # The whole record is hashed and kept; known hashes come from the index, not from the store
    index = HashIndex(store)
    prepared = IG.first_occurrence(IG.prepare_received(records), "row_hash", ("batch_number", "seq"))
    new = cut_lineage(index.unseen(prepared, "row_hash", run).drop("seq", "payload"))
    store.write(new, "raw", run, ["batch_number"])
    index.append(new, "row_hash", run)
    counts = landed.groupBy("batch_number", "day_used").agg(F.count("payload").alias("records_count"))
    store.write(counts.select(F.col("batch_number").cast("int"), "day_used", "records_count",
                              F.current_timestamp().alias("fetched_at"), F.lit("fetched").alias("status")), "ledger", run)

    # signals (Q1, Q2, Q3 from history tables, W2, A22) and the decision (Q4)
    typed = records.select("batch_number", *RECORD_COLUMNS)
    store.write(D.batch_sums(typed), "history_sums", run)
    store.write(D.fresh_categories(typed, store.read(spark, "first_seen", before)), "first_seen", run)
    decisions = cut_lineage(DEC.decide_training(_signals(spark, store, run, records, batches, new)))

    promotions = None
    if not decisions.where("should_train").isEmpty():
        promotions = _train_and_promote(spark, store, run, decisions, candidates, code_commit)
    store.write(EV.build_audit(decisions, promotions, code_commit=code_commit), "audit", run)
    store.commit(spark, run, f"{len(paths)} documents")
    return store.read(spark, "audit", run).where(F.col("run") == run).select(*EV.AUDIT_COLUMNS)


def _signals(spark: SparkSession, store: Store, run: int, records: DataFrame, batches: DataFrame, new: DataFrame) -> DataFrame:
    """Q7 of the landed batches, from this run's rows and the history tables."""
    raw_before = store.read(spark, "raw", run - 1)
    total_before = raw_before.count() if raw_before is not None else 0
    inserted = new.groupBy("batch_number").agg(F.count(F.lit(1)).alias("inserted_records"))
    schema = Q.validate_schema(Q.received_schema(records.select("batch_number", "payload")), batches=batches)
    quality = Q.validate_quality(IG.prepare_received(records).select("batch_number", *RECORD_COLUMNS, "row_hash"),
                                 hash_col="row_hash", batches=batches)
    drift = D.drift_from_tables(store.read(spark, "history_sums", run).drop("run"),
                                store.read(spark, "first_seen", run).drop("run")).join(batches, "batch_number")
    sig = (batches.join(inserted, "batch_number", "left").na.fill(0, ["inserted_records"])
           .join(quality.select("batch_number", F.col("valid").alias("quality_valid")), "batch_number", "left")
           .join(schema.select("batch_number", F.col("valid").alias("schema_valid"), "new_columns_count"), "batch_number", "left")
           .join(drift, "batch_number", "left"))
    sig = DEC.running_total(sig, "inserted_records").withColumn("total_records", F.col("total_records") + F.lit(total_before))
    sig = sig.withColumn("volume_share", DEC.volume_share(F.col("inserted_records"), F.col("total_records")))
    return sig.na.fill(0, ["new_columns_count", "new_categories_count"]).na.fill(False, ["drift_detected"])


def unprocessed_rows(spark: SparkSession, store: Store, run: int) -> DataFrame:
    """Raw rows up to ``run`` that no earlier run cleaned.  A cleaning run takes all rows stored before it, so they are those of the
    runs after the last one that cleaned: partitions, not an anti join over the store."""
    processed = store.read(spark, "processed", run - 1)
    last = 0 if processed is None else processed.agg(F.coalesce(F.max("run"), F.lit(0))).first()[0]
    return store.read(spark, "raw", run).where(F.col("run") > last)


def training_rows(spark: SparkSession, store: Store, run: int | None = None) -> DataFrame:
    """M4: every clean row of every run, with its split and its categories decoded (the models carry their own vocabulary)."""
    clean = store.read(spark, "clean", run)
    return FE.decode_versioned(clean, cut_lineage(store.read(spark, "dictionary", run).select("column", "value", "code")))


def _clean(spark: SparkSession, store: Store, run: int) -> bool:
    """F7 of the unprocessed rows with lasting codes (J3), S7 and S6; False if there is nothing to clean."""
    todo = cut_lineage(unprocessed_rows(spark, store, run).withColumn("_key", F.col("row_hash")))
    if todo.isEmpty():
        return False
    kept = cut_lineage(FE.clean_rows(todo.select("batch_number", *RECORD_COLUMNS, "_key")))  # cleaned once, used three times
    known = store.read(spark, "dictionary", run - 1)
    fresh = cut_lineage(FE.extend_dictionary(kept, None if known is None else known.select("column", "value", "code")))
    store.write(fresh, "dictionary", run)
    dictionary = fresh if known is None else known.select(*fresh.columns).unionByName(fresh)
    clean = FE.split_dataset(FE.encode_versioned(kept, dictionary), "_key", count_source=kept)
    store.write(clean.drop("_key"), "clean", run, ["split"])
    written = store.read(spark, "clean", run)
    if written is not None:  # of this run's training rows only
        train = written.where((F.col("run") == run) & (F.col("split") == "train"))
        states = store.read(spark, "gram", run - 1)
        first = states.select("shift").first() if states is not None else None
        store.write(GR.gram_state(train, shift=first["shift"] if first else GR.column_means(train)), "gram", run)
    store.write(todo.select("batch_number", "row_hash"), "processed", run)
    return True


def _train_and_promote(spark: SparkSession, store: Store, run: int, decisions: DataFrame, candidates, code_commit: str | None) -> DataFrame | None:
    """F7 on unprocessed rows (S6) → S7 → M4 on the whole clean table → S14, Q5 against the stored champion."""
    _clean(spark, store, run)
    if store.read(spark, "clean", run) is None:
        return None
    data = training_rows(spark, store, run)
    fitted, rows = {}, None
    if "ridge" in candidates:  # from the sums of all batches: no training row is read again
        ridge = GR.solve_ridge(GR.merge_states(store.read(spark, "gram", run)))
        if ridge is None:
            return None
        labels: dict[str, list[str]] = {}
        for r in store.read(spark, "dictionary", run).orderBy("column", "code").collect():  # a model carries its vocabulary
            labels.setdefault(r["column"], []).append(r["value"])
        fitted, rows = {"ridge": ridge.pipeline(labels)}, ridge.rows
    wide, models = TR.train_candidates(data, list(candidates), fitted=fitted, train_size=rows)
    if not models:
        return None
    wide = cut_lineage(wide)
    best = ME.best_candidate(wide.withColumn("_run", F.lit(1)), ["_run"]).first()
    champions = store.read(spark, "champions", run - 1)
    champ = champions.orderBy(F.desc("run")).first() if champions is not None else None
    version = str((champions.count() if champions is not None else 0) + 1)
    ids = F.concat(F.lit(f"run-{run}-"), F.col("candidate"))
    pair = None
    if best is not None:
        pair = spark.createDataFrame([(best["candidate"], float(best["val_mae"]), float(best["val_rmse"]),
                                       champ["mae"] if champ else None, champ["rmse"] if champ else None)],
                                     "best_model string, mae double, rmse double, champion_mae double, champion_rmse double")
    decided = PR.should_promote(pair).first() if pair is not None else None
    promote = bool(decided and decided["promote"])
    params = F.map_from_arrays(F.array(*[F.lit(k) for k in ("target", "features", "candidates", "reason")]),
                               F.array(F.lit(FE.TARGET), F.lit(",".join(FE.FEATURES)), F.lit(",".join(candidates)),
                                       F.lit(decided["reason"] if decided else "no candidate with metrics")))
    runs = EV.build_experiments(wide.withColumns({"run_id": ids, "best": F.col("candidate") == F.lit(best["candidate"] if best else None)}),
                                FE.batch_numbers_used(store.read(spark, "clean", run).select("batch_number")), params, code_commit, keep=("run_id", "best"))
    store.write(runs, "experiments", run)
    if promote:
        models[best["candidate"]].write().overwrite().save(f"{store.path('models')}/{version}")
        store.write(spark.createDataFrame([(version, f"run-{run}-{best['candidate']}", float(best["val_mae"]), float(best["val_rmse"]))],
                                          "version string, run_id string, mae double, rmse double").withColumn("logged_at", F.current_timestamp()), "champions", run)
    # the promotion applies to the newest batch that asked for training
    newest = decisions.where("should_train").agg(F.max("batch_number")).first()[0]
    return spark.createDataFrame(
        [(int(newest), promote, decided["reason"] if decided else "No valid candidate to compare; not promoted.", best["candidate"] if best else None,
          float(best["val_mae"]) if best else None, f"run-{run}-{best['candidate']}" if best else None, version if promote else None)],
        "batch_number int, promote boolean, reason string, best_model string, best_val_mae double, run_id string, version string")
