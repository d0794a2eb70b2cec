"""Two cycles over landed documents: ingest, signals, decision, clean, train, promote, audit."""

import json
import os

from pyspark.sql import functions as F

from conftest import SF_SMALL
from tidemark.plans.cycle import Store, run_cycle
from tidemark.sources import fixtures as fx


def _land(spark, folder, lo, hi):
    os.makedirs(folder, exist_ok=True)
    rows = (fx.listings_payload(spark, SF_SMALL).join(fx.listings_records(spark, SF_SMALL).select("listing_key", "day_used"),
                                                       "listing_key")
            .where(F.col("batch_number").between(lo, hi)).orderBy("listing_key").collect())
    docs = {}
    for r in rows:
        docs.setdefault((r.batch_number, r.day_used), []).append(json.loads(r.payload))
    for (b, day), recs in docs.items():
        with open(f"{folder}/batch_{b:03d}.json", "w") as f:
            json.dump({"batch_number": b, "day_used": day, "data": recs}, f)


def test_two_cycles(spark, tmpdir_fresh):
    landing, store = f"{tmpdir_fresh}/landing", Store(f"{tmpdir_fresh}/store")
    _land(spark, landing, 1, 6)
    a1 = {r.batch_number: r for r in run_cycle(spark, landing, store, code_commit="c1").collect()}
    assert sorted(a1) == [1, 2, 3, 4, 5, 6]
    assert a1[1].trained and a1[1].train_reason  # first batch: everything is new volume
    raw1 = spark.read.parquet(store.raw).count()
    _land(spark, landing, 7, 9)
    a2 = {r.batch_number: r for r in run_cycle(spark, landing, store, code_commit="c2").collect()}
    assert sorted(a2) == [7, 8, 9]  # only batches not in the ledger yet
    assert spark.read.parquet(store.raw).count() > raw1
    # replaying the same landing folder changes nothing
    assert run_cycle(spark, landing, store).count() == 0
    audit = spark.read.parquet(store.audit)
    assert audit.count() == 9
    assert audit.where("promoted").count() >= 1
    assert spark.read.parquet(store.champions).count() >= 1
    # every stored row was cleaned exactly once
    assert spark.read.parquet(store.processed).count() == spark.read.parquet(store.raw).count()
