"""Disk of the listings binding, scoring and whole received records (findings F4 to F6 of round 4)."""

import functools
import os
import shutil
import time

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tidemark.operators import ingest as IG
from tidemark.sources import fixtures as fx


def _rows(df):
    return sorted(map(str, df.collect()))


def _shuffles(spark):
    return spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker().shuffleStatuses().size()


def test_parts_of_the_listings_are_the_listings(spark):
    parts = fx.listing_parts(spark, SF_SMALL, part_bytes=20_000)
    assert 1 < len(parts) <= fx.MAX_PARTS and all(p.count() for p in parts)
    assert _rows(functools.reduce(lambda a, b: a.unionByName(b), parts)) == _rows(fx.listings(spark, SF_SMALL))


def test_written_parts_leave_no_shuffle_files(spark, tmpdir_fresh):
    rows = spark.range(1000).repartition(4, "id")
    before = _shuffles(spark)
    table = fx._write([rows.where("id < 500"), rows.where("id >= 500")], f"{tmpdir_fresh}/t", spark)
    assert sorted(r.id for r in table.collect()) == list(range(1000))
    until = time.time() + 20
    while _shuffles(spark) > before and time.time() < until:
        time.sleep(0.2)
    assert _shuffles(spark) <= before and spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "false") == "false"


def test_payload_formed_on_reading_is_the_stored_one(spark):
    assert _rows(fx.payload_rows(spark, SF_SMALL)) == _rows(fx.listings_payload(spark, SF_SMALL))


@pytest.mark.parametrize("name", ["M5_batch_score_status", "T6_score_stream", "P9_received_record"])
def test_no_copy_of_the_rows_beside_the_listings(spark, tmpdir_fresh, name):
    import __spark_entry__ as E
    sf = shutil.copytree(SF_SMALL, f"{tmpdir_fresh}/sf")  # another path: nothing stored yet
    base = spark.conf.get("spark.checkpoint.dir").removeprefix("file:")
    n = E.queries()[name](spark, sf).count()
    assert n == (80 if name.startswith("P9") else fx.listings_table(spark, sf).count())
    assert os.listdir(f"{base}/tidemark-tables/{fx._fingerprint(sf, fx._LISTING_SOURCES)}") == ["listings"]


def test_equal_sides_shuffle_sums_only_and_unequal_rows_are_found(spark):
    rows = spark.range(20_000).select(F.col("id"), F.concat(F.lit("r"), F.col("id") % 700).alias("text"))
    odd = rows.where("id <> 77").unionByName(rows.where("id = 5")).withColumn("text", F.expr("if(id = 9, 'other', text)"))
    both = rows.withColumn("_n", F.lit(1)).unionAll(rows.withColumn("_n", F.lit(-1)))
    assert IG.uneven_digests(both, ["id", "text"]).isEmpty()
    lost = IG.preservation_differences(rows, odd, ["id", "text"])
    assert sorted((r.id, r.text) for r in lost.collect()) == [(5, "r5"), (9, "other"), (9, "r9"), (77, "r77")]
    nulls = spark.createDataFrame([(None, "a"), (None, "a"), (1, None)], "id int, text string")
    assert IG.preservation_differences(nulls, nulls, ["id", "text"]).isEmpty()
    assert IG.preservation_differences(nulls, nulls.limit(2), ["id", "text"]).count() == 1
