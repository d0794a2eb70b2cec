"""Values and ties on which rules differed from what they promise."""

from pyspark.sql import functions as F

from tidemark.functions.expr import to_double
from tidemark.operators.ingest import first_occurrence
from tidemark.operators.promotion import champion_fold, promote_mae_only, run_to_version


def test_to_double_takes_numbers_only(spark):
    values = ["5d", "7f", " 1.5 ", "-2e3", ".5", "3.", "inf", "nan", "x", "", None, "0x1F", "1 2"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string").select("i", to_double("v").alias("d")).orderBy("i")
    assert [r["d"] for r in df.collect()] == [None, None, 1.5, -2000.0, 0.5, 3.0, float("inf"), None, None, None, None, None, None]
    row = spark.range(1).select(to_double(F.lit(True)).alias("b"), to_double(F.lit(7)).alias("n"), to_double(F.lit(1.0e10)).alias("d")).first()
    assert tuple(row) == (None, 7.0, 1.0e10)


def test_versions_are_numbers(spark):
    runs = spark.createDataFrame([("a",), ("b",), ("c",)], "run_id string")
    versions = spark.createDataFrame([("a", "10"), ("a", "9"), ("b", "x"), ("b", "11"), ("c", None)], "run_id string, version string")
    assert {r["run_id"]: r["version"] for r in run_to_version(runs, versions).collect()} == {"a": "9", "b": "11", "c": None}


def test_champion_without_mae_is_kept(spark):
    pairs = spark.createDataFrame([(1, 5.0, None, None), (2, 5.0, None, 7), (3, 5.0, 0.0, 7), (4, 9.0, 10.0, 7), (5, 9.9, 10.0, 7)],
                                  "i int, mae double, champion_mae double, champion int")
    got = {r["i"]: r["promote"] for r in promote_mae_only(pairs, champion="champion").collect()}
    assert got == {1: True, 2: False, 3: True, 4: True, 5: False}


def test_run_without_metrics_is_never_promoted(spark):
    runs = spark.createDataFrame([("l", 1, None, None, True), ("l", 2, float("nan"), 1.0, True), ("l", 3, 5.0, 6.0, True), ("l", 4, None, 1.0, True)],
                                 "line string, batch_number int, mae double, rmse double, resolved boolean")
    assert {r["batch_number"]: r["promoted"] for r in champion_fold(runs).collect()} == {1: False, 2: False, 3: True, 4: False}


def test_first_occurrence_keeps_one_of_tied_rows(spark):
    rows = [("h", 1, 0), ("h", 1, 0), ("h", 2, 0), ("g", 2, 5)]
    kept = first_occurrence(spark.createDataFrame(rows, "row_hash string, batch_number int, seq int"))
    assert sorted(map(tuple, kept.collect())) == [("g", 2, 5), ("h", 1, 0)]
