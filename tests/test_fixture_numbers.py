"""The FIXTURES sanity numbers (measured independently with DuckDB) at sf0.001."""

from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import SF_SMALL


def test_quality_and_drift_counts(spark):
    q2 = E.queries()["Q2_validate_quality"](spark, SF_SMALL)
    r = q2.agg(F.count_if(F.col("null_price_ratio") > 0.3).alias("np"), F.count_if(F.col("invalid_prices") > 0).alias("inv"),
               F.count_if(F.col("high_null_columns").contains("acre_lot")).alias("acre"),
               F.count_if(~F.col("valid")).alias("invalid")).first()
    assert (r.np, r.inv, r.acre, r.invalid) == (8, 15, 12, 30)
    s = E.queries()["Q7_batch_signals"](spark, SF_SMALL)
    r2 = s.agg(F.count_if("drift_detected").alias("drift"), F.count_if(F.col("volume_share") >= 0.1).alias("vol"),
               F.count_if((F.col("volume_share") >= 0.1) & F.col("drift_detected")).alias("both")).first()
    assert (r2.drift, r2.vol, r2.both) == (44, 9, 7)


def test_champion_fold_counts(spark):
    w = E.queries()["W7_champion_fold"](spark, SF_SMALL)
    r = w.agg(F.count(F.lit(1)).alias("runs"), F.count_if("promoted").alias("promoted"),
              F.count_if("blocked_by_rmse").alias("blocked")).first()
    assert (r.runs, r.promoted, r.blocked) == (388, 33, 3)


def test_clean_counts_and_median(spark):
    a10 = E.queries()["A10_median_fit"](spark, SF_SMALL).first()
    assert a10.median_bed == 25.0
    p99 = E.queries()["A11_p99"](spark, SF_SMALL).first().p99
    assert abs(p99 - 103824.6653) < 1e-4
