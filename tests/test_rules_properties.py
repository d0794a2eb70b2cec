"""Property tests for the decision, promotion and drift rules: Hypothesis
generates cases, all cases run in ONE Spark job, and each result is compared
with an independent Python recomputation of the rule."""

import math

from hypothesis import HealthCheck, Phase, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.operators import decision as DEC
from tidemark.operators import drift as D
from tidemark.operators import promotion as PR

SETTINGS = settings(max_examples=25, deadline=None, phases=[Phase.explicit, Phase.generate], suppress_health_check=list(HealthCheck))

decision_case = st.tuples(
    st.one_of(st.sampled_from([0, 999, 1000, 1001, 2000]), st.integers(0, 5000)),
    st.integers(0, 5000), st.booleans(), st.booleans(),
    st.one_of(st.sampled_from([4, 5, 6]), st.integers(0, 20)), st.integers(0, 4))


def _expected_decision(total, inserted, drift, ncat, ncol):
    vol = inserted / total if total > 0 else 0.0
    if vol < 0.10:
        return "SKIP", "low_volume"
    if drift:
        return "TRAIN", "drift"
    if ncat >= 5:
        return "TRAIN", "new_categories"
    if ncol >= 2:
        return "TRAIN", "new_columns"
    return "TRAIN", "volume"


@SETTINGS
@given(st.lists(decision_case, min_size=50, max_size=60))
def test_decide_training_matches_rule(spark, cases):
    rows = []
    for i, (total, ins, drift, qv, ncat, ncol) in enumerate(cases):
        ins = min(ins, total)
        rows.append((i, total, ins, drift, qv, ncat, ncol))
    df = spark.createDataFrame(rows, "batch_number int, total_records bigint, inserted_records bigint, drift_detected boolean,"
                                     " quality_valid boolean, new_categories_count bigint, new_columns_count int")
    df = df.withColumn("volume_share", DEC.volume_share(F.col("inserted_records"), F.col("total_records")))
    got = {r.batch_number: (r.decision, r.reason_code) for r in DEC.decide_training(df).collect()}
    for i, total, ins, drift, qv, ncat, ncol in rows:
        assert got[i] == _expected_decision(total, ins, drift, ncat, ncol)


metrics = st.floats(1e-3, 1e6, allow_nan=False, allow_infinity=False)


@SETTINGS
@given(st.lists(st.tuples(metrics, metrics, st.one_of(st.none(), st.tuples(metrics, metrics))), min_size=50, max_size=60))
def test_should_promote_matches_rule(spark, cases):
    rows = [(i, m, r, c[0] if c else None, c[1] if c else None) for i, (m, r, c) in enumerate(cases)]
    # add threshold cases around 3 % / 1 % on a (100, 200) champion
    extra = [(97.0, 202.0), (97.01, 200.0), (96.99, 202.01), (90.0, 202.0), (100.0, 200.0)]
    rows += [(len(rows) + k, m, r, 100.0, 200.0) for k, (m, r) in enumerate(extra)]
    df = spark.createDataFrame(rows, "id int, mae double, rmse double, champion_mae double, champion_rmse double")
    got = {r.id: r.promote for r in PR.should_promote(df).collect()}
    for i, m, r, cm, cr in rows:
        exp = True if cm is None else (m <= cm * (1.0 - 0.03) and r <= cr * (1.0 + 0.01))
        assert got[i] == exp, (m, r, cm, cr)


@SETTINGS
@given(st.lists(st.tuples(st.floats(-1e6, 1e6), st.floats(1e-3, 1e6), st.booleans()), min_size=50, max_size=60))
def test_drift_threshold(spark, cases):
    rows = []
    for i, (new, hist, neg) in enumerate(cases):
        h = -hist if neg else hist
        rows.append((i, new, h))
    df = spark.createDataFrame(rows, "batch_number int, mean_price double, hist_price double")
    df = df.withColumns({"_hcnt_price": F.lit(1), "first_seen_count": F.lit(0), "hist_categories": F.lit(0)})
    got = {r.batch_number: r.drift_detected for r in D.drift_verdict(df, columns=["price"]).collect()}
    for i, new, h in rows:
        assert got[i] == (abs(new - h) / abs(h) > 0.1)


def test_change_pct_zero_baseline(spark):
    from tidemark.functions.expr import improvement_pct, worsening_pct
    df = spark.createDataFrame([(0.0, 0.0), (0.0, 1.0), (100.0, 97.0)], "b double, v double")
    r = df.select(improvement_pct("b", "v").alias("i"), worsening_pct("b", "v").alias("w")).collect()
    assert (r[0].i, r[0].w) == (0.0, 0.0)
    assert r[1].i == -math.inf and r[1].w == math.inf
    assert abs(r[2].i - 0.03) < 1e-12
