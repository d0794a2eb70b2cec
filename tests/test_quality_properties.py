"""Schema and quality validation against an independent recomputation on
generated batches (absent keys, None, NaN, ints, floats, text)."""

import json
import math

from hypothesis import HealthCheck, Phase, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.operators import quality as Q
from tidemark.sources.fixtures import EXPECTED_SCHEMA

SETTINGS = settings(max_examples=5, deadline=None, phases=[Phase.explicit, Phase.generate], suppress_health_check=list(HealthCheck))
COLS = list(EXPECTED_SCHEMA)
value = st.one_of(st.none(), st.integers(-5, 5), st.floats(-100, 100, allow_nan=False), st.sampled_from(["a", "b", "12", ""]))
record = st.dictionaries(st.sampled_from(COLS + ["extra1"]), value, max_size=13)
batch = st.lists(record, min_size=1, max_size=12)


def _is_num(v):
    return isinstance(v, (int, float)) and not isinstance(v, bool)


def _expected_schema(records):
    recv = set().union(*[r.keys() for r in records])
    missing = sorted(set(COLS) - recv)
    extra = sorted(recv - set(COLS))
    mism = []
    for c in sorted(set(COLS) & recv):
        vals = [r[c] for r in records if c in r and r[c] is not None]
        if not vals:
            continue
        t = "number" if all(_is_num(v) for v in vals) else "string"
        if t != EXPECTED_SCHEMA[c]:
            mism.append(f"{c}: expected {EXPECTED_SCHEMA[c]}, got {t}")
    return not missing and not extra and not mism, missing, extra, mism


@SETTINGS
@given(st.lists(batch, min_size=40, max_size=50))
def test_validate_schema_matches_recomputation(spark, batches):
    rows = [(b, json.dumps(r)) for b, recs in enumerate(batches) for r in recs]
    df = spark.createDataFrame(rows, "batch_number int, payload string")
    got = {r.batch_number: r for r in Q.validate_schema(Q.received_schema(df)).collect()}
    for b, recs in enumerate(batches):
        valid, missing, extra, mism = _expected_schema(recs)
        g = got[b]
        assert (g.valid, g.missing_columns, g.extra_columns, g.type_mismatches) == (valid, missing, extra, mism)


def _to_float(v):
    if v is None or isinstance(v, bool):
        return None
    if isinstance(v, (int, float)):
        return None if (isinstance(v, float) and math.isnan(v)) else float(v)
    try:
        return float(str(v).strip())
    except ValueError:
        return None


num_or_null = st.one_of(st.none(), st.just(float("nan")), st.floats(-50, 50, allow_nan=False))
qrow = st.tuples(num_or_null, num_or_null, st.one_of(st.none(), st.sampled_from(["x", "y"])))


@SETTINGS
@given(st.lists(st.lists(qrow, min_size=1, max_size=12), min_size=40, max_size=50))
def test_validate_quality_matches_recomputation(spark, batches):
    rows = [(b, p, s, c) for b, recs in enumerate(batches) for (p, s, c) in recs]
    df = spark.createDataFrame(rows, "batch_number int, price double, size double, city string")
    got = {r.batch_number: r for r in Q.validate_quality(df, columns=["price", "size", "city"]).collect()}
    for b, recs in enumerate(batches):
        n = len(recs)

        def isnull(v):
            return v is None or (isinstance(v, float) and math.isnan(v))
        high = sorted(c for i, c in enumerate(["price", "size", "city"]) if sum(isnull(r[i]) for r in recs) / n > 0.5)
        nullp = sum(isnull(r[0]) for r in recs)
        invalid = sum(1 for r in recs if not isnull(r[0]) and _to_float(r[0]) is not None and _to_float(r[0]) <= 0)
        canon = {json.dumps(list(r)) for r in recs}  # the canonical record tells NaN from null, as the rule's own JSON text does
        dups = n - len(canon)
        valid = not (high or invalid > 0 or nullp / n > 0.3)
        g = got[b]
        assert (g.valid, g.high_null_columns, g.invalid_prices, g.duplicate_rows) == (valid, high, invalid, dups)
        assert abs(g.null_price_ratio - nullp / n) < 1e-12


def test_empty_batch_is_invalid(spark):
    df = spark.createDataFrame([(1, 5.0, "a")], "batch_number int, price double, city string")
    batches = spark.createDataFrame([(1,), (2,)], "batch_number int")
    got = {r.batch_number: r for r in Q.validate_quality(df, batches=batches).collect()}
    assert got[2].valid is False and got[2].issues == ["empty batch"]
    assert got[1].valid is True


@SETTINGS
@given(st.lists(st.lists(st.dictionaries(st.sampled_from(["price", "city", "bed"]),
                                         st.one_of(st.none(), st.integers(-3, 3), st.floats(-5, 5, allow_nan=False),
                                                   st.sampled_from(["x", "7", "-1", "abc"])), max_size=3),
                         min_size=1, max_size=10), min_size=40, max_size=50))
def test_validate_quality_payload_matches_dict_rule(spark, batches):
    rows = [(b, json.dumps(r)) for b, recs in enumerate(batches) for r in recs]
    df = spark.createDataFrame(rows, "batch_number int, payload string")
    got = {r.batch_number: r for r in Q.validate_quality_payload(df).collect()}
    for b, recs in enumerate(batches):
        n = len(recs)
        cols = sorted(set().union(*[r.keys() for r in recs]))
        high = [c for c in cols if sum(1 for r in recs if c not in r or r[c] is None) / n > 0.5]
        nullp = sum(1 for r in recs if "price" not in r or r["price"] is None)
        inv = sum(1 for r in recs if r.get("price") is not None and _to_float(r["price"]) is not None
                  and _to_float(r["price"]) <= 0)
        dups = n - len({json.dumps(r, sort_keys=True) for r in recs})
        g = got[b]
        assert (g.high_null_columns, g.invalid_prices, g.duplicate_rows) == (high, inv, dups), (recs, g)
        assert abs(g.null_price_ratio - nullp / n) < 1e-12
        assert g.valid == (not high and inv == 0 and nullp / n <= 0.3)
