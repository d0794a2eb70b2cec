"""DuckDB twins of the registered queries (the correctness gate).

Each text inlines the fixture bindings of ``tidemark.sources.fixtures`` as CTEs.
Conventions: arrays become delimited strings, doubles are rounded to 6 digits,
counts are BIGINT, every column aliased to the Spark name.
"""

from __future__ import annotations

from tidemark.sources.fixtures import (
    CANDIDATE_PREDICTIONS_SQL, DOCS_SQL, INFERENCE_LOG_SQL, LISTINGS_SQL, PAYLOAD_SQL, with_ctes)

PYLIST = "'[' || array_to_string(list_transform({x}, lambda v: '''' || v || ''''), ', ') || ']'"


def _pylist(x: str) -> str:
    return PYLIST.format(x=x)


_NULL_CNT = ",\n".join(
    f"count(*) FILTER (WHERE {c} IS NULL{' OR isnan(' + c + ')' if c not in ('status', 'city', 'state', 'prev_sold_date') else ''}) AS n_{c}"
    for c in ["acre_lot", "bath", "bed", "brokered_by", "city", "house_size", "prev_sold_date", "price", "state",
              "status", "street", "zip_code"])
_HIGH = "list_filter([" + ", ".join(
    f"CASE WHEN n_{c} / records > 0.5 THEN '{c}' END"
    for c in ["acre_lot", "bath", "bed", "brokered_by", "city", "house_size", "prev_sold_date", "price", "state",
              "status", "street", "zip_code"]) + "], lambda x: x IS NOT NULL)"
_ROW = "(brokered_by, status, price, bed, bath, acre_lot, street, city, state, zip_code, house_size, prev_sold_date)"

QUALITY_CTE = f"""
q_counts AS (
  SELECT batch_number, count(*) AS records, {_NULL_CNT},
         count(*) FILTER (WHERE price <= 0) AS invalid_prices,
         count(*) - count(DISTINCT {_ROW}) AS duplicate_rows
  FROM listings GROUP BY batch_number
),
q_high AS (SELECT *, {_HIGH} AS high, n_price / records AS null_price_ratio FROM q_counts),
quality AS (
  SELECT batch_number, records, high, duplicate_rows, invalid_prices, null_price_ratio,
         NOT (len(high) > 0 OR invalid_prices > 0 OR null_price_ratio > 0.3) AS valid,
         list_filter([
           CASE WHEN len(high) > 0 THEN 'High null rate in: ' || {_pylist('high')} END,
           CASE WHEN invalid_prices > 0 THEN CAST(invalid_prices AS VARCHAR) || ' records with invalid price' END,
           CASE WHEN null_price_ratio > 0.3 THEN 'More than 30% null prices ('
                || CAST(CAST(round_even(null_price_ratio * 100, 0) AS BIGINT) AS VARCHAR) || '%)' END,
           CASE WHEN duplicate_rows > 0 THEN CAST(duplicate_rows AS VARCHAR) || ' duplicate rows' END
         ], lambda x: x IS NOT NULL) AS issues
  FROM q_high
)"""

SCHEMA_CTE = """
expected AS (
  SELECT * FROM (VALUES ('brokered_by','number'),('status','string'),('price','number'),('bed','number'),
    ('bath','number'),('acre_lot','number'),('street','number'),('city','string'),('state','string'),
    ('zip_code','number'),('house_size','number'),('prev_sold_date','string')) t(key, expected)
),
kv AS (SELECT p.batch_number, j.key, j.type FROM payload p, json_each(p.payload) j),
recv AS (
  SELECT batch_number, key,
         CASE WHEN count(*) FILTER (WHERE type <> 'NULL') = 0 THEN NULL
              WHEN count(*) FILTER (WHERE type NOT IN ('NULL','UBIGINT','BIGINT','DOUBLE')) > 0 THEN 'string'
              ELSE 'number' END AS inferred
  FROM kv GROUP BY batch_number, key
),
sbatches AS (SELECT DISTINCT batch_number FROM payload),
s_missing AS (
  SELECT b.batch_number, list_sort(list(e.key) FILTER (WHERE r.key IS NULL)) AS missing
  FROM sbatches b CROSS JOIN expected e LEFT JOIN recv r ON r.batch_number = b.batch_number AND r.key = e.key
  GROUP BY b.batch_number
),
s_extra AS (
  SELECT r.batch_number, list_sort(list(r.key) FILTER (WHERE e.key IS NULL)) AS extra,
         list_sort(list(r.key || ': expected ' || e.expected || ', got ' || r.inferred)
                   FILTER (WHERE e.key IS NOT NULL AND r.inferred IS NOT NULL AND r.inferred <> e.expected)) AS mism
  FROM recv r LEFT JOIN expected e ON r.key = e.key GROUP BY r.batch_number
),
schema_v AS (
  SELECT m.batch_number, coalesce(missing, []) AS missing, coalesce(extra, []) AS extra, coalesce(mism, []) AS mism,
         (len(coalesce(missing, [])) = 0 AND len(coalesce(extra, [])) = 0 AND len(coalesce(mism, [])) = 0) AS valid
  FROM s_missing m JOIN s_extra x USING (batch_number)
)"""

DRIFT_CTE = """
d_sums AS (
  SELECT batch_number,
         sum(price) AS s_price, count(price) AS c_price, sum(house_size) AS s_house_size, count(house_size) AS c_house_size,
         sum(bed) AS s_bed, count(bed) AS c_bed, sum(bath) AS s_bath, count(bath) AS c_bath
  FROM listings GROUP BY batch_number
),
d_em AS (
  SELECT batch_number,
    s_price / c_price AS m_price, s_house_size / c_house_size AS m_house_size, s_bed / c_bed AS m_bed, s_bath / c_bath AS m_bath,
    sum(s_price) OVER w / sum(c_price) OVER w AS h_price, coalesce(sum(c_price) OVER w, 0) AS hc_price,
    sum(s_house_size) OVER w / sum(c_house_size) OVER w AS h_house_size, coalesce(sum(c_house_size) OVER w, 0) AS hc_house_size,
    sum(s_bed) OVER w / sum(c_bed) OVER w AS h_bed, coalesce(sum(c_bed) OVER w, 0) AS hc_bed,
    sum(s_bath) OVER w / sum(c_bath) OVER w AS h_bath, coalesce(sum(c_bath) OVER w, 0) AS hc_bath
  FROM d_sums WINDOW w AS (ORDER BY batch_number ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
),
d_vals AS (
  SELECT batch_number, 'status' AS col, status AS val FROM listings WHERE status IS NOT NULL
  UNION ALL SELECT batch_number, 'city', city FROM listings WHERE city IS NOT NULL
  UNION ALL SELECT batch_number, 'state', state FROM listings WHERE state IS NOT NULL
),
d_fs AS (SELECT col, val, min(batch_number) AS fb FROM d_vals GROUP BY col, val),
d_fsc AS (SELECT fb AS batch_number, count(*) AS n_first FROM d_fs GROUP BY fb),
d_j AS (
  SELECT e.*, f.n_first,
         coalesce(sum(coalesce(f.n_first, 0)) OVER (ORDER BY e.batch_number ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS hist_cats
  FROM d_em e LEFT JOIN d_fsc f USING (batch_number)
),
d_flags AS (
  SELECT batch_number,
         (hc_price > 0 OR hc_house_size > 0 OR hc_bed > 0 OR hc_bath > 0 OR hist_cats > 0) AS has_hist,
         list_filter([
           CASE WHEN h_bath <> 0 AND abs(m_bath - h_bath) / abs(h_bath) > 0.1 THEN 'bath' END,
           CASE WHEN h_bed <> 0 AND abs(m_bed - h_bed) / abs(h_bed) > 0.1 THEN 'bed' END,
           CASE WHEN h_house_size <> 0 AND abs(m_house_size - h_house_size) / abs(h_house_size) > 0.1 THEN 'house_size' END,
           CASE WHEN h_price <> 0 AND abs(m_price - h_price) / abs(h_price) > 0.1 THEN 'price' END
         ], lambda x: x IS NOT NULL) AS dcols,
         n_first
  FROM d_j
),
drift AS (
  SELECT batch_number, has_hist,
         CASE WHEN has_hist THEN dcols ELSE [] END AS drifted,
         CAST(CASE WHEN has_hist THEN coalesce(n_first, 0) ELSE 0 END AS BIGINT) AS ncat
  FROM d_flags
),
drift_v AS (
  SELECT batch_number, len(drifted) > 0 AS drift_detected, drifted, ncat,
         CASE WHEN NOT has_hist THEN 'no_history'
              WHEN len(drifted) = 0 AND ncat = 0 THEN 'no_drift'
              ELSE array_to_string(list_filter([
                 CASE WHEN len(drifted) > 0 THEN 'numeric_drift: ' || """ + _pylist("drifted") + """ END,
                 CASE WHEN ncat > 0 THEN 'new_categories(' || CASE WHEN ncat >= 5 THEN 'significant' ELSE 'minor' END
                      || '): ' || CAST(ncat AS VARCHAR) END], lambda x: x IS NOT NULL), '; ') END AS details
  FROM drift
)"""

SIGNALS_CTE = """
inserted AS (
  SELECT fb AS batch_number, count(*) AS inserted_records
  FROM (SELECT min(batch_number) AS fb FROM listings
        GROUP BY brokered_by, status, price, bed, bath, acre_lot, street, city, state, zip_code, house_size, prev_sold_date)
  GROUP BY fb
),
signals AS (
  SELECT q.batch_number, q.records, coalesce(i.inserted_records, 0) AS inserted_records,
         CAST(sum(coalesce(i.inserted_records, 0)) OVER (ORDER BY q.batch_number ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS total_records,
         q.valid AS quality_valid, s.valid AS schema_valid, CAST(len(s.extra) AS INTEGER) AS new_columns_count,
         d.drift_detected, d.ncat AS new_categories_count
  FROM quality q LEFT JOIN inserted i USING (batch_number) LEFT JOIN schema_v s USING (batch_number)
  LEFT JOIN drift_v d USING (batch_number)
),
sig2 AS (SELECT *, CASE WHEN total_records > 0 THEN inserted_records / total_records ELSE 0.0 END AS volume_share FROM signals),
decided AS (
  SELECT *, CASE WHEN volume_share < 0.1 THEN 'low_volume' WHEN drift_detected THEN 'drift'
                 WHEN new_categories_count >= 5 THEN 'new_categories' WHEN new_columns_count >= 2 THEN 'new_columns'
                 ELSE 'volume' END AS reason_code
  FROM sig2
)"""

DECISION_REASON = """CASE reason_code
  WHEN 'low_volume' THEN 'Insufficient new data volume: new share=' || printf('%.4f', volume_share) || ' < min_volume_pct=0.1.'
  WHEN 'drift' THEN 'Drift detected in the numeric variables of the batch.'
  WHEN 'new_categories' THEN 'Enough new categories: new_categories_count=' || CAST(new_categories_count AS VARCHAR) || ' >= min_new_categories=5.'
  WHEN 'new_columns' THEN 'New columns in the schema: new_columns_count=' || CAST(new_columns_count AS VARCHAR) || ' >= min_new_columns=2.'
  ELSE 'Enough new data volume: new share=' || printf('%.4f', volume_share) || ' >= min_volume_pct=0.1.' END"""

ORACLES: dict[str, str] = {}

ORACLES["Q1_validate_schema"] = with_ctes(LISTINGS_SQL, PAYLOAD_SQL, SCHEMA_CTE, body="""
SELECT batch_number, valid, array_to_string(missing, ',') AS missing_columns, array_to_string(extra, ',') AS extra_columns,
       array_to_string(mism, ',') AS type_mismatches, CAST(len(extra) AS INTEGER) AS new_columns_count
FROM schema_v""")

ORACLES["Q2_validate_quality"] = with_ctes(LISTINGS_SQL, QUALITY_CTE, body="""
SELECT batch_number, CAST(records AS BIGINT) AS records, valid, array_to_string(high, ',') AS high_null_columns,
       CAST(duplicate_rows AS BIGINT) AS duplicate_rows, CAST(invalid_prices AS BIGINT) AS invalid_prices,
       round(null_price_ratio, 6) AS null_price_ratio, array_to_string(issues, ' | ') AS issues
FROM quality""")

ORACLES["Q3_detect_drift"] = with_ctes(LISTINGS_SQL, DRIFT_CTE, body="""
SELECT batch_number, drift_detected, array_to_string(drifted, ',') AS drifted_columns, ncat AS new_categories_count,
       details AS drift_details
FROM drift_v""")

ORACLES["Q7_batch_signals"] = with_ctes(LISTINGS_SQL, PAYLOAD_SQL, QUALITY_CTE, SCHEMA_CTE, DRIFT_CTE, SIGNALS_CTE, body="""
SELECT batch_number, CAST(records AS BIGINT) AS records, CAST(inserted_records AS BIGINT) AS inserted_records, total_records,
       round(volume_share, 6) AS volume_share, quality_valid, schema_valid, new_columns_count, drift_detected,
       new_categories_count
FROM sig2""")

ORACLES["Q4_decide_training"] = with_ctes(LISTINGS_SQL, PAYLOAD_SQL, QUALITY_CTE, SCHEMA_CTE, DRIFT_CTE, SIGNALS_CTE, body=f"""
SELECT batch_number, round(volume_share, 6) AS volume_share, CASE WHEN reason_code = 'low_volume' THEN 'SKIP' ELSE 'TRAIN' END AS decision,
       reason_code, {DECISION_REASON} AS reason
FROM decided""")

# ------------------------------------------------------------ features ------
_NUMS = ["bed", "bath", "acre_lot", "house_size", "zip_code", "brokered_by", "street"]

CLEAN_CTE = """
clean0 AS (
  SELECT listing_key, batch_number, brokered_by, status, price, bed, bath, acre_lot, street, city, state, zip_code, house_size,
         CAST(coalesce(year(try_strptime(prev_sold_date, '%Y-%m-%d')), 0) AS INTEGER) AS prev_sold_year
  FROM listings WHERE price IS NOT NULL AND NOT isnan(price) AND price > 0
),
fit AS (SELECT """ + ", ".join(f"coalesce(quantile_cont({c}, 0.5), 0.0) AS m_{c}" for c in _NUMS) + """,
               quantile_cont(price, 0.99) AS p99 FROM clean0),
kept AS (
  SELECT c.listing_key, c.batch_number, c.status, c.price, c.city, c.state, c.prev_sold_year, """ + ", ".join(
    f"coalesce(c.{c}, f.m_{c}) AS {c}" for c in _NUMS) + """
  FROM clean0 c, fit f WHERE c.price <= f.p99
),
vocab AS (
  SELECT col, val, CAST(row_number() OVER (PARTITION BY col ORDER BY val) - 1 AS INTEGER) AS code FROM (
    SELECT DISTINCT 'status' AS col, status AS val FROM kept WHERE status IS NOT NULL
    UNION SELECT DISTINCT 'city', city FROM kept WHERE city IS NOT NULL
    UNION SELECT DISTINCT 'state', state FROM kept WHERE state IS NOT NULL)
),
oc AS (SELECT col, CAST(count(*) AS INTEGER) AS oc FROM vocab GROUP BY col),
enc AS (
  SELECT k.listing_key, k.batch_number, k.price, k.prev_sold_year, """ + ", ".join(f"k.{c}" for c in _NUMS) + """,
         CAST(coalesce(vs.code, (SELECT oc FROM oc WHERE col = 'status')) AS INTEGER) AS status,
         CAST(coalesce(vc.code, (SELECT oc FROM oc WHERE col = 'city')) AS INTEGER) AS city,
         CAST(coalesce(vt.code, (SELECT oc FROM oc WHERE col = 'state')) AS INTEGER) AS state
  FROM kept k
  LEFT JOIN vocab vs ON vs.col = 'status' AND vs.val = k.status
  LEFT JOIN vocab vc ON vc.col = 'city' AND vc.val = k.city
  LEFT JOIN vocab vt ON vt.col = 'state' AND vt.val = k.state
),
ranked AS (
  SELECT *, row_number() OVER (ORDER BY md5('42-' || listing_key), listing_key) - 1 AS rnk, count(*) OVER () AS n_all FROM enc
),
clean AS (
  SELECT * EXCLUDE (rnk, n_all),
         CASE WHEN rnk < floor(n_all * CAST(0.7 AS DOUBLE)) THEN 'train'
              WHEN rnk < floor(n_all * CAST(0.85 AS DOUBLE)) THEN 'val' ELSE 'test' END AS split
  FROM ranked
)"""

_CLEAN_COLS = ("listing_key, batch_number, round(price, 6) AS price, prev_sold_year, status, city, state, "
               + ", ".join(f"round({c}, 6) AS {c}" for c in _NUMS) + ", split")

ORACLES["F7_clean_pipeline"] = with_ctes(LISTINGS_SQL, CLEAN_CTE, body=f"SELECT {_CLEAN_COLS} FROM clean")
ORACLES["A10_median_fit"] = with_ctes(LISTINGS_SQL, CLEAN_CTE, body="SELECT " + ", ".join(
    f"round(m_{c}, 6) AS median_{c}" for c in _NUMS) + " FROM fit")
ORACLES["A11_p99"] = with_ctes(LISTINGS_SQL, CLEAN_CTE, body="SELECT round(p99, 6) AS p99 FROM fit")
ORACLES["P4_clip_p99"] = with_ctes(LISTINGS_SQL, CLEAN_CTE, body="SELECT listing_key, round(price, 6) AS price FROM kept")
ORACLES["P2_drop_null_target"] = with_ctes(LISTINGS_SQL, body="""
SELECT listing_key FROM listings WHERE price IS NOT NULL AND NOT isnan(price)""")
ORACLES["P3_positive_target"] = with_ctes(LISTINGS_SQL, body="""
SELECT listing_key, round(price, 6) AS price FROM listings WHERE price IS NOT NULL AND NOT isnan(price) AND price > 0""")
ORACLES["F1_fit_encoders"] = with_ctes(LISTINGS_SQL, CLEAN_CTE, body="""
SELECT col AS "column", val AS value, code FROM vocab
UNION ALL SELECT col, '<others>', oc FROM oc""")
ORACLES["O2_vocab_order"] = with_ctes(LISTINGS_SQL, CLEAN_CTE, body="""
SELECT col AS "column", val AS value, code FROM vocab""")
ORACLES["A23_split_sizes"] = with_ctes(LISTINGS_SQL, CLEAN_CTE, body="""
SELECT split, count(*) AS rows FROM clean GROUP BY split""")
ORACLES["A14_batch_numbers_used"] = with_ctes(LISTINGS_SQL, CLEAN_CTE, body="""
SELECT array_to_string(list_sort(list(DISTINCT batch_number)), ',') AS batch_numbers FROM clean WHERE batch_number IS NOT NULL""")
ORACLES["S8_scan_split"] = with_ctes(LISTINGS_SQL, CLEAN_CTE, body="""
SELECT listing_key, batch_number FROM clean WHERE split = 'val'""")
ORACLES["U3_concat_splits"] = with_ctes(LISTINGS_SQL, CLEAN_CTE, body="""
SELECT split, batch_number, count(*) AS rows FROM (
  SELECT * FROM clean WHERE split = 'train' UNION ALL SELECT * FROM clean WHERE split = 'val'
  UNION ALL SELECT * FROM clean WHERE split = 'test') GROUP BY split, batch_number""")
ORACLES["W6_global_rank"] = with_ctes(LISTINGS_SQL, body="""
SELECT listing_key, row_number() OVER (ORDER BY md5('42-' || listing_key), listing_key) - 1 AS rank FROM listings""")
ORACLES["F3_split_dataset"] = with_ctes(LISTINGS_SQL, body="""
SELECT listing_key, CASE WHEN rnk < floor(n_all * CAST(0.7 AS DOUBLE)) THEN 'train'
                         WHEN rnk < floor(n_all * CAST(0.85 AS DOUBLE)) THEN 'val' ELSE 'test' END AS split
FROM (SELECT listing_key, row_number() OVER (ORDER BY md5('42-' || listing_key), listing_key) - 1 AS rnk,
             count(*) OVER () AS n_all FROM listings)""")
HIST_VOCAB_CTE = """
hv AS (
  SELECT col, val, CAST(row_number() OVER (PARTITION BY col ORDER BY val) - 1 AS INTEGER) AS code FROM (
    SELECT DISTINCT 'status' AS col, status AS val FROM listings WHERE status IS NOT NULL AND batch_number <= 40
    UNION SELECT DISTINCT 'city', city FROM listings WHERE city IS NOT NULL AND batch_number <= 40
    UNION SELECT DISTINCT 'state', state FROM listings WHERE state IS NOT NULL AND batch_number <= 40)
),
hoc AS (SELECT col, CAST(count(*) AS INTEGER) AS oc FROM hv GROUP BY col),
henc AS (
  SELECT l.listing_key, l.batch_number,
       CAST(coalesce(vs.code, (SELECT oc FROM hoc WHERE col = 'status')) AS INTEGER) AS status,
       CAST(coalesce(vc.code, (SELECT oc FROM hoc WHERE col = 'city')) AS INTEGER) AS city,
       CAST(coalesce(vt.code, (SELECT oc FROM hoc WHERE col = 'state')) AS INTEGER) AS state
  FROM listings l
  LEFT JOIN hv vs ON vs.col = 'status' AND vs.val = l.status
  LEFT JOIN hv vc ON vc.col = 'city' AND vc.val = l.city
  LEFT JOIN hv vt ON vt.col = 'state' AND vt.val = l.state
)"""

ORACLES["J3_encode_lookup"] = with_ctes(LISTINGS_SQL, HIST_VOCAB_CTE, body="SELECT listing_key, status, city, state FROM henc")
ORACLES["F2_transform_encoders"] = ORACLES["J3_encode_lookup"]
ORACLES["P7_is_null"] = with_ctes(LISTINGS_SQL, body="""
SELECT """ + ",\n".join(
    f"count(*) FILTER (WHERE {c} IS NULL{' OR isnan(' + c + ')' if c not in ('status', 'city', 'state', 'prev_sold_date') else ''}) AS nulls_{c}"
    for c in ["brokered_by", "status", "price", "bed", "bath", "acre_lot", "street", "city", "state", "zip_code",
              "house_size", "prev_sold_date"]) + " FROM listings")
_FEATURES = ["brokered_by", "status", "bed", "bath", "acre_lot", "street", "city", "state", "zip_code", "house_size", "prev_sold_year"]
def _params_sql(source: str, prefix: str = "") -> str:
    """Names, texts and numbers of the parameters fitted on ``source``."""
    rows = [("categorical_columns", "'status,city,state'", "NULL"), ("numeric_columns", "'" + ",".join(_NUMS) + "'", "NULL"),
            ("split_train_frac", "NULL", "0.7"), ("split_val_frac", "NULL", "0.15"), ("split_test_frac", "NULL", "0.15"), ("random_state", "NULL", "42.0")]
    rows += [(f"impute_{c}_median", "NULL", f"(SELECT round(coalesce(quantile_cont({c}, 0.5), 0.0), 6) FROM {source})") for c in _NUMS]
    rows += [(f"encoder_{c}_{what}", "NULL", f"(SELECT CAST(count(DISTINCT {c}) AS DOUBLE) FROM {source})") for c in ("status", "city", "state") for what in ("n_categories", "others_code")]
    return " UNION ALL ".join(f"SELECT '{prefix}{n}' AS name, CAST({t} AS VARCHAR) AS text, CAST({v} AS DOUBLE) AS number" for n, t, v in rows)


FIT_CTE = """
fit_rows AS (SELECT * FROM listings WHERE price IS NOT NULL AND NOT isnan(price) AND price > 0 AND batch_number <= 40)"""
ORACLES["F4_fit_preprocessor"] = with_ctes(LISTINGS_SQL, FIT_CTE, body=_params_sql("fit_rows"))
ORACLES["X14_flatten_params"] = with_ctes(LISTINGS_SQL, FIT_CTE, body=_params_sql("fit_rows", "prep_"))
ORACLES["F6_capture_params"] = with_ctes(LISTINGS_SQL, CLEAN_CTE, body=_params_sql("kept"))
ORACLES["A10_sketch_percentiles"] = with_ctes(LISTINGS_SQL, CLEAN_CTE, body="SELECT " + ", ".join(
    f"(SELECT round(quantile_cont({c}, 0.5), 6) FROM clean0) AS median_{c}" for c in _NUMS) + ", (SELECT round(quantile_cont(price, 0.99), 6) FROM clean0) AS p99")
ORACLES["P5_fill_features"] = with_ctes(LISTINGS_SQL, HIST_VOCAB_CTE, body="SELECT l.listing_key, " + ", ".join(
    f"CASE WHEN CAST(l.zip_code AS BIGINT) % 4 IN ({i % 4}, {(i + 1) % 4}) THEN 0.0 ELSE "
    + (f"CAST(h.{c} AS DOUBLE)" if c in ("status", "city", "state") else
       "CAST(coalesce(year(try_strptime(l.prev_sold_date, '%Y-%m-%d')), 0) AS DOUBLE)" if c == "prev_sold_year" else f"round(coalesce(l.{c}, 0), 6)") + f" END AS {c}"
    for i, c in enumerate(_FEATURES)) + " FROM listings l JOIN henc h ON h.listing_key = l.listing_key")
ORACLES["X4_sold_year"] = with_ctes(LISTINGS_SQL, body="""
SELECT listing_key, CAST(coalesce(year(try_strptime(prev_sold_date, '%Y-%m-%d')), 0) AS INTEGER) AS prev_sold_year FROM listings""")
ORACLES["P6_feature_vector"] = with_ctes(LISTINGS_SQL, CLEAN_CTE, body="SELECT listing_key, " + ", ".join(
    f"round(CAST({c} AS DOUBLE), 6) AS f{i:02d}_{c}" for i, c in enumerate(
        ["brokered_by", "status", "bed", "bath", "acre_lot", "street", "city", "state", "zip_code", "house_size",
         "prev_sold_year"])) + " FROM clean")

# ------------------------------------------------- metrics & promotion ------
RUNS_CTE_T = """
metrics AS (
  SELECT line, batch_number, candidate, ordinal, split, count(*) AS n,
         avg(abs(predicted - actual)) AS mae, sqrt(avg((predicted - actual) * (predicted - actual))) AS rmse,
         CASE WHEN count(*) * var_pop(actual) <> 0
              THEN 1.0 - sum((predicted - actual) * (predicted - actual)) / (count(*) * var_pop(actual))
              WHEN sum((predicted - actual) * (predicted - actual)) = 0 THEN 1.0 ELSE 0.0 END AS r2
  FROM candidate_predictions GROUP BY line, batch_number, candidate, ordinal, split
),
wide AS (
  SELECT line, batch_number, candidate, ordinal,
         max(mae) FILTER (WHERE split = 'val') AS val_mae, max(rmse) FILTER (WHERE split = 'val') AS val_rmse
  FROM metrics GROUP BY line, batch_number, candidate, ordinal
),
run_metrics AS (
  SELECT line, batch_number, candidate, ordinal, avg(abs(predicted - actual)) AS mae,
         sqrt(avg((predicted - actual) * (predicted - actual))) AS rmse
  FROM candidate_predictions GROUP BY line, batch_number, candidate, ordinal
),
best AS (
  SELECT *, line || '-' || CAST(batch_number AS VARCHAR) || '-' || candidate AS run_id FROM (
    SELECT *, row_number() OVER (PARTITION BY line, batch_number ORDER BY mae, ordinal) AS rn
    FROM run_metrics WHERE mae IS NOT NULL AND NOT isnan(mae)) WHERE rn = 1
),
versions AS (
  SELECT run_id, version FROM (
    SELECT run_id, batch_number, CAST(row_number() OVER (PARTITION BY line ORDER BY batch_number, ordinal) AS VARCHAR) AS version
    FROM best) WHERE batch_number % 13 <> 0
),
runs AS (
  SELECT b.line, b.batch_number, b.mae AS mae, b.rmse AS rmse, {resolved} AS resolved,
         row_number() OVER (PARTITION BY b.line ORDER BY b.batch_number) AS rn
  FROM best b LEFT JOIN (SELECT run_id, arg_min(version, TRY_CAST(version AS BIGINT)) AS version FROM versions GROUP BY run_id) v USING (run_id)
  {where}
),
fold AS (
  WITH RECURSIVE f(line, rn, batch_number, mae, rmse, promoted, c_batch, c_mae, c_rmse, n_batch, n_mae, n_rmse) AS (
    SELECT line, rn, batch_number, mae, rmse, resolved, NULL::INTEGER, NULL::DOUBLE, NULL::DOUBLE,
           CASE WHEN resolved THEN batch_number END, CASE WHEN resolved THEN mae END, CASE WHEN resolved THEN rmse END
    FROM runs WHERE rn = 1
    UNION ALL
    SELECT r.line, r.rn, r.batch_number, r.mae, r.rmse, p.ok, f.n_batch, f.n_mae, f.n_rmse,
           CASE WHEN p.ok THEN r.batch_number ELSE f.n_batch END, CASE WHEN p.ok THEN r.mae ELSE f.n_mae END,
           CASE WHEN p.ok THEN r.rmse ELSE f.n_rmse END
    FROM f JOIN runs r ON r.line = f.line AND r.rn = f.rn + 1,
    LATERAL (SELECT r.resolved AND (f.n_mae IS NULL OR (r.mae <= f.n_mae * (1.0 - 0.03) AND r.rmse <= f.n_rmse * (1.0 + 0.01))) AS ok) p
  )
  SELECT line, batch_number, mae, rmse, promoted, c_batch AS champion_batch_number, c_mae AS champion_mae, c_rmse AS champion_rmse FROM f
)"""
RUNS_CTE = RUNS_CTE_T.format(where="", resolved="true")

_CH = "(champion_mae IS NOT NULL AND champion_rmse IS NOT NULL)"
_MAE_OK = "(mae <= champion_mae * (1.0 - 0.03))"
_RMSE_OK = "(rmse <= champion_rmse * (1.0 + 0.01))"
_MC = f"CASE WHEN {_CH} THEN CASE WHEN champion_mae = 0 THEN CASE WHEN mae = 0 THEN 0.0 ELSE '-inf'::DOUBLE END ELSE (champion_mae - mae) / champion_mae END END"
_RC = f"CASE WHEN {_CH} THEN CASE WHEN champion_rmse = 0 THEN CASE WHEN rmse = 0 THEN 0.0 ELSE 'inf'::DOUBLE END ELSE (rmse - champion_rmse) / champion_rmse END END"

ORACLES["A12_regression_metrics"] = with_ctes(CANDIDATE_PREDICTIONS_SQL, RUNS_CTE, body="""
SELECT line, batch_number, candidate, ordinal, split, n, round(mae, 6) AS mae, round(rmse, 6) AS rmse, round(r2, 6) AS r2 FROM metrics""")
ORACLES["A13_best_candidate"] = with_ctes(CANDIDATE_PREDICTIONS_SQL, RUNS_CTE, body="""
SELECT line, batch_number, candidate, round(mae, 2) AS mae, round(rmse, 2) AS rmse, run_id FROM best""")
ORACLES["J4_run_to_version"] = with_ctes(CANDIDATE_PREDICTIONS_SQL, RUNS_CTE, body="""
SELECT b.run_id, v.version FROM best b LEFT JOIN (SELECT run_id, arg_min(version, TRY_CAST(version AS BIGINT)) AS version FROM versions GROUP BY run_id) v USING (run_id)""")
ORACLES["W7_champion_fold"] = with_ctes(CANDIDATE_PREDICTIONS_SQL, RUNS_CTE, body=f"""
SELECT line, batch_number, promoted, CAST(champion_batch_number AS VARCHAR) AS champion_batch_number,
       round(champion_mae, 6) AS champion_mae,
       coalesce({_MAE_OK} AND NOT {_RMSE_OK}, false) AS blocked_by_rmse FROM fold""")
ORACLES["J5_candidate_vs_champion"] = with_ctes(CANDIDATE_PREDICTIONS_SQL, RUNS_CTE, body="""
SELECT line, batch_number, round(mae, 6) AS mae, round(rmse, 6) AS rmse, round(champion_mae, 6) AS champion_mae,
       round(champion_rmse, 6) AS champion_rmse FROM fold""")
Q5_CTE = f"""
q5 AS (
SELECT line, batch_number, promote, mc AS mae_change_pct, rc AS rmse_change_pct, reason_code, promoted,
       CASE WHEN NOT {_CH} THEN 'Promoted: first model (no previous champion).'
            WHEN mae_ok AND rmse_ok THEN 'Promoted: MAE improves ' || printf('%.2f', mc * 100) || '% (>= threshold 3.00%) and RMSE changes '
                 || printf('%.2f', rc * 100) || '% (<= threshold 1.00%).'
            ELSE 'Champion kept: ' || array_to_string(list_filter([
                   CASE WHEN NOT mae_ok THEN 'MAE improves ' || printf('%.2f', mc * 100) || '% (< threshold 3.00%)' END,
                   CASE WHEN NOT rmse_ok THEN 'RMSE worsens ' || printf('%.2f', rc * 100) || '% (> threshold 1.00%)' END],
                   lambda x: x IS NOT NULL), '; ') || '.' END AS reason
FROM (SELECT *, {_MC} AS mc, {_RC} AS rc, {_MAE_OK} AS mae_ok, {_RMSE_OK} AS rmse_ok,
             CASE WHEN mae IS NULL OR rmse IS NULL THEN false ELSE NOT {_CH} OR ({_MAE_OK} AND {_RMSE_OK}) END AS promote,
             CASE WHEN mae IS NULL OR rmse IS NULL THEN 'no_candidate' WHEN NOT {_CH} THEN 'first_model'
                  WHEN {_MAE_OK} AND {_RMSE_OK} THEN 'improved' WHEN NOT {_MAE_OK} AND NOT {_RMSE_OK} THEN 'mae_and_rmse'
                  WHEN NOT {_MAE_OK} THEN 'mae' ELSE 'rmse_guard' END AS reason_code
      FROM fold)
)"""
ORACLES["Q5_should_promote"] = with_ctes(CANDIDATE_PREDICTIONS_SQL, RUNS_CTE, Q5_CTE, body="""
SELECT line, batch_number, promote, round(mae_change_pct, 6) AS mae_change_pct, round(rmse_change_pct, 6) AS rmse_change_pct,
       reason_code, reason FROM q5""")
ORACLES["X8_change_pct"] = with_ctes(CANDIDATE_PREDICTIONS_SQL, RUNS_CTE, body=f"""
SELECT line, batch_number, round({_MC}, 6) AS mae_change_pct, round({_RC}, 6) AS rmse_change_pct FROM fold""")
ORACLES["Q6_promote_mae_only"] = with_ctes(CANDIDATE_PREDICTIONS_SQL, RUNS_CTE, body="""
SELECT line, batch_number,
       round(CASE WHEN NOT (champion_mae IS NULL OR champion_mae = 0) THEN (champion_mae - mae) / champion_mae END, 6) AS improvement,
       (champion_mae IS NULL OR champion_mae = 0) OR (champion_mae - mae) / champion_mae >= 0.03 AS promote
FROM fold""")
_HIST = """
SELECT line, candidate, bin, count(*) AS count, round(min(lo), 6) AS range_lo, round(min(hi), 6) AS range_hi FROM (
  SELECT line, candidate, lo, hi,
         CAST(CASE WHEN hi = lo THEN 0 ELSE least(floor((v - lo) / ((hi - lo) / {bins})), {bins} - 1) END AS INTEGER) AS bin{extra}
  FROM (SELECT *, {vexpr} AS v, {lo} OVER w AS lo, {hi} OVER w AS hi FROM candidate_predictions WHERE split = 'val'
        WINDOW w AS (PARTITION BY line, candidate)))
GROUP BY line, candidate, bin{extra_g}"""
ORACLES["A20_residual_histogram"] = with_ctes(CANDIDATE_PREDICTIONS_SQL, body=_HIST.format(
    bins=50, vexpr="predicted - actual", lo="min(predicted - actual)", hi="max(predicted - actual)", extra="", extra_g=""))
ORACLES["A24_actual_vs_predicted"] = with_ctes(CANDIDATE_PREDICTIONS_SQL, body="""
SELECT line, candidate, actual_bin, predicted_bin, count(*) AS count, round(min(lo), 6) AS range_lo, round(min(hi), 6) AS range_hi FROM (
  SELECT line, candidate, lo, hi,
         CAST(CASE WHEN hi = lo THEN 0 ELSE least(floor((actual - lo) / ((hi - lo) / 20)), 19) END AS INTEGER) AS actual_bin,
         CAST(CASE WHEN hi = lo THEN 0 ELSE least(floor((predicted - lo) / ((hi - lo) / 20)), 19) END AS INTEGER) AS predicted_bin
  FROM (SELECT *, least(min(actual) OVER w, min(predicted) OVER w) AS lo, greatest(max(actual) OVER w, max(predicted) OVER w) AS hi
        FROM candidate_predictions WHERE split = 'val' WINDOW w AS (PARTITION BY line, candidate)))
GROUP BY line, candidate, actual_bin, predicted_bin""")


# ------------------------------------------------------- audit history ------
AUDIT_CTE = """
audit AS (
  SELECT b.line, CAST(b.batch_number AS INTEGER) AS batch_number, (b.batch_number % 4 <> 0) AS trained,
         CASE WHEN b.batch_number % 4 <> 0 THEN 'train' ELSE 'skip' END AS train_reason,
         CASE WHEN b.batch_number % 4 <> 0 THEN coalesce(q.promoted, false) ELSE false END AS promoted,
         CASE WHEN b.batch_number % 4 <> 0 THEN coalesce(
              CASE WHEN q.promote AND NOT q.promoted THEN q.reason || ' (candidate version not found for run_id='
                   || b.run_id || '; champion alias unchanged)' ELSE q.reason END, '') ELSE '' END AS promotion_reason,
         CASE WHEN b.batch_number % 4 <> 0 THEN nullif(b.candidate, '') END AS best_model,
         CASE WHEN b.batch_number % 4 <> 0 THEN b.mae END AS best_val_mae,
         CASE WHEN b.batch_number % 4 <> 0 THEN b.run_id END AS run_id,
         CASE WHEN b.batch_number % 4 <> 0 THEN v.version END AS model_version,
         '0000000' AS code_commit,
         TIMESTAMP '2024-01-01 00:00:00' + to_seconds(b.batch_number * 300) AS logged_at
  FROM best b
  LEFT JOIN (SELECT run_id, arg_min(version, TRY_CAST(version AS BIGINT)) AS version FROM versions GROUP BY run_id) v USING (run_id)
  LEFT JOIN q5 q ON q.line = b.line AND q.batch_number = b.batch_number
)"""
_AUDIT_CTES = (CANDIDATE_PREDICTIONS_SQL, RUNS_CTE_T.format(where="WHERE b.batch_number % 4 <> 0",
                                                           resolved="v.version IS NOT NULL"), Q5_CTE, AUDIT_CTE)
_AUDIT_SEL = ("line, batch_number, trained, train_reason, promoted, promotion_reason, best_model, "
              "round(best_val_mae, 2) AS best_val_mae, run_id, model_version, code_commit, logged_at")
ORACLES["E1_build_audit"] = with_ctes(*_AUDIT_CTES, body=f"SELECT {_AUDIT_SEL} FROM audit")
ORACLES["S10_scan_audit"] = with_ctes(*_AUDIT_CTES, body=f"SELECT {_AUDIT_SEL.replace('line, ', '', 1)} FROM audit ORDER BY logged_at DESC")
ORACLES["O1_order_history"] = with_ctes(*_AUDIT_CTES, body="SELECT batch_number, logged_at FROM audit ORDER BY logged_at DESC")
ORACLES["S9_append_audit"] = with_ctes(*_AUDIT_CTES, body=f"""
SELECT line, batch_number, trained, train_reason, promoted, promotion_reason, best_model, round(best_val_mae, 2) AS best_val_mae,
       run_id, NULL::VARCHAR AS model_version, NULL::VARCHAR AS code_commit, logged_at FROM audit WHERE batch_number <= 40
UNION ALL SELECT {_AUDIT_SEL} FROM audit WHERE batch_number > 40""")
ORACLES["A15_history_summary"] = with_ctes(*_AUDIT_CTES, body="""
SELECT line, count(*) AS total_batches, count(*) FILTER (WHERE coalesce(trained, false)) AS trained_count,
       count(*) FILTER (WHERE coalesce(promoted, false)) AS promoted_count FROM audit GROUP BY line""")
ORACLES["W5_reverse_position"] = with_ctes(*_AUDIT_CTES, body="""
SELECT line, batch_number, CAST(row_number() OVER (PARTITION BY line ORDER BY logged_at, batch_number) AS INTEGER) AS display_number FROM audit""")
ORACLES["X15_status_label"] = with_ctes(*_AUDIT_CTES, body="""
SELECT line, batch_number, CASE WHEN coalesce(trained, false) AND coalesce(promoted, false) THEN 'trained_promoted'
                                WHEN coalesce(trained, false) THEN 'trained_not_promoted' ELSE 'skipped' END AS status_label FROM audit""")
ORACLES["X16_present_nulls"] = with_ctes(*_AUDIT_CTES, body="SELECT line, batch_number, " + ", ".join(
    f"coalesce(nullif(CAST({c} AS VARCHAR), ''), '—') AS {c}" for c in (
        "train_reason", "promotion_reason", "best_model", "run_id", "model_version")) + " FROM audit")
ORACLES["X17_join_batches"] = with_ctes(*_AUDIT_CTES, body="""
SELECT line, array_to_string(list_sort(list(DISTINCT batch_number)), ',') AS batch_numbers FROM audit WHERE trained GROUP BY line""")

# ------------------------------------------------------- inference log ------
LOG_CTE = """
log AS (
  SELECT event_id, request_ts, input_data, prediction, model_version, latency_s, st AS status,
         CASE WHEN st = 'error' THEN coalesce(CASE WHEN NOT regexp_matches(error, '^\\s*$') THEN error END, 'unknown error') END AS error,
         st IS NOT NULL AS valid
  FROM (SELECT *, CASE WHEN status IS NULL THEN CASE WHEN NOT regexp_matches(error, '^\\s*$') THEN 'error' ELSE 'ok' END
                       WHEN status IN ('ok', 'error') THEN status END AS st FROM inference_log)
),
bounds AS (SELECT * FROM (VALUES (0, 0.005::DOUBLE), (1, 0.01::DOUBLE), (2, 0.025::DOUBLE), (3, 0.05::DOUBLE), (4, 0.1::DOUBLE),
  (5, 0.25::DOUBLE), (6, 0.5::DOUBLE), (7, 1.0::DOUBLE), (8, 2.5::DOUBLE), (9, 5.0::DOUBLE), (10, 'inf'::DOUBLE)) t(bucket, le)),
buckets AS (
  SELECT model_version, bucket, le, count(*) FILTER (WHERE latency_s <= le) AS cum FROM log, bounds GROUP BY model_version, bucket, le
),
hb AS (
  SELECT *, coalesce(lag(le) OVER w, 0.0) AS prev_le, coalesce(lag(cum) OVER w, 0) AS prev_cum,
         max(cum) OVER (PARTITION BY model_version) AS n,
         max(CASE WHEN le <> 'inf'::DOUBLE THEN le END) OVER (PARTITION BY model_version) AS maxf
  FROM buckets WINDOW w AS (PARTITION BY model_version ORDER BY bucket)
),
hq AS (
  SELECT model_version, q, arg_min(CASE WHEN le = 'inf'::DOUBLE THEN maxf WHEN cum = prev_cum THEN le
                                        ELSE prev_le + (le - prev_le) * (q * n - prev_cum) / (cum - prev_cum) END, bucket) AS v
  FROM hb, (VALUES (0.5::DOUBLE), (0.95::DOUBLE), (0.99::DOUBLE)) qs(q)
  WHERE (cum >= q * n AND prev_cum < q * n) OR (bucket = 0 AND cum >= q * n)
  GROUP BY model_version, q
)"""
ORACLES["E3_normalise_inference"] = with_ctes(INFERENCE_LOG_SQL, LOG_CTE, body="""
SELECT event_id, request_ts, status, error, round(prediction, 6) AS prediction, model_version, round(latency_s, 6) AS latency_s, valid FROM log""")
ORACLES["X13_derive_status"] = with_ctes(INFERENCE_LOG_SQL, LOG_CTE, body="SELECT event_id, status, error FROM log")
ORACLES["X12_blank_to_null"] = with_ctes(INFERENCE_LOG_SQL, body="""
SELECT event_id, CASE WHEN NOT regexp_matches(error, '^\\s*$') THEN error END AS error FROM inference_log""")
ORACLES["X6_iso8601"] = with_ctes(INFERENCE_LOG_SQL, body="""
SELECT event_id, CASE WHEN epoch_us(request_ts) % 1000000 = 0 THEN strftime(request_ts, '%Y-%m-%dT%H:%M:%S') || '+00:00'
                      ELSE strftime(request_ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' END AS iso FROM inference_log""")
ORACLES["X5_to_utc"] = with_ctes(INFERENCE_LOG_SQL, body="SELECT event_id, request_ts FROM inference_log")
ORACLES["E4_events_to_json"] = with_ctes(INFERENCE_LOG_SQL, LOG_CTE, body="""
SELECT request_ts, input_data, round(prediction, 6) AS prediction, model_version, status, error, round(latency_s, 6) AS latency_s FROM log""")
ORACLES["A16_request_counters"] = with_ctes(INFERENCE_LOG_SQL, LOG_CTE, body="""
SELECT model_version, count(*) AS requests, count(*) FILTER (WHERE status = 'error') AS errors FROM log GROUP BY model_version""")
ORACLES["A17_latency_buckets"] = with_ctes(INFERENCE_LOG_SQL, LOG_CTE, body="""
SELECT model_version, CAST(bucket AS INTEGER) AS bucket, round(le, 6) AS le, cum FROM buckets""")
ORACLES["A18_histogram_quantile"] = with_ctes(INFERENCE_LOG_SQL, LOG_CTE, body="""
SELECT model_version, round(max(v) FILTER (WHERE q = 0.5), 6) AS p50, round(max(v) FILTER (WHERE q = 0.95), 6) AS p95,
       round(max(v) FILTER (WHERE q = 0.99), 6) AS p99 FROM hq GROUP BY model_version""")
ORACLES["A25_serving_status"] = with_ctes(INFERENCE_LOG_SQL, LOG_CTE, body="""
SELECT arg_max(model_version, request_ts) AS model_version, arg_max(model_version, request_ts) IS NOT NULL AS model_loaded,
       CASE WHEN arg_max(model_version, request_ts) IS NULL THEN 'degraded' ELSE 'healthy' END AS health FROM log""")
ORACLES["X9_status_code"] = with_ctes(LISTINGS_SQL, body="""
SELECT listing_key, CASE lower(trim(CASE WHEN status = 'A' THEN ' For_Sale ' WHEN status = 'N' THEN 'sold' ELSE status END))
  WHEN 'for_sale' THEN 0.0::DOUBLE WHEN 'ready_to_build' THEN 1.0::DOUBLE WHEN 'sold' THEN 2.0::DOUBLE ELSE -1.0::DOUBLE END AS status_code
FROM listings""")
ORACLES["X10_hash_bucket"] = with_ctes(LISTINGS_SQL, body="""
SELECT listing_key, CAST(('0x' || substr(md5(lower(trim(city))), 1, 8))::BIGINT % 10000 AS DOUBLE) AS city_bucket,
       CAST(('0x' || substr(md5(lower(trim(state))), 1, 8))::BIGINT % 1000 AS DOUBLE) AS state_bucket FROM listings""")


# ----------------------------------------------------------- contract ------
CONTRACT_CTE = """
contract AS (
  SELECT listing_key, batch_number, list_sort(list_filter([
CASE WHEN json_type(payload, '$.brokered_by') IS NULL THEN 'brokered_by: missing'
              WHEN json_type(payload, '$.brokered_by') = 'NULL' THEN 'brokered_by: null'
              WHEN NOT (json_type(payload, '$.brokered_by') IN ('UBIGINT', 'BIGINT', 'DOUBLE')
                        OR (json_type(payload, '$.brokered_by') = 'VARCHAR' AND TRY_CAST(json_extract_string(payload, '$.brokered_by') AS DOUBLE) IS NOT NULL))
              THEN 'brokered_by: invalid' END,
CASE WHEN json_type(payload, '$.bed') IS NULL THEN 'bed: missing'
              WHEN json_type(payload, '$.bed') = 'NULL' THEN 'bed: null'
              WHEN NOT (json_type(payload, '$.bed') IN ('UBIGINT', 'BIGINT', 'DOUBLE')
                        OR (json_type(payload, '$.bed') = 'VARCHAR' AND TRY_CAST(json_extract_string(payload, '$.bed') AS DOUBLE) IS NOT NULL))
              THEN 'bed: invalid' END,
CASE WHEN json_type(payload, '$.bath') IS NULL THEN 'bath: missing'
              WHEN json_type(payload, '$.bath') = 'NULL' THEN 'bath: null'
              WHEN NOT (json_type(payload, '$.bath') IN ('UBIGINT', 'BIGINT', 'DOUBLE')
                        OR (json_type(payload, '$.bath') = 'VARCHAR' AND TRY_CAST(json_extract_string(payload, '$.bath') AS DOUBLE) IS NOT NULL))
              THEN 'bath: invalid' END,
CASE WHEN json_type(payload, '$.acre_lot') IS NULL THEN 'acre_lot: missing'
              WHEN json_type(payload, '$.acre_lot') = 'NULL' THEN 'acre_lot: null'
              WHEN NOT (json_type(payload, '$.acre_lot') IN ('UBIGINT', 'BIGINT', 'DOUBLE')
                        OR (json_type(payload, '$.acre_lot') = 'VARCHAR' AND TRY_CAST(json_extract_string(payload, '$.acre_lot') AS DOUBLE) IS NOT NULL))
              THEN 'acre_lot: invalid' END,
CASE WHEN json_type(payload, '$.street') IS NULL THEN 'street: missing'
              WHEN json_type(payload, '$.street') = 'NULL' THEN 'street: null'
              WHEN NOT (json_type(payload, '$.street') IN ('UBIGINT', 'BIGINT', 'DOUBLE')
                        OR (json_type(payload, '$.street') = 'VARCHAR' AND TRY_CAST(json_extract_string(payload, '$.street') AS DOUBLE) IS NOT NULL))
              THEN 'street: invalid' END,
CASE WHEN json_type(payload, '$.zip_code') IS NULL THEN 'zip_code: missing'
              WHEN json_type(payload, '$.zip_code') = 'NULL' THEN 'zip_code: null'
              WHEN NOT (json_type(payload, '$.zip_code') IN ('UBIGINT', 'BIGINT', 'DOUBLE')
                        OR (json_type(payload, '$.zip_code') = 'VARCHAR' AND TRY_CAST(json_extract_string(payload, '$.zip_code') AS DOUBLE) IS NOT NULL))
              THEN 'zip_code: invalid' END,
CASE WHEN json_type(payload, '$.house_size') IS NULL THEN 'house_size: missing'
              WHEN json_type(payload, '$.house_size') = 'NULL' THEN 'house_size: null'
              WHEN NOT (json_type(payload, '$.house_size') IN ('UBIGINT', 'BIGINT', 'DOUBLE')
                        OR (json_type(payload, '$.house_size') = 'VARCHAR' AND TRY_CAST(json_extract_string(payload, '$.house_size') AS DOUBLE) IS NOT NULL))
              THEN 'house_size: invalid' END,
CASE WHEN json_type(payload, '$.status') IS NULL THEN 'status: missing'
              WHEN json_type(payload, '$.status') = 'NULL' THEN 'status: null'
              WHEN json_type(payload, '$.status') <> 'VARCHAR' THEN 'status: invalid' END,
CASE WHEN json_type(payload, '$.city') IS NULL THEN 'city: missing'
              WHEN json_type(payload, '$.city') = 'NULL' THEN 'city: null'
              WHEN json_type(payload, '$.city') <> 'VARCHAR' THEN 'city: invalid' END,
CASE WHEN json_type(payload, '$.state') IS NULL THEN 'state: missing'
              WHEN json_type(payload, '$.state') = 'NULL' THEN 'state: null'
              WHEN json_type(payload, '$.state') <> 'VARCHAR' THEN 'state: invalid' END,
CASE WHEN json_type(payload, '$.prev_sold_year') IS NOT NULL AND json_type(payload, '$.prev_sold_year') <> 'NULL'
              AND json_type(payload, '$.prev_sold_year') NOT IN ('UBIGINT', 'BIGINT', 'DOUBLE')
              AND NOT (json_type(payload, '$.prev_sold_year') = 'VARCHAR' AND TRY_CAST(json_extract_string(payload, '$.prev_sold_year') AS DOUBLE) IS NOT NULL)
              THEN 'prev_sold_year: invalid' END
  ], lambda x: x IS NOT NULL)) AS errors FROM payload
)"""
ORACLES["P8_request_contract"] = with_ctes(LISTINGS_SQL, PAYLOAD_SQL, CONTRACT_CTE, body="""
SELECT listing_key, len(errors) = 0 AS valid, array_to_string(errors, '; ') AS errors FROM contract""")
ORACLES["M5_batch_score_status"] = with_ctes(LISTINGS_SQL, PAYLOAD_SQL, CONTRACT_CTE, body="""
SELECT listing_key, CASE WHEN len(errors) = 0 THEN 'ok' ELSE 'error' END AS status, '1' AS model_version,
       CASE WHEN len(errors) > 0 THEN array_to_string(errors, '; ') END AS error FROM contract""")


# ------------------------------------------------------------ streaming -----
WINDOWS_CTE = """
win AS (
  SELECT time_bucket(INTERVAL 1 MINUTE, request_ts) - k * INTERVAL 1 MINUTE AS window_start, status, latency_s
  FROM log, range(0, 5) t(k)
),
wagg AS (
  SELECT window_start, window_start + INTERVAL 5 MINUTE AS window_end, count(*) AS requests,
         count(*) FILTER (WHERE status = 'error') AS errors FROM win GROUP BY window_start
)"""
ORACLES["T1_request_rate"] = with_ctes(INFERENCE_LOG_SQL, LOG_CTE, WINDOWS_CTE, body="""
SELECT window_start, window_end, requests, round(requests / 300.0, 6) AS request_rate FROM wagg""")
ORACLES["T2_error_rate"] = with_ctes(INFERENCE_LOG_SQL, LOG_CTE, WINDOWS_CTE, body="""
SELECT window_start, window_end, errors, round(errors / 300.0, 6) AS error_rate FROM wagg""")
ORACLES["T3_latency_quantiles"] = with_ctes(INFERENCE_LOG_SQL, LOG_CTE, WINDOWS_CTE, body="""
, wb AS (
  SELECT window_start, bucket, le, count(*) FILTER (WHERE latency_s <= le) AS cum FROM win, bounds GROUP BY window_start, bucket, le
), whb AS (
  SELECT *, coalesce(lag(le) OVER w, 0.0) AS prev_le, coalesce(lag(cum) OVER w, 0) AS prev_cum,
         max(cum) OVER (PARTITION BY window_start) AS n,
         max(CASE WHEN le <> 'inf'::DOUBLE THEN le END) OVER (PARTITION BY window_start) AS maxf
  FROM wb WINDOW w AS (PARTITION BY window_start ORDER BY bucket)
), whq AS (
  SELECT window_start, q, arg_min(CASE WHEN le = 'inf'::DOUBLE THEN maxf WHEN cum = prev_cum THEN le
                                       ELSE prev_le + (le - prev_le) * (q * n - prev_cum) / (cum - prev_cum) END, bucket) AS v
  FROM whb, (VALUES (0.5::DOUBLE), (0.95::DOUBLE), (0.99::DOUBLE)) qs(q)
  WHERE (cum >= q * n AND prev_cum < q * n) OR (bucket = 0 AND cum >= q * n)
  GROUP BY window_start, q
)
SELECT window_start, window_start + INTERVAL 5 MINUTE AS window_end, round(max(v) FILTER (WHERE q = 0.5), 6) AS p50,
       round(max(v) FILTER (WHERE q = 0.95), 6) AS p95, round(max(v) FILTER (WHERE q = 0.99), 6) AS p99
FROM whq GROUP BY window_start""".replace("\n, wb AS", ", wb AS", 1))
ORACLES["T4_current_version"] = with_ctes(INFERENCE_LOG_SQL, LOG_CTE, body="""
SELECT status, arg_max(model_version, request_ts) AS model_version, arg_max(model_version, request_ts) IS NOT NULL AS model_loaded,
       CASE WHEN arg_max(model_version, request_ts) IS NULL THEN 'degraded' ELSE 'healthy' END AS health FROM log GROUP BY status""")

# ------------------------------------------------------- ingest / docs ------
ORACLES["X1_row_hash"] = with_ctes(DOCS_SQL, body="SELECT doc_id, md5(text) AS row_hash FROM docs")
ORACLES["W1_first_occurrence"] = with_ctes(DOCS_SQL, body="""
SELECT doc_id, batch_number FROM (
  SELECT *, row_number() OVER (PARTITION BY md5(text) ORDER BY batch_number, doc_id) AS rn FROM docs) WHERE rn = 1""")
ORACLES["S13_known_hashes"] = with_ctes(DOCS_SQL, body="SELECT DISTINCT md5(text) AS row_hash FROM docs WHERE doc_id % 4 = 0")
ORACLES["J1_dedup_vs_store"] = with_ctes(DOCS_SQL, body="""
SELECT doc_id FROM docs d WHERE doc_id % 4 <> 0
  AND NOT EXISTS (SELECT 1 FROM docs k WHERE k.doc_id % 4 = 0 AND md5(k.text) = md5(d.text))""")
ORACLES["J1_hash_index"] = ORACLES["J1_dedup_vs_store"]
ORACLES["X1_received_hash"] = """
SELECT doc_id, md5('{"doc_id":' || doc_id || CASE WHEN doc_id % 3 = 0 THEN ',"extra":true' ELSE '' END || ',"lang":"' || lang || '","n_chars":'
  || CASE WHEN doc_id % 5 = 0 THEN '"' || n_chars || '"' ELSE CAST(n_chars AS VARCHAR) END || '}') AS row_hash FROM documents"""
ORACLES["P9_received_record"] = with_ctes(LISTINGS_SQL, body="""
SELECT batch_number, count(*) AS rows,
  CAST(count(*) * (12 - CASE WHEN batch_number % 9 = 0 THEN 1 ELSE 0 END + CASE WHEN batch_number % 10 = 0 THEN 2 ELSE 0 END) AS BIGINT) AS keys,
  CASE WHEN batch_number % 10 = 0 THEN count(_garage) ELSE 0 END AS with_garage,
  CASE WHEN batch_number % 12 = 0 THEN count(*) ELSE 0 END AS text_zip, CAST(0 AS BIGINT) AS violations
FROM listings GROUP BY batch_number""")
ORACLES["A3_duplicate_rows"] = with_ctes(DOCS_SQL, body="""
SELECT batch_number, count(*) - count(DISTINCT md5(text)) AS duplicate_rows FROM docs GROUP BY batch_number""")
ORACLES["T7_ingest_stream"] = with_ctes(DOCS_SQL, body="""
SELECT fb AS batch_number, count(*) AS inserted_records FROM (SELECT min(batch_number) AS fb FROM docs GROUP BY md5(text)) GROUP BY fb""")
LEDGER_CTE = """
ledger AS (
  SELECT batch_number, day_used, count(*) AS records_count, 'fetched' AS status,
         TIMESTAMP '2024-01-01 00:00:00' + to_seconds(batch_number * 300) AS fetched_at
  FROM listings GROUP BY batch_number, day_used
  UNION ALL SELECT -1, NULL, 0, 'exhausted', TIMESTAMP '2024-01-01 00:00:00' + to_seconds(81 * 300)
),
prefixes AS (
  SELECT count(*) OVER (ORDER BY fetched_at ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS batch_index, status FROM ledger
)"""
ORACLES["S3_batch_ledger"] = with_ctes(LISTINGS_SQL, LEDGER_CTE, body="""
SELECT CAST(batch_number AS INTEGER) AS batch_number, day_used, records_count, status, fetched_at FROM ledger""")
ORACLES["S1_next_batch"] = with_ctes(LISTINGS_SQL, LEDGER_CTE, body="""
SELECT batch_index, CASE WHEN batch_index >= 0 AND batch_index < 7
  THEN (['Monday','Tuesday','Wednesday','Thursday','Friday','Saturday','Sunday'])[batch_index + 1] END AS next_day,
  batch_index >= 7 OR status = 'exhausted' AS exhausted FROM prefixes""")
ORACLES["S2_exhausted"] = with_ctes(LISTINGS_SQL, LEDGER_CTE, body="""
SELECT batch_index, batch_index >= 7 OR status = 'exhausted' AS exhausted FROM prefixes""")
_REC = "brokered_by, status, price, bed, bath, acre_lot, street, city, state, zip_code, house_size, prev_sold_date"
ORACLES["S5_append_raw"] = with_ctes(LISTINGS_SQL, body=f"""
SELECT listing_key, batch_number, day_used, false AS processed FROM (
  SELECT *, row_number() OVER (PARTITION BY {_REC} ORDER BY batch_number, listing_key) AS rn FROM listings) WHERE rn = 1""")
ORACLES["S6_unprocessed"] = with_ctes(LISTINGS_SQL, body=f"""
SELECT l.listing_key, l.batch_number FROM listings l
WHERE NOT EXISTS (SELECT 1 FROM listings p WHERE p.batch_number <= 40 AND p.batch_number = l.batch_number
                  AND ({', '.join('p.' + c for c in _REC.split(', '))}) IS NOT DISTINCT FROM ({', '.join('l.' + c for c in _REC.split(', '))}))""")
ORACLES["S12_history_scan"] = with_ctes(LISTINGS_SQL, body="""
SELECT batch_number, count(*) AS rows FROM listings
WHERE batch_number IS DISTINCT FROM (SELECT max(batch_number) FROM listings) GROUP BY batch_number""")
ORACLES["P9_raw_preservation"] = with_ctes(LISTINGS_SQL, body=f"""
SELECT listing_key, {_REC} FROM listings EXCEPT ALL SELECT listing_key, {_REC} FROM listings""")
ORACLES["P1_drop_control"] = with_ctes(LISTINGS_SQL, body="""
SELECT batch_number, count(*) AS rows,
  'acre_lot,batch_number,bath,bed,brokered_by,city,house_size,listing_key,prev_sold_date,price,state,status,street,zip_code' AS columns
FROM listings GROUP BY batch_number""")
ORACLES["X3_to_numeric"] = """
SELECT event_id, round(TRY_CAST(replace(replace(props, '{"k": ', ''), '}', '') AS DOUBLE), 6) AS value,
       TRY_CAST('x' || replace(replace(props, '{"k": ', ''), '}', '') AS DOUBLE) AS bad_value FROM events"""

# -------------------------------------------------- decomposed signals ------
_RC = ["brokered_by", "status", "price", "bed", "bath", "acre_lot", "street", "city", "state", "zip_code", "house_size",
       "prev_sold_date"]
ORACLES["A1_total_records"] = with_ctes(LISTINGS_SQL, body="SELECT count(*) AS total_records FROM listings")
ORACLES["A2_null_ratio"] = with_ctes(LISTINGS_SQL, QUALITY_CTE, body=" UNION ALL ".join(
    f"SELECT batch_number, '{c}' AS \"column\", round(n_{c} / records, 6) AS null_ratio, n_{c} / records > 0.5 AS high FROM q_counts"
    for c in _RC))
ORACLES["A4_invalid_price"] = with_ctes(LISTINGS_SQL, QUALITY_CTE, body="SELECT batch_number, invalid_prices FROM quality")
ORACLES["A5_null_price_ratio"] = with_ctes(LISTINGS_SQL, QUALITY_CTE, body="""
SELECT batch_number, round(null_price_ratio, 6) AS null_price_ratio, null_price_ratio > 0.3 AS bad FROM quality""")
ORACLES["A6_batch_means"] = with_ctes(LISTINGS_SQL, DRIFT_CTE, body="""
SELECT batch_number, round(m_price, 6) AS mean_price, round(m_house_size, 6) AS mean_house_size, round(m_bed, 6) AS mean_bed,
       round(m_bath, 6) AS mean_bath FROM d_em""")
ORACLES["A7_hist_means"] = with_ctes(LISTINGS_SQL, body="""
SELECT round(avg(price), 6) AS hist_price, round(avg(house_size), 6) AS hist_house_size, round(avg(bed), 6) AS hist_bed,
       round(avg(bath), 6) AS hist_bath FROM listings WHERE batch_number IS DISTINCT FROM (SELECT max(batch_number) FROM listings)""")
ORACLES["W3_expanding_means"] = with_ctes(LISTINGS_SQL, DRIFT_CTE, body="""
SELECT batch_number, round(h_price, 6) AS hist_price, round(h_house_size, 6) AS hist_house_size, round(h_bed, 6) AS hist_bed,
       round(h_bath, 6) AS hist_bath FROM d_em""")
ORACLES["X7_relative_change"] = with_ctes(LISTINGS_SQL, DRIFT_CTE, body=", ".join(
    ["SELECT batch_number"] + [f"round(CASE WHEN h_{c} <> 0 THEN abs(m_{c} - h_{c}) / abs(h_{c}) END, 6) AS change_{c}"
                               for c in ["price", "house_size", "bed", "bath"]]) + " FROM d_em")
ORACLES["A8_distinct_categories"] = with_ctes(LISTINGS_SQL, DRIFT_CTE, body="""
SELECT batch_number, col AS "column", array_to_string(list_sort(list(DISTINCT val)), ',') AS "values" FROM d_vals GROUP BY batch_number, col""")
ORACLES["W4_first_seen_category"] = with_ctes(LISTINGS_SQL, DRIFT_CTE, body="""
SELECT col AS "column", val AS value, fb AS first_batch FROM d_fs""")
ORACLES["J2_category_diff"] = with_ctes(LISTINGS_SQL, DRIFT_CTE, body="""
SELECT DISTINCT v.batch_number, v.col AS "column", v.val AS value FROM d_vals v JOIN d_fs f ON f.col = v.col AND f.val = v.val
WHERE f.fb >= v.batch_number""")
ORACLES["U2_batch_minus_history"] = with_ctes(LISTINGS_SQL, DRIFT_CTE, body="""
SELECT DISTINCT batch_number, col AS "column", val AS value FROM d_vals
EXCEPT SELECT DISTINCT v.batch_number, v.col, v.val FROM d_vals v JOIN d_fs f ON f.col = v.col AND f.val = v.val
WHERE f.fb < v.batch_number""")
ORACLES["A9_new_category_count"] = with_ctes(LISTINGS_SQL, DRIFT_CTE, body="SELECT batch_number, ncat AS new_categories_count FROM drift_v")
ORACLES["A19_received_schema"] = with_ctes(LISTINGS_SQL, PAYLOAD_SQL, SCHEMA_CTE, body="SELECT batch_number, key, inferred FROM recv")
ORACLES["J6_schema_compare"] = with_ctes(LISTINGS_SQL, PAYLOAD_SQL, SCHEMA_CTE, body="""
SELECT r.batch_number, r.key, e.expected, r.inferred,
       (e.expected IS NOT NULL AND r.inferred IS NOT NULL AND e.expected <> r.inferred) AS mismatch
FROM recv r LEFT JOIN expected e ON r.key = e.key""")
ORACLES["U1_missing_extra_columns"] = with_ctes(LISTINGS_SQL, PAYLOAD_SQL, SCHEMA_CTE, body="""
SELECT batch_number, array_to_string(missing, ',') AS missing_columns, array_to_string(extra, ',') AS extra_columns FROM schema_v""")
_SIG = (LISTINGS_SQL, PAYLOAD_SQL, QUALITY_CTE, SCHEMA_CTE, DRIFT_CTE, SIGNALS_CTE)
ORACLES["A22_volume_share"] = with_ctes(*_SIG, body="SELECT batch_number, round(volume_share, 6) AS volume_share FROM sig2")
ORACLES["W2_running_total"] = with_ctes(*_SIG, body="""
SELECT batch_number, CAST(inserted_records AS BIGINT) AS inserted_records, total_records FROM sig2""")
ORACLES["X11_reason_text"] = with_ctes(*_SIG, body=f"SELECT batch_number, reason_code, {DECISION_REASON} AS reason FROM decided")


# ----------------------------------------------- sinks and streams (I/O) ----
ORACLES["S4_read_landed"] = with_ctes(LISTINGS_SQL, body="""
SELECT batch_number, count(*) AS records, count(*) FILTER (WHERE price IS NULL) AS null_price FROM listings GROUP BY batch_number""")
ORACLES["S7_append_clean"] = with_ctes(LISTINGS_SQL, CLEAN_CTE, body="""
SELECT batch_number, count(*) AS rows FROM clean WHERE split = 'train' GROUP BY batch_number""")
ORACLES["S11_append_inference"] = ORACLES["E3_normalise_inference"]
ORACLES["T5_log_stream"] = ORACLES["E3_normalise_inference"]
ORACLES["T6_score_stream"] = ORACLES["M5_batch_score_status"]
F5_CTE = """
c0 AS (
  SELECT listing_key, batch_number, brokered_by, status, price, bed, bath, acre_lot, street, city, state, zip_code, house_size
  FROM listings WHERE price IS NOT NULL AND NOT isnan(price) AND price > 0
),
hfit AS (SELECT """ + ", ".join(f"coalesce(quantile_cont({c}, 0.5), 0.0) AS m_{c}" for c in _NUMS) + """ FROM c0 WHERE batch_number <= 40),
fv AS (
  SELECT col, val, CAST(row_number() OVER (PARTITION BY col ORDER BY val) - 1 AS INTEGER) AS code FROM (
    SELECT DISTINCT 'status' AS col, status AS val FROM c0 WHERE status IS NOT NULL AND batch_number <= 40
    UNION SELECT DISTINCT 'city', city FROM c0 WHERE city IS NOT NULL AND batch_number <= 40
    UNION SELECT DISTINCT 'state', state FROM c0 WHERE state IS NOT NULL AND batch_number <= 40)
),
foc AS (SELECT col, CAST(count(*) AS INTEGER) AS oc FROM fv GROUP BY col),
fenc AS (
  SELECT c.listing_key, c.batch_number, """ + ", ".join(f"coalesce(c.{c}, f.m_{c}) AS {c}" for c in _NUMS) + """,
         CAST(coalesce(vs.code, (SELECT oc FROM foc WHERE col = 'status')) AS INTEGER) AS status,
         CAST(coalesce(vc.code, (SELECT oc FROM foc WHERE col = 'city')) AS INTEGER) AS city,
         CAST(coalesce(vt.code, (SELECT oc FROM foc WHERE col = 'state')) AS INTEGER) AS state
  FROM c0 c CROSS JOIN hfit f
  LEFT JOIN fv vs ON vs.col = 'status' AND vs.val = c.status
  LEFT JOIN fv vc ON vc.col = 'city' AND vc.val = c.city
  LEFT JOIN fv vt ON vt.col = 'state' AND vt.val = c.state
),
franked AS (SELECT *, row_number() OVER (ORDER BY md5('42-' || listing_key), listing_key) - 1 AS rnk, count(*) OVER () AS n_all FROM fenc)"""
ORACLES["F5_transform"] = with_ctes(LISTINGS_SQL, F5_CTE, body="""
SELECT listing_key, batch_number, status, city, state, """ + ", ".join(f"round({c}, 6) AS {c}" for c in _NUMS) + """,
       CASE WHEN rnk < floor(n_all * CAST(0.7 AS DOUBLE)) THEN 'train' WHEN rnk < floor(n_all * CAST(0.85 AS DOUBLE)) THEN 'val'
            ELSE 'test' END AS split FROM franked""")
ORACLES["X2_canonical_json"] = with_ctes(DOCS_SQL, body="""
SELECT doc_id, CAST(to_json({'doc_id': doc_id, 'text': text}) AS VARCHAR) AS canonical FROM docs""")


# ----------------------------------------------------- experiment rows -----
_TEST_PRESENT = """EXISTS (SELECT 1 FROM metrics m WHERE m.line = w.line AND m.batch_number = w.batch_number
                          AND m.candidate = w.candidate AND m.split = 'test')"""
_KNOWN = "x.{c} IS NOT NULL AND NOT isnan(x.{c})"
P10_CTE = """
p10 AS (SELECT w.line, w.batch_number, w.candidate, w.val_mae, t.mae AS test_mae FROM wide w LEFT JOIN metrics t
        ON t.line = w.line AND t.batch_number = w.batch_number AND t.candidate = w.candidate AND t.split = 'test')"""
ORACLES["P10_drop_nan_metrics"] = with_ctes(CANDIDATE_PREDICTIONS_SQL, RUNS_CTE, P10_CTE, body=f"""
SELECT line, batch_number, candidate,
       CAST((CASE WHEN {_KNOWN.format(c='val_mae')} THEN 1 ELSE 0 END) + (CASE WHEN {_KNOWN.format(c='test_mae')} THEN 1 ELSE 0 END) AS INTEGER) AS n_metrics,
       concat_ws(',', CASE WHEN {_KNOWN.format(c='test_mae')} THEN 'test_mae' END, CASE WHEN {_KNOWN.format(c='val_mae')} THEN 'val_mae' END) AS names,
       CASE WHEN {_KNOWN.format(c='test_mae')} THEN round(test_mae, 2) END AS test_mae
FROM p10 x""")
_SPLIT_PRESENT = """EXISTS (SELECT 1 FROM metrics m WHERE m.line = w.line AND m.batch_number = w.batch_number
                          AND m.candidate = w.candidate AND m.split = '{s}')"""
_METRIC = """(SELECT round(max(m.{m}), {k}) FROM metrics m WHERE m.line = w.line AND m.batch_number = w.batch_number
                          AND m.candidate = w.candidate AND m.split = '{s}') AS {s}_{m}"""
ORACLES["S14_experiment_runs"] = with_ctes(LISTINGS_SQL, CANDIDATE_PREDICTIONS_SQL, RUNS_CTE, body=f"""
SELECT line, batch_number, candidate,
       (SELECT array_to_string(list_sort(list(DISTINCT batch_number)), ',') FROM listings) AS batch_numbers_text,
       CAST(4 * (CASE WHEN {_SPLIT_PRESENT.format(s='val')} THEN 1 ELSE 0 END)
            + 3 * (CASE WHEN {_SPLIT_PRESENT.format(s='test')} THEN 1 ELSE 0 END)
            + (CASE WHEN {_SPLIT_PRESENT.format(s='train')} THEN 1 ELSE 0 END) AS INTEGER) AS n_metrics,
       '0000000' AS code_commit, 'model=' || candidate || ';prep_random_state=42;prep_split_train_frac=0.7' AS params,
       {", ".join(_METRIC.format(s=s, m=m, k=6 if m == 'r2' else 2) for s in ('val', 'test') for m in ('mae', 'rmse', 'r2'))}
FROM wide w""")
ORACLES["E2_build_experiments"] = with_ctes(CANDIDATE_PREDICTIONS_SQL, RUNS_CTE, body=" UNION ALL ".join(
    f"SELECT line, batch_number, candidate, split || '_{m}' AS metric, round({m}, 2) AS value FROM metrics WHERE split IN ('val', 'test')" for m in ("mae", "rmse", "r2")))

# ridge: moments of the training rows, then Gauss-Jordan elimination of the standardised normal equations, one pivot a step
_RIDGE_X = [f"CAST({c} AS DOUBLE)" for c in _FEATURES]
RIDGE_CTE = """
train AS (SELECT price AS y, """ + ", ".join(f"{x} AS x{i}" for i, x in enumerate(_RIDGE_X)) + """ FROM clean WHERE split = 'train'),
moments AS (SELECT CAST(count(*) AS DOUBLE) AS n, """ + ", ".join(f"stddev_pop(x{i}) AS s{i}, covar_pop(x{i}, y) AS c{i}" for i in range(11)) + ", " + ", ".join(
    f"covar_pop(x{i}, x{j}) AS c{i}_{j}" for i in range(11) for j in range(i, 11)) + """ FROM train),
steps AS (
  SELECT 0 AS k, [""" + ", ".join("[" + ", ".join(
    f"n * c{min(i, j)}_{max(i, j)} / (s{i} * s{j}){' + 1.0' if i == j else ''}" for j in range(11)) + f", n * c{i} / s{i}]" for i in range(11)) + """] AS m FROM moments
  UNION ALL
  SELECT k + 1, list_transform(range(1, 12), lambda i: list_transform(range(1, 13), lambda j:
    CASE WHEN i = k + 1 THEN m[i][j] / m[i][i] ELSE m[i][j] - m[i][k + 1] / m[k + 1][k + 1] * m[k + 1][j] END)) FROM steps WHERE k < 11
),
ridge AS (SELECT f.feature, f.place, (SELECT m FROM steps WHERE k = 11)[f.place][12] AS weight
  FROM (VALUES """ + ", ".join(f"('{c}', {i + 1})" for i, c in enumerate(_FEATURES)) + """) AS f(feature, place))"""
ORACLES["M1_ridge_weights"] = with_ctes(LISTINGS_SQL, CLEAN_CTE, RIDGE_CTE, body="""
SELECT feature, round(weight, 2) AS weight, (SELECT count(*) FROM train) AS train_rows FROM ridge""").replace("WITH ", "WITH RECURSIVE ", 1)
ORACLES["A21_ridge_importance"] = with_ctes(LISTINGS_SQL, CLEAN_CTE, RIDGE_CTE, body="""
SELECT CAST(row_number() OVER (ORDER BY abs(weight) DESC) AS INTEGER) AS place, feature, round(abs(weight), 2) AS importance FROM ridge""").replace("WITH ", "WITH RECURSIVE ", 1)


ORACLES["Q4_decide_training_documented"] = with_ctes(*_SIG, body="""
SELECT batch_number, total_records, quality_valid,
       CASE WHEN total_records < 1000 OR NOT quality_valid THEN 'SKIP'
            WHEN drift_detected OR volume_share >= 0.1 OR new_categories_count >= 5 OR new_columns_count >= 2 THEN 'TRAIN'
            ELSE 'SKIP' END AS decision,
       CASE WHEN total_records < 1000 THEN 'insufficient_records' WHEN NOT quality_valid THEN 'bad_quality'
            WHEN drift_detected THEN 'drift' WHEN volume_share >= 0.1 THEN 'volume'
            WHEN new_categories_count >= 5 THEN 'new_categories' WHEN new_columns_count >= 2 THEN 'new_columns'
            ELSE 'no_signal' END AS reason_code
FROM sig2""")


ORACLES["Q2_validate_quality_payload"] = with_ctes(LISTINGS_SQL, PAYLOAD_SQL, body="""
, pq AS (
  SELECT batch_number, count(*) AS records,
         count(*) FILTER (WHERE json_type(payload, '$.price') IS NULL OR json_type(payload, '$.price') = 'NULL') AS nullp,
         count(*) FILTER (WHERE json_type(payload, '$.price') IN ('UBIGINT', 'BIGINT', 'DOUBLE')
                          AND CAST(json_extract(payload, '$.price') AS DOUBLE) <= 0
                          OR json_type(payload, '$.price') = 'VARCHAR'
                          AND TRY_CAST(json_extract_string(payload, '$.price') AS DOUBLE) <= 0) AS invalid_prices,
         count(*) - count(DISTINCT payload) AS duplicate_rows
  FROM payload GROUP BY batch_number
), pk AS (
  SELECT p.batch_number, j.key, count(*) FILTER (WHERE j.type <> 'NULL') AS nn FROM payload p, json_each(p.payload) j
  GROUP BY p.batch_number, j.key
), ph AS (
  SELECT pk.batch_number, list_sort(list(pk.key) FILTER (WHERE (pq.records - pk.nn) / pq.records > 0.5)) AS high
  FROM pk JOIN pq USING (batch_number) GROUP BY pk.batch_number
), pv AS (
  SELECT pq.*, coalesce(ph.high, []) AS high, nullp / records AS null_price_ratio FROM pq LEFT JOIN ph USING (batch_number)
)
SELECT batch_number, records, NOT (len(high) > 0 OR invalid_prices > 0 OR null_price_ratio > 0.3) AS valid,
       array_to_string(high, ',') AS high_null_columns, duplicate_rows, invalid_prices,
       round(null_price_ratio, 6) AS null_price_ratio,
       array_to_string(list_filter([
         CASE WHEN len(high) > 0 THEN 'High null rate in: ' || """ + _pylist("high") + """ END,
         CASE WHEN invalid_prices > 0 THEN CAST(invalid_prices AS VARCHAR) || ' records with invalid price' END,
         CASE WHEN null_price_ratio > 0.3 THEN 'More than 30% null prices ('
              || CAST(CAST(round_even(null_price_ratio * 100, 0) AS BIGINT) AS VARCHAR) || '%)' END,
         CASE WHEN duplicate_rows > 0 THEN CAST(duplicate_rows AS VARCHAR) || ' duplicate rows' END
       ], lambda x: x IS NOT NULL), ' | ') AS issues
FROM pv""".replace("\n, pq AS", "", 0))


# ------------------------------------------------------------ rounding ------
def _rewrite_round(sql: str) -> str:
    """``round(x, k)`` -> ``floor(x * 1ek + 0.5) / 1ek`` (same arithmetic as the
    Spark side, so equal inputs give bit-equal outputs)."""
    out, i = [], 0
    while True:
        j = sql.find("round(", i)
        if j < 0 or (j > 0 and (sql[j - 1].isalnum() or sql[j - 1] == "_")):
            if j < 0:
                out.append(sql[i:])
                return "".join(out)
            out.append(sql[i:j + 6])
            i = j + 6
            continue
        depth, k, comma = 1, j + 6, -1
        while depth:
            ch = sql[k]
            if ch == "(":
                depth += 1
            elif ch == ")":
                depth -= 1
            elif ch == "," and depth == 1:
                comma = k
            k += 1
        if comma < 0:  # round(x) without digits: leave as is
            out.append(sql[i:k])
            i = k
            continue
        expr, digits = _rewrite_round(sql[j + 6:comma]), sql[comma + 1:k - 1].strip()
        out.append(sql[i:j])
        out.append(f"CASE WHEN isnan({expr}) OR isinf({expr}) THEN ({expr}) "
                   f"ELSE floor(({expr}) * 1e{digits} + 0.5123456789) / 1e{digits} END")
        i = k


_MONEY_COLS = ("mae", "rmse", "val_mae", "val_rmse", "champion_mae", "champion_rmse", "range_lo", "range_hi")
for _k in ("A12_regression_metrics", "A13_best_candidate", "W7_champion_fold", "J5_candidate_vs_champion",
           "E1_build_audit", "S10_scan_audit", "S9_append_audit",
           "A20_residual_histogram", "A24_actual_vs_predicted"):
    for _c in _MONEY_COLS:
        ORACLES[_k] = ORACLES[_k].replace(f", 6) AS {_c}", f", 2) AS {_c}")
ORACLES["W7_champion_stream"] = ORACLES["W7_champion_fold"]

# timestamps leave as fixed-format text (the Spark side does the same)
_TS_COLUMNS = {
    "E1_build_audit": ["logged_at"], "S10_scan_audit": ["logged_at"], "O1_order_history": ["logged_at"],
    "S9_append_audit": ["logged_at"], "E3_normalise_inference": ["request_ts"], "X5_to_utc": ["request_ts"],
    "E4_events_to_json": ["request_ts"], "S11_append_inference": ["request_ts"], "T5_log_stream": ["request_ts"],
    "T1_request_rate": ["window_start", "window_end"], "T2_error_rate": ["window_start", "window_end"],
    "T3_latency_quantiles": ["window_start", "window_end"], "S3_batch_ledger": ["fetched_at"],
}
for _k, _cols in _TS_COLUMNS.items():
    _rep = ", ".join(f"strftime({c}, '%Y-%m-%d %H:%M:%S.%f') AS {c}" for c in _cols)
    ORACLES[_k] = f"SELECT * REPLACE ({_rep}) FROM (\n{ORACLES[_k]}\n) AS t"
ORACLES = {k: _rewrite_round(v) for k, v in ORACLES.items()}
