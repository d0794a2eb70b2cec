"""Schema and quality validation per batch.

Every function takes a table of *all* batches and returns one row per batch.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.expr import is_null, py_list, row_hash, to_double
from tidemark.sources.fixtures import EXPECTED_SCHEMA

_NUMERIC_VARIANT_TYPES = ("BIGINT", "INT", "SMALLINT", "TINYINT", "DECIMAL", "DOUBLE", "FLOAT")


def _is_floating(df: DataFrame, c: str) -> bool:
    return isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType))


def _with_expected_batches(result: DataFrame, by: str, batches: DataFrame | None) -> DataFrame:
    """Left-join the expected batch list so that empty batches get a row."""
    if batches is None:
        return result
    return batches.select(by).distinct().join(result, by, "left")


# ------------------------------------------------------------------ A19 -----
def received_schema(df: DataFrame, by: str = "batch_number", payload: str = "payload") -> DataFrame:
    """Per (batch, key) present in >= 1 record, with the inferred logical type.

    ``inferred`` is 'number' iff every non-null value is a JSON number,
    'string' if any is not, null when all values are null.  Corrupt payloads
    parse to null and contribute no key.
    """
    # explode_outer: a batch whose records carry no key at all still appears
    # (one null key), so it is reported with every expected column missing
    kv = df.select(by, F.explode_outer(F.from_json(F.col(payload), T.MapType(T.StringType(), T.VariantType()))).alias("key", "value"))
    t = F.schema_of_variant("value")
    non_null = t != "VOID"
    is_num = F.regexp_like(t, F.lit("^(" + "|".join(_NUMERIC_VARIANT_TYPES) + ")"))
    return kv.groupBy(by, "key").agg(
        F.count_if(non_null).alias("_nn"), F.count_if(non_null & ~is_num).alias("_ns")
    ).select(by, "key", F.when(F.col("_nn") == 0, F.lit(None).cast("string"))
             .when(F.col("_ns") > 0, F.lit("string")).otherwise(F.lit("number")).alias("inferred"))


def typed_received_schema(df: DataFrame, by: str = "batch_number", columns: Sequence[str] | None = None) -> DataFrame:
    """A19 for a typed frame: keys are the columns, types from the dtypes (no data scan
    except to list batches; a column whose values are all null stays undetermined)."""
    columns = list(columns or [c for c in df.columns if c != by])
    aggs = []
    for c in columns:
        dt = df.schema[c].dataType
        logical = "number" if isinstance(dt, T.NumericType) else "string"
        aggs.append(F.struct(F.lit(c).alias("key"),
                             F.when(F.count(c) > 0, F.lit(logical)).alias("inferred")))
    return df.groupBy(by).agg(F.array(*aggs).alias("_k")).select(by, F.inline("_k"))


# --------------------------------------------------------------- J6 / Q1 ----
def validate_schema(received: DataFrame, by: str = "batch_number",
                    expected: Mapping[str, str] = EXPECTED_SCHEMA,
                    batches: DataFrame | None = None) -> DataFrame:
    """Q1: per batch ``valid, missing_columns, extra_columns, type_mismatches``.

    ``received`` is the output of :func:`received_schema`.  The expected schema
    is a literal (its size is the schema width), joined by key, never crossed.
    """
    spark = received.sparkSession
    exp = F.broadcast(spark.createDataFrame(list(expected.items()), "key string, expected string"))
    exp_keys = F.array(*[F.lit(k) for k in sorted(expected)])
    # one pass: received keys left-joined with the (schema-width) expected literal
    j = received.join(exp, "key", "left")  # a null key matches nothing
    mism = F.when(F.col("expected").isNotNull() & F.col("inferred").isNotNull() & (F.col("inferred") != F.col("expected")),
                  F.concat_ws("", "key", F.lit(": expected "), "expected", F.lit(", got "), "inferred"))
    g = j.groupBy(by).agg(F.array_sort(F.collect_set("key")).alias("_recv"),
                          F.array_sort(F.collect_list(mism)).alias("type_mismatches"))
    out = g.select(
        by,
        F.array_sort(F.array_except(exp_keys, "_recv")).alias("missing_columns"),
        F.array_sort(F.array_except("_recv", exp_keys)).alias("extra_columns"),
        "type_mismatches",
    )
    out = _with_expected_batches(out, by, batches)
    empty = F.array().cast("array<string>")
    return out.select(
        by,
        (F.col("missing_columns").isNotNull() & (F.size("missing_columns") == 0) & (F.size("extra_columns") == 0)
         & (F.size("type_mismatches") == 0)).alias("valid"),
        F.coalesce("missing_columns", empty).alias("missing_columns"),
        F.coalesce("extra_columns", empty).alias("extra_columns"),
        F.coalesce("type_mismatches", empty).alias("type_mismatches"),
        F.coalesce(F.size("extra_columns"), F.lit(0)).alias("new_columns_count"),
    )


# -------------------------------------------------------------- A1-A5 / Q2 --
def quality_aggs(df: DataFrame, columns: Sequence[str], price: str = "price") -> list:
    """Aggregate expressions shared by Q2 and the one-pass batch_signals plan."""
    aggs = [F.count(F.lit(1)).alias("records")]
    for c in columns:
        aggs.append(F.count_if(is_null(c, _is_floating(df, c))).alias(f"_null_{c}"))
    p = to_double(price)
    aggs.append(F.count_if(p <= 0).alias("invalid_prices"))
    aggs.append(F.count_if(is_null(price, _is_floating(df, price))).alias("_nullp"))
    return aggs


def quality_finish(agg: DataFrame, by: str, columns: Sequence[str], null_col_threshold: float = 0.5,
                   null_price_threshold: float = 0.3, duplicates: str = "duplicate_rows") -> DataFrame:
    """Turn :func:`quality_aggs` counts into the Q2 verdict row."""
    n = F.col("records")
    high = F.filter(F.array(*[F.when(F.try_divide(F.col(f"_null_{c}"), n) > null_col_threshold, F.lit(c)) for c in sorted(columns)]),
                    lambda x: x.isNotNull())
    ratio = F.when(n > 0, F.col("_nullp") / n).otherwise(F.lit(0.0))
    pct_thr = f"{null_price_threshold:.0%}"
    issues = F.filter(F.array(
        F.when(F.size("high_null_columns") > 0, F.concat(F.lit("High null rate in: "), py_list("high_null_columns"))),
        F.when(F.col("invalid_prices") > 0, F.concat(F.col("invalid_prices").cast("string"), F.lit(" records with invalid price"))),
        F.when(F.col("null_price_ratio") > null_price_threshold,
               F.concat(F.lit(f"More than {pct_thr} null prices ("),
                        F.bround(F.col("null_price_ratio") * 100, 0).cast("bigint").cast("string"), F.lit("%)"))),
        F.when(F.col(duplicates) > 0, F.concat(F.col(duplicates).cast("string"), F.lit(" duplicate rows"))),
    ), lambda x: x.isNotNull())
    out = agg.withColumn("high_null_columns", high).withColumn("null_price_ratio", ratio)
    out = out.withColumn("issues", F.when(n > 0, issues).otherwise(F.array(F.lit("empty batch"))))
    grave = (F.size("high_null_columns") > 0) | (F.col("invalid_prices") > 0) | (F.col("null_price_ratio") > null_price_threshold)
    return out.select(
        by, "records", (~grave & (n > 0)).alias("valid"), "high_null_columns",
        F.col(duplicates).cast("bigint").alias("duplicate_rows"), F.col("invalid_prices").cast("bigint").alias("invalid_prices"),
        "null_price_ratio", "issues")


def validate_quality(df: DataFrame, by: str = "batch_number", columns: Sequence[str] | None = None,
                     price: str = "price", null_col_threshold: float = 0.5, null_price_threshold: float = 0.3,
                     hash_col: str | None = None, batches: DataFrame | None = None) -> DataFrame:
    """Q2: per batch A2 null ratios, A3 duplicates, A4 invalid prices, A5 null price ratio.

    Counters in one ``groupBy(by)``; duplicates are rows minus distinct
    ``(batch, row_hash)`` pairs.
    ``batches`` (optional) lists expected batches so empty ones appear invalid.
    """
    columns = list(columns or [c for c in df.columns if c not in (by, hash_col)])
    h = F.col(hash_col) if hash_col else row_hash(columns)
    # counters per batch (tiny shuffle) + distinct (batch, hash) pairs (36 B per
    # distinct record) instead of a distinct aggregate that would shuffle every
    # counter at (batch, hash) granularity
    counts = df.groupBy(by).agg(*quality_aggs(df, columns, price))
    distinct = df.select(by, h.alias("_h")).distinct().groupBy(by).agg(F.count(F.lit(1)).alias("_distinct"))
    agg = counts.join(distinct, by, "left")
    agg = agg.withColumn("duplicate_rows", F.col("records") - F.coalesce("_distinct", F.lit(0)))
    if batches is not None:
        agg = batches.select(by).distinct().join(agg, by, "left").na.fill(0)
    return quality_finish(agg, by, columns, null_col_threshold, null_price_threshold)


def total_records(raw: DataFrame) -> DataFrame:
    """A1: rows in the raw store."""
    return raw.agg(F.count(F.lit(1)).alias("total_records"))


def validate_quality_payload(df: DataFrame, by: str = "batch_number", payload: str = "payload", price: str = "price",
                             null_col_threshold: float = 0.5, null_price_threshold: float = 0.3,
                             batches: DataFrame | None = None) -> DataFrame:
    """Q2 over landed JSON records, with the dict semantics of the rule:

    * the checked columns are the keys present in at least one record of the
      batch; a key absent from a record counts as null there;
    * duplicates compare the canonical record (keys sorted, JSON types kept,
      so ``1`` and ``1.0`` differ);
    * price is coerced (text that does not parse is neither null nor invalid).

    Each payload is parsed once into ``map<string,variant>``; per-key counts
    come from one ``groupBy(batch, key)`` and are joined back per batch.
    """
    m = F.from_json(F.col(payload), T.MapType(T.StringType(), T.VariantType()))
    x = df.select(by, m.alias("_m"))
    by_key = F.array_sort(F.map_entries("_m"), lambda a, b: F.when(a["key"] < b["key"], -1)
                          .when(a["key"] > b["key"], 1).otherwise(0))
    canon = F.to_json(F.map_from_entries(by_key))
    pv = F.try_element_at(F.col("_m"), F.lit(price))
    p_null = pv.isNull() | (F.schema_of_variant(pv) == "VOID")
    p_num = F.when(F.regexp_like(F.schema_of_variant(pv), F.lit("^(" + "|".join(_NUMERIC_VARIANT_TYPES) + ")")),
                   F.try_variant_get(pv, "$", "double")).otherwise(
        F.try_variant_get(pv, "$", "string").try_cast("double"))
    p_num = F.nanvl(p_num, F.lit(None).cast("double"))
    per_batch = x.groupBy(by).agg(
        F.count(F.lit(1)).alias("records"),
        F.count_if(p_null).alias("_nullp"),
        F.count_if(~p_null & (p_num <= 0)).alias("invalid_prices"))
    distinct = x.select(by, canon.alias("_c")).distinct().groupBy(by).agg(F.count(F.lit(1)).alias("_distinct"))
    kv = x.select(by, F.explode("_m").alias("key", "value"))
    nonnull = kv.groupBy(by, "key").agg(F.count_if(F.schema_of_variant("value") != "VOID").alias("_nn"))
    agg = per_batch.join(distinct, by, "left").withColumn("duplicate_rows", F.col("records") - F.coalesce("_distinct", F.lit(0)))
    high = (nonnull.join(per_batch.select(by, "records"), by)
            .where(F.try_divide(F.col("records") - F.col("_nn"), F.col("records")) > null_col_threshold)
            .groupBy(by).agg(F.array_sort(F.collect_list("key")).alias("_high")))
    agg = agg.join(high, by, "left")
    if batches is not None:
        agg = batches.select(by).distinct().join(agg, by, "left").na.fill(0, ["records", "_nullp", "invalid_prices", "duplicate_rows"])
    n = F.col("records")
    high_c = F.coalesce(F.col("_high"), F.array().cast("array<string>"))
    ratio = F.when(n > 0, F.col("_nullp") / n).otherwise(F.lit(0.0))
    pct_thr = f"{null_price_threshold:.0%}"
    out = agg.withColumn("high_null_columns", high_c).withColumn("null_price_ratio", ratio)
    issues = F.filter(F.array(
        F.when(F.size("high_null_columns") > 0, F.concat(F.lit("High null rate in: "), py_list("high_null_columns"))),
        F.when(F.col("invalid_prices") > 0, F.concat(F.col("invalid_prices").cast("string"), F.lit(" records with invalid price"))),
        F.when(F.col("null_price_ratio") > null_price_threshold,
               F.concat(F.lit(f"More than {pct_thr} null prices ("),
                        F.bround(F.col("null_price_ratio") * 100, 0).cast("bigint").cast("string"), F.lit("%)"))),
        F.when(F.col("duplicate_rows") > 0, F.concat(F.col("duplicate_rows").cast("string"), F.lit(" duplicate rows"))),
    ), lambda e: e.isNotNull())
    out = out.withColumn("issues", F.when(n > 0, issues).otherwise(F.array(F.lit("empty batch"))))
    grave = (F.size("high_null_columns") > 0) | (F.col("invalid_prices") > 0) | (F.col("null_price_ratio") > null_price_threshold)
    return out.select(by, F.col("records").cast("bigint").alias("records"), (~grave & (n > 0)).alias("valid"),
                      "high_null_columns", F.col("duplicate_rows").cast("bigint").alias("duplicate_rows"),
                      F.col("invalid_prices").cast("bigint").alias("invalid_prices"), "null_price_ratio", "issues")
