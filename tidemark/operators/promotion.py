"""Promotion rule, champion fold and registry lookups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.expr import fmt_pct, improvement_pct, worsening_pct

MAE_IMPROVEMENT = 0.03
RMSE_MAX_WORSENING = 0.01


def promote_rule(mae: Column, rmse: Column, champ_mae: Column, champ_rmse: Column,
                 mae_pct: float = MAE_IMPROVEMENT, rmse_pct: float | None = RMSE_MAX_WORSENING) -> Column:
    """Q5 step: a candidate without metrics (null or NaN) is never promoted;
    no champion -> promote; else both guards (inclusive).  A NaN champion
    metric counts as none.  ``rmse_pct=None`` drops the RMSE guard."""
    mae, rmse, champ_mae, champ_rmse = (F.nanvl(c, F.lit(None).cast("double")) for c in (mae, rmse, champ_mae, champ_rmse))
    has = champ_mae.isNotNull() & champ_rmse.isNotNull()
    ok = mae <= champ_mae * (1.0 - mae_pct)
    if rmse_pct is not None:
        ok = ok & (rmse <= champ_rmse * (1.0 + rmse_pct))
    known = mae.isNotNull() if rmse_pct is None else mae.isNotNull() & rmse.isNotNull()
    return known & (~has | ok)


def should_promote(pairs: DataFrame, mae_pct: float = MAE_IMPROVEMENT, rmse_pct: float = RMSE_MAX_WORSENING,
                   mae: str = "mae", rmse: str = "rmse", champ_mae: str = "champion_mae",
                   champ_rmse: str = "champion_rmse") -> DataFrame:
    """Q5 over a candidate/champion table (J5 output): promote, changes, reason."""
    m, r, cm, cr = F.col(mae), F.col(rmse), F.col(champ_mae), F.col(champ_rmse)
    has = cm.isNotNull() & cr.isNotNull()
    mae_ok = m <= cm * (1.0 - mae_pct)
    rmse_ok = r <= cr * (1.0 + rmse_pct)
    no_cand = m.isNull() | r.isNull()
    mc = F.when(has, improvement_pct(cm, m))
    rc = F.when(has, worsening_pct(cr, r))
    thr_m, thr_r = f"{mae_pct:.2%}", f"{rmse_pct:.2%}"
    reasons = F.filter(F.array(
        F.when(~mae_ok, F.concat(F.lit("MAE improves "), fmt_pct(mc, 2), F.lit(f" (< threshold {thr_m})"))),
        F.when(~rmse_ok, F.concat(F.lit("RMSE worsens "), fmt_pct(rc, 2), F.lit(f" (> threshold {thr_r})")))),
        lambda x: x.isNotNull())
    promote = F.when(no_cand, F.lit(False)).otherwise(~has | (mae_ok & rmse_ok))
    code = (F.when(no_cand, F.lit("no_candidate")).when(~has, F.lit("first_model"))
            .when(mae_ok & rmse_ok, F.lit("improved")).when(~mae_ok & ~rmse_ok, F.lit("mae_and_rmse"))
            .when(~mae_ok, F.lit("mae")).otherwise(F.lit("rmse_guard")))
    reason = (F.when(no_cand, F.lit("No valid candidate to compare; not promoted."))
              .when(~has, F.lit("Promoted: first model (no previous champion)."))
              .when(mae_ok & rmse_ok, F.concat(F.lit("Promoted: MAE improves "), fmt_pct(mc, 2),
                                               F.lit(f" (>= threshold {thr_m}) and RMSE changes "), fmt_pct(rc, 2),
                                               F.lit(f" (<= threshold {thr_r}).")))
              .otherwise(F.concat(F.lit("Champion kept: "), F.array_join(reasons, "; "), F.lit("."))))
    return pairs.withColumns({"promote": promote, "mae_change_pct": mc, "rmse_change_pct": rc,
                              "reason_code": code, "reason": reason})


def promote_mae_only(pairs: DataFrame, mae_pct: float = MAE_IMPROVEMENT, mae: str = "mae",
                     champ_mae: str = "champion_mae", champion: str | None = None) -> DataFrame:
    """Q6 legacy rule: (champ - best) / champ >= pct; no champion or a zero
    champion MAE (division failure) -> promote.

    ``champion`` names a column that is null where there is no champion; a
    champion without a stored MAE is then kept.  Without it a null MAE means
    no champion.
    """
    m, cm = F.col(mae), F.col(champ_mae)
    none = F.col(champion).isNull() if champion else cm.isNull()
    fallback = none | (F.coalesce(cm, F.lit(1.0)) == 0)
    imp = F.when(~fallback, (cm - m) / cm)
    return pairs.withColumns({"improvement": imp, "promote": fallback | F.coalesce(imp >= mae_pct, F.lit(False))})


def run_to_version(runs: DataFrame, versions: DataFrame, run_id: str = "run_id") -> DataFrame:
    """run_id -> first registered version, else null (left equi-join).

    Versions are compared as numbers ('9' before '10'); any that are no number
    come last, in text order.
    """
    number = F.col("version").cast("string").try_cast("bigint")
    first = F.min(F.when(F.col("version").isNotNull(), F.struct(number.isNull().alias("text"), number.alias("number"), F.col("version").alias("version"))))
    v = versions.groupBy(run_id).agg(first.alias("_first")).select(run_id, F.col("_first.version").alias("version"))
    return runs.join(v, run_id, "left")


def known_metric(x) -> float | None:
    """A metric as a number; null and NaN are none."""
    return None if x is None or x != x else float(x)


def champion_step(champion: tuple | None, order, mae: float | None, rmse: float | None, resolved: bool | None,
                  mae_pct: float = MAE_IMPROVEMENT, rmse_pct: float | None = RMSE_MAX_WORSENING) -> bool:
    """Q5 for one run against ``champion`` (order, mae, rmse), the rule of :func:`promote_rule` in the driver-free scalar form that
    the scan and the stream of W7 share."""
    mae, rmse = known_metric(mae), known_metric(rmse)
    if not resolved or mae is None or (rmse_pct is not None and rmse is None):
        return False
    if champion is None:
        return True
    return mae <= champion[1] * (1.0 - mae_pct) and (rmse_pct is None or champion[2] is None or rmse <= champion[2] * (1.0 + rmse_pct))


def champion_fold(runs: DataFrame, line: str = "line", order: str = "batch_number",
                  mae_pct: float = MAE_IMPROVEMENT, rmse_pct: float | None = RMSE_MAX_WORSENING) -> DataFrame:
    """Sequential champion per line.  A run is compared with the last
    *promoted* run of its line; it is promoted when the rule passes and its
    version resolves (``resolved``); otherwise the champion stays.

    The runs (one summary row per training run) are sorted by line and order,
    and each task scans its sorted stream once, holding one champion: nothing
    is collected per line, however many runs it has.  Lines scan in parallel.
    Runs of one order stand by their metrics, nulls first; null lines are one
    line.  A NaN metric counts as null and comes back as null.
    """
    mae, rmse = (F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")).alias(c) for c in ("mae", "rmse"))
    x = runs.select(F.col(line).alias("line"), F.col(order).cast("int").alias("ord"), mae, rmse, F.col("resolved").cast("boolean").alias("resolved"))
    x = x.repartition("line").sortWithinPartitions(*[F.asc_nulls_first(c) for c in ("line", "ord", "mae", "rmse", "resolved")])
    kind = x.schema["line"].dataType
    schema = T.StructType([T.StructField("line", kind), T.StructField("ord", T.IntegerType()), T.StructField("mae", T.DoubleType()), T.StructField("rmse", T.DoubleType()),
                           T.StructField("resolved", T.BooleanType()), T.StructField("c_ord", T.IntegerType()), T.StructField("c_mae", T.DoubleType()),
                           T.StructField("c_rmse", T.DoubleType()), T.StructField("promoted", T.BooleanType())])

    def scan(batches):
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema
        arrow, key, champion = to_arrow_schema(schema), object(), None
        for batch in batches:
            out = []
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if row[0] != key:
                    key, champion = row[0], None
                ok = champion_step(champion, *row[1:], mae_pct, rmse_pct)
                out.append((*row, *(champion or (None, None, None)), ok))
                if ok:
                    champion = (row[1], row[2], known_metric(row[3]))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], f.type) for i, f in enumerate(arrow)], schema=arrow)

    y = x.mapInArrow(scan, schema)
    return y.select(F.col("line").alias(line), F.col("ord").alias(order), "mae", "rmse", "resolved", F.col("c_ord").alias("champion_" + order),
                    F.col("c_mae").alias("champion_mae"), F.col("c_rmse").alias("champion_rmse"), "promoted")
