"""Ridge from mergeable sums: one small row a batch holds all that the normal equations need.

The state of a group of rows is its number, the sums of the eleven features and
the target, and the sums of all their products, each less a fixed shift (about
the column's mean, so that squares do not cancel).  States of disjoint rows add
up, so a model over all clean rows costs one pass over the new rows and a sum
over one row a batch; no earlier row is read again.
"""

from __future__ import annotations

import itertools
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer, StringIndexerModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.expr import to_double
from tidemark.operators.features import CATEGORICAL_COLUMNS, FEATURES, NULL_CODE, TARGET

RIDGE_ALPHA = 1.0


def _value(c: str):
    return F.coalesce(to_double(c), F.lit(0.0))  # P5


def column_means(rows: DataFrame, columns: Sequence[str] = (*FEATURES, TARGET)) -> list[float]:
    """Shifts for the states of a table, taken once from its first rows."""
    r = rows.agg(*[F.avg(_value(c)).alias(f"m{i}") for i, c in enumerate(columns)]).first()
    return [float(x or 0.0) for x in r]


def gram_state(rows: DataFrame, by: Sequence[str] = ("batch_number",), shift: Sequence[float] | None = None,
               columns: Sequence[str] = (*FEATURES, TARGET)) -> DataFrame:
    """One row a group: (*by, n, shift, sums, products); products of columns i <= j in row order.  One pass, combined map-side."""
    shift = [0.0] * len(columns) if shift is None else list(shift)
    x = rows.select(*by, *[(_value(c) - F.lit(float(s))).alias(f"_x{i}") for i, (c, s) in enumerate(zip(columns, shift, strict=True))])
    k = range(len(columns))
    pairs = list(itertools.combinations_with_replacement(k, 2))
    g = x.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), *[F.sum(f"_x{i}").alias(f"_s{i}") for i in k],
                           *[F.sum(F.col(f"_x{i}") * F.col(f"_x{j}")).alias(f"_p{i}_{j}") for i, j in pairs])
    return g.select(*by, "n", F.array(*[F.lit(float(s)) for s in shift]).alias("shift"), F.array(*[f"_s{i}" for i in k]).alias("sums"),
                    F.array(*[f"_p{i}_{j}" for i, j in pairs]).alias("products"))


def merge_states(states: DataFrame, by: Sequence[str] = (), columns: Sequence[str] = (*FEATURES, TARGET)) -> DataFrame:
    """The state of the union of disjoint groups that share one shift."""
    k = len(columns)
    size = k * (k + 1) // 2
    g = states.groupBy(*by, "shift").agg(F.sum("n").alias("n"), *[F.sum(F.col("sums")[i]).alias(f"_s{i}") for i in range(k)],
                                         *[F.sum(F.col("products")[i]).alias(f"_p{i}") for i in range(size)])
    return g.select(*by, "n", "shift", F.array(*[f"_s{i}" for i in range(k)]).alias("sums"), F.array(*[f"_p{i}" for i in range(size)]).alias("products"))


@dataclass(frozen=True)
class Ridge:
    """Fitted ridge: weights of the standardised features, and the same model on the features as they are."""
    features: tuple[str, ...]
    weights: tuple[float, ...]
    coefficients: tuple[float, ...]
    intercept: float
    rows: int

    def table(self, spark: SparkSession) -> DataFrame:
        rows = [(f, w, c) for f, w, c in zip(self.features, self.weights, self.coefficients, strict=True)]
        return spark.createDataFrame(rows, "feature string, weight double, coefficient double")

    def importance(self) -> list[tuple[str, float]]:
        """Absolute weights, descending."""
        return sorted(((f, abs(w)) for f, w in zip(self.features, self.weights, strict=True)), key=lambda t: -t[1])

    def pipeline(self, labels: Mapping[str, Sequence[str]], categorical: Sequence[str] = CATEGORICAL_COLUMNS) -> PipelineModel:
        """The model as Spark ML stages over raw categories: ``labels`` lists each column's values in code order; others and null take
        NULL_CODE, as in a versioned dictionary."""
        known = [c for c in categorical]
        indexer = StringIndexerModel.from_arrays_of_labels([list(labels.get(c, ())) for c in known], inputCols=known,
                                                           outputCols=[f"_{c}_idx" for c in known], handleInvalid="keep")
        terms = [repr(self.intercept) + "D"]
        for f, b in zip(self.features, self.coefficients, strict=True):
            code = f"IF(_{f}_idx >= {len(labels.get(f, ()))}, {float(NULL_CODE)}D, _{f}_idx)" if f in known else f"COALESCE(CAST({f} AS DOUBLE), 0D)"
            terms.append(f"({b!r}D) * {code}")
        return PipelineModel(stages=[indexer, SQLTransformer(statement=f"SELECT *, {' + '.join(terms)} AS prediction FROM __THIS__")])


def solve_ridge(state: DataFrame, alpha: float = RIDGE_ALPHA, features: Sequence[str] = FEATURES) -> Ridge | None:
    """Closed-form ridge on population-standardised features from one merged state (a row of some hundred numbers); None without rows.

    A constant feature has no scale and takes the weight 0."""
    r = state.first()
    if r is None or not r["n"]:
        return None
    n, k = r["n"], len(features)
    s = np.array(r["sums"]) / n
    product = np.zeros((k + 1, k + 1))
    upper = np.triu_indices(k + 1)
    product[upper] = r["products"]
    product = product + np.triu(product, 1).T
    cov = product / n - np.outer(s, s)
    mean = s + np.array(r["shift"])
    var = np.diag(cov)[:k]
    scale = np.sqrt(np.where(var > 1e-12 * np.maximum(1.0, mean[:k] ** 2), var, 1.0))
    used = np.where(var > 1e-12 * np.maximum(1.0, mean[:k] ** 2), 1.0, 0.0)
    a = n * cov[:k, :k] / np.outer(scale, scale) * np.outer(used, used) + alpha * np.eye(k)
    w = np.linalg.solve(a, n * cov[:k, k] / scale * used)
    b = w / scale
    return Ridge(tuple(features), tuple(map(float, w)), tuple(map(float, b)), float(mean[k] - b @ mean[:k]), int(n))
