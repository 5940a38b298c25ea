"""Logistic regression with a category column of any number of values.

The wide form turns every category into a column, and Newton's matrix grows
with their square.  Here a row has its dense features and one category, whose
coefficient stands in a table (category, coefficient) that is joined to the
rows and never reaches the driver.  As a row has one category, the categories'
part of the matrix is diagonal.  Eliminating it leaves a system as small as
the dense features:

    [A  B ] [d]   [g]        (A - sum_c b_c b_c' / D_c) d = g - sum_c b_c y_c / D_c
    [B' D ] [e] = [y]                                 e_c = (y_c - b_c . d) / D_c

A step needs, per category, the sums y_c, D_c and b_c (p + 2 numbers, combined
map-side, so a category with a third of the rows is no hot spot) and the dense
sums.  The per-category table is written at every step, which cuts the lineage.
The objective is that of ``newton.solve`` over dense features and unscaled 0/1
columns, all penalised but the intercept, so both give the same coefficients.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duelframe.operators.newton import MAX_STEPS
from duelframe.session import ensure_checkpoint_dir


@dataclass
class CategorySolution:
    coefficients: list[float]
    intercept: float
    categories: DataFrame  # (category, coefficient), one row per category of the rows
    loss: float
    passes: int


@dataclass
class _State:
    beta: np.ndarray
    table: DataFrame  # category, u, y, d, b: coefficient, gradient, curvature, mixed terms
    loss: float
    step: np.ndarray
    decrement: float


def solve(rows: DataFrame, features: list[str], category: Column, label: Column, penalty: float,
          weight: Column | None = None, means: list[float] | None = None, scales: list[float] | None = None,
          tol: float = 1e-10) -> CategorySolution:
    """Coefficients of the scaled ``features`` and of every value of ``category``.

    A row with a NULL category has none of them set; rows without a label are
    left out; a NULL or NaN feature is an error.  The penalty must be positive,
    as a category whose rows are all of one class has no finite coefficient
    without one.
    """
    if penalty <= 0:
        raise ValueError("the penalty must be positive")
    p = len(features)
    mean, scale = means or [0.0] * p, scales or [1.0] * p
    dense = [(F.col(f"`{c}`").cast("double") - F.lit(float(m))) / F.lit(float(s)) for c, m, s in zip(features, mean, scale)]
    data = rows.select(category.alias("category"), label.cast("double").alias("y"),
                       (F.lit(1.0) if weight is None else weight.cast("double")).alias("s"),
                       F.array(*dense, F.lit(1.0)).alias("x")).where("y is not null")
    bad = F.exists("x", lambda v: v.isNull() | F.isnan(v))
    data = data.withColumn("x", F.when(bad, F.raise_error(F.lit("a feature of the training rows is NULL or NaN"))
                                       .cast("array<double>")).otherwise(F.col("x")))
    root = f"{ensure_checkpoint_dir(rows.sparkSession).rstrip('/')}/duelframe-fit-{uuid.uuid4().hex}"
    total = data.agg(F.coalesce(F.sum("s"), F.lit(0.0))).first()[0]
    start = data.where("category is not null").select("category").distinct().withColumn("u", F.lit(0.0))
    now, passes = _at(data, start, np.zeros(p + 1), total, penalty, f"{root}/1"), 1
    share = 1.0
    while total > 0 and passes < MAX_STEPS and now.decrement > tol * tol:
        move = [F.lit(float(v)) for v in now.step]
        own = (F.col("y") - _dot(F.col("b"), move)) / F.col("d")
        moved = now.table.select("category", (F.col("u") - F.lit(share) * own).alias("u"))
        passes += 1
        trial = _at(data, moved, now.beta - share * now.step, total, penalty, f"{root}/{passes}")
        if trial.loss <= now.loss + 1e-13 * abs(now.loss):
            now, share = trial, 1.0
        else:
            share /= 2
            if share < 1e-3:  # the loss is at its floating-point floor
                break
    return CategorySolution(now.beta[:p].tolist(), float(now.beta[p]),
                            now.table.select("category", F.col("u").alias("coefficient")), now.loss, passes)


def _dot(x: Column, values: list[Column]) -> Column:
    return sum((x[i] * v for i, v in enumerate(values)), F.lit(0.0))


def _at(data: DataFrame, coefficients: DataFrame, beta: np.ndarray, total: float, penalty: float, path: str) -> _State:
    """The objective, and Newton's step, at these coefficients."""
    total, n = max(total, 1e-300), len(beta)
    of = coefficients.select(F.col("category").alias("of"), "u")
    margin = _dot(F.col("x"), [F.lit(float(v)) for v in beta]) + F.coalesce("u", F.lit(0.0))
    known = (data.join(of, F.col("category") == F.col("of"), "left").withColumn("m", margin)
             .withColumn("q", 1.0 / (1.0 + F.exp(-F.col("m")))))
    rows = known.select("category", "x", (F.col("s") * (F.col("q") - F.col("y"))).alias("r"),
                        (F.col("s") * F.col("q") * (1.0 - F.col("q"))).alias("h"),
                        (F.col("s") * (F.greatest("m", F.lit(0.0)) - F.col("m") * F.col("y")
                                       + F.log1p(F.exp(-F.abs("m"))))).alias("loss"))
    sums = (rows.where("category is not null").groupBy("category")
            .agg(F.sum("r").alias("r"), F.sum("h").alias("h"),
                 *[F.sum(F.col("h") * F.col("x")[i]).alias(f"b{i}") for i in range(n)]))
    table = sums.join(of, F.col("category") == F.col("of")).select(
        "category", "u", (F.col("r") / total + penalty * F.col("u")).alias("y"), (F.col("h") / total + penalty).alias("d"),
        F.array(*[F.col(f"b{i}") / total for i in range(n)]).alias("b"))
    table.write.parquet(path)
    table = data.sparkSession.read.schema(table.schema).parquet(path)

    i, j = np.triu_indices(n)
    gram = np.zeros((n, n))
    flat = _added(rows.select("x", "r", "h", "loss"), n)
    loss = flat[0] / total
    slope, gram[i, j] = flat[1:n + 1] / total, flat[n + 1:] / total
    flat = _added(table.select("b", (F.col("y") / F.col("d")).alias("r"), (1.0 / F.col("d")).alias("h"),
                               (F.col("u") * F.col("u")).alias("loss")), n)
    size, mixed = flat[0], flat[1:n + 1]
    through = np.zeros((n, n))
    through[i, j] = flat[n + 1:]
    pen = np.append(np.full(n - 1, penalty), 0.0)
    slope = slope + pen * beta
    gram[j, i], through[j, i] = gram[i, j], through[i, j]
    small = gram + np.diag(pen) - through
    step = np.linalg.lstsq(small, slope - mixed, rcond=1e-14)[0]
    squares = table.agg(F.coalesce(F.sum(F.col("y") * (F.col("y") - _dot(F.col("b"), [F.lit(float(v)) for v in step]))
                                         / F.col("d")), F.lit(0.0))).first()[0]
    loss += penalty / 2 * size + (pen * beta * beta).sum() / 2
    return _State(beta, table, float(loss), step, float(slope @ step + squares))


def _added(rows: DataFrame, n: int) -> np.ndarray:
    """Over rows (x, r, h, loss): the sums of loss, of r x, and of the upper triangle of h x x'."""
    i, j = np.triu_indices(n)
    size = 1 + n + len(i)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen = np.zeros(size), False
        for batch in batches:
            if batch.num_rows:
                x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, n)
                r, h, loss = (batch.column(k).to_numpy(zero_copy_only=False) for k in (1, 2, 3))
                total += np.concatenate([[loss.sum()], r @ x, ((x * h[:, None]).T @ x)[i, j]])
                seen = True
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(size, dtype=np.int32)), pa.array(total)], ["at", "v"])

    cells = rows.mapInArrow(run, "at int, v double").groupBy("at").agg(F.sum("v").alias("v")).toArrow()
    flat = np.zeros(size)
    flat[cells["at"].to_numpy()] = cells["v"].to_numpy()
    return flat
