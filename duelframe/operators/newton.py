"""Second-order fit of L2-penalised logistic regression, one data pass per step.

The scaled rows are packed once, as bytes of doubles, into a table in the
checkpoint folder that the passes read and that goes when the fit ends; a pass
then spends its time on the sums and not on building the features again.

Objective: sum_i s_i * log-loss_i / sum_i s_i + penalty / 2 * |w|^2 over the
scaled features, intercept not penalised.  A pass aggregates loss, gradient
and weighted Gram matrix at the present coefficients: every task adds up its
rows, Spark adds up the tasks' cells by position (d * (d + 3) / 2 numbers a
task, whatever its rows), and the driver solves the small system.  Newton's
step converges quadratically; a step that does not lower the loss is halved.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duelframe.session import ensure_checkpoint_dir
from duelframe.sources.stages import delete

MAX_STEPS = 50


@dataclass
class Solution:
    coefficients: list[float]
    intercept: float
    loss: float
    passes: int


@dataclass
class _State:
    weight: float
    loss: float
    gradient: np.ndarray
    gram: np.ndarray


def solve(rows: DataFrame, features: list[str], label: Column, weight: Column | None = None, means: list[float] | None = None,
          scales: list[float] | None = None, penalty: float = 0.0, tol: float = 1e-10, on_null: str = "error") -> Solution:
    """Coefficients of the scaled ``features`` ((x - mean) / scale) that minimise the objective.

    Stops when the Newton decrement, which bounds the distance to the least
    loss, falls under ``tol`` squared, or no step lowers the loss.
    ``on_null='error'`` refuses rows with a NULL or NaN feature, 'skip' leaves
    them out; rows without a label are left out.  No rows, or one class only,
    give finite coefficients as long as there is a penalty; the intercept of
    one class alone grows until its steps no longer change the loss.
    """
    d = len(features)
    mean, scale = np.array(means or [0.0] * d), np.array(scales or [1.0] * d)
    data = rows.select(F.array(*[F.col(f"`{c}`").cast("double") for c in features]).alias("x"),
                       label.cast("double").alias("y"), (F.lit(1.0) if weight is None else weight.cast("double")).alias("s"))
    data = data.where("y is not null")
    path = f"{ensure_checkpoint_dir(rows.sparkSession).rstrip('/')}/duelframe-fit-{uuid.uuid4().hex}"
    try:
        return _steps(_packed(data, mean, scale, on_null, path), d, penalty, tol)
    finally:
        delete(rows.sparkSession, path)


def _steps(data: DataFrame, d: int, penalty: float, tol: float) -> Solution:
    pen = np.append(np.full(d, penalty), 0.0)

    def at(beta: np.ndarray) -> _State:
        s = _pass(data, beta)
        total = max(s.weight, 1e-300)
        return _State(s.weight, s.loss / total + (pen * beta * beta).sum() / 2, s.gradient / total + pen * beta,
                      s.gram / total + np.diag(pen))

    best = step = np.zeros(d + 1)
    now, passes, share = at(best), 1, 1.0
    while now.weight > 0 and passes < MAX_STEPS:
        if share == 1.0:
            step = _solved(now.gram, now.gradient)
            if now.gradient @ step <= tol * tol:
                break
        trial = at(best - share * step)
        passes += 1
        # tasks' sums arrive in any order, so equal losses differ in their last digits
        if trial.loss <= now.loss + 1e-13 * abs(now.loss):
            best, now, share = best - share * step, trial, 1.0
        else:
            share /= 2
            if share < 1e-3:  # the loss is at its floating-point floor
                break
    return Solution(best[:d].tolist(), float(best[d]), float(now.loss), passes)


def _solved(gram: np.ndarray, gradient: np.ndarray) -> np.ndarray:
    """Newton step by Cholesky factors; by least squares where the matrix is singular."""
    try:
        low = np.linalg.cholesky(gram)
        return np.linalg.solve(low.T, np.linalg.solve(low, gradient))
    except np.linalg.LinAlgError:
        return np.linalg.lstsq(gram, gradient, rcond=1e-12)[0]


def _packed(data: DataFrame, mean: np.ndarray, scale: np.ndarray, on_null: str, path: str) -> DataFrame:
    """Table (x, y, s): a row's scaled features and a 1 for the intercept as bytes of doubles, label and weight."""
    d = len(mean)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, d) if d else np.zeros((batch.num_rows, 0))
            whole = ~np.isnan(x).any(axis=1)
            if not whole.all():
                if on_null == "error":
                    raise ValueError("a feature of the training rows is NULL or NaN")
                x, batch = x[whole], batch.filter(pa.array(whole))
            x = np.hstack([(x - mean) / scale, np.ones((len(x), 1))])
            ends = pa.py_buffer(np.arange(len(x) + 1, dtype=np.int32) * (8 * (d + 1)))
            rows = pa.Array.from_buffers(pa.binary(), len(x), [None, ends, pa.py_buffer(x.tobytes())])
            yield pa.RecordBatch.from_arrays([rows, batch.column(1), batch.column(2)], ["x", "y", "s"])

    packed = data.mapInArrow(run, "x binary, y double, s double")
    packed.write.parquet(path)
    return data.sparkSession.read.schema(packed.schema).parquet(path)


def _pass(data: DataFrame, beta: np.ndarray) -> _State:
    """Sums of weight, loss, gradient and Gram matrix over all packed rows."""
    n = len(beta)
    i, j = np.triu_indices(n)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(2 + n + len(i))
        seen = False
        for batch in batches:
            if not batch.num_rows:
                continue
            column = batch.column(0)
            x = np.frombuffer(column.buffers()[2], count=len(column) * n, offset=8 * n * column.offset).reshape(-1, n)
            y, s = (batch.column(k).to_numpy(zero_copy_only=False) for k in (1, 2))
            m = x @ beta
            p = 1.0 / (1.0 + np.exp(-np.clip(m, -700, 700)))
            loss = np.maximum(m, 0) - m * y + np.log1p(np.exp(-np.abs(m)))
            gram = (x * (s * p * (1 - p))[:, None]).T @ x
            total += np.concatenate([[s.sum(), (s * loss).sum()], x.T @ (s * (p - y)), gram[i, j]])
            seen = True
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total), dtype=np.int32)), pa.array(total)], ["at", "v"])

    cells = data.mapInArrow(run, "at int, v double").groupBy("at").agg(F.sum("v").alias("v")).toArrow()
    flat = np.zeros(2 + n + len(i))
    flat[cells["at"].to_numpy()] = cells["v"].to_numpy()
    gram = np.zeros((n, n))
    gram[i, j] = gram[j, i] = flat[n + 2:]
    return _State(flat[0], flat[1], flat[2:n + 2], gram)
