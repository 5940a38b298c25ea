"""Scaler statistics, class weights and the three baselines.

Objective matching: scikit-learn's default L2 logistic regression minimises
0.5*||w||^2 + C * sum_i s_i * loss_i with C = 1.  The fit minimises
(sum_i s_i * loss_i) / sum_i s_i + penalty * 0.5*||w||^2.  With plain or
balanced weights sum_i s_i = n, so a penalty of 1/n gives the same optimum.
The scaler uses the *population* standard deviation, with divisor 1 for
constant columns.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from duelframe import config as C
from duelframe.functions.exprs import class_label, long_rows
from duelframe.operators import newton

#: A fit ends when the Newton decrement (twice its loss above the minimum, per row) is below this squared.
TOL = 1e-10


def training_columns(columns: list[str]) -> list[str]:
    """Feature columns = everything not excluded (reference exclusion list)."""
    return [c for c in columns
            if c not in C.EXCLUDE_AT_TRAINING and c not in ("bout_id", "split", "year")]


def training_view(split_df: DataFrame, feature_cols: list[str], missing: str = "zero",
                  key: str = "bout_id") -> DataFrame:
    """key, split, target and double features.

    ``missing``: 'error' raises at fit time like the reference's solver on
    NaN (VectorAssembler's default), 'zero' fills remaining NULLs with the
    neutral 0 the reference uses for odds and percentages.
    """
    feats = [(F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(0.0)) if missing == "zero"
              else F.col(f"`{c}`").cast("double")).alias(c) for c in feature_cols]
    return split_df.select(F.col(key), "split", F.col("target").cast("int").alias("target"), *feats)


# --- O64 / O72: scaler ----------------------------------------------------------

def scaler_stats_wide(train: DataFrame, feature_cols: list[str]) -> DataFrame:
    """One row: mean and population std of every feature (one pass)."""
    aggs = []
    for i, c in enumerate(feature_cols):
        aggs += [F.avg(F.col(f"`{c}`")).alias(f"m{i}"), F.stddev_pop(F.col(f"`{c}`")).alias(f"s{i}")]
    return train.agg(*aggs)


def scaler_stats(train: DataFrame, feature_cols: list[str]) -> DataFrame:
    wide = scaler_stats_wide(train, feature_cols)
    return long_rows(wide, ["feature", "mean", "std"],
                     [(c, F.col(f"m{i}"), F.col(f"s{i}")) for i, c in enumerate(feature_cols)]) \
        .withColumn("scale", F.when(F.col("std") == 0, F.lit(1.0)).otherwise(F.col("std")))


def moments(train: DataFrame, feature_cols: list[str]) -> DataFrame:
    """(at, mean, square): mean and mean squared deviation of the at-th feature, NULLs left out.

    Tasks add up whole columns; a feature without values has no row.
    """
    d = len(feature_cols)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, mean, spread = np.zeros(d), np.zeros(d), np.zeros(d)
        for batch in batches:
            if not batch.num_rows:
                continue
            column = batch.column(0).flatten()
            x = column.to_numpy(zero_copy_only=False).reshape(-1, d)
            there = column.is_valid().to_numpy(zero_copy_only=False).reshape(-1, d)
            k = there.sum(axis=0).astype(float)
            own = np.where(there, x, 0.0).sum(axis=0) / np.maximum(k, 1)
            off = own - mean
            spread += (np.where(there, x - own, 0.0) ** 2).sum(axis=0) + off ** 2 * n * k / np.maximum(n + k, 1)
            mean += off * k / np.maximum(n + k, 1)
            n += k
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(d, dtype=np.int32)), pa.array(n), pa.array(mean),
                                          pa.array(spread)], ["at", "n", "m", "spread"])

    parts = (train.select(F.array(*[F.col(f"`{c}`").cast("double") for c in feature_cols]).alias("x"))
             .mapInArrow(run, "at int, n double, m double, spread double").where("n > 0"))
    every = Window.partitionBy("at")  # a row per task
    whole = parts.withColumn("mean", F.sum(F.col("n") * F.col("m")).over(every) / F.sum("n").over(every))
    off = F.col("m") - F.col("mean")
    return whole.groupBy("at", "mean").agg((F.sum(F.col("spread") + F.col("n") * off * off) / F.sum("n")).alias("square"))


@dataclass
class Scaler:
    feature_cols: list[str]
    means: list[float]
    scales: list[float]

    @classmethod
    def fit(cls, train: DataFrame, feature_cols: list[str]) -> "Scaler":
        found = {r["at"]: r for r in moments(train, feature_cols).collect()}  # one row per feature
        means = [float(found[i]["mean"]) if i in found else 0.0 for i in range(len(feature_cols))]
        scales = [(math.sqrt(found[i]["square"]) or 1.0) if i in found else 1.0 for i in range(len(feature_cols))]
        return cls(feature_cols, means, scales)

    def scaled_name(self, c: str) -> str:
        return f"{c}__z"

    def statement(self) -> str:
        """SQLTransformer statement: keeps every input column and adds the
        standardised feature ``<c>__z`` for each feature."""
        quoted = lambda name: "`" + name.replace("`", "``") + "`"
        parts = [f"({quoted(c)} - ({m!r})) / ({s!r}) AS {quoted(self.scaled_name(c))}"
                 for c, m, s in zip(self.feature_cols, self.means, self.scales)]
        return f"SELECT *, {', '.join(parts)} FROM __THIS__"

    def transform(self, df: DataFrame, passthrough: list[str]) -> DataFrame:
        out = SQLTransformer(statement=self.statement()).transform(df)
        return out.select(*passthrough, *[F.col(f"`{self.scaled_name(c)}`").alias(c)
                                          for c in self.feature_cols])


# --- O75: class weights -----------------------------------------------------------

def class_weights(train: DataFrame, target: str = "target") -> DataFrame:
    """Balanced weights n / (k * n_class) per class, from one pass.

    The window runs over the per-class counts (k rows, two for a binary
    target), never over data rows.
    """
    counts = train.groupBy(F.col(target).alias("class")).agg(F.count(F.lit(1)).alias("n_class"))
    every = Window.partitionBy()
    return counts.select(
        "class", "n_class",
        (F.sum("n_class").over(every) / (F.count(F.lit(1)).over(every) * F.col("n_class")))
        .alias("weight"))


def with_weights(train: DataFrame, target: str = "target") -> DataFrame:
    w = class_weights(train, target).select(F.col("class").alias(target), "weight")
    return train.join(F.broadcast(w), target)  # <= 2 rows


# --- O62 / O76: majority class -------------------------------------------------------

def majority_baseline_split(view: DataFrame, target: str = "target", split: str = "split") -> DataFrame:
    """Majority class of the train side and its accuracy on the test side.

    Ties go to the smaller class (pandas' sorted mode).

    One pass: counts per (side, class) -- at most 2 x classes rows -- then
    a window over that small table picks the train mode.
    """
    c = view.groupBy(F.col(split).alias("_side"), F.col(target).alias("_cls")) \
        .agg(F.count(F.lit(1)).alias("_n"))
    train_n = F.when(F.col("_side") == "train", F.col("_n"))
    mode = Window.partitionBy().orderBy(train_n.desc_nulls_last(), F.col("_cls").asc())
    c = c.withColumn("majority_class", F.first("_cls").over(mode))
    test_n = F.when(F.col("_side") == "test", F.col("_n"))
    hits = F.when((F.col("_side") == "test") & (F.col("_cls") == F.col("majority_class")), F.col("_n"))
    return c.groupBy("majority_class").agg(
        F.try_divide(F.sum(hits).cast("double"), F.sum(test_n).cast("double")).alias("accuracy")
    ).select(F.lit("Majority Class").alias("model"),
             class_label(F.col("majority_class")).alias("majority_label"),
             F.col("majority_class").cast("int"),
             F.coalesce(F.col("accuracy"), F.lit(0.0)).alias("accuracy"))


# --- O73 / O74 / O77 / O78 / O79: logistic regression -----------------------------------

def linear_statement(columns: list[str], weights: list[float], intercept: float, on_null: str = "error") -> str:
    """SQLTransformer statement: margin, predicted class and P(class 1) of a linear model."""
    quoted = lambda name: "`" + name.replace("`", "``") + "`"
    terms = [f"CAST({quoted(c)} AS DOUBLE) * CAST({w!r} AS DOUBLE)" for c, w in zip(columns, weights)]
    margin = " + ".join([f"CAST({intercept!r} AS DOUBLE)", *terms])
    if on_null == "error":
        margin = f"coalesce({margin}, CAST(raise_error('a feature of a scored row is NULL') AS DOUBLE))"
    return (f"SELECT *, CAST(margin > 0 AS INT) AS prediction, 1.0D / (1.0D + exp(-margin)) AS score"
            f" FROM (SELECT *, {margin} AS margin FROM __THIS__)")


@dataclass
class FittedModel:
    """A scaler (optional) and a linear model, both as stages of public SQL transformers."""

    pipeline: PipelineModel
    feature_cols: list[str]
    n_train: int
    weights: list[float] | None = None
    intercept: float | None = None
    passes: int = 0

    @classmethod
    def declared(cls, feature_cols: list[str], weights: list[float], intercept: float = 0.0,
                 scaler: Scaler | None = None, on_null: str = "error", n_train: int = 0, passes: int = 0) -> "FittedModel":
        """A model of given coefficients (of the scaled features, if there is a scaler)."""
        inputs = feature_cols if scaler is None else [scaler.scaled_name(c) for c in feature_cols]
        stages = [] if scaler is None else [SQLTransformer(statement=scaler.statement())]
        stages.append(SQLTransformer(statement=linear_statement(inputs, weights, intercept, on_null)))
        return cls(PipelineModel(stages), feature_cols, n_train, list(weights), intercept, passes)

    def coefficients(self) -> list[float]:
        if self.weights is None:
            raise ValueError("a reloaded model scores rows; its coefficients are in the manifest")
        return list(self.weights)

    def score(self, df: DataFrame, key: str = "bout_id") -> DataFrame:
        """key, split, target, prediction (0/1), score = P(class 1)."""
        return self.pipeline.transform(df).select(F.col(key), "split", "target", "prediction", "score")

    def save(self, path: str) -> None:
        self.pipeline.write().overwrite().save(path)


def fit_logistic(train: DataFrame, feature_cols: list[str], scaler: Scaler | None = None,
                 balanced: bool = False, handle_invalid: str = "error", n_train: int | None = None,
                 tol: float = TOL) -> FittedModel:
    """Fit [optional scaler] -> L2 logistic regression by Newton steps, one pass over ``train`` each.

    ``n_train`` (rows of ``train``) sets the penalty ``1/n``; it is counted
    when not supplied.
    """
    n_train = n_train if n_train is not None else train.count()
    weight = None
    if balanced:  # a number per class, so that a pass has no join
        weight = F.lit(None).cast("double")
        for r in class_weights(train).where("class is not null").collect():
            weight = F.when(F.col("target") == r["class"], F.lit(r["weight"])).otherwise(weight)
    found = newton.solve(train, feature_cols, F.col("target"), weight,
                         scaler.means if scaler else None, scaler.scales if scaler else None,
                         penalty=1.0 / max(n_train, 1), tol=tol, on_null=handle_invalid)
    return FittedModel.declared(feature_cols, found.coefficients, found.intercept, scaler, handle_invalid,
                                n_train, found.passes)


def coefficient_table(model: FittedModel) -> DataFrame:
    """(position, feature, coefficient, |coefficient|): one row per feature,
    built from the fitted parameters (bounded by the feature count)."""
    spark = SparkSession.getActiveSession()
    rows = [(i, c, float(w), abs(float(w)))
            for i, (c, w) in enumerate(zip(model.feature_cols, model.coefficients()))]
    return spark.createDataFrame(
        rows, "position int, feature string, coefficient double, abs_coefficient double")


def top_coefficients(model: FittedModel, n: int = C.TOP_COEFFICIENTS) -> DataFrame:
    return (coefficient_table(model)
            .orderBy(F.col("abs_coefficient").desc(), F.col("feature")).limit(n)
            .drop("position"))
