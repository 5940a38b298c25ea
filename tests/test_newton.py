"""The second-order fit against numpy, with few passes over the data."""
import numpy as np
import pytest
from pyspark.sql import functions as F
from test_semantics import _newton

from duelframe.operators import model as mo
from duelframe.operators import newton


def frame(spark, x, y, s=None, parts=5):
    cols = [f"f{k}" for k in range(x.shape[1])]
    rows = [(*map(float, r), int(t), float(1 if s is None else s[i])) for i, (r, t) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, ", ".join(f"{c} double" for c in cols) + ", target int, weight double").repartition(parts), cols


def test_equals_newton_in_numpy_with_weights_and_scales(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(900, 6)) * [1, 1000, 0.01, 5, 2, 1] + [0, 50, 3, 0, 0, 0]
    y = (x[:, 0] + x[:, 1] / 1000 + rng.normal(size=900) > 0.2).astype(int)
    s = rng.uniform(0.5, 2, 900)
    s *= 900 / s.sum()
    df, cols = frame(spark, x, y, s)
    mean, std = x.mean(axis=0), x.std(axis=0)
    got = newton.solve(df, cols, F.col("target"), F.col("weight"), mean.tolist(), std.tolist(), penalty=1 / 900)
    want = _newton((x - mean) / std, y, s)
    assert np.allclose(got.coefficients, want[:-1], atol=1e-9) and abs(got.intercept - want[-1]) < 1e-9
    assert got.passes <= 10


def test_separable_rows_need_halved_steps_and_stay_finite(spark):
    x = np.linspace(-1, 1, 200)[:, None] * 1e3
    y = (x[:, 0] > 0).astype(int)
    df, cols = frame(spark, x, y)
    got = newton.solve(df, cols, F.col("target"), penalty=1e-9)
    assert np.isfinite(got.coefficients).all() and got.coefficients[0] > 0 and got.passes <= newton.MAX_STEPS
    worse = newton.solve(df, cols, F.col("target"), penalty=1e-2)
    assert 0 < worse.coefficients[0] < got.coefficients[0]


def test_copied_and_constant_columns(spark):
    rng = np.random.default_rng(2)
    a = rng.normal(size=300)
    x = np.column_stack([a, a, np.zeros(300)])
    y = (a + rng.normal(size=300) > 0).astype(int)
    df, cols = frame(spark, x, y)
    got = newton.solve(df, cols, F.col("target"), penalty=1 / 300)
    assert abs(got.coefficients[0] - got.coefficients[1]) < 1e-9 and got.coefficients[2] == 0


def test_no_rows_one_class_and_nulls(spark):
    df, cols = frame(spark, np.array([[1.0], [2.0], [3.0]]), [1, 1, 1])
    assert newton.solve(df.limit(0), cols, F.col("target"), penalty=1.0) == newton.Solution([0.0], 0.0, 0.0, 1)
    one = newton.solve(df, cols, F.col("target"), penalty=1.0)
    assert np.isfinite(one.intercept) and one.intercept > 5
    holed = df.withColumn("f0", F.when(F.col("f0") > 1, F.col("f0")))
    with pytest.raises(Exception, match="NULL or NaN"):
        newton.solve(holed, cols, F.col("target"), penalty=1.0)
    skipped = newton.solve(holed, cols, F.col("target"), penalty=1.0, on_null="skip")
    whole = newton.solve(df.where("f0 > 1"), cols, F.col("target"), penalty=1.0)
    assert np.allclose(skipped.coefficients, whole.coefficients)


def test_declared_model_scores_saves_and_refuses_nulls(spark, tmp_path):
    df = spark.createDataFrame([(1, "test", 1, 2.0, -1.0), (2, "test", 0, -2.0, 0.0), (3, "test", 0, 0.0, 0.0)],
                               "bout_id long, split string, target int, a double, `b c` double")
    scaler = mo.Scaler(["a", "b c"], [0.5, 0.0], [2.0, 1.0])
    m = mo.FittedModel.declared(["a", "b c"], [3.0, -1.5], 0.25, scaler)
    margins = {1: 0.25 + 3 * 0.75 + 1.5, 2: 0.25 - 3 * 1.25, 3: 0.25 - 0.75}
    m.save(str(tmp_path / "m"))
    again = mo.FittedModel(type(m.pipeline).load(str(tmp_path / "m")), m.feature_cols, 0)
    for model in (m, again):
        for r in model.score(df).collect():
            assert r.prediction == (margins[r.bout_id] > 0) and abs(r.score - 1 / (1 + np.exp(-margins[r.bout_id]))) < 1e-15
    with pytest.raises(Exception, match="scored row is NULL"):
        m.score(df.withColumn("a", F.lit(None).cast("double"))).collect()


def test_features_are_built_once_and_the_packed_table_goes(spark):
    """However many passes, every source row is evaluated once; nothing stays in the checkpoint folder."""
    import os

    from duelframe.session import ensure_checkpoint_dir
    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, 2))
    y = (x[:, 0] + rng.normal(size=300) > 0).astype(int)
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    rows = spark.createDataFrame([(float(a), float(b), int(c)) for (a, b), c in zip(x, y)], "a double, b double, t int")
    folder = ensure_checkpoint_dir(spark).removeprefix("file:")
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    got = newton.solve(rows.mapInArrow(counted, rows.schema), ["a", "b"], F.col("t"), penalty=0.01)
    assert got.passes > 2 and seen.value == 300
    assert not [f for f in set(os.listdir(folder)) - before if f.startswith("duelframe-fit")]


def test_moments_match_numpy_with_nulls(spark):
    from duelframe.operators import model as mo
    rng = np.random.default_rng(4)
    x = rng.normal(1e6, 3, size=(500, 3))
    x[:, 2] = 7
    x[::9, 0] = np.nan
    rows = spark.createDataFrame([tuple(None if np.isnan(v) else float(v) for v in r) + (None,) for r in x],
                                 "a double, b double, c double, d double").repartition(5)
    scaler = mo.Scaler.fit(rows, ["a", "b", "c", "d"])
    assert np.allclose(scaler.means, [*np.nanmean(x, axis=0), 0.0], rtol=1e-14)
    assert np.allclose(scaler.scales, [np.nanstd(x[:, 0]), x[:, 1].std(), 1.0, 1.0], rtol=1e-9)
    assert mo.Scaler.fit(rows.limit(0), ["a"]).scales == [1.0]
