"""Fit with a category column of any size, exact top counts, quantiles merged in groups."""
import random

import pytest
from pyspark.sql import functions as F

from conftest import SF0001
from duelframe.functions.ordering import quantile_edges, top_counts
from duelframe.operators import category_fit, newton
from duelframe.operators.evaluate import roc_auc


def _rows(spark, n, categories, seed=3):
    rng = random.Random(seed)
    effect = {c: rng.gauss(0, 1) for c in range(categories)}
    rows = []
    for i in range(n):
        c = 0 if rng.random() < 0.33 else rng.randrange(categories)  # one category holds a third of the rows
        x, z = rng.gauss(0, 1), rng.gauss(5, 2)
        y = int(rng.random() < 1 / (1 + 2.718281828 ** -(0.7 * x - 0.1 * z + effect[c])))
        rows.append((i, None if rng.random() < 0.05 else f"c{c}", x, z, y if rng.random() > 0.02 else None, 1.0 + c % 2))
    return spark.createDataFrame(rows, "id long, c string, x double, z double, y int, w double")


def test_equals_the_wide_form(spark):
    df = _rows(spark, 1500, 12).repartition(5).cache()
    got = category_fit.solve(df, ["x", "z"], F.col("c"), F.col("y"), 0.01, F.col("w"), [0.1, 5.0], [1.0, 2.0])
    names = sorted(r[0] for r in df.select("c").where("c is not null").distinct().collect())
    wide = df.select("x", "z", "y", "w", *[F.coalesce((F.col("c") == n).cast("double"), F.lit(0.0)).alias(n) for n in names])
    want = newton.solve(wide, ["x", "z", *names], F.col("y"), F.col("w"), [0.1, 5.0] + [0.0] * len(names),
                        [1.0, 2.0] + [1.0] * len(names), 0.01)
    found = {r["category"]: r["coefficient"] for r in got.categories.collect()}
    assert sorted(found) == names and got.passes <= 10
    for a, b in zip([*got.coefficients, got.intercept, *[found[n] for n in names]],
                    [*want.coefficients[:2], want.intercept, *want.coefficients[2:]]):
        assert abs(a - b) < 1e-8
    assert abs(got.loss - want.loss) < 1e-12


def test_a_category_per_row_stays_a_table(spark):
    df = _rows(spark, 3000, 5).withColumn("c", F.concat("c", F.lit("/"), F.col("id")))
    got = category_fit.solve(df, ["x"], F.col("c"), F.col("y"), 0.01)
    rows = df.where("y is not null and c is not null")
    # at the optimum each category's gradient vanishes: (p - y) / n + penalty * u = 0
    n = df.where("y is not null").count()
    m = F.lit(got.intercept) + F.lit(got.coefficients[0]) * F.col("x") + F.col("coefficient")
    slope = (1 / (1 + F.exp(-m)) - F.col("y")) / n + 0.01 * F.col("coefficient")
    worst = got.categories.withColumnRenamed("category", "c").join(rows, "c").agg(F.max(F.abs(slope)), F.count("*")).first()
    assert worst[0] < 1e-12 and worst[1] == rows.count() == got.categories.count()


def test_odd_inputs_of_the_fit(spark):
    df = _rows(spark, 60, 3)
    none = category_fit.solve(df.limit(0), ["x"], F.col("c"), F.col("y"), 0.1)
    assert none.categories.count() == 0 and none.coefficients == [0.0]
    alone = category_fit.solve(df.withColumn("c", F.lit(None).cast("string")), ["x"], F.col("c"), F.col("y"), 0.1)
    want = newton.solve(df, ["x"], F.col("y"), penalty=0.1)
    assert abs(alone.coefficients[0] - want.coefficients[0]) < 1e-9
    with pytest.raises(ValueError, match="penalty"):
        category_fit.solve(df, ["x"], F.col("c"), F.col("y"), 0.0)
    with pytest.raises(Exception, match="NULL or NaN"):
        category_fit.solve(df.withColumn("x", F.when(F.col("id") != 7, F.col("x"))), ["x"], F.col("c"), F.col("y"), 0.1)


def test_competitor_effects_registered(spark):
    from duelframe.plans.catalog import QUERIES
    got = QUERIES["competitor_effects"](spark, SF0001)
    assert got.columns == ["category", "coefficient"] and got.count() > 0


@pytest.mark.parametrize("n_buckets", [1, 7, 1 << 16])
def test_top_counts_with_a_long_tail(spark, n_buckets):
    tail = spark.range(20_000).select(F.concat(F.lit("t"), "id").alias("v"))
    heavy = spark.range(900).select(F.concat(F.lit("h"), (F.sqrt("id") / 3).cast("int")).alias("v"))
    df = tail.union(heavy).union(spark.range(50).select(F.lit(None).cast("string")))
    for k in (1, 3, 10, 15):  # 15: beyond the heavy ones, ties of the tail count by value
        got = [tuple(r) for r in top_counts(df, "v", k, n_buckets).collect()]
        want = df.where("v is not null").groupBy("v").count().orderBy(F.desc("count"), "v").limit(k).collect()
        assert got == [tuple(r) for r in want]


def test_top_counts_of_numbers_and_nothing(spark):
    df = spark.createDataFrame([(0.0,), (-0.0,), (1.0,), (None,), (float("nan"),), (float("nan"),), (float("nan"),)], "v double")
    got = [tuple(r) for r in top_counts(df, "v", 2).collect()]
    assert str(got) == str([(float("nan"), 3), (0.0, 2)])
    assert top_counts(df.limit(0), "v", 3).collect() == []


def test_top_counts_shuffles_a_part(spark):
    df = spark.range(200_000, numPartitions=4).select(F.when(F.col("id") % 4 == 0, F.col("id") % 5).otherwise(F.col("id")).alias("v"))
    out = top_counts(df, "v", 5)
    counted = [n for n in out._jdf.queryExecution().optimizedPlan().toString().splitlines() if "LeftSemi" in n]
    assert counted  # only values of chosen buckets are counted
    heavy = {r["value"] for r in out.collect()}
    assert heavy == {0, 1, 2, 3, 4}


def test_quantiles_of_groups(spark):
    df = spark.range(0, 100_000, numPartitions=50).select((F.col("id") * 7919 % 100_003).cast("double").alias("s"))
    edges = quantile_edges(df, "s", 64, 640)
    assert 60 <= len(edges) <= 63 and edges == sorted(edges)
    placed = df.select(F.size(F.filter(F.array(*map(F.lit, edges)), lambda e: e <= F.col("s"))).alias("b")).groupBy("b").count()
    sizes = [r["count"] for r in placed.collect()]
    assert len(sizes) == len(edges) + 1 and max(sizes) < 2.5 * 100_000 / 64
    assert quantile_edges(df.limit(0), "s", 64) == [] and quantile_edges(df, "s", 1) == []


def test_auc_over_a_million_distinct_scores(spark):
    df = spark.range(0, 1_000_000, numPartitions=40).select(
        (F.col("id") * 7919 % 1_000_003).cast("double").alias("score"), (F.xxhash64("id") % 3 == 0).cast("int").alias("target"))
    got = roc_auc(df).first()
    t = df.toPandas()
    ranks = t["score"].rank()
    pos = t["target"] == 1
    want = (ranks[pos].sum() - pos.sum() * (pos.sum() + 1) / 2) / (pos.sum() * (~pos).sum())
    assert abs(got.roc_auc - want) < 1e-10
