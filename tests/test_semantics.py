"""Hand-made rows for the semantic decisions."""
import datetime as dt
import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from duelframe import config as C
from duelframe.functions.ordering import kth_smallest
from duelframe.operators import evaluate as ev
from duelframe.operators import features as fe
from duelframe.operators import model as mo
from duelframe.operators import profile as pr
from duelframe.operators import quality as qa
from duelframe.operators import split as sp
from duelframe.plans.pipeline import ContestPipeline

RAW_DDL = ("bout_id bigint, Date date, RedFighter string, BlueFighter string, Winner string, "
           "RedOdds double, BlueOdds double, RMatchWCRank int, BMatchWCRank int, "
           "RedStance string, BlueStance string, WeightClass string, Gender string, "
           "BetterRank string, EmptyArena int, Finish string")


def raw_rows(spark):
    d = dt.date(2020, 1, 1)
    rows = [
        (1, d, "a", "b", "Red", -150.0, 130.0, 3, None, "Orthodox", "Southpaw", "Lightweight", "MALE", "Red", 0, "KO"),
        (2, d, "c", "d", "Blue", 100.0, 100.0, None, None, None, "Orthodox", None, None, None, None, "SUB"),
        (3, d, "e", "f", None, None, 120.0, None, 2, "Southpaw", None, "Flyweight", "FEMALE", "Blue", 1, None),
        (4, d, "g", "h", "Draw", 110.0, -130.0, 1, 4, "Orthodox", "Orthodox", "Lightweight", "MALE", "neither", 0, "DEC"),
    ]
    return spark.createDataFrame(rows, RAW_DDL)


def test_target_and_gender_null_safe(spark):  # Q1, Q2
    df = raw_rows(spark).select("bout_id", fe.target_expr().alias("t"), fe.gender_expr().alias("m"))
    got = {r.bout_id: (r.t, r.m) for r in df.collect()}
    assert got == {1: (1, 1), 2: (0, 0), 3: (0, 0), 4: (0, 1)}


def test_diff_fill_and_rank_sentinel(spark):  # Q3, Q5
    raw = raw_rows(spark)
    feats, spec = fe.feature_matrix(raw)
    got = {r.bout_id: r for r in feats.collect()}
    assert got[1].odds_diff == -280.0
    assert got[3].odds_diff == 0.0          # missing side -> NULL diff -> neutral 0
    assert got[2].wc_rank_diff == 0         # both unranked: 99 - 99
    assert got[1].wc_rank_diff == 3 - 99
    assert got[3].wc_rank_diff == 99 - 2
    assert got[2].EmptyArena == 0           # filled
    assert "RedOdds" not in spec.columns


def test_stance_unknown_and_null_category(spark):  # Q6, Q7, Q9
    feats, spec = fe.feature_matrix(raw_rows(spark))
    got = {r.bout_id: r.asDict() for r in feats.collect()}
    assert got[2]["stance_matchup"] == "Unknown_vs_Orthodox"
    assert got[3]["stance_matchup"] == "Southpaw_vs_Unknown"
    wc = spec.weight_class
    assert wc == ["wc_Flyweight", "wc_Lightweight"]           # sorted, no NULL slot
    assert all(got[2][c] == 0 for c in wc)                     # NULL -> all zeros
    assert "stance_matchup" not in spec.columns                # not swept in by prefix
    assert "wc_rank_diff" in spec.ranks and spec.columns.count("wc_rank_diff") == 1


def test_vocabulary_without_a_limit(spark):
    df = spark.range(1500).select(F.col("id").alias("bout_id"), F.col("id").cast("string").alias("RedStance"),
                                  F.lit("x").alias("BlueStance"), F.lit("Red").alias("Winner"))
    assert len(fe.discover_vocabulary(df).stance) == 1500
    categories, cells = fe.sparse_one_hot(df.withColumn("c", F.when(F.col("bout_id") % 7 != 0, F.col("RedStance"))), F.col("c"))
    want = {c: i for i, c in enumerate(sorted(str(i) for i in range(1500) if i % 7))}
    assert {r["category"]: r["position"] for r in categories.collect()} == want
    assert {r["bout_id"]: r["position"] for r in cells.collect()} == {i: want[str(i)] for i in range(1500) if i % 7}


def test_odd_category_names_are_safe(spark):  # apostrophe, dot, case, backtick
    cats = ["Women's Strawweight", "St. Weight", "orthodox", "Orthodox", "a`b"]
    rows = [(i, c, "s", "Red" if i % 2 else "Blue", dt.date(2020, 1, 1 + i % 28), float(i), 2.0) for i, c in enumerate(cats * 8)]
    df = spark.createDataFrame(rows, "bout_id long, WeightClass string, RedStance string, Winner string, Date date, "
                                     "RedOdds double, BlueOdds double").withColumn("BlueStance", F.col("RedStance"))
    feats, spec = fe.feature_matrix(df)
    assert len({c.lower() for c in spec.columns}) == len(spec.columns)
    checks = {r["check_name"]: (r["passed"], r["value"]) for r in qa.feature_checks(feats, spec.columns, spec.labels).collect()}
    assert checks["no_duplicate_columns"] == (0, 1)  # the real duplicate is reported
    assert qa.feature_nulls(feats, spec.columns).count() == 0
    p = ContestPipeline(spark, features=feats)
    assert mo.scaler_stats(p.train(), p.feature_cols()).count() == len(p.feature_cols())
    assert p.full_scored().count() == 8
    sums = feats.agg(*[F.sum(F.col(f"`{c}`")).alias(str(i)) for i, c in enumerate(spec.weight_class)]).first()
    assert list(sums) == [8] * 5


def test_missing_target_raises(spark):  # O9
    with pytest.raises(ValueError):
        qa.drop_leakage(raw_rows(spark).drop("Winner"))


def test_leakage_dropped_and_audited(spark):  # O8, O10, O11
    raw = raw_rows(spark)
    clean = qa.drop_leakage(raw)
    assert "Finish" not in clean.columns
    audit = {r.column_name: (r.status, r.non_null) for r in qa.column_audit(raw).collect()}
    assert audit["Finish"] == ("found", 3)
    assert audit["FinishDetails"] == ("missing", None)
    assert audit["Winner"] == ("found", 3)
    chk = qa.leakage_check(raw, clean).first()
    assert (chk.rows_kept, chk.target_non_null, chk.columns_removed) == (4, 3, 1)


def test_value_counts_percent_of_all_rows(spark):  # Q10
    vc = {r.value: (r.n, r.pct) for r in pr.value_counts(raw_rows(spark), "Winner").collect()}
    assert vc == {"Red": (1, 25.0), "Blue": (1, 25.0), "Draw": (1, 25.0)}


def test_favourite_strict_less(spark):  # Q14
    fo = {r.bout_id: (r.favorite_is_red, r.favorite_won)
          for r in pr.favorite_outcome(raw_rows(spark)).collect()}
    assert fo[2] == (0, 1)   # equal odds: Blue is the favourite, Blue won
    assert fo[1] == (1, 1)
    assert 3 not in fo       # incomplete row dropped


def test_majority_tie_goes_to_smaller_class(spark):  # Q13
    rows = [("train", 1), ("train", 0), ("test", 0), ("test", 1), ("test", 0)]
    r = mo.majority_baseline_split(spark.createDataFrame(rows, "split string, target int")).first()
    assert (r.majority_class, r.majority_label) == (0, "Blue")
    assert abs(r.accuracy - 2 / 3) < 1e-12


def test_pearson_matches_pandas_pairwise_and_constant(spark):  # Q20
    rng = np.random.default_rng(7)
    n = 3000
    a = rng.normal(size=n)
    b = 0.3 * a + rng.normal(size=n)
    a[rng.random(n) < 0.2] = np.nan
    b[rng.random(n) < 0.3] = np.nan
    pdf = pd.DataFrame({"a": a, "b": b, "k": 1.0, "target": (rng.random(n) < 0.5).astype(int)})
    sdf = spark.createDataFrame(
        [tuple(None if (isinstance(v, float) and math.isnan(v)) else v for v in row)
         for row in pdf.itertuples(index=False)], "a double, b double, k double, target int")
    got = {(r.row_feature, r.col_feature): r.corr
           for r in pr.corr_matrix(sdf, ["a", "b", "k"]).collect()}
    assert abs(got[("b", "a")] - pdf["a"].corr(pdf["b"])) < 1e-12
    assert got[("k", "a")] is None     # constant column: NULL, no ANSI failure
    tc = pr.target_corr(sdf, ["a", "b", "target"]).collect()
    assert [r.feature for r in tc] == sorted(["a", "b"], key=lambda c: -abs(pdf[c].corr(pdf["target"])))


def test_histogram_matches_numpy(spark):  # Q21
    rng = np.random.default_rng(3)
    v = np.round(rng.normal(0, 150, 5000), 2)
    t = (rng.random(5000) < 0.55).astype(int)
    sdf = spark.createDataFrame([(float(x), int(y), 5.0) for x, y in zip(v, t)],
                                "odds_diff double, target int, const double")
    h = pr.class_histogram(sdf, ["odds_diff", "const"])
    got = {(r.feature, r.target, r.bin): r.n for r in h.collect()}
    for cls in (0, 1):
        counts, _ = np.histogram(v[t == cls], bins=30)
        for b, c in enumerate(counts):
            assert got.get(("odds_diff", cls, b), 0) == c
        assert got[("const", cls, 15)] == (t == cls).sum()


def test_csv_na_tokens(spark, tmp_path):  # Q22
    from pyspark.sql import types as T

    from duelframe.sources.io import read_raw_csv
    lines = ["bout_id,RedOdds,Winner,TitleBout,Date,NumberOfRounds"]
    for i, tok in enumerate(C.NA_TOKENS):
        lines.append(f"{i},{tok},{tok},{tok},{tok},{tok}")
    lines.append("100,-150.5,Red,True,2020-01-02,3.0")
    lines.append("101,nan,Blue,False,not-a-date,5")
    p = tmp_path / "raw.csv"
    p.write_text("\n".join(lines) + "\n")
    schema = T.StructType([T.StructField("bout_id", T.LongType()), T.StructField("RedOdds", T.DoubleType()),
                           T.StructField("Winner", T.StringType()), T.StructField("TitleBout", T.BooleanType()),
                           T.StructField("Date", T.DateType()), T.StructField("NumberOfRounds", T.IntegerType())])
    df = read_raw_csv(spark, str(p), schema)
    rows = {r.bout_id: r for r in df.collect()}
    for i in range(len(C.NA_TOKENS)):
        r = rows[i]
        assert (r.RedOdds, r.Winner, r.TitleBout, r.Date, r.NumberOfRounds) == (None,) * 5, C.NA_TOKENS[i]
    assert rows[100].RedOdds == -150.5 and rows[100].TitleBout is True
    assert rows[100].Date == dt.date(2020, 1, 2) and rows[100].NumberOfRounds == 3
    assert rows[101].RedOdds is None and rows[101].Date is None


def _naive_split(rows, ratio):
    ok = sorted((r for r in rows if r[1] is not None), key=lambda r: (r[1], r[0]))
    cut = int(len(ok) * ratio)
    return {r[0]: ("train" if i < cut else "test") for i, r in enumerate(ok)}


@pytest.mark.parametrize("n,seed", [(6528, 1), (997, 2), (40, 3)])
def test_time_split_equals_global_sort(spark, n, seed):  # Q11, Q12, O65
    rnd = random.Random(seed)
    base = dt.date(2010, 1, 1)
    keys = rnd.sample(range(10 * n), n)
    rows = [(k, None if rnd.random() < 0.01 else base + dt.timedelta(days=rnd.randrange(30)),
             rnd.randrange(2)) for k in keys]
    df = spark.createDataFrame(rows, "bout_id bigint, Date date, target int")
    out, point = sp.time_split(df, 0.8)
    got = {r.bout_id: r.split for r in out.collect()}
    assert got == _naive_split(rows, 0.8)
    valid = sum(1 for r in rows if r[1] is not None)
    assert point.cut == int(valid * 0.8)
    q = sp.date_quality(df).first()
    assert q.invalid_dates == n - valid


def test_split_sizes_of_published_run(spark):
    df = spark.range(6528).select(F.col("id").alias("bout_id"),
                                  F.date_add(F.lit(dt.date(2010, 3, 21)), (F.col("id") / 2).cast("int")).alias("Date"),
                                  F.lit(1).alias("target"))
    out, point = sp.time_split(df, 0.8)
    s = {r.split: r.n_rows for r in sp.split_summary(out).collect()}
    assert s == {"train": 5222, "test": 1306}


def test_kth_smallest_iterative_path(spark):
    keys = random.Random(5).sample(range(10**9), 20000)
    df = spark.createDataFrame([(k,) for k in keys], "k bigint")
    srt = sorted(keys)
    for k in (1, 777, 12345, 20000):
        assert kth_smallest(df, "k", k, final_keys=500, n_edges=16).values == (srt[k - 1],)


def test_kth_smallest_any_type_nulls_and_repeats(spark):
    rnd = random.Random(8)
    keys = [(rnd.choice([None, "a", "b", "é", "zz"]), rnd.choice([None, *range(40)])) for _ in range(3000)]
    df = spark.createDataFrame(keys, "s string, n long")
    order = sorted(keys, key=lambda r: (r[0] is not None, (r[0] or "").encode(), r[1] is not None, r[1] or 0))
    for k in (1, 2, 900, 1501, 3000):
        for final in (5, 10_000):
            got = kth_smallest(df, ["s", "n"], k, final_keys=final, n_edges=7)
            assert got.values == order[k - 1]
            assert got.rows_before == order.index(order[k - 1]) and got.rows_at == order.count(order[k - 1])


def test_split_keys_null_or_repeated(spark):
    day = dt.date(2020, 1, 1)
    same = spark.createDataFrame([(7, day, 0)] * 400, "bout_id long, Date date, target int")
    with pytest.raises(sp.SplitKeyError, match="bout_id"):
        sp.time_split(same, 0.8)
    half = spark.createDataFrame([(None if i % 2 else i, i, day) for i in range(400)], "bout_id long, n long, Date date")
    out, point = sp.time_split(half, 0.8)  # the NULLs come first, so the cut is among the others
    assert out.where("split = 'train'").count() == point.cut == 320
    out, point = sp.time_split(half, 0.3, key=["bout_id", "n"])
    train = sorted(r["n"] for r in out.where("split = 'train'").collect())
    assert train == [i for i in range(400) if i % 2][:120]
    with pytest.raises(sp.SplitKeyError):
        sp.time_split(half, 0.3)


def _brute_auc(y, s):
    pos = [b for a, b in zip(y, s) if a == 1]
    neg = [b for a, b in zip(y, s) if a == 0]
    tot = sum((p > q) + 0.5 * (p == q) for p in pos for q in neg)
    return tot / (len(pos) * len(neg))


@pytest.mark.parametrize("n_buckets", [2, 16, 1024])
def test_roc_auc_exact_with_ties(spark, n_buckets):  # O81
    rnd = random.Random(11)
    y = [rnd.randrange(2) for _ in range(600)]
    s = [round(rnd.gauss(a * 0.7, 1), 1) for a in y]   # coarse scores -> many ties
    df = spark.createDataFrame(list(zip(y, s)), "target int, score double")
    got = ev.roc_auc(df, n_buckets=n_buckets).first()
    assert abs(got.roc_auc - _brute_auc(y, s)) < 1e-12
    assert (got.n_pos, got.n_neg) == (sum(y), len(y) - sum(y))


def test_report_from_published_confusion(spark):  # golden numbers
    cells = spark.createDataFrame([(400, 171, 313, 422)], "c00 long, c01 long, c10 long, c11 long")
    rep = {r.label: r for r in ev.report_from_cells(cells).collect()}
    assert round(rep["accuracy"].f1_score, 4) == 0.6294
    assert [round(x, 2) for x in (rep["Blue"].precision, rep["Blue"].recall, rep["Blue"].f1_score)] == [0.56, 0.70, 0.62]
    assert [round(x, 2) for x in (rep["Red"].precision, rep["Red"].recall, rep["Red"].f1_score)] == [0.71, 0.57, 0.64]
    assert (rep["Blue"].support, rep["Red"].support) == (571, 735)
    assert [round(x, 2) for x in (rep["macro avg"].precision, rep["macro avg"].recall, rep["macro avg"].f1_score)] == [0.64, 0.64, 0.63]
    assert [round(x, 2) for x in (rep["weighted avg"].precision, rep["weighted avg"].recall, rep["weighted avg"].f1_score)] == [0.65, 0.63, 0.63]


def _newton(X, y, w, reg_c=1.0, iters=50):
    """Minimise 0.5*||beta||^2 + C * sum w_i * logloss_i (intercept unpenalised)."""
    n, d = X.shape
    Xa = np.hstack([X, np.ones((n, 1))])
    beta = np.zeros(d + 1)
    pen = np.ones(d + 1)
    pen[-1] = 0
    for _ in range(iters):
        p = 1 / (1 + np.exp(-Xa @ beta))
        g = reg_c * Xa.T @ (w * (p - y)) + pen * beta
        H = reg_c * (Xa.T * (w * p * (1 - p))) @ Xa + np.diag(pen)
        beta -= np.linalg.solve(H, g)
    return beta


def test_logistic_matches_reference_objective(spark):  # O73, O74, O75
    rng = np.random.default_rng(0)
    n = 400
    X = rng.normal(size=(n, 3)) * [1.0, 5.0, 0.2]
    X[:, 2] = 0.0  # constant column (scaler divisor 1)
    y = (X[:, 0] + 0.1 * X[:, 1] + rng.normal(size=n) > 0.3).astype(int)
    rows = [(i, "train", int(y[i]), *map(float, X[i])) for i in range(n)]
    df = spark.createDataFrame(rows, "bout_id long, split string, target int, a double, b double, c double")
    cols = ["a", "b", "c"]
    sc = mo.Scaler.fit(df, cols)
    assert sc.scales[2] == 1.0
    m = mo.fit_logistic(df, cols, scaler=sc, balanced=True)
    Xs = (X - X.mean(axis=0)) / np.where(X.std(axis=0) == 0, 1, X.std(axis=0))
    wts = np.where(y == 1, n / (2 * y.sum()), n / (2 * (n - y.sum())))
    beta = _newton(Xs, y, wts)
    assert np.allclose(m.coefficients(), beta[:-1], atol=1e-6)
    assert abs(m.intercept - beta[-1]) < 1e-6 and m.passes <= 10
    beta2 = _newton(X[:, :1], y, np.ones(n))
    m2 = mo.fit_logistic(df, ["a"])
    assert abs(m2.coefficients()[0] - beta2[0]) < 1e-6 and abs(m2.intercept - beta2[1]) < 1e-6


def test_vocabulary_fit_on_train_only(spark):  # Q8 option
    from duelframe.plans.pipeline import ContestPipeline
    from conftest import SF001
    p_all = ContestPipeline(spark, SF001)
    p_tr = ContestPipeline(spark, SF001, vocab_on="train")
    assert set(p_tr.vocab().stance) <= set(p_all.vocab().stance)
    assert p_tr.split_point() == p_all.split_point()


def test_roc_auc_many_buckets_bucketizer_path(spark):
    rnd = random.Random(21)
    y = [rnd.randrange(2) for _ in range(3000)]
    s = [round(rnd.gauss(a * 0.5, 1), 3) for a in y]
    df = spark.createDataFrame(list(zip(y, s)), "target int, score double")
    got = ev.roc_auc(df, n_buckets=1500).first().roc_auc
    ys, ss = np.array(y), np.array(s)
    pos, neg = ss[ys == 1], ss[ys == 0]
    brute = ((pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()) / (len(pos) * len(neg))
    assert abs(got - brute) < 1e-12


def test_evaluation_row_single_pass_matches_parts(spark):
    rnd = random.Random(4)
    rows = [(rnd.randrange(2), round(rnd.random(), 2)) for _ in range(500)]
    df = spark.createDataFrame(rows, "target int, score double") \
        .withColumn("prediction", (F.col("score") > 0.5).cast("int"))
    one = ev.evaluation_row(df, "m").first()
    assert abs(one.accuracy - ev.accuracy(df).first().accuracy) < 1e-15
    assert abs(one.roc_auc - _brute_auc([r[0] for r in rows], [r[1] for r in rows])) < 1e-12


def test_time_split_hot_date_bounded_rounds(spark):
    """A date holding 40% of all rows straddles the cut; the tiebreak search
    must stay exact while never ordering more than 300 keys in one task."""
    rnd = random.Random(9)
    n = 20000
    keys = rnd.sample(range(10**7), n)
    hot = dt.date(2015, 6, 1)
    rows = []
    for i, k in enumerate(keys):
        if i < 0.4 * n:
            d = hot
        elif i < 0.75 * n:
            d = hot - dt.timedelta(days=1 + rnd.randrange(50))
        else:
            d = hot + dt.timedelta(days=1 + rnd.randrange(50))
        rows.append((k, d, 0))
    df = spark.createDataFrame(rows, "bout_id bigint, Date date, target int")
    out, point = sp.time_split(df, 0.5, final_keys=300)
    assert point.boundary_date == hot and point.key_threshold is not None
    got = {r.bout_id: r.split for r in out.collect()}
    assert got == _naive_split(rows, 0.5)


def test_top_k_per_group_with_hot_group(spark):
    from duelframe.functions.ordering import top_k_per_group
    rnd = random.Random(13)
    rows = [(i, "HOT" if i % 3 == 0 else f"g{i % 7}", round(rnd.uniform(-1000, 1000), 0))
            for i in range(6000)]   # ties on the balance are broken by key
    df = spark.createDataFrame(rows, "k bigint, grp string, bal double")
    got = {(r.grp, r.rank): r.k for r in top_k_per_group(
        df, ["grp"], [F.col("bal").desc(), F.col("k").asc()], 15).collect()}
    pdf = pd.DataFrame(rows, columns=["k", "grp", "bal"]).sort_values(
        ["grp", "bal", "k"], ascending=[True, False, True])
    pdf["rank"] = pdf.groupby("grp").cumcount() + 1
    want = {(g, r): k for g, r, k in pdf[pdf["rank"] <= 15][["grp", "rank", "k"]].itertuples(index=False)}
    assert got == want


def test_time_split_whole_dates(spark):  # Q12 option
    d0 = dt.date(2022, 5, 20)
    rows = [(i, d0 + dt.timedelta(days=i // 4), 0) for i in range(20)]   # 4 rows per date
    df = spark.createDataFrame(rows, "bout_id bigint, Date date, target int")
    out, point = sp.time_split(df, 0.5, whole_dates=True)                 # cut 10 falls inside day 3
    got = {r.bout_id: r.split for r in out.collect()}
    assert [k for k, v in sorted(got.items()) if v == "train"] == list(range(8))
    assert point.cut == 8
    out2, _ = sp.time_split(df, 0.4, whole_dates=True)                    # cut 8 ends a date exactly
    assert sum(r.split == "train" for r in out2.collect()) == 8


def test_lenient_dates_and_yearly_trend_on_text(spark):
    rows = [("2024-12-07", "Red"), ("12/7/2024", "Blue"), ("2023/1/5", "Red"), ("garbage", "Red"), (None, "Blue")]
    df = spark.createDataFrame(rows, "Date string, Winner string")
    q = sp.date_quality(df).first()
    assert (q.invalid_dates, q.valid_dates) == (2, 3)
    yt = {r.year: (r.fights, r.red_wins) for r in pr.yearly_trend(df).collect()}
    assert yt[2024] == (2, 1) and yt[2023] == (1, 1) and yt[None] == (2, 1)


def test_roc_auc_equals_spark_exact_evaluator(spark):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    from conftest import SF001
    from duelframe.plans.pipeline import ContestPipeline
    p = ContestPipeline.for_input(spark, SF001)
    scored = p.rule_scored()
    ours = ev.roc_auc(scored, n_buckets=7).first().roc_auc     # several buckets
    spark_exact = BinaryClassificationEvaluator(
        rawPredictionCol="score", labelCol="label", metricName="areaUnderROC", numBins=0
    ).evaluate(scored.withColumn("label", F.col("target").cast("double")))
    assert abs(ours - spark_exact) < 1e-9


def test_no_odds_columns_skips_odds_baseline(spark):  # Q19
    from duelframe.plans.pipeline import ContestPipeline
    rnd = random.Random(23)
    base = dt.date(2020, 1, 1)
    rows = [(i, base + dt.timedelta(days=i), rnd.choice(["Red", "Blue"]),
             rnd.choice(["Orthodox", "Southpaw"]), "Orthodox", rnd.choice(["MALE", "FEMALE"]),
             float(rnd.randint(-3, 3)))
            for i in range(60)]
    raw = spark.createDataFrame(rows, "bout_id bigint, Date date, Winner string, RedStance string, "
                                      "BlueStance string, Gender string, WinDif double")
    p = ContestPipeline(spark, raw=raw)
    assert p.odds_model() is None and "odds_diff" not in p.feature_cols()
    ev_rows = [r.model for r in ev.results_summary(p.metric_rows()).collect()]
    assert ev_rows == ["Majority Class", "Logistic Regression (Full)"]
    rows = p.metric_rows()
    cmp = ev.baseline_comparison(rows[-1], rows[0], None).first()
    assert cmp.beat_odds_baseline is None and cmp.beat_majority_baseline in (0, 1)
    from duelframe.plans.report import metrics_document
    doc = metrics_document(p).first()
    assert doc.beat_odds_baseline is None and len(doc.baselines) == 1
    assert doc.split_info.train_rows == 48
