"""The three reference scripts end to end from a raw CSV (no key column)."""
import os

from pyspark.sql import functions as F

from conftest import SF0001
from duelframe import cli
from duelframe.plans.catalog import fin
from duelframe.plans.pipeline import ContestPipeline


def test_cli_run_matches_fixture_pipeline(spark, tmp_path, capsys):
    fixture = ContestPipeline(spark, SF0001, odds_direction=1)
    raw = fin(fixture.raw()).orderBy("bout_id")
    # pandas-style CSV: NA tokens for missing values, no key column, file order = key order
    text = raw.select(*[F.coalesce(F.col(c).cast("string"), F.lit("NA")).alias(c)
                        for c in raw.columns if c != "bout_id"])
    csv_dir = str(tmp_path / "raw")
    text.coalesce(1).write.option("header", True).csv(csv_dir)
    out = str(tmp_path / "out")
    doc = cli.main(["run", "--input", csv_dir, "--format", "csv", "--output", out,
                    "--direction", "1"], spark=spark).first()
    want = fixture.split_point()
    assert doc.split_info.train_rows == want.cut
    assert doc.split_info.test_rows == want.n_rows - want.cut
    assert doc.feature_count == len(fixture.feature_cols())
    assert os.path.isdir(os.path.join(out, "models", "full_model"))
    printed = capsys.readouterr().out
    assert "[column audit]" in printed and "[top coefficients]" in printed
    feats = spark.read.parquet(os.path.join(out, "features")).drop("year")
    assert feats.count() == 1500
    # same features as the fixture pipeline, row by row (keys follow file order)
    a = fixture.features().select("odds_diff", "wc_rank_diff", "target", "Date").orderBy("Date", "odds_diff").collect()
    b = feats.select("odds_diff", "wc_rank_diff", "target", "Date").orderBy("Date", "odds_diff").collect()
    assert a == b
    # training from a features CSV gives the same split and scores
    feats_csv = str(tmp_path / "features-csv")
    feats.coalesce(1).write.option("header", True).csv(feats_csv)
    again = cli.main(["train", "--input", feats_csv, "--format", "csv", "--output", str(tmp_path / "again"),
                      "--direction", "1"], spark=spark).first()
    assert again.split_info == doc.split_info and again.feature_count == doc.feature_count
    assert abs(again.model_metrics.roc_auc - doc.model_metrics.roc_auc) < 1e-6
    assert "[status of the full model]" in capsys.readouterr().out


def test_features_csv_is_typed_once_for_the_training(spark, tmp_path):
    path, out = str(tmp_path / "feats.csv"), str(tmp_path / "out")
    with open(path, "w") as f:
        f.write("bout_id,Date,target,odds_diff,year\n1,2020-01-02,1,3.5,2020\n2,NA,0,NA,NA\n3,2021-05-06,0,-1,2021\n")
    args = cli.parser().parse_args(["train", "--input", path, "--output", out])
    feats = cli._typed(spark, args)
    assert feats.columns == ["bout_id", "Date", "target", "odds_diff"]
    got = sorted((r["bout_id"], str(r["Date"]), r["target"], r["odds_diff"]) for r in feats.collect())
    assert got == [(1, "2020-01-02", 1, 3.5), (2, "None", 0, None), (3, "2021-05-06", 0, -1.0)]
    assert feats.inputFiles() and all(f.endswith(".parquet") for f in feats.inputFiles())
    assert "regexp" not in feats._jdf.queryExecution().optimizedPlan().toString()


def test_cli_eda_runs(spark, tmp_path, capsys):
    fixture = ContestPipeline(spark, SF0001, odds_direction=1)
    path = str(tmp_path / "raw.parquet")
    fixture.raw().drop("bout_id").write.parquet(path)
    cli.main(["eda", "--input", path], spark=spark)
    printed = capsys.readouterr().out
    assert "[missing values (top 15)]" in printed and "[yearly trend]" in printed


def test_cli_full_reference_schema(spark, tmp_path):
    """Hand-made rows with every column the reference reads (all pairs, all
    rank pairs, all 15 existing diffs): feature count and groups follow."""
    import random

    import pandas as pd

    from duelframe import config as C
    rnd = random.Random(17)
    n = 120
    data = {"RedFighter": [f"r{i}" for i in range(n)], "BlueFighter": [f"b{i}" for i in range(n)],
            "Date": [f"{1 + i % 12}/{1 + i % 28}/{2015 + i % 8}" for i in range(n)],  # M/d/yyyy text
            "Location": ["x"] * n, "Country": ["y"] * n,
            "Winner": [rnd.choice(["Red", "Blue"]) for _ in range(n)],
            "Finish": ["KO"] * n, "FinishDetails": ["-"] * n, "FinishRound": [1] * n,
            "FinishRoundTime": ["1:00"] * n, "TotalFightTimeSecs": [60] * n}
    for r, b in C.PAIRED_STATS.values():
        data[r] = [rnd.choice([None, round(rnd.uniform(-300, 300), 1)]) for _ in range(n)]
        data[b] = [round(rnd.uniform(-300, 300), 1) for _ in range(n)]
    for r, b in C.RANKING_PAIRS.values():
        data[r] = [rnd.choice([None, None, rnd.randint(1, 15)]) for _ in range(n)]
        data[b] = [rnd.choice([None, None, rnd.randint(1, 15)]) for _ in range(n)]
    for c in C.EXISTING_DIFF_COLUMNS:
        data[c] = [rnd.randint(-5, 5) for _ in range(n)]
    data["TitleBout"] = [rnd.choice([True, False]) for _ in range(n)]
    data["NumberOfRounds"] = [rnd.choice([3, 5]) for _ in range(n)]
    data["EmptyArena"] = [rnd.choice([None, 0, 1]) for _ in range(n)]
    data["RedStance"] = [rnd.choice(["Orthodox", "Southpaw", None]) for _ in range(n)]
    data["BlueStance"] = [rnd.choice(["Orthodox", "Switch"]) for _ in range(n)]
    data["WeightClass"] = [rnd.choice(["Lightweight", "Flyweight", "Heavyweight"]) for _ in range(n)]
    data["Gender"] = [rnd.choice(["MALE", "FEMALE"]) for _ in range(n)]
    data["BetterRank"] = [rnd.choice(["Red", "Blue", "neither", None]) for _ in range(n)]
    path = str(tmp_path / "contests.csv")
    pd.DataFrame(data).to_csv(path, index=False, na_rep="NA")

    doc = cli.main(["run", "--input", path, "--output", str(tmp_path / "out")], spark=spark).first()
    stance = 3 * 2   # (Orthodox, Southpaw, Unknown) x (Orthodox, Switch)
    want = 15 + 12 + 14 + 3 + stance + 3 + 3 + 1
    assert doc.feature_count == want
    assert doc.split_info.train_rows == int(n * 0.8)
    assert doc.split_info.test_rows == n - int(n * 0.8)
    feats = spark.read.parquet(str(tmp_path / "out" / "features"))
    assert "stance_matchup" in feats.columns and "Finish" not in feats.columns
    assert feats.filter(F.col("odds_diff").isNull()).count() == 0        # neutral fill
    assert feats.filter(F.col("draws_diff").isNull()).count() > 0        # left NULL, as in the reference


def test_cli_minimal_schema(spark, tmp_path):
    """Only the mandatory columns plus one existing diff: every stage and
    the EDA still run, skipping what is absent."""
    import pandas as pd
    n = 50
    pd.DataFrame({
        "Date": [f"2020-01-{1 + i % 28:02d}" for i in range(n)],
        "Winner": ["Red" if i % 3 else "Blue" for i in range(n)],
        "RedStance": ["Orthodox"] * n, "BlueStance": ["Southpaw" if i % 2 else "Orthodox" for i in range(n)],
        "RedFighter": ["a"] * n, "BlueFighter": ["b"] * n,
        "WinDif": [i % 5 - 2 for i in range(n)],
    }).to_csv(str(tmp_path / "mini.csv"), index=False)
    doc = cli.main(["run", "--input", str(tmp_path / "mini.csv"), "--output", str(tmp_path / "o")],
                   spark=spark).first()
    assert doc.feature_count == 1 + 2          # WinDif + two stance dummies
    assert len(doc.baselines) == 1 and doc.beat_odds_baseline is None
    cli.main(["eda", "--input", str(tmp_path / "mini.csv")], spark=spark)
