"""Command line: the reference's three scripts plus the EDA profiles.

    python -m duelframe clean    --input raw.csv        --output out/cleaned
    python -m duelframe features --input out/cleaned    --output out/features
    python -m duelframe train    --input out/features   --output out
    python -m duelframe eda      --input raw.csv
    python -m duelframe run      --input raw.csv        --output out

Each stage reads the previous stage's output (CSV or parquet in, parquet
out), prints the small audit tables and writes its result; ``run`` chains
all three in one session.  Only small result tables are shown on the driver.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession

from duelframe import config as C
from duelframe.operators import evaluate as ev
from duelframe.operators import features as fe
from duelframe.operators import model as mo
from duelframe.operators import profile as pr
from duelframe.operators import quality as qa
from duelframe.operators import split as sp
from duelframe.plans.pipeline import ContestPipeline
from duelframe.plans.report import save_artifacts
from duelframe.session import build_session
from duelframe.sources.io import read_contests, read_features, write_features, write_table


def _show(title: str, df: DataFrame) -> None:
    """Print a small result table whole (rows bounded by columns or categories)."""
    rows = df.collect()
    print(f"\n[{title}]\n" + " | ".join(df.columns))
    for r in rows:
        print(" | ".join("" if v is None else str(v) for v in r))


def _fmt(path: str, fmt: str | None) -> str:
    return fmt or ("csv" if path.lower().endswith(".csv") else "parquet")


def _read(spark: SparkSession, args) -> DataFrame:
    return read_contests(spark, args.input, _fmt(args.input, args.format), multi_line=args.multi_line)


def _pipeline(spark: SparkSession, args, **inputs) -> ContestPipeline:
    return ContestPipeline(spark, ratio=args.ratio, odds_direction=args.direction,
                           whole_dates=args.whole_dates, vocab_on=args.vocab_on, **inputs)


def do_clean(spark, args, raw: DataFrame | None = None) -> DataFrame:
    raw = raw if raw is not None else _read(spark, args)
    _show("column audit", qa.column_audit(raw))
    qa.require_target(raw)
    _show("target distribution", pr.value_counts(raw, C.TARGET_COLUMN))
    clean = qa.drop_leakage(raw)
    write_table(clean, args.output, fmt=args.output_format)
    _show("post-check", qa.leakage_check(raw, clean))
    return clean


def do_features(spark, args, clean: DataFrame | None = None) -> DataFrame:
    if clean is None:
        clean = _read(spark, args)
    p = _pipeline(spark, args, clean=clean)
    _show("neutral fills", fe.fill_counts(clean))
    _show("rank coverage", pr.rank_coverage(clean))
    _show("top stance matchups", pr.top_values(
        clean.select(fe.stance_matchup_expr().alias("stance_matchup")), "stance_matchup", C.STANCE_TOP_N))
    feats, spec = p.features(), p.spec()
    _show("feature checks", qa.feature_checks(feats, spec.columns, spec.labels))
    _show("feature nulls (not filled, as in the reference)", qa.feature_nulls(feats, spec.columns))
    _show("feature groups", qa.feature_groups(feats, spec.groups()))
    write_features(feats, args.output)
    cols = [c for c in C.KEY_FEATURE_SAMPLE if c in feats.columns]
    _show("sample", feats.select("bout_id", "Date", *cols).orderBy("Date", "bout_id").limit(C.SAMPLE_ROWS))
    return feats


def _typed(spark: SparkSession, args) -> DataFrame:
    """Features from CSV, typed once: the training reads them in many passes, and each would parse the text again
    in plans that hold the parsing of every column."""
    typed = f"{args.output.rstrip('/')}/typed-features"
    write_features(_read(spark, args).drop("year"), typed)
    return read_features(spark, typed)


def do_train(spark, args, feats: DataFrame | None = None) -> DataFrame:
    if feats is None:
        feats = _typed(spark, args) if _fmt(args.input, args.format) == "csv" else read_features(spark, args.input)
    p = _pipeline(spark, args, features=feats)
    _show("dates", sp.date_quality(feats))
    _show("split", sp.split_summary(p.split()))
    _show("majority baseline", p.majority())
    if p.odds_model() is None:
        print("\n[odds baseline] skipped: odds_diff not found")
    _show("full model: classification report", ev.classification_report(p.full_scored()))
    _show("full model: confusion matrix", ev.confusion_counts(p.full_scored()))
    _show("top coefficients", mo.top_coefficients(p.full_model()))
    doc = save_artifacts(p, args.output)
    rows = p.metric_rows()
    _show("results", ev.results_summary(rows))
    _show("status of the full model", ev.results_status(rows[-1], rows[0], rows[1] if len(rows) == 3 else None))
    return doc


def do_eda(spark, args) -> None:
    raw = _read(spark, args)
    p = _pipeline(spark, args, raw=raw)
    clean, feats = p.clean(), p.features()
    _show("shape", qa.table_shape({"raw": raw, "clean": clean, "features": feats}))
    _show("date range", pr.date_range(raw))
    _show("dtypes", qa.dtype_census(raw))
    _show("columns with missing values", qa.missing_summary(raw))
    _show("missing values (top 15)", qa.missing_profile(raw))
    _show("winner distribution", pr.value_counts(clean, C.TARGET_COLUMN))
    _show("class-conditional histograms", pr.class_histogram(feats))
    _show("correlations", pr.corr_matrix(feats))
    _show("correlation with target", pr.target_corr(feats))
    if {"RedOdds", "BlueOdds"} <= set(clean.columns):
        _show("favourite win rate", pr.favorite_win_rate(clean))
    _show("yearly trend", pr.yearly_trend(clean).orderBy("year"))
    if "WeightClass" in clean.columns:
        _show("weight classes", pr.value_counts(clean, "WeightClass", with_percent=False))


def do_run(spark, args) -> DataFrame:
    out = args.output.rstrip("/")
    raw = _read(spark, args)
    a = argparse.Namespace(**{**vars(args), "output": f"{out}/cleaned"})
    clean = do_clean(spark, a, raw)
    a = argparse.Namespace(**{**vars(args), "output": f"{out}/features"})
    do_features(spark, a, spark.read.parquet(f"{out}/cleaned") if args.output_format == "parquet" else clean)
    a = argparse.Namespace(**{**vars(args), "output": out})
    return do_train(spark, a, read_features(spark, f"{out}/features"))


def parser() -> argparse.ArgumentParser:
    ap = argparse.ArgumentParser(prog="duelframe")
    ap.add_argument("command", choices=["clean", "features", "train", "eda", "run"])
    ap.add_argument("--input", required=True)
    ap.add_argument("--output", default="duelframe-out")
    ap.add_argument("--format", choices=["csv", "parquet"], default=None, help="input format")
    ap.add_argument("--output-format", choices=["csv", "parquet"], default="parquet")
    ap.add_argument("--multi-line", action="store_true", help="CSV fields may hold line breaks")
    ap.add_argument("--ratio", type=float, default=C.TRAIN_RATIO)
    ap.add_argument("--direction", type=int, choices=[-1, 1], default=-1,
                    help="-1: lower odds favour Red (American odds)")
    ap.add_argument("--whole-dates", action="store_true")
    ap.add_argument("--vocab-on", choices=["all", "train"], default="all")
    ap.add_argument("--master", default=None)
    return ap


def main(argv: list[str] | None = None, spark: SparkSession | None = None):
    args = parser().parse_args(argv)
    spark = spark or build_session(args.master)
    fn = {"clean": do_clean, "features": do_features, "train": do_train,
          "eda": do_eda, "run": do_run}[args.command]
    return fn(spark, args)


if __name__ == "__main__":
    main(sys.argv[1:])
