"""The metrics document (nested) and artifact persistence."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duelframe.operators import evaluate as ev
from duelframe.operators import split as sp
from duelframe.sources.io import write_table


def _split_info(p) -> DataFrame:
    ss = sp.split_summary(p.split())  # two rows

    def side(name, col):
        return F.max(F.when(F.col("split") == name, F.col(col)))
    return ss.agg(F.struct(
        side("train", "n_rows").alias("train_rows"),
        side("test", "n_rows").alias("test_rows"),
        side("train", "date_range").alias("train_date_range"),
        side("test", "date_range").alias("test_date_range"),
        side("train", "red_win_rate").alias("train_red_win_rate"),
        side("test", "red_win_rate").alias("test_red_win_rate")).alias("split_info"))


def metrics_document(p, timestamp=None) -> DataFrame:
    """One row shaped like the reference's metrics JSON; the time, a column,
    is the caller's, so that the document depends on the data alone."""
    maj = p.majority().select(F.struct(
        F.col("model").alias("name"), F.col("majority_label").alias("majority_class"),
        "accuracy", F.lit(None).cast("double").alias("roc_auc")).alias("b0"))
    odds_scored = p.odds_scored()
    if odds_scored is not None:
        odds = p.evaluate(odds_scored, "Odds Only (LogReg)").select(F.struct(
            F.col("model").alias("name"), F.lit(None).cast("string").alias("majority_class"),
            "accuracy", "roc_auc").alias("b1"))
    else:
        odds = maj.sparkSession.range(1).select(F.lit(None).cast(
            "struct<name:string,majority_class:string,accuracy:double,roc_auc:double>").alias("b1"))
    # accuracy, ROC-AUC and the confusion cells come from one grouped pass
    full = ev.roc_auc(p.full_scored(), pred="prediction", cells=True)
    rep = ev.report_from_cells(full).agg(
        F.collect_list(F.struct("label", "precision", "recall", "f1_score", "support"))
        .alias("classification_report"))  # five rows
    full = full.select("accuracy", "roc_auc", F.array(F.array("c00", "c01"), F.array("c10", "c11"))
                       .alias("confusion_matrix"))
    doc = (_split_info(p).crossJoin(maj).crossJoin(odds).crossJoin(full).crossJoin(rep))
    beat_odds = F.when(F.col("b1").isNull(), F.lit(None).cast("boolean")) \
        .otherwise(F.col("roc_auc") > F.col("b1.roc_auc"))
    at = [] if timestamp is None else [F.date_format(timestamp, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp")]
    return doc.select(
        *at, F.lit("LogisticRegression").alias("model_type"),
        "split_info",
        F.filter(F.array("b0", "b1"), lambda x: x.isNotNull()).alias("baselines"),
        F.struct("accuracy", "roc_auc", "confusion_matrix", "classification_report").alias("model_metrics"),
        F.lit(len(p.feature_cols())).alias("feature_count"),
        (F.col("accuracy") > F.col("b0.accuracy")).alias("beat_majority_baseline"),
        beat_odds.alias("beat_odds_baseline"))


def save_artifacts(p, out_dir: str) -> DataFrame:
    """Model pipeline (scaler + assembler + LR), feature manifest and metrics."""
    root = out_dir.rstrip("/")
    model = p.full_model()
    model.save(f"{root}/models/full_model")
    sc = p.scaler()
    spark = p.spark
    manifest = spark.createDataFrame(
        [(i, c, m, s) for i, (c, m, s) in enumerate(zip(sc.feature_cols, sc.means, sc.scales))],
        "position int, feature string, mean double, scale double")
    write_table(manifest.coalesce(1), f"{root}/models/feature_manifest")
    doc = metrics_document(p, F.current_timestamp())
    write_table(doc.coalesce(1), f"{root}/reports/metrics", fmt="json")
    return doc
