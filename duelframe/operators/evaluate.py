"""Evaluation: accuracy, exact ROC-AUC, confusion matrix, per-class report,
baseline comparison and the results summary.

Inputs are scored tables with a 0/1 label, a 0/1 prediction and a score.
Everything is an aggregation; the confusion grid is a fixed 2x2 table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from duelframe import config as C
from duelframe.functions.exprs import long_rows
from duelframe.functions.ordering import bucketize, prefix_before, quantile_edges


def accuracy(scored: DataFrame, label: str = "target", pred: str = "prediction") -> DataFrame:
    return scored.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.avg((F.col(pred) == F.col(label)).cast("double")).alias("accuracy"))


BUCKETS = 1024


def roc_auc(scored: DataFrame, label: str = "target", score: str = "score",
            pred: str | None = None, cells: bool = False, n_buckets: int = BUCKETS) -> DataFrame:
    """Exact ROC-AUC; tied scores get half credit.

    AUC = sum over distinct scores s of pos(s) * (neg(<s) + neg(s)/2) / (P*N).
    ``neg(<s)`` is a running sum over distinct scores.  Scores are grouped
    first (ties collapse, so a score shared by a third of the rows is one
    row), cut into ``n_buckets`` quantile buckets, bucket offsets come from
    the (bounded) bucket totals, and the running sum inside each bucket is a
    window partitioned by bucket.  The plan is the same at every size.

    ``pred`` adds the accuracy of that prediction column, computed in the
    same pass, and ``cells`` the four confusion cells c00, c01, c10, c11.
    Rows with a NULL score or label are left out.
    """
    y = F.col(label).cast("bigint")
    aggs = {"_pos": y, "_neg": F.lit(1) - y}
    if pred is not None:
        aggs["_ok"] = (F.col(pred) == F.col(label)).cast("bigint")
    if cells:
        aggs |= {f"c{a}{p}": ((F.col(label) == a) & (F.col(pred) == p)).cast("bigint") for a in (0, 1) for p in (0, 1)}
    g = (scored.filter(F.col(score).isNotNull() & F.col(label).isNotNull())
         .groupBy(F.col(score).alias("_s")).agg(*[F.sum(c).alias(n) for n, c in aggs.items()]))
    gb = bucketize(g, "_s", quantile_edges(g, "_s", n_buckets, 10 * n_buckets), "_b")
    offsets = prefix_before(gb.groupBy("_b").agg(F.sum("_neg").alias("_bneg")), ["_b"], ["_bneg"])
    w = Window.partitionBy("_b").orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)
    below = (gb.join(F.broadcast(offsets.select("_b", "_bneg_before")), "_b")  # <= n_buckets rows
             .withColumn("_below", F.col("_bneg_before") + F.coalesce(F.sum("_neg").over(w), F.lit(0))))
    pos, neg = F.sum("_pos"), F.sum("_neg")
    credit = F.sum(F.col("_pos").cast("double") * (F.col("_below").cast("double") + 0.5 * F.col("_neg")))
    out = [F.try_divide(credit, pos.cast("double") * neg.cast("double")).alias("roc_auc"),
           pos.cast("bigint").alias("n_pos"), neg.cast("bigint").alias("n_neg")]
    if pred is not None:
        out.append(F.try_divide(F.sum("_ok").cast("double"), (pos + neg).cast("double"))
                   .alias("accuracy"))
    if cells:
        out += [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in aggs if c.startswith("c")]
    return below.agg(*out)


def confusion_cells(scored: DataFrame, label: str = "target", pred: str = "prediction") -> DataFrame:
    """One row c00, c01, c10, c11 (c<actual><predicted>)."""
    a, p = F.col(label), F.col(pred)
    return scored.agg(*[F.count_if((a == i) & (p == j)).alias(f"c{i}{j}")
                        for i in (0, 1) for j in (0, 1)])


def confusion_counts(scored: DataFrame, label: str = "target", pred: str = "prediction") -> DataFrame:
    """Rows = actual, columns = predicted; all four cells, zeros kept."""
    return confusion_long(confusion_cells(scored, label, pred))


def confusion_long(cells: DataFrame) -> DataFrame:
    return long_rows(cells, ["actual", "predicted", "n"],
                     [(a, p, F.col(f"c{a}{p}")) for a in (0, 1) for p in (0, 1)])


def report_from_cells(cells: DataFrame) -> DataFrame:
    """Classification report (precision, recall, F1, support) from the four
    confusion cells in columns c00, c01, c10, c11 (one row)."""
    c00, c01, c10, c11 = (F.col(x).cast("double") for x in ("c00", "c01", "c10", "c11"))

    def zdiv(a, b):  # scikit-learn reports 0 where the ratio is undefined
        return F.coalesce(F.try_divide(a, b), F.lit(0.0))

    p0, r0 = zdiv(c00, c00 + c10), zdiv(c00, c00 + c01)
    p1, r1 = zdiv(c11, c11 + c01), zdiv(c11, c11 + c10)
    f0, f1 = zdiv(2 * p0 * r0, p0 + r0), zdiv(2 * p1 * r1, p1 + r1)
    s0, s1 = c00 + c01, c10 + c11
    tot = s0 + s1
    acc = zdiv(c00 + c11, tot)
    stats = cells.select(
        p0.alias("p0"), r0.alias("r0"), f0.alias("f0"), s0.alias("s0"),
        p1.alias("p1"), r1.alias("r1"), f1.alias("f1"), s1.alias("s1"),
        acc.alias("acc"), tot.alias("tot"))
    none = F.lit(None).cast("double")
    x = {c: F.col(c) for c in ("p0", "r0", "f0", "s0", "p1", "r1", "f1", "s1", "acc", "tot")}

    def weighted(a, b):
        return F.try_divide(x[a] * x["s0"] + x[b] * x["s1"], x["tot"])

    return long_rows(stats, ["label", "precision", "recall", "f1_score", "support"], [
        (C.CLASS_LABELS[0], x["p0"], x["r0"], x["f0"], x["s0"]),
        (C.CLASS_LABELS[1], x["p1"], x["r1"], x["f1"], x["s1"]),
        ("accuracy", none, none, x["acc"], x["tot"]),
        ("macro avg", (x["p0"] + x["p1"]) / 2, (x["r0"] + x["r1"]) / 2, (x["f0"] + x["f1"]) / 2, x["tot"]),
        ("weighted avg", weighted("p0", "p1"), weighted("r0", "r1"), weighted("f0", "f1"), x["tot"]),
    ]).withColumn("support", F.col("support").cast("bigint"))


def classification_report(scored: DataFrame, label: str = "target", pred: str = "prediction") -> DataFrame:
    return report_from_cells(confusion_cells(scored, label, pred))


def evaluation_row(scored: DataFrame, name: str, label: str = "target",
                   pred: str = "prediction", score: str | None = "score") -> DataFrame:
    """One row: model name, accuracy, ROC-AUC (NULL without a score).

    With a score, accuracy and AUC come from the same grouped pass.
    """
    if score is None:
        return accuracy(scored, label, pred).select(
            F.lit(name).alias("model"), "accuracy", F.lit(None).cast("double").alias("roc_auc"))
    return roc_auc(scored, label, score, pred=pred).select(
        F.lit(name).alias("model"), "accuracy", "roc_auc")


def baseline_comparison(candidate: DataFrame, majority: DataFrame, odds: DataFrame | None) -> DataFrame:
    """Two flags: candidate beats the majority class on accuracy and the
    odds-only baseline on ROC-AUC (NULL when there is no odds baseline)."""
    c = candidate.select(F.col("accuracy").alias("model_accuracy"), F.col("roc_auc").alias("model_roc_auc"))
    m = majority.select(F.col("accuracy").alias("majority_accuracy"))
    out = c.crossJoin(m)
    if odds is not None:
        out = out.crossJoin(odds.select(F.col("roc_auc").alias("odds_roc_auc")))
    else:
        out = out.withColumn("odds_roc_auc", F.lit(None).cast("double"))
    return out.select(
        "model_accuracy", "model_roc_auc", "majority_accuracy", "odds_roc_auc",
        (F.col("model_accuracy") > F.col("majority_accuracy")).cast("int").alias("beat_majority_baseline"),
        (F.col("model_roc_auc") > F.col("odds_roc_auc")).cast("int").alias("beat_odds_baseline"))


def results_status(candidate: DataFrame, majority: DataFrame, odds: DataFrame | None) -> DataFrame:
    """The candidate's three status rows: 1 reached, 0 not, NULL without an odds baseline."""
    flags = baseline_comparison(candidate, majority, odds)
    milestone = (F.col("model_roc_auc") > F.lit(C.ROC_AUC_MILESTONE)).cast("int")
    return long_rows(flags, ["check_name", "reached"], [
        ("beats the majority class on accuracy", F.col("beat_majority_baseline")),
        ("beats the odds alone on ROC-AUC", F.col("beat_odds_baseline")),
        (f"ROC-AUC above {C.ROC_AUC_MILESTONE}", milestone)])


def results_summary(rows: list[DataFrame]) -> DataFrame:
    """Union of per-model metric rows with status columns."""
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out.withColumn(
        "auc_milestone", (F.col("roc_auc") > F.lit(C.ROC_AUC_MILESTONE)).cast("int"))
