"""Registered queries: ``name -> (spark, sf_dir) -> DataFrame`` and the SQL
that states the same result for DuckDB.

Output conventions shared by both sides: dates as ``yyyy-MM-dd`` text,
booleans as 0/1, aggregate doubles rounded to 9 decimals.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from duelframe import config as C
from duelframe.functions.exprs import lenient_date
from duelframe.functions.ordering import top_counts
from duelframe.operators import category_fit
from duelframe.operators import evaluate as ev
from duelframe.operators import features as fe
from duelframe.operators import model as mo
from duelframe.operators import profile as pr
from duelframe.operators import quality as qa
from duelframe.operators import split as sp
from duelframe.plans.pipeline import ContestPipeline

R = 9  # rounding of aggregate doubles in registered outputs


def round_half_away(c):
    """``R``-decimal rounding in double arithmetic: rint(x * 10^R) / 10^R.

    Stays in generated code (``F.round`` on doubles goes through BigDecimal)
    and is the same arithmetic the SQL oracle's ``round`` uses.
    """
    scale = float(10 ** R)
    return F.rint(c * F.lit(scale)) / F.lit(scale)


def fin(df: DataFrame, rounded: tuple[str, ...] = ()) -> DataFrame:
    """Dates -> text, booleans -> int, listed doubles rounded."""
    out = []
    for name, t in df.dtypes:
        c = F.col(f"`{name}`")
        if t == "date" or t.startswith("timestamp"):
            c = F.date_format(c, "yyyy-MM-dd")
        elif t == "boolean":
            c = c.cast("int")
        elif name in rounded:
            c = round_half_away(c)
        out.append(c.alias(name))
    return df.select(*out)


def P(spark: SparkSession, sf_dir: str) -> ContestPipeline:
    return ContestPipeline.for_input(spark, sf_dir)


# --- E1: scan, audit, clean --------------------------------------------------

def scan_raw(s, d):
    return fin(P(s, d).raw())


def clean_bouts(s, d):
    return fin(P(s, d).clean())


def column_audit(s, d):
    return qa.column_audit(P(s, d).raw())


def leakage_census(s, d):
    return qa.leakage_census(P(s, d).raw())


def leakage_check(s, d):
    p = P(s, d)
    return qa.leakage_check(p.raw(), p.clean())


def table_shape(s, d):
    p = P(s, d)
    return qa.table_shape({"raw": p.raw(), "clean": p.clean(), "features": p.features()})


def head_rows(s, d):
    return fin(P(s, d).raw().orderBy("bout_id").limit(C.HEAD_ROWS))


def dtype_census(s, d):
    return qa.dtype_census(P(s, d).raw())


def missing_profile(s, d):
    return fin(qa.missing_profile(P(s, d).raw()), ("pct",))


def missing_summary(s, d):
    return qa.missing_summary(P(s, d).raw())


# --- profiles on the cleaned table ---------------------------------------------

def complete_odds(s, d):
    return pr.complete_odds(P(s, d).clean())


def favorite_outcome(s, d):
    return pr.favorite_outcome(P(s, d).clean())


def favorite_win_rate(s, d):
    return fin(pr.favorite_win_rate(P(s, d).clean()), ("favorite_win_rate",))


def winner_distribution(s, d):
    return fin(pr.value_counts(P(s, d).clean(), C.TARGET_COLUMN), ("pct",))


def weightclass_counts(s, d):
    return pr.value_counts(P(s, d).clean(), "WeightClass", with_percent=False)


def yearly_trend(s, d):
    return fin(pr.yearly_trend(P(s, d).clean()), ("red_pct",))


def date_range(s, d):
    return fin(pr.date_range(P(s, d).raw()))


def rank_coverage(s, d):
    return fin(pr.rank_coverage(P(s, d).clean()), ("red_ranked_pct",))


# --- E2 pieces ---------------------------------------------------------------------

def binary_target(s, d):
    c = P(s, d).clean()
    return c.select("bout_id", C.TARGET_COLUMN, fe.target_expr().alias("target"))


def gender_binary(s, d):
    return P(s, d).clean().select("bout_id", fe.gender_expr().alias("is_male"))


def paired_diffs(s, d):
    c = P(s, d).clean()
    return c.select("bout_id", *[v.alias(k) for k, v in fe.paired_diff_exprs(c.columns).items()])


def neutral_fill(s, d):
    c = P(s, d).clean()
    exprs = fe.neutral_fill(fe.paired_diff_exprs(c.columns))
    exprs["EmptyArena"] = F.coalesce(F.col("EmptyArena"), F.lit(0))
    return c.select("bout_id", *[exprs[k].alias(k) for k in C.ZERO_FILL_COLUMNS if k in exprs])


def fill_counts(s, d):
    return fe.fill_counts(P(s, d).clean())


def rank_diffs(s, d):
    c = P(s, d).clean()
    return c.select("bout_id", *[v.alias(k) for k, v in fe.rank_diff_exprs(c.columns).items()])


def stance_matchup(s, d):
    return P(s, d).clean().select("bout_id", fe.stance_matchup_expr().alias("stance_matchup"))


def stance_top5(s, d):
    c = P(s, d).clean().select(fe.stance_matchup_expr().alias("stance_matchup"))
    return pr.top_values(c, "stance_matchup", C.STANCE_TOP_N)


def category_vocab(s, d):
    return fe.category_table(P(s, d).clean())


def _onehot(s, d, col, prefix, vocab_attr):
    p = P(s, d)
    vals = getattr(p.vocab(), vocab_attr)
    value = fe.stance_matchup_expr() if col is None else F.col(col)
    exprs = fe.one_hot_exprs(value, prefix, vals)
    return p.clean().select("bout_id", *[v.alias(k) for k, v in exprs.items()])


def stance_onehot(s, d):
    return _onehot(s, d, None, C.STANCE_PREFIX, "stance")


def weightclass_onehot(s, d):
    return _onehot(s, d, "WeightClass", C.WEIGHTCLASS_PREFIX, "weight_class")


def betterrank_onehot(s, d):
    return _onehot(s, d, "BetterRank", C.BETTERRANK_PREFIX, "better_rank")


def _text_dates(s, d):
    """The contests with their date as text: five layouts by key, and one that is no date."""
    layouts = ["yyyy-MM-dd", "M/d/yyyy", "yyyy/M/d", "d MMMM yyyy", "MMMM d, yyyy"]
    text = F.lit("no date 99/99")
    for i, layout in enumerate(layouts):
        text = F.when(F.col("bout_id") % 6 == i, F.date_format("Date", layout)).otherwise(text)
    return P(s, d).clean().select("bout_id", text.alias("Date"))


def lenient_dates(s, d):
    return fin(_text_dates(s, d).select("bout_id", lenient_date(F.col("Date")).alias("parsed")))


def text_date_quality(s, d):
    return fin(sp.date_quality(_text_dates(s, d)))


def vocab_unbounded(s, d):
    """One-hot cells of a column with a category per competitor."""
    return fe.sparse_one_hot(P(s, d).clean(), F.col("RedFighter"))[1]


def feature_matrix(s, d):
    return fin(P(s, d).features())


def feature_checks(s, d):
    p = P(s, d)
    return qa.feature_checks(p.features(), p.spec().columns, p.spec().labels)


def feature_groups(s, d):
    p = P(s, d)
    return qa.feature_groups(p.features(), p.spec().groups())


def feature_nulls(s, d):
    p = P(s, d)
    return qa.feature_nulls(p.features(), p.spec().columns)


def feature_sample(s, d):
    f = P(s, d).features()
    cols = [c for c in C.KEY_FEATURE_SAMPLE if c in f.columns]
    return fin(f.select("bout_id", "Date", *cols).orderBy("Date", "bout_id").limit(C.SAMPLE_ROWS))


def class_balance(s, d):
    return fin(pr.class_balance(P(s, d).features()), ("red_rate", "blue_rate"))


def class_histogram(s, d):
    return fin(pr.class_histogram(P(s, d).features()), ("bin_start", "bin_end"))


def corr_matrix(s, d):
    return fin(pr.corr_matrix(P(s, d).features()), ("corr",))


def target_corr(s, d):
    return fin(pr.target_corr(P(s, d).features()), ("corr",))


# --- E3: split, baselines, evaluation --------------------------------------------

def date_quality(s, d):
    return fin(sp.date_quality(P(s, d).features()))


def time_split(s, d):
    return fin(P(s, d).split().select("bout_id", "Date", "target", "split"))


def split_text_key(s, d):
    """Time split ordered by a text key with NULLs and repeats, then the row's own key."""
    bouts = P(s, d).clean().select("bout_id", "Date", F.when(F.col("bout_id") % 5 != 0, F.col("RedFighter"))
                                   .alias("text_key"))
    return sp.time_split(bouts, key=["text_key", "bout_id"])[0].select("bout_id", "text_key", "split")


def split_summary(s, d):
    return fin(sp.split_summary(P(s, d).split()), ("red_win_rate",))


def training_view(s, d):
    return P(s, d).training()


def odds_only_view(s, d):
    return P(s, d).training().select("bout_id", "split", "target", "odds_diff")


def scaler_stats(s, d):
    p = P(s, d)
    return fin(mo.scaler_stats(p.train(), p.feature_cols()), ("mean", "std", "scale"))


def standardized_features(s, d):
    p = P(s, d)
    cols = p.feature_cols()
    return fin(p.scaler().transform(p.training(), ["bout_id", "split", "target"]), tuple(cols))


def class_weights(s, d):
    return fin(mo.class_weights(P(s, d).train()), ("weight",))


def majority_baseline(s, d):
    p = P(s, d)
    return fin(p.majority(), ("accuracy",))


def eval_accuracy(s, d):
    return fin(ev.accuracy(P(s, d).rule_scored()), ("accuracy",))


def eval_roc_auc(s, d):
    p = P(s, d)
    return fin(ev.roc_auc(p.rule_scored()), ("roc_auc",))


def confusion_matrix(s, d):
    return ev.confusion_counts(P(s, d).rule_scored())


def classification_report(s, d):
    return fin(ev.classification_report(P(s, d).rule_scored()),
               ("precision", "recall", "f1_score"))


def rule_comparison(s, d):
    """The odds rule as the candidate, against the majority class and against itself."""
    p = P(s, d)
    row = p.evaluate(p.rule_scored(), "Odds Rule")
    return fin(ev.baseline_comparison(row, p.majority(), row),
               ("model_accuracy", "model_roc_auc", "majority_accuracy", "odds_roc_auc"))


def rule_summary(s, d):
    p = P(s, d)
    majority = p.majority().select("model", "accuracy", F.lit(None).cast("double").alias("roc_auc"))
    return fin(ev.results_summary([majority, p.evaluate(p.rule_scored(), "Odds Rule")]), ("accuracy", "roc_auc"))


def rule_status(s, d):
    p = P(s, d)
    row = p.evaluate(p.rule_scored(), "Odds Rule")
    return ev.results_status(row, p.majority(), row)


def top_competitors(s, d):
    """The ten Red competitors with most bouts, without a shuffle of all competitors."""
    return top_counts(P(s, d).clean(), "RedFighter", 10)


def competitor_effects(s, d):
    """Coefficients of every Red competitor beside the odds, fitted on the train side."""
    p = P(s, d)
    fit = category_fit.solve(p.split().where("split = 'train'"), ["odds_diff"], F.col("RedFighter"), F.col("target"),
                             penalty=1e-3, means=[0.0], scales=[100.0])
    return fin(fit.categories, ("coefficient",))


#: A declared linear model: feature -> coefficient.
DECLARED = {"odds_diff": 0.0001, "td_pct_diff": -0.5, "draws_diff": 0.03125, "is_male": 0.25, "wc_rank_diff": -0.0078125}


def declared_model():
    return mo.FittedModel.declared(list(DECLARED), list(DECLARED.values()))


def declared_scores(s, d):
    """The test side scored by a model of declared coefficients: predicted class and probability."""
    scored = declared_model().score(P(s, d).test())
    return fin(scored.select("bout_id", "target", "prediction", "score"), ("score",))


def declared_coefficients(s, d):
    """The largest declared coefficients of the features that the test side has."""
    have = set(P(s, d).feature_cols())
    kept = {c: w for c, w in DECLARED.items() if c in have}
    return mo.top_coefficients(mo.FittedModel.declared(list(kept), list(kept.values())), 3)


def declared_report(s, d):
    return fin(ev.classification_report(declared_scores(s, d)), ("precision", "recall", "f1_score"))


# model-based (no SQL form: iterative fit)

def odds_baseline(s, d):
    p = P(s, d)
    m = p.odds_model()
    row = p.evaluate(p.odds_scored(), "Odds Only (LogReg)")
    return fin(row.select("*", F.lit(m.coefficients()[0]).alias("coefficient"),
                          F.lit(float(m.intercept)).alias("intercept")),
               ("accuracy", "roc_auc", "coefficient", "intercept"))


def logreg_baseline(s, d):
    p = P(s, d)
    return p.evaluate(p.full_scored(), "Logistic Regression (Full)")


def scored_bouts(s, d):
    return P(s, d).full_scored()


def top_coefficients(s, d):
    return mo.top_coefficients(P(s, d).full_model())


def model_report(s, d):
    return ev.classification_report(P(s, d).full_scored())


def baseline_comparison(s, d):
    p = P(s, d)
    rows = p.metric_rows()
    odds = rows[1] if len(rows) == 3 else None
    return ev.baseline_comparison(rows[-1], rows[0], odds)


def results_summary(s, d):
    return ev.results_summary(P(s, d).metric_rows())


def metrics_report(s, d):
    from duelframe.plans.report import metrics_document
    return metrics_document(P(s, d))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in [
        scan_raw, clean_bouts, column_audit, leakage_census, leakage_check, table_shape,
        head_rows, dtype_census, missing_profile, complete_odds, favorite_outcome,
        favorite_win_rate, winner_distribution, weightclass_counts, yearly_trend, date_range,
        rank_coverage, binary_target, gender_binary, paired_diffs, neutral_fill, fill_counts,
        rank_diffs, stance_matchup, stance_top5, category_vocab, stance_onehot,
        weightclass_onehot, betterrank_onehot, feature_matrix, feature_checks, feature_groups,
        feature_nulls, feature_sample, class_balance, class_histogram, corr_matrix,
        target_corr, date_quality, time_split, split_summary, training_view, odds_only_view,
        scaler_stats, standardized_features, class_weights, majority_baseline, eval_accuracy,
        eval_roc_auc, confusion_matrix, classification_report, missing_summary, vocab_unbounded,
        lenient_dates, text_date_quality,
        split_text_key, rule_comparison, rule_summary, rule_status, declared_scores, declared_report, declared_coefficients, odds_baseline,
        logreg_baseline, scored_bouts, top_coefficients, model_report, baseline_comparison,
        results_summary, metrics_report, top_competitors, competitor_effects,
    ]
}
