"""Distribution profiles: category counts, class balance, yearly trend,
odds-favourite analysis, class histograms and correlations.

All are aggregations with map-side partial aggregation; the only joins are
against one-row or per-(column, class) aggregates whose size does not grow
with the data (checked bound: columns x classes).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from duelframe import config as C
from duelframe.functions.exprs import as_date, histogram_bin, long_rows, pearson, percent, sign_label


# --- O52 / O53 / O69: category counts ----------------------------------------

def value_counts(df: DataFrame, col: str, with_percent: bool = True) -> DataFrame:
    """Counts of non-missing values, largest first; percent of *all* rows.

    One scan: the NULL group is counted (it belongs to the denominator) and
    dropped after the total is taken by a window over the grouped result --
    one row per category of a categorical column, so that window is small.
    """
    grouped = df.groupBy(F.col(col).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    if with_percent:
        grouped = grouped.withColumn(
            "pct", percent(F.col("n"), F.sum("n").over(Window.partitionBy())))
    return grouped.filter(F.col("value").isNotNull()).orderBy(F.col("n").desc(), F.col("value"))


# --- O54 / O42: class balance --------------------------------------------------

def class_balance(df: DataFrame, target: str = "target") -> DataFrame:
    y = F.col(target)
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum(y).cast("bigint").alias("red_wins"),
        F.sum(F.lit(1) - y).cast("bigint").alias("blue_wins"),
        F.avg(y.cast("double")).alias("red_rate"),
        (F.lit(1.0) - F.avg(y.cast("double"))).alias("blue_rate"),
    )


# --- O55 / O37: yearly trend ---------------------------------------------------

def yearly_trend(df: DataFrame, date_col: str = "Date") -> DataFrame:
    """Per year: non-missing outcomes, Red wins and Red percentage."""
    w = F.col(C.TARGET_COLUMN)
    return (df.groupBy(F.year(as_date(df, date_col)).cast("bigint").alias("year"))
            .agg(F.count(w).alias("fights"),
                 F.count_if(w == C.TARGET_POSITIVE).alias("red_wins"))
            .withColumn("red_pct", percent(F.col("red_wins"), F.col("fights"))))


# --- O56: date range -------------------------------------------------------------

def date_range(df: DataFrame, date_col: str = "Date") -> DataFrame:
    d = F.col(date_col)
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.min(d).alias("first_date"),
                  F.max(d).alias("last_date"))


# --- O25 / O27 / O61: favourite analysis ---------------------------------------

def complete_odds(df: DataFrame, key: str = "bout_id") -> DataFrame:
    cols = [key, "RedOdds", "BlueOdds", C.TARGET_COLUMN]
    return df.select(*cols).na.drop(subset=["RedOdds", "BlueOdds", C.TARGET_COLUMN])


def favorite_outcome(df: DataFrame, key: str = "bout_id") -> DataFrame:
    """Favourite = strictly lower odds on Red; equal odds make Blue the favourite."""
    co = complete_odds(df, key)
    fav_red = F.col("RedOdds") < F.col("BlueOdds")
    w = F.col(C.TARGET_COLUMN)
    won = (fav_red & (w == "Red")) | (~fav_red & (w == "Blue"))
    return co.select(key, fav_red.cast("int").alias("favorite_is_red"),
                     won.cast("int").alias("favorite_won"))


def favorite_win_rate(df: DataFrame, key: str = "bout_id") -> DataFrame:
    fo = favorite_outcome(df, key)
    return fo.agg(F.count(F.lit(1)).alias("n_bouts"),
                  F.sum("favorite_won").cast("bigint").alias("favorite_wins"),
                  F.avg(F.col("favorite_won").cast("double")).alias("favorite_win_rate"))


# --- O63: rank coverage ------------------------------------------------------------

def rank_coverage(df: DataFrame) -> DataFrame:
    """Percent of rows where the Red side of each rank pair is present."""
    pairs = {k: v for k, v in C.RANKING_PAIRS.items() if v[0] in df.columns and v[1] in df.columns}
    if not pairs:
        return df.sparkSession.createDataFrame(
            [], "rank_diff string, red_ranked bigint, red_ranked_pct double")
    aggs = [F.count(F.lit(1)).alias("_rows")] + [
        F.count(F.col(r)).alias(f"_c{i}") for i, (r, _) in enumerate(pairs.values())]
    return (long_rows(df.agg(*aggs), ["rank_diff", "red_ranked"],
                      [(k, F.col(f"_c{i}")) for i, k in enumerate(pairs)], F.col("_rows"))
            .select("rank_diff", "red_ranked", percent(F.col("red_ranked"), F.col("_rows"))
                    .alias("red_ranked_pct")))


# --- O57 / O24: class-conditional histograms ------------------------------------

def class_histogram(features: DataFrame, columns: list[str] | None = None,
                    bins: int = C.HISTOGRAM_BINS, target: str = "target") -> DataFrame:
    """Equal-width bins over each (column, class)'s own min..max."""
    columns = [c for c in (columns or C.HISTOGRAM_COLUMNS) if c in features.columns]
    if not columns:
        return features.sparkSession.createDataFrame(
            [], "feature string, target int, bin bigint, bin_start double, bin_end double, n bigint")
    # one wide aggregate gives every (column, class) range; then one pass bins
    # the cells and counts them: one row per (column, class, bin)
    named = [F.struct(F.lit(i).alias("i"), F.col(f"`{c}`").cast("double").alias("v")) for i, c in enumerate(columns)]
    wide = features.groupBy(F.col(target).alias("target")).agg(
        *[f(F.col(f"`{c}`").cast("double")).alias(f"{n}{i}") for i, c in enumerate(columns)
          for n, f in (("lo", F.min), ("hi", F.max))])
    ranges = long_rows(wide, ["i", "feature", "lo", "hi"],
                       [(i, c, F.col(f"lo{i}"), F.col(f"hi{i}")) for i, c in enumerate(columns)], F.col("target"))
    cells = (features.select(F.col(target).alias("target"), F.inline(F.array(*named)))
             .where(F.col("v").isNotNull()))
    binned = cells.join(F.broadcast(ranges), ["i", "target"]).withColumn(  # columns x classes rows
        "bin", histogram_bin(F.col("v"), F.col("lo"), F.col("hi"), bins))
    width = F.when(F.col("hi") == F.col("lo"), F.lit(1.0)) \
        .otherwise((F.col("hi") - F.col("lo")) / F.lit(float(bins)))
    start = F.when(F.col("hi") == F.col("lo"), F.col("lo") - 0.5).otherwise(F.col("lo"))
    return (binned.groupBy("feature", "target", "bin", "lo", "hi")
            .agg(F.count(F.lit(1)).alias("n"))
            .select("feature", "target", "bin",
                    (start + F.col("bin") * width).alias("bin_start"),
                    (start + (F.col("bin") + 1) * width).alias("bin_end"), "n"))


# --- O58 / O59 / O60 / O71 / O23: correlations -----------------------------------

def present_numeric(df: DataFrame, columns: list[str]) -> list[str]:
    return [c for c in columns if c in df.columns]


def corr_matrix(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Lower triangle (row index > column index) of the Pearson matrix, long form."""
    cols = present_numeric(df, columns or C.CORRELATION_COLUMNS)
    pairs = [(cols[i], cols[j]) for i in range(len(cols)) for j in range(i)]
    if not pairs:
        return df.sparkSession.createDataFrame([], "row_feature string, col_feature string, corr double")
    aggs = [pearson(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"_p{k}")
            for k, (a, b) in enumerate(pairs)]
    return long_rows(df.agg(*aggs), ["row_feature", "col_feature", "corr"],
                     [(a, b, F.col(f"_p{k}")) for k, (a, b) in enumerate(pairs)])


def target_corr(df: DataFrame, columns: list[str] | None = None, target: str = "target") -> DataFrame:
    """Correlation of each numeric column with the target, strongest first."""
    cols = [c for c in present_numeric(df, columns or C.CORRELATION_COLUMNS) if c != target]
    if not cols or target not in df.columns:
        return df.sparkSession.createDataFrame([], "feature string, corr double, direction string")
    aggs = [pearson(F.col(c).cast("double"), F.col(target).cast("double")).alias(f"_p{k}")
            for k, c in enumerate(cols)]
    return (long_rows(df.agg(*aggs), ["feature", "corr"], [(c, F.col(f"_p{k}")) for k, c in enumerate(cols)])
            .withColumn("direction", sign_label(F.col("corr")))
            .orderBy(F.abs(F.col("corr")).desc_nulls_last(), F.col("feature")))


# --- O68: top stance matchups ------------------------------------------------------

def top_values(df: DataFrame, col: str, n: int) -> DataFrame:
    return value_counts(df, col, with_percent=False).limit(n)
