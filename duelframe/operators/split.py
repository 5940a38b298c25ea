"""Date parsing, the exact time-ordered train/test split and its summary.

The reference sorts all rows by date and cuts at position ``int(n * ratio)``.
Here no data-sized sort or global window is used:

1. one aggregation gives per-date counts (bounded by the number of calendar
   dates); a window over that small table gives each date's offset and finds
   the date holding the cut;
2. on that date only, the exact k-th smallest key (``kth_smallest``, bounded
   rounds) gives the tiebreak threshold;
3. every row is labelled by a projection -- no shuffle of the data.

The result equals ``row_number() over (order by date, key) <= cut``.  The key
may be one column or several, of any orderable type; NULLs come first.  If the
cut falls between rows of one and the same key, no rule on the key can give
the exact sizes, and the split fails with a message that names the key.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from duelframe import config as C
from duelframe.functions.exprs import as_date
from duelframe.functions.ordering import at_most, kth_smallest


def date_quality(df: DataFrame, date_col: str = "Date") -> DataFrame:
    """Rows, rows with an invalid/missing date (dropped by the split), range."""
    d = as_date(df, date_col)
    return df.agg(F.count(F.lit(1)).alias("n_rows"),
                  F.count_if(d.isNull()).alias("invalid_dates"),
                  F.count(d).alias("valid_dates"),
                  F.min(d).alias("first_date"), F.max(d).alias("last_date"))


class SplitKeyError(ValueError):
    """The key does not tell the rows at the cut apart."""


def _listed(key) -> list:
    return list(key) if isinstance(key, (list, tuple)) else [key]


@dataclass
class SplitPoint:
    n_rows: int
    cut: int                       # rows in train
    boundary_date: object = None   # date holding the cut (None: no train rows)
    key_threshold: tuple | None = None   # on boundary_date, keys up to this are train

    def is_train(self, date: Column, key) -> Column:
        """Train rows, as a condition on plain columns: the bound on the date
        stands alone, so a scan can skip files and row groups by it."""
        if self.boundary_date is None:
            return F.lit(False)
        d = F.lit(self.boundary_date).cast("date")
        if self.key_threshold is None:
            return date <= d
        return (date <= d) & ((date < d) | at_most(_listed(key), self.key_threshold))

    def is_test(self, date: Column, key) -> Column:
        """Rows with a date that are not train rows; its date bound stands alone too."""
        if self.boundary_date is None:
            return date.isNotNull()
        d = F.lit(self.boundary_date).cast("date")
        if self.key_threshold is None:
            return date > d
        return (date >= d) & ((date > d) | ~at_most(_listed(key), self.key_threshold))


def find_split_point(dated: DataFrame, ratio: float, date_col: str, key: str | list[str],
                     whole_dates: bool = False, **bounds) -> SplitPoint:
    per_date = dated.groupBy(date_col).agg(F.count(F.lit(1)).alias("_n"))
    everything = Window.partitionBy()  # small table: one row per date
    w = Window.orderBy(date_col).rowsBetween(Window.unboundedPreceding, -1)
    tagged = (per_date
              .withColumn("_total", F.sum("_n").over(everything))
              .withColumn("_before", F.coalesce(F.sum("_n").over(w), F.lit(0)))
              .withColumn("_cut", F.floor(F.col("_total") * F.lit(float(ratio))).cast("bigint")))
    hit = (tagged.filter((F.col("_before") < F.col("_cut"))
                         & (F.col("_before") + F.col("_n") >= F.col("_cut")))
           .select(date_col, "_n", "_total", "_before", "_cut").first())
    if hit is None:  # empty input or no train rows
        tot = dated.count()
        return SplitPoint(tot, int(tot * ratio))
    n_total, cut = int(hit["_total"]), int(hit["_cut"])
    k = cut - int(hit["_before"])
    if k == int(hit["_n"]):
        return SplitPoint(n_total, cut, hit[date_col], None)
    if whole_dates:  # the straddling date goes to test: train ends the day before
        before = int(hit["_before"])
        prev = (dated.filter(F.col(date_col) < F.lit(hit[date_col]))
                .agg(F.max(date_col).alias("d")).first()["d"]) if before else None
        return SplitPoint(n_total, before, prev, None)
    one_date = dated.filter(F.col(date_col) == F.lit(hit[date_col]))
    at = kth_smallest(one_date, key, k, **bounds)
    if at.rows_before + at.rows_at != k:
        raise SplitKeyError(
            f"{at.rows_at} rows of {hit[date_col]} share the key {dict(zip(_listed(key), at.values))} and the cut "
            f"falls between them; add a column to the key, or keep dates whole")
    return SplitPoint(n_total, cut, hit[date_col], at.values)


def time_split(df: DataFrame, ratio: float = C.TRAIN_RATIO, date_col: str = "Date",
               key: str | list[str] = "bout_id", whole_dates: bool = False,
               **bounds) -> tuple[DataFrame, SplitPoint]:
    """Label rows 'train'/'test' by (date, key) order; invalid dates dropped.

    ``whole_dates`` keeps every date on one side: a date the cut would
    straddle goes entirely to test.  ``bounds`` go to ``kth_smallest``.
    """
    dated = df.withColumn(date_col, as_date(df, date_col)).filter(F.col(date_col).isNotNull())
    keys = _listed(key)
    point = find_split_point(dated.select(date_col, *keys), ratio, date_col, key, whole_dates, **bounds)
    is_train = point.is_train(F.col(date_col), [F.col(c) for c in keys])
    return dated.withColumn("split", F.when(is_train, F.lit("train")).otherwise(F.lit("test"))), point


def split_summary(split_df: DataFrame, date_col: str = "Date", target: str = "target") -> DataFrame:
    """Per side: rows, first/last date, 'start to end' text, Red win rate."""
    first = F.date_format(F.min(date_col), "yyyy-MM-dd")
    last = F.date_format(F.max(date_col), "yyyy-MM-dd")
    return split_df.groupBy("split").agg(
        F.count(F.lit(1)).alias("n_rows"),
        first.alias("start_date"), last.alias("end_date"),
        F.concat(first, F.lit(" to "), last).alias("date_range"),
        F.avg(F.col(target).cast("double")).alias("red_win_rate"))
