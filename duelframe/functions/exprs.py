"""Shared JVM-side column expressions (no Python UDFs)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def flag_equals(c: Column, value) -> Column:
    """0/1 indicator of ``c == value`` where NULL counts as 0 (null-safe)."""
    return c.eqNullSafe(F.lit(value)).cast("int")


def percent(num: Column, den: Column) -> Column:
    """100 * num / den as double; NULL when den is 0."""
    return F.try_divide(F.lit(100.0) * num.cast("double"), den.cast("double"))


def sign_label(c: Column) -> Column:
    """'(+)' for strictly positive, '(-)' otherwise (zero is '(-)')."""
    return F.when(c > 0, F.lit("(+)")).otherwise(F.lit("(-)"))


def class_label(c: Column) -> Column:
    """1 -> 'Red', anything else -> 'Blue'."""
    return F.when(c == 1, F.lit("Red")).otherwise(F.lit("Blue"))


def nan_to_null(c: Column, dtype: str = "double") -> Column:
    """Spark keeps NaN distinct from NULL; the contest schema never wants NaN."""
    return F.when(F.isnan(c), F.lit(None).cast(dtype)).otherwise(c)


def pearson(a: Column, b: Column) -> Column:
    """Pearson correlation with pairwise deletion of NULLs.

    ``corr`` raises DIVIDE_BY_ZERO under ANSI mode on a constant column;
    this form gives NULL there instead.  Both standard deviations are taken
    over the rows where the *other* column is present as well, which is what
    pairwise deletion means.
    """
    a2 = F.when(b.isNotNull(), a)
    b2 = F.when(a.isNotNull(), b)
    den = F.stddev_pop(a2) * F.stddev_pop(b2)
    return F.try_divide(F.covar_pop(a2, b2), F.when(den != 0, den))


def histogram_bin(v: Column, lo: Column, hi: Column, bins: int) -> Column:
    """0-based bin of ``v`` among ``bins`` equal bins over [lo, hi].

    The last bin is closed; a constant range puts every value in the middle
    bin of [v-0.5, v+0.5], as numpy does.
    """
    width = (hi - lo).cast("double")
    return (
        F.when(hi == lo, F.lit(bins // 2))
        .otherwise(F.least(F.floor((v - lo) * F.lit(float(bins)) / width),
                           F.lit(bins - 1)))
        .cast("bigint")
    )


# date layouts tried in order by the lenient parser (ISO first)
DATE_FORMATS = ["yyyy-MM-dd", "M/d/yyyy", "yyyy/M/d", "d MMMM yyyy", "MMMM d, yyyy"]


def lenient_date(c: Column) -> Column:
    """Parse to DATE; unparseable text becomes NULL (never raises under ANSI)."""
    t = F.trim(c.cast("string"))
    return F.coalesce(*[F.try_to_date(t, f) for f in DATE_FORMATS], F.try_to_date(t))


def as_date(df, date_col: str) -> Column:
    """``date_col`` as DATE whatever its stored type (text parsed leniently)."""
    t = dict(df.dtypes)[date_col]
    if t == "date":
        return F.col(date_col)
    if t.startswith("timestamp"):
        return F.to_date(F.col(date_col))
    return lenient_date(F.col(date_col))


def long_rows(wide: DataFrame, names: list[str], rows: list[tuple], *more: Column) -> DataFrame:
    """One output row per tuple and input row; tuples hold columns and plain values.

    Built from columns and literals, so a name or value may hold any text.
    """
    cells = [F.struct(*[(v if isinstance(v, Column) else F.lit(v)).alias(n) for n, v in zip(names, row)])
             for row in rows]
    return wide.select(F.inline(F.array(*cells)), *more)
