"""Audits: column presence, leakage guard, shapes, NULL and dtype profiles.

Schema facts (which names exist) are known on the driver; every data fact
(non-NULL counts, NULL cells, rows) comes from ONE aggregation pass over the
table, then ``unpivot`` turns the single wide row into a long table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duelframe import config as C
from duelframe.functions.exprs import long_rows


class LeakageError(ValueError):
    pass


# --- O8 / O9 / O50: column audit ---------------------------------------------

def column_audit(df: DataFrame, expected: list[str] | None = None) -> DataFrame:
    """Per expected column: found/missing, non-NULL count, total rows."""
    expected = expected if expected is not None else C.LEAKAGE_COLUMNS + [C.TARGET_COLUMN]
    cols = set(df.columns)
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for i, c in enumerate(expected):
        aggs.append((F.count(F.col(c)) if c in cols else F.lit(None).cast("bigint")).alias(f"_n{i}"))
    wide = df.agg(*aggs)
    return long_rows(wide, ["column_name", "status", "non_null"],
                     [(c, "found" if c in cols else "missing", F.col(f"_n{i}")) for i, c in enumerate(expected)],
                     F.col("_rows").alias("total_rows"))


def leakage_census(df: DataFrame) -> DataFrame:
    """Non-NULL values held by each leakage column that is present."""
    found = [c for c in C.LEAKAGE_COLUMNS if c in df.columns]
    if not found:
        return df.sparkSession.createDataFrame([], "column_name string, non_null bigint")
    return df.agg(*[F.count(F.col(c)).alias(c) for c in found]) \
        .unpivot([], found, "column_name", "non_null")


def require_target(df: DataFrame) -> None:
    if C.TARGET_COLUMN not in df.columns:
        raise ValueError(f"the table has no outcome column {C.TARGET_COLUMN!r}")


# --- O10 / O11: cleaning and its post-condition ------------------------------

def drop_leakage(df: DataFrame) -> DataFrame:
    """Remove post-outcome columns (absent ones are ignored); keep the target."""
    require_target(df)
    clean = df.drop(*C.LEAKAGE_COLUMNS)
    left = [c for c in C.LEAKAGE_COLUMNS if c in clean.columns]
    if left or C.TARGET_COLUMN not in clean.columns:  # checked before any write
        raise LeakageError(f"leakage columns still present: {left}")
    return clean


def leakage_check(raw: DataFrame, clean: DataFrame) -> DataFrame:
    """One-row audit of the cleaned table (rows, target rows, columns)."""
    left = [c for c in C.LEAKAGE_COLUMNS if c in clean.columns]
    return clean.agg(
        F.count(F.lit(1)).alias("rows_kept"),
        F.count(F.col(C.TARGET_COLUMN)).alias("target_non_null"),
    ).select(
        "rows_kept", "target_non_null",
        F.lit(len(left)).cast("bigint").alias("leakage_columns_left"),
        F.lit(len(raw.columns) - len(clean.columns)).cast("bigint").alias("columns_removed"),
        F.lit(int(C.TARGET_COLUMN in clean.columns)).alias("target_preserved"),
    )


# --- O12 / O49: shape ---------------------------------------------------------

def table_shape(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows x columns for each named table (one count per table)."""
    out = None
    for name, df in tables.items():
        one = df.agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(name).alias("table_name"), "n_rows",
            F.lit(len(df.columns)).cast("bigint").alias("n_columns"))
        out = one if out is None else out.unionByName(one)
    return out


# --- O51 / O26 / O67: NULL profiles ------------------------------------------

def null_counts(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """(column_name, missing, total_rows) for every column, one pass."""
    columns = columns if columns is not None else df.columns
    if not columns:
        return df.sparkSession.createDataFrame(
            [], "column_name string, missing bigint, total_rows bigint")
    aggs = [F.count(F.lit(1)).alias("_rows")] + [
        F.count_if(F.col(f"`{c}`").isNull()).alias(f"_m{i}") for i, c in enumerate(columns)]
    return long_rows(df.agg(*aggs), ["column_name", "missing"],
                     [(c, F.col(f"_m{i}")) for i, c in enumerate(columns)], F.col("_rows").alias("total_rows"))


def missing_profile(df: DataFrame, top_n: int | None = C.MISSING_TOP_N) -> DataFrame:
    """Columns with NULLs, percent of all rows, largest first (ties by name)."""
    prof = (null_counts(df).filter(F.col("missing") > 0)
            .select("column_name", "missing",
                    (F.lit(100.0) * F.col("missing") / F.col("total_rows")).alias("pct")))
    prof = prof.orderBy(F.col("pct").desc(), F.col("column_name"))
    return prof.limit(top_n) if top_n else prof


def missing_summary(df: DataFrame) -> DataFrame:
    """How many of the columns hold NULLs, and how many columns there are."""
    return null_counts(df).agg(F.count_if(F.col("missing") > 0).alias("columns_with_missing"),
                               F.count(F.lit(1)).alias("n_columns"))


# --- O19: dtype census --------------------------------------------------------

def dtype_census(df: DataFrame) -> DataFrame:
    """Per Spark type: number of columns and NULL cells (one pass)."""
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    aggs = [F.count_if(F.col(f"`{c}`").isNull()).alias(f"_m{i}") for i, c in enumerate(df.columns)]
    long = long_rows(df.agg(*aggs), ["dtype", "missing"],
                     [(types[c], F.col(f"_m{i}")) for i, c in enumerate(df.columns)])
    return long.groupBy("dtype").agg(F.count(F.lit(1)).alias("n_columns"),
                                     F.sum("missing").alias("null_cells"))


# --- O20 / O21 / O22: feature audits -----------------------------------------

def feature_checks(features: DataFrame, feature_cols: list[str], labels: dict[str, str] | None = None) -> DataFrame:
    """Status rows: no missing values, no competitor names, no duplicate names.

    ``labels`` gives the text behind an encoded column where its name differs;
    duplicates are judged by that text without regard to case, as Spark
    resolves names.
    """
    texts = [(labels or {}).get(c, c) for c in feature_cols]
    forbidden = [c for c in texts if any(p in c for p in C.FORBIDDEN_NAME_PARTS)]
    lowered = [c.lower() for c in texts]
    dupes = len(lowered) - len(set(lowered))
    null_cells = sum((F.count_if(F.col(f"`{c}`").isNull()) for c in feature_cols), F.lit(0))
    wide = features.agg(null_cells.cast("bigint").alias("null_cells"),
                        F.count(F.lit(1)).alias("n_rows"))
    big = lambda n: F.lit(n).cast("bigint")
    return long_rows(wide, ["check_name", "passed", "value"], [
        ("no_missing_values", (F.col("null_cells") == 0).cast("int"), F.col("null_cells")),
        ("no_competitor_names", int(not forbidden), big(len(forbidden))),
        ("no_duplicate_columns", int(dupes == 0), big(dupes)),
        ("rows", 1, F.col("n_rows"))])


def feature_groups(features: DataFrame, groups: dict[str, list[str]]) -> DataFrame:
    """Per feature group: columns, NULL cells and non-zero cells (one pass)."""
    aggs, entries = [], []
    for i, (g, cols) in enumerate(groups.items()):
        nulls = sum((F.count_if(F.col(f"`{c}`").isNull()) for c in cols), F.lit(0))
        nonzero = sum((F.count_if(F.col(f"`{c}`") != 0) for c in cols), F.lit(0))
        aggs += [nulls.cast("bigint").alias(f"_n{i}"), nonzero.cast("bigint").alias(f"_z{i}")]
        entries.append((g, F.lit(len(cols)).cast("bigint"), F.col(f"_n{i}"), F.col(f"_z{i}")))
    return long_rows(features.agg(*aggs), ["feature_group", "n_columns", "null_cells", "nonzero_cells"], entries)


def feature_nulls(features: DataFrame, feature_cols: list[str]) -> DataFrame:
    """Feature columns that still hold NULLs after the fills (warned, not filled)."""
    return null_counts(features, feature_cols).filter(F.col("missing") > 0) \
        .select("column_name", "missing")
