"""CSV / parquet / JSON sources and sinks for the contest tables.

CSV is an edge format: pandas treats a list of tokens (``NA``, ``nan``,
``NULL`` ...) as missing at every read, Spark keeps them as text.  The raw
reader therefore scans every column as a string, maps the tokens to NULL and
``try_cast``s to the declared schema (bad values become NULL rather than
failing the job under ANSI mode).  Between stages parquet is used.

Quoted fields follow RFC 4180, as pandas writes and reads them: commas and
doubled quotes inside quotes are text, and so is a quote within a plain field.
Line breaks inside quotes need ``multi_line=True``, which finds the true record
ends block by block (``csv_blocks``); without it a file with an open field at
a line's end is refused, never misread.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from duelframe import config as C
from duelframe.functions.exprs import as_date, lenient_date, nan_to_null
from duelframe.sources.csv_blocks import CsvTextError, read_blocks


def _is_na(c: Column) -> Column:
    return F.trim(c).isin(C.NA_TOKENS) | c.isNull()


def normalize_raw(df: DataFrame, schema: T.StructType | None = None) -> DataFrame:
    """NA tokens -> NULL, text -> declared type (``try_cast``), NaN -> NULL.

    With no schema the input types are kept: strings get the token mapping,
    floating columns lose NaN.  One projection, no job.
    """
    types = {f.name: f.dataType for f in (schema.fields if schema else df.schema.fields)}
    current = dict(df.dtypes)
    out = []
    for name in df.columns:
        c = F.col(f"`{name}`")
        target = types.get(name, T.StringType())
        if current[name] == "string":
            c = F.when(_is_na(c), F.lit(None).cast("string")).otherwise(c)
            if not isinstance(target, T.StringType):
                if isinstance(target, T.BooleanType):
                    low = F.lower(F.trim(c))
                    c = F.when(low == "true", F.lit(True)).when(low == "false", F.lit(False))
                elif isinstance(target, T.DateType):
                    c = lenient_date(c)
                else:
                    # integral text such as "3.0" (pandas writes nullable ints as floats)
                    if isinstance(target, (T.IntegerType, T.LongType, T.ShortType)):
                        c = F.coalesce(c.try_cast(target), _number(c).try_cast("double").try_cast(target))
                    else:
                        c = _number(c).try_cast(target)
        if isinstance(target, (T.DoubleType, T.FloatType)):
            c = nan_to_null(c, target.simpleString())
        out.append(c.alias(name))
    return df.select(*out)


#: Text that is a number; a cast alone would take Java's suffixes (``1d``, ``2f``), too.
NUMBER = r"^\s*[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?\s*$|^\s*[+-]?(?i:inf|infinity|nan)\s*$"


def _number(c: Column) -> Column:
    """The text of ``c`` if it is a number's, else empty (no cast takes that).

    ``c`` stands once in it: these expressions are nested for every column of a wide table.
    """
    return F.regexp_extract(c, NUMBER, 0)


def _refuse_open_quotes(spark: SparkSession, path: str) -> None:
    """A line in which a quoted field opens and does not close belongs to a field with a line break."""
    closed = F.regexp_replace("value", '(^|(?<=,))"(?:[^"]++|"")*+"[^,]*+', "")
    bad = spark.read.text(path).agg(F.count_if(F.col("value").contains('"') & closed.rlike('(^|,)"'))).first()[0]
    if bad:
        raise CsvTextError(f"{path}: {bad} lines end inside a quoted field; read it with multi_line=True")


def _text_scan(spark: SparkSession, path: str, names: list[str] | None = None) -> DataFrame:
    reader = spark.read.option("header", True).option("emptyValue", "") \
        .option("quote", '"').option("escape", '"') \
        .option("nullValue", "\u0000never\u0000")
    if names is not None:
        reader = reader.schema(T.StructType([T.StructField(n, T.StringType(), True) for n in names]))
    else:
        reader = reader.option("inferSchema", False)  # every column as text
    return reader.csv(path)


def infer_schema(text: DataFrame) -> T.StructType:
    """Types for an all-text table, like pandas' CSV inference, in one pass.

    A column is boolean / bigint / double / date when every non-missing
    value parses as one (tried in that order; dates in any layout of
    ``DATE_FORMATS``), text otherwise; a column with no values at all is
    double (pandas' all-NaN float column).
    """
    aggs = []
    for i, name in enumerate(text.columns):
        c = F.col(f"`{name}`")
        c = F.when(_is_na(c), F.lit(None).cast("string")).otherwise(F.trim(c))
        aggs += [F.count(c).alias(f"n{i}"),
                 F.count_if(F.lower(c).isin("true", "false")).alias(f"b{i}"),
                 F.count_if(c.try_cast("bigint").isNotNull()).alias(f"i{i}"),
                 F.count_if(_number(c).try_cast("double").isNotNull()).alias(f"d{i}"),
                 F.count_if(lenient_date(c).isNotNull()).alias(f"t{i}")]
    row = text.agg(*aggs).first()
    fields = []
    for i, name in enumerate(text.columns):
        n = row[f"n{i}"]
        if n == 0:
            dtype = T.DoubleType()
        elif row[f"b{i}"] == n:
            dtype = T.BooleanType()
        elif row[f"i{i}"] == n:
            dtype = T.LongType()
        elif row[f"d{i}"] == n:
            dtype = T.DoubleType()
        elif row[f"t{i}"] == n:
            dtype = T.DateType()
        else:
            dtype = T.StringType()
        fields.append(T.StructField(name, dtype, True))
    return T.StructType(fields)


def read_raw_csv(spark: SparkSession, path: str, schema: T.StructType | None = None,
                 multi_line: bool = False) -> DataFrame:
    """Raw contests from CSV with a header, typed by ``schema`` (inferred
    with one pass over the text when not given)."""
    if multi_line:
        names = [f.name for f in schema.fields] if schema else _text_scan(spark, path).columns
        text = read_blocks(spark, path, names, _ROW).drop(_ROW)
        return normalize_raw(text, schema or infer_schema(text))
    _refuse_open_quotes(spark, path)
    if schema is None:
        schema = infer_schema(_text_scan(spark, path))
    df = _text_scan(spark, path, [f.name for f in schema.fields])
    return normalize_raw(df, schema)


_ROW = "__row"


def read_keyed_csv(spark: SparkSession, path: str | list[str], key: str = "bout_id",
                   schema: T.StructType | None = None) -> DataFrame:
    """Raw contests from one or many CSV files, keyed by the rows' order (path, then place) if they have no ``key``.

    The key does not depend on split size, tasks or cores.
    """
    names = [f.name for f in schema.fields] if schema else _text_scan(spark, path).columns
    text = read_blocks(spark, path, names, _ROW)
    typed = normalize_raw(text.drop(_ROW), schema or infer_schema(text.drop(_ROW)))
    if key in names:
        return typed
    full = T.StructType([T.StructField(_ROW, T.LongType()), *(schema or typed.schema).fields])
    return normalize_raw(text, full).withColumnRenamed(_ROW, key)


def with_row_key(df: DataFrame, key: str = "bout_id") -> DataFrame:
    """Add a row key when the input, a single file, has none.

    ``monotonically_increasing_id`` applied directly on a file scan (no
    shuffle before it) follows the order of one file, which the reference's
    stable sort falls back to for equal dates.  Over several files it would
    depend on their sizes and on the split size, so those need a key column.
    """
    if key in df.columns:
        return df
    if len(df.inputFiles()) > 1:
        raise ValueError(f"several files without a column {key!r}: rows need a key that does not depend on the scan")
    return df.select(F.monotonically_increasing_id().alias(key), "*")


def read_contests(spark: SparkSession, path: str, fmt: str = "csv",
                  schema: T.StructType | None = None, key: str = "bout_id",
                  multi_line: bool = False) -> DataFrame:
    """Raw contest table from CSV (typed, NA tokens handled) or parquet.

    CSV rows without a key are numbered in file order, over several files too.
    """
    if fmt == "csv":
        if multi_line:
            return read_keyed_csv(spark, path, key, schema)
        df = read_raw_csv(spark, path, schema)
        if key not in df.columns and len(df.inputFiles()) > 1:
            return read_keyed_csv(spark, path, key, schema)
    else:
        df = normalize_raw(spark.read.parquet(path))
    return with_row_key(df, key)


def write_table(df: DataFrame, path: str, fmt: str = "parquet",
                partition_by: list[str] | None = None) -> None:
    """Overwrite ``path`` (parents are created by the writer)."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w.option("header", True).option("escape", '"').csv(path)
    elif fmt == "json":
        w.json(path)
    else:
        w.parquet(path)


def write_features(features: DataFrame, path: str, date_col: str = "Date") -> None:
    """Feature table partitioned by year, so date-range reads prune files."""
    write_table(features.withColumn("year", F.year(as_date(features, date_col))), path,
                partition_by=["year"])


def read_features(spark: SparkSession, path: str, first_date=None, last_date=None,
                  keep_year: bool = False) -> DataFrame:
    """Feature table written by ``write_features``; date bounds prune
    year directories before any file is opened."""
    df = spark.read.parquet(path)
    d = as_date(df, "Date")
    if first_date is not None:
        df = df.filter((F.col("year") >= F.year(F.lit(first_date).cast("date")))
                       & (d >= F.lit(first_date).cast("date")))
    if last_date is not None:
        df = df.filter((F.col("year") <= F.year(F.lit(last_date).cast("date")))
                       & (d <= F.lit(last_date).cast("date")))
    return df if keep_year else df.drop("year")
