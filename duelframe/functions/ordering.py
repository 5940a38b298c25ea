"""Order-dependent helpers that never put a data-sized input in one task.

* ``top_k_per_group``: ``row_number`` per group filtered to ``<= k``.  Spark
  plans this as a *partial* ``WindowGroupLimit`` before the shuffle, so only
  ``k`` rows per group and map partition move -- a group holding a third of
  all rows costs no more than a small one.
* ``quantile_edges`` / ``bucketize``: order-preserving buckets of a number
  from approximate quantiles, by binary search in the JVM.
* ``sample_edges`` / ``bucket_of``: the same for values of any orderable type,
  from a bounded sample by hash; the bucket id is a balanced CASE tree.
* ``kth_smallest`` / ``positions``: exact order statistics and exact places in
  a sorted order, from bucket counts, without sorting everything in one task.
* ``top_counts``: the most frequent values, exact, without a shuffle of all values.
* ``prefix_before``: exclusive running sums over a *small* ordered table
  (bucket totals), used to turn per-bucket counts into global offsets.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_k_per_group(df: DataFrame, group_cols: list[str], order_cols: list[Column],
                    k: int, rank_col: str = "rank") -> DataFrame:
    """Rows ranked 1..k within each group (ties broken by ``order_cols``)."""
    w = Window.partitionBy(*group_cols).orderBy(*order_cols)
    return df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= k)


SKETCH_GROUPS = 32  # tasks that merge the sketches of one set of quantiles


def quantile_edges(df: DataFrame, col: str, n_buckets: int,
                   accuracy: int = 10000) -> list:
    """Sorted distinct approximate quantile edges of ``col`` (bounded list).

    Tasks' sketches are merged in ``SKETCH_GROUPS`` groups by task, so no task
    merges them all.  The groups' quantiles, weighted by the groups' rows, are
    merged on the driver: ``SKETCH_GROUPS * (n_buckets - 1)`` numbers at most.
    """
    if n_buckets <= 1:
        return []
    probs = [i / n_buckets for i in range(1, n_buckets)]
    groups = (df.select(F.col(col).alias("_v"), F.pmod(F.spark_partition_id(), F.lit(SKETCH_GROUPS)).alias("_g"))
              .where(F.col("_v").isNotNull()).groupBy("_g")
              .agg(F.percentile_approx("_v", probs, accuracy).alias("q"), F.count(F.lit(1)).alias("n")).collect())
    points = sorted((q, r["n"] / len(probs)) for r in groups for q in r["q"])
    share = sum(r["n"] for r in groups) / n_buckets
    edges, below = [], 0.0
    for q, n in points:
        below += n
        while below >= share * (len(edges) + 1) and len(edges) < n_buckets - 1:
            edges.append(q)
    return sorted(set(edges))


COUNT_BUCKETS = 1 << 16


def top_counts(df: DataFrame, col: str, k: int, n_buckets: int = COUNT_BUCKETS) -> DataFrame:
    """The ``k`` most frequent non-NULL values (value, n), ties to the smaller value; exact.

    Counting every value shuffles a row per distinct value.  Here rows are
    first counted per hash bucket (``n_buckets`` rows a task at most); a value
    occurs no more often than its bucket.  Recounting the values of the ``k``
    fullest buckets gives a k-th count that the answer can't fall below, so
    only buckets that reach it are recounted for the answer.  With a few heavy
    values that is a small part of the values; without, it is all of them.
    """
    value = F.col(col)
    if df.schema[col].dataType.typeName() in ("double", "float"):
        value = value + F.lit(0.0).cast(df.schema[col].dataType)  # -0.0 equals 0.0 but has another hash
    rows = df.select(value.alias("value")).where(F.col("value").isNotNull()) \
        .withColumn("_b", F.pmod(F.xxhash64("value"), F.lit(n_buckets)).cast("int"))
    full = sorted(((r["n"], r["_b"]) for r in rows.groupBy("_b").agg(F.count(F.lit(1)).alias("n")).collect()), reverse=True)

    def counted(buckets: list[int]) -> DataFrame:
        table = df.sparkSession.createDataFrame([(b,) for b in buckets], "_b int")
        return (rows.join(F.broadcast(table), "_b", "left_semi")  # <= n_buckets rows
                .groupBy("value").agg(F.count(F.lit(1)).alias("n"))
                .orderBy(F.col("n").desc(), F.col("value")).limit(k))

    first = counted([b for _, b in full[:k]]).collect()
    least = first[-1]["n"] if len(first) == k else 0
    return counted([b for n, b in full if n >= least])


EDGES = 255  # edges of one CASE tree


def sample_edges(df: DataFrame, col: str, n: int = EDGES) -> list:
    """At most ``n`` values of ``col`` in ascending order, for any orderable type.

    Takes the values of least hash, which is a uniform sample of the distinct
    values; a partial top-k per task, so at most ``n`` values per task move.
    """
    picked = df.select(col).orderBy(F.xxhash64(col), F.col(col)).limit(n)
    return [r[0] for r in picked.orderBy(col).collect()]


def bucket_of(c: Column, edges: list[Column]) -> Column:
    """Bucket index in ``0..len(edges)``: number of edges ``<= c``.

    Built as a balanced binary CASE tree (depth log2 of the edge count), so it
    is monotone in ``c`` and fully code-generated.
    """
    def build(lo: int, hi: int) -> Column:
        # answer lies in [lo, hi]
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi + 1) // 2          # test edge index mid-1
        return F.when(c < edges[mid - 1], build(lo, mid - 1)).otherwise(build(mid, hi))

    return build(0, len(edges)).cast("int")


def prefix_before(small: DataFrame, order_cols: list[str], value_cols: list[str],
                  partition_cols: list[str] | None = None) -> DataFrame:
    """Add ``<v>_before`` = sum of ``v`` over all earlier rows.

    Only for tables whose size is bounded by construction (bucket totals,
    per-date counts); without ``partition_cols`` the window runs in one task.
    """
    w = Window.orderBy(*order_cols) if not partition_cols else \
        Window.partitionBy(*partition_cols).orderBy(*order_cols)
    w = w.rowsBetween(Window.unboundedPreceding, -1)
    out = small
    for v in value_cols:
        out = out.withColumn(f"{v}_before", F.coalesce(F.sum(v).over(w), F.lit(0)))
    return out


def bucketize(df: DataFrame, col: str, edges: list, out: str) -> DataFrame:
    """Add ``out`` = order-preserving bucket of the number ``col``
    (``ml.feature.Bucketizer``: JVM binary search over the split array)."""
    splits = [float("-inf")] + sorted({float(e) for e in edges}) + [float("inf")]
    tmp = f"{out}__in"
    b = Bucketizer(splits=splits, inputCol=tmp, outputCol=out, handleInvalid="keep")
    return b.transform(df.withColumn(tmp, F.col(col).cast("double"))) \
        .withColumn(out, F.col(out).cast("int")).drop(tmp)


def positions(df: DataFrame, col: str, out: str = "position") -> DataFrame:
    """Distinct non-NULL values of ``col`` with their 0-based place in sorted order.

    Buckets by sampled edges, bucket totals for the offsets (at most
    ``EDGES + 1`` rows), and a window inside each bucket.
    """
    values = df.select(col).where(F.col(col).isNotNull()).distinct()
    edges = [F.lit(e) for e in sample_edges(values, col)]
    placed = values.withColumn("_b", bucket_of(F.col(col), edges))
    totals = prefix_before(placed.groupBy("_b").agg(F.count(F.lit(1)).alias("_n")), ["_b"], ["_n"])
    w = Window.partitionBy("_b").orderBy(col)
    return (placed.join(F.broadcast(totals.select("_b", "_n_before")), "_b")  # <= EDGES + 1 rows
            .select(col, (F.col("_n_before") + F.row_number().over(w) - 1).cast("bigint").alias(out)))


@dataclass
class OrderedKey:
    """A key in (NULLs first) lexicographic order, and the rows before and at it."""
    values: tuple
    rows_before: int
    rows_at: int


def at_most(keys: list[Column], values: tuple) -> Column:
    """Whether the keys are at or before ``values``; NULL comes first, never NULL itself."""
    key, value, rest = keys[0], values[0], values[1:]
    null = key.isNull()
    if not rest:
        return null if value is None else null | F.coalesce(key <= F.lit(value), F.lit(False))
    less = F.lit(False) if value is None else null | F.coalesce(key < F.lit(value), F.lit(False))
    return less | (key.eqNullSafe(F.lit(value)) & at_most(keys[1:], rest))


def kth_smallest(df: DataFrame, key: str | list[str], k: int, final_keys: int = 20_000,
                 n_edges: int = EDGES) -> OrderedKey:
    """The key of the exact k-th row (1-based) in ascending order of ``key``.

    Keys may be of any orderable type, NULL (first) or repeated: rows are
    counted per distinct key first, so repeats collapse.  Each round samples
    edges among the remaining keys, counts rows per bucket (at most
    ``n_edges + 1`` rows come back) and keeps the bucket that holds row k,
    which leaves fewer distinct keys each time.  The last ``final_keys`` keys
    at most get a running sum.
    """
    keys = [key] if isinstance(key, str) else list(key)
    counted = df.groupBy(F.struct(*keys).alias("_k")).agg(F.count(F.lit(1)).alias("_n"))
    types = counted.schema["_k"].dataType.fields

    def lit(row) -> Column:
        return F.struct(*[F.lit(row[f.name]).cast(f.dataType).alias(f.name) for f in types])

    total = counted.agg(F.sum("_n").alias("n"), F.count(F.lit(1)).alias("keys")).first()
    if not 1 <= k <= (total["n"] or 0):
        raise ValueError(f"k={k} outside 1..{total['n'] or 0}")
    left, below, n_keys = counted, 0, total["keys"]
    while n_keys > final_keys:
        edges = sample_edges(left, "_k", n_edges)
        spread = left.withColumn("_b", bucket_of(F.col("_k"), [lit(e) for e in edges]))
        counts = spread.groupBy("_b").agg(F.sum("_n").alias("n"), F.count(F.lit(1)).alias("keys"))
        for r in sorted(counts.collect(), key=lambda r: r["_b"]):
            if below + r["n"] >= k:
                b, n_keys = r["_b"], r["keys"]
                break
            below += r["n"]
        low = F.lit(True) if b == 0 else F.col("_k") >= lit(edges[b - 1])
        high = F.lit(True) if b == len(edges) else F.col("_k") < lit(edges[b])
        left = left.filter(low & high)
    w = Window.orderBy("_k").rowsBetween(Window.unboundedPreceding, -1)
    row = (left.withColumn("_before", F.lit(below) + F.coalesce(F.sum("_n").over(w), F.lit(0)))
           .filter((F.col("_before") < k) & (F.col("_before") + F.col("_n") >= k)).first())
    return OrderedKey(tuple(row["_k"][f.name] for f in types), int(row["_before"]), int(row["_n"]))
