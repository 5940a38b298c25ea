"""Embedding whitening: distributed covariance, eigenvectors by mixed-precision refinement.

Entries are quantised to integers, so the sums and co-moments that Spark adds
up are exact, whatever the order and number of the tasks.  Every task centres
its rows by the integers nearest to the means before it multiplies them; what
is left of the means is taken off in exact arithmetic.  Tasks send one row of
d values for each dimension, so the shuffle does not grow with the rows of a
task, and the driver gets d x d numbers.

Eigenvectors of the covariance come from LAPACK in float32 and are then
corrected by Ogita and Aishima's iteration, which consists of matrix products
in higher precision (numpy's long double) and converges quadratically.  The
correction of a pair of columns divides by the gap of their eigenvalues, so it
fails for eigenvalues that lie closer together than the error so far.  Those
form clusters: within each, the matrix is projected on the cluster's columns,
shifted by their mean eigenvalue (which magnifies the gaps relative to what is
left) and solved on its own in double precision; the columns are turned by the
result and the iteration goes on.

Defined results: a row whose vector is null, or holds a null or an entry that
is not finite, is dropped.  Vectors have one dimension: the most frequent length (the
larger of equals); rows of another length are dropped too, empty vectors
likewise.  A null id stays null and repeated rows count as often as they stand.
A component without variance (constant or dependent dimensions, fewer rows
than dimensions) has no whitened value: null, and explained 0; it is left out
of the identity error.  An empty table gives no rows.  An entry beyond 2^40 in
absolute value raises an error, since its integer would leave the exact range;
a deviation beyond 64 bits is null.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import free_name, in_arrow

SCALE, SHIFT = 1024, 100_000
LARGEST = 2.0 ** 40
WIDE = np.longdouble
#: A component whose variance is below this share of the largest has none.
FLAT = 1e-13


def quantised(column: pa.Array, dim: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(length of each row's vector or -1 if unusable, row numbers, integer matrix of the rows of length ``dim``)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    offsets = column.offsets.to_numpy().astype(np.int64)
    flat = column.values
    values = flat.cast(pa.float64()).to_numpy(zero_copy_only=False)  # nulls become NaN
    lengths = np.diff(offsets)
    bad = np.concatenate(([0], np.cumsum(~np.isfinite(values))))
    unusable = (bad[offsets[1:]] > bad[offsets[:-1]]) | (lengths == 0)
    if column.null_count:
        unusable |= column.is_null().to_numpy(zero_copy_only=False)
    lengths[unusable] = -1
    if dim is None:
        return lengths, np.zeros(0, np.int64), np.zeros((0, 0), np.int64)
    rows = np.flatnonzero(lengths == dim)
    picked = values[offsets[:-1][rows][:, None] + np.arange(dim)]
    if picked.size and np.abs(picked).max() > LARGEST:
        raise ValueError(f"an entry of the vectors exceeds {LARGEST:g}")
    return lengths, rows, np.floor(SCALE * picked).astype(np.int64) + SHIFT


def _vectors(df: DataFrame, vector: str) -> DataFrame:
    return df.select(F.col(f"`{vector}`").cast("array<double>").alias("v"))


def totals(df: DataFrame, vector: str = "embedding") -> tuple[int, int, list[int]]:
    """(dimension, rows, exact sums) of the usable vectors of the most frequent length; (0, 0, []) without any."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, list] = {}
        for batch in batches:
            for dim in np.unique(quantised(batch.column(0))[0]):
                if dim > 0:
                    x = quantised(batch.column(0), int(dim))[2]
                    n, so_far = sums.get(int(dim), (0, 0))
                    sums[int(dim)] = n + len(x), so_far + x.sum(axis=0).astype(object)
            if sum(sums) > 1 << 20:  # many lengths: Spark adds up the parts
                yield from _cells(sums)
                sums = {}
        yield from _cells(sums)

    parts = _vectors(df, vector).mapInArrow(run, "dim int, n long, j int, s string")
    every = (parts.groupBy("dim", "j").agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))
             .groupBy("dim", "n").agg(F.collect_list(F.struct("j", "s")).alias("s")))  # dim numbers a row
    top = every.orderBy(F.desc("n"), F.desc("dim")).first()
    return (top["dim"], top["n"], [int(r["s"]) for r in sorted(top["s"])]) if top else (0, 0, [])


def _cells(sums: dict[int, tuple]) -> Iterator[pa.RecordBatch]:
    for dim, (n, total) in sums.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(dim, dim, np.int32)), pa.array(np.full(dim, n)), pa.array(np.arange(dim, dtype=np.int32)),
             pa.array([str(v) for v in total])], ["dim", "n", "j", "s"])


def _products_of_all(df: DataFrame, vector: str, middle: np.ndarray) -> list[list[int]]:
    """Exact sums of the products of all pairs of dimensions, rows centred by ``middle``."""
    dim = len(middle)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            _, _, x = quantised(batch.column(0), dim)
            for at in range(0, len(x), 4096):
                part = _products(x[at:at + 4096] - middle).astype(object)
                total = part if total is None else total + part
        if total is not None:
            i = np.repeat(np.arange(total.shape[0]), total.shape[1])
            j = np.tile(np.arange(total.shape[1]), total.shape[0])
            for at in range(0, len(i), 1 << 16):
                cells = [str(v) for v in total.reshape(-1)[at:at + (1 << 16)]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(i[at:at + (1 << 16)].astype(np.int32)), pa.array(j[at:at + (1 << 16)].astype(np.int32)),
                     pa.array(cells)], ["i", "j", "s"])

    sums = (_vectors(df, vector).mapInArrow(run, "i int, j int, s string")
            .groupBy("i", "j").agg(F.sum(F.col("s").cast("decimal(38,0)")).cast("string").alias("s")))
    out = [[0] * dim for _ in range(dim)]
    for r in sums.collect():  # dim x dim numbers
        out[r["i"]][r["j"]] = int(r["s"])
    return out


def _products(y: np.ndarray) -> np.ndarray:
    """y'y in exact integers: by BLAS while doubles hold every sum, else split into high and low parts."""
    largest = int(np.abs(y).max()) if y.size else 0
    if largest * largest * max(len(y), 1) < 1 << 53:
        f = y.astype(np.float64)
        return (f.T @ f).astype(np.int64)
    if largest < 1 << 30 and largest * largest * len(y) < 1 << 62:
        high, low = y >> 15, y & 0x7FFF  # parts below 2^16: sums of 4,096 products stay below 2^53
        h, l = high.astype(np.float64), low.astype(np.float64)
        cross = (h.T @ l).astype(np.int64)
        return ((h.T @ h).astype(np.int64) << 30) + ((cross + cross.T) << 15) + (l.T @ l).astype(np.int64)
    o = y.astype(object)
    return o.T @ o


@dataclass
class Moments:
    n: int
    sums: list[int]
    covariance: np.ndarray  # long double, dim x dim


def moments(df: DataFrame, vector: str = "embedding") -> Moments:
    """Rows, exact sums and the covariance (divisor n) of the quantised vectors, in two passes."""
    dim, n, sums = totals(df, vector)
    if not dim:
        return Moments(0, [], np.zeros((0, 0), WIDE))
    middle = np.array([(2 * s + n) // (2 * n) for s in sums], np.int64)
    rest = [s - n * int(m) for s, m in zip(sums, middle)]
    gram = _products_of_all(df, vector, middle)
    cov = np.empty((dim, dim), WIDE)
    for i in range(dim):
        for j in range(dim):
            cov[i, j] = _ratio(n * gram[i][j] - rest[i] * rest[j], n * n)
    return Moments(n, sums, cov)


def _ratio(a: int, b: int) -> WIDE:
    """a / b of integers in long double."""
    whole, left = divmod(a, b)
    high = whole >> 32
    return WIDE(high) * WIDE(1 << 32) + WIDE(whole - (high << 32)) + WIDE(left / b)


def refine(a: np.ndarray, x: np.ndarray, rounds: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, eigenvectors) of symmetric ``a`` in falling order, from approximate vectors ``x``.

    Ogita and Aishima's correction with a sub-solve for every cluster, until
    it no longer changes the vectors beyond what the precision resolves.
    """
    a, x = a.astype(WIDE), x.astype(WIDE)
    d = len(a)
    noise = 8 * d * np.finfo(WIDE).eps
    norm = np.sqrt((a * a).sum())
    close = np.sqrt(np.finfo(WIDE).eps) * norm  # below, rounding over gap is no small correction any more
    last = np.inf
    for _ in range(rounds):
        r = np.eye(d, dtype=WIDE) - x.T @ x
        s = x.T @ (a @ x)
        r, s = (r + r.T) / 2, (s + s.T) / 2  # a small gap would magnify what rounding makes unsymmetric
        values = np.diag(s) / (1 - np.diag(r))
        order = np.argsort(-values, kind="stable")
        x, values, r, s = x[:, order], values[order], r[np.ix_(order, order)], s[np.ix_(order, order)]
        off = s - np.diag(np.diag(s))
        left = max(np.abs(off).max() / norm, np.abs(r).max())
        if left < noise or (left < 1e-16 and left >= last / 2):
            break
        last = left
        reach = max(close, 2 * (np.sqrt((off * off).sum()) + norm * np.sqrt((r * r).sum())))
        gap = values[None, :] - values[:, None]
        apart = np.abs(gap) > reach
        e = np.where(apart, (s + values[None, :] * r) / np.where(apart, gap, 1), r / 2)
        x = x + x @ e
        _sub_solves(a, x, values, reach)
    return values, x


def _sub_solves(a: np.ndarray, x: np.ndarray, values: np.ndarray, reach: float) -> None:
    """Turn the columns of each cluster into eigenvectors of the projected, shifted matrix, in place."""
    start, d = 0, len(values)
    while start < d:
        end = start + 1
        while end < d and values[end - 1] - values[end] <= reach:
            end += 1
        if end - start > 1:
            block = x[:, start:end]
            inner = block.T @ (a @ block) - values[start:end].mean() * (block.T @ block)
            inner = (inner + inner.T) / 2
            size = np.abs(inner).max()
            if size > 0:
                _, w = np.linalg.eigh((inner / size).astype(np.float64))
                w = w[:, ::-1].astype(WIDE)
                x[:, start:end] = block @ (1.5 * w - w @ (w.T @ w) / 2)  # orthonormal beyond double precision
        start = end


def components(cov: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, unit eigenvectors as columns) by falling eigenvalue, in long double; largest entry positive."""
    size = np.abs(cov).max() if cov.size else 0
    if not size:
        return np.zeros(len(cov), WIDE), np.eye(len(cov), dtype=WIDE)
    _, first = np.linalg.eigh((cov / size).astype(np.float32))
    values, x = refine(cov / size, first[:, ::-1])
    x = x / np.sqrt((x * x).sum(axis=0))
    signs = np.sign(x[np.abs(x).argmax(axis=0), np.arange(x.shape[1])])
    return values * size, x * signs


@dataclass
class Whitening:
    dim: int
    n: int
    sums: list[int]
    values: np.ndarray  # of the first components
    vectors: np.ndarray  # dim x components
    explained: list[float]

    def project(self, x: np.ndarray) -> np.ndarray:
        """Whitened coordinates of integer rows; NaN where a component has no variance."""
        mean_floor = np.array([s // self.n for s in self.sums], np.int64)
        part = np.array([(s % self.n) / self.n for s in self.sums])
        with np.errstate(divide="ignore", invalid="ignore"):
            scaled = self.vectors.astype(np.float64) / np.sqrt(self.values.astype(np.float64))
        scaled[:, self.flat] = np.nan
        return ((x - mean_floor) - part) @ scaled

    @property
    def flat(self) -> np.ndarray:
        return np.array([not e > 0.0 for e in self.explained], bool)

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum over dimensions of (n x - S)^2, exact; None beyond 64 bits."""
        s, n = self.sums, self.n
        largest = max((n * int(v) - t for t, v in zip(s, x.max(axis=0))), default=0) if len(x) else 0
        least = min((n * int(v) - t for t, v in zip(s, x.min(axis=0))), default=0) if len(x) else 0
        bound = max(abs(largest), abs(least))
        if bound * bound * self.dim < 1 << 62 and n * max(int(np.abs(x).max()) if x.size else 0, 1) < 1 << 62:
            y = n * x - np.array(s, np.int64)
            return (y * y).sum(axis=1).tolist()
        y = n * x.astype(object) - np.array(s, object)
        return [v if v < 1 << 63 else None for v in (y * y).sum(axis=1).tolist()]


def fit(df: DataFrame, vector: str = "embedding", n_components: int = 8) -> Whitening | None:
    """Whitening of all usable rows of ``df``; None if there are none."""
    m = moments(df, vector)
    dim = len(m.sums)
    if not dim:
        return None
    values, vectors = components(m.covariance)
    k = min(n_components, dim)
    trace = np.trace(m.covariance)
    explained = [float(v / trace) if trace > 0 and v > FLAT * values[0] else 0.0 for v in values[:k]]
    return Whitening(dim, m.n, m.sums, values[:k], vectors[:, :k], explained)


def identity_error(df: DataFrame, white: Whitening, vector: str = "embedding") -> float:
    """Largest absolute entry of the whitened rows' covariance minus the identity, over components with variance."""
    live = np.flatnonzero(~white.flat)
    k = len(live)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k + 1, k))
        for batch in batches:
            w = white.project(quantised(batch.column(0), white.dim)[2])[:, live]
            total += np.vstack([w.T @ w, w.sum(axis=0)])
        i, j = np.divmod(np.arange(total.size), max(k, 1))
        yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)),
                                          pa.array(total.reshape(-1))], ["i", "j", "s"])

    cells = (_vectors(df, vector).mapInArrow(run, "i int, j int, s double")
             .groupBy("i", "j").agg(F.sum("s").alias("s")).collect())
    total = np.zeros((k + 1, k))
    for r in cells:  # (k + 1) x k numbers
        total[r["i"], r["j"]] = r["s"]
    mean = total[k] / white.n
    return float(np.abs(total[:k] / white.n - np.outer(mean, mean) - np.eye(k)).max()) if k else 0.0


SCHEMA = "component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(df: DataFrame, id_col: str = "vec_id", vector: str = "embedding", n_components: int = 8) -> DataFrame:
    """(id_col, component, n, deviation, whitened, explained, identity_error): a row per usable vector and component."""
    name = free_name([f.split()[0] for f in SCHEMA.split(", ")], id_col)
    schema = f"`{name}` {df.select(F.col(f'`{id_col}`')).schema[0].dataType.simpleString()}, {SCHEMA}"
    white = fit(df, vector, n_components)
    if white is None:
        return df.sparkSession.createDataFrame([], schema)
    error = identity_error(df, white, vector)
    k = len(white.explained)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, rows, x = quantised(batch.column(1), white.dim)
            if not len(rows):
                continue
            w = white.project(x).reshape(-1)
            each = np.repeat(np.arange(len(rows)), k)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows[each])), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(rows))),
                 pa.array(np.full(len(each), white.n)), pa.array(white.deviations(x), pa.int64()).take(pa.array(each)),
                 pa.array(w, mask=np.isnan(w)), pa.array(np.tile(np.array(white.explained), len(rows))),
                 pa.array(np.full(len(each), error))], [name, *[f.split()[0] for f in SCHEMA.split(", ")]])

    rows = df.select(F.col(f"`{id_col}`").alias(name), F.col(f"`{vector}`").cast("array<double>").alias("v"))
    return in_arrow(rows, run, schema)
