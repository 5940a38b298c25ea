"""Quality rules judged together by an isolation forest on their statistics.

Each text gets rule statistics (mean word length, symbols, repeated lines and
words, letter case, digits, punctuation).  An isolation forest is fitted on
labelled good documents: every tree cuts a small random subset by random
columns at random values until its rows stand alone, and a text that is
separated after few cuts is unlike them.  Cuts fall anywhere in a node's part
of the range that all labelled rows span, not only between the good rows that
it holds; a statistic that is constant in good documents (no symbols at all)
would otherwise never be cut and no document could fail by it.  The anomaly
score is
``2 ** (-mean path length / expected path length)``, as published.  The score
above which a document is rejected is calibrated on labelled rows.  Two base
rules reject on their own: under 50 words, or more than half of the words in
repeated three-word windows.

The model rests on all labelled documents: they give the range of every
statistic, the rows counted in every leaf (a leaf's path goes on by the
expected path of its rows, as published) and the rows from which each tree
draws the few that decide which nodes are cut further (``TREE_ROWS``, the
method's own parameter).  The threshold is the best of all labelled documents'
scores.  These are Spark jobs over a table of statistics; what reaches the
driver is bounded by the forest's size (``TREES * TREE_ROWS`` drawn rows, a
count per leaf).  Statistics and verdicts cover all rows and whole texts.

Defined results: a null text has no words, so it fails the base rule; null or
unknown labels are not used; without usable labels of both kinds no document
fails by the forest; of several labels for an id the least quality counts;
repeated rows are judged alike; empty tables give empty tables.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from duelframe.functions.ordering import bucketize, prefix_before, quantile_edges

from .common import in_arrow, written

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\v\f\r"
FEATURES = ["mean_word", "symbol_share", "dup_line_share", "repeat_share", "upper_share",
            "digit_share", "mark_share", "stop_share"]
#: Shares per word and the like are cut off here, so that a few wild texts don't stretch the range.
MOST = np.array([20.0, 1.0, 1.0, 1.0, 1.0, 1.0, 1.0, 2.0])
TREES, TREE_ROWS, MORE_HEIGHT = 100, 256, 8


def _among(data: bytes) -> np.ndarray:
    mask = np.zeros(256, bool)
    mask[list(data)] = True
    return mask


_IS_SYMBOL, _IS_SPACE = _among(SYMBOLS), _among(SPACES)
_IS_UPPER = _among(bytes(range(65, 91)))
_IS_LETTER = _among(bytes(range(65, 91)) + bytes(range(97, 123)) + bytes(range(0xC2, 0xF5)))
_IS_DIGIT, _IS_MARK, _IS_STOP = _among(b"0123456789"), _among(b"!?\"'()[]{}/\\=+_~^@;:-"), _among(b".,")
_IS_LEAD = np.array([not 0x80 <= b < 0xC0 for b in range(256)])


def repeated_words(words: list[bytes]) -> int:
    """Words inside a three-word window that the text holds twice or more."""
    n = len(words)
    if n < 4:
        return 0
    number = dict(zip(words, range(n)))
    ids = np.fromiter(map(number.__getitem__, words), np.int64, n)
    pairs = ids[:-1] * n + ids[1:]  # below n^2, so exact for any text Spark can hold
    if n < 2_000_000:
        windows = pairs[:-1] * n + ids[2:]
    else:
        windows = np.unique(pairs[:-1], return_inverse=True)[1] * n + ids[2:]
    order = np.argsort(windows, kind="stable")
    same = windows[order][1:] == windows[order][:-1]
    if not same.any():
        return 0
    starts = np.concatenate((order[1:][same], order[:-1][same]))
    covered = np.zeros(n, bool)
    for step in range(3):
        covered[starts + step] = True
    return int(covered.sum())


def statistics(text: str | None) -> tuple[list[int], list[float]]:
    """The five counts and the features of a text."""
    data = (text or "").encode("utf-8")
    words = data.split()
    lines = [line for line in data.split(b"\n") if line.strip()]
    bytes_seen = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    n, spaces = len(words), int(bytes_seen[_IS_SPACE].sum())
    chars = int(bytes_seen[_IS_LEAD].sum()) - spaces
    symbols, dups, repeats = int(bytes_seen[_IS_SYMBOL].sum()), len(lines) - len(set(lines)), repeated_words(words)
    letters = int(bytes_seen[_IS_LETTER].sum())
    per = max(n, 1)
    return [n, chars, symbols, dups, repeats], [
        chars / per, symbols / per, dups / max(len(lines), 1), repeats / per,
        int(bytes_seen[_IS_UPPER].sum()) / max(letters, 1), int(bytes_seen[_IS_DIGIT].sum()) / max(chars, 1),
        int(bytes_seen[_IS_MARK].sum()) / per, int(bytes_seen[_IS_STOP].sum()) / per]


@dataclass
class Forest:
    """Trees as flat arrays: column (-1 at a leaf), cut, left child, right child, leaf's path length."""

    column: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    length: np.ndarray
    rows: int
    threshold: float = np.inf

    def leaves(self, x: np.ndarray) -> Iterator[np.ndarray]:
        """For each tree the leaf of every row."""
        x = np.minimum(x, MOST)
        every = np.arange(len(x))
        for t in range(len(self.column)):
            node = np.zeros(len(x), np.int64)
            while (inner := self.column[t, node] >= 0).any():
                less = x[every, np.maximum(self.column[t, node], 0)] < self.cut[t, node]
                node = np.where(inner, np.where(less, self.left[t, node], self.right[t, node]), node)
            yield node

    def scores(self, x: np.ndarray) -> np.ndarray:
        total = np.zeros(len(x))
        for t, node in enumerate(self.leaves(x)):
            total += self.length[t, node]
        return 2.0 ** (-total / len(self.column) / max(_expected(self.rows), 1e-9))

    def counted(self, held: np.ndarray) -> Forest:
        """The same cuts, with ``held`` rows in each tree's leaves."""
        depth = np.zeros(self.column.shape, np.int64)
        for t, node in zip(*np.nonzero(self.column >= 0)):  # a node stands before its children
            depth[t, self.left[t, node]] = depth[t, self.right[t, node]] = depth[t, node] + 1
        paths = np.array([_expected(int(n)) for n in held.ravel()]).reshape(held.shape)
        return replace(self, length=np.where(self.column < 0, depth + paths, 0.0), rows=int(held[0].sum()))


def _expected(n: int) -> float:
    """Mean path length of an unsuccessful search in a binary search tree of n rows."""
    return 2 * (np.log(n - 1) + 0.5772156649015329) - 2 * (n - 1) / n if n > 2 else float(n == 2)


def grow(x: np.ndarray, low: np.ndarray, high: np.ndarray, trees: int = TREES,
         rows: int = TREE_ROWS, seed: int = 42) -> Forest:
    """Fit the trees, each on ``rows`` rows of ``x`` drawn without replacement.

    ``low`` and ``high`` bound the first cuts of each column.
    """
    rng = np.random.default_rng(seed)
    x, low, high = np.minimum(x, MOST), np.minimum(low, MOST), np.minimum(high, MOST)
    rows = min(rows, len(x))
    height = int(np.ceil(np.log2(max(rows, 2)))) + MORE_HEIGHT
    grown = []
    for _ in range(trees):
        nodes = [[-1, 0.0, -1, -1, 0.0]]
        todo = [(0, x[rng.choice(len(x), rows, replace=False)], low, high, 0)]
        while todo:
            at, part, a, b, depth = todo.pop()
            wide = np.flatnonzero(b > a)
            if depth == height or len(part) < 2 or not len(wide):
                nodes[at][4] = depth + _expected(len(part))
                continue
            c = int(rng.choice(wide))
            cut = rng.uniform(a[c], b[c])
            less, below, above = part[:, c] < cut, b.copy(), a.copy()
            below[c] = above[c] = cut
            nodes[at][:4] = c, cut, len(nodes), len(nodes) + 1
            todo += [(len(nodes), part[less], a, below, depth + 1), (len(nodes) + 1, part[~less], above, b, depth + 1)]
            nodes += [[-1, 0.0, -1, -1, 0.0], [-1, 0.0, -1, -1, 0.0]]
        grown.append(nodes)
    size = max(map(len, grown))
    flat = np.array([nodes + [[-1, 0.0, -1, -1, 0.0]] * (size - len(nodes)) for nodes in grown])
    ints = [flat[:, :, i].astype(np.int64) for i in (0, 2, 3)]
    return Forest(ints[0], flat[:, :, 1], ints[1], ints[2], flat[:, :, 4], rows)


def calibrated(scores: np.ndarray, good: np.ndarray, keep_share: float) -> float:
    """The score above which a row is rejected.

    Of the cuts that keep at least ``keep_share`` of the good rows the one
    that rejects the most bad rows for every good one lost: the largest gain
    of bad rows' share minus ten times good rows' share; the higher on ties.
    """
    if not good.any() or good.all():
        return np.inf
    cuts = np.unique(scores)
    lost = 1 - np.searchsorted(np.sort(scores[good]), cuts, side="right") / good.sum()
    found = 1 - np.searchsorted(np.sort(scores[~good]), cuts, side="right") / (~good).sum()
    gain = np.where(lost <= 1 - keep_share, found - 10 * lost, -np.inf)
    best = len(gain) - 1 - int(np.argmax(gain[::-1]))
    if gain[best] <= 0:
        return np.inf
    above = cuts[best + 1] if best + 1 < len(cuts) else np.inf
    return float((cuts[best] + above) / 2)  # halfway to the first rejected score


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
        keep_share: float = 0.995) -> Forest:
    """Fit forest and threshold on all labelled documents of 50 words and more."""
    chosen = (labels.where("quality in (0, 1) and doc_id is not null")
              .groupBy(F.col("doc_id").cast("long").alias("id")).agg(F.min("quality").cast("int").alias("quality")))
    rows = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text")).where("id is not null")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [statistics(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([g[0][0] for g in got], pa.int64()),
                 pa.array([g[1] for g in got], pa.list_(pa.float64()))], ["id", "n_words", "x"])

    # the statistics are narrow, so texts stay where they are; an id that many rows share counts once
    stats = (in_arrow(rows, run, "id long, n_words long, x array<double>")
             .groupBy("id").agg(F.min(F.struct("n_words", "x")).alias("r")).select("id", "r.*"))
    known = written(stats.where("n_words >= 50").join(chosen, "id").select("id", "quality", "x"), "quality-statistics")
    ends = [f(F.col("x")[i]) for f in (F.min, F.max) for i in range(len(FEATURES))]
    n, n_good, *ends = known.agg(F.count(F.lit(1)), F.count_if(F.col("quality") == 1), *ends).first()
    if not n:
        return Forest(*(np.full((1, 1), -1) for _ in range(4)), np.ones((1, 1)), 2)
    model, n_model = (known.where("quality = 1"), n_good) if n_good >= 2 else (known, n)
    drawn = model  # about as many rows as all trees draw, by their ids' hash
    if n_model > TREES * TREE_ROWS:
        part = int(TREES * TREE_ROWS / n_model * 2 ** 31)
        drawn = model.where(F.pmod(F.xxhash64("id"), F.lit(2 ** 31)) < part)
    x = np.array([r["x"] for r in drawn.orderBy("id").collect()])
    forest = grow(x, np.array(ends[:len(FEATURES)]), np.array(ends[len(FEATURES):]))
    forest = forest.counted(_leaf_rows(model, forest))
    forest.threshold = _threshold(known, forest, n_good, n - n_good, keep_share)
    return forest


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, len(FEATURES))


def _leaf_rows(rows: DataFrame, forest: Forest) -> np.ndarray:
    """How many of ``rows`` each node holds as a leaf."""
    shape = forest.column.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(shape, np.int64)
        for batch in batches:
            for t, node in enumerate(forest.leaves(_matrix(batch.column(0)))):
                held[t] += np.bincount(node, minlength=shape[1])
        at = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(held.ravel()[at])], ["at", "n"])

    cells = rows.select("x").mapInArrow(run, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).toArrow()
    held = np.zeros(shape, np.int64)
    held.ravel()[cells["at"].to_numpy()] = cells["n"].to_numpy()
    return held


def _threshold(known: DataFrame, forest: Forest, n_good: int, n_bad: int, keep_share: float) -> float:
    """``calibrated`` of all rows' scores, by running sums over the distinct scores."""
    if not n_good or not n_bad:
        return np.inf

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(forest.scores(_matrix(batch.column(0)))), batch.column(1)],
                                             ["score", "quality"])

    cuts = (known.select("x", "quality").mapInArrow(run, "score double, quality int").groupBy("score")
            .agg(F.count_if(F.col("quality") == 1).alias("good"), F.count_if(F.col("quality") == 0).alias("bad")))
    cuts = written(cuts, "quality-scores")
    placed = bucketize(cuts, "score", quantile_edges(cuts, "score", 256), "b")
    before = prefix_before(placed.groupBy("b").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad")), ["b"], ["good", "bad"])
    inside = Window.partitionBy("b").orderBy("score")

    def above(kind: str, n: int) -> Column:
        return 1 - (F.col(f"{kind}_before") + F.sum(kind).over(inside)) / F.lit(float(n))

    best = (placed.join(F.broadcast(before.select("b", "good_before", "bad_before")), "b")  # 256 rows at most
            .select("score", above("good", n_good).alias("lost"), above("bad", n_bad).alias("found"))
            .where(F.col("lost") <= 1 - keep_share)
            .agg(F.max(F.struct((F.col("found") - 10 * F.col("lost")).alias("gain"), "score")).alias("best")).first()["best"])
    if best is None or best["gain"] <= 0:
        return np.inf
    after = cuts.where(F.col("score") > best["score"]).agg(F.min("score")).first()[0]
    return np.inf if after is None else float((best["score"] + after) / 2)  # halfway to the first rejected score


def judge(docs: DataFrame, forest: Forest, text: str = "text", prefix: str = "") -> DataFrame:
    """``docs`` with the counts, ``score``, ``base_failed`` and ``kept``, their names led by ``prefix``."""
    new = ([T.StructField(prefix + c, T.LongType()) for c in COUNTS]
           + [T.StructField(prefix + "score", T.DoubleType()),
              T.StructField(prefix + "base_failed", T.BooleanType()), T.StructField(prefix + "kept", T.BooleanType())])
    names = [f.name for f in new]
    if clash := {c.lower() for c in docs.columns} & {n.lower() for n in names}:
        raise ValueError(f"choose a prefix: the input already has {sorted(clash)}")
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [statistics(t) for t in batch.column(at).to_pylist()]
            counts = np.array([g[0] for g in got], np.int64).reshape(-1, len(COUNTS))
            scores = forest.scores(np.array([g[1] for g in got]).reshape(-1, len(FEATURES)))
            failed = (counts[:, 0] < 50) | (100 * counts[:, 4] > 50 * counts[:, 0])
            kept = ~failed & ~(scores > forest.threshold)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *(pa.array(c) for c in counts.T.copy()), pa.array(scores), pa.array(failed),
                 pa.array(kept)], [*batch.schema.names, *names])

    return in_arrow(docs, run, T.StructType([*docs.schema.fields, *new]))
