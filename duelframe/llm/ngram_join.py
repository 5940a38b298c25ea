"""N-gram Jaccard join: the product of the document by n-gram incidence matrix, in blocks.

A document's set holds the distinct word shingles of its text.  Two documents
are linked when 100 * |intersection| >= percent * |union|; groups are the
connected components of all links.

Documents with equal sets are one row of the matrix, a class, whatever their
number.  The overlaps of all classes are the entries of the matrix times its
transpose, added up column by column, of which most need not be formed:

* Columns are ordered, the rarest first (by a count sketch of fixed size; any
  order gives the same links, a good one makes less work).  A linked pair
  overlaps in percent of the larger set at least, hence meets among the first
  n - ceil(percent * n / 100) + 1 columns of both; only these columns are
  multiplied.
* A column (all classes with one n-gram) with many rows is cut into tiles by
  class, and every pair of tiles is a block of its own; blocks, not columns,
  are spread over the tasks, so no task gathers a column.
* A product is not formed if the sizes alone rule a link out, or if the columns
  from this one on, and those before it that any other class has too, cannot
  fill the required overlap.
* Partial overlaps are added up by pair in Spark.  A pair whose sum and rests
  stay below the required overlap is dropped; the others are multiplied in
  full, on the classes' whole sets.

Thousands of near copies of one text would give millions of true links, which
the groups do not need.  ``groups`` therefore first links classes to a central
one among those that agree with them in some least shingle hashes: the one
with the fewest columns of its own, since a copy's edits make columns that no
other class has, and the text that all were made from has none.  These are
true links, checked on whole sets.  Then blocks are multiplied for classes of
different groups only, which leaves out no link between two groups, so the
components are those of all links.  ``links`` gives every single link.

Shingles are held as 64-bit hashes; two different shingles of one pair of
documents with equal hashes have a chance of about 1e-13 for texts of 1,000
words.

Defined results: a null text is empty; a text with fewer words than a shingle
is one shingle, one without words has an empty set and is linked with nothing,
so its component is its own id.  Repeated rows are one row each with the same
result; rows of one id with different texts are different members.  A null id
never names a group unless all its ids are null.  Only the id and the text
are read, so other columns can't clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import in_arrow, written
from .components import connected_components

WORDS, PERCENT = 5, 80
#: Classes in a tile of a column; a block compares two tiles.
TILE = 4096
#: Cells of the sketch that orders the columns: 0.5 MB on the driver and in each task, at every input size.
CELLS = 1 << 16
#: Least hashes per class: each pair of neighbouring ones is a band.
BINS = 8
#: Pairs formed at once in a task.
PAIRS = 1 << 20

#: Bytes of text hashed at once.
CHUNK = 1 << 18

_BLANK = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _factors(n: int, seed: int) -> np.ndarray:
    """n odd 64-bit numbers that look random."""
    return _mixed(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed)) | np.uint64(1)


_PLACES = _factors(256, 1)
_BYTES = _factors(256, 2)
_BYTES[ord("A"):ord("Z") + 1] = _BYTES[ord("a"):ord("z") + 1]  # lower-cased
_BYTES[_BLANK] = 0


def _word_hashes(joined: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(start, hash) of every word: sum of byte value times a factor of its place, mixed."""
    raw = np.frombuffer(joined, np.uint8)
    blank = _BLANK[raw]
    starts = np.flatnonzero(~blank & np.concatenate(([True], blank[:-1])))
    if not len(starts):
        return starts, np.zeros(0, np.uint64)
    place = np.arange(starts[0], len(raw)) - np.repeat(starts, np.diff(np.append(starts, len(raw))))
    most = int(place.max()) + 1
    factors = _PLACES if most <= len(_PLACES) else _factors(most, 1)
    values = _BYTES[raw[starts[0]:]] * factors[place]
    return starts, _mixed(np.add.reduceat(values, starts - starts[0]))


def shingle_sets(texts: list[str | None], size: int = WORDS) -> list[np.ndarray]:
    """Per text the sorted distinct 64-bit hashes of its word shingles (A-Z lower-cased)."""
    out: list[np.ndarray] = []
    held: list[bytes] = []
    total = 0
    for k, text in enumerate(texts):
        held.append((text or "").encode("utf-8"))
        total += len(held[-1]) + 1
        if total >= CHUNK or k + 1 == len(texts):
            out += _sets_of_chunk(held, size)
            held, total = [], 0
    return out


def _sets_of_chunk(texts: list[bytes], size: int) -> list[np.ndarray]:
    starts, words = _word_hashes(b"\n".join(texts))
    ends = np.cumsum([len(t) + 1 for t in texts])
    first = np.searchsorted(starts, np.concatenate(([0], ends)))  # first word of every text
    factors = _factors(size, 3)

    def windows(of: np.ndarray, width: int) -> np.ndarray:
        h = np.full(len(of) - width + 1, width, np.uint64)
        for j in range(width):
            h += of[j:j + len(h)] * factors[j]
        return _mixed(h)

    every = windows(words, size) if len(words) >= size else np.zeros(0, np.uint64)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= size:
            h = np.sort(every[a:b - size + 1])
            out.append(h[np.concatenate(([True], h[1:] != h[:-1]))])
        else:
            out.append(windows(words[a:b], b - a) if b > a else np.zeros(0, np.uint64))
    return out


def shingles(text: str | None, size: int = WORDS) -> np.ndarray:
    return shingle_sets([text], size)[0]


def required(a, b, percent: int):
    """Least overlap of linked sets of a and b shingles."""
    return -(-percent * (a + b) // (100 + percent))


def _digests(docs: DataFrame, doc_id: str, text: str, size: int) -> DataFrame:
    """(doc_id, text_key, n, digest) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = shingle_sets(batch.column(2).to_pylist(), size)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([len(s) for s in sets], pa.int32()),
                 pa.array([xxhash.xxh128_digest(s.tobytes()) for s in sets], pa.binary())],
                ["doc_id", "text_key", "n", "digest"])

    return in_arrow(_keyed(docs, doc_id, text), run, "doc_id long, text_key long, n int, digest binary")


def _keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.xxhash64(f"`{text}`").alias("text_key"),
                       F.col(f"`{text}`").alias("text"))


def _classes(marked: DataFrame) -> DataFrame:
    """(cls, digest, n, least, doc_id, text_key, repeated): a row per distinct non-empty set, with a row that has it."""
    rows = marked.where("n > 0").groupBy("digest", "n", "doc_id", "text_key").agg(F.count("*").alias("k"))
    one = rows.groupBy("digest", "n").agg(F.min("doc_id").alias("least"),
                                          F.min(F.struct("doc_id", "text_key", "k")).alias("of"))
    return one.select(F.monotonically_increasing_id().alias("cls"), "digest", "n", "least", "of.doc_id", "of.text_key",
                      (F.col("of.k") > 1).alias("repeated"))


def _class_texts(docs: DataFrame, classes: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(cls, text) of every class."""
    rows = _keyed(docs, doc_id, text).alias("d")

    def of(some: DataFrame) -> DataFrame:
        c = some.select("cls", F.col("doc_id").alias("c_id"), F.col("text_key").alias("c_key"))
        return rows.join(c, F.col("doc_id").eqNullSafe(F.col("c_id")) & (F.col("text_key") == F.col("c_key"))) \
            .select("cls", "text")

    return of(classes.where("not repeated")).union(of(classes.where("repeated")).dropDuplicates(["cls"]))


def _survey(texts: DataFrame, size: int) -> DataFrame:
    """(bin, a, b): for bin >= 0 hash a of class b's least shingles in that band, else b shingles in sketch cell a."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.zeros(CELLS, np.int64)
        edges = np.arange(BINS, dtype=np.uint64) << np.uint64(64 - BINS.bit_length() + 1)
        for batch in batches:
            ids, bands = batch.column(0).to_numpy(zero_copy_only=False), []
            for h in shingle_sets(batch.column(1).to_pylist(), size):
                np.add.at(cells, (h & np.uint64(CELLS - 1)).astype(np.int64), 1)
                least = np.append(h, np.uint64(0))[np.searchsorted(h, edges)]
                bands.append(_mixed(least[0::2] + np.uint64(3) * _mixed(least[1::2])))
            k = BINS // 2
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.tile(np.arange(k, dtype=np.int32), len(ids))),
                 pa.array((np.concatenate(bands) if bands else np.zeros(0, np.uint64)).view(np.int64)),
                 pa.array(np.repeat(ids, k))], ["bin", "a", "b"])
        at = np.flatnonzero(cells)
        for i in range(0, len(at), 1 << 16):
            part = at[i:i + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(part), -1, np.int32)), pa.array(part),
                                              pa.array(cells[part])], ["bin", "a", "b"])

    return in_arrow(texts, run, "bin int, a long, b long")


def _incidence(texts: DataFrame, cells: np.ndarray, size: int, percent: int) -> DataFrame:
    """(gram, cls, n, pos): the cells of the matrix that any link has to pass, pos counted in column order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            grams, ids, ns, places = [], [], [], []
            for c, h in zip(batch.column(0).to_pylist(), shingle_sets(batch.column(1).to_pylist(), size)):
                first = len(h) - -(-percent * len(h) // 100) + 1
                order = np.lexsort((h, cells[(h & np.uint64(CELLS - 1)).astype(np.int64)]))
                grams.append(h[order[:first]].view(np.int64))
                ids.append(np.full(first, c, np.int64))
                ns.append(np.full(first, len(h), np.int32))
                places.append(np.arange(first, dtype=np.int32))
            for i in range(0, len(grams), 256):
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x[i:i + 256])) for x in (grams, ids, ns, places)],
                                                 ["gram", "cls", "n", "pos"])

    return in_arrow(texts, run, "gram long, cls long, n int, pos int")


def _blocks(cells: DataFrame, tile: int) -> DataFrame:
    """(gram, ta, tb, t, cls, part, n, pos, before): every cell in all blocks of its column that need it.

    Columns whose classes are all of one part need no product.
    """
    size = cells.groupBy("gram").agg(F.count("*").alias("m"), F.min("part").alias("p"), F.max("part").alias("q"))
    wide = size.where("m > 1 and p <> q").select("gram", F.expr(f"cast(ceil(m / {tile}) as int)").alias("k"))
    t = F.expr("cast(pmod(xxhash64(cls), k) as int)")
    return (cells.join(wide, "gram").withColumn("t", t)
            .withColumn("other", F.explode(F.expr("sequence(0, k - 1)")))
            .select("gram", F.least("t", "other").alias("ta"), F.greatest("t", "other").alias("tb"),
                    "t", "cls", "part", "n", "pos", "before"))


def _products(blocks: DataFrame, percent: int) -> DataFrame:
    """(a, b, na, nb, pa, pb): a row for every product of two cells of a column that a link may need."""

    def formed(c: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
        rows = len(c["gram"])
        new = np.ones(rows + 1, bool)
        new[1:-1] = (c["gram"][1:] != c["gram"][:-1]) | (c["ta"][1:] != c["ta"][:-1]) | (c["tb"][1:] != c["tb"][:-1])
        starts = np.flatnonzero(new)
        later = np.repeat(starts[1:], np.diff(starts)) - np.arange(rows) - 1  # rows after this one in its block
        upto = np.cumsum(later)
        at = 0
        while at < rows:
            end = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + PAIRS, side="right")))
            count = later[at:end]
            i = np.repeat(np.arange(at, end), count)
            j = i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(count) - count, count)
            at = end
            keep = (c["part"][i] != c["part"][j]) & ((c["ta"][i] == c["tb"][i]) | (c["t"][i] != c["t"][j]))
            i, j = i[keep], j[keep]
            ni, nj = c["n"][i].astype(np.int64), c["n"][j].astype(np.int64)
            keep = 100 * np.minimum(ni, nj) >= percent * np.maximum(ni, nj)
            rest = np.minimum(ni - c["pos"][i], nj - c["pos"][j])
            # a column before a common one stands before it in both sets, and is common only if others have it
            keep &= rest + np.minimum(c["before"][i], c["before"][j]) >= required(ni, nj, percent)
            i, j = i[keep], j[keep]
            swap = c["cls"][i] > c["cls"][j]
            i, j = np.where(swap, j, i), np.where(swap, i, j)
            if len(i):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x) for x in (c["cls"][i], c["cls"][j], c["n"][i], c["n"][j], c["pos"][i], c["pos"][j])],
                    ["a", "b", "na", "nb", "pa", "pb"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) >= 1 << 15:
                c = _columns(held)
                last = (c["gram"] == c["gram"][-1]) & (c["ta"] == c["ta"][-1]) & (c["tb"] == c["tb"][-1])
                cut = int(np.argmax(last))  # the last block may go on in the next batch
                if cut:
                    yield from formed({k: v[:cut] for k, v in c.items()})
                held = [pa.RecordBatch.from_arrays([pa.array(v[cut:]) for v in c.values()], list(c))]
        if held and sum(b.num_rows for b in held):
            yield from formed(_columns(held))

    spread = blocks.repartition("gram", "ta", "tb").sortWithinPartitions("gram", "ta", "tb")
    return in_arrow(spread, run, "a long, b long, na int, nb int, pa int, pb int")


def _columns(batches: list[pa.RecordBatch]) -> dict[str, np.ndarray]:
    return {k: np.concatenate([b.column(i).to_numpy(zero_copy_only=False) for b in batches])
            for i, k in enumerate(batches[0].schema.names)}


def _true_links(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """(a, b) of those ``pairs`` whose whole sets are linked."""
    both = (pairs.select("a", "b").join(texts.select(F.col("cls").alias("a"), F.col("text").alias("ta")), "a")
            .join(texts.select(F.col("cls").alias("b"), F.col("text").alias("tb")), "b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            sets = (shingle_sets(batch.column(i).to_pylist(), size) for i in (2, 3))
            for x, y in zip(*sets):
                both = np.sort(np.concatenate([x, y]))
                common = int((both[1:] == both[:-1]).sum())
                keep.append(common >= required(len(x), len(y), percent))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return in_arrow(both.select("a", "b", "ta", "tb"), run, "a long, b long")


def _sketch(survey: DataFrame) -> np.ndarray:
    cells = np.zeros(CELLS, np.int64)
    for r in survey.where("bin < 0").groupBy("a").agg(F.sum("b").alias("n")).toLocalIterator():  # CELLS numbers at most
        cells[r["a"]] = r["n"]
    return cells


def _met(texts: DataFrame, survey: DataFrame, size: int, percent: int) -> DataFrame:
    """The cells of the matrix in columns that several classes have; ``before`` counts those of the class before it."""
    matrix = written(_incidence(texts, _sketch(survey), size, percent), "incidence")
    shared = matrix.groupBy("gram").agg(F.count("*").alias("m")).where("m > 1").select("gram")
    order = Window.partitionBy("cls").orderBy("pos")  # at most the columns of one text
    return written(matrix.join(shared, "gram").withColumn("before", F.row_number().over(order) - 1), "shared-columns")


def _central_links(texts: DataFrame, classes: DataFrame, survey: DataFrame, met: DataFrame, size: int,
                   percent: int) -> DataFrame:
    """(a, b): links of classes to the class of their band that has the fewest columns of its own."""
    shared = met.groupBy("cls").agg(F.count("*").alias("shared"))
    own = classes.select("cls", "n").join(shared, "cls").select(
        "cls", "n", (F.expr(f"n - cast(ceil({percent} * n / 100) as int) + 1") - F.col("shared")).alias("own"))
    bands = written(survey.where("bin >= 0").select("bin", F.col("a").alias("h"), F.col("b").alias("cls"))
                    .join(own, "cls"), "bands")
    heads = bands.groupBy("bin", "h").agg(F.min(F.struct("own", "cls", "n")).alias("head"), F.count("*").alias("m"))
    pairs = bands.join(heads.where("m > 1").select("bin", "h", "head"), ["bin", "h"]).where("cls <> head.cls")
    sizes = f"100 * least(n, head.n) >= {percent} * greatest(n, head.n)"
    likely = pairs.where(sizes).select(F.least("cls", "head.cls").alias("a"), F.greatest("cls", "head.cls").alias("b"))
    return _true_links(written(likely.distinct(), "heads"), texts, size, percent)


def _cross_links(texts: DataFrame, met: DataFrame, parts: DataFrame | None, size: int, percent: int,
                 tile: int) -> DataFrame:
    """(a, b): all links between classes of different parts; without ``parts`` every class is a part of its own."""
    if parts is None:
        cells = met.withColumn("part", F.col("cls"))
    else:
        cells = met.join(parts.select(F.col("node").alias("cls"), "root"), "cls", "left") \
            .withColumn("part", F.coalesce("root", "cls")).drop("root")
    sums = _products(_blocks(cells, tile), percent).groupBy("a", "b").agg(
        F.count("*").alias("common"), F.max("na").alias("na"), F.max("nb").alias("nb"),
        F.max("pa").alias("pa"), F.max("pb").alias("pb"))
    rest = F.least(F.col("na") - F.col("pa"), F.col("nb") - F.col("pb")) - 1
    need = F.expr(f"cast(ceil({percent} * (na + nb) / {100 + percent}) as int)")
    likely = written(sums.where(F.col("common") + rest >= need).select("a", "b"), "candidates")
    return _true_links(likely, texts, size, percent)


def _prepared(docs: DataFrame, doc_id: str, text: str, size: int) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    marked = written(_digests(docs, doc_id, text, size), "digests")
    classes = written(_classes(marked), "classes")
    texts = written(_class_texts(docs, classes, doc_id, text), "class-texts")
    return marked, classes, texts, written(_survey(texts, size), "survey")


def links(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = WORDS, percent: int = PERCENT,
          tile: int = TILE) -> tuple[DataFrame, DataFrame]:
    """Every link: (a, b) between classes, and the membership (doc_id, text_key, n, cls; null for an empty set)."""
    marked, classes, texts, survey = _prepared(docs, doc_id, text, size)
    found = _cross_links(texts, _met(texts, survey, size, percent), None, size, percent, tile)
    return found, marked.join(classes.select("digest", "n", "cls"), ["digest", "n"], "left") \
        .select("doc_id", "text_key", "n", "cls")


def groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = WORDS, percent: int = PERCENT,
           tile: int = TILE) -> DataFrame:
    """(doc_id, text_key, n, class_id, component_id) of every row.

    class_id is the smallest id with the same set, component_id the smallest
    one that links lead to; both are the row's own id for an empty set.
    """
    marked, classes, texts, survey = _prepared(docs, doc_id, text, size)
    met = _met(texts, survey, size, percent)
    near = written(_central_links(texts, classes, survey, met, size, percent), "near")
    parts = written(connected_components(near), "parts")
    across = _cross_links(texts, met, parts, size, percent, tile)
    trees = parts.select(F.col("node").alias("a"), F.col("root").alias("b"))
    roots = connected_components(trees.union(across))
    least = classes.select(F.col("cls").alias("node"), "least")
    of_root = roots.join(least, "node").groupBy("root").agg(F.min("least").alias("component_id"))
    named = roots.join(of_root, "root").select(F.col("node").alias("cls"), "component_id")
    known = classes.join(named, "cls", "left").select(
        "digest", "n", F.col("least").alias("class_id"), F.coalesce("component_id", "least").alias("component_id"))
    empty = F.col("n") == 0
    return marked.join(known, ["digest", "n"], "left").select(
        "doc_id", "text_key", "n", F.when(empty, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.when(empty, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))
