"""Phrase collocation mining: pairs of frequency-ranked ids, counted in direct-address tiles.

Frequent words get ids by falling frequency.  A phrase of two words is a pair
of ids; the plane of all pairs is cut into square tiles.  A task counts the
pairs of its texts tile by tile: in tiles that hold many of them by numpy's
bincount on a dense table of counters (a pair's place in the tile is its
address), in the others by sorted coordinates.  Low ranks meet often, so a few
dense tiles near the origin take most of the text.  Spark adds up the tasks'
counts.  Pairs that are frequent enough are ranked anew, and a phrase of three
words is the pair of the ids of its first two and its last two words; so the
step is repeated up to the longest phrase.  A phrase can only be frequent if
both its parts are, so positions without a frequent part drop out.

A rank table is sent to every task, so its size is bounded by ``max_ranked``
entries whatever the input.  If more words or phrases are frequent, the rest
keep 64-bit hashes for ids, and so does every rarer one (no table says which
they are): their pairs lie in no tile, are counted by coordinates, and the
final counts tell which are frequent.  Results are the same; more pairs travel.

All counts are per language; a text's language is part of a word's identity,
so different languages never share an id.  Words are told apart exactly when
they are counted and by 64-bit hashes when texts are turned into ids.

Defined results: a null text is empty, a null language ``und`` (one with the
language of that name).  Repeated rows count as often as they stand, ids are
not read.  A language without candidates has no rows.  Ties of score, count
and phrase can't occur, since a phrase stands once per language.  A score
above 64 bits is impossible (it is at most 1000 n).
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import in_arrow, written

MIN_COUNT, MAX_WORDS, TOP = 100, 5, 2000
#: Entries of a rank table: 16 MB in the driver and in every task at most.
MAX_RANKED = 1 << 20
#: Side of a tile; a dense one has this squared counters of 8 bytes.
SIDE = 512
#: Dense tiles held at once (2 MB each), and pairs in one batch of ids that make a tile dense.
DENSE_TILES, DENSE_FROM = 24, 2048
#: Coordinates held before they are given to Spark.
HELD = 1 << 18
#: Distinct words counted or remembered at once in a task.
HELD_WORDS = 120_000

_TABLE = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ.,;:!?\x0a\x0b\x0c\x0d\x09", b"abcdefghijklmnopqrstuvwxyz" + b"\n" * 10 + b" ")
_HASHED = np.int64(1) << np.int64(62)


def tokens(text: str | None) -> list[bytes]:
    """Words of a text (A-Z lower-cased), with a line feed as a token between pieces."""
    parts = (text or "").encode("utf-8").translate(_TABLE).replace(b"\n", b" \n ").split(b" ")
    return [w for w in parts if w]


def _texts(docs: DataFrame, text: str, lang: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit("und")).alias("lang"),
                       F.col(f"`{text}`").alias("text"))


def word_counts(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, word, n): all occurrences of every word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, Counter] = {}
        for batch in batches:
            for code, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                seen.setdefault(code, Counter()).update(tokens(t))
                if sum(map(len, seen.values())) > HELD_WORDS:  # Spark adds up the parts
                    yield from given(seen)
                    seen = {}
        yield from given(seen)

    def given(seen: dict[str, Counter]) -> Iterator[pa.RecordBatch]:
        for code, words in seen.items():
            words.pop(b"\n", None)
            keys = list(words)
            for at in range(0, len(keys), 1 << 14):
                part = keys[at:at + (1 << 14)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([code] * len(part)), pa.array([w.decode("utf-8") for w in part]),
                     pa.array([words[w] for w in part], pa.int64())], ["lang", "word", "n"])

    parts = in_arrow(_texts(docs, text, lang), run, "lang string, word string, n long")
    return parts.groupBy("lang", "word").agg(F.sum("n").alias("n"))


def word_key(lang: str, word: bytes) -> int:
    """Non-negative 62-bit hash of a word of a language."""
    return xxhash.xxh64_intdigest(word, xxhash.xxh32_intdigest(lang)) >> 2


def _pair_keys(i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Non-negative 62-bit hashes of pairs of ids."""
    h = i.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + j.astype(np.uint64)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        h = (h ^ (h >> np.uint64(shift))) * np.uint64(factor)
    return ((h ^ (h >> np.uint64(31))) >> np.uint64(2)).astype(np.int64)


@dataclass
class Ranks:
    """Ids of the frequent words or pairs: ranks by falling count; hashes beyond ``max_ranked`` of them."""

    keys: np.ndarray  # sorted
    ids: np.ndarray  # rank of each key
    closed: bool  # every frequent one has a rank

    def of(self, keys: np.ndarray) -> np.ndarray:
        """Id of each key: its rank, or -1 if it is known to be rare, or the key itself, marked as a hash."""
        other = np.full(len(keys), -1, np.int64) if self.closed else keys | _HASHED
        if not len(self.keys):
            return other
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.ids[at], other)


def _ranked(found: DataFrame, max_ranked: int) -> tuple[Ranks, DataFrame]:
    """Rank table of (key, n, ...) and ``found`` with the column ``id``."""
    found = written(found, "frequent")  # counted once; read for the ranks and for the ids
    top = found.orderBy(F.desc("n"), "key").limit(max_ranked + 1).select("key").toArrow()["key"].to_numpy()
    closed = len(top) <= max_ranked
    top = top[:max_ranked].astype(np.int64)
    order = np.argsort(top)
    ranks = Ranks(top[order], order.astype(np.int64), closed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = pa.array(ranks.of(batch.column("key").to_numpy(zero_copy_only=False).astype(np.int64)))
            yield pa.RecordBatch.from_arrays([*batch.columns, ids], [*batch.schema.names, "id"])

    schema = ", ".join(f"{c} {t}" for c, t in found.dtypes) + ", id long"
    return ranks, written(in_arrow(found, run, schema), "ranked")


def _encoded(docs: DataFrame, ranks: Ranks, text: str, lang: str) -> DataFrame:
    """(ids): per text the ids of its words, -1 for rare words and between pieces, as 64-bit integers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, dict[bytes, int]] = {}
        for batch in batches:
            out = []
            for code, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = tokens(t)
                memo = known.setdefault(code, {b"\n": -1})
                new = list(set(words).difference(memo))
                keys = np.fromiter((word_key(code, w) for w in new), np.int64, len(new))
                memo.update(zip(new, ranks.of(keys).tolist()))
                out.append(np.fromiter(map(memo.__getitem__, words), np.int64, len(words)).tobytes())
                if sum(map(len, known.values())) > HELD_WORDS:
                    known = {}
                else:
                    for w in new:
                        if len(w) > 40:
                            del memo[w]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["ids"])

    return in_arrow(_texts(docs, text, lang), run, "ids binary")


class Tiles:
    """Counts of pairs of ids: dense tables for crowded tiles, sorted coordinates for the rest."""

    def __init__(self) -> None:
        self.dense: dict[int, np.ndarray] = {}
        self.coordinates: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.held = 0

    def add(self, i: np.ndarray, j: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Count pairs; gives (i, j, n) when the coordinates get many."""
        ranked = (i < _HASHED) & (j < _HASHED)
        if not ranked.all():
            self._keep(*_merged(i[~ranked], j[~ranked], np.ones(int((~ranked).sum()), np.int64)))
            i, j = i[ranked], j[ranked]
        tile = ((i // SIDE) << 31) | (j // SIDE)
        order = np.argsort(tile, kind="stable")
        i, j, tile = i[order], j[order], tile[order]
        starts = np.flatnonzero(np.concatenate(([True], tile[1:] != tile[:-1]))) if len(tile) else np.zeros(0, np.int64)
        ends = np.append(starts[1:], len(tile))
        sparse = np.ones(len(tile), bool)
        for a, b in zip(starts.tolist(), ends.tolist()):
            t = int(tile[a])
            if t in self.dense or (b - a >= DENSE_FROM and len(self.dense) < DENSE_TILES):
                counts = np.bincount((i[a:b] % SIDE) * SIDE + j[a:b] % SIDE, minlength=SIDE * SIDE)
                self.dense[t] = self.dense[t] + counts if t in self.dense else counts
                sparse[a:b] = False
        if sparse.any():
            i, j = i[sparse], j[sparse]
            key, n = np.unique((i << 31) | j, return_counts=True)
            self._keep(key >> 31, key & ((1 << 31) - 1), n)
        if self.held > HELD:
            i, j, n = (np.concatenate(c) for c in zip(*self.coordinates))
            self.coordinates, self.held = [], 0
            merged = _merged(i, j, n)
            if 2 * len(merged[0]) < HELD:
                self._keep(*merged)
            else:
                yield merged

    def _keep(self, i: np.ndarray, j: np.ndarray, n: np.ndarray) -> None:
        self.coordinates.append((i, j, n))
        self.held += len(i)

    def rest(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        for t, counts in self.dense.items():
            at = np.flatnonzero(counts)
            yield (t >> 31) * SIDE + at // SIDE, (t & ((1 << 31) - 1)) * SIDE + at % SIDE, counts[at]
        if self.coordinates:
            yield _merged(*(np.concatenate(c) for c in zip(*self.coordinates)))


def _merged(i: np.ndarray, j: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted coordinates with the counts of equal ones added up."""
    order = np.lexsort((j, i))
    i, j, n = i[order], j[order], n[order]
    if not len(i):
        return i, j, n
    first = np.flatnonzero(np.concatenate(([True], (i[1:] != i[:-1]) | (j[1:] != j[:-1]))))
    return i[first], j[first], np.add.reduceat(n, first)


def _pairs(ids: np.ndarray, tables: list[Ranks]) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of ids of neighbouring phrases, one word apart, after one step per table."""
    for ranks in tables:
        left, right = ids[:-1], ids[1:]
        both = (left >= 0) & (right >= 0)
        ids = np.full(max(len(ids) - 1, 0), -1, np.int64)
        ids[both] = ranks.of(_pair_keys(left[both], right[both]))
    left, right = ids[:-1], ids[1:]
    both = (left >= 0) & (right >= 0)
    return left[both], right[both]


def _pair_counts(encoded: DataFrame, ranks: Ranks, tables: list[Ranks], min_count: int) -> DataFrame:
    """(i, j, n): the frequent pairs of ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tiles = Tiles()
        for batch in batches:
            mark = np.full(1, -1, np.int64).tobytes()
            ids = np.frombuffer(mark.join(batch.column(0).to_pylist()), np.int64)  # texts don't touch
            for at in range(0, len(ids), 1 << 17):  # a chunk reaches into the next by the words of its last phrase
                for found in tiles.add(*_pairs(ids[at:at + (1 << 17) + len(tables) + 1], tables)):
                    yield from given(*found)
        for found in tiles.rest():
            yield from given(*found)

    def given(i: np.ndarray, j: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
        packed = i << 31 | j
        if all(t.closed for t in (ranks, *tables)):
            columns = {"at": packed, "n": n}
        else:  # a hashed id fills a column of its own
            wide = (i >= _HASHED) | (j >= _HASHED)
            columns = {"at": np.where(wide, -1, packed), "i": np.where(wide, i, 0), "j": np.where(wide, j, 0), "n": n}
        for at in range(0, len(i), 1 << 16):
            yield pa.RecordBatch.from_arrays([pa.array(c[at:at + (1 << 16)].astype(np.int64)) for c in columns.values()],
                                             list(columns))

    place = ["at"] if all(t.closed for t in (ranks, *tables)) else ["at", "i", "j"]
    # several files to a task: the more text it counts, the fewer rows it sends for each word of it
    files = encoded.rdd.getNumPartitions()
    fewer = encoded.coalesce(max(files // 4, min(files, encoded.sparkSession.sparkContext.defaultParallelism)))
    parts = in_arrow(fewer, run, ", ".join(f"{c} long" for c in [*place, "n"]))
    counts = parts.groupBy(*place).agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)
    i, j = F.shiftright("at", 31), F.col("at").bitwiseAND((1 << 31) - 1)
    if len(place) > 1:
        i, j = F.when(F.col("at") >= 0, i).otherwise(F.col("i")), F.when(F.col("at") >= 0, j).otherwise(F.col("j"))
    return counts.select(i.alias("i"), j.alias("j"), "n")


def phrases(docs: DataFrame, text: str = "text", lang: str = "lang", min_count: int = MIN_COUNT,
            max_words: int = MAX_WORDS, max_ranked: int = MAX_RANKED) -> tuple[DataFrame, DataFrame]:
    """(lang, words, phrase, n) of all phrases of 1 to ``max_words`` words that occur ``min_count`` times,
    and (lang, total) with each language's word occurrences."""
    counted = written(word_counts(docs, text, lang), "words")
    totals = counted.groupBy("lang").agg(F.sum("n").alias("total"))

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [word_key(c, w.encode("utf-8")) for c, w in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(keys, pa.int64())], ["lang", "word", "n", "key"])

    words = in_arrow(counted.where(F.col("n") >= min_count), keyed, "lang string, word string, n long, key long")
    word_ranks, level = _ranked(words.select("key", "n", "lang", F.col("word").alias("phrase"), F.col("word").alias("last")),
                           max_ranked)
    encoded = written(_encoded(docs, word_ranks, text, lang), "ids")
    out, tables = [level.select("lang", F.lit(1).alias("words"), "phrase", "n")], []
    for length in range(2, max_words + 1):
        pairs = _pair_counts(encoded, word_ranks, tables, min_count)
        left = level.select(F.col("id").alias("i"), "lang", F.col("phrase").alias("head"))
        right = level.select(F.col("id").alias("j"), "last")
        found = pairs.join(left, "i").join(right, "j").select(
            "i", "j", "n", "lang", F.concat_ws(" ", "head", "last").alias("phrase"), "last")
        ranks, level = _ranked(_with_pair_keys(found), max_ranked)
        tables.append(ranks)
        out.append(level.select("lang", F.lit(length).alias("words"), "phrase", "n"))
    every = out[0]
    for part in out[1:]:
        every = every.unionByName(part)
    return every, totals


def _with_pair_keys(found: DataFrame) -> DataFrame:
    """(key, n, lang, phrase, last) of (i, j, n, lang, phrase, last)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            i, j = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
            yield pa.RecordBatch.from_arrays([pa.array(_pair_keys(i, j)), *batch.columns[2:]],
                                             ["key", "n", "lang", "phrase", "last"])

    return in_arrow(found, run, "key long, n long, lang string, phrase string, last string")


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", min_count: int = MIN_COUNT,
                 max_words: int = MAX_WORDS, max_ranked: int = MAX_RANKED) -> DataFrame:
    """(lang, words, phrase, a, l, r, n, score): candidates that no longer one with the same count contains."""
    every, totals = phrases(docs, text, lang, min_count, max_words, max_ranked)
    every = written(every, "phrases")
    longer = every.where("words > 1").select("lang", "words", "phrase", F.col("n").alias("a"))
    split = longer.withColumn("w", F.split("phrase", " "))
    cuts = split.withColumn("k", F.explode(F.expr("sequence(1, words - 1)"))).select(
        "lang", "words", "phrase", "a", "k", F.expr("array_join(slice(w, 1, k), ' ')").alias("head"),
        F.expr("array_join(slice(w, k + 1, words - k), ' ')").alias("tail"))
    part = lambda name, n: every.select("lang", F.col("phrase").alias(name), F.col("n").alias(n))
    # products may pass 64 bits, not 38 digits; div is exact
    score = F.expr("cast(1000 * cast(a as decimal(38,0)) * n as decimal(38,0)) div cast(cast(l as decimal(38,0)) * r as decimal(38,0))")
    scored = (cuts.join(part("head", "l"), ["lang", "head"]).join(part("tail", "r"), ["lang", "tail"])
              .join(totals.select("lang", F.col("total").alias("n")), "lang").withColumn("score", score))
    lowest = scored.groupBy("lang", "words", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    inner = split.where("words > 2").select("lang", "a", F.explode(F.expr(
        "flatten(transform(sequence(2, words - 1), m -> transform(sequence(1, words - m + 1),"
        " s -> array_join(slice(w, s, m), ' '))))")).alias("phrase"))
    covered = inner.groupBy("lang", "phrase").agg(F.max("a").alias("covered"))
    return (lowest.join(covered, ["lang", "phrase"], "left").where("covered is null or 100 * covered < 100 * a")
            .select("lang", "words", "phrase", "a", "cut.l", "cut.r", "n", "cut.score"))


def top(found: DataFrame, limit: int = TOP, salts: int = 64) -> DataFrame:
    """Each language's first ``limit`` by score and a, falling, then phrase; in two steps, so no task sorts a language."""
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salted = found.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(salts)))
    few = salted.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))) \
        .where(F.col("rank") <= limit).drop("rank", "salt")
    ranked = few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    return ranked.where(F.col("rank") <= limit).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
