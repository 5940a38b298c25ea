"""Benchmark decontamination with item-sized windows.

For a benchmark item of w words, every w-word window of a document is a
possible leak; a document of fewer than w words is one window, the whole text.
Window and item are compared by their five-word shingles (an item under five
words is one shingle).  The steps:

1.  Words become numbers of the benchmark's vocabulary, and shingles numbers
    of its shingle list.  A window that shares no shingle with an item of its
    size has similarity zero, so only windows around shared shingles go on;
    documents that share none, nearly all, end here.
2.  Each of these windows gets a SimHash (running sums of the bits of its
    shingles' hashes).
3.  A multi-index finds the items near it: of ``BLOCKS`` blocks of a
    fingerprint, one differs in at most ``RADIUS // BLOCKS`` bits if the whole
    differs in at most ``RADIUS``.  The index holds each item under all block
    values within that reach, so a window needs one lookup per block and no
    fingerprint within the radius is missed.
4.  The candidates are verified by their exact weighted similarity: the sum of
    the smaller over the sum of the larger count of each shingle, at least
    ``threshold``.

``RADIUS`` is set so that a similarity of 0.8 lies well inside: 64 random
signs differ there in 9.7 places on average, 2.9 of standard deviation.  That
holds for shingles that differ.  An item with few different shingles (two words
in turn) differs in 16 places on average, so items that repeat a shingle have
the radius ``WIDE_RADIUS``; blocks are no help that far, and the fingerprints of
those of one length are compared one by one.

The benchmark is the stated query set.  It is taken in blocks of at most
``BLOCK_ITEMS`` items, whose words go to the tasks; documents are read once
for each block and never shuffled.

Words are maximal runs without ASCII white space, A-Z in lower case.

Defined results: a null or empty text has no windows; a text shorter than an
item's shingles has none in common with it; items that are null, empty or
without words match nothing; repeated items count once; repeated
documents are judged alike; empty tables give empty results.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import in_arrow

SHINGLE, THRESHOLD = 5, 0.8
RADIUS, BLOCKS = 19, 4
WIDE_RADIUS = 34
BLOCK_ITEMS = 5000
_WIDTH = 64 // BLOCKS
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8").lower().split()


def _sizes(words: int) -> tuple[int, int]:
    """Shingle length and number of shingles of an item."""
    k = min(SHINGLE, words)
    return k, words - k + 1


def _rolled(codes: np.ndarray, k: int) -> np.ndarray:
    """A number for each k-word shingle."""
    n = len(codes) - k + 1
    out = np.zeros(max(n, 0), np.uint64)
    for i in range(k if n > 0 else 0):
        out = (out ^ codes[i:i + n].astype(np.uint64)) * _FACTOR
        out ^= out >> np.uint64(29)
    return out


def _bits(hashes: np.ndarray) -> np.ndarray:
    """+1 or -1 for every bit."""
    rows = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return rows.astype(np.int32) * 2 - 1


def _packed(sums: np.ndarray) -> np.ndarray:
    return np.packbits(sums > 0, axis=1, bitorder="little").view(np.uint64).ravel()


class Index:
    """The items of one block: vocabulary, shingles, and the multi-index of their fingerprints."""

    def __init__(self, items: tuple[tuple[int, str], ...]):
        found = [(i, w) for i, t in items if (w := words_of(t))]
        self.ids = [i for i, _ in found]
        self.length = np.array([len(w) for _, w in found], np.int64)
        self.vocabulary: dict[bytes, int] = {}
        for _, w in found:
            for x in w:
                self.vocabulary.setdefault(x, len(self.vocabulary) + 1)
        shingles: dict[tuple[bytes, ...], int] = {}
        self.bags, owners, rolled = [], [], []
        for at, (_, w) in enumerate(found):
            k, n = _sizes(len(w))
            bag = Counter(shingles.setdefault(tuple(w[i:i + k]), len(shingles)) for i in range(n))
            self.bags.append(bag)
            codes = np.array([self.vocabulary[x] for x in w], np.int64)
            rolled.append((k, _rolled(codes, k), [shingles[tuple(w[i:i + k])] for i in range(n)]))
            owners += [(s, at) for s in bag]
        self.shingles = list(shingles)
        self.hash_of = np.array([xxhash.xxh64_intdigest(b" ".join(s), 42) for s in self.shingles], np.uint64)
        #: by shingle length: sorted rolled values and the shingle of each (equal values are told apart by words)
        self.lookup = {}
        for k in {k for k, _, _ in rolled}:
            pairs = sorted({(int(v), s) for kk, values, ss in rolled if kk == k for v, s in zip(values, ss)})
            self.lookup[k] = (np.array([v for v, _ in pairs], np.uint64), [s for _, s in pairs])
        #: shingle -> window lengths of the items that hold it
        self.windows_of: dict[int, set[int]] = {}
        for s, at in owners:
            self.windows_of.setdefault(s, set()).add(int(self.length[at]))
        self._multi_index()

    def _multi_index(self) -> None:
        sums = [_bits(self.hash_of[list(bag.elements())]).sum(axis=0) for bag in self.bags]
        self.fingerprint = _packed(np.array(sums, np.int32).reshape(-1, 64)) if sums else np.zeros(0, np.uint64)
        masks = np.array([sum(1 << i for i in c) for n in range(RADIUS // BLOCKS + 1)
                          for c in combinations(range(_WIDTH), n)], np.int64)
        keys = [self._block_keys(self.fingerprint, self.length, b)[:, None] ^ masks for b in range(BLOCKS)]
        keys = np.concatenate(keys, axis=1) if keys else np.zeros((0, 0), np.int64)
        item = np.repeat(np.arange(len(self.ids)), keys.shape[1])
        order = np.argsort(keys.ravel(), kind="stable")
        self.keys, self.items = keys.ravel()[order], item[order]
        #: window length -> items that repeat a shingle
        self.repeating: dict[int, np.ndarray] = {}
        again = [at for at, bag in enumerate(self.bags) if max(bag.values()) > 1]
        for n in {int(self.length[at]) for at in again}:
            self.repeating[n] = np.array([at for at in again if self.length[at] == n], np.int64)

    @staticmethod
    def _block_keys(fingerprints: np.ndarray, length: np.ndarray, block: int) -> np.ndarray:
        """Window length, block and the block's value in one number; the value is lowest."""
        value = (fingerprints >> np.uint64(block * _WIDTH)) & np.uint64((1 << _WIDTH) - 1)
        return ((length * BLOCKS + block) << _WIDTH) | value.astype(np.int64)

    def near(self, fingerprints: np.ndarray, length: int) -> set[tuple[int, int]]:
        """(row, item) of all items of that length within the radius."""
        out: set[tuple[int, int]] = set()
        lengths = np.full(len(fingerprints), length, np.int64)
        for b in range(BLOCKS):
            keys = self._block_keys(fingerprints, lengths, b)
            low, high = np.searchsorted(self.keys, keys), np.searchsorted(self.keys, keys, side="right")
            count = high - low
            row = np.repeat(np.arange(len(keys)), count)
            at = low[row] + np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
            item = self.items[at]
            bits = np.bitwise_count(fingerprints[row] ^ self.fingerprint[item])
            out.update(zip(row[bits <= RADIUS].tolist(), item[bits <= RADIUS].tolist()))
        for item in self.repeating.get(length, np.zeros(0, np.int64)).tolist():
            bits = np.bitwise_count(fingerprints ^ self.fingerprint[item])
            out.update((row, item) for row in np.flatnonzero(bits <= WIDE_RADIUS).tolist())
        return out

    def _shared(self, words: list[bytes], codes: np.ndarray, k: int) -> np.ndarray:
        """For every k-word shingle of the document its number in the list, or -1."""
        values, numbers = self.lookup[k]
        out = np.full(max(len(words) - k + 1, 0), -1, np.int64)
        known = codes > 0
        inside = np.flatnonzero(np.lib.stride_tricks.sliding_window_view(known, k).all(axis=1)) if len(out) else []
        if not len(inside):
            return out
        rolled = _rolled(codes, k)[inside]
        low = np.searchsorted(values, rolled)
        hit = values[np.minimum(low, len(values) - 1)] == rolled
        for p, i, v in zip(inside[hit].tolist(), low[hit].tolist(), rolled[hit]):
            here = tuple(words[p:p + k])
            while i < len(values) and values[i] == v:
                if self.shingles[numbers[i]] == here:
                    out[p] = numbers[i]
                i += 1
        return out

    def matches(self, text: str | None, threshold: float) -> dict[int, tuple[float, int]]:
        """item -> (highest similarity of a window, first word of the first such window)."""
        words = words_of(text)
        if not words or not self.ids:
            return {}
        codes = np.fromiter(map(self.vocabulary.get, words, repeat(0)), np.int64, len(words))
        best: dict[int, tuple[float, int]] = {}
        for k in self.lookup:
            shared = self._shared(words, codes, k)
            places = np.flatnonzero(shared >= 0)
            by_length: dict[int, list[int]] = {}
            for p in places.tolist():
                for length in self.windows_of[int(shared[p])]:
                    if _sizes(length)[0] == k:
                        by_length.setdefault(length, []).append(p)
            for length, hits in by_length.items():
                self._windows(words, shared, k, length, hits, threshold, best)
        return {self.ids[i]: v for i, v in best.items()}

    def _windows(self, words, shared, k, length, hits, threshold, best) -> None:
        """Compare the windows of one length that hold a shared shingle with the items of that length.

        A text shorter than the items is its own only window.
        """
        of_item = _sizes(length)[1]
        n, last = min(of_item, len(shared)), max(len(words) - length, 0)
        if n / of_item < threshold:
            return  # too few shingles, if all were common
        starts = np.array(hits, np.int64)[:, None] - np.arange(n)
        starts = np.unique(starts[(starts >= 0) & (starts <= last)])
        for run in np.split(starts, np.flatnonzero(np.diff(starts) > n) + 1) if len(starts) else []:
            for at in range(0, len(run), 4096):
                part = run[at:at + 4096]
                low, high = int(part[0]), int(part[-1]) + n
                numbers = shared[low:high]
                hashes = self.hash_of[np.maximum(numbers, 0)]
                for i in np.flatnonzero(numbers < 0).tolist():
                    hashes[i] = xxhash.xxh64_intdigest(b" ".join(words[low + i:low + i + k]), 42)
                sums = np.concatenate((np.zeros((1, 64), np.int32), np.cumsum(_bits(hashes), axis=0)))
                begin = part - low
                for row, item in sorted(self.near(_packed(sums[begin + n] - sums[begin]), length)):
                    window = Counter(numbers[begin[row]:begin[row] + n].tolist())
                    common = sum(min(c, window[s]) for s, c in self.bags[item].items())
                    similarity = common / (n + of_item - common)
                    if similarity >= threshold and similarity > best.get(item, (0.0, 0))[0]:
                        best[item] = similarity, int(part[row])


@lru_cache(maxsize=4)
def _index(items: tuple[tuple[int, str], ...]) -> Index:
    return Index(items)


def _blocks(benchmark: DataFrame, item_id: str, text: str) -> list[tuple[tuple[int, str], ...]]:
    """The benchmark's items, in blocks of about ``BLOCK_ITEMS``."""
    items = benchmark.select(F.col(item_id).cast("long").alias("i"), F.col(text).alias("t")).where(
        "i is not null and t is not null").distinct()
    n = -(-items.count() // BLOCK_ITEMS)
    part = F.pmod(F.xxhash64("i", "t"), F.lit(max(n, 1)))
    return [tuple(sorted((r["i"], r["t"]) for r in items.where(part == b).collect())) for b in range(n)]


MATCHES = T.ArrayType(T.StructType([
    T.StructField("item_id", T.LongType()), T.StructField("similarity", T.DoubleType()),
    T.StructField("first_word", T.LongType())]))


def mark(docs: DataFrame, items: tuple[tuple[int, str], ...], text: str = "text",
         threshold: float = THRESHOLD, out: str = "matches") -> DataFrame:
    """``docs`` with the leaked items of one block in column ``out``."""
    if out.lower() in {c.lower() for c in docs.columns}:
        raise ValueError(f"the input already has a column {out}: pass another name")
    at = docs.columns.index(text)
    kind = pa.list_(pa.struct([("item_id", pa.int64()), ("similarity", pa.float64()), ("first_word", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = _index(items)
        for batch in batches:
            found = [[{"item_id": i, "similarity": s, "first_word": w}
                      for i, (s, w) in sorted(index.matches(t, threshold).items())]
                     for t in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, kind)], [*batch.schema.names, out])

    return in_arrow(docs, run, T.StructType([*docs.schema.fields, T.StructField(out, MATCHES)]))


def leaks(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text",
          item_id: str = "item_id", item_text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, item_id, similarity, first_word): the items found in each document row."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    found = None
    for items in _blocks(benchmark, item_id, item_text) or [()]:
        here = mark(rows, items, threshold=threshold).select("doc_id", F.inline("matches"))
        found = here if found is None else found.unionByName(here)
    return found


def without_leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id",
                  item_text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the rows in which an item was found."""
    for items in _blocks(benchmark, item_id, item_text):
        docs = mark(docs, items, text, threshold, "__matches").where(F.size("__matches") == 0).drop("__matches")
    return docs
