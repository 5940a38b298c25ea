"""Exact removal of long repeated byte strings, decided by suffix arrays.

A byte is removed if a ``length``-byte string that covers it also starts
anywhere else in the corpus, the same document included.  Matches never cross
documents and are judged on the input.

1.  Every window of ``length`` bytes names an anchor: the gram of ``GRAM``
    bytes in it with the least hash, the leftmost on ties.  Equal windows name
    the same gram at the same place, so only windows of anchors with equal
    grams can be equal.  The windows of one anchor adjoin; the bytes they span
    are its context.  There is about one anchor for 180 bytes.
2.  Contexts are counted by a 128-bit digest.  One that occurs twice is
    repeated as a whole; that settles copies of documents and the inside of
    shared passages, however many there are, by counting alone.
3.  What remains are single contexts whose gram has other contexts: edges of
    passages and edits of near copies.  The contexts of a gram are aligned at
    the anchor and cut wherever two of them part, to the left and to the right;
    each becomes a short string of pieces.  A suffix array over many such
    strings, with the longest common prefixes, gives for every piece the
    longest match of the text that starts there, and with it the windows that
    occur again.

The suffix array is built by linear grouping: suffixes are grouped by first
symbol; groups are processed in descending order; each sends, through the
pointers to the next smaller suffix before its members, the suffixes found
there into a group right behind their own, those with most pointers last.
Then all groups hold one Lyndon prefix each, and one pass in ascending order
fills the array.  Nothing is renamed and sorted again.

Grams with over ``CROWD`` contexts don't go to one task: their windows are
hashed and counted by Spark, with the same result.

Defined results: a null text has no bytes; texts under ``length`` bytes lose
nothing; rows that repeat lose all their windows, as these start elsewhere;
rows are told apart by id and text, so ids may be null or repeat.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import in_arrow, written

LENGTH, GRAM = 400, 32
CROWD = 20_000
BLOCK_PIECES = 200_000
_BASE = 0x5851F42D4C957F2D


# ---- suffix array ---------------------------------------------------------

def suffix_array(symbols: list[int]) -> list[int]:
    """Order of the suffixes; the last symbol must be the only one of the least value."""
    n = len(symbols)
    _, inverse, counts = np.unique(np.array(symbols), return_inverse=True, return_counts=True)
    firsts = np.cumsum(counts) - counts
    group = firsts[inverse].tolist()  # a group is named by its first slot
    members: dict[int, list[int]] = defaultdict(list)
    for i, g in enumerate(group):
        members[g].append(i)
    size = {g: len(m) for g, m in members.items()}
    first_of = [0] * n  # at a group's last slot: its first
    for g, z in size.items():
        first_of[g + z - 1] = g
    prev = [-1] * n
    end = n
    while end > 0:
        g = first_of[end - 1]
        end = g
        own = members.pop(g)
        if len(own) > 1:
            own = sorted(i for i in own if group[i] == g)
        pointed: dict[int, int] = {}
        for i in own:
            if group[i] != g:
                continue
            j = i - 1
            while j >= 0 and group[j] >= g:
                j = prev[j]
            prev[i] = j
            if j >= 0:
                pointed[j] = pointed.get(j, 0) + 1
        by_count: dict[int, dict[int, list[int]]] = {}
        for j, count in pointed.items():
            by_count.setdefault(count, {}).setdefault(group[j], []).append(j)
        for count in sorted(by_count, reverse=True):
            for h, moved in by_count[count].items():
                stay = size[h] - len(moved)
                if not stay:
                    continue  # the whole group moves behind itself
                s = h + stay
                size[h], size[s] = stay, len(moved)
                first_of[s + len(moved) - 1], first_of[s - 1] = s, h
                members[s] = moved
                for j in moved:
                    group[j] = s
    slot = list(range(n))
    order = [-1] * n
    order[0] = n - 1
    placed = bytearray(n)
    placed[n - 1] = 1
    for i in range(n):
        j = order[i] - 1
        while j >= 0 and not placed[j]:
            g = group[j]
            order[slot[g]] = j
            slot[g] += 1
            placed[j] = 1
            j = prev[j]
    return order


def common_prefixes(symbols: list[int], order: list[int]) -> list[int]:
    """Common prefix of each suffix in the order with the one before it."""
    n = len(symbols)
    rank = [0] * n
    for r, i in enumerate(order):
        rank[i] = r
    out, h = [0] * n, 0
    for i in range(n):
        r = rank[i]
        if not r:
            h = 0
            continue
        j = order[r - 1]
        while i + h < n and j + h < n and symbols[i + h] == symbols[j + h]:
            h += 1
        out[r] = h
        h = max(h - 1, 0)
    return out


# ---- contexts of one gram -------------------------------------------------

def _common(x: bytes, y: bytes) -> int:
    n = min(len(x), len(y))
    if x[:n] == y[:n]:
        return n
    return int((np.frombuffer(x, np.uint8, n) != np.frombuffer(y, np.uint8, n)).argmax())


def _cuts(strings: list[bytes]) -> list[list[int]]:
    """Per string the depths, up to its longest match with another, at which any two part."""
    times = Counter(strings)
    ordered = sorted(times)
    parts = [_common(x, y) for x, y in zip(ordered, ordered[1:])]
    reach = {s: max(p, q, len(s) if times[s] > 1 else 0) for s, p, q in zip(ordered, [0, *parts], [*parts, 0])}
    depths = sorted({*parts, *(len(s) for s in ordered if times[s] > 1)} - {0})
    return [[d for d in depths if d <= reach[s]] for s in strings]


class Block:
    """Strings of pieces of many grams, and the windows that a suffix array finds repeated in them."""

    def __init__(self, length: int):
        self.length = length
        self.names: dict[tuple, int] = {}
        self.strings: list[tuple[list[int], list[int], list[int], object]] = []
        self.pieces = 0

    def add(self, gram: int, contexts: list[tuple[bytes, int, int, object]]) -> None:
        """``contexts``: (bytes, first distance, last distance of the anchor from a window, tag); tag None: no question."""
        left = [c[:far][::-1] for c, far, _, _ in contexts]
        right = [c[far:] for c, far, _, _ in contexts]
        for l, r, lc, rc, (_, far, near, tag) in zip(left, right, _cuts(left), _cuts(right), contexts):
            if not rc or (lc[-1] if lc else 0) + rc[-1] < self.length:
                continue  # too short to match at all
            name = lambda side, s, cuts: [
                self.names.setdefault((gram, side, a, s[a:b]), len(self.names)) for a, b in zip([0, *cuts], cuts)]
            string = name(0, l, lc)[::-1] + name(1, r, rc)
            self.strings.append((string, lc, rc, None if tag is None else (far, near, tag)))
            self.pieces += len(string) + 1

    def repeats(self) -> Iterator[tuple[object, int, int]]:
        """(tag, least, greatest distance) of windows that occur again."""
        n = len(self.strings)
        if n < 2:
            return
        symbols: list[int] = []
        begin = []
        for k, (string, *_) in enumerate(self.strings):
            begin.append(len(symbols))
            symbols += [x + n + 1 for x in string]
            symbols.append(k + 1)  # each end is a symbol of its own
        symbols.append(0)
        order = suffix_array(symbols)
        lcp = common_prefixes(symbols, order)
        longest = [0] * len(symbols)
        for r, i in enumerate(order):
            longest[i] = max(lcp[r], lcp[r + 1] if r + 1 < len(lcp) else 0)
        for at, (_, lc, rc, asked) in zip(begin, self.strings):
            if asked is None:
                continue
            far, near, tag = asked
            for t in range(len(lc) + 1):
                matched = longest[at + len(lc) - t] - t  # pieces right of the anchor
                if matched < 1:
                    continue
                least = max(self.length - rc[matched - 1], near, lc[t - 2] + 1 if t > 1 else min(t, 1))
                most = min(lc[t - 1] if t else 0, far)
                if least <= most:
                    yield tag, least, most


# ---- anchors --------------------------------------------------------------

_POWERS = np.ones(1, np.uint64), np.ones(1, np.uint64)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64."""
    global _POWERS
    if len(_POWERS[0]) < n:
        size = 1 << (n - 1).bit_length()
        inverse = pow(_BASE, -1, 1 << 64)
        _POWERS = tuple(np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(size - 1, b, np.uint64))),
                                   dtype=np.uint64) for b in (_BASE, inverse))
    return _POWERS[0][:n], _POWERS[1][:n]


def anchors(data: bytes, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """(place, hash of the gram, first and last window) of each anchor of a text."""
    n = len(data)
    if n < length:
        return tuple(np.zeros(0, np.int64) for _ in range(4))
    up, down = _powers(n)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum((np.frombuffer(data, np.uint8) + np.uint64(1)) * up)))
    hashes = (sums[gram:] - sums[:-gram]) * down[:n - gram + 1]
    hashes ^= hashes >> np.uint64(31)
    hashes *= np.uint64(0x9E3779B97F4A7C15)
    hashes ^= hashes >> np.uint64(29)
    keys = (hashes & ~np.uint64(0xFFFFFFFF)) | np.arange(len(hashes), dtype=np.uint64)
    width = length - gram + 1
    rows = np.full(-(-len(keys) // width) * width, np.iinfo(np.uint64).max)
    rows[:len(keys)] = keys
    rows = rows.reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    windows = n - length + 1
    place = (np.minimum(behind[:windows], ahead[width - 1:width - 1 + windows]) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    first = np.concatenate(([0], np.flatnonzero(np.diff(place)) + 1))
    last = np.concatenate((first[1:], [windows])) - 1
    return place[first], hashes[place[first]].view(np.int64), first, last


def _digest(data: bytes, seed: int) -> tuple[int, int]:
    value = xxhash.xxh3_128_digest(data, seed)
    return int.from_bytes(value[:8], "little", signed=True), int.from_bytes(value[8:], "little", signed=True)


def _keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(text).alias("key"),
                       F.encode(F.coalesce(F.col(text), F.lit("")), "UTF-8").alias("data"))


ANCHORS = "doc_id long, key long, place int, far int, near int, gram long, c1 long, c2 long"


def _anchor_rows(docs: DataFrame, length: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in range(8)]
            for doc, key, data in zip(*(c.to_pylist() for c in batch.columns)):
                place, gram, first, last = anchors(data, length)
                spans = list(zip(place.tolist(), first.tolist(), last.tolist()))
                digests = [_digest(data[a:b + length], p - a) for p, a, b in spans]
                for column, values in zip(out, (
                        [doc] * len(spans), [key] * len(spans), place.tolist(), (place - first).tolist(),
                        (place - last).tolist(), gram.tolist(), [d[0] for d in digests], [d[1] for d in digests])):
                    column += values
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)],
                                             [f.split()[0] for f in ANCHORS.split(", ")])

    return in_arrow(docs, run, ANCHORS)


# ---- Spark ----------------------------------------------------------------

def _with_rows(docs: DataFrame, rows: DataFrame, how: str) -> DataFrame:
    """Join per-document rows (d, k, ...) to the texts."""
    return docs.join(rows, docs["doc_id"].eqNullSafe(rows["d"]) & (docs["key"] == rows["k"]), how)


CONTEXTS = "gram long, crowded boolean, c1 long, c2 long, single boolean, far int, near int, doc_id long, key long, " \
           "place int, data binary"


def _context_bytes(docs: DataFrame, edges: DataFrame, length: int) -> DataFrame:
    """The bytes of each context, from a document that holds it."""
    wanted = edges.groupBy(F.col("at.doc_id").alias("d"), F.col("at.key").alias("k")).agg(
        F.collect_list(F.struct("gram", "crowded", "c1", "c2", "single", "at.far", "at.near", "at.place")).alias("list"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(c["gram"], c["crowded"], c["c1"], c["c2"], c["single"], c["far"], c["near"], doc, key, c["place"],
                     data[c["place"] - c["far"]:c["place"] - c["near"] + length])
                    for doc, key, data, found in zip(*(x.to_pylist() for x in batch.columns)) for c in found]
            kinds = {"long": pa.int64(), "boolean": pa.bool_(), "int": pa.int32(), "binary": pa.binary()}
            fields = [f.split() for f in CONTEXTS.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kinds[f[1]]) for i, f in enumerate(fields)],
                                             [f[0] for f in fields])

    return in_arrow(_with_rows(docs, wanted, "inner").select("doc_id", "key", "data", "list"), run, CONTEXTS)


SPANS = "doc_id long, key long, a int, b int"


def _span_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32()]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)],
                                      ["doc_id", "key", "a", "b"])


def _by_suffix_array(contexts: DataFrame, length: int) -> DataFrame:
    """Spans of single contexts, gram by gram."""

    def spans(block: Block) -> pa.RecordBatch:
        return _span_batch([(doc, key, place - most, place - least + length)
                            for (doc, key, place), least, most in block.repeats()])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, gram, found = Block(length), None, {}
        for batch in batches:
            for g, _, c1, c2, single, far, near, doc, key, place, data in zip(*(c.to_pylist() for c in batch.columns)):
                if g != gram and found:
                    block.add(gram, list(found.values()))
                    found = {}
                    if block.pieces >= BLOCK_PIECES:
                        yield spans(block)
                        block = Block(length)
                gram = g
                found[c1, c2] = (data, far, near, (doc, key, place) if single else None)
        if found:
            block.add(gram, list(found.values()))
        yield spans(block)

    return in_arrow(contexts.repartition("gram").sortWithinPartitions("gram"), run, SPANS)


def _by_windows(contexts: DataFrame, length: int) -> DataFrame:
    """Spans of single contexts of crowded grams: their windows, hashed and counted."""
    schema = "w1 long, w2 long, c1 long, single boolean, doc_id long, key long, a int"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, c1, _, single, far, near, doc, key, place, data in zip(*(c.to_pylist() for c in batch.columns)):
                digests = [_digest(data[i:i + length], far - i) for i in range(far - near + 1)]
                n = len(digests)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([d[0] for d in digests], pa.int64()), pa.array([d[1] for d in digests], pa.int64()),
                     pa.array([c1] * n, pa.int64()), pa.array([single] * n), pa.array([doc] * n, pa.int64()),
                     pa.array([key] * n, pa.int64()), pa.array(range(place - far, place - near + 1), pa.int32())],
                    [f.split()[0] for f in schema.split(", ")])

    windows = in_arrow(contexts, run, schema)
    again = (windows.groupBy("w1", "w2").agg(F.min("c1").alias("low"), F.max("c1").alias("high"))
             .where("low <> high").select("w1", "w2"))  # in two contexts at least
    return (windows.where("single").join(again, ["w1", "w2"])
            .select("doc_id", "key", "a", (F.col("a") + length).alias("b")))


def repeated_spans(keyed: DataFrame, length: int = LENGTH, crowd: int = CROWD) -> DataFrame:
    """(doc_id, key, a, b): byte ranges, not merged, that cover exactly the repeated windows."""
    found = written(_anchor_rows(keyed, length), "anchors")
    contexts = written(found.groupBy("gram", "c1", "c2").agg(
        F.count("*").alias("n"), F.min(F.struct("doc_id", "key", "place", "far", "near")).alias("at")),
        "contexts", free_shuffles=True)
    whole = found.join(contexts.where("n > 1").select("c1", "c2"), ["c1", "c2"]).select(
        "doc_id", "key", (F.col("place") - F.col("far")).alias("a"), (F.col("place") - F.col("near") + length).alias("b"))
    mixed = (contexts.groupBy("gram").agg(F.count("*").alias("k"), F.count_if(F.col("n") == 1).alias("singles"))
             .where("k > 1 and singles > 0").select("gram", (F.col("k") > crowd).alias("crowded")))
    edges = contexts.join(mixed, "gram").select("gram", "crowded", "c1", "c2", (F.col("n") == 1).alias("single"), "at")
    texts = written(_context_bytes(keyed, edges, length), "context-bytes", free_shuffles=True)
    return (whole.unionByName(_by_suffix_array(texts.where("not crowded"), length))
            .unionByName(_by_windows(texts.where("crowded"), length)))


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH,
                   crowd: int = CROWD) -> DataFrame:
    """(doc_id, n_bytes, removed, kept): the removed ranges, merged, and the bytes that stay."""
    keyed = _keyed(docs, doc_id, text)
    spans = written(repeated_spans(keyed, length, crowd), "spans", free_shuffles=True).groupBy(
        F.col("doc_id").alias("d"), F.col("key").alias("k")).agg(F.collect_set(F.struct("a", "b")).alias("spans"))  # equal rows give equal spans

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))
        for batch in batches:
            sizes, removed, kept = [], [], []
            for data, ranges in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                merged: list[list[int]] = []
                for r in sorted(ranges or [], key=lambda r: r["a"]):
                    if merged and r["a"] <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], r["b"])
                    else:
                        merged.append([r["a"], r["b"]])
                ends = [0, *(b for _, b in merged)]
                sizes.append(len(data))
                removed.append([{"a": a, "b": b} for a, b in merged])
                kept.append(b"".join(data[x:y] for x, y in zip(ends, [*(a for a, _ in merged), len(data)])))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(removed, kind), pa.array(kept, pa.binary())],
                ["doc_id", "n_bytes", "removed", "kept"])

    return in_arrow(_with_rows(keyed, spans, "left").select("doc_id", "data", "spans"), run,
                    "doc_id long, n_bytes long, removed array<struct<a:int,b:int>>, kept binary")
