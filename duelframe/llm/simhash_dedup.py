"""SimHash near-duplicates, linked through the anchor points of a covering code.

Fingerprint: the bits that are set in over half of the XXH64 hashes (seed 42)
of a text's word shingles, repeats included.  Two texts are linked when their
fingerprints differ in at most ``max_bits`` places; groups are the connected
components of all links.

Finding the links.  The anchors are the words of a covering code: every
64-bit value lies within the covering radius of an anchor.  The code is a
product of perfect codes over slices of the fingerprint (Golay [23,12],
radius 3; Hamming [15,11], radius 1; a slice that no code covers is left
free), so a value has exactly one anchor within the radius, its home.  A
fingerprint y within ``max_bits`` of x lies within radius + ``max_bits`` of
x's home.  Hence each fingerprint is replicated to every anchor within that
distance and compared there with the fingerprints at home: no pair is missed,
and each is met once.  Because a perfect code's cosets are given by their
syndromes, the anchors near a value come from a table lookup.

Work is done on distinct fingerprints, so a group of exact copies, however
large, is one row.  A fingerprint has at most 2,080 others within two bits,
which bounds the links of the densest cluster by its size times a constant.
The join by anchor is an ordinary sort-merge join, which Spark splits when an
anchor is crowded.

Tables with a row for each document, fingerprint or anchor are joined with the
merge hint.  Spark would broadcast them by their compressed files' size, which
says little about the rows: the anchors of 250,000 fingerprints, 61 rows of each,
count as a few MB there and do not fit into a driver of 1 GB.

Defined results: a null text is the empty text; texts without words have
fingerprint zero and are linked like any other; a null id never names a group
unless all ids of the group are null; repeated rows are one member each.  Extra columns
of any name stay in ``keep_one`` and are not read by the others.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations, product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import free_name, in_arrow, written
from .components import connected_components

SEED = 42
#: (width, generator polynomial, covering radius) of the codes in use.
GOLAY = (23, 0b101011100011, 3)
HAMMING = (15, 0b10011, 1)
#: Two Golay slices make 2^24 anchors; from this many fingerprints on, a Hamming slice makes 2^35.
FINE_CODE_FROM = 200_000_000


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """The 64-bit SimHash of a text, as an unsigned integer."""
    words = (text or "").encode("utf-8").lower().split()
    n = len(words)
    if not n:
        return 0
    joined = b" ".join(words)
    if n < shingle:
        hashes = [xxhash.xxh64_intdigest(joined, SEED)]
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1) - 1
        starts = np.concatenate(([0], ends[:n - shingle] + 1)).tolist()
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[a:b], SEED) for a, b in zip(starts, ends[shingle - 1:].tolist())]
    values = np.array(hashes, np.uint64)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(values), 1 << 16):
        rows = values[at:at + (1 << 16)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(rows, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(values), bitorder="little")
    return int(bits.view(np.uint64)[0])


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                 shingle: int = 3) -> DataFrame:
    """(doc_id, text_key, fp): one row per row of ``docs``; fp is the signed 64-bit value.

    ``text_key`` is a hash of the text that tells rows of one id apart.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t, shingle) for t in batch.column(2).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(fps.view(np.int64))], ["doc_id", "text_key", "fp"])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"),
                       F.xxhash64(text).alias("text_key"), F.col(text).alias("text"))
    return in_arrow(rows, run, "doc_id long, text_key long, fp long")


@lru_cache(maxsize=8)
def _cosets(width: int, generator: int, reach: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of a cyclic code: syndromes of all values, and per syndrome the error patterns of weight <= reach."""
    degree = generator.bit_length() - 1
    remainder = np.array([_mod(1 << i, generator, degree) for i in range(width)], np.int64)
    syndromes = np.zeros(1 << width, np.int16)
    for i in range(width):
        syndromes[1 << i: 2 << i] = syndromes[:1 << i] ^ remainder[i]
    patterns = np.array([sum(1 << i for i in c) for w in range(reach + 1)
                         for c in combinations(range(width), w)], np.int64)
    weights = np.array([w for w in range(reach + 1) for _ in combinations(range(width), w)], np.int64)
    order = np.argsort(syndromes[patterns], kind="stable")  # by syndrome, lightest first
    first = np.searchsorted(syndromes[patterns][order], np.arange((1 << degree) + 1))
    return syndromes, first, patterns[order], weights[order]


def _mod(value: int, generator: int, degree: int) -> int:
    while value.bit_length() > degree:
        value ^= generator << (value.bit_length() - 1 - degree)
    return value


def anchors(values: np.ndarray, codes: tuple, excess: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All anchors within radius + ``excess`` of each value, slice by slice.

    Returns (row of the value, anchor, whether it is the value's home).
    """
    row, anchor, over = np.arange(len(values)), np.zeros(len(values), np.int64), np.zeros(len(values), np.int64)
    shift = 0
    for width, generator, radius in codes:
        syndromes, first, patterns, weights = _cosets(width, generator, radius + excess)
        part = ((values >> np.uint64(shift)) & np.uint64((1 << width) - 1)).astype(np.int64)[row]
        s = syndromes[part].astype(np.int64)
        count = first[s + 1] - first[s]
        back = np.repeat(np.arange(len(row)), count)
        at = first[s][back] + np.arange(len(back)) - np.repeat(np.cumsum(count) - count, count)
        spent = over[back] + np.maximum(0, weights[at] - radius)
        keep = spent <= excess
        back, at = back[keep], at[keep]
        row, over = row[back], spent[keep]
        anchor = (anchor[back] << width) | (part[back] ^ patterns[at])
        shift += width
    return row, anchor, over == 0


def links(classes: DataFrame, max_bits: int = 2, codes: tuple | None = None) -> DataFrame:
    """(a, b): all pairs a < b of distinct values in column ``fp`` with at most ``max_bits`` different bits."""
    if codes is None:
        codes = (GOLAY, GOLAY) + ((HAMMING,) if classes.count() >= FINE_CODE_FROM else ())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            for at in range(0, len(fps), 2000):
                part = fps[at:at + 2000]
                row, anchor, home = anchors(part.view(np.uint64), codes, max_bits)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchor), pa.array(part[row]), pa.array(home)], ["anchor", "fp", "home"])

    near = in_arrow(classes.select("fp"), run, "anchor long, fp long, home boolean")
    # only the lookup, no hashing of texts, is repeated for the two sides
    at_home = near.where("home").select("anchor", F.col("fp").alias("a"))
    # the estimate of a map's size takes one row for each of its input's, here there are some 61
    return (at_home.join(near.select("anchor", F.col("fp").alias("b")).hint("merge"), "anchor")
            .where("a < b").where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits)
            .select("a", "b"))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3,
                    max_bits: int = 2, codes: tuple | None = None) -> DataFrame:
    """(doc_id, text_key, fp, component_id, root) of every row.

    component_id is the group's smallest id; root is a fingerprint of the
    group, which tells groups apart whose smallest ids are equal.
    """
    marked = written(fingerprints(docs, doc_id, text, shingle), "fingerprints")
    classes = written(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "classes")
    roots = connected_components(links(classes, max_bits, codes))
    linked = roots.join(classes.hint("merge"), roots["node"] == classes["fp"]).select("root", "fp", "least")
    of_root = linked.groupBy("root").agg(F.min("least").alias("component_id"))
    groups = written(linked.join(of_root, "root").select("fp", "component_id", "root"), "groups")
    named = classes.join(groups.hint("merge"), "fp", "left").select(
        "fp", F.coalesce("component_id", "least").alias("component_id"), F.coalesce("root", "fp").alias("root"))
    named = written(named, "named")  # Spark splits a crowded fingerprint only in a join of two tables, not of three
    return marked.join(named.hint("merge"), "fp").select("doc_id", "text_key", "fp", "component_id", "root")


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """``docs`` with one row of each group: that with the smallest id.

    Rows of one id are told apart by their text: groups that share their
    smallest id keep one row each, and of a group's rows with that id the one
    with the least text hash stays.  Of entirely repeated rows one stays.  In a
    group without any id the row with the least text hash stays.
    """
    groups = written(near_duplicates(docs, doc_id, text, **how), "members")
    candidates = groups.where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    chosen = candidates.groupBy("root").agg(F.min(F.struct("doc_id", "text_key")).alias("key"), F.count("*").alias("n"))
    keys = written(chosen.select("key.doc_id", "key.text_key", (F.col("n") > 1).alias("repeated")), "kept")
    own_id, own_key = free_name(docs.columns, "__id"), free_name(docs.columns, "__key")
    keyed = docs.withColumn(own_id, F.col(doc_id).cast("long")).withColumn(own_key, F.xxhash64(text))

    def of(rows: DataFrame) -> DataFrame:
        hit = (keyed[own_id].eqNullSafe(rows["doc_id"])) & (keyed[own_key] == rows["text_key"])
        return keyed.join(rows.hint("merge"), hit, "left_semi")

    once = of(keys.where("not repeated"))
    again = of(keys.where("repeated")).dropDuplicates([own_id, own_key])
    return once.unionByName(again).drop(own_id, own_key)
