import random
import re

import numpy as np
import xxhash
from llm_data import SF, SCHEMA, empty_docs, odd_docs, words
from pyspark.sql import functions as F

from duelframe.llm import queries, simhash_dedup as S
from duelframe.llm.components import connected_components


def brute_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    parts = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)] if w else []
    h = [xxhash.xxh64(p.encode(), seed=42).intdigest() for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_groups(rows):
    """doc -> least id reachable, over (id, fingerprint)."""
    fps = sorted({f for _, f in rows})
    root = {f: f for f in fps}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f

    for i, a in enumerate(fps):
        for b in fps[i + 1:]:
            if (a ^ b).bit_count() <= 2:
                root[find(a)] = find(b)
    least = {}
    for d, f in rows:
        if d is not None:
            least[find(f)] = min(least.get(find(f), d), d)
    return [(d, f"{f:016x}", least.get(find(f))) for d, f in rows]


def test_fingerprint_by_definition():
    rng = random.Random(3)
    for n in (0, 1, 2, 3, 4, 17, 300):
        text = words(rng, n).replace(" ", "\t \n", 1).upper() + (" É ÄÖ" if n % 2 else "")
        assert S.fingerprint(text) == brute_fingerprint(text)
    assert S.fingerprint(None) == S.fingerprint(" \n") == 0


def test_every_value_has_one_home_and_no_near_value_misses_it():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 2**63, 300, dtype=np.uint64) * 2 + rng.integers(0, 2, 300, dtype=np.uint64)
    for bits in (0, 1, 2):
        b = a.copy()
        for i in range(len(b)):
            for k in rng.choice(64, bits, replace=False):
                b[i] ^= np.uint64(1) << np.uint64(k)
        for codes in ((S.GOLAY, S.GOLAY), (S.GOLAY, S.GOLAY, S.HAMMING)):
            row, anchor, home = S.anchors(a, codes, 2)
            assert sorted(row[home].tolist()) == list(range(len(a)))
            homes = dict(zip(row[home].tolist(), anchor[home].tolist()))
            row, anchor, _ = S.anchors(b, codes, 2)
            near = set(zip(row.tolist(), anchor.tolist()))
            assert len(near) == len(row) and all((i, homes[i]) in near for i in homes)


def test_links_match_all_pairs(spark):
    rng = random.Random(5)
    values = [rng.getrandbits(64) for _ in range(200)]
    for v in list(values):
        for _ in range(3):
            for b in rng.sample(range(64), rng.randrange(1, 5)):
                v ^= 1 << b
            values.append(v)
    values = list(dict.fromkeys(values))
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    frame = spark.createDataFrame([(v,) for v in signed], "fp long")
    want = {(min(a, b), max(a, b)) for i, a in enumerate(signed) for b in signed[i + 1:]
            if ((a ^ b) & (2**64 - 1)).bit_count() <= 2}
    for codes in (None, (S.GOLAY, S.GOLAY, S.HAMMING)):
        got = [tuple(r) for r in S.links(frame, 2, codes).collect()]
        assert len(got) == len(set(got)) and set(got) == want


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(60)] + [(1000, 1000 + i) for i in range(1, 50)] + [(3000, 2999), (5, 5)]
    got = {r["node"]: r["root"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == ({i: 0 for i in range(61)} | {1000 + i: 1000 for i in range(50)} | {2999: 2999, 3000: 2999})
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_query_matches_brute_force(spark):
    rows = [(r["doc_id"], brute_fingerprint(r["text"])) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = sorted(map(tuple, queries.op4_simhash_dedup(spark, SF).collect()))
    assert got == sorted(brute_groups(rows))


def test_odd_rows(spark):
    docs = odd_docs(spark).withColumnRenamed("lang", "fp").withColumnRenamed("n_chars", "component_id")
    rows = [(r["doc_id"], brute_fingerprint(r["text"])) for r in docs.collect()]
    got = [(r["doc_id"], f"{r['fp'] & (2**64 - 1):016x}", r["component_id"]) for r in S.near_duplicates(docs).collect()]
    key = lambda r: (r[0] is None, r)
    assert sorted(got, key=lambda r: str(r)) == sorted(brute_groups(rows), key=lambda r: str(r)), key
    kept = S.keep_one(docs)
    assert kept.columns == docs.columns
    part = {f: f for _, f in rows}  # components by fingerprint, as their least ids may be equal
    for _ in part:
        part = {f: min(part[g] for g in part if (f ^ g).bit_count() <= 2) for f in part}
    least = [min((i for i, f in rows if part[f] == c and i is not None), default=None) for c in set(part.values())]
    left = [r["doc_id"] for r in kept.collect()]
    assert sorted(left, key=str) == sorted(least, key=str)  # one row of each component, with its least id
    assert S.near_duplicates(empty_docs(spark)).count() == S.keep_one(empty_docs(spark)).count() == 0


def test_large_group_of_copies_keeps_one(spark):
    rng = random.Random(9)
    text = words(rng, 50)
    docs = spark.createDataFrame([(i, text, "en", "s", 1) for i in range(500)] + [(900, words(rng, 50), "en", "s", 1)], SCHEMA)
    assert sorted(r["doc_id"] for r in S.keep_one(docs).select("doc_id").collect()) == [0, 900]
    assert S.near_duplicates(docs).where(F.col("component_id") == 0).count() == 500


def test_groups_that_share_their_smallest_id_keep_one_row_each(spark):
    rng = random.Random(21)
    other = [words(rng, 60) for _ in range(8)]
    rows = [(5, other[0]), (5, other[0]), (7, other[0]), (5, other[1]), (8, other[1]), (5, other[2]), (9, other[3])]
    rows += [(1, t) for t in other[4:]] + [(None, other[5])]
    kept = S.keep_one(spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], SCHEMA)).collect()
    want = [(5, other[0]), (5, other[1]), (5, other[2]), (9, other[3]), *[(1, t) for t in other[4:]]]
    assert sorted((r["doc_id"], r["text"]) for r in kept) == sorted(want)


def joins_of(df):
    """Kinds of joins and broadcasts as planned; what runs at last must have no other kinds."""
    find = lambda: re.findall(r"\w+Join(?=[ (])|BroadcastExchange", df._jdf.queryExecution().executedPlan().toString())
    planned = find()
    df.collect()
    assert set(find()) == set(planned)
    return planned


def test_tables_of_the_documents_size_are_not_broadcast(spark):
    """These are small, so that without hints all would be, far below Spark's own threshold."""
    docs = spark.createDataFrame([(i, f"some words {i % 40} that stand here", "en", "s", 1) for i in range(80)], SCHEMA)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")
        classes = S.written(S.fingerprints(docs).groupBy("fp").agg(F.min("doc_id").alias("least")), "classes")
        assert joins_of(S.links(classes)) == ["SortMergeJoin"]
        assert joins_of(S.near_duplicates(docs)) == ["SortMergeJoin"]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_linked_rows_without_ids_keep_one(spark):
    rng = random.Random(23)
    while True:  # two texts whose fingerprints are linked but differ
        a = words(rng, 400)
        b = a + " " + words(rng, 1)
        if 0 < (brute_fingerprint(a) ^ brute_fingerprint(b)).bit_count() <= 2:
            break
    docs = spark.createDataFrame([(None, t, "en", "s", 1) for t in (a, b, a, words(rng, 50))], SCHEMA)
    texts = [r["text"] for r in S.keep_one(docs).collect()]
    assert len(texts) == 2 and len(set(texts) & {a, b}) == 1
