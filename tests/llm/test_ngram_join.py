import random
from collections import defaultdict

import numpy as np
import pytest
from llm_data import SCHEMA, SF, empty_docs, odd_docs, words

from duelframe.llm import ngram_join as J
from duelframe.llm import queries


def shingle_set(text, size=5):
    w = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        w = w.replace(c, " ")
    w = [x for x in w.split(" ") if x]
    return {tuple(w[i:i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else ({tuple(w)} if w else set())


def linked(a, b, percent=80):
    both = len(a & b)
    return bool(a) and bool(b) and 100 * both >= percent * (len(a) + len(b) - both)


def brute(rows, size=5, percent=80):
    """(doc_id, n_shingles, component_id) of (doc_id, text) rows, by comparing all pairs that share a shingle."""
    sets = [shingle_set(t, size) for _, t in rows]
    with_gram = defaultdict(list)
    for i, s in enumerate(sets):
        for g in s:
            with_gram[g].append(i)
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, s in enumerate(sets):
        for j in {j for g in s for j in with_gram[g] if j < i}:
            if find(i) != find(j) and linked(s, sets[j], percent):
                root[find(i)] = find(j)
    least = defaultdict(list)
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)].append(d)
    return [(d, len(sets[i]), min(least[find(i)], default=None) if sets[i] else d) for i, (d, _) in enumerate(rows)]


def run(docs, **how):
    return [(r["doc_id"], r["n"], r["component_id"]) for r in J.groups(docs, **how).collect()]


def near_copies(rng, base, n, changes):
    out = []
    for _ in range(n):
        w = base.split()
        for _ in range(changes):
            w[rng.randrange(len(w))] = words(rng, 1)
        out.append(" ".join(w))
    return out


def corpus():
    """Chains, groups of near copies, shared passages, threshold cases, short and repeated texts."""
    rng = random.Random(2)
    texts = []
    for k in range(6):
        base = words(rng, 120)
        texts += [base] + near_copies(rng, base, 8, 1 + k % 4)
        chain = base
        for _ in range(10):
            chain = near_copies(rng, chain, 1, 2)[0]
            texts.append(chain)
    passage = words(rng, 60)
    texts += [passage + " " + words(rng, 5 + i) for i in range(40)]
    texts += [words(rng, 10 + i % 50) + " " + passage + " " + words(rng, i % 30) for i in range(40)]
    for n in range(1, 30):  # sets of equal or nested words around the threshold
        w = words(rng, n + 4).split()
        texts += [" ".join(w), " ".join(w[: len(w) - max(1, n // 5)]), " ".join(w[: len(w) - max(1, n // 5) - 1])]
    texts += ["a b c", "A  B\tC", "a b c d", "x", "", None, " \n", "a b c d e", "a a a a a a a a a a", "a a a a a"]
    return [(i * 7 % 1009, t) for i, t in enumerate(texts)]


@pytest.mark.parametrize("tile", [4096, 5])
def test_groups_match_all_pairs(spark, tile):
    rows = corpus()
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], SCHEMA).repartition(4)
    assert sorted(run(docs, tile=tile)) == sorted(brute(rows))


def test_links_are_every_pair(spark):
    rows = corpus()
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], SCHEMA)
    found, members = J.links(docs, tile=7)
    of = {r["doc_id"]: r["cls"] for r in members.collect()}
    got = {tuple(sorted(r)) for r in found.collect()}
    by_class = {of[i]: shingle_set(t) for i, t in rows if of[i] is not None}
    keys = sorted(by_class)
    want = {(a, b) for k, a in enumerate(keys) for b in keys[k + 1:] if linked(by_class[a], by_class[b])}
    assert got == want and len(want) > 100


@pytest.mark.parametrize("size,percent", [(3, 60), (1, 90), (5, 100)])
def test_other_sizes_and_thresholds(spark, size, percent):
    rows = corpus()[:120]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], SCHEMA)
    assert sorted(run(docs, size=size, percent=percent)) == sorted(brute(rows, size, percent))


def test_query_matches_brute_force(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = [tuple(r)[:3] for r in queries.op11_ngram_jaccard_join(spark, SF).collect()]
    assert sorted(got) == sorted(brute(rows))


def test_odd_rows(spark):
    docs = odd_docs(spark).withColumnsRenamed({"lang": "cls", "n_chars": "n", "source": "component_id"})
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert sorted(run(docs), key=str) == sorted(brute(rows), key=str)
    assert run(empty_docs(spark)) == []


def test_hot_passage_and_large_group(spark):
    rng = random.Random(11)
    base, passage = words(rng, 60), words(rng, 55)
    texts = near_copies(rng, base, 300, 1) + [base] * 300
    texts += [passage + " " + words(rng, 3 + i % 12) for i in range(300)]  # the passage alone links many of them
    rows = list(enumerate(texts))
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], SCHEMA).repartition(8)
    assert sorted(run(docs, tile=50)) == sorted(brute(rows))


def test_shingles_of_equal_words_and_order():
    assert len(J.shingles("b a b a b a")) == 2 and len(J.shingles("a " * 50)) == 1
    assert not np.intersect1d(J.shingles("a b c d e"), J.shingles("b a c d e")).size
    assert not np.intersect1d(J.shingles("a b c d"), J.shingles("a b c d e")).size
    assert len(J.shingles("w" * 100_000 + " x")) == 1 and len(J.shingles("É b\xa0c d\x0be\u2003f g")) == 1
    texts = [t for _, t in corpus()]
    alone = [J.shingles(t) for t in texts]
    assert all(np.array_equal(a, b) for a, b in zip(alone, J.shingle_sets(texts)))  # chunks change nothing
    assert [len(a) for a in alone] == [len(shingle_set(t)) for t in texts]
