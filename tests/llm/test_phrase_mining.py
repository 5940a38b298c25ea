import random
import re
from collections import Counter

import numpy as np
import pytest
from llm_data import SCHEMA, empty_docs, odd_docs

from duelframe.llm import phrase_mining as P
from duelframe.llm import queries

SF = "/root/testdata/sf0.01"


def pieces(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [[w for w in re.split("[ \t]", p) if w] for p in re.split("[.,;:!?\n-\r]", low)]


def brute(rows, min_count, max_words=5, limit=2000):
    """(lang, rank, phrase, a, l, r, n, score) of (lang, text) rows."""
    out = []
    for lang in {c if c is not None else "und" for c, _ in rows}:
        f, n = Counter(), 0
        for c, t in rows:
            if (c if c is not None else "und") == lang:
                for w in pieces(t):
                    n += len(w)
                    f.update(tuple(w[i:i + m]) for m in range(1, max_words + 1) for i in range(len(w) - m + 1))
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= min_count}
        longest = Counter()  # the largest count of a longer candidate around a phrase
        for q, b in candidates.items():
            for m in range(2, len(q)):
                for i in range(len(q) - m + 1):
                    longest[q[i:i + m]] = max(longest[q[i:i + m]], b)
        scored = []
        for p, a in candidates.items():
            if 100 * longest[p] >= 100 * a:
                continue
            s, k = min((1000 * a * n // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            scored.append((-s, -a, " ".join(p).encode(), a, f[p[:k]], f[p[k:]], n, s))
        for rank, (_, _, p, *rest) in enumerate(sorted(scored)[:limit], 1):
            out.append((lang, rank, p.decode(), *rest))
    return out


def corpus(seed=1):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(40)] + ["É", "漢", "a\xa0b", "x y"]
    sets = ["new york city hall", "a a a a a a", "to be or not to be", "É 漢 É"]
    rows = []
    for k in range(120):
        parts = []
        for _ in range(rng.randrange(12)):
            parts.append(rng.choice(sets) if rng.random() < 0.4 else
                         " ".join(rng.choices(vocabulary, [1 / (i + 1) for i in range(len(vocabulary))], k=rng.randrange(9))))
            parts.append(rng.choice([" ", ". ", ",", "\n", "\t", " \x0b", "\r\n", "  "]))
        rows.append((rng.choice(["en", "de", None, "und"]), "".join(parts).upper() if k % 5 == 0 else "".join(parts)))
    return rows


def run(docs, min_count, limit=2000, **how):
    return sorted(map(tuple, P.top(P.collocations(docs, min_count=min_count, **how), limit, salts=4).collect()))


@pytest.mark.parametrize("max_ranked", [1 << 20, 7, 0])
def test_against_brute_force(spark, max_ranked):
    rows = corpus()
    docs = spark.createDataFrame([(i, t, c, "s", 1) for i, (c, t) in enumerate(rows)], SCHEMA).repartition(3)
    want = sorted(brute(rows, 6))
    assert run(docs, 6, max_ranked=max_ranked) == want and len(want) > 40
    assert run(docs, 6, limit=5, max_ranked=max_ranked) == sorted(brute(rows, 6, limit=5))


def test_dense_and_sparse_tiles_count_alike(spark, monkeypatch):
    rows = corpus(2)
    docs = spark.createDataFrame([(i, t, c, "s", 1) for i, (c, t) in enumerate(rows)], SCHEMA).repartition(2)
    rng = np.random.default_rng(3)
    i, j = rng.zipf(1.3, 60_000) % 5000, rng.zipf(1.3, 60_000) % 5000
    want = Counter(zip(i.tolist(), j.tolist()))
    for dense_from, held, tiles in ((1, 1 << 20, 48), (1 << 30, 500, 48), (200, 2000, 3)):
        monkeypatch.setattr(P, "DENSE_FROM", dense_from)
        monkeypatch.setattr(P, "HELD", held)
        monkeypatch.setattr(P, "DENSE_TILES", tiles)
        t, got = P.Tiles(), Counter()
        for at in range(0, len(i), 7000):
            for a, b, n in t.add(i[at:at + 7000], j[at:at + 7000]):
                got.update(dict(zip(zip(a.tolist(), b.tolist()), n.tolist())))
        assert len(t.dense) <= tiles and (dense_from > 1 or t.dense)
        for a, b, n in t.rest():
            for x, y, c in zip(a.tolist(), b.tolist(), n.tolist()):
                got[x, y] += c
        assert got == want
    assert run(docs, 5) == sorted(brute(rows, 5))


def test_exact_beyond_64_bits(spark):
    every = spark.createDataFrame([("en", 1, "a", 4_000_000_007), ("en", 1, "b", 4_000_000_007),
                                   ("en", 2, "a b", 3_999_999_999)], "lang string, words int, phrase string, n long")
    real, P.phrases = P.phrases, lambda *a: (every, spark.createDataFrame([("en", 9_000_000_000_123)], "lang string, total long"))
    try:
        row = P.collocations(every).first()
    finally:
        P.phrases = real
    assert row["score"] == 1000 * 3_999_999_999 * 9_000_000_000_123 // 4_000_000_007 ** 2


def test_odd_rows(spark):
    docs = odd_docs(spark).withColumnsRenamed({"source": "phrase", "n_chars": "score"})
    rows = [(r["lang"], r["text"]) for r in docs.collect()]
    assert run(docs, 2) == sorted(brute(rows, 2))
    assert run(empty_docs(spark), 1) == []


def test_chunks_of_ids_overlap(spark):
    text = "p q r s t " * 120_000  # more ids than a chunk
    docs = spark.createDataFrame([("en", text)], "lang string, text string")
    got = {r["phrase"]: r["n"] for r in P.phrases(docs)[0].collect()}
    assert got["p q r s t"] == 120_000 and got["t p q"] == 119_999 and got["s"] == 120_000


def test_query_matches_brute_force(spark):
    rows = [(r["lang"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert sorted(map(tuple, queries.op12_phrase_mining(spark, SF).collect())) == sorted(brute(rows, 100))
