import hashlib
import random
import time
from collections import Counter

from llm_data import SF, empty_docs, odd_docs

from duelframe.llm import queries
from duelframe.llm import suffix_dedup as X


def brute(texts, length):
    """(bytes, removed, spans, kept) of every text."""
    times = Counter(t[i:i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if times[t[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((len(t), sum(gone), spans, bytes(c for c, g in zip(t, gone) if not g)))
    return out


def mutated(rng, n, letters=4, size=120):
    base = ["".join(rng.choice("abcdefghé"[:letters + 1]) for _ in range(rng.randrange(size))) for _ in range(5)]
    out = []
    for _ in range(n):
        t = rng.choice(base)
        for _ in range(rng.randrange(4)):
            i = rng.randrange(len(t) + 1)
            t = rng.choice([t[:i] + "é" + t[i:], t[:i] + t[i + 1:], t[:i] + rng.choice(base)[:20] + t[i:], t * 2])
        out.append(t)
    return out


def test_suffix_array_by_sorting():
    rng = random.Random(1)
    for _ in range(2000):
        s = [rng.randint(1, rng.choice([1, 2, 3, 9])) for _ in range(rng.randrange(40))] + [0]
        order = X.suffix_array(s)
        assert order == sorted(range(len(s)), key=lambda i: s[i:])
        for a, b, n in zip(order, order[1:], X.common_prefixes(s, order)[1:]):
            assert s[a:a + n] == s[b:b + n] and s[a + n:a + n + 1] != s[b + n:b + n + 1]


def test_each_window_has_one_anchor_that_depends_on_it_alone():
    rng = random.Random(2)
    for _ in range(50):
        data = bytes(rng.choice(b"abcab") for _ in range(rng.randrange(300)))
        seen = {}
        place, gram, first, last = X.anchors(data, 20, 4)
        windows = [(x, p, g) for p, g, a, b in zip(place, gram, first, last) for x in range(a, b + 1)]
        assert [x for x, _, _ in windows] == list(range(max(0, len(data) - 19)))
        for x, p, g in windows:
            assert x <= p <= x + 16
            assert seen.setdefault(data[x:x + 20], (p - x, g)) == (p - x, g)


def test_small_lengths_match_brute_force():
    rng = random.Random(3)
    for _ in range(40):
        length, gram = rng.choice([(20, 4), (12, 4), (8, 2)])
        texts = [t.encode() for t in mutated(rng, 12, letters=rng.choice([1, 3, 8]))] + [b"", b"abc", b"a" * 90]
        assert local(texts, length, gram) == brute(texts, length)


def local(texts, length, gram):
    """The operator's steps without Spark."""
    gone = [bytearray(len(t)) for t in texts]
    contexts = {}
    for k, t in enumerate(texts):
        for p, g, a, b in zip(*(c.tolist() for c in X.anchors(t, length, gram))):
            contexts.setdefault(g, {}).setdefault((t[a:b + length], p - a, p - b), []).append((k, p))
    block = X.Block(length)
    for g, found in contexts.items():
        for (_, far, near), at in found.items():
            for k, p in at if len(at) > 1 else ():
                gone[k][p - far:p - near + length] = b"\1" * (far - near + length)
        block.add(g, [(*c, at[0] if len(at) == 1 else None) for c, at in found.items()])
    for (k, p), least, most in block.repeats():
        gone[k][p - most:p - least + length] = b"\1" * (most - least + length)
    return [(len(t), sum(g), sum(x and not (i and g[i - 1]) for i, x in enumerate(g)),
             bytes(c for c, x in zip(t, g) if not x)) for t, g in zip(texts, gone)]


def rows_of(frame):
    return sorted(str((r["doc_id"], r["n_bytes"], sum(s["b"] - s["a"] for s in r["removed"]), len(r["removed"]), bytes(r["kept"])))
                  for r in frame.collect())


def test_spark_matches_brute_force_with_and_without_crowding(spark):
    rng = random.Random(5)
    texts = mutated(rng, 50, letters=8, size=900) + ["x" * 700, "ab" * 500]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    want = sorted(str((i, *w)) for i, w in enumerate(brute([t.encode() for t in texts], 100)))
    for crowd in (X.CROWD, 1):
        assert rows_of(X.remove_repeats(docs, length=100, crowd=crowd)) == want


def test_query_matches_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    want = brute([(r["text"] or "").encode() for r in docs], 400)
    got = {r["doc_id"]: r for r in queries.op10_suffix_dedup(spark, SF).collect()}
    assert len(got) == len(docs)
    for d, (n, removed, spans, kept) in zip(docs, want):
        r = got[d["doc_id"]]
        assert (r["n_bytes"], r["n_removed"], r["n_spans"]) == (n, removed, spans)
        assert r["kept_sha256"] == hashlib.sha256(kept).hexdigest()


def test_shuffle_files_of_ended_steps_are_dropped(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffles():
        found = files.getAllFiles().iterator()
        out = set()
        while found.hasNext():
            out.add(found.next().getName())
        return {f for f in out if f.startswith("shuffle_")}

    before = shuffles()
    rng = random.Random(11)
    docs = spark.createDataFrame(list(enumerate(mutated(rng, 50, letters=8, size=900))), "doc_id long, text string")
    left = X.remove_repeats(docs, length=100)  # all steps but the last have run
    end = time.time() + 20
    while shuffles() - before and time.time() < end:
        time.sleep(0.2)  # files go in the background
    assert not shuffles() - before
    assert left.count() == 50


def test_odd_rows(spark):
    docs = odd_docs(spark).withColumnRenamed("lang", "gram").withColumnRenamed("source", "key")
    rows = docs.collect()
    want = brute([(r["text"] or "").encode() for r in rows], 400)
    assert rows_of(X.remove_repeats(docs)) == sorted(str((r["doc_id"], *w)) for r, w in zip(rows, want))
    assert X.remove_repeats(empty_docs(spark)).count() == 0
