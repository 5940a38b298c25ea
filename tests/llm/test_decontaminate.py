import random
from collections import Counter

import numpy as np
from llm_data import SF, SCHEMA, empty_docs, odd_docs, words

from duelframe.llm import decontaminate as D
from duelframe.llm import queries


def brute(text, items, threshold=0.8):
    """Best weighted similarity of any window of an item's size, and its first place."""
    w, out, of_text = D.words_of(text), {}, {}
    for i, t in items:
        x = D.words_of(t)
        if not x:
            continue
        k = min(5, len(x))
        bag = lambda y: Counter(tuple(y[j:j + k]) for j in range(len(y) - k + 1))
        own, best = bag(x), (0.0, 0)
        if k not in of_text:
            of_text[k] = set(bag(w))
        if not of_text[k] & own.keys():
            continue  # no window has anything in common with the item
        for s in range(len(w) - len(x) + 1):
            win = bag(w[s:s + len(x)])
            sim = sum((own & win).values()) / sum((own | win).values())
            if sim >= threshold and sim > best[0]:
                best = sim, s
        if best[0]:
            out[i] = best
    return out


def planted(rng, n=150):
    vocabulary = words(rng, 120).split()
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.choice([1, 3, 5, 8, 20, 45, 60])))) for i in range(25)]
    texts = []
    for _ in range(n):
        w = [rng.choice(vocabulary) for _ in range(rng.randrange(0, 150))]
        if rng.random() < .7:
            x = rng.choice(items)[1].split()
            for _ in range(rng.randrange(3)):
                j = rng.randrange(len(x))
                x[j:j + rng.randrange(2)] = rng.choice([[], [rng.choice(vocabulary)], [x[j].upper()]])
                x = x or ["q"]
            at = rng.randrange(len(w) + 1)
            w[at:at] = x
        texts.append(" ".join(w))
    return items, texts


def test_matches_every_window():
    rng = random.Random(11)
    items, texts = planted(rng)
    index = D.Index(tuple(items))
    hits = 0
    for t in texts:
        want = brute(t, items)
        assert index.matches(t, 0.8) == want
        hits += len(want)
    assert hits > 60


def test_multi_index_finds_all_within_the_radius():
    rng = np.random.default_rng(3)
    items = tuple((i, words(random.Random(i), 30)) for i in range(40))
    index = D.Index(items)
    probe = index.fingerprint.copy()
    for i in range(len(probe)):
        for b in rng.choice(64, rng.integers(0, 26), replace=False):
            probe[i] ^= np.uint64(1) << np.uint64(b)
    want = {(r, i) for r, p in enumerate(probe) for i, f in enumerate(index.fingerprint)
            if int(p ^ f).bit_count() <= D.RADIUS}
    assert index.near(probe, 30) == want and want
    assert index.near(probe, 29) == set()


def test_near_the_threshold_the_radius_suffices():
    rng = random.Random(13)
    found = total = 0
    for k in range(300):
        x = words(rng, 59).split()
        y = list(x)
        y[rng.randrange(5, 54)] = "changed"  # 50 of 55 shingles stay: similarity 0.83
        index = D.Index(((k, " ".join(x)),))
        total += 1
        found += bool(index.matches("lead in " + " ".join(y) + " lead out", 0.8))
    assert found == total


def test_query_matches_brute_force(spark):
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    want = sorted((d["doc_id"], i, round(s, 9), at) for d in docs for i, (s, at) in brute(d["text"], items).items())
    got = sorted((r["doc_id"], r["item_id"], round(r["similarity"], 9), r["first_word"])
                 for r in queries.op5_decontamination(spark, SF).collect())
    assert got == want


def test_blocks_and_odd_rows(spark, monkeypatch):
    rng = random.Random(17)
    items, texts = planted(rng, 40)
    bench = spark.createDataFrame([*items, items[0], (90, None), (91, ""), (None, "a b"), (92, " \n")], "item_id long, text string")
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in enumerate(texts)], SCHEMA).union(odd_docs(spark))
    rows = docs.collect()
    want = sorted(str((r["doc_id"], i)) for r in rows for i in brute(r["text"], items))
    assert sorted(str((r["doc_id"], r["item_id"])) for r in D.leaks(docs, bench).collect()) == want
    monkeypatch.setattr(D, "BLOCK_ITEMS", 6)
    assert sorted(str((r["doc_id"], r["item_id"])) for r in D.leaks(docs, bench).collect()) == want
    clean = D.without_leaks(docs, bench)
    assert clean.columns == docs.columns
    assert sorted(map(str, clean.collect())) == sorted(str(r) for r in rows if not brute(r["text"], items))
    assert D.leaks(empty_docs(spark), bench).count() == 0
    assert D.leaks(docs, bench.limit(0)).count() == 0
    assert D.without_leaks(docs, bench.limit(0)).count() == len(rows)


def brute_short(text, items, threshold=0.8):
    """As ``brute``, for the items that are longer than the text: the whole text is the window."""
    w, out = D.words_of(text), {}
    for i, t in items:
        x = D.words_of(t)
        k = min(5, len(x))
        if len(w) < len(x):
            own, win = (Counter(tuple(y[j:j + k]) for j in range(len(y) - k + 1)) for y in (x, w))
            sim = sum((own & win).values()) / sum((own | win).values())
            if sim >= threshold:
                out[i] = sim, 0
    return out


def test_text_shorter_than_the_item(spark):
    rng = random.Random(19)
    x = words(rng, 59).split()
    index = D.Index(((7, " ".join(x)),))
    assert index.matches(" ".join(x[:30] + x[31:]), 0.8) == {7: (50 / 59, 0)}  # 5 of 55 are lost, 4 are new
    assert index.matches(" ".join(x[:57] + x[58:]), 0.8) == {7: (53 / 56, 0)}
    assert index.matches(" ".join(x[3:]), 0.8) == {7: (52 / 55, 0)}
    vocabulary = words(rng, 200).split()
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.choice([2, 4, 5, 6, 9, 14, 25, 45, 59])))) for i in range(60)]
    texts = []
    for _, t in items * 12:
        w = t.split()
        at, n = rng.randrange(len(w)), rng.randrange(1, 6)
        texts.append(" ".join(rng.choice([w[:at] + w[at + 1:], w[n:], w[:-n], w[n // 2:-n]])))
    index, hits = D.Index(tuple(items)), 0
    for t in texts:
        want = brute_short(t, items)
        assert index.matches(t, 0.8) == brute(t, items) | want
        hits += len(want)
    assert hits > 200
    docs = spark.createDataFrame([(1, " ".join(x[3:])), (2, "clean")], "doc_id long, text string")
    bench = spark.createDataFrame([(7, " ".join(x))], "item_id long, text string")
    assert [r["doc_id"] for r in D.without_leaks(docs, bench).collect()] == [2]


def test_items_that_repeat_shingles_at_the_threshold():
    rng = random.Random(31)
    items, texts = [], []
    for i in range(400):
        period = rng.choice([1, 2, 3])
        base = [w + str(i) for w in words(rng, period).split(" ")]
        item = [base[j % period] for j in range(rng.randrange(27, 50))]
        edited = list(item)
        for j in range(rng.randrange(0, 4)):  # at an end, so that few shingles change
            edited[j if rng.random() < .5 else -1 - j] = f"new{j}"
        items.append((i, " ".join(item)))
        texts.append(f"{words(rng, 30)} {' '.join(edited)} {words(rng, 30)}")
    index, near = D.Index(tuple(items)), 0
    for i, (text, (_, item)) in enumerate(zip(texts, items)):
        w, x = text.split(), item.split()
        bag, best = Counter(zip(*(x[j:] for j in range(5)))), 0.0
        for a in range(len(w) - len(x) + 1):
            part = w[a:a + len(x)]
            common = sum((Counter(zip(*(part[j:] for j in range(5)))) & bag).values())
            best = max(best, common / (2 * (len(x) - 4) - common))
        near += 0.8 <= best < 0.9
        assert (i in index.matches(text, 0.8)) == (best >= 0.8), (text, item)
    assert near > 50
