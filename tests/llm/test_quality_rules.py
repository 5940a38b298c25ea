import re
from collections import Counter

import numpy as np
from llm_data import SF, empty_docs, odd_docs

from duelframe.llm import quality_rules as Q
from duelframe.llm import queries

LARGER = "/root/testdata/sf0.01"


def brute(text):
    t = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    times = Counter(zip(w, w[1:], w[2:]))
    covered = {i + k for i, x in enumerate(zip(w, w[1:], w[2:])) if times[x] > 1 for k in range(3)}
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return [len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered)]


def test_counts_by_definition():
    texts = [None, "", " \n ", "a b c", "a b c a b c", "a a a a", "x\nx\n\n \nx\ny", "#*$ %&|<> é\xa0漢 \U0001f600",
             "a b c d a b c e a b", "\x0b\x0c\r\x1c\x85"]
    for t in texts:
        assert Q.statistics(t)[0] == brute(t), t


def test_scores_are_path_lengths():
    rng = np.random.default_rng(0)
    x = rng.normal(0, 0.05, (400, len(Q.FEATURES))) + 0.3
    forest = Q.grow(x, np.zeros(len(Q.FEATURES)), np.ones(len(Q.FEATURES)), trees=20)

    def walk(row, t):
        node, depth = 0, 0
        while forest.column[t, node] >= 0:
            side = forest.left if row[forest.column[t, node]] < forest.cut[t, node] else forest.right
            node, depth = side[t, node], depth + 1
        return forest.length[t, node]

    want = [2 ** (-np.mean([walk(r, t) for t in range(20)]) / Q._expected(forest.rows)) for r in x[:30]]
    assert np.allclose(forest.scores(x[:30]), want)
    assert forest.scores(np.full((1, len(Q.FEATURES)), 0.9))[0] > forest.scores(x).max()


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{LARGER}/documents.parquet")
    labels = spark.read.parquet(f"{LARGER}/labels.parquet")
    forest = Q.fit(docs, labels.where("doc_id % 2 = 0"))
    rest = Q.judge(docs.join(labels.where("doc_id % 2 = 1"), "doc_id"), forest).where("not base_failed")
    r = rest.selectExpr("avg(if(quality = 1, double(kept), null))", "avg(if(quality = 0, double(not kept), null))").first()
    assert r[0] >= 0.97 and r[1] >= 0.8, r


def test_query_matches_brute_force(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    forest = Q.fit(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    got = queries.op9_quality_rules(spark, SF).collect()
    assert len(got) == len(texts)
    for r in got:
        counts, x = Q.statistics(texts[r["doc_id"]])
        assert [r[c] for c in Q.COUNTS] == counts == brute(texts[r["doc_id"]])
        failed = counts[0] < 50 or 100 * counts[4] > 50 * counts[0]
        assert r["base_failed"] == failed
        assert r["kept"] == (not failed and not forest.scores(np.array([x]))[0] > forest.threshold)


def test_odd_rows_and_labels(spark):
    docs = odd_docs(spark)
    labels = spark.createDataFrame([(5, 1, 0), (5, 0, 0), (None, 1, 0), (9, None, 0), (7, 3, 0), (4, 1, None)],
                                   "doc_id long, quality int, toxic int")
    forest = Q.fit(docs, labels)
    got = Q.judge(docs.withColumnRenamed("lang", "kept"), forest, prefix="q_")
    assert got.count() == docs.count()
    assert got.where("text is null").selectExpr("max(q_n_words)", "bool_and(q_base_failed)").first()[:] == (0, True)
    none = Q.fit(docs, labels.limit(0))
    assert none.threshold == np.inf
    assert Q.judge(empty_docs(spark), Q.fit(empty_docs(spark), labels)).count() == 0


def test_model_and_threshold_use_every_labelled_document(spark):
    """More labelled documents than the 6,000 once sampled: all count in the leaves, the ranges and the threshold."""
    rng = np.random.default_rng(1)
    words = np.array(["the", "a.", "House", "river,", "42", "green", "walked", "stone;", "over", "night"])
    texts = [" ".join(rng.choice(words, 55)) for _ in range(6500)]
    texts += [" ".join(rng.choice(["#", "zz$", "&", "9|9", *words[:2 + i % 5]], 55)) for i in range(400)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i < 6500)) for i in range(len(texts))], "doc_id long, quality int")
    forest = Q.fit(docs, labels)
    x, good = np.array([Q.statistics(t)[1] for t in texts]), np.arange(len(texts)) < 6500
    assert forest.rows == 6500
    held = np.array([np.bincount(node, minlength=forest.column.shape[1]) for node in forest.leaves(x[good])])
    assert np.array_equal(forest.counted(held).length, forest.length)
    assert forest.threshold == Q.calibrated(forest.scores(x), good, 0.995) < np.inf
    kept = {r["doc_id"]: r["kept"] for r in Q.judge(docs, forest).where("not base_failed").collect()}
    assert all(kept[i] == (not s > forest.threshold) for i, s in enumerate(forest.scores(x)) if i in kept)
