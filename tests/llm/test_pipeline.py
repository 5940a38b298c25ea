import pytest
from llm_data import SCHEMA, SF, empty_docs, odd_docs
from test_decontaminate import brute as leaks
from test_line_dedup import brute as boilerplate
from test_quality_rules import brute as counts
from test_simhash_dedup import brute_fingerprint, brute_groups, joins_of

import corpus_pipeline as C
from duelframe.llm import line_dedup, queries
from duelframe.llm import quality_rules as Q

LARGER = "/root/testdata/sf0.01"


def test_whole_pipeline_against_its_steps(spark):
    docs = spark.read.parquet(f"{LARGER}/documents.parquet")
    forest = Q.fit(docs, spark.read.parquet(f"{LARGER}/labels.parquet"))
    rows = {}
    for r in docs.collect():
        n = counts(r["text"])
        _, x = Q.statistics(r["text"])
        if n[0] >= 50 and 2 * n[4] <= n[0] and not forest.scores(Q.np.array([x]))[0] > forest.threshold:
            rows[r["doc_id"]] = (r["source"], r["text"])
    ids = list(rows)
    cleaned = boilerplate([rows[i] for i in ids], line_dedup.RATIO, line_dedup.MIN_PAGES)
    texts = {i: t for i, (t, _, _) in zip(ids, cleaned)}
    groups = brute_groups([(i, brute_fingerprint(t)) for i, t in texts.items()])
    items = [tuple(r) for r in spark.read.parquet(f"{LARGER}/benchmark.parquet").select("item_id", "text").collect()]
    kept = [i for i, _, c in groups if i == c]
    vocabulary = [(i, t.lower()) for i, t in items]
    suspects = {i for i in kept if any(w in texts[i].lower() for _, t in vocabulary for w in (t[20:50], t[-50:-20]))}
    left = sorted(i for i in kept if not (i in suspects and leaks(texts[i], items)))
    got = {r["doc_id"]: r for r in C.run(spark, LARGER).collect()}
    assert sorted(got) == left
    assert 0 < len(left) < len(kept) < len(ids) < docs.count()
    want = queries.bpe_digests(spark.createDataFrame([(i, texts[i]) for i in left], "doc_id long, text string"))
    assert sorted(map(tuple, want.collect())) == sorted(map(tuple, got.values()))


@pytest.mark.parametrize("k", range(len(C.STAGES)))
def test_stages_keep_columns_and_take_odd_rows(spark, k):
    name, stage = C.STAGES[k]
    docs = odd_docs(spark)
    clash = docs.selectExpr("*", "source as fp", "1 as matches", "2 as kept", "3 as n_lines", "4 as key", "lang as drop")
    for d in (docs, clash, empty_docs(spark)):
        out = stage(spark, d, SF)
        if k + 1 < len(C.STAGES):
            assert out.columns == d.columns, name
        rows = out.count()
        assert rows <= d.count()
        if not d.limit(1).count():
            assert rows == 0


def test_near_duplicate_stage_broadcasts_no_list_of_documents(spark):
    docs = spark.createDataFrame([(i, f"some words {i % 40} that stand here", "en", "s", 1) for i in range(80)], SCHEMA)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")
        assert joins_of(C.near_duplicates(spark, docs, SF)) == ["SortMergeJoin"] * 2
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_line_stage_updates_n_chars(spark):
    rows = [(i, f"same line\nown line {i}", "en", "s", 99) for i in range(20)]
    out = C.lines(spark, spark.createDataFrame(rows, SCHEMA), SF).collect()
    assert all(r["text"] == f"own line {r['doc_id']}" and r["n_chars"] == len(r["text"]) for r in out)
