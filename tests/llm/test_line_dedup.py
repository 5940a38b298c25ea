import random
from collections import Counter, defaultdict

from llm_data import SCHEMA, SF, empty_docs, odd_docs, words
from oracle_compare import compare, duck

from duelframe.llm import line_dedup as L
from duelframe.llm import queries


def brute(rows, ratio, least):
    """rows of (host, text) -> (text, lines, dropped)."""
    pages, seen = Counter(h for h, _ in rows), defaultdict(Counter)
    for h, t in rows:
        seen[h].update({x.strip(" ") for x in (t or "").split("\n")} - {""} if t is not None else ())
    out = []
    for h, t in rows:
        lines = [] if t is None else t.split("\n")
        bad = lambda x: seen[h][x] >= max(min(least, 2), min(least, pages[h])) and seen[h][x] > ratio * pages[h]
        kept = [x for x in lines if not x.strip(" ") or not bad(x.strip(" "))]
        out.append((None if t is None else "\n".join(kept), len(lines), len(lines) - len(kept)))
    return out


def test_matches_brute_force_with_a_hot_host(spark):
    rng = random.Random(4)
    pool = [words(rng, 5) for _ in range(30)]
    rows = []
    for i in range(300):
        host = "hot" if i % 3 == 0 else rng.choice(["a", "b", "c", None, ""])
        lines = [rng.choice(pool[:5] if rng.random() < .3 else pool) if rng.random() < .6 else words(rng, 4)
                 for _ in range(rng.randrange(8))]
        rows.append((i, rng.choice(["\n", "\n\n", "\n  "]).join(lines) if i % 17 else None, "en", host, 1))
    docs = spark.createDataFrame(rows, SCHEMA)
    want = brute([(r[3], r[1]) for r in rows], 0.1, 3)
    got = L.drop_boilerplate(docs, ratio=0.1, min_pages=3).orderBy("doc_id").collect()
    assert [(r["text"], r["n_lines"], r["n_dropped"]) for r in got] == want
    assert sum(w[2] for w in want) > 50


def test_small_hosts(spark):
    rows = [(100 * h + i, f"menu\n{h} {i}\n" + ("often\n" if i else ""), "en", f"host{h}", 1)
            for h in range(40) for i in range(1 + h % 6)]
    got = L.drop_boilerplate(spark.createDataFrame(rows, SCHEMA)).orderBy("doc_id").collect()
    assert [(r["text"], r["n_lines"], r["n_dropped"]) for r in got] == brute([(r[3], r[1]) for r in rows], L.RATIO, L.MIN_PAGES)
    for r in got:
        pages = 1 + int(r["source"][4:]) % 6
        assert ("menu" in r["text"]) == (pages == 1)  # on every page of a host with two or more


def test_same_result_when_nothing_is_broadcast(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    one = sorted(map(str, L.drop_boilerplate(docs, ratio=0.02, min_pages=2).collect()))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        assert sorted(map(str, L.drop_boilerplate(docs, ratio=0.02, min_pages=2).collect())) == one
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_plan_has_no_python(spark):
    plan = queries.op1_line_dedup(spark, SF)._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "InArrow"))


def test_query_matches_sql(spark):
    for sf in (SF, "/root/testdata/sf0.01"):
        assert not compare(queries.op1_line_dedup(spark, sf), duck(sf), queries.SQL["op1_line_dedup"])


def test_odd_rows(spark):
    docs = odd_docs(spark).withColumnRenamed("lang", "key").withColumnRenamed("n_chars", "drop")
    rows = docs.collect()
    got = L.drop_boilerplate(docs, ratio=0.1, min_pages=2)
    assert got.columns == [*docs.columns, "n_lines", "n_dropped"]
    want = brute([(r["source"], r["text"]) for r in rows], 0.1, 2)
    assert sorted(map(str, ((r["text"], r["n_lines"], r["n_dropped"]) for r in got.collect()))) == sorted(map(str, want))
    assert L.drop_boilerplate(empty_docs(spark)).count() == 0
