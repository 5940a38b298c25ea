import hashlib
from collections import Counter

import pytest
from llm_data import SF, empty_docs, odd_docs
from oracle_compare import compare, duck

from duelframe.llm import queries
from duelframe.llm import sharding as P


def digest(text):
    return int(hashlib.md5(text.encode()).hexdigest()[:13], 16)


def brute_table(shards, size):
    """By whole permutations: on its turn a shard takes the first free slot of its list."""
    wishes = {s: [(digest(f"{s}/first") % size + j * (digest(f"{s}/stride") % (size - 1) + 1)) % size
                  for j in range(size)] for s in shards}
    assert all(sorted(w) == list(range(size)) for w in wishes.values())
    owner, turn = {}, 0
    while len(owner) < size:
        s = shards[turn % len(shards)]
        owner[next(x for x in wishes[s] if x not in owner)] = s
        turn += 1
    return [owner[i] for i in range(size)]


def test_table_by_definition():
    for n, size in ((1, 7), (3, 101), (7, 211)):
        names = [f"s{i}" for i in range(n)]
        assert P.lookup_table(names, size) == brute_table(names, size)


def test_even_and_stable():
    names = [f"s{i}" for i in range(16)]
    table = P.lookup_table(names)
    shares = Counter(table).values()
    assert max(shares) - min(shares) <= 1
    fewer = P.lookup_table(names[:-1])
    moved = sum(a != b for a, b in zip(table, fewer) if a != "s15")
    assert moved < 0.2 * len(table)


@pytest.mark.parametrize("bad", [([], 7), (["a", "a"], 7), (["a"], 8), (["a", "b", "c"], 2)])
def test_bad_arguments(bad):
    with pytest.raises(ValueError):
        P.lookup_table(*bad)


def test_query_matches_brute_force(spark):
    table = brute_table(queries.SHARDS, P.SLOTS)
    got = queries.op2_sharding(spark, SF).collect()
    assert len(got) == spark.read.parquet(f"{SF}/documents.parquet").count()
    for r in got:
        assert r["slot"] == digest(str(r["doc_id"])) % P.SLOTS and r["shard"] == table[r["slot"]]
    assert "BroadcastHashJoin" in queries.op2_sharding(spark, SF)._jdf.queryExecution().toString()


def test_query_matches_sql(spark):
    assert not compare(queries.op2_sharding(spark, SF), duck(SF), queries.SQL["op2_sharding"])


def test_odd_rows(spark):
    docs = odd_docs(spark).withColumnRenamed("lang", "slot")
    with pytest.raises(ValueError):
        P.place(docs, ["a"])
    got = P.place(docs, ["a", "b", "c"], slot="s", shard="t")
    assert got.count() == docs.count() and got.where("t is null").count() == 0
    assert got.where("doc_id is null").select("t").distinct().count() == 1
    assert got.where("doc_id = 5").select("t").distinct().count() == 1
    assert P.place(docs, ["a", "b", "c"], ["doc_id", "text"], slot="s", shard="t").count() == docs.count()
    assert P.place(empty_docs(spark), ["a"]).count() == 0
