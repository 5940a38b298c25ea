import hashlib
import random

import numpy as np
import pytest
import tiktoken
from llm_data import SF, empty_docs, odd_docs
from public_tokenizers import PATTERN

from duelframe.llm import byte_bpe, queries


@pytest.fixture(scope="module")
def coder():
    return byte_bpe.coder(queries.VOCABULARY, PATTERN, cut_at_spaces=True)


@pytest.fixture(scope="module")
def oracle(coder):
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=coder.ranks, special_tokens={})


def ids(packed):
    return np.frombuffer(packed, "<u4").tolist()


def test_random_texts_match(coder, oracle):
    rng = random.Random(1)
    parts = ["th", "ing", " ", "  ", "e", "\n", "é", "\U0001f600", "=", "==", "1", "23", "'s", "一", "aaaa", "\x00",
             "\x1c", "\x85", " ", "ſ", "²", "<|endoftext|>"]
    texts = ["", " ", "a" * 5000, " " * 3000, "\n\n \n  x", "ab" * 999, "a \x1cb"]
    texts += ["".join(rng.choice(parts) for _ in range(rng.randrange(200))) for _ in range(500)]
    texts += ["".join(chr(rng.choice([rng.randrange(0x300), rng.randrange(0x2000, 0x2070)])) for _ in range(60))
              for _ in range(300)]
    for t in texts:
        assert ids(coder.encode(t)) == oracle.encode_ordinary(t), t
        assert coder.decode(coder.encode(t)) == t.encode()


def test_each_piece_is_the_merges_by_definition(coder):
    rng = random.Random(2)
    for _ in range(500):
        data = bytes(rng.choice(b"abcdeinorst\xc3\xa9 ") for _ in range(rng.randrange(1, 25)))
        if data not in coder.ranks:
            assert coder.encode_piece(data) == coder.merged(data)[0]


def test_memo_stays_bounded(monkeypatch):
    monkeypatch.setattr(byte_bpe, "CACHED_PIECES", 10)
    memo = byte_bpe._Memo(lambda key: key.encode())
    for i in range(100):
        assert memo[str(i % 30)] == str(i % 30).encode()
        assert len(memo) <= 10 and len(memo.old) <= 10


def test_query_on_whole_table(spark, oracle):
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = queries.op8_byte_bpe(spark, SF).collect()
    assert len(got) == len(docs)
    for r in got:
        want = oracle.encode_ordinary(docs[r["doc_id"]])
        assert r["n_tokens"] == len(want)
        assert r["ids_sha256"] == hashlib.sha256(np.array(want, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(docs[r["doc_id"]].encode()).hexdigest()


def test_odd_rows(spark, oracle):
    docs = odd_docs(spark).withColumnRenamed("lang", "decoded_")
    got = byte_bpe.decode(byte_bpe.encode(docs, queries.VOCABULARY, PATTERN), queries.VOCABULARY)
    rows = got.collect()
    assert len(rows) == docs.count() and "decoded_" in got.columns
    texts = sorted((r["text"] or "") for r in docs.collect())
    assert sorted(bytes(r["decoded"]).decode() for r in rows) == texts
    assert queries.bpe_digests(empty_docs(spark)).count() == 0
