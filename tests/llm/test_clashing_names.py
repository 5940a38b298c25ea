"""Extra columns named like an operator's own ones keep their values or are refused by name."""
import pytest
from llm_data import odd_docs
from public_tokenizers import PATTERN
from pyspark.sql import functions as F

from duelframe.llm import byte_bpe, line_dedup, queries, sharding, simhash_dedup, url_filter


def extras(df, names):
    return df.select("*", *[F.concat(F.lit(f"{n}/"), F.coalesce(F.col(df.columns[0]).cast("string"), F.lit("-"))).alias(n)
                            for n in names])


def same(plain, clashing, names):
    """The result without extra columns, and each extra column's values beside their row's id."""
    assert [c for c in clashing.columns if c not in names] == plain.columns
    assert sorted(map(str, clashing.select(*plain.columns).collect())) == sorted(map(str, plain.collect()))
    for r in clashing.collect():
        assert [r[n] for n in names] == [f"{n}/{'-' if r[0] is None else r[0]}" for n in names]


LINES = ["__of", "__drop", "__lines", "__keys", "__hit", "__kept", "host", "pages", "key", "n", "drop", "of"]


def test_line_dedup(spark):
    docs = odd_docs(spark).withColumn("text", F.concat_ws("\n", "text", F.lit("all rights reserved")))
    same(line_dedup.drop_boilerplate(docs), line_dedup.drop_boilerplate(extras(docs, LINES)), LINES)
    with pytest.raises(ValueError, match="n_lines"):
        line_dedup.drop_boilerplate(extras(docs, ["N_Lines"]))


def test_sharding(spark):
    docs, names = odd_docs(spark), ["__slot", "__slot_"]
    same(sharding.place(docs, ["a", "b"], size=7), sharding.place(extras(docs, names), ["a", "b"], size=7), names)
    docs = odd_docs(spark)
    same(sharding.place(docs, ["a", "b"], size=7, slot="__slot"),
         sharding.place(extras(docs, ["__slot_"]), ["a", "b"], size=7, slot="__slot"), ["__slot_"])
    with pytest.raises(ValueError, match="shard"):
        sharding.place(extras(docs, ["shard"]), ["a", "b"])


SIMHASH = ["__id", "__key", "doc_id_", "text_key", "fp", "component_id", "root", "least", "node", "repeated", "key", "n"]


def test_simhash_dedup(spark):
    docs = odd_docs(spark)
    same(simhash_dedup.keep_one(docs), simhash_dedup.keep_one(extras(docs, SIMHASH)), SIMHASH)


URLS = ["by_rule", "__bad", "src", "dst", "kind", "mass", "weight", "way", "share", "allowed", "blocked"]


def test_url_filter(spark):
    pages = spark.createDataFrame(
        [(1, "http://a.com/de/", ""), (2, "http://b.com/x", '<a href="http://a.com/de/">'), (3, "http://b.com/x", None),
         (4, "http://c.org/", '<a href="http://d.net/">'), (5, None, None)], "page_id long, url string, html string")
    same(url_filter.judge(pages), url_filter.judge(extras(pages, URLS)), URLS)
    replaced = url_filter.judge(extras(pages, ["host", "path", "rule", "verdict"]))
    same(url_filter.judge(pages), replaced, [])


def test_byte_bpe(spark):
    docs, names = odd_docs(spark), ["rank", "pieces", "token_id"]
    code = lambda df, **how: byte_bpe.encode(df, queries.VOCABULARY, PATTERN, **how)
    one, two = code(docs), code(extras(docs, names))
    same(one, two.select(*docs.drop("text").columns, "token_ids", *names), names)
    for bad in ("token_ids", "Token_IDs", "back"):
        with pytest.raises(ValueError, match=bad.lower()):
            code(extras(docs, [bad]), decoded_as="back")
    with pytest.raises(ValueError, match="decoded"):
        byte_bpe.decode(extras(one, ["decoded"]), queries.VOCABULARY)
    assert code(docs, ids="text").columns == [*docs.drop("text").columns, "text"]


def test_a_pattern_that_joins_words_is_not_cut_at_spaces(spark):
    whole = byte_bpe.coder(queries.VOCABULARY, r"[\s\S]+")
    text = "to be or not to be"
    assert whole.encode(text) == whole.encode_pieces(text) and whole.decode(whole.encode(text)) == text.encode()
    fast, slow = (byte_bpe.coder(queries.VOCABULARY, PATTERN, cut) for cut in (True, False))
    for t in ("", " a  b c ", "x y\n z", text * 9):
        assert fast.encode(t) == slow.encode(t)
