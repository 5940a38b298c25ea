"""Registered queries of the training-data operators, and their SQL."""

from __future__ import annotations

from public_tokenizers import PATTERN
from public_tokenizers import path as tokenizer_path
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (byte_bpe, decontaminate, line_dedup, ngram_join, phrase_mining, quality_rules, secret_scan,
               sharding, simhash_dedup, suffix_dedup, url_filter, warc_zip, whitening)
from .common import read_table

VOCABULARY = tokenizer_path("byte_bpe_50k.tiktoken")


SHARDS = [f"shard-{i:02d}" for i in range(16)]


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without their source's boilerplate lines."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return line_dedup.drop_boilerplate(docs)


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shard of every document."""
    return sharding.place(read_table(spark, sf_dir, "documents").select("doc_id"), SHARDS)


def _joined(spans: str) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document: pattern spans and those that the CRF adds."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secret_scan.scan(docs, secret_scan.fit(docs)).select("doc_id", "secrets").withColumn(
        "base", F.filter("secrets", lambda s: s["kind"] != "crf"))
    count = lambda kind: F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long")
    return found.select("doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"),
                        count("hex").alias("n_hex"), F.sha2(_joined("base"), 256).alias("base_sha256"),
                        _joined("secrets").alias("spans"), count("crf").alias("n_crf"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The benchmark items that leaked into each document."""
    return decontaminate.leaks(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op6_warc_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page, written to ZIP-packaged WARC files and read back by byte ranges."""
    manifest = warc_zip.write_archives(read_table(spark, sf_dir, "pages"))
    records = warc_zip.read_records(warc_zip.record_ranges(manifest))
    return warc_zip.resolved(records)


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's URL, by rule or by its host's trust and distrust."""
    return url_filter.judge(read_table(spark, sf_dir, "pages").select("page_id", "url", "html")).select(
        "page_id", "host", "path", "rule", "verdict")


def op4_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents whose fingerprints differ in two bits or fewer."""
    groups = simhash_dedup.near_duplicates(read_table(spark, sf_dir, "documents"), shingle=3, max_bits=2)
    return groups.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def bpe_digests(docs: DataFrame) -> DataFrame:
    """Per document: token count and digests of its ids and of the decoded bytes."""
    back = byte_bpe.encode(docs.select("doc_id", "text"), VOCABULARY, PATTERN, decoded_as="decoded",
                           cut_at_spaces=True)
    return back.select("doc_id", F.expr("cast(octet_length(token_ids) div 4 as long)").alias("n_tokens"),
                       F.sha2("token_ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document, and what they decode to."""
    return bpe_digests(read_table(spark, sf_dir, "documents"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule statistics of every document and the verdict of base rules and forest."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    forest = quality_rules.fit(docs, read_table(spark, sf_dir, "labels"))
    return quality_rules.judge(docs, forest).select(
        "doc_id", *quality_rules.COUNTS, "base_failed", "kept", "score")


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without the 400-byte strings that occur elsewhere."""
    cut = suffix_dedup.remove_repeats(read_table(spark, sf_dir, "documents"), length=400)
    lost = F.aggregate("removed", F.lit(0).cast("long"), lambda n, r: n + r["b"] - r["a"])
    return cut.select("doc_id", "n_bytes", lost.alias("n_removed"), F.size("removed").cast("long").alias("n_spans"),
                      F.sha2("kept", 256).alias("kept_sha256"), F.octet_length("kept").cast("long").alias("n_kept"))


def op11_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents whose sets of five-word shingles have a Jaccard similarity of 0.8 or more."""
    rows = ngram_join.groups(read_table(spark, sf_dir, "documents"), size=5, percent=80)
    return rows.select("doc_id", F.col("n").cast("long").alias("n_shingles"), "component_id", "class_id")


def op12_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each language's first 2,000 collocations of two to five words."""
    found = phrase_mining.collocations(read_table(spark, sf_dir, "documents"), min_count=100, max_words=5)
    return phrase_mining.top(found, limit=2000)


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whitened coordinates of every embedding on the first eight components."""
    return whitening.whiten(read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), n_components=8)


QUERIES = {f.__name__: f for f in (op1_line_dedup, op2_sharding, op3_secret_scan, op4_simhash_dedup,
                                   op5_decontamination, op6_warc_zip, op7_url_filter, op8_byte_bpe,
                                   op9_quality_rules, op10_suffix_dedup, op11_ngram_jaccard_join,
                                   op12_phrase_mining, op13_embedding_whitening)}

LINE_DEDUP_SQL = f"""
WITH numbered AS MATERIALIZED (
  SELECT row_number() OVER () AS rn, doc_id, source, string_split(text, chr(10)) AS parts FROM documents
), lines AS (
  SELECT rn, doc_id, source, line, i, trim(line, ' ') AS key
  FROM (SELECT rn, doc_id, source, unnest(parts) AS line, generate_subscripts(parts, 1) AS i FROM numbered)
), pages AS (
  SELECT source, count(*) AS n FROM documents GROUP BY source
), bad AS (
  SELECT s.source, s.key
  FROM (SELECT source, key, count(DISTINCT rn) AS n FROM lines WHERE key <> '' GROUP BY source, key) s
  JOIN pages p ON s.source IS NOT DISTINCT FROM p.source
  WHERE s.n >= greatest(2, least({line_dedup.MIN_PAGES}, p.n)) AND s.n > {line_dedup.RATIO}::DOUBLE * p.n
), marked AS (
  SELECT l.*, b.key IS NOT NULL AS dropped
  FROM lines l LEFT JOIN bad b ON l.source IS NOT DISTINCT FROM b.source AND l.key = b.key
), kept AS (
  SELECT rn, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
         coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT dropped), '') AS text
  FROM marked GROUP BY rn
)
SELECT d.doc_id, d.source, k.text, coalesce(k.n_lines, 0)::BIGINT AS n_lines, coalesce(k.n_dropped, 0)::BIGINT AS n_dropped
FROM numbered d LEFT JOIN kept k USING (rn)
"""

WARC_SQL = f"""
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes,
         sha1(coalesce(html, '')) AS payload_digest FROM pages
), k AS (
  SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS keeper,
         count(*) OVER (PARTITION BY payload_digest, payload_bytes) AS n FROM p
), r AS (
  SELECT *, CASE WHEN payload_bytes >= {warc_zip.MIN_BYTES} AND n > 1 AND page_id IS DISTINCT FROM keeper
                 THEN keeper END AS refers_to FROM k
)
SELECT page_id, payload_bytes, payload_digest, refers_to, true AS digest_ok,
       CASE WHEN refers_to IS NULL THEN 'response' ELSE 'revisit' END AS record_type FROM r
"""

_HASH = "('0x' || substr(md5({}), 1, 13))::BIGINT"
SHARDING_SQL = f"""
WITH RECURSIVE wish AS (
  SELECT i, name, {_HASH.format("name || '/first'")} % {sharding.SLOTS} AS first,
         {_HASH.format("name || '/stride'")} % {sharding.SLOTS - 1} + 1 AS stride
  FROM (SELECT i, 'shard-' || lpad(i::VARCHAR, 2, '0') AS name FROM range({len(SHARDS)}) t(i))
), fill AS (
  SELECT 0 AS turn, repeat('.', {sharding.SLOTS}) AS taken, -1::BIGINT AS slot, '' AS shard
  UNION ALL
  SELECT f.turn + 1, f.taken[:x.slot] || '#' || f.taken[x.slot + 2:], x.slot, x.name
  FROM fill f, LATERAL (SELECT w.name, (w.first + j * w.stride) % {sharding.SLOTS} AS slot
                        FROM wish w, range({sharding.SLOTS}) t(j)
                        WHERE w.i = f.turn % {len(SHARDS)}
                          AND f.taken[(w.first + j * w.stride) % {sharding.SLOTS} + 1] = '.'
                        ORDER BY j LIMIT 1) x
  WHERE f.turn < {sharding.SLOTS}
)
SELECT d.doc_id, d.slot, f.shard
FROM (SELECT doc_id, {_HASH.format("coalesce(doc_id::VARCHAR, chr(92) || 'N')")} % {sharding.SLOTS} AS slot
      FROM documents) d JOIN fill f ON f.slot = d.slot
"""

JACCARD_SQL = r"""
WITH RECURSIVE docs AS (
  SELECT row_number() OVER () AS rn, doc_id,
         list_filter(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                        '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words FROM documents
), sets AS (
  SELECT rn, doc_id, coalesce(list_sort(list_distinct(
           CASE WHEN len(words) = 0 THEN []
                WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
                ELSE list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' ')) END)), []) AS s
  FROM docs
), classes AS MATERIALIZED (
  SELECT row_number() OVER () AS c, s, len(s) AS n, min(doc_id) AS least FROM sets WHERE len(s) > 0 GROUP BY s
), grams AS MATERIALIZED (
  SELECT c, n, unnest(s) AS g FROM classes
), links AS MATERIALIZED (
  SELECT a.c AS a, b.c AS b FROM grams a JOIN grams b ON a.g = b.g AND a.c < b.c
  WHERE 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
  GROUP BY a.c, b.c, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
), both_ways AS MATERIALIZED (
  SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reach AS (
  SELECT a AS c, b AS d FROM both_ways
  UNION
  SELECT r.c, e.b FROM reach r JOIN both_ways e ON r.d = e.a
), named AS (
  SELECT c.s, c.least, coalesce(least(c.least, min(o.least)), c.least) AS component_id
  FROM classes c LEFT JOIN reach r ON r.c = c.c LEFT JOIN classes o ON o.c = r.d GROUP BY c.s, c.least
)
SELECT t.doc_id, len(t.s)::BIGINT AS n_shingles, CASE WHEN len(t.s) = 0 THEN t.doc_id ELSE m.component_id END AS component_id,
       CASE WHEN len(t.s) = 0 THEN t.doc_id ELSE m.least END AS class_id
FROM sets t LEFT JOIN named m ON t.s = m.s
"""

PHRASES_SQL = r"""
WITH pieces AS (
  SELECT row_number() OVER () AS p, lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda w: w <> '') AS w
  FROM (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
          translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
          '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)
), counts AS MATERIALIZED (
  SELECT lang, m, phrase, count(*) AS f
  FROM (SELECT lang, m, unnest(list_transform(range(1, len(w) - m + 2), lambda i: array_to_string(w[i:i + m - 1], ' '))) AS phrase
        FROM pieces, range(1, 6) t(m) WHERE len(w) >= m)
  GROUP BY lang, m, phrase
), totals AS (
  SELECT lang, sum(f)::BIGINT AS n FROM counts WHERE m = 1 GROUP BY lang
), frequent AS MATERIALIZED (
  SELECT lang, m, phrase, f, string_split(phrase, ' ') AS w FROM counts WHERE f >= 100
), cuts AS (
  SELECT c.lang, c.m, c.phrase, c.f AS a, k, array_to_string(w[1:k], ' ') AS head, array_to_string(w[k + 1:], ' ') AS tail
  FROM frequent c, range(1, 5) t(k) WHERE c.m > 1 AND k < c.m
), scored AS (
  SELECT c.lang, c.phrase, c.a, c.k, l.f AS l, r.f AS r, t.n, (1000::HUGEINT * c.a * t.n) // (l.f::HUGEINT * r.f) AS score
  FROM cuts c JOIN frequent l ON l.lang = c.lang AND l.phrase = c.head
  JOIN frequent r ON r.lang = c.lang AND r.phrase = c.tail JOIN totals t ON t.lang = c.lang
), lowest AS (
  SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS i FROM scored
), covered AS (
  SELECT DISTINCT b.lang, b.phrase
  FROM (SELECT lang, f, unnest(flatten(list_transform(range(2, m), lambda s: list_transform(
               range(1, m - s + 2), lambda i: array_to_string(w[i:i + s - 1], ' '))))) AS phrase
        FROM frequent WHERE m > 2) x JOIN frequent b ON b.lang = x.lang AND b.phrase = x.phrase AND 100 * x.f >= 100 * b.f
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
  FROM lowest WHERE i = 1 AND (lang, phrase) NOT IN (SELECT lang, phrase FROM covered)
)
SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score FROM ranked WHERE rank <= 2000
"""

SQL: dict[str, str] = {"op12_phrase_mining": PHRASES_SQL,
                       "op11_ngram_jaccard_join": JACCARD_SQL, "op2_sharding": SHARDING_SQL, "op1_line_dedup": LINE_DEDUP_SQL, "op6_warc_zip": WARC_SQL}
