"""Registered queries of the subpackage: each applies one operator to its whole table."""

from __future__ import annotations

import corpus_pipeline
import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from emberline.llm.bpe import encoded_digests
from emberline.llm.common import read_table
from emberline.llm.license_scan import scan_licenses
from emberline.llm.merkle import manifest
from emberline.llm.ngram_join import ngram_components
from emberline.llm.oracles import merkle_sql, mix_sql, trie_sql
from emberline.llm.packing import pack_documents
from emberline.llm.prefix_trie import prefix_trie
from emberline.llm.quality_classifier import quality_classifier
from emberline.llm.quality_rules import quality_rules
from emberline.llm.secret_scan import scan_secrets
from emberline.llm.source_mix import mix_sources
from emberline.llm.topk_search import QUERY_STEP, top_k
from emberline.llm.url_filter import TERMS, filter_urls
from emberline.llm.warc import read_records, write_archives
from emberline.plans.registry import Query


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "posterior")


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(read_table(spark, sf_dir, "documents"))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(read_table(spark, sf_dir, "pages"))


_OP3_SQL = f"""
WITH rests AS (
 SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) END AS rest FROM pages
), parts AS (
 SELECT page_id,
  coalesce(translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
  coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path
 FROM rests
), rules(action, rule_host, rule_path) AS (
 VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')
), fits AS (
 SELECT *, (SELECT arg_max(struct_pack(rule := rule_host || rule_path, action := action), length(rule_host || rule_path))
  FROM rules WHERE (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)) AS best
 FROM parts
)
SELECT page_id, host, path, best.rule AS rule,
 coalesce(best.action, CASE WHEN regexp_matches(host, '{"|".join(TERMS)}') THEN 'block' ELSE 'allow' END) AS verdict
FROM fits"""


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(read_table(spark, sf_dir, "documents"))


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                          added_tokens=True)


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_records(write_archives(read_table(spark, sf_dir, "pages")), payloads=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


_OP7_SQL = """
WITH payloads AS (
 SELECT page_id, sha1(coalesce(html, '')) AS digits, strlen(coalesce(html, '')) AS payload_bytes FROM pages
), digests AS (
 SELECT page_id, payload_bytes, array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
  1 + (CAST('0x' || substr(digits, CAST(1 + 5 * (i // 4) AS BIGINT), 5) AS BIGINT) >> CAST(15 - 5 * (i % 4) AS INT)) % 32, 1)
  for i in range(32)], '') AS payload_digest
 FROM payloads
), marked AS (
 SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS last FROM digests
)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
 CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
 CASE WHEN page_id <> last THEN last END AS refers_to
FROM marked"""


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoded_digests(read_table(spark, sf_dir, "documents"),
                           public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_components(read_table(spark, sf_dir, "documents"))


_OP9_SQL = r"""
WITH RECURSIVE words AS (
 SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
 FROM documents
), lists AS (
 SELECT doc_id, CASE WHEN w IS NULL OR len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
  ELSE list_distinct([w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3] for i in range(1, len(w) - 2)]) END AS s
 FROM words
), sizes AS (
 SELECT doc_id, CAST(len(s) AS BIGINT) AS n FROM lists
), shingles AS (
 SELECT doc_id, unnest(s) AS shingle FROM lists
), common AS (
 SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS shared FROM shingles a JOIN shingles b USING (shingle) GROUP BY ALL
), links AS (
 SELECT x, y FROM common JOIN sizes a ON a.doc_id = x JOIN sizes b ON b.doc_id = y
 WHERE x <> y AND 100 * shared >= 85 * (a.n + b.n - shared)
), reached(doc_id, other) AS (
 SELECT doc_id, doc_id FROM documents
 UNION SELECT r.doc_id, l.y FROM reached r JOIN links l ON l.x = r.other
)
SELECT doc_id, n AS n_shingles, min(other) AS component_id FROM sizes JOIN reached USING (doc_id) GROUP BY ALL"""


def op10_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % QUERY_STEP == 0)


_OP10_SQL = """
WITH vectors AS (
 SELECT vec_id, [CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT) for x in embedding] AS v FROM embeddings
 WHERE embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
), scores AS (
 SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_sum([p[1] * p[2] for p in list_zip(q.v, c.v)]) AS BIGINT) AS score
 FROM vectors q JOIN vectors c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM scores QUALIFY rank <= 20"""


def op11_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken", "copies")


#: Fixed values of the result contracts of op12 and op13.
_GROUP, _LOAN, _TAMPER = 20, 4, 3


def _crc32(column: str) -> Column:
    return F.crc32(F.col(column).cast("string").cast("binary"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(read_table(spark, sf_dir, "conversations"), _GROUP, _crc32("conv_id") % _LOAN, _LOAN - 1)


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest(read_table(spark, sf_dir, "documents"), _crc32("doc_id") % _TAMPER == 0)


#: Those without SQL are tested against brute force, round trips or held-out rows in tests/llm.
QUERIES: dict[str, Query] = {
    "op1_quality_rules": Query(op1_quality_rules, None),
    "op2_secret_scan": Query(op2_secret_scan, None),
    "op3_url_filter": Query(op3_url_filter, _OP3_SQL),
    "op4_quality_classifier": Query(op4_quality_classifier, None),
    "op5_license_scan": Query(op5_license_scan, None),
    "op6_best_fit_packing": Query(op6_best_fit_packing, None),
    "op7_warc": Query(op7_warc, _OP7_SQL),
    "op8_byte_bpe": Query(op8_byte_bpe, None),
    "op9_ngram_join": Query(op9_ngram_join, _OP9_SQL),
    "op10_exact_topk": Query(op10_exact_topk, _OP10_SQL),
    "op11_source_mix": Query(op11_source_mix, mix_sql()),
    "op12_prefix_trie": Query(op12_prefix_trie, trie_sql()),
    "op13_merkle_manifest": Query(op13_merkle_manifest, merkle_sql()),
    "pipeline": Query(corpus_pipeline.run, corpus_pipeline.ORACLE_SQL),
}
