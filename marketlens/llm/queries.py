"""The operators' queries: each applies one operator to its whole table and shapes the result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.llm import jaccard_join, lang_id, ngram_lm, packing, pii, piece_codec, quality_rules, ranked_search, rp_forest, secret_scan, simhash_index, spelling_trie, token_counts
from marketlens.llm.common import id_crc, table

Query = Callable[[SparkSession, str], DataFrame]


def op1_pack_min_slack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op2_neighbours_rp_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rp_forest.nearest(table(spark, sf_dir, "embeddings"), F.pmod(F.col("vec_id"), F.lit(50)) == 0)


def op3_secrets_by_token_efficiency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.find_secrets(table(spark, sf_dir, "documents"))


def op4_score_ngram_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.pmod(id_crc("doc_id"), F.lit(7)) == 2
    return ngram_lm.score(docs, ~held_out).withColumn("held_out", held_out)


def op5_count_tokens_transducer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"))


def op6_pii_bilstm_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_pii(table(spark, sf_dir, "documents"))


def op7_sentencepiece_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_codec.encode_digests(table(spark, sf_dir, "documents"))


def op8_weak_supervision_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.score_quality(table(spark, sf_dir, "documents"))


def op9_rank_order_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.pmod(id_crc("doc_id"), F.lit(3)) == 1
    found = lang_id.identify(docs.withColumn("_held", held_out), ~F.col("_held"))
    return found.select("doc_id", (F.pmod(id_crc("doc_id"), F.lit(3)) == 1).alias("held_out"), "lang_pred", "score")


def op10_jaccard_divide_skip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicate_components(table(spark, sf_dir, "documents"))


def op11_simhash_byte_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_index.near_duplicate_components(table(spark, sf_dir, "documents"))


def op12_spelling_frequency_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_trie.spelling_forms(table(spark, sf_dir, "documents"))


def op13_ranked_search_term_owners(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Query] = {f.__name__: f for f in (
    op1_pack_min_slack, op2_neighbours_rp_forest, op3_secrets_by_token_efficiency, op4_score_ngram_trie,
    op5_count_tokens_transducer, op6_pii_bilstm_crf, op7_sentencepiece_digests, op8_weak_supervision_quality, op9_rank_order_language, op10_jaccard_divide_skip,
    op11_simhash_byte_positions, op12_spelling_frequency_trie, op13_ranked_search_term_owners)}
#: Queries that SQL can express.
ORACLE_SQL: dict[str, str] = {
    "op13_ranked_search_term_owners": r"""
WITH doc_terms AS (
  SELECT row_number() OVER () AS doc, doc_id,
    regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents),
item_terms AS (
  SELECT item, any_value(item_id) AS item_id, term, count(*) AS q FROM (
    SELECT row_number() OVER () AS item, item_id,
      unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM benchmark) GROUP BY item, term),
sized AS (SELECT doc, doc_id, terms, len(terms) AS n FROM doc_terms WHERE len(terms) > 0),
totals AS (SELECT count(*) AS docs, sum(n)::BIGINT AS len_all FROM sized),
postings AS (SELECT doc, term, count(*) AS tf FROM (SELECT doc, unnest(terms) AS term FROM sized) GROUP BY doc, term),
weights AS (SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM postings, totals GROUP BY term, docs),
scored AS (
  SELECT i.item, any_value(i.item_id) AS item_id, p.doc, any_value(d.doc_id) AS doc_id,
    sum(i.q * w.w * ((1000000000 * p.tf) // (1000 * p.tf + 12 * (75 + (25 * d.n * t.docs) // t.len_all))))::BIGINT AS score
  FROM item_terms i JOIN weights w USING (term) JOIN postings p USING (term) JOIN sized d ON d.doc = p.doc CROSS JOIN totals t
  GROUP BY i.item, p.doc),
ranked AS (SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id, doc)::INTEGER AS rank FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 20
""",
}
