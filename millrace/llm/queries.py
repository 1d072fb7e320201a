"""The operators as registered queries over whole tables, and their SQL where there is one."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import oracle, word_bpe
from millrace.llm.byte_bpe import digests, encode, read_ranks
from millrace.llm.common import read
from millrace.llm.html_extract import extract
from millrace.llm.language_id import fit, identify, remainder
from millrace.llm.lm_score import score, train
from millrace.llm.merkle import manifest
from millrace.llm.neighbours import nearest_neighbours
from millrace.llm.packing import pack_documents
from millrace.llm.simhash_dedup import simhash_components
from millrace.llm.sketch import fingerprint_edits
from millrace.llm.spelling import spelling_variants
from millrace.llm.substring_dedup import substring_dedup
from millrace.llm.url_filter import judge_urls, rule_table

RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)

PACK_VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
END_ID = 2
PIECES = public_tokenizers.path("piece_bpe_32k.model")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = substring_dedup(read(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


def op2_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_neighbours(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op3_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    scored = score(docs, train(docs, remainder(10) != 0, PIECES))
    held_out = F.coalesce(remainder(10) == 0, F.lit(False)).alias("held_out")
    return scored.select("doc_id", held_out, "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_edits(read(spark, sf_dir, "documents"))


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(read(spark, sf_dir, "documents"), PACK_VOCABULARY, END_ID)


def op6_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(read(spark, sf_dir, "documents"))


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(read(spark, sf_dir, "pages"), rule_table(spark, RULES))


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = read_ranks(RANKS)
    return digests(encode(read(spark, sf_dir, "documents"), ranks), ranks)


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(read(spark, sf_dir, "pages"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    found = identify(docs, fit(docs.filter(remainder(4) != 2)))
    return found.select("doc_id", F.coalesce(remainder(4) == 2, F.lit(False)).alias("held_out"), "lang_pred", "score", "ambiguous")


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each word of all texts that occurs often enough, with the more frequent spelling it stands for."""
    return spelling_variants(read(spark, sf_dir, "documents"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's leaf, proof and root, and whether the tampered leaf still leads to the root."""
    return manifest(read(spark, sf_dir, "documents")).drop("proof")


def op13_word_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Checksums of each text's ids and of what they decode to."""
    return word_bpe.digests(word_bpe.encode(read(spark, sf_dir, "documents"), WORD_BPE), WORD_BPE)


QUERIES = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_nearest_neighbours": op2_nearest_neighbours,
    "op3_lm_score": op3_lm_score,
    "op4_fingerprints": op4_fingerprints,
    "op5_best_fit_packing": op5_best_fit_packing,
    "op6_simhash_dedup": op6_simhash_dedup,
    "op7_url_filter": op7_url_filter,
    "op8_byte_bpe": op8_byte_bpe,
    "op9_html_extraction": op9_html_extraction,
    "op10_language_id": op10_language_id,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_word_bpe": op13_word_bpe,
}

ORACLE = {
    "op7_url_filter": r"""
WITH rules(verdict, rule_host, rule_path) AS (
    VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'),
           ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')
), split AS (
    SELECT row_number() OVER () AS n, page_id,
           translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''),
                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path
    FROM pages
), best AS (
    SELECT n, arg_max({'rule': rule_host || rule_path, 'verdict': verdict}, length(rule_host || rule_path)) AS r
    FROM split JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
    GROUP BY n
)
SELECT page_id, host, path, r.rule AS rule, coalesce(r.verdict, 'allow') AS verdict
FROM split LEFT JOIN best USING (n)
""",
    "op11_spelling_variants": oracle.SPELLING,
    "op12_merkle_manifest": oracle.MERKLE,
}
