"""The registered queries of the operators (production parameters, whole tables)."""

from __future__ import annotations

import os

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sftforge.llm import op1_license_scan as op1
from sftforge.llm import op2_hilbert_ann as op2
from sftforge.llm import op3_warc as op3
from sftforge.llm import op4_quality_classifier as op4
from sftforge.llm import op5_minhash_dedup as op5
from sftforge.llm import op6_substring_dedup as op6
from sftforge.llm import op7_quality_rules as op7
from sftforge.llm import op8_sharding as op8
from sftforge.llm import op9_best_fit_packing as op9
from sftforge.llm import op10_sentencepiece as op10
from sftforge.llm import op11_token_codes as op11
from sftforge.llm import op12_spelling_variants as op12
from sftforge.llm import op13_token_alignment as op13
from sftforge.llm.common import documents
from sftforge.sources.tables import table

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op4.classify(documents(spark, sf_dir), table(spark, sf_dir, "labels"))


@query
def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op7.measure_and_judge(documents(spark, sf_dir))


@query
def op5_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op5.classes(documents(spark, sf_dir)).select("doc_id", "class_id")


@query
def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op9.pack_documents(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


@query
def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op6.remove_repeats(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = public_tokenizers.path("piece_bpe_32k.model")
    coded = op10.encode(documents(spark, sf_dir), model)
    return coded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2(op10.decode(coded, model)("ids"), 256).alias("decoded_sha256"),
        F.coalesce(F.try_element_at("ends", F.lit(-1)), F.lit(0)).alias("covered_bytes"))


@query
def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op8.digest(op8.shard_table(spark, os.path.join(sf_dir, "documents.parquet")))


@query
def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op3.archive_round_trip(table(spark, sf_dir, "pages"))


# The digest in base 32: five hexadecimal digits make four of its digits.
ORACLE["op3_warc"] = """
WITH h AS (
  SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS x FROM pages),
d AS (
  SELECT page_id, octet_length(encode(html)) AS payload_bytes,
    array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST(
      (CAST('0x' || substr(x, 1 + 5 * (i // 4), 5) AS BIGINT) >> (5 * (3 - i % 4))) & 31 AS BIGINT), 1)
      FOR i IN range(0, 32)], '') AS payload_digest
  FROM h),
o AS (SELECT payload_digest, min(page_id) AS original FROM d GROUP BY payload_digest)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
  CASE WHEN page_id = original THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> original THEN original END AS refers_to
FROM d JOIN o USING (payload_digest)
"""


@query
def op2_hilbert_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op2.search(table(spark, sf_dir, "embeddings"), lambda vec_id: vec_id % 20 == 0)


@query
def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op1.scan(documents(spark, sf_dir), op1.production())


@query
def op11_token_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op11.round_trip(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


@query
def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op12.group_variants(documents(spark, sf_dir))


@query
def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op13.align(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"),
                      public_tokenizers.path("piece_bpe_32k.model"))
