"""One query for each operator of this subpackage, over its whole intended table."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import bpe_round_trip
from .embedding_dedup import near_duplicate_vectors
from .fill_in_middle import fill_in_middle, restored
from .filter_audit import filter_audit
from .html_extraction import extract_main_text
from .language_id import held_out, learn_languages, predict_languages
from .license_scan import scan_licenses
from .mixing import mix_schedule
from .ngram_join import near_duplicates
from .oracle import ORACLE_SQL, URL_ENTRIES
from .quality import line_first_quality
from .storage import shared_dir
from .substring_dedup import remove_duplicate_spans
from .token_store import read_store, store_documents
from .url_filter import url_host, url_verdicts


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(_table(spark, sf_dir, "documents"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, vocabulary = _table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    names, probabilities = learn_languages(docs.filter(~held_out()), vocabulary)
    out = predict_languages(docs, vocabulary, names, probabilities)
    return out.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table has no dates: page p is fetched on day 37 p mod 366 of 2024. Beside the fixed
    entries a list blocks every eleventh host by its md5 from its day on, half of them for 120 days.
    """
    pages = _table(spark, sf_dir, "pages").select("page_id", "url")
    day = F.date_add(F.lit("2024-01-01").cast("date"), F.pmod(F.col("page_id") * 37, F.lit(366)).cast("int"))
    captures = pages.withColumn("fetched", day)
    hosts = pages.select(url_host(F.col("url")).alias("rule")).filter("rule IS NOT NULL").distinct().withColumn("c", F.conv(F.substring(F.md5("rule"), 1, 8), 16, 10).cast("long")).filter("c % 11 = 0")
    listed = hosts.select(F.lit("hosts").alias("list"), "rule", F.lit(True).alias("blocks"), F.explode(F.when(F.col("c") % 2 == 0, F.array(F.lit(True), F.lit(False))).otherwise(F.array(F.lit(True)))).alias("adds"), "c")
    listed = listed.select("list", "rule", "blocks", "adds", (F.col("c") % 300 + F.when(F.col("adds"), 0).otherwise(120)).cast("int").alias("day"))
    fixed = spark.createDataFrame(list(URL_ENTRIES), "list string, rule string, blocks boolean, adds boolean, day int")
    entries = listed.unionByName(fixed).withColumn("at", F.date_add(F.lit("2024-01-01").cast("date"), F.col("day"))).drop("day")
    out = url_verdicts(captures, entries)
    return out.withColumn("fetched", F.date_format("fetched", "yyyy-MM-dd"))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_duplicate_spans(_table(spark, sf_dir, "documents"), digest=True)


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_schedule(_table(spark, sf_dir, "documents"))


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe_round_trip(docs, public_tokenizers.path("byte_bpe_50k.json"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_first_quality(docs)


def op8_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"))


def op9_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_vectors(_table(spark, sf_dir, "embeddings"))


def op10_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_dir(spark)}/token-store-{uuid.uuid4().hex}"
    store_documents(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), path, end_id=1)
    return read_store(spark, path, digest=True)


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op12_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main_text(_table(spark, sf_dir, "pages"))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = fill_in_middle(_table(spark, sf_dir, "documents"))
    digests = F.sha2("output", 256).alias("output_sha256"), F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256")
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *digests)


__all__ = ["ORACLE_SQL", "QUERIES"]

QUERIES = {
    "op1_license_scan": op1_license_scan,
    "op2_language_id": op2_language_id,
    "op3_url_filter": op3_url_filter,
    "op4_substring_dedup": op4_substring_dedup,
    "op5_mixing": op5_mixing,
    "op6_bpe": op6_bpe,
    "op7_quality_rules": op7_quality_rules,
    "op8_ngram_join": op8_ngram_join,
    "op9_embedding_dedup": op9_embedding_dedup,
    "op10_token_store": op10_token_store,
    "op11_filter_audit": op11_filter_audit,
    "op12_html_extraction": op12_html_extraction,
    "op13_fill_in_middle": op13_fill_in_middle,
}
