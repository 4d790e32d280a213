"""Documents to token ids in five stages, each calling one operator of ``kinoframe.llm``.

A stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and
read again as the next one's docs. All but the last return the columns of ``documents``:

1. quality rules: rejected documents go, the others lose the lines that failed;
2. n-gram Jaccard join: of each group of near-duplicates the document with the smallest id stays;
3. substring dedup: duplicate spans are cut out; a document of which nothing is left goes;
4. mixing: a document stands as often as the mixture takes it, the last copy cut where the source's share ends;
5. BPE: token ids in place of the text.

n_chars follows the text. Rows that share an id are kept or dropped together by stage 2.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinoframe.llm.bpe import encode_bpe
from kinoframe.llm.mixing import mix
from kinoframe.llm.ngram_join import near_duplicates
from kinoframe.llm.quality import line_first_quality
from kinoframe.llm.storage import dropped, shared_dir
from kinoframe.llm.substring_dedup import remove_duplicate_spans

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _documents(df: DataFrame) -> DataFrame:
    return df.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    judged = line_first_quality(docs.select(*COLUMNS), cleaned=True)
    return _documents(judged.filter("kept").withColumn("text", F.col("clean_text")))


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    gone = near_duplicates(docs).filter("NOT kept").select("doc_id").distinct()
    return docs.select(*COLUMNS).join(gone, "doc_id", "left_anti").select(*COLUMNS)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # The same words go either way; beside the other stages the smaller index keeps executors small.
    cut = remove_duplicate_spans(docs.select(*COLUMNS), by_content=False)
    return _documents(cut.filter("n_words > n_removed").withColumn("text", F.col("kept_text")))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _documents(mix(docs.select(*COLUMNS)))


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return encode_bpe(docs.select("doc_id", "source", "text"), public_tokenizers.path("byte_bpe_50k.json"))


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("substring_dedup", substring_dedup),
    ("mixing", mixing),
    ("bpe_encoding", bpe_encoding),
]

#: SQL has no MinHash groups, byte-pair merges or shuffled mixture; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``: (doc_id, source, ids, n_tokens)."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    base = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for number, (name, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{base}/{number}-{name}")
        if number:
            dropped(docs)
        docs = spark.read.parquet(f"{base}/{number}-{name}")
    return docs
