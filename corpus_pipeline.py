"""Corpus pipeline: five stages from raw documents to packed training sequences, each by one operator of harrow.llm.

A stage takes (spark, docs, sf_dir) and works on all that the stage before it kept; all but the last return the columns of
documents. Where a stage changes texts, n_chars follows. Null texts pass as they are; empty tables pass through.
"""

from __future__ import annotations

import uuid

from harrow.llm import common, jaccard, packing, quality, repeats, secrets
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: No SQL: the classifier, the tokenizer and best fit can't be expressed there; tests hold the stages against brute force.
ORACLE_SQL = None


def _counted(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else docs


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality classifier: documents scored below one half go. Learns from labels outside the held-out third.

    A null or empty text is scored as a text without words; rows without doc_id can't be learnt from but are scored; repeated rows
    share their fate; without any label all stay; an empty table stays empty.
    """
    common.bounded_batches(spark)
    learnt = lambda df: df.where(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(3)) != 1)
    model = quality.fit(learnt(docs), learnt(common.table(spark, sf_dir, "labels")))
    (score,) = common.unused(docs.columns, "score")
    return quality.score(docs, model, out=score).where(F.col(score) >= 0.5).select(*[F.col(f"`{c}`") for c in docs.columns])


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """N-gram Jaccard join over 5-word shingles at 0.8: of each component the document with the smallest doc_id stays.

    Null and empty texts and rows without doc_id stay; all rows of a doc_id share its fate; an empty table stays empty.
    """
    common.bounded_batches(spark)
    return jaccard.keep_first(docs, jaccard.Settings(n=5, num=80, den=100))


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Substring dedup: words in a 20-word window that occurs earlier are cut from the texts.

    Null and empty texts and rows without doc_id stay as they are; a row read twice is cut once, both ways alike; an empty table stays empty.
    """
    common.bounded_batches(spark)
    return _counted(repeats.without_repeats(docs))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secret scan: every span found is replaced by a mark. Null and empty texts stay as they are; an empty table stays empty."""
    common.bounded_batches(spark)
    return _counted(secrets.redacted(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Best-fit packing of the token sequences into rows of at most 1024 tokens: the columns of pack_documents().

    A null or empty text is one end token; every row is packed, repeated ones too; an empty table gives an empty result.
    """
    common.bounded_batches(spark)
    return packing.pack_documents(docs)


STAGES = [
    ("quality_classifier", keep_good), ("ngram_jaccard_join", drop_near_copies), ("substring_dedup", cut_repeats),
    ("secret_scan", redact_secrets), ("best_fit_packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result is written as Parquet to the shared folder and read again by the next."""
    docs = common.table(spark, sf_dir, "documents")
    root = f"{common.shared_dir(spark)}/llm/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        path = f"{root}/{name}"
        with common.shuffle_files_go(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
