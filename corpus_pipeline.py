"""The corpus pipeline: five stages over ``documents``, each written and read again.

Language ID, near-duplicates, personal data, source mix, token ids. Every stage takes
(spark, docs, sf_dir) and works on all that its predecessor kept; all but the last return
the columns of ``documents``. Nulls, empty texts and repeated rows are treated as the
operators' docstrings say; columns beyond those of ``documents`` are dropped by the first stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.llm import bpe, language, mixing, pii, simhash
from shelfcast.llm.common import fresh_folder

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Reject what has no letters or lies between two languages; a missing ``lang`` is filled in."""
    model = language.learn(docs)
    found = language.identify(docs, model, COLUMNS[1:])
    kept = found.filter((F.col("lang_pred") != language.UNKNOWN) & ~F.col("ambiguous"))
    return kept.withColumn("lang", F.coalesce("lang", "lang_pred")).select(*COLUMNS)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: fingerprints of three-word shingles, linked at two differing bits or fewer."""
    return simhash.one_of_each(docs.select(*COLUMNS), width=3, radius=2)


def sanitised(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data masked, revealing terms generalised or removed."""
    clean = pii.sanitise(docs.select(*COLUMNS))
    return clean.withColumn("n_chars", F.when(F.col("text").isNotNull(), F.length("text").cast("long")))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each copy of a document that the mix takes, in training order."""
    return mixing.mixed_documents(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each row, decoded and compared with the text they come from."""
    return bpe.digests(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("language ID", known_language),
    ("SimHash near-dedup", one_of_each_group),
    ("PII", sanitised),
    ("mixing", mixed),
    ("BPE", token_ids),
]

# SQL cannot express SimHash trees or BPE; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each result but the last is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = fresh_folder(spark, "stage")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
