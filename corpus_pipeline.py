"""A corpus pipeline: five stages from raw documents to packed training sequences.

Each stage works on all that the one before kept; what it rejects is gone, and what
it redacts stays redacted.

Defined cases: without labels the classifier keeps everything; null and empty texts fail
the fixed quality rules and go; of rows that repeat an id, near-duplicate removal keeps
one, and rows with a null id all stay; of near copies the smallest id stays; texts of any
length are taken whole; columns other than doc_id, text, lang, source and n_chars pass
through whatever their names, and all but the last stage return the columns they were
given; an empty table gives no rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from chronopix.llm._common import discard, table, written
from chronopix.llm.ngram_join import one_of_each
from chronopix.llm.packing import pack_documents
from chronopix.llm.quality_classifier import good_documents
from chronopix.llm.quality_rules import kept_documents
from chronopix.llm.secrets import redact_secrets


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return good_documents(docs, table(spark, sf_dir, "labels"))


def apply_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return kept_documents(docs)


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return one_of_each(docs)


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return redact_secrets(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack_documents(docs)


STAGES = [
    ("quality classifier", classify),
    ("quality rules", apply_rules),
    ("n-gram Jaccard join", deduplicate),
    ("secret scans", redact),
    ("best-fit packing", pack),
]

#: Trained models and tokenizers can't be written in SQL; tests hold the pipeline
#: against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table."""
    docs, last = table(spark, sf_dir, "documents"), None
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs)
            if last is not None:
                discard(last)  # the stage that read it is written
            last = docs
    return docs
