"""Corpus pipeline: from raw documents to packed training windows.

``STAGES`` run in order over ``documents``; each is written as Parquet under
the shared folder and read again by the next, and works on all that the one
before kept. All but the last return the columns of ``documents``. Null texts,
empty tables, repeated rows and further columns are handled by each stage's
operator as its docstring says.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from contrail.llm.common import read_table, stage
from contrail.llm.queries import tokenizer_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the robust outlier test accept."""
    from contrail.llm.quality_rules import keep_good
    return keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates (80 % of their word shingles)."""
    from contrail.llm.near_dup import WORD_PERCENT, keep_one_each
    return keep_one_each(docs, percent=WORD_PERCENT)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that leak no item of ``benchmark``."""
    from contrail.llm.decontaminate import drop_leaks
    return drop_leaks(docs, read_table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by the name of its kind."""
    from contrail.llm.pii import redact_documents
    return redact_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' ids in windows of 1024: one row per piece."""
    from contrail.llm.packing import pack_documents
    return pack_documents(docs, tokenizer_path())


STAGES = [("quality_rules", quality_rules), ("near_duplicates", near_duplicates),
          ("decontamination", decontamination), ("personal_data", personal_data), ("packing", packing)]

# No SQL expresses the robust estimate, the redaction's parsers, tokenising or
# packing; tests/llm/test_pipeline.py holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for k, (name, fn) in enumerate(STAGES):
        docs = fn(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = stage(docs, f"pipeline-{name}")
    return docs
