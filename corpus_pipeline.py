"""The corpus pipeline: quality rules, line dedup, near-dedup, personal data, packing.

Each stage takes (spark, docs, sf_dir) and works on every document its
predecessor kept; all but the last return the columns of ``documents``.
``run`` writes each stage's result to the shared folder and reads it back, so a
lost executor never costs more than one stage.  Documents without anything to
remove pass the stages unchanged; an empty table packs to no rows.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emberlog.llm import line_dedup, near_dup, packing, pii, quality
from emberlog.llm.common import stored, table

CAPACITY = 1024
END_ID = 2
NEAR_WORDS = 5

#: SQL cannot choose cutoffs by binomial bounds or tokenize; the tests hold the stages against brute force.
ORACLE_SQL = None


def _measured(docs: DataFrame) -> DataFrame:
    """``n_chars`` of the texts as they are now."""
    return docs.withColumn("n_chars", F.length(F.coalesce("text", F.lit(""))).cast(docs.schema["n_chars"].dataType))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: documents that the rules reject go."""
    return quality.keep(docs, table(spark, sf_dir, "labels"))


def drop_common_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: later copies of common blocks go, and documents that lose all their words."""
    cleaned = line_dedup.clean(docs)
    emptied = (F.size("removed") > 0) & ~F.coalesce(F.col("text"), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    return _measured(cleaned.where(~emptied).select(*docs.columns))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: of each group of near duplicates the document with the smallest id stays."""
    return near_dup.deduplicate(docs, NEAR_WORDS)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: personal data is replaced by its kind."""
    return _measured(pii.mask(docs))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: token sequences, one row per piece of a document."""
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=END_ID, capacity=CAPACITY, id_bits=16)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", drop_common_lines),
    ("near_dedup", near_duplicates),
    ("personal_data", personal_data),
    ("best_fit_packing", best_fit_packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
