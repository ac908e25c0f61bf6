"""From raw documents to training sequences, in five stages.

Each stage takes all rows that its predecessor kept, as ``(spark, docs, sf_dir)``, and all but
the last return the columns of ``documents``. Between stages rows are written to the shared
folder and read back. Empty tables pass through; null texts count as empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventflow.llm.common import read_table, stored
from eventflow.llm.decontaminate import drop_contaminated
from eventflow.llm.exact_dedup import drop_copies
from eventflow.llm.packing import pack
from eventflow.llm.quality import ACCEPT, score_quality
from eventflow.llm.queries import quality_weights
from eventflow.llm.simhash import drop_near_duplicates


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go. It learns from the labelled ones among ``docs``."""
    scored = score_quality(docs, quality_weights(spark, sf_dir, docs))
    return scored.where(F.col("quality_score") >= ACCEPT).select(*docs.columns)


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts one document stays."""
    return drop_copies(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near duplicates the document of the smallest id stays."""
    return drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    return drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left is packed into sequences; a row per piece."""
    return pack(docs)


STAGES = [
    ("quality", quality),
    ("exact_duplicates", exact_duplicates),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("packing", packing),
]
# SQL has neither the classifier nor the tokenizer; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
