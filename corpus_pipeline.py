"""From raw documents to token files: five corpus operators, one after the other.

Every stage takes (spark, docs, sf_dir) and works on all that its predecessor kept. All but the last return the
columns of documents, whatever they are; an empty table passes through.
"""

from pyspark.sql import DataFrame, SparkSession

from clicklake.llm import decontamination, mixing, near_duplicates, quality, token_files
from clicklake.llm.common import stored, table


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the byte-level classifier rejects go."""
    return quality.keep(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates stays."""
    return near_duplicates.distinct(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontamination.remove(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words of each source as often as its target weight asks for; a document may come more than once, or in part."""
    return mixing.mixed_documents(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files in the shared scratch folder, and what they hold of each document."""
    return token_files.encode_documents(docs)


STAGES = [
    ("quality_filter", quality_filter),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("mix_sources", mix_sources),
    ("token_output", token_output),
]

#: SQL can't express the first stage, nor the sampling of others.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to documents; each result is written and read again before the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
