"""From documents to token files: five stages, each a distributed job over all rows that the one before kept.

A stage is written as Parquet into the shared checkpoint folder and read again by the next one, so a lost
executor never costs more than tasks of the stage that runs.  All stages but the last return the columns of
``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from wattlane.llm import decontamination, language, mixing, near_duplicates, token_files
from wattlane.llm.queries import table, tokenizer_path
from wattlane.llm.texts import remainder
from wattlane.session import scratch_path, ship_package

#: Posterior below which a document's language counts as unknown.
SURE = 0.5


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter or without a likely language go; all stay where no document has a language."""
    model = language.fit(docs.where(remainder("doc_id", 4) != 2))
    if not model.languages:
        return docs
    told = language.predict(spark, docs, model)
    known = (F.col("lang_pred") != language.UNDETERMINED) & (F.col("score") >= SURE)
    return told.where(known).select(docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays, that of the smallest doc_id; a document is a doc_id and a text."""
    return near_duplicates.one_of_each(docs, width=5)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    marked = decontamination.mark(spark, docs, table(spark, sf_dir, "benchmark"))
    return marked.where(F.size("leaks") == 0).select(docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights: a document comes as often as it is taken, or not at all."""
    return mixing.mixed(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files, and what was read back from them: a row per document."""
    return token_files.encode(spark, docs, tokenizer_path())


STAGES = [
    ("language_id", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", decontaminate),
    ("source_mixing", mix_sources),
    ("token_files", write_tokens),
]

#: Trained models, signatures and random rounding have no SQL form; tests/llm checks the stages by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    ship_package(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
