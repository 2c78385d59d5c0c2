"""The registered queries of the text operators; each runs over its whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from wattlane.llm import (
    collocations,
    decontamination,
    fingerprints,
    language,
    licenses,
    main_text,
    mixing,
    near_duplicates,
    repeats,
    sharding,
    token_files,
    toxicity,
    whitening,
)
from wattlane.llm.texts import remainder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item within the edit bound, with the item and the passage's place."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontamination.leaked(decontamination.mark(spark, docs, table(spark, sf_dir, "benchmark")))


def op2_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fitted on labelled rows outside the held-out fold; every document is scored."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    labels = table(spark, sf_dir, "labels").where(remainder("doc_id", 5) != 0)
    net = toxicity.fit(spark, docs, labels)
    return toxicity.score(spark, docs, net).select("doc_id", (remainder("doc_id", 5) == 0).alias("held_out"), "score",
                                                   "predicted", "threshold", "flagged")


def op4_superminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.link(table(spark, sf_dir, "documents"))


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fitted on labelled rows outside the held-out fold; every document is scored."""
    docs = table(spark, sf_dir, "documents")
    out = (remainder("doc_id", 4) == 2).alias("held_out")
    model = language.fit(docs.where(remainder("doc_id", 4) != 2))
    return language.predict(spark, docs.select("doc_id", out, "text"), model).drop("text")


def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.encode(spark, table(spark, sf_dir, "documents"), tokenizer_path())


def op8_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text.main_text(spark, table(spark, sf_dir, "pages"))


def op9_suffix_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(table(spark, sf_dir, "documents")).drop("spans")


def op10_syncmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare(table(spark, sf_dir, "documents"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(spark, table(spark, sf_dir, "embeddings"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(table(spark, sf_dir, "documents"))


def op13_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.plan(spark, table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontamination": op1_decontamination,
    "op2_source_mixing": op2_source_mixing,
    "op3_toxicity": op3_toxicity,
    "op4_superminhash": op4_superminhash,
    "op5_language": op5_language,
    "op6_licenses": op6_licenses,
    "op7_token_files": op7_token_files,
    "op8_main_text": op8_main_text,
    "op9_suffix_sort": op9_suffix_sort,
    "op10_syncmers": op10_syncmers,
    "op11_whitening": op11_whitening,
    "op12_collocations": op12_collocations,
    "op13_sharding": op13_sharding,
}
#: Signatures, trained models, random rounding, codecs, eigenvectors and permutations have no SQL form; the tests hold
#: these queries against brute force, round trips and held-out labels instead.
SQL: dict[str, str] = {"op12_collocations": collocations.SQL}
