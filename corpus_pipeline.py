"""A training corpus from ``documents``, in five stages that each read the Parquet of the one before."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallychain.llm import decontaminate, language_id, mixing, sharding, simhash
from tallychain.llm.tables import stored, table


#: Languages of the corpus; None for every language that the labelled documents teach.
LANGUAGES: list[str] | None = None


def of_the_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of ``LANGUAGES``; those without a letter or without a main language go."""
    return language_id.keep_languages(docs, LANGUAGES, language_id.LEAST_SHARE)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component."""
    return simhash.drop_near_duplicates(docs, simhash.SHINGLE_WORDS, simhash.MAX_BITS)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document once or more, as often as its source's weight asks."""
    return mixing.mix(docs, max_repeats=mixing.MAX_REPEATS).select(docs.columns)


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A shard and a place in it for every row."""
    return sharding.shard_rows(docs)


STAGES = [
    ("language_id", of_the_languages),
    ("simhash_near_dedup", without_near_copies),
    ("decontamination", without_benchmark),
    ("source_mixing", mixed),
    ("sharding", sharded),
]

#: SQL can't express the language model; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over all of ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
