"""A corpus pipeline of five stages; each calls one operator of the subpackage ``llm``.

Every stage but the last returns the columns of documents, in their order, and
works on all its predecessor kept. What a stage does with null or empty texts,
repeated rows, ties and empty tables is said by its operator.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from marketframe.llm import decontaminate, langid, mixing, shards, simhash
from marketframe.llm.common import small_batches, stored, table
from marketframe.session import work_dir

# Share of the tokens the mixture keeps, and the least probability of the best language (chance is one in four).
KEEP, LEAST_LANGUAGE = 0.8, 0.3


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without a recognisable language."""
    small_batches(spark)
    return langid.known_language(docs, LEAST_LANGUAGE)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each SimHash group: three-word shingles, fingerprints linked at three or fewer differing bits."""
    small_batches(spark)
    return simhash.one_of_each(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a benchmark passage."""
    return decontaminate.remove_leaked(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sample documents so that sources, languages and topics meet their targets, the observed shares flattened."""
    return mixing.sampled(docs, None, KEEP)


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Put the documents into eight shards of near equal bytes."""
    placed = shards.assign(docs, 8, map_path=work_dir(spark, "slot-map"))
    return placed.withColumnRenamed("id", "doc_id")


STAGES = [("language", language), ("near duplicates", near_duplicates), ("decontamination", decontaminated), ("mixing", mixed), ("sharding", sharded)]
# A trained model and XXH64 fingerprints have no SQL; tests compare run() with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to the table documents; each result is written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
