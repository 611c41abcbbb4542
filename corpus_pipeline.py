"""The corpus pipeline: quality rules, near-duplicates, decontamination, personal data, packing.

Each stage takes what its predecessor kept.  ``run`` writes every stage's rows as Parquet under the shared checkpoint folder and reads them
back for the next one, so that a lost executor or a failed stage costs that stage only.

Defined results, for every stage: null and empty texts are texts without words (the first stage rejects them; later stages, given
some, keep them); very long texts are taken whole; rows with a null id are documents of their own; repeated rows and ids are
judged row by row, but of equal or near-equal texts one row stays after the second stage; extra columns pass through all stages but the
last, whatever their names; an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from subledger.llm import decontam, packing, pii, rules, simhash
from subledger.llm.common import release, stored, table
from subledger.llm.queries import ship


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the pipeline's policy (``rules.PRODUCTION``).  The ledger's bits are computed beside each row, without a join."""
    ship(spark)
    return rules.filter_documents(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component: the one with the smallest id (one row of it, where ids repeat)."""
    ship(spark)
    return simhash.keep_one(spark, docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no test item."""
    ship(spark)
    return decontam.decontaminate(spark, docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data and the terms that reveal it masked."""
    ship(spark)
    return pii.sanitise(spark, docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents and their places in sequences of 4096 tokens."""
    ship(spark)
    return packing.pack(spark, docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("simhash_near_dedup", simhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("personal_data", personal_data),
    ("best_fit_packing", best_fit_packing),
]

#: The fingerprints, the retrieval and the tokenizer are beyond SQL; tests/llm holds run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(spark, stage(spark, docs, sf_dir), f"stage-{name}")
        release(spark)
    return docs
