"""The queries of this subpackage: one per operator over its whole table, and the pipeline."""

from __future__ import annotations

import importlib
import os
import tempfile
import zipfile

from pyspark.sql import DataFrame, SparkSession

from subledger.llm.common import table
from subledger.llm.sql import ORACLES

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors' Python workers this package, once per application (`spark-submit --py-files` does the same)."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    path = os.path.join(tempfile.mkdtemp(prefix="subledger-"), "subledger-package.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(os.path.join(root, "subledger")):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(path)
    _SHIPPED.add(sc.applicationId)


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    from subledger.llm.packing import pack
    return pack(spark, table(spark, sf_dir, "documents"))


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    from subledger.llm.chat import link_quotations
    return link_quotations(spark, table(spark, sf_dir, "conversations"))


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    from subledger.llm.decontam import leaks
    return leaks(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    from subledger.llm.simhash import near_duplicates
    return near_duplicates(spark, table(spark, sf_dir, "documents"))


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    from subledger.llm.rules import quality_digest
    return quality_digest(table(spark, sf_dir, "documents"))


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    from subledger.llm.ranking import quality_scores
    return quality_scores(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    from subledger.llm.substring import substring_dedup
    return substring_dedup(spark, table(spark, sf_dir, "documents"))


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    from subledger.llm.pii import personal_data
    return personal_data(spark, table(spark, sf_dir, "documents"))


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    from subledger.llm.tokencount import token_counts
    return token_counts(spark, table(spark, sf_dir, "documents"))


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    from subledger.llm.katz import katz_scores
    return katz_scores(spark, table(spark, sf_dir, "documents"))


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    from subledger.llm.ranked import ranked_search
    return ranked_search(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    from subledger.llm.bytetree import token_digest
    return token_digest(spark, table(spark, sf_dir, "documents"))


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    from subledger.llm.alignment import alignment_digest
    return alignment_digest(spark, table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importlib.import_module("corpus_pipeline").run(spark, sf_dir)


def _shipped(query):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return query(spark, sf_dir)
    return run


_ALL = {
    "op1_best_fit_packing": op1, "op2_chat_quotation_linking": op2, "op3_benchmark_decontamination": op3,
    "op4_simhash_near_dedup": op4, "op5_quality_rules": op5, "op6_quality_classifier": op6,
    "op7_substring_dedup": op7, "op8_pii_sanitisation": op8, "op9_token_counts": op9,
    "op10_katz_scoring": op10, "op11_ranked_search": op11, "op12_byte_bpe_tree": op12,
    "op13_tokenizer_alignment": op13, "pipeline": pipeline,
}
QUERIES = {name: (_shipped(query), ORACLES.get(name)) for name, query in _ALL.items()}
