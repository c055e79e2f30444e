"""The training-data pipeline: five stages, each an operator applied to all that the one before it kept.

`run` writes each stage's result as Parquet to the shared folder and rereads it for the next, which cuts
the lineage, so a lost executor costs a stage at most.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from caselog.llm import decontamination, packing, quality_classifier, secrets, simhash
from caselog.llm.common import prepare, table
from caselog.sources.storage import save

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the quality classifier predicts good."""
    prepare(spark)
    return quality_classifier.keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of SimHash near-duplicates, that of the smallest id."""
    prepare(spark)
    return simhash.keep_one(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that aren't contaminated by benchmark items."""
    prepare(spark)
    return decontamination.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets replaced by a mark."""
    prepare(spark)
    return secrets.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' token sequences: each piece with its ids and where it lies."""
    prepare(spark)
    return packing.pack(docs, keep_ids=True)


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", quality),
    ("SimHash near-dedup", near_duplicates),
    ("benchmark decontamination", benchmark),
    ("secret scans", secret_scan),
    ("best-fit packing", pack),
]

#: The classifier, the fingerprints' components and the tokenizer can't be put in SQL; the tests compare
#: the stages with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = save(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return docs
