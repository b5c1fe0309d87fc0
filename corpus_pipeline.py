"""A training corpus from ``documents``: five stages, each written as Parquet and read again."""

from __future__ import annotations

import functools
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casegrid.llm import decontaminate, line_dedup, quality, registry, simhash
from casegrid.llm.common import doc_remainder, table
from casegrid.session import ensure_checkpoint_dir, ship_package


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return quality.filter_by_quality(docs, table(spark, sf_dir, "labels"), doc_remainder(F.col("id"), 5) != 0)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found in ten documents or more go from all documents; ``n_chars`` follows the text."""
    found = line_dedup.dedup_lines(docs, min_docs=10, min_chars=1)
    changed = F.col("n_dropped") > 0
    new = {"text": F.when(changed, F.col("kept_text")).otherwise(F.col("row.text")),
           "n_chars": F.when(changed, F.length("kept_text").cast("long")).otherwise(F.col("row.n_chars"))}
    return found.select(*[new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: that with the least id."""
    return simhash.drop_near_duplicates(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a benchmark passage go."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mixing_to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each time that the mix takes a document: its columns, ``domain`` and ``epoch`` (in place of any so named)."""
    found = registry.mixed(docs)
    return found.select(*[f"row.`{c}`" for c in docs.columns if c not in ("domain", "epoch")], "domain", "epoch")


def _shipped(stage):
    @functools.wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return stage(spark, docs, sf_dir)

    return run_stage


STAGES = [(name, _shipped(stage)) for name, stage in (
    ("quality_classifier", quality_classifier),
    ("line_dedup", line_dedup_stage),
    ("simhash_near_dedup", simhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("mixing_to_weights", mixing_to_weights),
)]

#: Fingerprints need XXH64 and the classifier a fit, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/corpus-{uuid.uuid4().hex}"
    for i, (name, stage) in enumerate(STAGES):
        path = f"{base}/{i}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
