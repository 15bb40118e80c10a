"""A corpus pipeline over ``documents``: quality rules, near-duplicates, personal data,
source mixing, piece sampling.

Each stage takes ``(spark, docs, sf_dir)``, works on every row that its
predecessor kept and, but for the last, returns the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from genrec.llm import order_minhash, personal_data, piece_sampling, quality_rules, source_mix
from genrec.llm.common import table
from genrec.session import scratch_dir

PIECES = "piece_bpe_32k.model"
SAMPLES = 2                    # segmentations of each document that the last stage writes


def _quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rule and the learned rules keep."""
    return quality_rules.keep_good(docs, table(spark, sf_dir, "labels"))


def _near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class."""
    return order_minhash.drop_near_copies(docs)


def _personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by its kind."""
    return personal_data.redact(docs)


def _mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: whole passes over documents, and excerpts of the picked blocks."""
    return source_mix.mixed_documents(docs)


def _pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sampled segmentations of every document of the mix, as piece ids."""
    return piece_sampling.encode(docs, public_tokenizers.path(PIECES), k=SAMPLES)


STAGES = [("quality_rules", _quality), ("order_minhash", _near_copies), ("personal_data", _personal_data),
          ("source_mix", _mix), ("piece_sampling", _pieces)]

# learned rules, sketches and sampled pieces have no SQL; tests/llm compares the stages with brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order, each written as Parquet and read again by the next.

    Runs one write per stage but the last, whose plan is returned.
    """
    docs = table(spark, sf_dir, "documents")
    folder = scratch_dir(spark, "pipeline")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs.write.parquet(f"{folder}/{i}-{name}")
            docs = spark.read.parquet(f"{folder}/{i}-{name}")
    return docs


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
