"""From raw documents to packed sequences, stage by stage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from fleetpulse.llm.decontaminate import drop_contaminated
from fleetpulse.llm.exact_dedup import DigestIndex, keep_new
from fleetpulse.llm.packing import pack
from fleetpulse.llm.quality import keep_good
from fleetpulse.llm.shared import keep, shared_path, table
from fleetpulse.llm.simhash import keep_one_of_each_group

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_poor_text(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return keep_good(docs, table(spark, folder, "labels"))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Of equal texts the document with the largest id stays."""
    return keep_new(docs, DigestIndex(spark, shared_path(spark, "digest-index")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id stays."""
    return keep_one_of_each_group(docs)


def drop_benchmark_text(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    return drop_contaminated(docs, table(spark, folder, "benchmark"))


def pack_sequences(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """What is left, cut into pieces and packed: one row per piece."""
    return pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", drop_poor_text),
    ("exact dedup", drop_exact_copies),
    ("simhash near-dedup", drop_near_copies),
    ("benchmark decontamination", drop_benchmark_text),
    ("packing", pack_sequences),
]

# Fingerprints, trained scores and token ids are beyond SQL: tests/llm holds every stage
# against a brute-force version instead.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    """The documents through all stages, each written before the next reads it."""
    docs = table(spark, folder, "documents")
    for name, stage in STAGES[:-1]:
        docs = keep(stage(spark, docs, folder), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, folder)
