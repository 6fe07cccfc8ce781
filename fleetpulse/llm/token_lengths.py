"""Exact histogram of encoded lengths, and what its suffix sums answer.

Every text is encoded once; what moves is one row per length and task. For any context
limit the histogram tells how many documents fit, how many tokens they hold, and how
many are left if longer ones are cut.

Defined cases: a NULL text is the empty text, of length 0; repeated rows count each;
an empty table gives an empty histogram.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fleetpulse.llm.shared import by_value, keep, table, whole_text
from fleetpulse.llm.tokens import encoder

by_value(__name__)

# Suffix sums run within blocks of so many lengths and once over the blocks.
BLOCK = 1024


def encoded_lengths(docs: DataFrame, text_column: str = "text", path: str | None = None):
    def count(batches: Iterator) -> Iterator:
        import pyarrow as pa

        own = encoder(path)
        for batch in batches:
            counts = map(own.count, batch.column(0).to_pylist())
            yield pa.RecordBatch.from_arrays([pa.array(counts, pa.int64())], ["length"])

    texts = docs.select(whole_text(text_column).alias("text"))
    return texts.mapInArrow(count, "length BIGINT")


def length_histogram(lengths: DataFrame) -> DataFrame:
    return lengths.groupBy("length").agg(F.count("*").alias("n_docs"))


def limit_answers(histogram: DataFrame) -> DataFrame:
    """For each occurring length as context limit: what fits and what cutting leaves.

    ``docs_within``/``tokens_within`` cover documents of at most the limit,
    ``docs_longer`` the others, ``truncated_tokens`` is the sum of lengths cut to the
    limit and ``share_within`` the limit's rank among all documents (its quantile).
    """
    rows = histogram.select(
        "length",
        "n_docs",
        (F.col("length") * F.col("n_docs")).alias("tokens"),
        F.floor(F.col("length") / BLOCK).alias("block"),
    )
    blocks = rows.groupBy("block").agg(F.sum("n_docs").alias("d"), F.sum("tokens").alias("t"))
    # One row per 1,024 lengths up to the longest document: few, whatever the input.
    later = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    sums = blocks.select(
        "block",
        F.coalesce(F.sum("d").over(later), F.lit(0)).alias("docs_after"),
        F.coalesce(F.sum("t").over(later), F.lit(0)).alias("tokens_after"),
        F.sum("d").over(everything).alias("all_docs"),
        F.sum("t").over(everything).alias("all_tokens"),
    )
    longer = (
        Window.partitionBy("block")
        .orderBy(F.desc("length"))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    suffix = rows.join(sums, "block").select(
        "length",
        "n_docs",
        (F.coalesce(F.sum("n_docs").over(longer), F.lit(0)) + F.col("docs_after")).alias(
            "docs_longer"
        ),
        (F.coalesce(F.sum("tokens").over(longer), F.lit(0)) + F.col("tokens_after")).alias(
            "tokens_longer"
        ),
        "all_docs",
        "all_tokens",
    )
    within = F.col("all_docs") - F.col("docs_longer")
    fitting = F.col("all_tokens") - F.col("tokens_longer")
    return suffix.select(
        F.col("length").alias("context_limit"),
        "n_docs",
        within.alias("docs_within"),
        "docs_longer",
        fitting.alias("tokens_within"),
        (fitting + F.col("docs_longer") * F.col("length")).alias("truncated_tokens"),
        F.col("all_tokens").alias("total_tokens"),
        (within / F.col("all_docs")).alias("share_within"),
    )


def truncated_total(histogram: DataFrame, limit: int) -> DataFrame:
    """The tokens left if every document is cut to any given limit; 0 for no rows."""
    cut = F.least("length", F.lit(limit)) * F.col("n_docs")
    return histogram.agg(F.coalesce(F.sum(cut), F.lit(0)).alias("truncated_tokens"))


def length_quantile(answers: DataFrame, share: float) -> DataFrame:
    """The smallest length that at least ``share`` of the documents do not exceed."""
    reached = answers.where(F.col("share_within") >= share)
    return reached.agg(F.min("context_limit").alias("length"))


def op5_token_lengths(spark: SparkSession, folder: str) -> DataFrame:
    lengths = encoded_lengths(table(spark, folder, "documents"))
    return limit_answers(keep(length_histogram(lengths), "lengths"))
