"""Exact dedup against a persistent digest index.

The index is a Parquet table bucketed and sorted by the SHA-256 digest of the text. A
batch is reduced to one row per digest before it moves, sort-merge anti-joined with
the index on its own buckets, and what is left is appended. Which text stays is thus
settled once: the first batch that brings it, and in that batch the largest id.

Defined cases: a NULL text is the empty text; a NULL id ranks below every number; of
rows that repeat both id and text exactly one is kept; an empty batch appends nothing;
further columns, whatever their names, are carried along or ignored.
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetpulse.llm.shared import exists, keep, partitions, shared_path, table, whole_text

ENTRY = "digest BINARY, keep_id BIGINT, row_no BIGINT, batch STRING"


def digest(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


class DigestIndex:
    """The bucketed table at ``path``; opening an existing path goes on with it.

    The number of buckets is fixed when the index is made and kept in its folder, from
    where it is taken again; asking for another number is refused.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int | None = None):
        self.spark, self.path = spark, path
        self.buckets = self._fixed_buckets(buckets)
        self.name = "digest_index_" + hashlib.md5(path.encode()).hexdigest()
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name} ({ENTRY}) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS "
            f"LOCATION '{path}'"
        )

    def _fixed_buckets(self, asked: int | None) -> int:
        # Names with an underscore in front are not read as part of the table.
        place = f"{self.path}/_buckets"
        if exists(self.spark, place):
            fixed = self.spark.read.schema("buckets INT").json(place).first().buckets
            if asked and asked != fixed:
                raise ValueError(f"the index at {self.path} has {fixed} buckets, not {asked}")
            return fixed
        buckets = asked or partitions(self.spark)
        if exists(self.spark, self.path):
            raise ValueError(f"{self.path} holds no index that tells its number of buckets")
        self.spark.range(1).select(F.lit(buckets).alias("buckets")).write.json(place)
        return buckets

    def close(self) -> None:
        """Forget the table's name; the index itself stays at its path."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")

    def table(self) -> DataFrame:
        """Read bucket by bucket: a join on the digest moves none of it."""
        return self.spark.table(self.name)

    def entries(self) -> DataFrame:
        """Read without buckets, so that a join can split a digest many rows have."""
        return self.spark.read.schema(ENTRY).parquet(self.path)

    def append(self, fresh: DataFrame) -> None:
        aligned = fresh.repartition(self.buckets, "digest")
        aligned.select("digest", "keep_id", "row_no", "batch").write.insertInto(self.name)
        self.spark.catalog.refreshTable(self.name)


def digest_rows(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Id, digest and a number for each row, kept: the only pass over the texts."""
    rows = docs.select(
        F.col(id_column).cast("long").alias("doc_id"),
        digest(whole_text(text_column)).alias("digest"),
        F.monotonically_increasing_id().alias("row_no"),
    )
    return keep(rows, "digests")


def admit(rows: DataFrame, index: DigestIndex) -> str:
    """Append the batch's unknown digests to the index; the batch's name."""
    batch = uuid.uuid4().hex
    tops = rows.groupBy("digest").agg(F.max(F.struct("doc_id", "row_no")).alias("top"))
    known = index.table().select("digest").hint("merge")
    fresh = tops.join(known, "digest", "left_anti").select(
        "digest",
        F.col("top.doc_id").alias("keep_id"),
        F.col("top.row_no").alias("row_no"),
        F.lit(batch).alias("batch"),
    )
    index.append(fresh)
    return batch


def verdicts(batches: list[tuple[str, DataFrame]], index: DigestIndex) -> DataFrame:
    """Every row of the batches with its group: which row stays and how many there are.

    Only texts that occur more than once are joined back. Both sides are plain
    shuffles, so Spark splits a digest that very many rows have.
    """
    parts = [rows.withColumn("batch", F.lit(batch)) for batch, rows in batches]
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    sizes = rows.groupBy("digest").agg(F.count("*").alias("group_size"))
    entries = index.entries().select(
        "digest", "keep_id", F.col("row_no").alias("keep_row"), F.col("batch").alias("keep_batch")
    )
    ours = F.col("keep_batch").isin([batch for batch, _ in batches])
    groups = sizes.join(entries, "digest").where((F.col("group_size") > 1) | ~ours)
    marked = rows.join(keep(groups, "groups"), "digest", "left")
    alone = F.col("group_size").isNull()
    return marked.select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (
            alone
            | (F.col("batch") == F.col("keep_batch")) & (F.col("row_no") == F.col("keep_row"))
        ).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def deduplicate(docs: DataFrame, index: DigestIndex, **columns: str) -> DataFrame:
    """One batch against the index, one row per given row; the index then knows it."""
    rows = digest_rows(docs, **columns)
    return verdicts([(admit(rows, index), rows)], index)


def keep_new(
    docs: DataFrame, index: DigestIndex, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    rows = digest_rows(docs, id_column, text_column)
    batch = admit(rows, index)
    mine = index.entries().where(F.col("batch") == batch).select("digest")
    packed = docs.select(
        digest(whole_text(text_column)).alias("digest"), F.struct("*").alias("row")
    )
    rank = F.coalesce(F.col(f"row.{id_column}").cast("long"), F.lit(-(2**63)))
    tops = packed.groupBy("digest").agg(F.max_by("row", rank).alias("row"))
    kept = tops.join(mine, "digest", "left_semi")
    return kept.select("row.*")


def op1_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in two batches, the upper half of the ids first.

    The first batch to bring a text keeps it, so the largest id of equal texts stays.
    """
    docs = table(spark, folder, "documents")
    ends = docs.agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).first()
    middle = ((ends.low or 0) + (ends.high or 0)) // 2
    upper = F.coalesce(F.col("doc_id") > middle, F.lit(False))
    index = DigestIndex(spark, shared_path(spark, "digest-index"))
    batches = []
    for part in (docs.where(upper), docs.where(~upper)):
        rows = digest_rows(part)
        batches.append((admit(rows, index), rows))
    index.close()
    return verdicts(batches, index)


SQL = """
    SELECT doc_id,
      max(doc_id) OVER same AS keep_id,
      count(*) OVER same AS group_size,
      doc_id = max(doc_id) OVER same AS kept,
      sha256(coalesce(text, '')) AS text_sha256
    FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""
