"""Small helpers of the text operators: tables, kept results, text as UTF-8."""

from __future__ import annotations

import sys
import tempfile
import uuid
from collections.abc import Callable
from typing import Any

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def by_value(module: str) -> None:
    """Send a module's functions with the tasks: executors need not have the package."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


by_value(__name__)

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def once(key: str, make: Callable[[], Any]) -> Any:
    """What a Python worker makes once and keeps for its later tasks.

    Modules sent by value are new in every task, so it is kept beside them.
    """
    kept = vars(sys).setdefault("_text_operators", {})
    if key not in kept:
        kept[key] = make()
    return kept[key]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def shared_path(spark: SparkSession, label: str) -> str:
    """A new path in the folder that ``spark.checkpoint.dir`` names for all machines.

    Where the setting is missing (a test on one machine) it is set to a new folder.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not root:
        if not context.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="llm-"))
        root = context.getCheckpointDir()
    return f"{root.rstrip('/')}/llm/{label}-{uuid.uuid4().hex}"


def keep(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and go on from the files.

    Later passes read the columns they use; a lost executor costs a re-read. The
    shuffles of the write are of no more use and their files go at once.
    """
    spark = df.sparkSession
    path = shared_path(spark, label)
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def delete(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def whole_text(column: str = "text") -> Column:
    """The text, NULL as the empty one."""
    return F.coalesce(F.col(column), F.lit(""))


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case and nothing else changed."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def document_key(id_column: str = "doc_id", text_column: str = "text") -> list[Column]:
    """What tells documents apart: ``key_id`` and the digest ``key_text``."""
    return [
        F.col(id_column).cast("long").alias("key_id"),
        F.unhex(F.sha2(whole_text(text_column), 256)).alias("key_text"),
    ]


def _keyed_join(docs: DataFrame, keys: DataFrame, how: str, columns: dict[str, str]) -> DataFrame:
    # Packed, so that no column of the documents can clash with the keys.
    packed = docs.select(*document_key(**columns), F.struct("*").alias("document"))
    chosen = keys.select(F.col("key_id").alias("chosen_id"), F.col("key_text").alias("chosen_text"))
    same = F.col("key_id").eqNullSafe(F.col("chosen_id")) & (
        F.col("key_text") == F.col("chosen_text")
    )
    return packed.join(keep(chosen.distinct(), "keys"), same, how).select("document.*")


def keyed_semi_join(docs: DataFrame, keys: DataFrame, **columns: str) -> DataFrame:
    """The rows of ``docs`` whose ``document_key`` is among ``keys``."""
    return _keyed_join(docs, keys, "left_semi", columns)


def keyed_anti_join(docs: DataFrame, keys: DataFrame, **columns: str) -> DataFrame:
    """The rows of ``docs`` whose ``document_key`` is not among ``keys``."""
    return _keyed_join(docs, keys, "left_anti", columns)
