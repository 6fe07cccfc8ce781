"""Intermediate results kept in the shared folder, so that no lineage is rerun."""

from __future__ import annotations

import tempfile
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``.

    It has to outlive executors and be visible to all of them. Where it is not set,
    only a session whose one process is the whole cluster gets a folder of its own.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="fleetpulse-"))
        folder = context.getCheckpointDir()
    return folder.rstrip("/")


def fresh_path(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/fleetpulse/{label}-{uuid.uuid4().hex}"


@dataclass(frozen=True)
class Staged:
    """A written result: ``frame`` reads it back, column by column as needed."""

    frame: DataFrame
    path: str

    def discard(self) -> None:
        """Delete the files, once nothing reads ``frame`` any more."""
        discard(self.frame.sparkSession, self.path)


def discard(spark: SparkSession, path: str) -> None:
    """Delete a file or folder, wherever the session's file systems keep it."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def stage(df: DataFrame, label: str) -> Staged:
    """Write ``df`` once and go on from the files.

    Later passes read only the columns they use, and a lost executor costs a re-read
    rather than a recomputation.
    """
    spark = df.sparkSession
    path = fresh_path(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    return Staged(spark.read.schema(df.schema).parquet(path), path)
