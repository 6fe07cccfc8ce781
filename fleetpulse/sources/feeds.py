"""The two raw CSV feeds."""

from __future__ import annotations

import re
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetpulse.schema import FLEET_FEED_TYPES, SITE_FEED_TYPES, SOURCE_FILE

# Which files of a raw folder belong to which feed. Site files are named
# in any case, as their numbers are read in any case.
FLEET_FILES = "data_group_*.csv"
SITE_FILES = "".join(f"[{c.upper()}{c}]" for c in "location") + "*.csv"


# Column for the text of a record that does not fit its types or its header.
UNREADABLE = "unreadable_record"
# Headers that are read at the same time.
READERS = 16


def read_fleet_feed(spark: SparkSession, folder: str, unreadable: bool = False) -> DataFrame:
    """Readings that carry their own ``turbine_id``.

    A cell that cannot be read is NULL. With ``unreadable`` the text of a record with
    such cells is in a column of that name.
    """
    return _read_csv(spark, f"{folder}/{FLEET_FILES}", FLEET_FEED_TYPES, {}, unreadable)


def read_site_feed(spark: SparkSession, folder: str, unreadable: bool = False) -> DataFrame:
    """Readings of one site per file, with the file's path in ``source_file``."""
    source = {SOURCE_FILE: F.col("_metadata.file_path")}
    return _read_csv(spark, f"{folder}/{SITE_FILES}", SITE_FEED_TYPES, source, unreadable)


def _read_csv(
    spark: SparkSession,
    files: str,
    types: Mapping[str, T.DataType],
    extra: Mapping[str, Column],
    unreadable: bool,
) -> DataFrame:
    """Typed read without an inference pass over the data.

    Files are read in groups of equal headers, one scan each, and the groups are matched
    by column name; most often there is one. Types are looked up by name, and a column
    without a declared type stays text, NULL where a file lacks it. Files that lack a
    declared column which others have are refused. No file is read into the wrong
    columns: a header that changes before the scan makes it fail.
    """
    groups = _files_by_header(spark, files)
    declared = {frozenset(set(names) & set(types)) for names in groups}
    if len(declared) > 1:
        lists = " and ".join(sorted(", ".join(sorted(names)) for names in declared))
        raise ValueError(f"CSV headers of {files} have different columns: {lists}")
    frames = []
    for names, paths in groups.items():
        fields = [T.StructField(name, types.get(name, T.StringType())) for name in names]
        schema = T.StructType([*fields, T.StructField(UNREADABLE, T.StringType())])
        frame = (
            spark.read.option("header", True)
            .option("enforceSchema", False)
            .option("columnNameOfCorruptRecord", UNREADABLE)
            .schema(schema)
            .csv(files if len(groups) == 1 else paths)
        )
        kept = [*names, UNREADABLE] if unreadable else names
        frames.append(frame.select(*kept, *(c.alias(name) for name, c in extra.items())))
    whole = frames[0]
    for frame in frames[1:]:
        whole = whole.unionByName(frame, allowMissingColumns=True)
    added = [name for name in (*extra, UNREADABLE) if name in whole.columns]
    return whole.select(*(name for name in whole.columns if name not in added), *added)


def _files_by_header(spark: SparkSession, files: str) -> dict[tuple[str, ...], list[str]]:
    """Paths by the columns of their header, the first file's first; empty files go.

    Spark lists the files without reading them, then each header is one small read.
    """
    listed = spark.read.format("binaryFile").load(files).select("path").orderBy("path")
    paths = [re.sub(r"([\\\[\]{}*?,])", r"\\\1", row.path) for row in listed.collect()]
    reader = spark.read.option("header", True)
    with ThreadPoolExecutor(READERS) as pool:
        headers = list(pool.map(lambda path: tuple(reader.csv(path).columns), paths))
    groups: dict[tuple[str, ...], list[str]] = {}
    for names, path in zip(headers, paths, strict=True):
        if names:
            groups.setdefault(names, []).append(path)
    return groups or {tuple(reader.csv(files).columns): paths}
