"""Exact quantiles of a column, at any size."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BUCKETS = 4096
# A bucket with no more rows than this (4 MB of values) is fetched and sorted.
FETCH_LIMIT = 500_000


def exact_quantile(
    df: DataFrame,
    column: str,
    fraction: float,
    fetch_limit: int = FETCH_LIMIT,
) -> float | None:
    """Linearly interpolated quantile of all values; None without rows.

    A first pass finds the range and refuses values without a rank (NULL, NaN) and
    infinite ones. The two order statistics around the quantile are then found by
    zooming in: a pass counts rows in 4,096 equal buckets, and only the bucket that
    holds the wanted ranks is looked at again, until it is small or holds a single
    value. A pass moves at most 4,096 counters, so neither the number of rows nor the
    number of distinct values matters, and the buckets narrow at least 4,096-fold per
    pass. ``df`` is read once per pass, so hand in something materialized.
    """
    values = df.select(F.col(column).cast("double").alias(column))
    finite = F.coalesce(F.abs(F.col(column)) < F.lit(math.inf), F.lit(False))
    ends = values.agg(
        F.min(column).alias("low"),
        F.max(column).alias("high"),
        F.count_if(~finite).alias("unusable"),
    ).first()
    if ends["unusable"]:
        raise ValueError(f"{ends['unusable']} rows have no finite {column}")
    if ends["low"] is None:
        return None
    low, high = ends["low"], ends["high"]
    total: int | None = None
    skipped = 0  # rows below `low`
    lower_rank = upper_rank = 0
    weight = 0.0
    while True:
        within = values.where(F.col(column).between(low, high))
        step = (high - low) / BUCKETS
        bucket = (
            F.least(F.floor((F.col(column) - low) / step), F.lit(BUCKETS - 1))
            if step > 0
            else F.lit(0)
        )
        counts = (
            within.groupBy(bucket.alias("bucket"))
            .agg(
                F.count(F.lit(1)).alias("rows"),
                F.min(column).alias("first"),
                F.max(column).alias("last"),
            )
            .collect()
        )
        counts.sort(key=lambda row: row["bucket"])
        if total is None:
            total = sum(row["rows"] for row in counts)
            if total == 0:
                return None
            position = (total - 1) * fraction
            lower_rank = math.floor(position)
            upper_rank = min(lower_rank + 1, total - 1)
            weight = position - lower_rank

        passed = skipped
        for place, row in enumerate(counts):
            if lower_rank < passed + row["rows"]:
                break
            passed += row["rows"]
        in_bucket = row["rows"]
        if row["first"] == row["last"] or upper_rank >= passed + in_bucket:
            # Either one value, or the lower rank is the last row of this bucket.
            smaller = row["last"]
            larger = (
                row["last"]
                if upper_rank < passed + in_bucket
                else counts[place + 1]["first"]
            )
            return smaller + (larger - smaller) * weight
        low, high, skipped = row["first"], row["last"], passed
        if in_bucket <= fetch_limit:
            found = values.where(F.col(column).between(low, high)).toArrow()
            ordered = np.sort(found[column].to_numpy())
            smaller = float(ordered[lower_rank - skipped])
            larger = float(ordered[upper_rank - skipped])
            return smaller + (larger - smaller) * weight
