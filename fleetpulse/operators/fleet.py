"""Combine flags, rate turbines by them, and drop the faulty ones."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetpulse.functions.readings import FAULTY, NORMAL, either_flag, rating
from fleetpulse.params import Params


def combine_flags(df: DataFrame) -> DataFrame:
    return df.withColumn(
        "combined_anomaly", either_flag(F.col("z_anomaly"), F.col("if_anomaly"))
    )


def rate_turbines(
    df: DataFrame,
    params: Params = Params(),
    key: str = "turbine_id",
    flag: str = "combined_anomaly",
) -> DataFrame:
    """Share of anomalous readings and the rating per turbine.

    Sums and counts are combined before the shuffle, so each task sends one row per
    turbine it saw, however many readings a turbine has.
    """
    totals = df.groupBy(key).agg(
        F.sum(flag).alias("total_anomalies"),
        F.count(F.lit(1)).alias("total_records"),
    )
    share = F.col("total_anomalies") / F.col("total_records")
    return totals.withColumn("anomaly_rate", share).withColumn(
        "turbine_status", rating(F.col("anomaly_rate"), params)
    )


def drop_faulty(df: DataFrame, ratings: DataFrame, key: str = "turbine_id") -> DataFrame:
    """Attach each turbine's rating and keep the turbines that are not faulty.

    Rows without a rating (among them those with a NULL key) are dropped. No join
    strategy is forced: Spark broadcasts the ratings when their measured size is
    under its limit and otherwise sort-merges, splitting hot turbines at run time.
    It can split only where both sides are shuffled for the join itself, so hand in
    ratings that were written out rather than an aggregation, which is already
    partitioned by the key and would pin each turbine to one task.
    """
    healthy = ratings.select(key, "turbine_status").where(F.col("turbine_status") != FAULTY)
    return df.join(healthy, key)


def drop_rated_faulty(
    df: DataFrame, ratings: DataFrame, key: str = "turbine_id"
) -> DataFrame:
    """``drop_faulty`` where every key of ``df`` but NULL is known to have a rating.

    Only turbines that are not normal are joined, so the build side stays a fraction
    of the fleet and most often small enough for Spark to broadcast by its own limit;
    the rest is normal by its absence.
    """
    unusual = ratings.select(key, "turbine_status").where(F.col("turbine_status") != NORMAL)
    status = F.coalesce("turbine_status", F.lit(NORMAL))
    marked = df.where(F.col(key).isNotNull()).join(unusual, key, "left")
    return marked.withColumn("turbine_status", status).where(status != FAULTY)
