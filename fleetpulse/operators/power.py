"""Expected power, residuals and the global z-score flag."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetpulse.functions import moments, readings
from fleetpulse.params import Params


def with_expected_power(df: DataFrame, params: Params = Params()) -> DataFrame:
    return df.withColumn(
        "expected_power", readings.expected_power(F.col("wind_speed"), params)
    )


def residual() -> Column:
    return F.col("power_output") - F.col("expected_power")


def with_residual(df: DataFrame) -> DataFrame:
    return df.withColumn("error", residual())


def flag_zscore(
    df: DataFrame, params: Params = Params(), spread: Column | None = None
) -> DataFrame:
    """Flag residuals further than k sample deviations from the fleet-wide mean.

    Mean and deviation come from one scalar subquery: a column-pruned partial
    aggregation whose single row is inlined as a literal, so the rows themselves
    are neither joined nor shuffled. They are exact, so no order of the rows moves a
    reading over the threshold. A caller that knows them hands them in as ``spread``.
    With an undefined deviation nothing is flagged.
    """
    with_error = with_residual(df)
    if spread is None:
        spread = moments.spread(df, residual())
    distance = F.abs(F.col("error") - spread["mean"])
    return with_error.withColumn(
        "z_anomaly",
        F.when(distance > params.zscore_threshold * spread["deviation"], 1).otherwise(0),
    )


def round_power(df: DataFrame, digits: int = 2) -> DataFrame:
    """Round both powers and take the residual anew from the rounded values."""
    rounded = df.withColumns(
        {
            name: F.round(F.col(name), digits)
            for name in ("power_output", "expected_power")
        }
    )
    return rounded.withColumn("error", F.round(residual(), digits))
