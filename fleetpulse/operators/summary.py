"""Daily minimum, maximum and mean output per turbine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetpulse.functions.aggregates import rounded_mean
from fleetpulse.params import Params
from fleetpulse.schema import SUMMARY_COLUMNS


def summarize_power(
    df: DataFrame, params: Params = Params(), key: str = "turbine_id"
) -> DataFrame:
    """One row per turbine and tumbling window, windows aligned to the UTC epoch.

    All three aggregates combine before the shuffle, so a turbine that holds much
    of the data still reaches its reducer as one row per map task and window.
    """
    power = F.col("power_output")
    window = F.window("timestamp", params.summary_window)
    lowest, highest, mean = SUMMARY_COLUMNS[1:]
    return (
        df.groupBy(key, window)
        .agg(
            F.round(F.min(power), 2).alias(lowest),
            F.round(F.max(power), 2).alias(highest),
            rounded_mean(power, 2).alias(mean),
        )
        .withColumn(SUMMARY_COLUMNS[0], F.col("window.start"))
        .select(key, *SUMMARY_COLUMNS)
    )
