"""Bring both feeds to one layout and keep the usable readings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetpulse.functions.readings import nonnegative, site_number, site_time
from fleetpulse.params import Params
from fleetpulse.schema import ESSENTIAL_COLUMNS, SITE_FEED_TYPES, SOURCE_FILE


def assign_site_ids(sites: DataFrame, fleet: DataFrame) -> DataFrame:
    """Add ``turbine_id``: the site number, moved past the ids the fleet uses.

    The offset is a scalar subquery over the one id column of ``fleet``, so it is
    computed on the cluster as part of this frame and needs no join. An empty fleet
    gives offset 0.
    """
    offset = fleet.select(F.coalesce(F.max("turbine_id"), F.lit(0)).cast("int")).scalar()
    return sites.withColumn("turbine_id", site_number(F.col(SOURCE_FILE)) + offset)


def standardize_site_feed(sites: DataFrame, params: Params = Params()) -> DataFrame:
    """Rename, rescale and retype the site feed to the fleet feed's columns."""
    renamed = {"windspeed_100m": "wind_speed", "winddirection_100m": "wind_direction"}
    dropped = (set(SITE_FEED_TYPES) | {SOURCE_FILE}) - set(renamed)
    kept = [
        F.col(name).alias(renamed.get(name, name))
        for name in sites.columns
        if name not in dropped
    ]
    return sites.select(
        *kept,
        (F.col("Power") * params.rated_power).alias("power_output"),
        site_time(F.col("Time")).alias("timestamp"),
    )


def void_negative_power(readings: DataFrame) -> DataFrame:
    """Negative power is a fault of the meter, not a value: make it NULL."""
    return readings.withColumn("power_output", nonnegative(F.col("power_output")))


def clean_readings(readings: DataFrame) -> DataFrame:
    """Keep readings with a time, a wind speed and a power that is not negative.

    The result is that of ``void_negative_power`` and dropping what is incomplete,
    but stated as comparisons, which reach the scan and can skip row groups there.
    ``dropna`` also removes NaN. A NULL ``turbine_id`` is not a reason to drop.
    """
    present = F.col("power_output") >= 0
    for name in ESSENTIAL_COLUMNS:
        present = present & F.col(name).isNotNull()
    return readings.where(present).dropna(subset=list(ESSENTIAL_COLUMNS))


def merge_feeds(fleet: DataFrame, sites: DataFrame) -> DataFrame:
    """Clean bag union, matched by column name; unequal column sets fail."""
    return clean_readings(fleet.unionByName(sites, allowMissingColumns=False))
