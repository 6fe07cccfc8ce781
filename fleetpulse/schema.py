"""Column types of the two raw feeds and of the common reading layout."""

from __future__ import annotations

from pyspark.sql import types as T

# The column names of the raw files and of the layers' tables.

# Types by column name. Files may list their columns in any order, so these are
# matched against the header rather than applied by position.
FLEET_FEED_TYPES: dict[str, T.DataType] = {
    "timestamp": T.TimestampType(),
    "turbine_id": T.IntegerType(),
    "wind_speed": T.DoubleType(),
    "wind_direction": T.DoubleType(),
    "power_output": T.DoubleType(),
}

SITE_FEED_TYPES: dict[str, T.DataType] = {
    "Time": T.TimestampType(),
    "temperature_2m": T.DoubleType(),
    "relativehumidity_2m": T.DoubleType(),
    "dewpoint_2m": T.DoubleType(),
    "windspeed_10m": T.DoubleType(),
    "windspeed_100m": T.DoubleType(),
    "winddirection_10m": T.DoubleType(),
    "winddirection_100m": T.DoubleType(),
    "windgusts_10m": T.DoubleType(),
    "Power": T.DoubleType(),
}

# A reading without one of these is unusable. The turbine id is not among them.
ESSENTIAL_COLUMNS = ("timestamp", "power_output", "wind_speed")

SOURCE_FILE = "source_file"

# The columns of the daily summary beside its key, in order.
SUMMARY_COLUMNS = ("window_start", "min_power", "max_power", "avg_power")
