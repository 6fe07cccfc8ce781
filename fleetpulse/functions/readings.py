"""Expressions over single readings: ids, cleaning, the power curve, ratings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fleetpulse.params import Params

# Layout of the timestamps and file names of the site feed. The
# site number comes from the last path part. Spark writes a file as a folder of part
# files; there the folder is the file, and only then does its name decide.
SITE_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
SITE_FILE_PATTERN = r"(?i)Location(\d+)[^/]*(?:/part-[^/]*)?$"

# The names a turbine's rating can take.
FAULTY = "FAULTY_SENSOR"
REVIEW = "REVIEW_REQUIRED"
NORMAL = "NORMAL"


def site_number(path: Column) -> Column:
    """Number in a ``Location<N>.csv`` path; NULL when there is none."""
    return F.regexp_extract(path, SITE_FILE_PATTERN, 1).try_cast("int")


def nonnegative(power: Column) -> Column:
    """Negative values become NULL; NaN and -0.0 are not negative and stay."""
    return F.when(~(power < 0), power)


def site_time(raw: Column) -> Column:
    """Site timestamps; text that does not fit the layout gives NULL."""
    return F.try_to_timestamp(raw, F.lit(SITE_TIME_FORMAT))


def expected_power(wind_speed: Column, params: Params = Params()) -> Column:
    """Output in MW that the wind alone would explain."""
    return (
        F.lit(0.5)
        * F.lit(params.air_density)
        * F.lit(float(params.swept_area))
        * F.pow(wind_speed, F.lit(3.0))
        * F.lit(params.power_coefficient)
        / F.lit(1_000_000.0)
    )


def either_flag(*flags: Column) -> Column:
    """1 when any flag is 1; NULL flags count as unset."""
    raised = F.lit(False)
    for flag in flags:
        raised = raised | (flag == 1)
    return F.when(raised, 1).otherwise(0)


def rating(anomaly_rate: Column, params: Params = Params()) -> Column:
    """Both bounds are strict, and an unknown rate is rated normal."""
    return (
        F.when(anomaly_rate > params.faulty_rate, FAULTY)
        .when(anomaly_rate > params.review_rate, REVIEW)
        .otherwise(NORMAL)
    )
