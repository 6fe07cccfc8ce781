"""Aggregate expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# A value is summed as three whole numbers, so the order of the rows does not matter:
# two limbs of its whole part and its fraction to this many places. Values of 2 ** RANGE
# and more raise; below, a group's sums have room for 2 ** 35 rows.
PLACES = 8
LIMB = 24
RANGE = 52


def rounded_mean(value: Column, digits: int) -> Column:
    """Mean rounded half up, the same whatever order the rows are summed in.

    Adding doubles rounds at every step, so two partitionings of the same rows can
    disagree in the last digit and land on either side of a rounding tie. Whole numbers
    add exactly. A value out of range raises an error, whether or not the session's
    arithmetic does. An infinite or NaN value makes the group's mean infinite or NaN.
    """
    finite = F.abs(value) < F.lit(math.inf)
    number = F.when(
        finite,
        F.when(F.abs(value) < F.lit(2.0**RANGE), value).otherwise(
            F.raise_error(F.concat(F.lit("too large for an exact mean: "), value.cast("string"))).cast("double")
        ),
    )
    whole = F.floor(number)
    high = F.shiftright(whole, LIMB)
    low = whole.bitwiseAND(F.lit((1 << LIMB) - 1))
    part = F.rint((number - whole) * F.lit(10.0**PLACES)).cast("long")

    def total(limb: Column) -> Column:
        return F.sum(limb).cast("decimal(38,0)")

    scale = F.lit(10**PLACES).cast("decimal(9,0)")
    units = (total(high) * F.lit(1 << LIMB).cast("decimal(8,0)") + total(low)) * scale + total(part)
    # Whole-number division of |units| by rows * unit, half a unit up.
    unit = F.lit(10 ** (PLACES - digits)).cast(f"decimal({PLACES - digits + 1},0)")
    span = F.nullif(F.count(value), F.lit(0)).cast("decimal(17,0)") * unit
    steps = F.call_function("div", F.abs(units) * 2 + span, span * 2)
    exact = F.when(units < 0, -steps).otherwise(steps) / F.lit(float(10**digits))
    endless = F.sum(F.when(~finite, value))
    return F.coalesce(endless, exact)
