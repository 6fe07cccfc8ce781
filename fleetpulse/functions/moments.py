"""Mean and sample deviation that are exact, hence the same for every row order.

A value is cut into limbs: multiples of falling powers of two with few enough bits that
their sums, kept as whole numbers, are exact. Its square is cut the same way, together
with what the rounded product misses of it. The moments are then worked out from the sums
of one row in fractions, and rounded once.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Sequence
from fractions import Fraction

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

# The last step may run in a task, where the package need not be installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

LIMB = 24
# Values of 2 ** RANGE and more raise; what is under 2 ** -80 of a value is rounded off.
RANGE = 40
VALUE_GRIDS = tuple(RANGE - LIMB * (k + 1) for k in range(5))
SQUARE_GRIDS = tuple(2 * RANGE - LIMB * (k + 1) for k in range(8))
# A square misses its product by less than 2 ** -53 of it.
MISSED_FROM = next(k for k, grid in enumerate(SQUARE_GRIDS) if grid + LIMB <= 2 * RANGE - 48)


def with_limbs(df: DataFrame, value: Column) -> DataFrame:
    """``df`` with the limbs that ``moment_sums`` adds up, under names that begin ``m_``."""
    finite = F.abs(value) < F.lit(math.inf)
    number = F.when(
        finite,
        F.when(F.abs(value) < F.lit(2.0**RANGE), value).otherwise(
            F.raise_error(F.concat(F.lit("too large for exact moments: "), value.cast("string"))).cast("double")
        ),
    )
    df = df.withColumns({"m_odd": F.when(~finite, 1), "m_value": number})
    # The product, and what it misses of the square, from halves with exact products.
    scaled = f"m_value * {2.0**27 + 1.0}D"
    df = df.selectExpr("*", f"{scaled} - ({scaled} - m_value) AS m_high", "m_value * m_value AS m_square")
    df = df.selectExpr("*", "m_value - m_high AS m_low")
    missed = "m_high * m_high - m_square + m_high * m_low * 2D + m_low * m_low AS m_missed"
    df = df.selectExpr("*", missed)
    # Each step takes the nearest multiple of a power of two and goes on with the rest.
    rest = {"m_value": "m_value", "m_square": "m_square", "m_missed": "m_missed"}
    for k, grid in enumerate(SQUARE_GRIDS):
        columns = []

        def cut(name: str, step: int) -> str:
            pad = f"{1.5 * 2.0 ** (52 + step)!r}D"
            part = f"({rest[name]} + {pad} - {pad})"
            columns.append(f"{rest[name]} - {part} AS {name}{k}")
            rest[name] = f"{name}{k}"
            return f"CAST({part} * {2.0**-step!r}D AS BIGINT)"

        square = cut("m_square", grid)
        limb = f"{square} + {cut('m_missed', grid)}" if k >= MISSED_FROM else square
        columns.append(f"{limb} AS m_q{k}")
        if k < len(VALUE_GRIDS):
            columns.append(f"{cut('m_value', VALUE_GRIDS[k])} AS m_s{k}")
        df = df.selectExpr("*", *columns)
    return df


def moment_sums() -> list[Column]:
    """The aggregates over the limbs; a sum that passes 64 bits is NULL."""
    names = [f"m_s{k}" for k in range(len(VALUE_GRIDS))] + [f"m_q{k}" for k in range(len(SQUARE_GRIDS))]
    sums = [F.try_sum(F.col(name)).alias(name) for name in names]
    return [F.count("m_value").alias("m_count"), F.count("m_odd").alias("m_odd"), *sums]


def moments(sums: Row) -> tuple[float | None, float | None]:
    """Mean and sample deviation; NaN with an infinite or NaN value among the rows.

    Without values there is no mean, and without two of them no deviation.
    """
    if sums["m_odd"]:
        return math.nan, math.nan
    count = sums["m_count"]
    if not count:
        return None, None
    total = _total(sums, "m_s", VALUE_GRIDS)
    mean = float(total / count)
    if count == 1:
        return mean, None
    spread = (_total(sums, "m_q", SQUARE_GRIDS) - total * total / count) / (count - 1)
    return mean, _root(max(spread, Fraction(0)))


def _total(sums: Row, name: str, grids: Sequence[int]) -> Fraction:
    limbs = [sums[f"{name}{k}"] for k in range(len(grids))]
    if None in limbs:
        raise OverflowError("too many rows for exact moments")
    return sum((limb * Fraction(2) ** grid for limb, grid in zip(limbs, grids)), Fraction(0))


def _root(square: Fraction) -> float:
    """The square root to within a unit in the last place."""
    if not square:
        return 0.0
    shift = 2 * max(0, 64 - (square.numerator.bit_length() - square.denominator.bit_length()) // 2)
    return math.isqrt(int(square * 2**shift)) / 2 ** (shift // 2)


def spread(df: DataFrame, value: Column) -> Column:
    """(``mean``, ``deviation``) of ``value`` as a scalar subquery over ``df``.

    It runs when, and only if, something uses it; its last step sees one row.
    """
    finish = F.udf(lambda row: moments(row), "struct<mean: double, deviation: double>")
    sums = with_limbs(df.select(value.alias("m_value")), F.col("m_value")).agg(*moment_sums())
    return sums.select(finish(F.struct(*sums.columns))).scalar()
