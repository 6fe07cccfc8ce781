from __future__ import annotations

import math
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from fleetpulse.functions.moments import moment_sums, moments, with_limbs
from fleetpulse.operators.power import flag_zscore
from tests.helpers import rows


def measured(spark, values, parts=3):
    df = spark.createDataFrame([(v,) for v in values], "x double").repartition(parts)
    return moments(with_limbs(df, F.col("x")).agg(*moment_sums()).first())


def exact(values):
    fractions = [Fraction(v) for v in values]
    mean = sum(fractions) / len(fractions)
    square = sum((x - mean) ** 2 for x in fractions) / (len(fractions) - 1)
    return float(mean), math.sqrt(square)


CASES = {
    "wide": [random.Random(1).uniform(-1, 1) * 10 ** random.Random(k).randrange(-6, 11) for k in range(300)],
    "close to a far mean": [1e9 + k * 1e-6 for k in range(200)],
    "tiny": [k * 1e-9 for k in range(-50, 99)],
    "equal": [0.1] * 77,
    "signs": [-(2.0**39), 2.0**39, 1.0, -1.0, 0.0, -0.0, 1e-300],
}


@pytest.mark.parametrize("name", CASES)
def test_moments_are_those_of_fractions_for_any_order(spark, name):
    values = list(CASES[name])
    found = set()
    for seed in range(3):
        random.Random(seed).shuffle(values)
        found.add(measured(spark, values, 1 + 3 * seed))
    assert len(found) == 1
    mean, deviation = found.pop()
    assert mean == pytest.approx(exact(values)[0], rel=1e-15, abs=1e-24)
    assert deviation == pytest.approx(exact(values)[1], rel=1e-12, abs=1e-24)


def test_what_has_no_moments(spark):
    assert measured(spark, []) == (None, None)
    assert measured(spark, [None, None]) == (None, None)
    assert measured(spark, [5.5, None]) == (5.5, None)
    assert measured(spark, [1.0, None, 3.0]) == (2.0, math.sqrt(2))
    for odd in (math.nan, math.inf, -math.inf):
        assert all(map(math.isnan, measured(spark, [1.0, odd, 2.0])))


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_values_out_of_range_raise(spark, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        with pytest.raises(Exception, match="too large for exact moments"):
            measured(spark, [1.0, 2.0**40])
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_sums_beyond_64_bits_raise(spark):
    row = with_limbs(spark.createDataFrame([(1.0,), (2.0,)], "x double"), F.col("x")).agg(*moment_sums()).first()
    with pytest.raises(OverflowError):
        moments(row.asDict() | {"m_s1": None})


@pytest.mark.parametrize("side", [-1e-12, 1e-12])
def test_a_row_next_to_the_threshold_is_flagged_alike_for_any_order(spark, side):
    rng = random.Random(7)
    values = [rng.gauss(50, 3) + rng.random() * 1e-7 for _ in range(400)]

    def beyond(x):
        mean, deviation = exact([*values, x])
        return x - mean - 2 * deviation

    low, high = 50.0, 200.0
    while high - low > 1e-14 * 200:
        middle = (low + high) / 2
        low, high = (middle, high) if beyond(middle) < 0 else (low, middle)
    values.append(high + side)
    for seed in range(4):
        order = list(enumerate(values))
        random.Random(seed).shuffle(order)
        df = spark.createDataFrame([(i, v, 0.0) for i, v in order], "id int, power_output double, expected_power double")
        flagged = dict(rows(flag_zscore(df.repartition(1 + seed * 2)), "id", "z_anomaly"))
        assert flagged[400] == (1 if side > 0 else 0)


def test_moments_cost_no_shuffle_of_rows(spark):
    df = spark.range(100).selectExpr("id", "CAST(id AS double) AS x")
    text = with_limbs(df, F.col("x")).agg(*moment_sums())._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange") == 1 and "partial_try_sum" in text
