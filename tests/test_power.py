from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from fleetpulse.operators.power import (
    flag_zscore,
    round_power,
    with_expected_power,
    with_residual,
)
from fleetpulse.params import Params
from tests.helpers import final_plan, plan, rows

POWERS = "id int, power_output double, expected_power double"


def residuals(spark, *values):
    return spark.createDataFrame(
        [(i, float(v), 0.0) for i, v in enumerate(values)], POWERS
    )


def flags(df):
    return [flag for _, flag in sorted(rows(df, "id", "z_anomaly"))]


def test_expected_power(spark):
    df = spark.createDataFrame([(5.0,), (0.0,), (30.0,)], "wind_speed double")
    expected = [0.5 * 1.2 * 5024 * v**3 * 0.45 / 1e6 for v in (0.0, 5.0, 30.0)]
    found = [p for _, p in rows(with_expected_power(df))]
    assert sorted(found) == pytest.approx(expected, rel=1e-12)


def test_power_curve_parameters(spark):
    df = spark.createDataFrame([(10.0,)], "wind_speed double")
    params = Params(air_density=1.0, swept_area=2000, power_coefficient=0.5)
    assert rows(with_expected_power(df, params)) == [(10.0, pytest.approx(0.5))]


def test_far_residual_is_flagged(spark):
    assert flags(flag_zscore(residuals(spark, 1, 1, 1, 1, 1, 1, 50))) == [0] * 6 + [1]


def test_threshold_is_a_parameter(spark):
    df = residuals(spark, 1, 1, 1, 1, 1, 1, 50)
    assert flags(flag_zscore(df, Params(zscore_threshold=3.0))) == [0] * 7


@pytest.mark.parametrize("values", [(), (3,), (2, 2, 2, 2, 2, 2, 2)])
def test_undefined_or_zero_deviation_flags_nothing(spark, values):
    df = flag_zscore(residuals(spark, *values))
    assert flags(df) == [0] * len(values)
    assert dict(df.dtypes)["z_anomaly"] == "int"


def test_statistics_span_all_turbines_and_use_the_sample_deviation(spark):
    rng = np.random.default_rng(3)
    values = np.concatenate([rng.normal(0, 1, 40), rng.normal(9, 1, 4)])
    df = residuals(spark, *values).repartition(3)
    expected = np.abs(values - values.mean()) > 2 * values.std(ddof=1)
    assert flags(flag_zscore(df)) == expected.astype(int).tolist()
    assert expected.sum() == 4


def test_no_join_no_shuffle_of_rows_and_one_pass_for_statistics(spark, tmp_path):
    residuals(spark, *range(50)).write.parquet(f"{tmp_path}/r")
    df = flag_zscore(spark.read.parquet(f"{tmp_path}/r"))
    assert "Join" not in plan(df)
    text = final_plan(df)
    assert "partial_try_sum" in text
    assert "ReusedSubquery" in text


def test_rounding(spark):
    df = spark.createDataFrame([(1, 1.005, 0.125), (2, 2.004, 1.006)], POWERS)
    rounded = round_power(with_residual(df))
    assert rows(rounded) == [(1, 1.01, 0.13, 0.88), (2, 2.0, 1.01, 0.99)]
    assert rounded.columns == ["id", "power_output", "expected_power", "error"]


def test_rounded_residual_is_the_difference_of_rounded_powers(spark):
    # Unrounded difference 0.0098 would give 0.01.
    df = spark.createDataFrame([(1, 1.0149, 1.0051)], POWERS)
    assert rows(round_power(df), "error") == [(0.0,)]


def test_flags_see_unrounded_values(spark):
    # 0.004 is far from the zeros, but would vanish if rounded first.
    df = flag_zscore(residuals(spark, 0, 0, 0, 0, 0, 0, 0.004))
    assert flags(round_power(df)) == [0] * 6 + [1]
    early = round_power(residuals(spark, 0, 0, 0, 0, 0, 0, 0.004))
    assert flags(flag_zscore(early)) == [0] * 7


def test_unused_flag_costs_no_statistics(spark):
    df = flag_zscore(residuals(spark, 1, 2, 3)).select("id")
    assert "Subquery" not in plan(df)
    assert df.agg(F.count(F.lit(1))).first()[0] == 3
