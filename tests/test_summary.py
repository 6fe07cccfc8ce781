from __future__ import annotations

import random
from datetime import datetime
from decimal import ROUND_HALF_UP, Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from fleetpulse.operators.summary import summarize_power
from fleetpulse.params import Params
from tests.helpers import plan, rows

POWER = "timestamp timestamp, power_output double, turbine_id int"


def at(day, hour=0, minute=0):
    return datetime(2021, 1, day, hour, minute)


def test_one_row_per_turbine_and_day(spark):
    df = spark.createDataFrame(
        [
            (at(1), 10.0, 1),
            (at(1, 23, 59), 30.0, 1),
            (at(2), 50.0, 1),
            (at(1, 12), 7.0, 2),
            (at(1, 12), 8.0, None),
        ],
        POWER,
    )
    summary = summarize_power(df)
    assert summary.columns == [
        "turbine_id", "window_start", "min_power", "max_power", "avg_power",
    ]
    assert rows(summary) == [
        (1, at(1), 10.0, 30.0, 20.0),
        (1, at(2), 50.0, 50.0, 50.0),
        (2, at(1), 7.0, 7.0, 7.0),
        (None, at(1), 8.0, 8.0, 8.0),
    ]


def test_text_timestamps_and_null_timestamps(spark):
    df = spark.createDataFrame(
        [("2023-06-30 23:59:59", 1.25, 4), ("2023-06-30 08:15:00", 0.75, 4), (None, 3.5, 4)],
        "timestamp string, power_output double, turbine_id int",
    )
    assert rows(summarize_power(df)) == [(4, datetime(2023, 6, 30), 0.75, 1.25, 1.0)]


def test_window_length_is_a_parameter(spark):
    df = spark.createDataFrame([(at(1, 5), 1.0, 1), (at(1, 7), 3.0, 1)], POWER)
    summary = summarize_power(df, Params(summary_window="6 hours"))
    assert rows(summary, "window_start") == [(at(1),), (at(1, 6),)]


def test_days_are_utc_in_any_session_zone(spark):
    df = spark.sql(
        """SELECT timestamp_seconds(s) AS timestamp, 1.0D AS power_output,
                  1 AS turbine_id
           FROM VALUES (86399), (86400), (172799) AS t(s)"""
    )
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        starts = summarize_power(df).selectExpr("unix_seconds(window_start)")
        assert rows(starts) == [(0,), (86400,)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_zoneless_timestamps_stay_zoneless(spark):
    df = spark.sql(
        "SELECT timestamp_ntz'2021-01-01 23:59:59' AS timestamp, 1.0D AS power_output,"
        " 1 AS turbine_id"
    )
    summary = summarize_power(df)
    assert dict(summary.dtypes)["window_start"] == "timestamp_ntz"
    assert rows(summary, "window_start") == [(at(1),)]


def test_half_cents_round_up(spark):
    df = spark.createDataFrame([(at(1), 1.005, 1), (at(1), 1.005, 1)], POWER)
    assert rows(summarize_power(df)) == [(1, at(1), 1.01, 1.01, 1.01)]


def test_mean_does_not_depend_on_row_order(spark):
    values = [10.07, 10.08] * 50 + [0.1, 20.05] * 50
    exact = sum(round(v * 1000) for v in values) / len(values) / 1000
    assert exact == 10.075
    for seed in range(4):
        random.Random(seed).shuffle(values)
        df = spark.createDataFrame([(at(1), v, 1) for v in values], POWER)
        assert rows(summarize_power(df.repartition(seed + 1)), "avg_power") == [(10.08,)]


@pytest.mark.parametrize(
    ("values", "mean"),
    [
        ([float("inf"), 1.0], float("inf")),
        ([1e15, 3e15], 2e15),
        ([None, 2.0, 4.0], 3.0),
        ([-1.005, -1.005], -1.01),
        ([-0.001, -0.003], 0.0),
        ([-0.5, 1.51], 0.51),
        ([4.4e7 + 0.01, 4.4e7 + 0.02], 4.4e7 + 0.02),
        ([4.6e7, 4.8e7], 4.7e7),
        ([5e12, 1e12 + 0.01], 3e12 + 0.01),
        ([None, None], None),
    ],
)
def test_values_beyond_decimals(spark, values, mean):
    df = spark.createDataFrame([(at(1), v, 1) for v in values], POWER)
    assert rows(summarize_power(df), "avg_power") == [(mean,)]


@settings(
    max_examples=20,
    deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture],
)
@given(st.lists(st.integers(-10_000_000, 10_000_000), min_size=1, max_size=30))
def test_mean_of_cents_is_exact(spark, cents):
    df = spark.createDataFrame([(at(1), c / 100, 1) for c in cents], POWER)
    mean = Decimal(sum(cents)) / len(cents) / 100
    expected = float(mean.quantize(Decimal("0.01"), ROUND_HALF_UP))
    assert rows(summarize_power(df), "avg_power") == [(expected,)]


def test_many_large_values_do_not_overflow(spark):
    df = spark.range(3_000_000).selectExpr(
        "timestamp'2021-01-01' AS timestamp",
        "44000000D + (id % 2) / 100 AS power_output",
        "1 AS turbine_id",
    )
    assert rows(summarize_power(df), "avg_power") == [(44000000.01,)]


def test_one_large_value_changes_no_order(spark):
    values = [5e7, *(1.0 + i / 100 for i in range(199))]
    exact = sum(round(v * 100) for v in values) / 100 / len(values)
    for seed in range(3):
        random.Random(seed).shuffle(values)
        df = spark.createDataFrame([(at(1), v, 1) for v in values], POWER)
        mean = rows(summarize_power(df.repartition(seed + 2)), "avg_power")
        assert mean == [(round(exact + 1e-9, 2),)]


@pytest.mark.parametrize("ansi", ["true", "false"])
@pytest.mark.parametrize("values", [[1e23, 1.0, 3.0], [2.0**52], [-1e300]])
def test_values_beyond_the_range_raise(spark, ansi, values):
    df = spark.createDataFrame([(at(1), v, 1) for v in values], POWER)
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        with pytest.raises(Exception, match="too large for an exact mean"):
            summarize_power(df).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)



def test_nan_gives_nan(spark):
    df = spark.createDataFrame([(at(1), float("nan"), 1), (at(1), 1.0, 1)], POWER)
    assert str(summarize_power(df).first()["avg_power"]) == "nan"


def test_reads_three_columns_and_combines_before_the_shuffle(spark, tmp_path):
    spark.createDataFrame([(at(1), 1.0, 1)], POWER).selectExpr(
        "*", "'x' AS other"
    ).write.parquet(f"{tmp_path}/r")
    text = plan(summarize_power(spark.read.parquet(f"{tmp_path}/r")))
    assert "other" not in text
    assert "PushedFilters: [IsNotNull(timestamp)]" in text
    assert "partial_min" in text
    assert text.count("hashpartitioning") == 1
    assert "Expand" not in text and "SortAggregate" not in text
