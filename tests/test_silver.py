from __future__ import annotations

import math
from datetime import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from fleetpulse.operators.silver import (
    clean_readings,
    merge_feeds,
    standardize_site_feed,
    void_negative_power,
)
from fleetpulse.schema import ESSENTIAL_COLUMNS
from fleetpulse.params import Params
from tests.helpers import plan, rows

READINGS = "turbine_id int, wind_speed double, timestamp string, power_output double"
NAN, INF = float("nan"), float("inf")


def test_dirty_readings_are_dropped(spark):
    raw = spark.createDataFrame(
        [
            (31, 11.5, "2019-08-04 03:10:00", 2.75),
            (31, 0.25, "2019-08-04 03:20:00", -0.01),
            (32, None, "2019-08-04 03:30:00", 1.5),
            (32, 6.0, None, 0.625),
            (33, 6.5, "2019-08-04 03:50:00", None),
            (33, 9.0, "2019-08-04 04:00:00", 0.5),
        ],
        READINGS,
    )
    kept = rows(clean_readings(raw), "turbine_id", "power_output")
    assert kept == [(31, 2.75), (33, 0.5)]
    assert clean_readings(raw).columns == raw.columns


def test_special_values(spark):
    raw = spark.createDataFrame(
        [(None, w, "t", p) for p, w in [
            (NAN, 1.0), (-0.0, 2.0), (0.0, 3.0), (INF, 4.0), (-INF, 5.0), (1.0, NAN),
        ]],
        READINGS,
    )
    kept = rows(clean_readings(raw), "wind_speed", "power_output", "turbine_id")
    assert kept == [(2.0, -0.0, None), (3.0, 0.0, None), (4.0, INF, None)]
    assert math.copysign(1.0, kept[0][1]) == -1.0


def test_negative_power_becomes_null(spark):
    powers = [-1.0, -0.0, 0.0, 2.0, None, INF, -INF]
    raw = spark.createDataFrame([(str(i), p) for i, p in enumerate(powers)],
                                "timestamp string, power_output double")
    assert rows(void_negative_power(raw), "timestamp", "power_output") == [
        ("0", None), ("1", -0.0), ("2", 0.0), ("3", 2.0), ("4", None), ("5", INF),
        ("6", None),
    ]


number = st.one_of(st.none(), st.floats(), st.sampled_from([0.0, -0.0, NAN, INF]))


@settings(
    max_examples=15,
    deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture],
)
@given(st.lists(st.tuples(st.sampled_from(["t", None]), number, number), max_size=30))
def test_cleaning_keeps_exactly_the_usable(spark, readings):
    def usable(value):
        return value is not None and not math.isnan(value)

    expected = [
        r for r in readings
        if r[0] is not None and usable(r[1]) and usable(r[2]) and not r[1] < 0
    ]
    raw = spark.createDataFrame([(1, w, t, p) for t, p, w in readings], READINGS)
    kept = rows(clean_readings(raw), "timestamp", "power_output", "wind_speed")
    assert kept == sorted(expected, key=repr)
    two_steps = void_negative_power(raw).dropna(subset=list(ESSENTIAL_COLUMNS))
    assert rows(two_steps, "timestamp", "power_output", "wind_speed") == kept


def test_site_feed_gets_the_common_layout(spark):
    raw = spark.createDataFrame(
        [(8, "/raw/location4.csv", "NNW", 13.75, 0.2, "2020-02-29 23:00:00")],
        "turbine_id int, source_file string, winddirection_100m string,"
        " windspeed_100m double, Power double, Time string",
    )
    feed = standardize_site_feed(raw)
    assert feed.columns == [
        "turbine_id", "wind_direction", "wind_speed", "power_output", "timestamp",
    ]
    assert rows(feed) == [(8, "NNW", 13.75, 0.9, datetime(2020, 2, 29, 23))]


def test_rated_power_is_a_parameter(spark):
    raw = spark.createDataFrame(
        [(211.0, 0.75, "2019-11-05 04:50:00", 6.5)],
        "winddirection_100m double, Power double, Time string, windspeed_100m double",
    )
    feed = standardize_site_feed(raw, Params(rated_power=8.0))
    assert rows(feed, "power_output") == [(6.0,)]


def test_site_times(spark):
    layout = (
        "windspeed_100m double, Time string, winddirection_100m double, Power double"
    )
    raw = spark.createDataFrame(
        [(4.5, "soon", 17.0, 0.1), (9.0, "2018-04-31 06:00:00", 300.0, 0.3)], layout
    )
    feed = standardize_site_feed(raw)
    assert rows(feed, "timestamp") == [(None,), (None,)]
    assert clean_readings(feed).count() == 0
    typed = raw.selectExpr(
        "timestamp'2016-07-19 22:15:31' AS Time", "Power", "windspeed_100m",
        "winddirection_100m",
    )
    assert rows(standardize_site_feed(typed), "timestamp")[0] == (
        datetime(2016, 7, 19, 22, 15, 31),
    )


def test_merge_matches_names_and_keeps_duplicates(spark):
    fleet = spark.createDataFrame([(7, 8.5, "noon", 1.125)] * 2, READINGS)
    sites = spark.createDataFrame(
        [(0.375, "dusk", 3.25, 40), (-0.5, "dawn", 3.0, 40)],
        "power_output double, timestamp string, wind_speed double, turbine_id int",
    )
    merged = merge_feeds(fleet, sites)
    assert merged.columns == fleet.columns
    assert rows(merged) == [(40, 3.25, "dusk", 0.375)] + [(7, 8.5, "noon", 1.125)] * 2


def test_merge_refuses_unequal_columns(spark):
    fleet = spark.createDataFrame([(7, 8.5, "noon", 1.125)], READINGS)
    with pytest.raises(Exception, match="turbine_id|column"):
        merge_feeds(fleet, fleet.drop("turbine_id")).collect()


def test_merge_widens_numbers(spark):
    fleet = spark.createDataFrame(
        [("a", 10, 5.0)], "timestamp string, power_output int, wind_speed double"
    )
    sites = spark.createDataFrame(
        [("b", 2.5, 6)], "timestamp string, power_output double, wind_speed int"
    )
    merged = merge_feeds(fleet, sites)
    assert [kind for _, kind in merged.dtypes] == ["string", "double", "double"]
    assert rows(merged) == [("a", 10.0, 5.0), ("b", 2.5, 6.0)]


def test_cleaning_reaches_the_scan(spark, tmp_path):
    spark.createDataFrame([(1, 5.0, "a", 10.0)], READINGS).write.parquet(
        f"{tmp_path}/readings"
    )
    cleaned = clean_readings(spark.read.parquet(f"{tmp_path}/readings"))
    text = plan(cleaned.select("wind_speed"))
    for pushed in (
        "IsNotNull(timestamp)",
        "IsNotNull(wind_speed)",
        "GreaterThanOrEqual(power_output,0.0)",
    ):
        assert pushed in text
    assert "turbine_id" not in text
    assert "Exchange" not in text
