from __future__ import annotations

import pytest

from fleetpulse.operators.fleet import combine_flags, drop_faulty, rate_turbines
from fleetpulse.params import Params
from fleetpulse.sources.staging import stage
from tests.helpers import final_plan, plan, rows

FLAGS = "turbine_id int, z_anomaly int, if_anomaly int"
FLAGGED = "turbine_id int, combined_anomaly int"


def flagged(spark, **share):
    """``t1=(6, 10)``: turbine 1 has 6 anomalous readings of 10."""
    data = []
    for name, (bad, total) in share.items():
        turbine = int(name[1:]) if name != "none" else None
        data += [(turbine, 1)] * bad + [(turbine, 0)] * (total - bad)
    return spark.createDataFrame(data, FLAGGED)


def test_flag_truth_table_with_nulls(spark):
    cases = {
        (0, 0): 0, (1, 0): 1, (0, 1): 1, (1, 1): 1, (None, 1): 1, (1, None): 1,
        (None, 0): 0, (0, None): 0, (None, None): 0,
    }
    df = spark.createDataFrame([(1, *flags) for flags in cases], FLAGS)
    combined = combine_flags(df)
    assert dict(combined.dtypes)["combined_anomaly"] == "int"
    found = {(z, i): c for _, z, i, c in rows(combined)}
    assert found == cases


def test_rating_bounds_are_strict(spark):
    df = flagged(
        spark, t1=(6, 10), t2=(601, 1000), t3=(3, 10), t4=(301, 1000), t5=(0, 4), t6=(4, 4)
    )
    assert rows(rate_turbines(df), "turbine_id", "turbine_status") == [
        (1, "REVIEW_REQUIRED"),
        (2, "FAULTY_SENSOR"),
        (3, "NORMAL"),
        (4, "REVIEW_REQUIRED"),
        (5, "NORMAL"),
        (6, "FAULTY_SENSOR"),
    ]


def test_rating_columns(spark):
    rated = rate_turbines(flagged(spark, t1=(1, 4)))
    assert rated.dtypes == [
        ("turbine_id", "int"),
        ("total_anomalies", "bigint"),
        ("total_records", "bigint"),
        ("anomaly_rate", "double"),
        ("turbine_status", "string"),
    ]
    assert rows(rated) == [(1, 1, 4, 0.25, "NORMAL")]


def test_bounds_are_parameters(spark):
    df = flagged(spark, t1=(1, 4))
    params = Params(faulty_rate=0.2, review_rate=0.1)
    assert rows(rate_turbines(df, params), "turbine_status") == [("FAULTY_SENSOR",)]


def test_null_ids_form_a_turbine_and_null_flags_do_not_count(spark):
    df = spark.createDataFrame(
        [(None, 1), (None, 1), (1, None), (1, None), (2, 1), (2, None)], FLAGGED
    )
    assert rows(rate_turbines(df)) == [
        (1, None, 2, None, "NORMAL"),
        (2, 1, 2, 0.5, "REVIEW_REQUIRED"),
        (None, 2, 2, 1.0, "FAULTY_SENSOR"),
    ]


def test_faulty_turbines_go_and_the_rest_keep_all_their_rows(spark):
    df = flagged(spark, t1=(4, 4), t2=(2, 4), t3=(1, 4), none=(0, 3))
    healthy = drop_faulty(df, rate_turbines(df))
    assert healthy.columns == ["turbine_id", "combined_anomaly", "turbine_status"]
    assert rows(healthy) == (
        [(2, 0, "REVIEW_REQUIRED")] * 2
        + [(2, 1, "REVIEW_REQUIRED")] * 2
        + [(3, 0, "NORMAL")] * 3
        + [(3, 1, "NORMAL")]
    )


def test_rows_without_a_rating_are_dropped(spark):
    df = flagged(spark, t1=(0, 1), t2=(0, 1))
    ratings = rate_turbines(flagged(spark, t1=(0, 1)))
    assert rows(drop_faulty(df, ratings), "turbine_id") == [(1,)]


def test_rating_combines_before_its_only_shuffle(spark):
    text = plan(rate_turbines(flagged(spark, t1=(1, 2))), "simple")
    assert text.count("Exchange hashpartitioning(turbine_id") == 1
    assert text.index("partial_sum") > text.index("Exchange")


def test_join_is_broadcast_by_size_only(spark):
    df = flagged(spark, t1=(1, 4), t2=(4, 4))
    expected = rows(drop_faulty(df, rate_turbines(df)))
    assert "BroadcastHashJoin" in final_plan(drop_faulty(df, rate_turbines(df)))
    limits = (
        "spark.sql.autoBroadcastJoinThreshold",
        "spark.sql.adaptive.autoBroadcastJoinThreshold",
    )
    try:
        for limit in limits:
            spark.conf.set(limit, -1)
        joined = drop_faulty(df, rate_turbines(df))
        assert "SortMergeJoin" in final_plan(joined)
        assert rows(joined) == expected
    finally:
        for limit in limits:
            spark.conf.unset(limit)


def test_hot_turbine_is_split_when_the_join_shuffles(spark, tmp_path):
    """A turbine with most of the rows must not land in one task."""
    spark.range(0, 400_000, 1, 8).selectExpr(
        "IF(id % 10 < 9, 1, CAST(id % 97 AS INT)) AS turbine_id",
        "CAST(id % 11 = 0 AS INT) AS combined_anomaly",
        "CAST(id AS STRING) AS payload",
    ).write.parquet(f"{tmp_path}/hot")
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    df = spark.read.parquet(f"{tmp_path}/hot")
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        ratings = stage(rate_turbines(df), "ratings").frame
        joined = drop_faulty(df, ratings)
        text = final_plan(joined)
    finally:
        for name in settings:
            spark.conf.unset(name)
    assert "skew=true" in text
    assert joined.count() == df.count()


@pytest.mark.parametrize("bad", [{"contamination_rate": 0.0}, {"trees": 0}, {"seed": -1}])
def test_parameters_are_checked(bad):
    with pytest.raises(ValueError):
        Params.from_config(bad)


def test_parameters_from_a_mapping():
    params = Params.from_config({"zscore_threshold": 3.0})
    assert (params.zscore_threshold, params.contamination_rate) == (3.0, 0.15)
    assert Params.from_config(None) == Params()


def test_keys_of_other_jobs_are_passed_over(caplog):
    params = Params.from_config({"seed": 7, "retries": 3})
    assert params == Params(seed=7)
    assert "retries" in caplog.text
