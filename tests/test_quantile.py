from __future__ import annotations

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from fleetpulse.operators.quantile import exact_quantile


def column(spark, values):
    return spark.createDataFrame([(float(v),) for v in values], "v double")


scores = st.one_of(
    st.floats(-3.0, 1e6), st.sampled_from([0.0, 0.25, 0.5, 0.5 + 2**-40, 1.0])
)


@settings(
    max_examples=12,
    deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture],
)
@given(
    st.lists(scores, min_size=1, max_size=40), st.floats(0.0, 1.0), st.sampled_from([1, 5, 100])
)
def test_equals_numpy(spark, values, fraction, fetch_limit):
    found = exact_quantile(column(spark, values), "v", fraction, fetch_limit)
    assert found == pytest.approx(np.percentile(values, fraction * 100), rel=1e-12, abs=1e-12)


def test_narrow_clusters_take_several_passes(spark):
    values = 0.5 + np.arange(3000) * 2.0**-50
    frame = column(spark, values)
    found = exact_quantile(frame, "v", 0.85, fetch_limit=1)
    assert found == pytest.approx(np.percentile(values, 85), abs=2.0**-52)


def test_heavy_ties_are_never_fetched(spark):
    frame = spark.range(100_000).selectExpr("IF(id % 3 = 0, 0.7D, id / 200000) AS v")
    values = np.where(np.arange(100_000) % 3 == 0, 0.7, np.arange(100_000) / 200_000)
    for fraction in (0.5, 0.8, 0.85):
        found = exact_quantile(frame, "v", fraction, fetch_limit=10)
        assert found == pytest.approx(np.percentile(values, fraction * 100), abs=1e-12)


def test_no_rows(spark):
    assert exact_quantile(column(spark, []), "v", 0.5) is None


def test_values_have_no_bounds(spark):
    values = np.random.default_rng(3).uniform(0.0, 2.0, 1000)
    found = exact_quantile(column(spark, values), "v", 0.85)
    assert found == pytest.approx(np.percentile(values, 85), rel=1e-12)
    assert (values > found).sum() == 150


@pytest.mark.parametrize("bad", [None, float("nan"), float("inf")])
def test_values_without_a_rank_are_refused(spark, bad):
    frame = spark.createDataFrame([(1.0,), (bad,)], "v double")
    with pytest.raises(ValueError, match="1 rows have no finite v"):
        exact_quantile(frame, "v", 0.5)
