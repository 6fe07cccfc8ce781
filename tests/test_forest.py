from __future__ import annotations

import math
import os
import subprocess
import sys

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fleetpulse.functions.trees import mean_path
from fleetpulse.operators.forest import (
    FEATURES,
    fit_forest,
    flag_above_quantile,
    flag_outliers,
    outlier_score,
    sampled,
)
from fleetpulse.params import Params
from tests.helpers import plan, rows, shared_files
from tests.test_trees import descend

READINGS = "id long, wind_speed double, expected_power double, power_output double"
FEW = Params(trees=20, max_samples=64)


def cloud(spark, n=400, seed=0, far=()):
    rng = np.random.default_rng(seed)
    values = rng.normal(5.0, 1.0, (n, 3))
    for place in far:
        values[place] = (60.0, 90.0, 0.0)
    data = [(i, *map(float, v)) for i, v in enumerate(values)]
    return spark.createDataFrame(data, READINGS)


def flags(df):
    return {row["id"]: row["if_anomaly"] for row in df.select("id", "if_anomaly").collect()}


def test_planted_outliers_are_flagged_and_share_is_bounded(spark):
    far = range(0, 400, 40)
    found = flags(flag_outliers(cloud(spark, far=far), FEW, key=("id",)).frame)
    assert len(found) == 400
    assert all(found[place] == 1 for place in far)
    assert 0.10 * 400 < sum(found.values()) <= math.ceil(0.15 * 400)


def test_contamination_is_a_parameter(spark):
    params = Params(trees=20, max_samples=64, contamination_rate=0.05)
    found = flags(flag_outliers(cloud(spark), params, key=("id",)).frame)
    assert 0 < sum(found.values()) <= 20


def test_partitioning_and_row_order_change_nothing(spark):
    df = cloud(spark, far=(3, 77))
    expected = flags(flag_outliers(df, FEW, key=("id",)).frame)
    for copy in (df.repartition(7), df.orderBy(F.rand(5)).coalesce(2)):
        assert flags(flag_outliers(copy, FEW, key=("id",)).frame) == expected


def test_seed_changes_the_trees(spark):
    df = cloud(spark)
    first = fit_forest(df, FEW, key=("id",))
    again = fit_forest(df, FEW, key=("id",))
    other = fit_forest(df, Params(trees=20, max_samples=64, seed=7), key=("id",))
    assert all(
        np.array_equal(a.threshold, b.threshold) for a, b in zip(first.trees, again.trees)
    )
    assert not np.array_equal(first.trees[0].threshold, other.trees[0].threshold)


def test_scores_equal_brute_force_over_the_whole_frame(spark):
    df = cloud(spark, n=300)
    model = fit_forest(df, FEW, key=("id",))
    assert (len(model.trees), model.sample_size) == (20, 64)
    for row in outlier_score(df.repartition(3), model).collect():
        values = [row[name] for name in FEATURES]
        depth = np.mean([descend(tree, values) for tree in model.trees])
        assert row["score"] == pytest.approx(2.0 ** (-depth / mean_path(64)), rel=1e-12)
        assert 0.0 < row["score"] <= 1.0


def test_flags_equal_numpy_percentile(spark):
    df = cloud(spark, n=357)
    scored = outlier_score(df, fit_forest(df, FEW, key=("id",))).persist()
    scores = {row["id"]: row["score"] for row in scored.collect()}
    cut = np.percentile(list(scores.values()), 85)
    found = flags(flag_above_quantile(scored, FEW))
    assert found == {i: int(score > cut) for i, score in scores.items()}


@settings(
    max_examples=6,
    deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture],
)
@given(
    st.lists(
        st.tuples(*[st.floats(-1e6, 1e6)] * 3), min_size=1, max_size=40
    ),
    st.sampled_from([0.05, 0.15, 0.5]),
)
def test_share_never_exceeds_contamination(spark, values, contamination):
    params = Params(trees=4, max_samples=16, contamination_rate=contamination)
    df = spark.createDataFrame([(i, *v) for i, v in enumerate(values)], READINGS)
    found = flags(flag_outliers(df, params, key=("id",)).frame)
    assert len(found) == len(values)
    assert sum(found.values()) <= math.ceil(contamination * len(values))


@pytest.mark.parametrize("n", [0, 1, 2, 3])
def test_few_rows(spark, n):
    df = cloud(spark).where(F.col("id") < n)
    flagged = flag_outliers(df, FEW, key=("id",)).frame
    assert dict(flagged.dtypes)["if_anomaly"] == "int"
    assert flagged.columns == [*df.columns, "error", "if_anomaly"]
    assert set(flags(flagged).values()) <= {0, 1}
    assert flagged.count() == n


def test_equal_rows_are_not_flagged(spark):
    df = spark.range(50).selectExpr(
        "id", "1D AS wind_speed", "2D AS expected_power", "3D AS power_output"
    )
    assert set(flags(flag_outliers(df, FEW, key=("id",)).frame).values()) == {0}


@pytest.mark.parametrize("bad", [float("inf"), float("nan"), None])
def test_unusable_features_are_refused(spark, bad):
    df = spark.createDataFrame([(1, 1.0, 1.0, bad), (2, 1.0, 1.0, 1.0)], READINGS)
    with pytest.raises(ValueError, match="1 rows have a missing or infinite value"):
        fit_forest(df, FEW)


def test_powers_are_rounded_after_the_forest(spark):
    df = spark.createDataFrame([(1, 5.0, 1.006, 2.004), (2, 5.0, 1.0, 3.0)], READINGS)
    flagged = flag_outliers(df, FEW, key=("id",)).frame
    assert rows(flagged, "id", "power_output", "expected_power", "error") == [
        (1, 2.0, 1.01, 0.99),
        (2, 3.0, 1.0, 2.0),
    ]


def numbered(spark, n):
    return spark.range(n).selectExpr("id", "CAST(id AS DOUBLE) AS x")


def drawn(df, params, n):
    frame = sampled(df, ("x",), ("id",), params, n)
    return frame.toPandas()


def test_every_tree_sees_all_rows_of_a_small_table(spark):
    found = drawn(numbered(spark, 90), Params(trees=7, max_samples=64), 90)
    assert len(found) == 7 * 90
    assert all(sorted(group.x) == list(range(90)) for _, group in found.groupby("tree"))
    assert found.groupby("tree").place.nunique().min() == 90


def test_sample_is_uniform_and_large_enough_for_every_tree(spark):
    found = drawn(numbered(spark, 200_000), Params(trees=20, max_samples=256), 200_000)
    sizes = found.groupby("tree").size()
    assert len(sizes) == 20 and sizes.min() >= 256
    expected = 20 * 512
    assert abs(len(found) - expected) < 6 * math.sqrt(expected)
    counts, _ = np.histogram(found.x, bins=10, range=(0, 200_000))
    assert np.abs(counts - expected / 10).max() < 6 * math.sqrt(expected / 10)


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("size", [16, 1024])
def test_copies_enter_the_sample_in_proportion(spark, seed, size):
    """A third of the rows are one reading: neither absent nor all there is."""
    found = drawn(copies(spark, 120_000), Params(trees=20, max_samples=size, seed=seed), 120_000)
    share = (found.x == -1.0).mean()
    assert share == pytest.approx(1 / 3, abs=6 * math.sqrt(2 / 9 / len(found)))


def copies(spark, n):
    df = numbered(spark, n).selectExpr("IF(id % 3 = 0, -1, id) AS id", "x")
    return df.withColumn("x", F.when(F.col("id") == -1, -1.0).otherwise(F.col("x")))


def test_copies_do_not_make_flags_depend_on_partitions(spark):
    df = copies(spark, 60_000).selectExpr(
        "id",
        "x % 25 AS wind_speed",
        "x % 7 AS expected_power",
        "x % 11 + x / 60000 AS power_output",
    )
    counts = []
    for parts in (3, 7):
        staged = flag_outliers(df.repartition(parts), FEW, key=("id",))
        counts.append(rows(staged.frame.groupBy("id", "if_anomaly").count()))
        staged.discard()
    assert counts[0] == counts[1]
    assert 0 < sum(n for _, flag, n in counts[0] if flag) <= 9_000


def test_a_failing_cut_leaves_no_scores(spark, monkeypatch):
    before = shared_files(spark)

    def refuse(*_):
        raise OSError("no ranks")

    monkeypatch.setattr("fleetpulse.operators.forest.exact_quantile", refuse)
    with pytest.raises(OSError, match="no ranks"):
        flag_outliers(cloud(spark), FEW, key=("id",))
    assert shared_files(spark) == before


def test_scoring_moves_no_rows(spark, tmp_path):
    cloud(spark).write.parquet(f"{tmp_path}/r")
    df = spark.read.parquet(f"{tmp_path}/r")
    text = plan(outlier_score(df, fit_forest(df, FEW, key=("id",))))
    assert "ArrowEvalPython" in text
    assert "Exchange" not in text and "Join" not in text


def test_executors_need_no_package(tmp_path):
    """A session started elsewhere grows and scores without the package on its path."""
    code = (
        f"import sys; sys.path.insert(0, {os.getcwd()!r})\n"
        "from pyspark.sql import SparkSession\n"
        "spark = (SparkSession.builder.master('local[2]').config('spark.ui.enabled', 'false')\n"
        "  .config('spark.sql.shuffle.partitions', '2').getOrCreate())\n"
        "from fleetpulse.operators.forest import flag_outliers\n"
        "df = spark.range(60).selectExpr('id', 'id % 7D AS wind_speed', '1D AS expected_power',\n"
        "  'id % 11D AS power_output')\n"
        "print('rows', flag_outliers(df, key=('id',)).frame.count())\n"
    )
    path = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run(
        [sys.executable, "-c", code], cwd=tmp_path, env=path, capture_output=True, text=True
    )
    assert "rows 60" in done.stdout, done.stderr[-2000:]
