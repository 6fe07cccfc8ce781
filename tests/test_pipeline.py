from __future__ import annotations

import logging
import os
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from fleetpulse.operators.fleet import combine_flags, drop_faulty, rate_turbines
from fleetpulse.operators.forest import flag_outliers
from fleetpulse.operators.power import flag_zscore, with_expected_power
from fleetpulse.operators.summary import summarize_power
from fleetpulse.params import Params
from fleetpulse.plans.pipeline import (
    Layers,
    build_gold,
    run_all,
    run_bronze,
    run_gold,
    run_silver,
)
from fleetpulse.sources.tables import drop_schemas
from tests.helpers import plan, rows, shared_files
from tests.test_feeds import SITE_HEADER, write

PARAMS = Params(trees=20, max_samples=64)
LAYERS = Layers(bronze="p_bronze", silver="p_silver", gold="p_gold")


@pytest.fixture
def layers(spark):
    def clear():
        drop_schemas(spark, LAYERS.bronze, LAYERS.silver, LAYERS.gold)

    clear()
    yield LAYERS
    clear()


def raw_folder(tmp_path):
    """Three fleet turbines, one reporting nonsense for a day, and two sites."""
    rng = np.random.default_rng(1)
    start = datetime(2022, 3, 1)
    fleet = []
    for step in range(144):
        time = start + timedelta(minutes=30 * step)
        for turbine in (1, 2, 3):
            wind = rng.uniform(4, 14)
            power = 0.00135648 * wind**3 + rng.normal(0, 0.05)
            if turbine == 3:
                if step >= 48:
                    continue
                wind, power = 40 + step, 500.0 + step
            fleet.append(f"{time},{turbine},{wind:.2f},90,{max(power, 0.0):.2f}")
    header = "timestamp,turbine_id,wind_speed,wind_direction,power_output"
    write(tmp_path, "data_group_1.csv", header, *fleet[:200])
    write(tmp_path, "data_group_2.csv", header, *fleet[200:],
          f"{start},1,5,90,-3.0", f"{start},1,,90,1.0")
    for site in (1, 2):
        lines = [
            f"{start + timedelta(hours=h)},1,2,3,4,{5 + h % 7},6,7,8,{0.03 * (h % 7):.2f}"
            for h in range(48)
        ]
        write(tmp_path, f"Location{site}.csv", SITE_HEADER, *lines)
    return str(tmp_path)


def test_files_to_gold(spark, tmp_path, layers, caplog):
    with caplog.at_level(logging.INFO):
        run_all(spark, raw_folder(tmp_path), PARAMS, layers)
    for line in ("fleet: 338 rows", "sites: 96 rows", "kept: 432 rows"):
        assert line in caplog.text

    readings = spark.table(layers.readings)
    assert readings.columns == [
        "timestamp", "turbine_id", "wind_speed", "wind_direction", "power_output",
    ]
    assert readings.count() == 432
    assert rows(readings.select("turbine_id").distinct()) == [(i,) for i in range(1, 6)]

    ratings = dict(rows(spark.table(layers.ratings), "turbine_id", "turbine_status"))
    assert ratings[3] == "FAULTY_SENSOR"
    assert [ratings[t] for t in (1, 2, 4, 5)] == ["NORMAL"] * 4

    analysis = spark.table(layers.analysis)
    assert analysis.columns == [
        "turbine_id", "timestamp", "wind_speed", "wind_direction", "power_output",
        "expected_power", "error", "z_anomaly", "if_anomaly", "combined_anomaly",
        "turbine_status",
    ]
    assert analysis.count() == 432 - 48
    assert analysis.where("turbine_id = 3").count() == 0

    summary = spark.table(layers.summary)
    assert summary.columns == [
        "turbine_id", "window_start", "min_power", "max_power", "avg_power",
    ]
    assert rows(summary) == rows(summarize_power(analysis))
    # Three days for the fleet's two sound turbines, two for each site.
    assert summary.count() == 2 * 3 + 2 * 2


def test_layers_run_separately_and_again(spark, tmp_path, layers):
    folder = raw_folder(tmp_path)
    for _ in range(2):  # site ids come from the fleet table, so they do not drift
        run_bronze(spark, folder, layers)
    ids = spark.table(layers.site_feed).select("turbine_id").distinct()
    assert rows(ids) == [(4,), (5,)]
    assert spark.table(layers.site_feed).columns[-2:] == ["source_file", "turbine_id"]
    run_silver(spark, PARAMS, layers)
    run_gold(spark, PARAMS, layers)
    first = rows(spark.table(layers.ratings))
    run_gold(spark, PARAMS, layers, mode="append")
    assert rows(spark.table(layers.ratings)) == sorted(first * 2, key=repr)


def test_external_layers(spark, tmp_path, layers):
    external = Layers(layers.bronze, layers.silver, layers.gold,
                      root=str(tmp_path / "lake"), catalog="spark_catalog")
    run_all(spark, raw_folder(tmp_path), PARAMS, external)
    for table in (external.fleet_feed, external.readings, external.summary):
        assert os.path.isdir(f"{tmp_path}/lake/{table.replace('.', '/')}")


def gold_input(spark):
    """Turbine ids, times and a broken turbine, with one unknown id."""
    return spark.range(3000).selectExpr(
        "CAST(nullif(id % 12, 5) AS INT) AS turbine_id",
        "timestamp'2022-03-01 00:00:00' + make_dt_interval(0, 0, CAST(id AS INT)) AS timestamp",
        "CAST(4 + hash(id) % 50 / 10 + IF(id % 12 = 3, 60, 0) AS DOUBLE) AS wind_speed",
        "CAST(abs(hash(id, 1)) % 200 / 100 AS DOUBLE) AS power_output",
    )


def test_gold_equals_the_steps_one_by_one(spark):
    df = gold_input(spark)
    flagged = flag_zscore(with_expected_power(df, PARAMS), PARAMS)
    stepwise = combine_flags(flag_outliers(flagged, PARAMS).frame)
    ratings = rate_turbines(stepwise, PARAMS)
    analysis = drop_faulty(stepwise, ratings)
    gold = build_gold(df, PARAMS)
    assert rows(gold.ratings) == rows(ratings)
    assert rows(gold.analysis) == rows(analysis)
    assert rows(gold.summary) == rows(summarize_power(analysis, PARAMS))
    statuses = {status for (status,) in rows(ratings, "turbine_status")}
    assert "FAULTY_SENSOR" in statuses and len(statuses) > 1
    assert rows(ratings.where("turbine_id IS NULL"), "total_records") == [(250,)]
    assert analysis.where(F.col("turbine_id").isNull()).count() == 0
    gold.release()
    assert not any(os.path.exists(step.path) for step in gold.staged)


def test_gold_layout_of_work(spark):
    gold = build_gold(gold_input(spark), PARAMS)
    analysis, summary = plan(gold.analysis), plan(gold.summary)
    # Rows reach the analysis without a shuffle, and without running Python again: only
    # the few turbines that are not normal are joined.
    assert "hashpartitioning" not in analysis and "BroadcastHashJoin" in analysis
    assert "Python" not in analysis + summary
    # The summary reads three columns, shuffles aggregates once, then joins.
    assert "ReadSchema: struct<turbine_id:int,timestamp:timestamp,power_output:double>" in summary
    assert summary.count("hashpartitioning(turbine_id") == 1
    gold.release()


def test_staged_files_go_even_when_saving_fails(spark, layers, monkeypatch, tmp_path):
    run_all(spark, raw_folder(tmp_path), PARAMS, layers)
    before = spark.conf.get("spark.checkpoint.dir") + "/fleetpulse"
    kept = set(os.listdir(before))

    def refuse(self, df, table, *_, **__):
        raise OSError("no space")

    monkeypatch.setattr(Layers, "save", refuse)
    with pytest.raises(OSError, match="no space"):
        run_gold(spark, PARAMS, layers)
    assert set(os.listdir(before)) == kept


@pytest.mark.parametrize("step", ["flag_above_quantile", "rate_turbines"])
def test_a_failing_step_leaves_nothing(spark, monkeypatch, step):
    before = shared_files(spark)

    def refuse(*_, **__):
        raise OSError("no more")

    monkeypatch.setattr(f"fleetpulse.plans.pipeline.{step}", refuse)
    with pytest.raises(OSError, match="no more"):
        build_gold(gold_input(spark), PARAMS)
    assert shared_files(spark) == before


def test_hot_turbine_without_broadcast(spark):
    """A third of the rows are one turbine's; the join sorts and still keeps them all."""
    df = gold_input(spark).withColumn(
        "turbine_id", F.expr("IF(second(timestamp) % 3 = 0, 100, turbine_id)")
    )
    gold = build_gold(df, PARAMS)
    expected = rows(drop_faulty(gold.analysis.drop("turbine_status"), gold.ratings))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "Broadcast" not in plan(gold.analysis)
        assert rows(gold.analysis) == expected
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    gold.release()


def test_table_names():
    layers = Layers()
    assert layers.fleet_feed == "bronze_data.original_turbine_bronze"
    assert layers.site_feed == "bronze_data.new_turbine_bronze"
    assert layers.readings == "silver_data.wind_turbine_silver"
    assert layers.ratings == "gold_data.gold_turbine_stats"
    assert layers.analysis == "gold_data.gold_turbine_analysis"
    assert layers.summary == "gold_data.gold_turbine_summary"


@pytest.mark.parametrize("external", [False, True])
def test_a_run_saved_again_replaces_itself(spark, tmp_path, layers, external, monkeypatch):
    if external:
        layers = Layers(layers.bronze, layers.silver, layers.gold, root=str(tmp_path / "lake"))
    run_bronze(spark, raw_folder(tmp_path), layers)
    run_silver(spark, PARAMS, layers)
    run_gold(spark, PARAMS, layers, run_id="a")
    once = {t: rows(spark.table(t).drop("run_id")) for t in (layers.ratings, layers.analysis, layers.summary)}
    real = Layers.save

    def fail_second(self, df, table, *arguments, **options):
        if table == layers.analysis:
            raise OSError("no space")
        return real(self, df, table, *arguments, **options)

    for run_id in ("a", "b"):  # a run that was finished before, and a new one
        monkeypatch.setattr(Layers, "save", fail_second)
        with pytest.raises(OSError, match="no space"):
            run_gold(spark, PARAMS, layers, run_id=run_id)
        monkeypatch.setattr(Layers, "save", real)
        done = 0 if run_id == "a" else 1
        for table, expected in once.items():
            assert rows(layers.finished(spark, table).drop("run_id")) == sorted(expected * done, key=repr)
        run_gold(spark, PARAMS, layers, run_id=run_id)
        for table, expected in once.items():
            assert rows(layers.finished(spark, table).drop("run_id")) == sorted(expected * (done + 1), key=repr)
            assert spark.table(table).count() == len(expected) * (done + 1)


def test_a_run_without_rows_replaces_one_with_rows(spark, layers):
    frame = spark.createDataFrame([(1, "x"), (2, "y")], "k int, v string")
    layers.save(frame, layers.ratings, run_id="o'clock")
    layers.save(frame.limit(0), layers.ratings, run_id="o'clock")
    assert spark.table(layers.ratings).count() == 0
    layers.save(frame, layers.ratings, run_id="next")
    with pytest.raises(ValueError, match="not a table of such runs"):
        layers.save(frame.drop("v"), layers.ratings, run_id="next")
