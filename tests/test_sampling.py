from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from fleetpulse.functions.sketch import WeightSketch, pack, unpack
from fleetpulse.functions.trees import _tail_quantile, draw_slots
from fleetpulse.operators.forest import fit_forest, flag_outliers
from fleetpulse.operators.sampling import drawable, sampled, sketch_capacity
from fleetpulse.params import Params
from tests.helpers import plan, rows, shared_files

FEW = Params(trees=4, max_samples=16)
NAMES = ("wind_speed", "expected_power", "power_output")


def copies(spark, n):
    """A third of the rows are copies of one reading."""
    id = F.expr("IF(id % 3 = 0, -1, id)").alias("id")
    x = F.col("id").cast("double")
    return spark.range(n).select(id).select(
        "id", (x % 25).alias("wind_speed"), (x % 7).alias("expected_power"), (x / 1000).alias("power_output")
    )


@pytest.mark.parametrize("seed", range(5))
def test_items_of_weight_one_are_found_in_any_order(seed):
    rng = np.random.default_rng(seed)
    codes = np.concatenate([np.arange(30_000), np.repeat(np.arange(30_000, 30_200), 50), np.full(40_000, 99_999)])
    weights = np.concatenate([rng.uniform(0, 0.02, 30_000), np.full(10_000, 0.0201), np.full(40_000, 0.5)])
    order = rng.permutation(len(codes)) if seed else np.arange(len(codes))
    codes, weights = codes[order].astype(np.uint64), weights[order]
    whole = WeightSketch(1000)
    for part in np.array_split(np.arange(len(codes)), 1 + 3 * seed):
        own = WeightSketch(1000)
        for batch in np.array_split(part, 7):
            own.add(codes[batch], weights[batch])
        own.settle()
        assert np.isfinite(own.weights).sum() <= 1000
        whole.add(*unpack(pack(own.codes, own.weights)), own.lost)
    found = set(whole.reaching().tolist())
    assert whole.lost < 1.0
    assert {*range(30_000, 30_200), 99_999} <= found


def test_an_empty_sketch():
    assert len(WeightSketch(5).reaching()) == 0
    assert [len(x) for x in unpack(pack(np.zeros(0, np.uint64), np.zeros(0)))] == [0, 0]


@pytest.mark.parametrize("capacity", [None, 40])
def test_candidates_do_not_change_the_sample(spark, capacity):
    df, n = copies(spark, 60_000), 60_000
    whole = rows(sampled(df, NAMES, ("id",), FEW, n))
    for parts in (3, 7):
        found = drawable(df.repartition(parts), NAMES, ("id",), FEW, n, capacity)
        assert found.frame.count() < 12_000
        assert rows(sampled(df, NAMES, ("id",), FEW, n, found.frame)) == whole
        found.discard()


def test_only_candidates_are_counted(spark):
    df = copies(spark, 1000)
    candidates = spark.createDataFrame([(1,)], "code long")
    text = plan(sampled(df, NAMES, ("id",), FEW, 10**6, candidates))
    tree = text[: text.index("\n\n")]
    assert "BroadcastHashJoin LeftSemi" in tree
    # The readings meet the candidates in the scan's stage, before anything is exchanged.
    assert tree.index("Exchange (") < tree.index("BroadcastHashJoin LeftSemi")
    assert tree[tree.index("BroadcastHashJoin LeftSemi") :].count(" Exchange (") == 0


def test_flags_with_the_sketch_do_not_depend_on_partitions(spark):
    n = 60_000
    assert n > sketch_capacity(FEW, n)  # the sketch is used
    before = shared_files(spark)
    counts = []
    for parts in (3, 7):
        staged = flag_outliers(copies(spark, n).repartition(parts), FEW, key=("id",))
        counts.append(rows(staged.frame.groupBy("id", "if_anomaly").count()))
        staged.discard()
    assert counts[0] == counts[1]
    assert shared_files(spark) == before


def test_a_sample_size_beyond_what_is_sent_joins_otherwise(spark, monkeypatch):
    df, n = copies(spark, 20_000), 20_000
    whole = rows(sampled(df, NAMES, ("id",), FEW, n))
    found = drawable(df, NAMES, ("id",), FEW, n)
    monkeypatch.setattr("fleetpulse.operators.sampling.SENT", 0)
    assert rows(sampled(df, NAMES, ("id",), FEW, n, found.frame)) == whole
    found.discard()


def test_trees_of_one_task_are_those_of_many(spark):
    df = copies(spark, 3_000)
    model = fit_forest(df, FEW, key=("id",))
    assert len(model.trees) == FEW.trees
    again = fit_forest(df.coalesce(1), FEW, key=("id",))
    assert all((a.threshold == b.threshold).all() for a, b in zip(model.trees, again.trees))


@pytest.mark.parametrize("slots, share", [(2_000, 0.4), (10**6, 0.001), (10**12, 1e-8), (10**14, 3e-10)])
def test_quantiles_of_large_counts_are_those_of_the_binomial(slots, share):
    mean = slots * share
    low = max(int(mean - 12 * math.sqrt(mean)), 0)

    def log_chance(k):
        if slots <= 10**6:
            choose = math.log(math.comb(slots, k)) if slots <= 2_000 else (
                math.lgamma(slots + 1) - math.lgamma(k + 1) - math.lgamma(slots - k + 1)
            )
            return choose + k * math.log(share) + (slots - k) * math.log1p(-share)
        return k * math.log(mean) - mean - math.lgamma(k + 1)  # all but Poisson

    for uniform in (0.999, 0.7, 0.5, 0.1, 1e-6):
        above, k = 0.0, min(int(mean + 12 * math.sqrt(mean)), slots)
        while k > low:
            above += math.exp(log_chance(k))
            if above > uniform:
                break
            k -= 1
        assert abs(_tail_quantile(uniform, slots, share) - k) <= 1


@pytest.mark.parametrize("share", [1.0, 0.7, 0.3, 0.01, 1e-4])
def test_draws_are_within_the_slots_and_repeat(share):
    codes = np.random.default_rng(1).integers(-(2**63), 2**63, 3_000)
    slots = np.where(np.arange(3_000) % 50 == 0, 5_000, 20)
    row, slot = draw_slots(3, codes, slots, share)
    again = draw_slots(3, codes, slots, share)
    assert (row == again[0]).all() and (slot == again[1]).all()
    assert len(set(zip(row.tolist(), slot.tolist()))) == len(row)
    assert (slot < slots[row]).all() and (slot >= 0).all()
    mean = slots.sum() * share
    assert abs(len(row) - mean) <= 6 * math.sqrt(mean * (1 - share)) + 1e-9
    # Any part of the rows gets what it gets in all.
    half = draw_slots(3, codes[:1500], slots[:1500], share)
    assert (half[0] == row[row < 1500]).all() and (half[1] == slot[row < 1500]).all()
