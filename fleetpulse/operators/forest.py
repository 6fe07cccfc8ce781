"""Isolation forest: sampled, grown, scored and cut on the cluster."""

from __future__ import annotations

import math
import pickle
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from fleetpulse.functions.trees import Tree, grow_tree, mean_path, worker_tables
from fleetpulse.operators.power import round_power
from fleetpulse.operators.quantile import exact_quantile
from fleetpulse.operators.sampling import drawable, sampled, sketch_capacity
from fleetpulse.params import Params
from fleetpulse.sources.staging import Staged, stage

FEATURES = ("wind_speed", "expected_power", "power_output")
# Columns that tell readings apart; those a frame has are used to draw the sample.
KEY = ("turbine_id", "timestamp")


@dataclass(frozen=True)
class ForestModel:
    features: tuple[str, ...]
    sample_size: int
    trees: tuple[Tree, ...]


def fit_forest(
    df: DataFrame,
    params: Params = Params(),
    features: Sequence[str] = FEATURES,
    key: Sequence[str] = KEY,
    rows: int | None = None,
) -> ForestModel:
    """Grow ``params.trees`` trees, each from up to ``params.max_samples`` rows.

    A tree grows from the rows that drew its number, several trees to a task; only the
    grown trees reach the driver. ``rows`` saves counting them (see ``row_counts``).
    """
    if rows is None:
        rows = usable_rows(df.agg(*row_counts(features)).first(), features)
    sample_size = min(params.max_samples, rows)
    if sample_size == 0:
        return ForestModel(tuple(features), 0, ())

    # A small frame is counted whole; the sample is the same either way.
    found = None
    if rows > sketch_capacity(params, rows):
        found = drawable(df, features, key, params, rows)
    try:
        drawn = sampled(df, features, key, params, rows, found and found.frame)
        grown = _grown(drawn, list(features), params, sample_size).collect()
    finally:
        if found:
            found.discard()
    trees = tuple(Tree(*pickle.loads(tree)) for _, tree in sorted(grown))
    return ForestModel(tuple(features), sample_size, trees)


def _grown(drawn: DataFrame, names: list[str], params: Params, sample_size: int) -> DataFrame:
    """``number`` and ``tree``: the drawn rows of a few trees meet in each task."""
    seed = params.seed

    def grow(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = list(batches)
        if not rows:
            return
        for number, group in pd.concat(rows).groupby("tree"):
            chosen = group.sort_values(["place", *names]).head(sample_size)
            points = np.ascontiguousarray(chosen[names].to_numpy(float))
            tree = grow_tree(points, np.random.default_rng([seed, number]))
            yield pd.DataFrame({"number": [number], "tree": [pickle.dumps(tuple(tree))]})

    tasks = min(params.trees, drawn.sparkSession.sparkContext.defaultParallelism)
    dealt = drawn.repartitionById(tasks, (F.col("tree") % tasks).cast("int"))
    return dealt.mapInPandas(grow, "number long, tree binary")


def row_counts(features: Sequence[str] = FEATURES) -> tuple[Column, Column]:
    """The aggregates ``fit_forest`` needs first: all rows, and those it cannot use."""
    finite = F.lit(True)
    for name in features:
        value = F.abs(F.col(name).cast("double")) < F.lit(math.inf)
        finite = finite & F.coalesce(value, F.lit(False))
    return F.count(F.lit(1)).alias("rows"), F.count_if(~finite).alias("unusable")


def usable_rows(counts: Row, features: Sequence[str] = FEATURES) -> int:
    if counts["unusable"]:
        raise ValueError(
            f"{counts['unusable']} rows have a missing or infinite value in "
            f"{', '.join(features)}"
        )
    return counts["rows"]


def outlier_score(df: DataFrame, model: ForestModel, column: str = "score") -> DataFrame:
    """Add the anomaly score in (0, 1]: 2 ** -(mean path length / expected length).

    The trees are a broadcast, bounded by trees x samples; a Python worker makes their
    tables from it. Rows keep their place, so scoring neither joins nor shuffles.
    """
    scale = mean_path(model.sample_size)
    if scale == 0.0:  # at most one row was seen: every row is as odd as any other
        return df.withColumn(column, F.lit(0.5))
    width = len(model.features)
    name = uuid.uuid4().hex
    shared = df.sparkSession.sparkContext.broadcast([tuple(t) for t in model.trees])

    @F.pandas_udf("double")
    def path_length(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        measure = worker_tables(name, shared.value, width)
        for batch in batches:
            yield pd.Series(measure([series.to_numpy(float) for series in batch]))

    inputs = [F.col(name).cast("double") for name in model.features]
    return df.withColumn(
        column, F.pow(F.lit(2.0), -path_length(*inputs) / F.lit(scale))
    )


def flag_above_quantile(
    df: DataFrame, params: Params = Params(), column: str = "score"
) -> DataFrame:
    """Replace the score by a flag on its highest share of rows; ties stay unflagged.

    Reads the score column of ``df`` twice or so: hand in something materialized.
    """
    cut = exact_quantile(df, column, 1.0 - params.contamination_rate)
    flag = F.when(F.col(column) > F.lit(cut), 1).otherwise(0)
    return df.withColumn("if_anomaly", flag).drop(column)


def stage_scores(df: DataFrame, model: ForestModel, *unneeded: str) -> Staged:
    """Scores beside rounded powers, written once to the shared folder.

    The forest sees unrounded values. The cut needs all scores before the first flag
    is known, so they are kept rather than derived twice; ``unneeded`` columns are not.
    """
    return stage(round_power(outlier_score(df, model)).drop(*unneeded), "scores")


def flag_outliers(
    df: DataFrame,
    params: Params = Params(),
    key: Sequence[str] = KEY,
    model: ForestModel | None = None,
) -> Staged:
    """Isolation-forest flag per reading, then powers rounded to two digits.

    The caller discards the result when nothing reads its frame any more. A ``model``
    that is given is used instead of one grown from the rows.
    """
    scored = stage_scores(df, model or fit_forest(df, params, key=key))
    try:
        return replace(scored, frame=flag_above_quantile(scored.frame, params))
    except BaseException:
        scored.discard()
        raise
