"""The forest's sample: drawn by hash, without shuffling the readings.

A reading with hash ``u`` in [0, 1) that occurs ``c`` times is drawn for some tree just
if ``u < 1 - (1 - share) ** (c * trees)``, that is if ``c`` reaches a number that ``u``
sets. So each row weighs one over that number, and the drawn readings are those whose
rows weigh 1 together: heavy items, found by a mergeable sketch. Rows hashed high weigh
next to nothing and drop out of it; the weight of all rows, and with it the sketch, grows
with the logarithm of their number only. Just the readings that the sketch reports are
then counted exactly, so what is drawn does not depend on what the sketch dropped.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetpulse.functions.sketch import WeightSketch, pack, unpack
from fleetpulse.functions.trees import draw_slots, mixed
from fleetpulse.params import Params
from fleetpulse.sources.staging import Staged, stage

# Reported readings that are sent to every task at most, eight bytes each. A forest with
# more (trees x samples in the hundreds of millions) joins them as Spark sees fit.
SENT = 1 << 22


def draw_share(params: Params, rows: int) -> float:
    """The probability of a slot: about twice ``max_samples`` rows meet at each tree."""
    return min(1.0, 2.0 * params.max_samples / max(rows, 1))


def sketch_capacity(params: Params, rows: int) -> int:
    """Twice the weight that ``rows`` rows have in expectation, whatever their copies."""
    drawn = 2.0 * params.max_samples * params.trees
    return 2 * math.ceil(drawn * (1.0 + math.log(max(rows / drawn, 1.0))))


def reading_code(
    df: DataFrame, features: Sequence[str], key: Sequence[str], params: Params
) -> Column:
    """A reading's hash over the features and those columns of ``key`` that ``df`` has."""
    identity = [F.col(name) for name in key if name in df.columns and name not in features]
    return F.xxhash64(F.lit(params.seed), *identity, *features).alias("code")


def drawable(
    df: DataFrame,
    features: Sequence[str],
    key: Sequence[str],
    params: Params,
    rows: int,
    capacity: int | None = None,
) -> Staged:
    """The hashes (``code``) of all readings that can be drawn, and a few others.

    Every task sketches its rows and sends one packet per hash partition, where the
    sketches merge. Should they have lost too much, they are made anew, twice as large.
    """
    spark = df.sparkSession
    slots = params.trees * math.log1p(-draw_share(params, rows))
    size = capacity or sketch_capacity(params, rows)
    parts = spark.sparkContext.defaultParallelism

    def sketch(batches: Iterator) -> Iterator:
        import pyarrow as pa

        summary = WeightSketch(size)
        for batch in batches:
            codes = batch.column(0).to_numpy().view(np.uint64)
            uniform = (codes >> np.uint64(11)) * 2.0**-53
            with np.errstate(divide="ignore"):
                summary.add(codes, np.minimum(slots / np.log1p(-uniform), 1.0))
        summary.settle()
        owner = summary.codes % np.uint64(parts)
        data = [pack(summary.codes[own], summary.weights[own]) for own in (owner == p for p in range(parts))]
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(parts), pa.int32()), pa.array([summary.lost] * parts), pa.array(data, pa.binary())],
            ["part", "lost", "data"],
        )

    share = max(1, 2 * size // parts)

    def merge(batches: Iterator) -> Iterator:
        import pyarrow as pa

        summary = WeightSketch(share)
        for batch in batches:
            for lost, data in zip(batch.column(1).to_pylist(), batch.column(2), strict=True):
                summary.add(*unpack(data.as_py()), lost)
        found = summary.reaching().view(np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(found, 0)), pa.array(np.append(np.zeros(len(found)), summary.lost))],
            ["code", "lost"],
        )

    coded = df.select(reading_code(df, features, key, params))
    packets = coded.mapInArrow(sketch, "part int, lost double, data binary")
    merged = packets.repartitionById(parts, F.col("part")).mapInArrow(merge, "code long, lost double")
    found = stage(merged, "drawable")
    if (found.frame.agg(F.max("lost")).first()[0] or 0.0) >= 1.0:
        found.discard()
        return drawable(df, features, key, params, rows, 2 * size)
    return found


def sampled(
    df: DataFrame,
    features: Sequence[str],
    key: Sequence[str],
    params: Params,
    rows: int,
    candidates: DataFrame | None = None,
) -> DataFrame:
    """The rows each tree may grow from: ``tree``, the features and ``place``.

    Every row has a slot for each tree, and a slot is drawn with the same small
    probability, so that about twice ``max_samples`` rows meet at each tree (all rows,
    if there are no more). ``place`` puts a tree's rows in a random order.

    Equal rows are counted before anything is drawn, and the draw is a function of the
    row's hash and its count. The sample thus depends on which rows there are and how
    often, and on nothing else; copies of a reading enter it in proportion. Only
    readings among the ``candidates`` are counted, if these are given.
    """
    share = draw_share(params, rows)
    names, trees, seed = list(features), params.trees, params.seed
    columns = [F.col(name).cast("double").alias(name) for name in names]
    coded = df.select(reading_code(df, names, key, params), *columns)
    if candidates is not None:
        chosen = candidates.select("code")
        small = sketch_capacity(params, rows) <= SENT
        coded = coded.join(F.broadcast(chosen) if small else chosen, "code", "left_semi")
    counted = coded.groupBy("code", *names).agg(F.count(F.lit(1)).alias("copies"))
    uniform = F.shiftrightunsigned("code", 11) * 2.0**-53
    chance = -math.inf if share >= 1.0 else math.log1p(-share)
    drawn = counted.where(uniform < -F.expm1(F.col("copies") * trees * F.lit(chance)))

    def spread(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            codes, copies = batch["code"].to_numpy(), batch["copies"].to_numpy()
            row, slot = draw_slots(seed, codes, copies * trees, share)
            place = mixed(codes[row].view(np.uint64) ^ mixed(slot.astype(np.uint64)))
            drawn_rows = batch[names].iloc[row]
            yield drawn_rows.assign(tree=slot % trees, place=place.view(np.int64))

    types = ", ".join(f"{name} double" for name in names)
    return drawn.mapInPandas(spread, f"{types}, tree long, place long")
