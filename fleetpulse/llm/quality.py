"""Compression classifier for text quality.

Two zstandard dictionaries are built from labelled text, one from good and one from bad
documents. A text is cut into chunks, each compressed with either dictionary alone; the
difference of the two sums over the text's bytes tells which of the two it is like. A
logistic fit on other labelled rows turns the difference into a probability.

The fit uses at most ``PER_CLASS`` labelled ids of each class, the lowest by a hash of
the id, as far as their texts have at most ``FIT_BYTES`` bytes, half for the
dictionaries and half for the calibration, in which each class weighs as much as its
labels outside the held-out fold do. Scoring covers every whole text.

Defined cases: a NULL text is the empty text, whose difference is 0; a NULL id is not
held out and never trains; labels that are NULL or no 0 or 1 are passed over; without
rows of both classes every score is the share of good labels (0.5 without any); rows
that repeat are scored each.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetpulse.llm.shared import by_value, keep, table, whole_text

by_value(__name__)

PER_CLASS = 800
FIT_BYTES = 32_768
CHUNK = 512
DICTIONARY_BYTES = 32_768
LEVEL = 3
FOLDS, HELD_OUT = 3, 1


@dataclass(frozen=True)
class QualityModel:
    good: bytes
    bad: bytes
    slope: float
    offset: float


def held_out(id_column: str = "doc_id") -> Column:
    code = F.crc32(F.col(id_column).cast("string").cast("binary"))
    return F.coalesce(code % FOLDS == HELD_OUT, F.lit(False))


def chunks(text: str) -> Iterator[bytes]:
    data = text.encode()
    return (data[i : i + CHUNK] for i in range(0, len(data), CHUNK))


def dictionary(texts: list[str]) -> bytes:
    """A trained dictionary, or the samples themselves where they are too few for one."""
    import zstandard

    samples = [chunk for text in texts for chunk in chunks(text)]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-DICTIONARY_BYTES:]


class Sizer:
    """Compresses with both dictionaries."""

    def __init__(self, good: bytes, bad: bytes):
        import zstandard

        def compressor(data: bytes):
            own = zstandard.ZstdCompressionDict(data)
            own.precompute_compress(level=LEVEL)
            return zstandard.ZstdCompressor(level=LEVEL, dict_data=own)

        self.good, self.bad = compressor(good), compressor(bad)

    def difference(self, text: str) -> float:
        total = size = 0
        for chunk in chunks(text):
            total += len(self.bad.compress(chunk)) - len(self.good.compress(chunk))
            size += len(chunk)
        return total / size if size else 0.0


def logistic(
    x: np.ndarray, y: np.ndarray, amount: np.ndarray | float = 1.0
) -> tuple[float, float]:
    """Slope and offset of the fit of ``y`` on ``x`` with a faint pull towards zero.

    Each row counts by its ``amount``.
    """
    scale = float(np.abs(x).max()) or 1.0
    design = np.stack([x / scale, np.ones_like(x)], axis=1)
    weights = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip((design * weights).sum(axis=1), -30, 30)))
        gradient = (design * (amount * (y - p))[:, None]).sum(axis=0) - 1e-3 * weights
        curve = amount * np.maximum(p * (1 - p), 1e-9)
        a, b, d = ((design[:, i] * design[:, j] * curve).sum() for i, j in ((0, 0), (0, 1), (1, 1)))
        a, d = a + 1e-3, d + 1e-3
        step = np.array([d * gradient[0] - b * gradient[1], a * gradient[1] - b * gradient[0]])
        weights = weights + step / (a * d - b * b)
    return float(weights[0] / scale), float(weights[1])


def known_labels(labels: DataFrame) -> DataFrame:
    """``id`` and ``quality`` of the labels that may be learned from."""
    known = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
    return known.where(~held_out()).select(F.col("doc_id").alias("id"), "quality").distinct()


def training_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The bounded sample to fit on: ``text`` and ``quality``, one row per chosen id.

    Ids are chosen from the labels alone; only then are their texts fetched, by a join
    with a kept table of a fixed size, so no other text moves.
    """
    known = known_labels(labels)
    good, bad = (
        known.where(F.col("quality") == q).orderBy(F.xxhash64("id"), "id").limit(PER_CLASS)
        for q in (1, 0)
    )
    chosen = keep(good.unionByName(bad), "chosen-labels")
    texts = docs.select(F.col("doc_id").alias("id"), whole_text().alias("text"))
    rows = texts.where(F.octet_length("text") <= FIT_BYTES).join(chosen, "id")
    one_each = rows.groupBy("id", "quality").agg(F.min("text").alias("text"))
    return one_each.orderBy(F.xxhash64("id"), "id").select("text", "quality")


def fit(docs: DataFrame, labels: DataFrame) -> QualityModel:
    rows = training_rows(docs, labels).toPandas()
    groups = [rows.text[rows.quality == q].tolist() for q in (1, 0)]
    totals = dict(known_labels(labels).groupBy("quality").count().collect())
    counts = [totals.get(q, 0) for q in (1, 0)]
    if min(map(len, groups)) < 2:
        share = (counts[0] + 1) / (sum(counts) + 2)
        if not sum(counts):
            share = 0.5
        return QualityModel(b"", b"", 0.0, float(np.log(share / (1 - share))))
    good, bad = (dictionary(g[::2]) for g in groups)
    sizer = Sizer(good, bad)
    rest = [(sizer.difference(t), q) for g, q in zip(groups, (1, 0), strict=True) for t in g[1::2]]
    x, y = (np.array(v, float) for v in zip(*rest, strict=True))
    # The sample is bounded per class; classes count by their share of all labels.
    kept = np.where(y == 1, y.sum(), (1 - y).sum())
    amount = np.where(y == 1, *counts) / kept
    return QualityModel(good, bad, *logistic(x, y, amount * len(x) / amount.sum()))


def score(model: QualityModel, text: Column) -> Column:
    """The probability that a text is good, 0 to 1."""

    @F.pandas_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        sizer = Sizer(model.good, model.bad) if model.slope else None
        for texts in batches:
            x = np.array([sizer.difference(t) if sizer else 0.0 for t in texts], float)
            raw = np.clip(model.slope * x + model.offset, -30, 30)
            yield pd.Series(1 / (1 + np.exp(-raw)))

    return run(text)


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the classifier does not reject."""
    model = fit(docs, labels)
    return docs.where(score(model, whole_text()) >= 0.5)


def op3_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = fit(docs, table(spark, folder, "labels"))
    scored = docs.select(
        "doc_id", held_out().alias("held_out"), score(model, whole_text()).alias("score")
    )
    return scored.withColumn("predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0))
