"""What the two operators on repeated passages share: distinct texts and live anchors.

Texts are reduced to distinct ones, each in the *part* (the task) that wrote it. Tasks
exchange packed numbers instead of rows: a part sends each hash once to the bucket of
that hash, with all copies inside the part already combined, and each bucket answers
every part with those of its hashes that occur elsewhere too. A passage that a third of
all documents hold is thus one number per part, wherever it goes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetpulse.llm.shared import by_value, keep, partitions, whole_text

by_value(__name__)

U64 = np.uint64
PACKET = "bucket INT, part INT, data BINARY"
ANSWER = "part INT, data BINARY"
# An anchor that more parts hold than this is told apart as crowded.
CROWD = 64


def distinct_texts(
    docs: DataFrame, *counts: Column, id_column: str = "doc_id", text_column: str = "text"
) -> tuple[DataFrame, DataFrame]:
    """Every row's ``doc_id`` and ``digest``; and each text once, as bytes, with its
    least ``doc_id``, its number of ``copies``, its ``part`` and any further ``counts``
    over its rows' ``doc_id``."""
    doc_id = F.col(id_column).cast("long").alias("doc_id")
    text = whole_text(text_column)
    code = F.unhex(F.sha2(text, 256)).alias("digest")
    rows = keep(docs.select(doc_id, code), "rows")
    texts = (
        docs.select(doc_id, code, text.cast("binary").alias("text"))
        .groupBy("digest")
        .agg(
            F.min("doc_id").alias("doc_id"),
            F.count("*").alias("copies"),
            *counts,
            F.first("text").alias("text"),
        )
        .withColumn("part", F.spark_partition_id())
    )
    return rows, keep(texts, "texts")


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijection that spreads 64-bit numbers."""
    values = values ^ (values >> U64(30))
    values = values * U64(0xBF58476D1CE4E5B9)
    values = values ^ (values >> U64(27))
    values = values * U64(0x94D049BB133111EB)
    return values ^ (values >> U64(31))


def window_hashes(values: np.ndarray, length: int, base: int) -> np.ndarray:
    """A hash of each run of ``length`` values: their polynomial in ``base``."""
    if len(values) < length:
        return np.zeros(0, U64)
    total, done, block, size, power = None, 0, values, 1, base
    while True:
        if length & size:
            piece = block[done:]
            if total is None:
                total = piece
            else:
                count = min(len(total), len(piece))
                total = total[:count] * U64(power) + piece[:count]
            done += size
        if 2 * size > length:
            break
        block = block[:-size] * U64(power) + block[size:]
        power = power * power % 2**64
        size *= 2
    return mixed(total[: len(values) - length + 1])


def packets(part: int, keys: np.ndarray, buckets: int, *values: np.ndarray) -> list[tuple]:
    """Sorted ``keys`` and their values as one packet per bucket."""
    edges = np.array([(i << 64) // buckets for i in range(1, buckets)], U64)
    cuts = [0, *np.searchsorted(keys, edges).tolist(), len(keys)]
    return [
        (bucket, part, b"".join(x[low:high].tobytes() for x in (keys, *values)))
        for bucket, (low, high) in enumerate(zip(cuts, cuts[1:], strict=False))
        if high > low
    ]


def as_batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {
        "INT": pa.int32(),
        "BIGINT": pa.int64(),
        "DOUBLE": pa.float64(),
        "BINARY": pa.binary(),
        "STRING": pa.string(),
    }
    fields = [field.split() for field in schema.split(", ")]
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(fields)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, kinds[kind]) for c, (_, kind) in zip(columns, fields, strict=True)],
        [name for name, _ in fields],
    )


def by_part(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray]]:
    """The parts in a batch and their rows."""
    parts = batch.column("part").to_numpy()
    for part in np.unique(parts):
        yield int(part), np.flatnonzero(parts == part)


def live_anchors(
    texts: DataFrame, anchors: Callable[[bytes, int], np.ndarray], crowd: int = CROWD
) -> DataFrame:
    """For each part (``part``, ``data``) its anchor hashes that occur more than once.

    ``anchors`` gives the hashes of a text, which is there in so many copies. The last
    bit is spent: on the way out it tells whether a hash occurs more than once in its
    part already, on the way back whether it is crowded (0) or not (1).
    """
    buckets = partitions(texts.sparkSession)

    def send(batches: Iterator) -> Iterator:
        for batch in batches:
            column, copies = batch.column("text"), batch.column("copies").to_numpy()
            for part, rows in by_part(batch):
                found = [anchors(column[int(i)].as_py(), copies[i]) for i in rows]
                keys, counts = np.unique(np.concatenate(found) | U64(1), return_counts=True)
                keys = np.where(counts > 1, keys, keys ^ U64(1))
                yield as_batch(packets(part, keys, buckets), PACKET)

    def answer(group: pa.Table) -> pa.Table:
        parts = group.column("part").to_numpy()
        each = [np.frombuffer(x.as_py(), U64) for x in group.column("data")]
        keys = np.concatenate(each)
        owner = np.repeat(np.arange(len(each)), [len(x) for x in each])
        order = np.argsort(keys, kind="stable")
        keys, owner = keys[order], owner[order]
        bare = keys | U64(1)
        again = np.zeros(len(keys), bool)
        again[1:] = bare[1:] == bare[:-1]
        live = again | (keys & U64(1)).astype(bool)
        live[:-1] |= again[1:]
        first = np.flatnonzero(~again)
        size = np.diff(np.append(first, len(keys)))
        holders = np.repeat(size, size)
        told = np.where(holders > crowd, bare ^ U64(1), bare)
        back = np.argsort(owner[live], kind="stable")
        keys, owner = told[live][back], owner[live][back]
        cuts = np.searchsorted(owner, np.arange(len(each) + 1))
        rows = [
            (int(parts[i]), keys[cuts[i] : cuts[i + 1]].tobytes())
            for i in range(len(each))
            if cuts[i + 1] > cuts[i]
        ]
        return pa.Table.from_batches([as_batch(rows, ANSWER)])

    sent = texts.select("part", "copies", "text").mapInArrow(send, PACKET)
    return sent.groupBy("bucket").applyInArrow(answer, ANSWER)


def joined_answers(answers: pa.Table) -> np.ndarray:
    """A part's live anchor hashes, sorted, last bit set."""
    each = [np.frombuffer(x.as_py(), U64) for x in answers.column("data")]
    return np.sort(np.concatenate([np.zeros(0, U64), *each]) | U64(1))


def crowded_answers(answers: pa.Table) -> np.ndarray:
    """Those among a part's live anchor hashes that are crowded, in the same form."""
    each = [np.frombuffer(x.as_py(), U64) for x in answers.column("data")]
    keys = np.concatenate([np.zeros(0, U64), *each])
    return np.sort(keys[keys & U64(1) == 0] | U64(1))


def among(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which values are in the sorted array ``known``."""
    if not len(known):
        return np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(known, values), len(known) - 1)
    return known[at] == values


def covered(starts: np.ndarray, length: int | np.ndarray, size: int) -> np.ndarray:
    """Which of ``size`` places lie in a run of ``length`` places from some start."""
    change = np.zeros(size + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + length, -1)
    return np.cumsum(change[:-1]) > 0
