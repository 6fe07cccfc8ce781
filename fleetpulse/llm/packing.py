"""Packing into token sequences by cutting-stock column generation.

Every text is encoded once and cut into full sequences and a remainder. The remainders
are counted by length class, the only thing the plan needs: a linear program chooses
how often to use each pattern of classes that fits one sequence, and new patterns are
priced by a knapsack dynamic program over its duals. Pattern uses are rounded down;
what is left over, less than one use per pattern, is filled in first-fit order. Each
piece then finds its sequence from its class and its rank in it.

A class holds ``GRAIN`` lengths and counts as the longest, so a plan always fits; it
wastes under half a grain per piece. The histogram has ``SEQUENCE / GRAIN`` counters
and the plan a bounded number of patterns, whatever the input.

Defined cases: a NULL text is the empty text and gives the end id alone; rows that
repeat are packed each; a NULL id stays NULL; an empty table gives no pieces.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fleetpulse.llm.shared import by_value, keep, table, whole_text
from fleetpulse.llm.tokens import encoder

by_value(__name__)

SEQUENCE = 2048
GRAIN = 16
END_ID = 1
# The program stops when better patterns could save this share or half a sequence.
GAP = 5e-4
# Pivots at most: stopping early leaves a valid plan with a little more padding.
MOST_TURNS = 3000

PIECE = (
    "doc_id BIGINT, start BIGINT, length BIGINT, ids_crc32 BIGINT, doc_tokens BIGINT, "
    "size_class INT, part INT, place BIGINT"
)


def cut_pieces(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    path: str | None = None,
) -> DataFrame:
    """Each document's pieces, numbered by class within the task (``part``, ``place``)."""

    def cut(batches: Iterator) -> Iterator:
        import zlib

        import pyarrow as pa
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        seen = np.zeros(SEQUENCE // GRAIN + 1, np.int64)
        own = encoder(path)
        end = END_ID.to_bytes(4, "little")
        for batch in batches:
            rows: list[tuple] = []
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for doc_id, text in zip(ids, texts, strict=True):
                coded = own.encode(text) + end
                total = len(coded) // 4
                for start in range(0, total, SEQUENCE):
                    piece = coded[4 * start : 4 * (start + SEQUENCE)]
                    size = -(-len(piece) // (4 * GRAIN))
                    rows.append(
                        (
                            doc_id,
                            start,
                            len(piece) // 4,
                            zlib.crc32(piece),
                            total,
                            size,
                            part,
                            int(seen[size]),
                        )
                    )
                    seen[size] += 1
            kinds = [pa.int64()] * 5 + [pa.int32()] * 2 + [pa.int64()]
            columns = list(zip(*rows, strict=True)) or [[]] * len(kinds)
            names = [field.split()[0] for field in PIECE.split(", ")]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names
            )

    chosen = docs.select(
        F.col(id_column).cast("long").alias("doc_id"), whole_text(text_column).alias("text")
    )
    return chosen.mapInArrow(cut, PIECE)


@dataclass(frozen=True)
class Plan:
    """Patterns and how often each is used; row p of ``patterns`` counts by class."""

    patterns: np.ndarray
    uses: np.ndarray


def best_pattern(worth: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """Unbounded knapsack: the most worth that fits, class ``c`` taking ``c`` units."""
    classes = np.arange(1, len(worth))
    best, chosen = np.zeros(capacity + 1), np.zeros(capacity + 1, np.int64)
    for room in range(1, capacity + 1):
        usable = classes[: min(room, len(classes))]
        values = best[room - usable] + worth[usable]
        top = int(values.argmax()) if len(values) else 0
        if len(values) and values[top] > best[room - 1] + 1e-12:
            best[room], chosen[room] = values[top], usable[top]
        else:
            best[room] = best[room - 1]
    pattern, room = np.zeros(len(worth), np.int64), capacity
    while room:
        size = int(chosen[room])
        pattern[size] += size > 0
        room -= size or 1
    return float(best[capacity]), pattern


def inverted(matrix: np.ndarray) -> np.ndarray:
    """Gauss-Jordan elimination, on the calling thread alone."""
    size = len(matrix)
    work = np.concatenate([matrix, np.eye(size)], axis=1)
    for column in range(size):
        pivot = column + int(np.abs(work[column:, column]).argmax())
        work[[column, pivot]] = work[[pivot, column]]
        work[column] /= work[column, column]
        others = work[:, column].copy()
        others[column] = 0.0
        work -= np.outer(others, work[column])
    return work[:, size:]


def plan_patterns(demand: np.ndarray, gap: float = GAP) -> Plan:
    """Cover ``demand[c]`` pieces of each class ``c`` (units) with few sequences."""
    capacity = len(demand) - 1
    wanted = np.flatnonzero(demand)
    if not len(wanted):
        return Plan(np.zeros((0, capacity + 1), np.int64), np.zeros(0, np.int64))
    # Unequal small shifts keep pivots from going round in circles between ties.
    need = demand[wanted] + 1e-3 * (1 + np.arange(len(wanted)) / len(wanted))
    basis = np.diag(capacity // wanted).astype(float)
    inverse, uses = np.diag(1 / np.diag(basis)), need / np.diag(basis)
    for turn in range(MOST_TURNS):
        worth = np.zeros(capacity + 1)
        worth[wanted] = np.maximum(inverse.sum(axis=0), 0.0)
        value, pattern = best_pattern(worth, capacity)
        # What is used now is at most ``value`` times the optimum.
        if value <= 1 + gap or uses.sum() * (1 - 1 / value) < 0.5:
            break
        column = pattern[wanted].astype(float)
        step = (inverse * column).sum(axis=1)
        limits = np.where(step > 1e-9, uses / np.where(step > 1e-9, step, 1.0), np.inf)
        out = int(limits.argmin())
        uses = np.maximum(uses - limits[out] * step, 0.0)
        uses[out] = limits[out]
        basis[:, out] = column
        if turn % 64 == 63:
            inverse = inverted(basis)
            uses = np.maximum((inverse * need).sum(axis=1), 0.0)
        else:
            row = inverse[out] / step[out]
            inverse = inverse - np.outer(step, row)
            inverse[out] = row
    patterns = np.zeros((len(wanted), capacity + 1), np.int64)
    patterns[:, wanted] = np.rint(basis.T).astype(np.int64)
    whole = np.floor(uses + 1e-9).astype(np.int64)
    # Rounding errors aside, rounded uses cover no class more often than it occurs.
    while (over := whole @ patterns - demand).max() > 0:
        worst = int(over.argmax())
        users = np.flatnonzero((patterns[:, worst] > 0) & (whole > 0))
        each = patterns[users[0], worst]
        whole[users[0]] -= min(whole[users[0]], -(-over[worst] // each))
    rest = first_fit(demand - whole @ patterns)
    every = np.concatenate([patterns, rest])
    times = np.concatenate([whole, np.ones(len(rest), np.int64)])
    return Plan(every[times > 0], times[times > 0])


def first_fit(left: np.ndarray) -> np.ndarray:
    """The remaining pieces, largest first, each sequence filled as far as it goes."""
    capacity, left, filled = len(left) - 1, left.copy(), []
    while left.any():
        pattern, room = np.zeros_like(left), capacity
        for size in np.flatnonzero(left)[::-1]:
            take = min(int(left[size]), room // int(size))
            pattern[size] += take
            room -= take * int(size)
        left -= pattern
        filled.append(pattern)
    return np.array(filled, np.int64).reshape(-1, capacity + 1)


def places(plan: Plan) -> dict[int, tuple[np.ndarray, ...]]:
    """For each class, the runs of ranks that lie in one pattern: first rank, first
    sequence, pieces per sequence, and the slot of the first of them."""
    first_sequence = np.concatenate([[0], np.cumsum(plan.uses)[:-1]]).astype(np.int64)
    before = np.cumsum(plan.patterns[:, ::-1], axis=1)[:, ::-1] - plan.patterns
    runs = {}
    for size in np.flatnonzero(plan.patterns.any(axis=0)):
        rows = np.flatnonzero(plan.patterns[:, size])
        each = plan.patterns[rows, size]
        amounts = each * plan.uses[rows]
        starts = np.concatenate([[0], np.cumsum(amounts)[:-1]]).astype(np.int64)
        runs[int(size)] = (starts, first_sequence[rows], each, before[rows, size])
    return runs


def pack(docs: DataFrame, **columns: str) -> DataFrame:
    """All documents' pieces with their sequence and their offset in it."""
    pieces = keep(cut_pieces(docs, **columns), "pieces")
    counts = keep(pieces.groupBy("size_class", "part").agg(F.count("*").alias("n")), "sizes")
    demand = np.zeros(SEQUENCE // GRAIN + 1, np.int64)
    for row in counts.groupBy("size_class").agg(F.sum("n").alias("n")).collect():
        demand[row.size_class] = row.n
    runs = places(plan_patterns(demand))

    @F.pandas_udf("sequence_id BIGINT, slot BIGINT")
    def place_of(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for sizes, ranks in batches:
            size, rank = sizes.to_numpy(), ranks.to_numpy()
            sequence, slot = np.zeros(len(size), np.int64), np.zeros(len(size), np.int64)
            for kind in np.unique(size):
                rows = np.flatnonzero(size == kind)
                starts, firsts, each, slots = runs[int(kind)]
                run = np.searchsorted(starts, rank[rows], "right") - 1
                inside = rank[rows] - starts[run]
                sequence[rows] = firsts[run] + inside // each[run]
                slot[rows] = slots[run] + inside % each[run]
            yield pd.DataFrame({"sequence_id": sequence, "slot": slot})

    earlier = Window.partitionBy("size_class").orderBy("part")
    offsets = counts.withColumn("offset", F.sum("n").over(earlier) - F.col("n")).drop("n")
    ranked = pieces.join(offsets, ["size_class", "part"]).withColumn(
        "at", place_of("size_class", F.col("place") + F.col("offset"))
    )
    inside = Window.partitionBy("sequence_id").orderBy("slot")
    return ranked.select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "at.sequence_id", "at.slot"
    ).select(
        "doc_id",
        "start",
        "length",
        "ids_crc32",
        "doc_tokens",
        "sequence_id",
        (F.sum("length").over(inside) - F.col("length")).alias("offset"),
    )


def op4_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack(table(spark, folder, "documents"))
