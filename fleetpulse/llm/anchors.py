"""Substring dedup by difference-cover anchors.

Words are numbered within their document. Only runs of words that start at cover places
modulo ``PERIOD`` are hashed. Of any two places some shift below the period takes both
onto cover places, so two equal passages of ``WINDOW`` words share an anchor at the same
distance from their starts. Around anchors that occur in several texts the match is
extended to whole windows, compared by 128-bit hashes, and a word goes if a window over
it also starts in a document of smaller id.

Copies of a whole text are settled by the text's least id. Everything else is per part:
see ``matches``.

Defined cases: a NULL text has no words; a document repeated under one id is one
document; a NULL id counts as larger than every number and keeps nothing from others of
its kind; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetpulse.llm.matches import (
    ANSWER,
    PACKET,
    U64,
    among,
    as_batch,
    by_part,
    covered,
    distinct_texts,
    joined_answers,
    live_anchors,
    mixed,
    packets,
    window_hashes,
)
from fleetpulse.llm.shared import by_value, keep, partitions, table

by_value(__name__)

WINDOW = 50
# A difference cover: every shift modulo the period is a difference of two of these.
PERIOD = 31
COVER = (1, 5, 11, 24, 25, 27)
ANCHOR_BASE = 0x9E3779B97F4A7C15
FIRST_BASE = 0xD1342543DE82EF95
SECOND_BASE = 0xF1357AEA2E62A9C5
NO_ID = 2**63 - 1

MARKED = (
    "part INT, digest BINARY, doc_id BIGINT, n_words BIGINT, kept_sha256 STRING, "
    "text BINARY, starts BINARY"
)
RESULT = "digest BINARY, n_words BIGINT, n_removed BIGINT, kept_sha256 STRING"


def word_hashes(words: list[bytes]) -> np.ndarray:
    from xxhash import xxh64_intdigest

    return np.fromiter(map(xxh64_intdigest, words), U64, len(words))


def cover_places(count: int) -> np.ndarray:
    places = np.arange(max(count, 0))
    return places[np.isin(places % PERIOD, COVER)]


def anchors_of(hashes: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the anchors of a document."""
    every = window_hashes(hashes, window - PERIOD + 1, ANCHOR_BASE)
    places = cover_places(len(every))
    return places, every[places]


def candidate_starts(hashes: np.ndarray, live: np.ndarray, window: int) -> np.ndarray:
    """Starts of the windows that hold a live anchor."""
    places, values = anchors_of(hashes, window)
    places = places[among(values | U64(1), live)]
    size = max(len(hashes) - window + 1, 0)
    change = np.zeros(size + 1, np.int64)
    np.add.at(change, np.clip(places - (PERIOD - 1), 0, size), 1)
    np.add.at(change, np.minimum(places + 1, size), -1)
    return np.flatnonzero(np.cumsum(change[:-1]) > 0)


def window_names(hashes: np.ndarray, starts: np.ndarray, window: int) -> np.ndarray:
    """128-bit names of the windows at ``starts``, two numbers each."""
    first = window_hashes(hashes, window, FIRST_BASE)[starts]
    second = window_hashes(mixed(hashes), window, SECOND_BASE)[starts]
    return np.stack([first, second], axis=1)


def least_by_name(names: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each distinct name, sorted, and its least id."""
    order = np.lexsort((ids, names[:, 1], names[:, 0]))
    names, ids = names[order], ids[order]
    first = np.ones(len(names), bool)
    first[1:] = (names[1:] != names[:-1]).any(axis=1)
    return names[first], ids[first]


def mark(texts: DataFrame, live: DataFrame, window: int) -> DataFrame:
    """Each text's words; the texts and window starts that the extension must look at."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        from hashlib import sha256

        known, rows = joined_answers(right), []
        for row in left.to_pylist():
            words = row["text"].split()
            starts = np.zeros(0, np.int64)
            if len(words) >= window:
                starts = candidate_starts(word_hashes(words), known, window)
            rows.append(
                (
                    row["part"],
                    row["digest"],
                    NO_ID if row["doc_id"] is None else row["doc_id"],
                    len(words),
                    sha256(b" ".join(words)).hexdigest(),
                    row["text"] if len(starts) else None,
                    starts.astype(np.int32).tobytes(),
                )
            )
        return pa.Table.from_batches([as_batch(rows, MARKED)])

    chosen = texts.select("part", "digest", "doc_id", "text")
    return chosen.groupBy("part").cogroup(live.groupBy("part")).applyInArrow(run, MARKED)


def names_of(texts: pa.Array, starts: pa.Array, ids: np.ndarray, window: int):
    """Window names of several texts, the id of each, and where each text's begin."""
    names, owners, cuts = [np.zeros((0, 2), U64)], [np.zeros(0, np.int64)], [0]
    for text, packed, doc_id in zip(texts, starts, ids, strict=True):
        at = np.frombuffer(packed.as_py(), np.int32)
        names.append(window_names(word_hashes(text.as_py().split()), at, window))
        owners.append(np.full(len(at), doc_id))
        cuts.append(cuts[-1] + len(at))
    return np.concatenate(names), np.concatenate(owners), cuts


def earlier_elsewhere(marked: DataFrame, window: int) -> DataFrame:
    """For each part the windows that start in a document of smaller id in another part."""
    buckets = partitions(marked.sparkSession)

    def send(batches: Iterator) -> Iterator:
        for batch in batches:
            for part, rows in by_part(batch):
                own = batch.take(pa.array(rows))
                ids = own.column("doc_id").to_numpy()
                names, owners, _ = names_of(own.column("text"), own.column("starts"), ids, window)
                names, least = least_by_name(names, owners)
                first, second = (np.ascontiguousarray(names[:, i]) for i in (0, 1))
                yield as_batch(packets(part, first, buckets, second, least), PACKET)

    def answer(group: pa.Table) -> pa.Table:
        parts = group.column("part").to_numpy()
        each = [np.frombuffer(x.as_py(), U64).reshape(3, -1) for x in group.column("data")]
        first, second, least = np.concatenate(each, axis=1)
        least = least.view(np.int64)
        owner = np.repeat(parts, [x.shape[1] for x in each])
        order = np.lexsort((least, second, first))
        first, second, least, owner = (x[order] for x in (first, second, least, owner))
        new = np.ones(len(first), bool)
        new[1:] = (first[1:] != first[:-1]) | (second[1:] != second[:-1])
        run = np.maximum.accumulate(np.where(new, np.arange(len(first)), 0))
        told = np.flatnonzero(least > least[run])
        told = told[np.argsort(owner[told], kind="stable")]
        rows = []
        for part in np.unique(owner[told]):
            own = told[owner[told] == part]
            values = (first[own], second[own], least[run[own]])
            rows.append((int(part), b"".join(x.tobytes() for x in values)))
        return pa.Table.from_batches([as_batch(rows, ANSWER)])

    chosen = marked.where("text IS NOT NULL").select("part", "doc_id", "text", "starts")
    sent = chosen.mapInArrow(send, PACKET)
    return sent.groupBy("bucket").applyInArrow(answer, ANSWER)


def remove(marked: DataFrame, earlier: DataFrame, window: int) -> DataFrame:
    """What is left of the texts that have candidate windows."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        from hashlib import sha256

        ids = left.column("doc_id").to_numpy()
        texts, starts = (left.column(c).combine_chunks() for c in ("text", "starts"))
        names, owners, cuts = names_of(texts, starts, ids, window)
        told = [np.frombuffer(x.as_py(), U64).reshape(3, -1) for x in right.column("data")]
        far = np.concatenate([np.zeros((3, 0), U64), *told], axis=1)
        known, least = least_by_name(
            np.concatenate([names, far[:2].T]), np.concatenate([owners, far[2].view(np.int64)])
        )
        pair = np.dtype([("a", U64), ("b", U64)])
        keys = np.ascontiguousarray(known).view(pair).ravel()
        order = np.argsort(keys, order=("a", "b"))
        asked = np.ascontiguousarray(names).view(pair).ravel()
        gone = least[order][np.searchsorted(keys[order], asked)] < owners
        rows = []
        for i, (text, packed) in enumerate(zip(texts, starts, strict=True)):
            words = text.as_py().split()
            at = np.frombuffer(packed.as_py(), np.int32)[gone[cuts[i] : cuts[i + 1]]]
            lost = covered(at, window, len(words))
            left_over = b" ".join([w for w, x in zip(words, lost, strict=True) if not x])
            rows.append(
                (
                    left.column("digest")[i].as_py(),
                    len(words),
                    int(lost.sum()),
                    sha256(left_over).hexdigest(),
                )
            )
        return pa.Table.from_batches([as_batch(rows, RESULT)])

    chosen = marked.where("text IS NOT NULL").select("part", "digest", "doc_id", "text", "starts")
    return chosen.groupBy("part").cogroup(earlier.groupBy("part")).applyInArrow(run, RESULT)


def remove_repeats(docs: DataFrame, window: int = WINDOW, **columns: str) -> DataFrame:
    """One row per given row: ``doc_id``, ``n_words``, ``n_removed``, ``kept_sha256``."""
    if window < PERIOD:
        raise ValueError(f"a window needs at least {PERIOD} words")
    rows, texts = distinct_texts(docs, **columns)

    def anchors(text: bytes, copies: int) -> np.ndarray:
        words = text.split()
        if len(words) < window:
            return np.zeros(0, U64)
        # Once per document: only matches between documents count.
        return np.unique(anchors_of(word_hashes(words), window)[1] | U64(1))

    marked = keep(mark(texts, live_anchors(texts, anchors), window), "marked")
    changed = remove(marked, earlier_elsewhere(marked, window), window)
    same = marked.where("text IS NULL").select(
        "digest", "n_words", F.lit(0).cast("long").alias("n_removed"), "kept_sha256"
    )
    results = keep(same.union(changed), "results")
    first = texts.select("digest", F.col("doc_id").alias("first_id"), "copies")
    # A copy of an earlier text goes whole; its id is larger or, at the least, missing.
    copy = ~F.col("doc_id").eqNullSafe(F.col("first_id")) & (F.col("n_words") >= window)
    return rows.join(results.join(first, "digest"), "digest").select(
        "doc_id",
        "n_words",
        F.when(copy, F.col("n_words")).otherwise(F.col("n_removed")).alias("n_removed"),
        F.when(copy, F.sha2(F.lit(""), 256)).otherwise(F.col("kept_sha256")).alias("kept_sha256"),
    )


def op10_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return remove_repeats(table(spark, folder, "documents"))
