"""SimHash near-dedup by pigeonhole blocks.

A text's fingerprint is the bitwise majority of the 64-bit hashes of its word shingles.
Fingerprints that differ in at most ``DISTANCE`` bits agree on all but that many of
``blocks`` blocks, so they meet under some choice of the remaining blocks. Texts are
reduced to distinct fingerprints first; those that meet are verified, and each meeting
passes on only the links of a spanning forest, never all its pairs. A meeting of more
than ``CROWD`` fingerprints is not compared pair by pair: each member names every
fingerprint up to half the distance away, and two members are within the distance just
if they name a common one.

Defined cases: a NULL text is the empty text; texts without words have fingerprint zero
and are linked like any other; fewer words than a shingle are one shingle; rows that
repeat are each in the result; a NULL id is never a component's name unless all its
documents lack one.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetpulse.llm.components import components
from fleetpulse.llm.shared import by_value, document_key, keep, keyed_semi_join, table, whole_text

by_value(__name__)

SHINGLE = 4
DISTANCE = 4
BITS = 64
CROWD = 1024
SEED = 42


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """The unsigned fingerprint of one text."""
    from xxhash import xxh64_intdigest

    words = text.encode().lower().split()  # bytes: ASCII letters and ASCII white space
    if not words:
        return 0
    if len(words) < shingle:
        hashes = [xxh64_intdigest(b" ".join(words), SEED)]
    else:
        rows = zip(*(words[i:] for i in range(shingle)), strict=False)
        hashes = [xxh64_intdigest(x, SEED) for x in map(b" ".join, rows)]
    bits = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 4096):
        part = np.array(hashes[at : at + 4096], np.uint64).view(np.uint8).reshape(-1, 8)
        bits += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * bits > len(hashes), bitorder="little").view(np.uint64)[0])


def with_fingerprint(docs: DataFrame, text: str, shingle: int = SHINGLE) -> DataFrame:
    """``docs`` with its ``text`` column replaced by ``fp``, a signed 64-bit number."""
    others = [c for c in docs.columns if c != text]
    schema = docs.select(*others, F.lit(0).cast("long").alias("fp")).schema

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            texts = batch.column(len(others)).to_pylist()
            prints = np.array([fingerprint(x, shingle) for x in texts], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(prints.view(np.int64))], [*others, "fp"]
            )

    return docs.select(*others, text).mapInArrow(run, schema)


def block_masks(blocks: int, distance: int = DISTANCE) -> list[int]:
    """The bits each choice of ``blocks - distance`` blocks compares."""
    ends = [BITS * i // blocks for i in range(blocks + 1)]
    masks = [(1 << high) - (1 << low) for low, high in zip(ends, ends[1:], strict=False)]
    return [sum(chosen) for chosen in combinations(masks, blocks - distance)]


def choose_blocks(count: int, distance: int = DISTANCE) -> int:
    """The blocks that keep meetings few for ``count`` fingerprints; any number is exact."""

    def cost(blocks: int) -> float:
        kept = blocks - distance
        return math.comb(blocks, kept) * (8 + count / 2 ** (BITS * kept / blocks))

    return min(range(distance + 1, distance + 6), key=cost)


def signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def forest(members: list[int], distance: int = DISTANCE) -> list[tuple[int, int]]:
    """Links of a spanning forest of the members within ``distance`` of each other."""
    values = np.array(members, np.int64).view(np.uint64)
    tree = list(range(len(members)))

    def root(i: int) -> int:
        while tree[i] != i:
            tree[i] = i = tree[tree[i]]
        return i

    links = []
    for i in range(len(members) - 1):
        near = np.bitwise_count(values[i + 1 :] ^ values[i]) <= distance
        for j in np.flatnonzero(near) + i + 1:
            a, b = root(i), root(int(j))
            if a != b:
                tree[b] = a
                links.append((members[i], members[int(j)]))
    return links


def meeting_links(meetings: DataFrame, distance: int = DISTANCE) -> DataFrame:
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            found = [x for m in batch.column(0).to_pylist() for x in forest(m, distance)]
            a, b = zip(*found, strict=True) if found else ((), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"]
            )

    return meetings.select("members").mapInArrow(run, "a BIGINT, b BIGINT")


def ball(radius: int) -> np.ndarray:
    """The masks of at most ``radius`` bits."""
    masks = (
        sum(1 << bit for bit in bits)
        for size in range(radius + 1)
        for bits in combinations(range(BITS), size)
    )
    return np.fromiter(masks, np.uint64)


def midpoint_links(crowd: DataFrame, even: int, odd: int) -> DataFrame:
    """Links to the least fingerprint at each midpoint that a fingerprint reaches.

    Those with an even number of bits reach ``even`` bits far, others ``odd``. Where the
    two differ, a midpoint links only if both sorts reach it: any two of different sorts
    are then near, which connects them all.
    """
    reach = [ball(even), ball(odd)]

    def name(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for value in batch.column(0).to_numpy().view(np.uint64):
                masks = reach[int(np.bitwise_count(value)) % 2]
                midpoints = (masks ^ value).view(np.int64)
                own = np.full(len(masks), value, np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(midpoints), pa.array(own)], ["midpoint", "fp"]
                )

    named = crowd.select("fp").mapInArrow(name, "midpoint BIGINT, fp BIGINT")
    sort = F.bit_count("fp") % 2
    sorts = [] if even == odd else [(F.min(sort) < F.max(sort)).alias("both")]
    firsts = named.groupBy("midpoint").agg(
        F.min("fp").alias("a"), F.max("fp").alias("z"), F.count("*").alias("n"), *sorts
    )
    shared = firsts.where("n > 1" if even == odd else "n > 1 AND both")
    pairs = shared.where("n = 2").select("a", F.col("z").alias("b"))
    more = named.join(keep(shared.where("n > 2").select("midpoint", "a"), "midpoints"), "midpoint")
    return pairs.union(more.select("a", F.col("fp").alias("b")))


def crowd_links(crowd: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """Exact links among members of large meetings, linear in their number.

    Members at most twice ``distance // 2`` apart share a midpoint halfway. Members at an
    odd ``distance`` are of different parity, so those of one parity reach a bit farther.
    """
    half = distance // 2
    links = midpoint_links(crowd, half, half)
    return links.union(midpoint_links(crowd, half + 1, half)) if distance % 2 else links


def fingerprint_links(
    prints: DataFrame, count: int, distance: int = DISTANCE, crowd: int = CROWD
) -> DataFrame:
    """Links (``a``, ``b``) that connect just what chains of near fingerprints connect.

    ``prints`` has distinct ``fp``; ``count`` only steers the number of blocks.
    """
    masks = block_masks(choose_blocks(count, distance), distance)
    choices = F.array(
        *(
            F.struct(F.lit(i).alias("choice"), F.lit(signed(mask)).alias("mask"))
            for i, mask in enumerate(masks)
        )
    )
    keyed = prints.select("fp", F.explode(choices).alias("c")).select(
        F.col("c.choice").alias("choice"), F.col("fp").bitwiseAND(F.col("c.mask")).alias("key"), "fp"
    )
    sizes = keyed.groupBy("choice", "key").agg(F.count("*").alias("n")).where("n > 1")
    sizes = keep(sizes, "meetings")
    few = keyed.join(sizes.where(F.col("n") <= crowd), ["choice", "key"])
    meetings = few.groupBy("choice", "key").agg(F.collect_list("fp").alias("members"))
    links = meeting_links(meetings, distance)
    large = sizes.where(F.col("n") > crowd)
    if large.isEmpty():
        return links
    members = keyed.join(large, ["choice", "key"]).select("fp").distinct()
    return links.union(crowd_links(keep(members, "crowd"), distance))


def near_groups(prints: DataFrame, distance: int = DISTANCE, crowd: int = CROWD) -> DataFrame:
    """``fp`` and ``component_id`` for distinct prints (``fp``, ``least_id``)."""
    links = fingerprint_links(prints, prints.count(), distance, crowd)
    roots = components(links)
    if roots is None:
        return prints.select("fp", F.col("least_id").alias("component_id"))
    named = prints.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least_id", F.coalesce("root", "fp").alias("root")
    )
    least = named.groupBy("root").agg(F.min("least_id").alias("component_id"))
    return named.join(keep(least, "components"), "root").select("fp", "component_id")


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text"):
    """One row per given row: ``doc_id``, ``fp`` and ``component_id``."""
    chosen = docs.select(
        F.col(id_column).cast("long").alias("doc_id"), whole_text(text_column).alias("text")
    )
    rows = keep(with_fingerprint(chosen, "text"), "fingerprints")
    prints = keep(rows.groupBy("fp").agg(F.min("doc_id").alias("least_id")), "prints")
    return rows.join(keep(near_groups(prints), "groups"), "fp")


def keep_one_of_each_group(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay: of each component the document of least id.

    Rows that repeat both id and text are one document.
    """
    chosen = docs.select(*document_key(), whole_text().alias("text"))
    rows = keep(with_fingerprint(chosen, "text"), "fingerprints")
    prints = keep(rows.groupBy("fp").agg(F.min("key_id").alias("least_id")), "prints")
    # The component's name may be NULL, so documents are ranked under its fingerprint.
    groups = near_groups(prints.withColumn("least_id", F.col("fp")))
    ranked = rows.join(keep(groups, "groups"), "fp")
    unknown = F.col("key_id").isNull()
    first = ranked.groupBy("component_id").agg(
        F.min(F.struct(unknown, "key_id", "key_text")).alias("key")
    )
    return keyed_semi_join(docs, first.select("key.key_id", "key.key_text"))


def op8_simhash(spark: SparkSession, folder: str) -> DataFrame:
    rows = near_duplicates(table(spark, folder, "documents"))
    return rows.select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )
