from __future__ import annotations

import random

import pytest

from fleetpulse.llm import simhash
from tests.llm.helpers import FOLDER, documents, fingerprint, near_components, sample

ROWS = [
    (1, None), (2, ""), (3, " \n"), (4, "one two"), (5, "ONE  two"), (6, "a b c d e f g h " * 50),
    (7, "a b c d e f g h " * 50 + "i"), (8, "É é x y"), (None, "one two"), (9, "z" * 100_000),
    (6, "a b c d e f g h " * 50), (10, "w " * 30_000),
]


def brute(rows):
    prints = [fingerprint(t) for _, t in rows]
    roots = near_components(prints)
    least = {}
    for (doc_id, _), root in zip(rows, roots):
        if doc_id is not None:
            least[root] = min(least.get(root, doc_id), doc_id)
    return sorted(
        (i or 0, f"{p:016x}", least.get(r)) for (i, _), p, r in zip(rows, prints, roots)
    )


def found(frame):
    return sorted(
        (r.doc_id or 0, f"{r.fp % 2**64:016x}", r.component_id) for r in frame.collect()
    )


def test_odd_rows_equal_brute_force(spark):
    assert found(simhash.near_duplicates(documents(spark, ROWS, clashing=True))) == brute(ROWS)


def test_query_equals_brute_force(spark):
    rows = [tuple(r) for r in simhash.op8_simhash(spark, FOLDER).collect()]
    assert sorted(rows) == brute(sample(spark))


def test_empty_table(spark):
    assert simhash.near_duplicates(documents(spark, [])).count() == 0


@pytest.mark.parametrize("crowd", [2, 1024])
def test_crowds_are_linked_exactly(spark, crowd):
    random.seed(crowd)
    centres = [random.getrandbits(64) for _ in range(3)]
    prints = {random.getrandbits(64) for _ in range(60)}
    for centre in centres:
        for _ in range(60):
            flips = random.sample(range(64), random.randrange(8))
            prints.add(centre ^ sum(1 << b for b in flips))
    ordered = sorted(prints)
    frame = spark.createDataFrame(
        [(p - 2**64 if p >> 63 else p, i) for i, p in enumerate(ordered)], "fp long, least_id long"
    )
    got = {r.fp % 2**64: r.component_id for r in simhash.near_groups(frame, crowd=crowd).collect()}
    assert got == dict(zip(ordered, near_components(ordered)))


@pytest.mark.parametrize("distance", [1, 3, 5])
def test_odd_distances_are_linked_exactly_in_a_crowd(spark, distance):
    random.seed(distance)
    prints = {random.getrandbits(64) for _ in range(6 if distance == 5 else 20)}
    for centre in list(prints)[:6]:
        at = centre
        for _ in range(3):  # a chain of links of just the distance, and a near miss
            at ^= sum(1 << b for b in random.sample(range(64), distance))
            prints.add(at)
        prints.add(at ^ sum(1 << b for b in random.sample(range(64), distance + 1)))
    ordered = sorted(prints)
    frame = spark.createDataFrame(
        [(p - 2**64 if p >> 63 else p, i) for i, p in enumerate(ordered)], "fp long, least_id long"
    )
    links = simhash.crowd_links(frame, distance).distinct().collect()
    assert all(((r.a ^ r.b) % 2**64).bit_count() <= 2 * distance for r in links)
    groups = simhash.near_groups(frame, distance, crowd=1).collect()
    got = {r.fp % 2**64: r.component_id for r in groups}
    assert got == dict(zip(ordered, near_components(ordered, distance)))


@pytest.mark.parametrize("count", [10, 10**6, 10**9, 10**11])
def test_any_number_of_blocks_leaves_one_in_common(count):
    masks = simhash.block_masks(simhash.choose_blocks(count))
    random.seed(count)
    for _ in range(200):
        flipped = sum(1 << b for b in random.sample(range(64), 4))
        assert any(flipped & mask == 0 for mask in masks)


def test_one_of_each_group_stays(spark):
    docs = documents(spark, ROWS, clashing=True)
    kept = simhash.keep_one_of_each_group(docs)
    assert kept.columns == docs.columns
    names = {c for _, _, c in brute(ROWS)}
    assert {r.doc_id for r in kept.collect()} == names
    assert simhash.keep_one_of_each_group(documents(spark, [])).count() == 0


def test_long_chains_become_one_component(spark):
    from fleetpulse.llm.components import components

    links = spark.range(500).selectExpr("id AS a", "id + 1 AS b")
    roots = components(links).collect()
    assert len(roots) == 501 and len({r.root for r in roots}) == 1
    assert components(links.where("a < 0")) is None
