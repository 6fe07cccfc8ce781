from __future__ import annotations

from hashlib import sha256
from math import floor, isfinite

import pytest

from fleetpulse.llm.clustering import (
    LARGEST,
    cluster,
    first_centroids,
    nearest,
    op11_centroid_clustering,
    updated,
    whole_vectors,
)
from fleetpulse.llm.shared import keep
from tests.helpers import plan

SCHEMA = "vec_id long, embedding array<double>, label int"


def frame(spark, rows, clashing=False):
    made = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)
    if clashing:
        made = made.selectExpr("*", "'own' AS v", "1 AS cluster", "2 AS distance", "'x' AS digest")
    return made


def run(spark, rows, dimensions, clusters, rounds=5, clashing=False):
    vectors = keep(whole_vectors(frame(spark, rows, clashing), dimensions=dimensions), "vectors")
    return cluster(vectors, first_centroids(vectors, clusters), rounds)


def brute(rows, dimensions, clusters, rounds=5):
    """Rows as (vec_id, cluster, distance), the centroids and the inertias."""
    kept = [
        (i, [floor(256 * x) for x in v])
        for i, v in rows
        if v is not None and len(v) == dimensions and all(x is not None and isfinite(x) for x in v)
    ]
    named = lambda i: sha256(f"2:{'' if i is None else i}".encode()).hexdigest()
    centroids = [v for _, v in sorted(kept, key=lambda r: (named(r[0]), r[1]))[:clusters]]

    def assign():
        return [
            min((sum((a - b) ** 2 for a, b in zip(v, c)), k) for k, c in enumerate(centroids))
            for _, v in kept
        ]

    for _ in range(rounds):
        placed = assign()
        for k in range(len(centroids)):
            members = [v for (_, v), (_, at) in zip(kept, placed) if at == k]
            if members:
                centroids[k] = [sum(x) // len(members) for x in zip(*members)]
    placed = assign()
    inertias = [sum(d for d, k in placed if k == n) for n in range(len(centroids))]
    found = [(i, k, d) for (i, _), (d, k) in zip(kept, placed)]
    return found, centroids, inertias


def tuples(result):
    return sorted(map(tuple, result.assigned.collect()), key=repr)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [0.5, -0.25]), (2, [0.5, -0.25]), (2, [0.5, -0.25]), (None, [-0.001, 0.001]),
        (3, None), (4, []), (5, [1.0]), (6, [1.0, None]), (7, [nan, 1.0]), (8, [1.0, -inf]),
        (9, [3.0, 3.0]), (10, [-3.0, 3.0]), (11, [0.0, 0.0]), (11, [1.0, 1.0]), (12, [-0.0, 2.5]),
    ]
    result = run(spark, rows, 2, 4, clashing=True)
    found, centroids, inertias = brute(rows, 2, 4)
    assert tuples(result) == sorted(found, key=repr)
    assert (result.centroids, result.inertias) == (centroids, inertias)


def test_fewer_vectors_than_clusters_and_none(spark):
    result = run(spark, [(1, [1.0]), (2, [2.0])], 1, 40)
    assert sorted(d for _, _, d in tuples(result)) == [0, 0] and len(result.centroids) == 2
    empty = run(spark, [(1, [1.0, 2.0]), (2, None)], 1, 40)
    assert tuples(empty) == [] and empty.centroids == [] and empty.inertias == []


def test_ties_go_to_the_smaller_number_and_empty_clusters_stay(spark):
    rows = [(k, [1.0]) for k in range(50)] + [(50, [9.0])]
    result = run(spark, rows, 1, 3)
    found, centroids, inertias = brute(rows, 1, 3)
    assert tuples(result) == sorted(found, key=repr)
    assert (result.centroids, result.inertias) == (centroids, inertias)


def test_huge_components_stay_in_range(spark):
    result = run(spark, [(1, [1e300, -1e300]), (2, [-1e300, 1e300]), (3, [0.0, 0.0])], 2, 1, rounds=0)
    assert all(abs(x) <= LARGEST for row in result.centroids for x in row)
    assert max(d for _, _, d in tuples(result)) == 2 * (2 * LARGEST) ** 2 or len(tuples(result)) == 3


@pytest.mark.parametrize("parts", [1, 7])
def test_partitions_do_not_matter(spark, parts):
    rows = [(k, [((k * 37) % 101) / 50 - 1, ((k * 53) % 97) / 48 - 1]) for k in range(300)]
    rows += [(1000 + k, [0.125, 0.125]) for k in range(150)]  # a third are copies
    vectors = whole_vectors(frame(spark, rows), dimensions=2).repartition(parts)
    result = cluster(vectors, first_centroids(vectors, 6))
    found, centroids, inertias = brute(rows, 2, 6)
    assert tuples(result) == sorted(found, key=repr)
    assert (result.centroids, result.inertias) == (centroids, inertias)


def test_a_round_stays_in_the_jvm_and_moves_sums_only(spark):
    vectors = keep(whole_vectors(frame(spark, [(1, [1.0, 2.0])]), dimensions=2), "vectors")
    assert updated(vectors, [[0, 0]]) == [[256, 512]]
    chosen = vectors.select("v", nearest(vectors["v"], [[0, 0], [1, 1]])["cluster"].alias("k"))
    text = plan(chosen.groupBy("k").count())
    assert "Python" not in text and "Arrow" not in text and "from_json" not in text
    assert "partial_count" in text


def test_query_on_the_given_table(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding").collect()]
    found, centroids, inertias = brute(rows, 64, 40)
    result = op11_centroid_clustering(spark, folder).collect()
    assert sorted((r.vec_id, r.cluster, r.distance) for r in result) == sorted(found)
    written = [sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    assert all(r.centroid_sha256 == written[r.cluster] for r in result)
    assert all(r.cluster_inertia == inertias[r.cluster] and r.inertia == sum(inertias) for r in result)
