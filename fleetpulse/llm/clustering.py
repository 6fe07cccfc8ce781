"""Centroid clustering in whole numbers, by expressions that stay in the JVM.

Vectors become arrays of whole numbers once and are kept. A round carries the centroids
in its plan as literal arrays: ``zip_with`` and ``aggregate`` compute each squared
distance, ``array_min`` over structs of distance and number chooses the cluster, and one
sum per column, combined in the tasks, updates the centroids. A round thus reads the
kept vectors once and moves one row per task and cluster; only the clusters' sums, a
number of rows set by ``clusters``, reach the driver. All arithmetic is exact, so the
result does not depend on the order or the partitions of the rows.

Defined cases: a NULL vector, one with a NULL, NaN or infinite component, or one of
another length is left out; rows that repeat are vectors of their own; a NULL id is
hashed as the empty text; of ids with equal hashes (repeated ids) the smaller vector
comes first; with fewer vectors than clusters each one starts a cluster; an empty table
gives no rows; of equal distances the smaller cluster number wins; a cluster that loses
all its vectors keeps its centroid. Numbers beyond ``LARGEST`` after scaling count as
``LARGEST`` with their sign, so that no distance passes 64 bits; inertias that do become
NULL. Further columns are ignored.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetpulse.llm.shared import keep, partitions, table

DIMENSIONS = 64
CLUSTERS = 40
ROUNDS = 5
SCALE = 256
SALT = "2:"
LARGEST = 1 << 27

Centroids = list[list[int]]


@dataclass(frozen=True)
class Clustering:
    """``assigned`` has ``vec_id``, ``cluster`` and ``distance`` for every vector."""

    assigned: DataFrame
    centroids: Centroids
    inertias: list[int]


def whole_vectors(
    embeddings: DataFrame,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    dimensions: int = DIMENSIONS,
    scale: int = SCALE,
) -> DataFrame:
    """``vec_id`` and ``v``, the scaled vector in whole numbers, for each usable row.

    Spread evenly, since every later pass does much work on each row.
    """
    vector = F.transform(F.col(vector_column), lambda x: x.cast("double"))
    finite = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x) < F.lit(float("inf"))))
    bound = F.lit(float(LARGEST))
    scaled = F.transform(
        vector, lambda x: F.floor(F.greatest(-bound, F.least(bound, x * scale))).cast("long")
    )
    usable = embeddings.where((F.size(vector) == dimensions) & finite)
    return usable.select(F.col(id_column).cast("long").alias("vec_id"), scaled.alias("v")).repartition(
        partitions(embeddings.sparkSession)
    )


def first_centroids(vectors: DataFrame, clusters: int = CLUSTERS, salt: str = SALT) -> Centroids:
    """The vectors whose salted ids have the smallest digests, in that order."""
    written = F.coalesce(F.col("vec_id").cast("string"), F.lit(""))
    digest = F.sha2(F.concat(F.lit(salt), written), 256)
    first = vectors.select(digest.alias("digest"), "v").orderBy("digest", "v").limit(clusters)
    return [row.v for row in first.collect()]


def nearest(vector: Column, centroids: Centroids) -> Column:
    """The struct (``distance``, ``cluster``) of the nearest centroid."""

    def squared(centroid: Column) -> Column:
        parts = F.zip_with(vector, centroid, lambda a, b: (a - b) * (a - b))
        return F.aggregate(parts, F.lit(0).cast("long"), lambda total, part: total + part)

    # Written as text, which Spark folds into one literal before the job runs.
    literal = F.from_json(F.lit(json.dumps(centroids)), "array<array<bigint>>")
    return F.array_min(
        F.transform(
            literal,
            lambda centroid, number: F.struct(
                squared(centroid).alias("distance"), number.alias("cluster")
            ),
        )
    )


def updated(vectors: DataFrame, centroids: Centroids) -> Centroids:
    """Each centroid as the componentwise floor of its vectors' mean."""
    placed = vectors.select("v", nearest(F.col("v"), centroids)["cluster"].alias("cluster"))
    columns = [F.sum(F.col("v")[i]).alias(f"s{i}") for i in range(len(centroids[0]))]
    after = list(centroids)
    for cluster, count, *sums in placed.groupBy("cluster").agg(F.count("*"), *columns).collect():
        after[cluster] = [total // count for total in sums]
    return after


def cluster(vectors: DataFrame, centroids: Centroids, rounds: int = ROUNDS) -> Clustering:
    """``rounds`` updates of the centroids, then the last assignment, kept."""
    if not centroids:
        empty = vectors.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance"))
        return Clustering(empty.limit(0), [], [])
    for _ in range(rounds):
        centroids = updated(vectors, centroids)
    best = nearest(F.col("v"), centroids)
    assigned = keep(vectors.select("vec_id", best.alias("best")), "clusters")
    assigned = assigned.select("vec_id", "best.cluster", "best.distance")
    total = F.sum(F.col("distance").cast("decimal(38,0)"))
    found = dict(assigned.groupBy("cluster").agg(total).collect())
    return Clustering(assigned, centroids, [int(found.get(k, 0)) for k in range(len(centroids))])


def op11_centroid_clustering(spark: SparkSession, folder: str) -> DataFrame:
    vectors = keep(whole_vectors(table(spark, folder, "embeddings")), "vectors")
    result = cluster(vectors, first_centroids(vectors))

    def per_cluster(column: Column, values: list, kind: str) -> Column:
        listed = ", ".join("NULL" if x is None else repr(x) for x in values)
        return F.element_at(F.expr(f"cast(array({listed}) as array<{kind}>)"), column + 1)

    inertias = [x if x < 1 << 63 else None for x in result.inertias]
    written = [",".join(map(str, row)) for row in result.centroids]
    whole = sum(result.inertias)
    at = F.col("cluster")
    return result.assigned.select(
        "vec_id",
        "cluster",
        "distance",
        per_cluster(at, inertias, "bigint").alias("cluster_inertia"),
        F.lit(whole if whole < 1 << 63 else None).cast("long").alias("inertia"),
        F.sha2(per_cluster(at, written, "string"), 256).alias("centroid_sha256"),
    )


def _sql() -> str:
    """One pair of steps per round: assign, then average."""
    steps = [
        f"""
        v AS (
          SELECT row_number() OVER () AS r, vec_id, embedding FROM embeddings
          WHERE len(embedding) = {DIMENSIONS} AND len(list_filter(embedding,
            lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        x AS (
          SELECT r, generate_subscripts(embedding, 1) AS i,
            CAST(floor({SCALE} * CAST(unnest(embedding) AS DOUBLE)) AS BIGINT) AS x FROM v),
        f AS (
          SELECT r, row_number() OVER (ORDER BY sha256('{SALT}' || vec_id)) - 1 AS k FROM v
          ORDER BY k LIMIT {CLUSTERS}),
        c0 AS (SELECT k, i, x AS c FROM f JOIN x USING (r))"""
    ]
    for n in range(ROUNDS + 1):
        steps.append(
            f"""
        d{n} AS (
          SELECT r, k, CAST(sum((x - c) * (x - c)) AS BIGINT) AS d
          FROM x JOIN c{n} USING (i) GROUP BY r, k),
        a{n} AS (SELECT r, min((d, k)) AS best FROM d{n} GROUP BY r),
        b{n} AS (SELECT r, best[1] AS d, best[2] AS k FROM a{n})"""
        )
        if n < ROUNDS:
            steps.append(
                f"""
        m{n} AS (
          SELECT k, i, CAST(floor(CAST(sum(x) AS DOUBLE) / count(*)) AS BIGINT) AS c
          FROM b{n} JOIN x USING (r) GROUP BY k, i),
        c{n + 1} AS (
          SELECT k, i, coalesce(m{n}.c, c{n}.c) AS c FROM c{n} LEFT JOIN m{n} USING (k, i))"""
            )
    last = ROUNDS
    return f"""
        WITH {",".join(steps)},
        h AS (
          SELECT k, sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY i)) AS h
          FROM c{last} GROUP BY k)
        SELECT vec_id, CAST(b.k AS INTEGER) AS cluster, b.d AS distance,
          CAST(sum(b.d) OVER (PARTITION BY b.k) AS BIGINT) AS cluster_inertia,
          CAST(sum(b.d) OVER () AS BIGINT) AS inertia, h AS centroid_sha256
        FROM b{last} b JOIN v USING (r) JOIN h ON h.k = b.k
    """


SQL = _sql()
