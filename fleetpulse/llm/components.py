"""Connected components of a link table, by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetpulse.llm.shared import keep


def components(links: DataFrame) -> DataFrame | None:
    """``node`` and ``root`` for every node of ``links`` (``a``, ``b``); None for none.

    In each round every node joins its neighbour of the smallest hash, and links are
    drawn anew between what they joined. Hashes make chains shrink by a share per
    round rather than by one node. Every round is kept, so lineage stays short.
    """
    links = keep(links.select("a", "b").where("a <> b").distinct(), "links")
    roots: DataFrame | None = None
    while not links.isEmpty():
        ends = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = ends.groupBy(F.col("a").alias("node")).agg(
            F.min(F.struct(F.xxhash64("b").alias("h"), F.col("b").alias("node"))).alias("least")
        )
        own = F.struct(F.xxhash64("node").alias("h"), F.col("node").alias("node"))
        parents = keep(
            lowest.select("node", F.least("least", own)["node"].alias("parent")), "parents"
        )
        if roots is None:
            roots = parents.select("node", F.col("parent").alias("root"))
        else:
            step = parents.select(F.col("node").alias("root"), "parent")
            roots = keep(
                roots.join(step, "root", "left").select(
                    "node", F.coalesce("parent", "root").alias("root")
                ),
                "roots",
            )
        of_a = parents.select(F.col("node").alias("a"), F.col("parent").alias("pa"))
        of_b = parents.select(F.col("node").alias("b"), F.col("parent").alias("pb"))
        links = keep(
            links.join(of_a, "a")
            .join(of_b, "b")
            .where("pa <> pb")
            .select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b"))
            .distinct(),
            "links",
        )
    return roots
