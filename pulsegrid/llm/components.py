"""Connected components by alternating large-star and small-star steps.

Every step is a grouped minimum (partial aggregates first) and a join of two written tables, so that a node with
a large share of all edges is split by adaptive execution. Edges never leave the executors; the driver sees one
row (count and checksum) per round. The rounds end in stars: every node points to the smallest of its component.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.common import materialise


# Edges that one task handles at ease; the number of tasks follows the number of edges.
EDGES_A_TASK = 200_000


def _step(edges: DataFrame, large: bool, parts: int) -> DataFrame:
    """``edges(u, v)``, u > v. Large star: larger neighbours to the least; small star: smaller ones and itself."""
    if large:
        seen = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = seen.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        moved = seen.where("v > u").join(materialise(least, "star", parts), "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        least = materialise(edges.groupBy("u").agg(F.min("v").alias("m")), "star", parts)
        moved = (edges.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(least.select("u", F.col("m").alias("v"))))
    return materialise(moved.where("u > v").distinct(), "edges", parts)


def connected_components(edges: DataFrame, max_rounds: int = 200) -> DataFrame:
    """``(node, component)`` for every node that has an edge; ``edges(src, dst)`` are longs in any direction.

    Nulls and loops are no edges; repeated edges count once; no edges give no rows. The component is the smallest
    node. Raises if the rounds (about log n) do not suffice, rather than return what is not finished.
    """
    now = materialise(edges.where("src != dst").select(F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v")).distinct(), "edges")
    mark = None
    for _ in range(max_rounds):
        found = now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if not found[0] or found == mark:
            break
        mark = found
        parts = 1 + found[0] // EDGES_A_TASK
        now = _step(_step(now, True, parts), False, parts)
    else:
        raise RuntimeError(f"components not settled after {max_rounds} rounds")
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def shared_classes(held: DataFrame, key: str) -> DataFrame:
    """Links ``(a, b)`` between the classes of one id: ``held(key, id)`` names the classes that rows of an id fell into;
    each is linked with the least one. The least is a partial aggregate, so an id that very many rows share is no group."""
    least = held.groupBy(key).agg(F.min("id").alias("_least"), F.max("id").alias("_most")).where("_least != _most")
    return held.join(least, key).where("id != _least").select(F.col("id").alias("a"), F.col("_least").alias("b"))
