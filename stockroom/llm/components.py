"""Connected components of a table of edges, by alternating star contraction.

Every node ends up linked to the smallest node of its component.  The large
step hangs a node's larger neighbours under its smallest neighbour, the small
step its smaller ones; both only shuffle edges by a node, take a minimum (with
partial aggregation) and join it back, so nothing is gathered per component.
Each round is written to the shared folder, which keeps lineage short; the
loop ends when a round changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockroom.llm.common import materialize

MOST_ROUNDS = 60


def _large(edges: DataFrame) -> DataFrame:
    """edges (hi, lo) with hi > lo -> larger neighbours of a node under its smallest."""
    both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionAll(
        edges.select(F.col("lo").alias("u"), F.col("hi").alias("v"))
    )
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    up = both.filter("v > u").join(least, "u")
    return up.select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()


def _small(edges: DataFrame) -> DataFrame:
    """The smaller neighbours of a node, and the node, under the smallest of them."""
    least = edges.groupBy("hi").agg(F.min("lo").alias("m"))
    joined = edges.join(least, "hi")
    moved = joined.filter("lo > m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
    own = least.select("hi", F.col("m").alias("lo"))
    return moved.unionAll(own).distinct()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root): every node of an edge with the smallest node it reaches.

    ``edges`` holds pairs of bigint nodes in any order, with repeats and loops;
    pairs with a null are ignored.
    """
    lo, hi = F.least(a, b), F.greatest(a, b)
    pairs = edges.filter(F.col(a).isNotNull() & F.col(b).isNotNull()).select(hi.alias("hi"), lo.alias("lo"))
    loops = pairs.filter("hi = lo").select(F.col("hi").alias("node"), F.col("lo").alias("root"))
    stars = materialize(pairs.filter("hi > lo").distinct(), "edges")
    known = None
    for _ in range(MOST_ROUNDS):
        stars = materialize(_small(_large(stars)), "edges")
        # stars are at rest when no node is both a child and a parent and each child has one parent
        state = stars.agg(
            F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)")).alias("digest")
        ).first()
        if state == known:
            break
        known = state
    else:
        raise RuntimeError(f"components: no rest after {MOST_ROUNDS} rounds")
    found = stars.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
    roots = found.select(F.col("root").alias("node"), "root").distinct()
    return found.unionAll(roots).unionAll(loops).groupBy("node").agg(F.min("root").alias("root"))
