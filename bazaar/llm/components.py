"""Connected components of a link table, as repeated joins and aggregates.

Alternating large-star and small-star rounds: each round replaces links by links
to the smallest known neighbour, so the rounds grow with the logarithm of the
longest chain. The smallest neighbour is a map-side combined aggregate and the
join back is an ordinary equi join with an exchange of its own on both sides, which
adaptive execution splits when one node has very many links. Each round is a table in the shared folder; the one before
the last is deleted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaar.llm.staging import Scratch


def _star(links: DataFrame, large: bool) -> DataFrame:
    """Links (u, v), u > v, after one round. Large: from the larger neighbours of a node; small: from the smaller."""
    # another key than the grouping's: else the join would run inside the aggregate's
    # stage, where the rows of one node cannot be split
    key = F.col("u").bitwiseXOR(F.lit(1)).alias("k")
    both = links.select("u", "v").union(links.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else links
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    found = least.select(key, "m")
    if large:
        # every larger neighbour v of u points to the least of u and its neighbours
        joined = both.where("v > u").select(key, "u", "v").join(found, "k")
        return joined.select(F.col("v").alias("u"), F.least("u", "m").alias("v"))
    joined = links.select(key, "u", "v").join(found, "k")
    out = joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return out.union(least.select("u", F.col("m").alias("v")))


def connected_components(links: DataFrame, scratch: Scratch, label: str = "cc", max_rounds: int = 60) -> DataFrame:
    """(node, component) of every node of ``links`` (a, b longs); component is the smallest node reachable."""
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    edges = scratch.table(edges, f"{label}-0")
    state = None
    for k in range(1, max_rounds + 1):
        after = _star(_star(edges, large=True).where("u <> v"), large=False).where("u <> v").distinct()
        edges = scratch.table(after, f"{label}-{k}")
        scratch.drop(f"{label}-{k - 1}")
        now = edges.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
        if tuple(now) == state:
            break
        state = tuple(now)
    else:
        raise RuntimeError("connected components did not settle")
    # settled: every node links to its root alone
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
