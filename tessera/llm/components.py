"""Connected components of a link table by alternating large-star and small-star rounds.

Each round is two grouped minima and two equi-joins; the links are written to the shared
folder after every round, so no lineage grows and nothing is gathered anywhere. Rounds stop
when the link table no longer changes (about log² of the longest chain).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import scratch


def _state(links: DataFrame) -> tuple:
    row = links.agg(
        F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x"), F.sum(F.xxhash64("v", "u") % 1_000_003).alias("s")
    ).first()
    return row["n"], row["x"], row["s"]


def _round(links: DataFrame) -> DataFrame:
    both = links.select("u", "v").union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    low2 = large.groupBy("u").agg(F.min("v").alias("m"))
    moved = large.join(low2, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(low2.select("u", F.col("m").alias("v"))).distinct()


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, root)`` for every node with a link; ``root`` is the smallest node reachable.

    ``links`` holds long node pairs in any order, repeats and self-links allowed; rows with a
    null end are ignored. Nodes that no other node links to are not returned.
    """
    now = scratch(
        links.where(F.col(a) != F.col(b))
        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .distinct(),
        "links",
    )
    state = _state(now)
    while state[0]:
        nxt = scratch(_round(now), "links")
        after = _state(nxt)
        if after == state:
            break
        now, state = nxt, after
    roots = now.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)
