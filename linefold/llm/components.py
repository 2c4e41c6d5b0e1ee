"""Connected components by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stable


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star round over edges (u > v): every node hangs its larger (or its
    smaller-or-equal) neighbours on the least node that it knows.  The least is a
    partially aggregated minimum, so a hub costs no more than its edges."""
    if large:
        both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        both = edges
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m"))
    joined = both.join(least, "u")
    if large:
        out = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(joined.select("u", F.col("m").alias("v")))
    return out.where("u <> v").distinct()


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``edges(a, b)`` of comparable ids to ``(node, component)``: the least id
    reachable, for every node that has an edge to another node.

    Ids may be of any ordered type; null ends and loops are left out.  Each round
    is checkpointed, so a lost executor costs one round.  The number of rounds
    grows with the logarithm of the component size.
    """
    now = stable(
        edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    )
    mark = lambda df: tuple(df.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % 1000003)).first())
    seen = mark(now)
    for _ in range(max_rounds):
        if not seen[0]:
            break
        now = stable(_star(_star(now, True), False))
        new = mark(now)
        if new == seen:
            break
        seen = new
    else:
        raise RuntimeError(f"no fixed point after {max_rounds} rounds")
    return now.select(F.col("u").alias("node"), F.col("v").alias("component"))
