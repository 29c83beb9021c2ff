"""Connected components of an edge table, by alternating stars; nothing is collected."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.core.workspace import cut

#: A key is hot if it has more than MOST rows, and more than one row in HOT; there are no more than HOT such keys.
HOT, MOST = 1000, 1 << 16


def join_split(left: DataFrame, right: DataFrame, keys: list[str], rows: str, total: int, most: int) -> DataFrame:
    """left join right (one row a key), without sending all of a hot key's rows to one task.

    right's column ``rows`` says how many of left's ``total`` rows a key has; none has more than ``most``. Hot keys, if
    there can be any, are broadcast: at most HOT, as their rows add up to the total. All others are shuffled.
    """
    least = max(MOST, total // HOT)
    if most <= least:
        return left.join(right, keys)
    hot = F.broadcast(right.where(F.col(rows) > least))
    rest = left.join(F.broadcast(right.where(F.col(rows) > least).select(*keys)), keys, "left_anti")
    return left.join(hot, keys).unionByName(rest.join(right.where(F.col(rows) <= least), keys))


def _star(pairs: DataFrame, total: int, most: int) -> DataFrame:
    """pairs (node, near), ``total`` of them, ``most`` of a node -> each pair with the smallest of the node and all its near ones."""
    low = pairs.groupBy("node").agg(F.min("near").alias("low"), F.count("*").alias("rows"))
    low = low.select("node", F.least("node", "low").alias("low"), "rows")
    return join_split(pairs, low, ["node"], "rows", total, most).drop("rows")


def _state(pairs: DataFrame) -> tuple[bool, int, int]:
    """(settled, rows, most): whether every node points at one smaller node that points at none, so that this one is its
    component's smallest; the number of rows, each counted for both its ends, and of those of one end at most."""
    roles = pairs.select(F.col("node").alias("x"), F.lit(1).alias("up"), F.lit(0).alias("down"))
    ends = roles.union(pairs.select("near", F.lit(0), F.lit(1))).groupBy("x").agg(F.sum("up").alias("up"), F.sum("down").alias("down"))
    bad, rows, most = ends.agg(F.bool_or(F.expr("up > 0 and up + down > 1")), F.sum(F.col("up") + F.col("down")), F.max(F.col("up") + F.col("down"))).first()
    return not bad, rows or 0, most or 0


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """One row (node, component) per node that an edge names; component is the smallest node reachable.

    Large-star and small-star in turn (Kiveris et al. 2014): O(log^2 n) rounds. Each round is written to the shared
    folder. Null ends and loops carry no link; a node that has only a loop is its own component.
    """
    ends = edges.select(F.col(a).alias("x"), F.col(b).alias("y")).where("x is not null and y is not null")
    now = cut(ends.select(F.greatest("x", "y").alias("node"), F.least("x", "y").alias("near")).distinct(), "edges")
    every = now
    now = now.where("node <> near")
    for _ in range(max_rounds):
        settled, total, most = _state(now)
        if settled:
            break
        both = now.union(now.select(F.col("near").alias("node"), F.col("node").alias("near")))
        large = _star(both, total, most).where("near > node").select(F.col("near").alias("node"), F.col("low").alias("near"))
        large = large.where("node <> near").distinct()
        # a node has no more rows here: one for each smaller node near it
        small = _star(large, total, most)
        now = small.select(F.col("near").alias("node"), F.col("low").alias("near"))
        now = now.union(small.select("node", F.col("low").alias("near"))).where("node <> near").distinct()
        now = cut(now, "stars")
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    nodes = every.select("node").union(every.select("near")).distinct()
    return nodes.join(now, "node", "left").select("node", F.coalesce("near", "node").alias("component"))
