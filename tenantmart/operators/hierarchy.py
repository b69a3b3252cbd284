"""Self-referencing tables (P&L account -> parent account, season ->
previous season).

``attach_parent`` adds the columns of a parent: one left join a level, for
callers that know the depth.

``ancestors`` gives the whole closure (node, ancestor, distance) without one,
by pointer doubling: a round joins every node's pairs with the pairs that start
at its farthest ancestor, so chains of any length ``L`` take ``log2(L)`` rounds,
each a distributed join over written tables.  Only one yes or no a round
reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path


class HierarchyCycle(ValueError):
    """Nodes that are their own ancestors; ``nodes`` is the frame (node) of all of them."""

    def __init__(self, message: str, nodes: DataFrame):
        super().__init__(message)
        self.nodes = nodes


def attach_parent(child: DataFrame, nodes: DataFrame, parent_ref: str, node_id: str,
                  columns, prefix: str = "parent_", depth: int = 1) -> DataFrame:
    """Add ``prefix + column`` of the parent node (and of its ancestors up to
    ``depth`` levels as ``prefix2_``, ``prefix3_`` ...)."""
    out, ref = child, parent_ref
    for level in range(1, depth + 1):
        p = prefix if level == 1 else f"{prefix}{level}_"
        cols = [F.col(c).alias(p + c) for c in columns]
        parent = nodes.select(F.col(node_id).alias(f"_{p}id"), *cols)
        out = out.join(parent, out[ref] == parent[f"_{p}id"], "left").drop(f"_{p}id")
        if level < depth:
            ref = p + parent_ref
    return out


def _written(df: DataFrame) -> DataFrame:
    path = scratch_path(df.sparkSession, "hierarchy")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _links(nodes: DataFrame, node_id: str, parent_ref: str) -> DataFrame:
    """(node, parent): of repeated ids the smallest parent; parents that are no node are left out."""
    known = nodes.where(F.col(node_id).isNotNull()).groupBy(F.col(node_id).alias("node")).agg(F.min(parent_ref).alias("parent"))
    return known.join(known.select(F.col("node").alias("parent")), "parent", "left_semi").select("node", "parent")


def cycle_nodes(nodes: DataFrame, node_id: str, parent_ref: str) -> DataFrame:
    """(node): every node that is its own ancestor, a node that names itself included.

    Jumps double each round (parent, grandparent, four steps, ...); a chain that
    ends drops out, and a jump of more steps than there are nodes ends on a
    cycle.  Every node on one is such an end: that of the node as many steps
    before it."""
    jump = _written(_links(nodes, node_id, parent_ref))
    most, steps = jump.count(), 1
    while steps <= most:
        jump = _written(jump.join(jump.select(F.col("node").alias("parent"), F.col("parent").alias("next")), "parent")
                        .select("node", F.col("next").alias("parent")))
        if jump.isEmpty():
            break
        steps *= 2
    return jump.select(F.col("parent").alias("node")).distinct()


def ancestors(nodes: DataFrame, node_id: str, parent_ref: str, on_cycle: str = "raise") -> DataFrame:
    """Every (node, ancestor, distance), distance 1 for the parent.

    NULL ids are left out, NULL parents and parents that are no node end a
    chain, repeated ids count once (smallest parent).  Nodes on or below a cycle
    have endless chains: ``on_cycle='raise'`` raises ``HierarchyCycle`` with the
    cycle's nodes, ``'cut'`` treats the nodes on cycles as roots.
    """
    if on_cycle not in ("raise", "cut"):
        raise ValueError("on_cycle must be 'raise' or 'cut'")
    links = _links(nodes, node_id, parent_ref)
    loops = cycle_nodes(nodes, node_id, parent_ref)
    found = loops.orderBy("node").limit(10).collect()
    if found and on_cycle == "raise":
        raise HierarchyCycle(f"nodes that are their own ancestors, {[r['node'] for r in found]} among them", loops)
    if found:
        links = links.join(loops, "node", "left_anti")
    pairs = _written(links.select("node", F.col("parent").alias("ancestor"), F.lit(1).cast("long").alias("distance")))
    reach = 1                                   # pairs hold every distance up to ``reach``
    while True:
        ends = pairs.where(F.col("distance") == reach).withColumnRenamed("ancestor", "via").drop("distance")
        further = pairs.select(F.col("node").alias("via"), "ancestor", "distance")
        more = _written(ends.join(further, "via").select("node", "ancestor", (F.col("distance") + reach).alias("distance")))
        if more.isEmpty():
            return pairs
        pairs, reach = _written(pairs.unionByName(more)), reach * 2
