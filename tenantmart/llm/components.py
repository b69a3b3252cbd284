"""Connected components of a link table, as Spark joins.

Alternates two steps until the links no longer change: every node hands its
larger neighbours its smallest one, then every node hands all its smaller
neighbours the smallest.  The links end as stars around each component's
smallest node.  Each step is one aggregation (partial before the shuffle) and
one join of two written tables, so the links of a hub can be split over tasks.
Each round is a table on the shared folder; only a count and a check sum reach
the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b") % F.lit(1 << 40))).first())


def _smallest(pairs: DataFrame, label: str) -> DataFrame:
    return materialise(pairs.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")), label)


def stars(links: DataFrame) -> DataFrame:
    """(a, b) for every node ``a`` that is not its component's smallest node ``b``.

    ``links`` has columns a and b in any order; self-links and nulls are ignored.
    """
    edges = materialise(
        links.select(F.greatest("a", "b").alias("x"), F.least("a", "b").alias("b")).select(F.col("x").alias("a"), "b").where("a > b").distinct(),
        "links")
    state = _state(edges)
    while state[0]:
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
        large = (materialise(both, "links-both").join(_smallest(both, "links-min"), "u")
                 .where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        large = materialise(large, "links-large")
        small = large.join(_smallest(large, "links-min"), "u")
        edges = materialise(
            small.select(F.explode(F.array(
                F.struct(F.col("v").alias("a"), F.col("m").alias("b")),
                F.struct(F.col("u").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.*").where("a > b").distinct(),
            "links")
        state, before = _state(edges), state
        if state == before:
            break
    return edges
