"""Places in a seeded random order, without sorting everything in one task.

Rows are scattered over ``2 ** BITS`` ranges of a hash; the ranges' totals are
summed first and only then is each range ordered by itself, from the place at
which it starts.  The ranges are even, as the hash takes in the row's identity.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import materialise

BITS = 12


def hash_range(h: Column, bits: int = BITS) -> Column:
    return F.shiftrightunsigned(h, 64 - bits).cast("int")


def places(df: DataFrame, order: str, group: str, weight: str, ties: tuple = ()) -> DataFrame:
    """``df`` with ``place`` (rows of its group before it) and ``start`` (their weight).

    ``order`` is a long column with a hash; rows with equal hashes follow
    ``ties``; a null group is a group.  ``df`` should be a written table of light
    rows, as it is read twice.
    """
    zero = F.lit(0).cast("long")
    keyed = df.withColumn("_range", hash_range(F.col(order)))
    sums = keyed.groupBy(group, "_range").agg(F.count(F.lit(1)).alias("_n"), F.sum(weight).alias("_w"))
    before = W.partitionBy(group).orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    starts = materialise(
        sums.select(F.col(group).alias("_g"), F.col("_range").alias("_r"), F.coalesce(F.sum("_n").over(before), zero).alias("_n"),
                    F.coalesce(F.sum("_w").over(before), zero).alias("_w")),
        "range-starts")
    joined = keyed.join(starts, keyed[group].eqNullSafe(starts["_g"]) & (keyed["_range"] == starts["_r"]))
    own = W.partitionBy(group, "_range").orderBy(order, *ties)
    inner = own.rowsBetween(W.unboundedPreceding, -1)
    return joined.select(*df.columns, (F.col("_n") + F.row_number().over(own) - 1).alias("place"),
                         (F.col("_w") + F.coalesce(F.sum(weight).over(inner), zero)).alias("start"))
