"""Dashboard star query over the labour fact (labour cost and hours per
season, farm and operation family).

The fact is pre-aggregated to its (season, farm, operation) grain before the
dimension joins -- aggregation pushed below the join by hand, since Catalyst
does not -- so the dimension lookups touch one row per group instead of one
per fact row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MEASURES = (("cost", "cost_analytique"), ("hours_direct", "hj_direct"),
            ("hours_indirect", "hj_indirect"))


def labour_cost_star(fact: DataFrame, operations: DataFrame, seasons: DataFrame) -> DataFrame:
    pre = fact.groupBy("campagne", "ferme", "id_operation").agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.sum(src).alias(f"_{out}") for out, src in MEASURES])
    ops = operations.select("id_operation", "famille_operation")
    sea = seasons.select(F.col("id_campagne").alias("campagne"), "reference_campagne")
    j = pre.join(ops, on="id_operation", how="left").join(sea, on="campagne", how="left")
    return j.groupBy("campagne", "reference_campagne", "ferme", "famille_operation").agg(
        F.sum("_n").alias("lines"),
        *[F.sum(f"_{out}").alias(out) for out, _ in MEASURES])
