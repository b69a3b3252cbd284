"""Lookups that replace per-row subqueries with equi-joins.

* ``interval_lookup`` -- the "which season contains this timestamp" question
  (point-in-range join, smallest id wins).  Spark has no range-join operator
  and a non-equi join plans as a nested loop.  Here ranges become disjoint
  segments that carry their smallest id, and a timestamp belongs to the last
  segment that begins before it:

  1. Each range is cut into aligned time blocks, two of each length (a power of
     two of microseconds) at most, and each block keeps its smallest id.
     However long, many or nested the ranges are, that is some dozen rows for
     each.
  2. A point's id is the smallest of the blocks that hold it, one of each
     length: an equi-join.  This is asked only for the points where an answer
     can change: the ranges' bounds and the first instants of the cells (some
     minutes) in which there are facts.
  3. The facts' different timestamps and these points are sorted by cell and
     time, and ``last(ignoreNulls)`` carries each segment's id to its timestamps.
  4. The facts are joined by timestamp, an equi-join whose hot keys AQE splits.

  The work grows as the number of ranges and facts, not as their product.
* ``unique_lookup`` -- a correlated scalar subquery ``(SELECT id FROM t
  WHERE t.label = x.label)`` as a left join on a key-unique side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Longest block: 2 ** 60 microseconds hold every timestamp from year 1 to 9999.
TOP = 60
#: Facts are sorted within cells of 2 ** 30 microseconds (18 minutes).
CELL = 30


def _micros(ts: Column) -> Column:
    """Microseconds of a timestamp without time zone, counted so that none is negative."""
    day = F.unix_date(ts.cast("date")).cast("long") * 86_400_000_000
    second = (F.date_part(F.lit("SECOND"), ts) * 1_000_000).cast("long")
    return day + (F.hour(ts) * 3600 + F.minute(ts) * 60).cast("long") * 1_000_000 + second + F.lit(1 << (TOP - 1))


def time_blocks(ranges: DataFrame) -> DataFrame:
    """(level, block, id): the aligned blocks that make up each range (id, first, end), ``end`` excluded."""
    up, down = "shiftright(first + shiftleft(1L, l) - 1, l)", "shiftright(end, l)"
    cover = f"""filter(flatten(transform(sequence(0, {TOP}), l -> array(
        CASE WHEN {up} < {down} AND {up} % 2 = 1 THEN struct(l AS level, {up} AS block) END,
        CASE WHEN {up} < {down} AND {down} % 2 = 1 THEN struct(l AS level, {down} - 1 AS block) END))), b -> b IS NOT NULL)"""
    blocks = ranges.select("id", F.explode(F.expr(cover)).alias("at"))
    return blocks.groupBy("at.level", "at.block").agg(F.min("id").alias("id"))


def segments(ranges: DataFrame, cells: DataFrame) -> DataFrame:
    """(t, id): from t on (to the next t), ``id`` is the smallest id of the ranges there, NULL if none.

    ``cells`` has further points t to answer for.
    """
    points = ranges.select(F.explode(F.array("first", "end")).alias("t")).unionByName(cells)
    asked = points.select("t", F.explode(F.sequence(F.lit(0), F.lit(TOP))).alias("level"))
    asked = asked.withColumn("block", F.expr("shiftright(t, level)"))
    # a point in no range ends the segment before it
    return asked.join(time_blocks(ranges), ["level", "block"], "left").groupBy("t").agg(F.min("id").alias("id"))


def interval_lookup(facts: DataFrame, ts_col: str, ranges: DataFrame, id_col: str, start_col: str,
                    end_col: str, out_col: str, times: DataFrame | None = None, few: int = 0) -> DataFrame:
    """Add ``out_col`` = smallest ``id_col`` of the ranges with
    ``start <= ts <= end``, NULL if none; facts keep their rows.

    ``times`` may name a cheaper frame whose ``ts_col`` holds all timestamps of
    the facts.  Ranges without id or bound, or that end before they begin, hold
    nothing; a NULL timestamp is in none.  With ``few`` the answers are evaluated
    at once, and if there are no more than that, they are broadcast: the facts
    are not shuffled.
    """
    known = (ranges.select(F.col(id_col).alias("id"), F.col(start_col).cast("timestamp_ntz").alias("s"),
                           F.col(end_col).cast("timestamp_ntz").alias("e"))
             .where(F.col("id").isNotNull() & (F.col("s") <= F.col("e")))
             .select("id", _micros(F.col("s")).alias("first"), (_micros(F.col("e")) + 1).alias("end")))
    at = (facts if times is None else times).select(F.col(ts_col).cast("timestamp_ntz").alias("_ts")).where("_ts is not null").distinct()
    at = at.select("_ts", _micros(F.col("_ts")).alias("t"))
    cell = F.expr(f"shiftleft(shiftright(t, {CELL}), {CELL})")
    answers = segments(known, at.select(cell.alias("t")).distinct())
    line = (answers.select("t", F.struct("id").alias("hit"), F.lit(None).cast("timestamp_ntz").alias("_ts"))
            .unionByName(at.select("t", F.lit(None).cast(answers.select(F.struct("id").alias("hit")).schema["hit"].dataType).alias("hit"), "_ts")))
    # at equal times the segment comes first
    before = W.partitionBy(cell).orderBy("t", F.col("_ts").isNotNull()).rowsBetween(W.unboundedPreceding, W.currentRow)
    line = line.select("_ts", "t", F.last("hit", ignorenulls=True).over(before)["id"].alias(out_col)).where("_ts is not null")
    if few:
        answer = line.select(F.col("t").alias("_t"), out_col)
        found = answer.limit(few + 1).collect()
        if len(found) <= few:
            small = F.broadcast(facts.sparkSession.createDataFrame(found, answer.schema))
            return facts.withColumn("_t", _micros(F.col(ts_col).cast("timestamp_ntz"))).join(small, "_t", "left").drop("_t")
    line = line.drop("t")
    joined = facts.withColumn("_ts", F.col(ts_col).cast("timestamp_ntz")).join(line, "_ts", "left")
    return joined.drop("_ts")


def unique_lookup(table: DataFrame, key_col: str, value_col: str, key_alias: str,
                  value_alias: str) -> DataFrame:
    """``key -> value`` with one row per key (smallest value kept), the
    deterministic form of a scalar subquery that must return one row."""
    return (table.where(F.col(key_col).isNotNull())
            .groupBy(F.col(key_col).alias(key_alias))
            .agg(F.min(value_col).alias(value_alias)))
