"""Calendar dimension (one row per day).

The day range is derived from the data (smallest to largest business date
of the given columns): one aggregation for the bounds, then
``explode(sequence(...))``.  Output size is the number of days in the span.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def calendar_rows(day: Column) -> list[Column]:
    """The calendar attributes of a date column: ISO week of year, day of
    week with Sunday = 1, English month and day names, quarter as 'Q1'..'Q4'."""
    return [
        day.alias("date_cal"),
        F.year(day).alias("year"),
        F.concat(F.lit("Q"), F.quarter(day).cast("string")).alias("quarter"),
        F.month(day).alias("month_number"),
        F.date_format(day, "MMMM").alias("month"),
        F.dayofmonth(day).alias("day"),
        F.weekofyear(day).alias("week_of_year"),
        F.dayofweek(day).alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
    ]


def calendar_between(bounds: DataFrame, start_col: str = "start", end_col: str = "end"):
    """Every day from ``start`` to ``end`` of a one-row bounds frame."""
    days = bounds.select(F.explode(F.sequence(F.col(start_col).cast("date"),
                                              F.col(end_col).cast("date"))).alias("d"))
    return days.select(*calendar_rows(F.col("d")))


def calendar_for(frames_and_cols) -> DataFrame:
    """Calendar covering every date in ``[(df, column), ...]``."""
    bounds = [df.agg(F.min(F.to_date(F.col(c))).alias("start"),
                     F.max(F.to_date(F.col(c))).alias("end")) for df, c in frames_and_cols]
    allb = reduce(lambda a, b: a.unionByName(b), bounds)
    one = allb.agg(F.min("start").alias("start"), F.max("end").alias("end"))
    return calendar_between(one)
