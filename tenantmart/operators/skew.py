"""Skew-safe forms of the header -> lines joins.

``header LEFT JOIN lines`` (a timesheet and its person lines, a receipt and
its plot lines) is the fan-out of every fact model.  When one header owns a
third of all lines, a plain left outer join cannot be split by AQE: only the
preserved (header) side of an outer join may be split, and that side holds
one row for the hot key, so one task would produce a third of the output.

Few keys are ever hot, so only they pay for a form that can be split.
``hot_keys`` finds them in one pass without a shuffle of keys: a frequent-items
sketch, whose counts are exact up to a known error.  The rows of hot keys take
the splittable form, all others the plain join, and the union of both is the
whole result whatever the sketch says: a key on either way gives the same rows.

The splittable form of the left join is an *inner* join -- whose skewed
partitions AQE splits on either side -- of the header with the lines and one
all-NULL line for every header key that has none.  Those keys are found at key
level (distinct header keys anti-joined with the distinct line keys, both
collapsed before the shuffle).

``own_exchange_join`` keeps a chain of joins on one key splittable.  AQE does
not split a join whose partitioning the next join takes over; a second key
column, a hash of the first with a tag of its own, gives each join its own
exchange.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


#: A key is hot with this share of a table's rows, and at least so many rows.
HOT_SHARE = 1 / 4_000
HOT_ROWS = 10_000
#: Keys that a sketch tracks: a count is off by at most 3.5 / TRACKED of the rows (1 / 18,724), less than HOT_SHARE.
TRACKED = 65_536


def hot_keys(tables, on: str, share: float = HOT_SHARE, least: int = HOT_ROWS) -> list:
    """Keys that hold a ``share`` of one table's rows and at least ``least``
    of them; no such key is missed.  Keys with up to the sketch's error less may
    be among them.  At most ``1 / (share - error)`` keys a table; NULL is none."""
    tagged = [t.where(F.col(on).isNotNull()).select(F.col(on).alias("key"), F.lit(i).alias("table")) for i, t in enumerate(tables)]
    found = reduce(DataFrame.unionByName, tagged).groupBy("table").agg(
        F.count(F.lit(1)).alias("rows"), F.expr(f"approx_top_k(key, {int(2 / share)}, {TRACKED})").alias("top")).collect()
    return sorted({r["item"] for f in found for r in f["top"] if r["count"] >= max(least, share * f["rows"])})


def routed(frames, on: str, hot: list):
    """The frames' rows of hot keys and of all others (NULL keys among these)."""
    is_hot = F.coalesce(F.col(on).isin(hot), F.lit(False))
    return [f.where(is_hot) for f in frames], [f.where(~is_hot) for f in frames]


def own_exchange_join(left: DataFrame, right: DataFrame, on: str, tag: int) -> DataFrame:
    """``left INNER JOIN right USING (on)`` with exchanges of its own."""
    extra = F.xxhash64(F.lit(tag), F.col(on))
    return left.withColumn("_exchange", extra).join(
        right.withColumn("_exchange", extra), on=[on, "_exchange"], how="inner").drop("_exchange")


def lines_with_placeholders(header_keys: DataFrame, lines: DataFrame, on: str) -> DataFrame:
    """``lines`` with a key, plus one all-NULL line for every key of
    ``header_keys`` that has none (the NULL key among them)."""
    keyed = lines.where(F.col(on).isNotNull())
    have = keyed.select(F.col(on).alias("_has")).distinct()
    missing = header_keys.select(on).distinct().join(have, F.col(on) == F.col("_has"), "left_anti")
    extra = [f for f in lines.schema.fields if f.name != on]
    return keyed.unionByName(missing.select(on, *[F.lit(None).cast(f.dataType).alias(f.name) for f in extra]))


def fanout_left_join(header: DataFrame, lines: DataFrame, on: str, header_keys: DataFrame | None = None,
                     least: int = HOT_ROWS) -> DataFrame:
    """``header LEFT JOIN lines USING (on)`` with the hot keys of the lines
    splittable.  ``header_keys`` may name a cheaper frame whose ``on`` column
    has all of the header's keys (and perhaps more).  Columns: ``on``, then the
    header's, then the lines'."""
    hot = hot_keys([lines], on, least=least)
    keys = header if header_keys is None else header_keys
    (hot_header, hot_lines, hot_header_keys), (header, lines, _) = routed((header, lines, keys), on, hot) if hot else ((None,) * 3, (header, lines, keys))
    plain = header.join(lines.where(F.col(on).isNotNull()).withColumnRenamed(on, "_line_key"), F.col(on) == F.col("_line_key"), "left").drop("_line_key")
    columns = [on, *[c for c in plain.columns if c != on]]
    if not hot:
        return plain.select(*columns)
    full = lines_with_placeholders(hot_header_keys, hot_lines, on).withColumnRenamed(on, "_line_key")
    split = hot_header.join(full, F.col(on) == F.col("_line_key"), "inner").drop("_line_key")
    return plain.select(*columns).unionByName(split.select(*columns))
