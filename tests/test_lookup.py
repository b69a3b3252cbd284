"""Interval lookup against brute force: nested, long, touching and empty ranges, bounds to the microsecond."""
import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tenantmart.operators.lookup import TOP, interval_lookup, time_blocks

BASE = dt.datetime(2023, 12, 31, 23, 59, 59, 999_990)


def brute(ts, ranges):
    hits = [i for i, s, e in ranges if ts is not None and None not in (i, s, e) and s <= ts <= e]
    return min(hits) if hits else None


def lookup(spark, facts, ranges, **kw):
    f = spark.createDataFrame(list(enumerate(facts)), "n long, at timestamp_ntz").repartition(3)
    r = spark.createDataFrame(ranges, "key int, s timestamp_ntz, e timestamp_ntz")
    rows = interval_lookup(f, "at", r, "key", "s", "e", "hit", **kw)
    assert rows.columns == ["n", "at", "hit"] and rows.schema["hit"].dataType.simpleString() == "int"
    return {r.n: r.hit for r in rows.collect()}


@pytest.mark.parametrize("seed, unit", [(1, dt.timedelta(microseconds=1)), (2, dt.timedelta(minutes=7)), (3, dt.timedelta(days=40))])
def test_random_ranges(spark, seed, unit):
    rng = random.Random(seed)
    point = lambda: BASE + unit * rng.randrange(60)
    ranges = [(rng.randrange(50), point(), point()) for _ in range(40)]
    ranges += [(i, BASE + unit * i, BASE + unit * (60 - i)) for i in range(25, 0, -1)]      # one within the other
    ranges += [(None, BASE, BASE + unit * 60), (7, None, BASE), (7, BASE, None)]
    bounds = [b for r in ranges for b in r[1:] if b is not None]
    tick = dt.timedelta(microseconds=1)
    facts = [b + d for b in bounds for d in (-tick, dt.timedelta(0), tick)] + [point() for _ in range(100)] + [None, None]
    assert lookup(spark, facts, ranges) == {n: brute(t, ranges) for n, t in enumerate(facts)}


def test_first_and_last_days_of_the_calendar(spark):
    first, last = dt.datetime(1, 1, 1), dt.datetime(9999, 12, 31, 23, 59, 59, 999_999)
    ranges = [(5, first, last), (3, dt.datetime(1960, 2, 29, 12), dt.datetime(1970, 1, 1)), (9, last, last), (1, first, first)]
    facts = [first, first + dt.timedelta(microseconds=1), dt.datetime(1969, 12, 31, 23, 59, 59, 999_999), dt.datetime(1970, 1, 1, 0, 0, 0, 1), last]
    assert lookup(spark, facts, ranges) == {0: 1, 1: 5, 2: 3, 3: 5, 4: 5}


def test_no_ranges_no_facts_and_cheaper_times(spark):
    facts = [BASE, None, BASE + dt.timedelta(days=2)]
    assert lookup(spark, facts, []) == {0: None, 1: None, 2: None}
    assert lookup(spark, [], [(1, BASE, BASE)]) == {}
    times = spark.createDataFrame([(t,) for t in [*facts, BASE - dt.timedelta(days=9)]], "at timestamp_ntz")
    assert lookup(spark, facts, [(4, BASE, BASE)], times=times) == {0: 4, 1: None, 2: None}


def test_blocks_of_a_range_are_few_and_exact(spark):
    rng = random.Random(5)
    rows = [(i, *sorted(rng.sample(range(1 << 20), 2))) for i in range(200)] + [(900, 0, 1 << (TOP - 1)), (901, 12345, 12346)]
    blocks = time_blocks(spark.createDataFrame(rows, "id int, first long, end long")).collect()
    assert len(blocks) <= 2 * 20 * len(rows)
    for _ in range(500):
        t = rng.randrange(1 << 20)
        hits = [i for i, a, b in rows if a <= t < b]
        assert min(b.id for b in blocks if t >> b.level == b.block) == min(hits)


def test_a_hot_day_is_spread_by_cells_and_no_list_is_built(spark):
    """Ranges and facts of one day: rows between the steps grow as their number, not as their product."""
    def plan(n):
        day = F.lit("2024-03-01").cast("timestamp_ntz")
        at = lambda c: F.timestamp_add("SECOND", c, day)
        ranges = spark.range(n).select(F.col("id"), at(F.col("id") % 86_000).alias("s"), at(F.col("id") % 86_000 + 300).alias("e"))
        facts = spark.range(5 * n).select("id", at(F.pmod(F.xxhash64("id"), F.lit(86_400))).alias("ts"))
        return interval_lookup(facts, "ts", ranges, "id", "s", "e", "hit")
    df = plan(4_000)
    assert "collect_list" not in df._jdf.queryExecution().toString()
    want = {i: min((j for j in range(4_000) if j <= s <= j + 300), default=None) for i, s in
            [(r.id, r.ts.hour * 3600 + r.ts.minute * 60 + r.ts.second) for r in df.select("id", "ts").limit(300).collect()]}
    got = {r.id: r.hit for r in df.where(F.col("id").isin(list(want))).collect()}
    assert got == want
