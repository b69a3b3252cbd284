"""Property tests: Spark expressions against plain-Python definitions,
one Spark job per generated batch."""
import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tenantmart.functions import week_start_date
from tenantmart.operators.cleanse import date_from_number
from tenantmart.operators.lookup import interval_lookup

EPOCH = dt.date(1970, 1, 1)
LAST_DAY = (dt.date(9999, 12, 31) - EPOCH).days
SETTINGS = settings(max_examples=8, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])


def number_to_date(v):
    """Plain-Python statement of the magnitude rule."""
    if v is None or v <= 0:
        return None
    if v > 10 ** 15:
        return EPOCH + dt.timedelta(days=v // (86_400 * 10 ** 9))
    if v > 10 ** 12:
        days = v // 86_400_000
        return EPOCH + dt.timedelta(days=days) if days <= LAST_DAY else None
    if v > 10 ** 9:
        days = v // 86_400
        return EPOCH + dt.timedelta(days=days) if days <= LAST_DAY else None
    if 19_000_000 <= v <= 21_001_231:
        try:
            return dt.date(v // 10000, v // 100 % 100, v % 100)
        except ValueError:
            return None
    return EPOCH + dt.timedelta(days=v // (86_400 * 10 ** 9))


values = st.one_of(
    st.integers(-10, 10 ** 9 + 10),
    st.integers(19_000_000, 21_001_231),
    st.integers(10 ** 9, 4 * 10 ** 9),
    st.integers(10 ** 11, 10 ** 12),
    st.integers(10 ** 12, 4 * 10 ** 12),
    st.integers(10 ** 14, 10 ** 15),
    st.integers(10 ** 15, 4 * 10 ** 18),
)


@SETTINGS
@given(st.lists(values, min_size=1, max_size=60))
def test_date_from_number_matches_definition(spark, vs):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vs)], "i int, v bigint")
    got = {r.i: r.d for r in df.select("i", date_from_number(F.col("v")).alias("d")).collect()}
    assert [got[i] for i in range(len(vs))] == [number_to_date(v) for v in vs]


@SETTINGS
@given(st.lists(st.tuples(st.integers(1901, 2099), st.integers(1, 53)), min_size=1,
                max_size=40))
def test_week_start_matches_definition(spark, yws):
    df = spark.createDataFrame(yws, "y int, w int")
    got = [r.d for r in df.select(week_start_date(F.col("y"), F.col("w")).alias("d")).collect()]
    want = []
    for y, w in yws:
        jan1 = dt.date(y, 1, 1)
        want.append(jan1 - dt.timedelta(days=(jan1.weekday() + 1) % 7)
                    + dt.timedelta(weeks=w - 1))
    assert got == want


day = st.dates(dt.date(2024, 1, 1), dt.date(2024, 3, 31))


@SETTINGS
@given(st.lists(st.tuples(st.integers(1, 50), day, day), min_size=1, max_size=12),
       st.lists(st.tuples(day, st.sampled_from([0, 1, 3600, 86399])), min_size=1, max_size=30))
def test_interval_lookup_matches_brute_force(spark, seasons, facts):
    s = spark.createDataFrame(seasons, "id int, s date, e date")
    ts = [dt.datetime.combine(d, dt.time()) + dt.timedelta(seconds=sec) for d, sec in facts]
    f = spark.createDataFrame(list(enumerate(ts)), "i int, t timestamp_ntz")
    got = {r.i: r.c for r in interval_lookup(f, "t", s, "id", "s", "e", "c").collect()}
    for i, t in enumerate(ts):
        hits = [sid for sid, a, b in seasons
                if dt.datetime.combine(a, dt.time()) <= t <= dt.datetime.combine(b, dt.time())]
        assert got[i] == (min(hits) if hits else None)


@SETTINGS
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 5)), st.integers(0, 9)),
                max_size=15),
       st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 5)), st.integers(0, 9)),
                max_size=25))
def test_fanout_left_join_equals_left_join(spark, header, lines):
    from tenantmart.operators.skew import fanout_left_join
    h = spark.createDataFrame(header, "k int, a int")
    ln = spark.createDataFrame(lines, "k int, b int")
    got = sorted(map(repr, (tuple(r) for r in fanout_left_join(h, ln, "k").collect())))
    want = sorted(map(repr, (tuple(r) for r in h.join(ln, "k", "left").collect())))
    assert got == want


@SETTINGS
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 6)), st.sampled_from(["a", "b", None]),
                          st.integers(0, 3)), max_size=10),
       st.dictionaries(st.integers(0, 8), st.sampled_from(["x", "y", None]), max_size=8),
       st.lists(st.sampled_from(["n", None]), max_size=3))
def test_upsert_frame_matches_definition(spark, target, source_keyed, source_null_keys):
    """Every matched target row takes the source values and keeps its
    target-only column; other rows of both sides are kept; NULL keys never
    match."""
    from tenantmart.operators.load import upsert_frame
    t = spark.createDataFrame(target, "k int, v string, c int")
    src_rows = list(source_keyed.items()) + [(None, v) for v in source_null_keys]
    s = spark.createDataFrame(src_rows, "k int, v string")
    got = sorted(map(repr, (tuple(r) for r in upsert_frame(t, s, ["k"]).collect())))
    want = []
    for k, v, c in target:
        if k is not None and k in source_keyed:
            want.append((k, source_keyed[k], c))
        else:
            want.append((k, v, c))
    tkeys = {k for k, _, _ in target if k is not None}
    want += [(k, v, None) for k, v in src_rows if k is None or k not in tkeys]
    assert got == sorted(map(repr, want))


token_text = st.one_of(st.none(), st.sampled_from(
    ["n/a", "N/A", "nA", "NaN", "nAn", "None", "NONE", "nOnE", "null", "", " ", "   ", "    ",
     "inf", "iNf", "-inf", "<NA>", "NaTT", "natt", "ok", " na", "Nancy"]),
    st.text(alphabet=st.characters(max_codepoint=127), max_size=4))


@SETTINGS
@given(st.lists(token_text, min_size=1, max_size=40))
def test_null_tokens_match_definition(spark, cells):
    from tenantmart.operators.cleanse import NULL_TOKENS, NULL_TOKENS_ANY_CASE, clean_null_tokens
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cells)], "i int, s string")
    got = {r.i: r.s for r in clean_null_tokens(df, ["s"]).collect()}
    for i, c in enumerate(cells):
        gone = c is not None and (c in NULL_TOKENS or c.lower() in NULL_TOKENS_ANY_CASE)
        assert got[i] == (None if gone else c), (i, c)
