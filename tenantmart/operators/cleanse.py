"""Cleansing operators applied to a model's output before it is loaded.

Order is the original one: exact-duplicate removal, column names, duplicate
columns, NULL tokens, non-finite numbers, numeric coercion, date columns.
Every step is a single ``select`` of column expressions (one pass, codegen),
except duplicate removal, which is a distinct aggregation (map-side partial
aggregation first, so a heavily repeated row is collapsed before the
shuffle).  No UDF, no collect.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Cell spellings that mean "no value" (compared whole-cell).
NULL_TOKENS = (
    "nan", "NaN", "NAN", "Nan",
    "None", "none", "NONE",
    "null", "NULL", "Null",
    "na", "NA", "N/A", "n/a",
    "NaT", "nat", "<NA>", "NaTT",
    "inf", "Inf", "INF", "-inf", "-Inf", "-INF",
    "", " ", "  ", "   ",
)
# Spellings also matched without regard to case.
NULL_TOKENS_ANY_CASE = ("nan", "nat", "none", "null", "na", "n/a")

# Name fragments that mark a column as a date by name.
DATE_NAME_HINTS = ("date", "embauche", "sortie", "debut", "fin")

# Text date layouts tried in order (Spark datetime patterns): ISO with any part
# of a time and an offset, slashes, compact, and month or day first.
TEXT_DATE_FORMATS = ("yyyy-MM-dd[['T'][ ]HH:mm[:ss[.SSSSSSSSS]]][XXX]", "yyyy/MM/dd[ HH:mm[:ss]]",
                     "yyyyMMdd")
MONTH_FIRST, DAY_FIRST = "MM/dd/yyyy[ HH:mm[:ss]]", "dd/MM/yyyy[ HH:mm[:ss]]"

LAST_DATE = _dt.date(9999, 12, 31)

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
                 T.DecimalType)


# C1 ---------------------------------------------------------------------------------------
def dedupe_rows(df: DataFrame, unit: str | None = None, copies: str | None = None) -> DataFrame:
    """Exact duplicate rows removed; NULL equals NULL and NaN equals NaN.
    ``unit`` names a column beside the row's own, which is dropped: rows of
    different units must not be equal (``shared_units`` tells which might be).  Rows
    that lie by unit are then not shuffled.  ``copies`` names a new column with
    the number of rows that were equal."""
    rows = df.dropDuplicates() if copies is None else df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias(copies))
    return rows if unit is None else rows.drop(unit)


def shared_units(parts: DataFrame, unit: str) -> DataFrame:
    """Units of which some row of ``parts`` (in all other columns) occurs in another
    unit as well.  Compared by a hash of 64 bits, so a few units more may be among
    them; no such unit is missed but the NULL one.  Narrow rows are sorted by
    hash, however many there are of one."""
    others = [c for c in parts.columns if c != unit]
    marked = parts.where(F.col(unit).isNotNull()).select(unit, F.xxhash64(*others).alias("_part"))
    same = Window.partitionBy("_part")
    ends = marked.select(unit, F.min(unit).over(same).alias("_least"), F.max(unit).over(same).alias("_most"))
    return ends.where("_least <> _most").select(unit).distinct()


# C2 ---------------------------------------------------------------------------------------
def normalize_column_names(df: DataFrame, case: str = "lower") -> DataFrame:
    """Names trimmed and case-folded (positional rename, duplicates allowed)."""
    fold = str.lower if case == "lower" else str.upper
    return df.toDF(*[fold(c.strip()) for c in df.columns])


# C3 ---------------------------------------------------------------------------------------
def drop_duplicate_columns(df: DataFrame) -> DataFrame:
    """Keep the first column of each name (case-insensitive, like the
    warehouse); works on frames whose names are not unique."""
    names = df.columns
    tmp = [f"_c{i}" for i in range(len(names))]
    seen, keep = set(), []
    for i, n in enumerate(names):
        k = n.lower()
        if k not in seen:
            seen.add(k)
            keep.append(F.col(tmp[i]).alias(n))
    return df.toDF(*tmp).select(*keep)


# C4 ---------------------------------------------------------------------------------------
def null_token_expr(c: Column, tokens=NULL_TOKENS, any_case=NULL_TOKENS_ANY_CASE,
                    trim: bool = False) -> Column:
    """NULL when the whole cell is one of the tokens.  ``trim=True`` also
    catches tokens padded with blanks (and blank cells of any length)."""
    v = F.trim(c) if trim else c
    hit = v.isin(*tokens) | F.lower(v).isin(*any_case)
    return F.when(hit, F.lit(None).cast("string")).otherwise(c)


def clean_null_tokens(df: DataFrame, columns=None, trim: bool = False, tokens=NULL_TOKENS,
                      any_case=NULL_TOKENS_ANY_CASE) -> DataFrame:
    cols = set(columns) if columns is not None else {
        f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    return df.select(*[null_token_expr(F.col(c), tokens, any_case, trim).alias(c) if c in cols
                       else F.col(c) for c in df.columns])


# C5 ---------------------------------------------------------------------------------------
def finite_or_null(c: Column) -> Column:
    return F.when(F.isnan(c) | c.isin(float("inf"), float("-inf")), F.lit(None)).otherwise(c)


def clean_nonfinite(df: DataFrame, columns=None) -> DataFrame:
    cols = set(columns) if columns is not None else {
        f.name for f in df.schema.fields if isinstance(f.dataType, (T.FloatType, T.DoubleType))}
    return df.select(*[finite_or_null(F.col(c)).alias(c) if c in cols else F.col(c)
                       for c in df.columns])


# C6 ---------------------------------------------------------------------------------------
def coerce_numeric(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """``try_cast`` to the declared numeric type: unparsable text -> NULL."""
    return df.select(*[F.col(c).try_cast(types[c]).alias(c) if c in types else F.col(c)
                       for c in df.columns])


# C8 ---------------------------------------------------------------------------------------
def detect_date_columns(columns, configured=(), by_name: bool = False, exclude=()) -> list[str]:
    """Configured date columns, plus (opt-in) any name holding a date hint."""
    out = [c for c in columns if c in set(configured)]
    if by_name:
        ex = {e.lower() for e in exclude}
        out += [c for c in columns if c not in out and c.lower() not in ex
                and any(h in c.lower() for h in DATE_NAME_HINTS)]
    return out


# C9 ---------------------------------------------------------------------------------------
def _days(v: Column, unit: int) -> Column:
    # exact integer floor division for positive v: (v - v mod unit) / unit is a
    # whole number; rounding removes the double's representation error
    return F.round((v - F.pmod(v, F.lit(unit))) / F.lit(unit)).cast("int")


def date_from_number(c: Column) -> Column:
    """Numeric date decided per row by magnitude: > 1e15 nanoseconds,
    > 1e12 milliseconds, > 1e9 seconds since the epoch; 19000000..21001231
    a ``YYYYMMDD`` integer; any other positive value nanoseconds; zero or
    negative NULL, and NULL past 9999-12-31.  Calendar arithmetic only, no
    time zone involved."""
    v = F.floor(c).cast("bigint")
    d = (F.when(v.isNull() | (v <= 0), F.lit(None).cast("date"))
            .when(v > 10 ** 15, F.date_from_unix_date(_days(v, 86_400 * 10 ** 9)))
            .when(v > 10 ** 12, F.date_from_unix_date(_days(v, 86_400_000)))
            .when(v > 10 ** 9, F.date_from_unix_date(_days(v, 86_400)))
            .when((v >= 19_000_000) & (v <= 21_001_231),
                  F.try_to_date(v.cast("string"), "yyyyMMdd"))
            .otherwise(F.date_from_unix_date(_days(v, 86_400 * 10 ** 9))))
    # a calendar date past 9999-12-31 fits no warehouse DATE column
    return F.when(d <= F.lit(LAST_DATE), d)


# C10 --------------------------------------------------------------------------------------
def date_from_text(c: Column, formats=TEXT_DATE_FORMATS, day_first: bool = False) -> Column:
    """First layout that parses the whole text wins; else NULL.  The date is
    the one written, whatever the offset.  ``day_first`` reads ``01/02/2023``
    as 1 February."""
    tries = (*formats, DAY_FIRST if day_first else MONTH_FIRST)
    plain = F.regexp_replace(c, r"(Z|[+-]\d{2}:?\d{2})$", "")
    has_time = c.rlike(r"\d:\d\d")
    text = F.when(has_time, plain).otherwise(c)
    return F.coalesce(*[F.to_date(F.try_to_timestamp(text, F.lit(f))) for f in tries])


def to_date_column(df: DataFrame, name: str, formats=TEXT_DATE_FORMATS, day_first: bool = False) -> Column:
    dt = df.schema[name].dataType
    c = F.col(name)
    if isinstance(dt, T.DateType):
        return c
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType)):
        return F.to_date(c)
    if isinstance(dt, NUMERIC_TYPES):
        return date_from_number(c)
    return date_from_text(null_token_expr(c), formats, day_first)


def clean_dates(df: DataFrame, columns, formats=TEXT_DATE_FORMATS, day_first: bool = False) -> DataFrame:
    cols = set(columns)
    return df.select(*[to_date_column(df, c, formats, day_first).alias(c) if c in cols else F.col(c)
                       for c in df.columns])


def format_dates(df: DataFrame, columns, fmt: str = "yyyy-MM-dd") -> DataFrame:
    """Dates as text, for an export that needs ``YYYY-MM-DD`` strings (C11);
    inside the warehouse dates stay ``DateType``."""
    cols = set(columns)
    return df.select(*[F.date_format(F.col(c), fmt).alias(c) if c in cols else F.col(c)
                       for c in df.columns])


# C12 --------------------------------------------------------------------------------------
def cleansing_report(df: DataFrame, date_columns=()) -> DataFrame:
    """One aggregation pass: per column the NULL count, the non-NULL count
    and, for date columns, the valid dates; returned one row per column."""
    aggs = [F.count(F.lit(1)).alias("__rows")]
    for i, c in enumerate(df.columns):
        aggs.append(F.count_if(F.col(c).isNull()).alias(f"__n{i}"))
    wide = df.agg(*aggs)
    dset = set(date_columns)
    rows = [F.struct(F.lit(c).alias("column_name"), F.col(f"__n{i}").alias("null_count"),
                     (F.col("__rows") - F.col(f"__n{i}")).alias("non_null_count"),
                     F.lit(c in dset).alias("is_date"))
            for i, c in enumerate(df.columns)]
    return wide.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


# the whole step ----------------------------------------------------------------------------
@dataclass
class CleanseSpec:
    dedupe: bool = True
    date_columns: tuple = ()
    detect_dates_by_name: bool = False
    date_exclude: tuple = ()
    numeric_types: dict = field(default_factory=dict)
    trim_tokens: bool = False


def cleanse(df: DataFrame, spec: CleanseSpec | None = None) -> DataFrame:
    """C1 -> C2 -> C3 -> C4 -> C5 -> C6 -> C8/C9/C10 as one lazy plan."""
    spec = spec or CleanseSpec()
    if spec.dedupe:
        df = dedupe_rows(df)
    df = drop_duplicate_columns(normalize_column_names(df))
    df = clean_null_tokens(df, trim=spec.trim_tokens)
    df = clean_nonfinite(df)
    if spec.numeric_types:
        df = coerce_numeric(df, spec.numeric_types)
    dcols = detect_date_columns(df.columns, spec.date_columns, spec.detect_dates_by_name,
                                spec.date_exclude)
    return clean_dates(df, dcols) if dcols else df

