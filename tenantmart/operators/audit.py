"""Constraint audits and conformance to the declared schema.

Each audit is one aggregation per table (partial aggregation before the
shuffle); foreign keys are checked by joining the distinct non-NULL child keys
to the distinct parent keys, so a hot child key is collapsed before it meets the
parent.  Results come back as small report DataFrames, never collected.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import TABLES, Table


class SchemaMismatch(ValueError):
    pass


def key_audit(df: DataFrame, table: str, kind: str, keys) -> DataFrame:
    """Rows, distinct keys, keys seen more than once, rows with a NULL key part."""
    keys = list(keys)
    any_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"),
                                    F.max(any_null.cast("int")).alias("has_null"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("row_count"),
        F.count(F.lit(1)).alias("distinct_keys"),
        F.count_if(F.col("n") > 1).alias("duplicate_keys"),
        F.coalesce(F.sum(F.when(F.col("has_null") == 1, F.col("n"))), F.lit(0))
        .cast("bigint").alias("null_key_rows"),
    ).select(F.lit(table).alias("table_name"), F.lit(kind).alias("constraint_kind"),
             F.lit(",".join(keys)).alias("key_columns"), "row_count", "distinct_keys",
             "duplicate_keys", "null_key_rows")


def length_audit(df: DataFrame, table: Table) -> DataFrame | None:
    """Longest text per ``varchar(n)`` column and the count of longer values."""
    cols = [c for c in table.columns if c.length is not None and c.name in df.columns]
    if not cols:
        return None
    aggs = []
    for i, c in enumerate(cols):
        ln = F.length(F.col(c.name).cast("string"))
        aggs += [F.max(ln).alias(f"m{i}"), F.count_if(ln > c.length).alias(f"o{i}")]
    wide = df.agg(*aggs)
    rows = [F.struct(F.lit(table.name).alias("table_name"), F.lit(c.name).alias("column_name"),
                     F.lit(c.length).alias("declared_length"),
                     F.col(f"m{i}").alias("max_length"), F.col(f"o{i}").alias("over_limit"))
            for i, c in enumerate(cols)]
    return wide.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def conform(df: DataFrame, table: Table, strict: bool = True) -> DataFrame:
    """Select the declared columns by name, in declared order, each
    ``try_cast`` to its declared type.  ``strict`` raises on a missing or an
    extra column; otherwise missing ones are typed NULLs, extras dropped."""
    missing = [c for c in table.names if c not in df.columns]
    extra = [c for c in df.columns if c not in table.names]
    if strict and (missing or extra):
        raise SchemaMismatch(f"{table.name}: missing {missing}, extra {extra}")
    out = []
    for c in table.columns:
        if c.name in df.columns:
            out.append(F.col(c.name).try_cast(c.spark_type).alias(c.name))
        else:
            out.append(F.lit(None).cast(c.spark_type).alias(c.name))
    return df.select(*out)


def conform_losses(df: DataFrame, table: Table) -> DataFrame:
    """Per declared column present in ``df``: values that were non-NULL and
    became NULL under the declared type (one aggregation pass)."""
    cols = [c for c in table.columns if c.name in df.columns]
    aggs = [F.count_if(F.col(c.name).isNotNull() & F.col(c.name).try_cast(c.spark_type).isNull())
            .alias(f"l{i}") for i, c in enumerate(cols)]
    wide = df.agg(*aggs)
    rows = [F.struct(F.lit(table.name).alias("table_name"), F.lit(c.name).alias("column_name"),
                     F.lit(c.type).alias("declared_type"), F.col(f"l{i}").alias("lost_values"))
            for i, c in enumerate(cols)]
    return wide.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def union_all(frames) -> DataFrame:
    frames = [f for f in frames if f is not None]
    return reduce(lambda a, b: a.unionByName(b), frames)


def audit_primary_keys(tables: dict[str, DataFrame], constraints) -> DataFrame:
    return union_all(key_audit(tables[t], t, kind, keys) for t, kind, keys in constraints
                     if t in tables)


def _key_counts(df: DataFrame, column: str) -> DataFrame:
    """(k, n): the non-NULL keys of a column as text, with their rows.  Types
    whose values each have a text of their own are grouped as they are, and the
    text is made once for each key."""
    own_text = (T.IntegralType, T.StringType, T.BooleanType, T.DateType)
    key = F.col(column) if isinstance(df.schema[column].dataType, own_text) else F.col(column).cast("string")
    counts = df.select(key.alias("k")).where("k IS NOT NULL").groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    return counts.select(F.col("k").cast("string").alias("k"), "n")


def audit_foreign_keys(tables: dict[str, DataFrame], fks) -> DataFrame:
    """Per foreign key: non-NULL child rows and those without a parent row.

    Each child and each referenced column is read once, by itself, and counted
    by its own type (one row per key).  Only these keys are then put together,
    as text (so integer widths may differ), and a left join marks those that found
    a parent.
    """
    fks = [f for f in fks if f[0] in tables and f[2] in tables]
    if not fks:
        raise ValueError("no foreign key between the given tables")
    parent_no = {p: i for i, p in enumerate(dict.fromkeys((p, pc) for _, _, p, pc in fks))}
    keys = union_all(_key_counts(tables[c], cc).select(F.lit(i).alias("fk"), F.lit(parent_no[p, pc]).alias("parent"), "k", "n")
                     for i, (c, cc, p, pc) in enumerate(fks))
    parents = union_all(_key_counts(tables[p], pc).select(F.lit(i).alias("parent"), "k", F.lit(True).alias("found"))
                        for (p, pc), i in parent_no.items())
    orphan = F.col("found").isNull()
    marked = keys.join(parents, on=["parent", "k"], how="left").groupBy("fk").agg(
        F.sum("n").alias("checked"), F.sum(F.when(orphan, F.col("n"))).alias("orphans"),
        F.count_if(orphan).alias("keys"))
    spark = next(iter(tables.values())).sparkSession
    spec = spark.createDataFrame(
        [(i, *f) for i, f in enumerate(fks)],
        "fk int, child_table string, child_column string, parent_table string, parent_column string")
    return spec.join(marked, on="fk", how="left").select(
        "child_table", "child_column", "parent_table", "parent_column",
        *[F.coalesce(c, F.lit(0)).cast("bigint").alias(n) for n, c in (
            ("checked_rows", "checked"), ("orphan_rows", "orphans"), ("orphan_keys", "keys"))])


def audit_lengths(tables: dict[str, DataFrame]) -> DataFrame:
    return union_all(length_audit(df, TABLES[n]) for n, df in tables.items() if n in TABLES)
