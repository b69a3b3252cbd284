"""Tenant registry, tagging and the incremental central merge.

The registry holds one row per tenant schema -- metadata, bounded by the
number of tenants -- so the id assignment may use a single-partition
window.  Tenant *data* never goes through such a window: the merge is one
plan over the tenants not merged yet (by-name union), written to a folder of
its own and then added to the central table as partitions.

The central table is partitioned by (``source_tenant``, ``id_client``): the
tenant a row came from, and the id it carries.  Usually they agree, but a
source may bring ids of its own, even another tenant's.  The catalog's list of
``source_tenant`` partitions is the ledger of what is merged: a slice becomes
visible and recorded in one step, a run that dies before it has changed
nothing, and a refresh drops exactly what the same source brought before.
``merged_rows`` reads the table without the ledger column.

Tenants whose table is one folder of parquet files (what a whole load
publishes) are not branches of the plan: all folders of one schema are one
scan, and a row's tenant follows from the path of its file.  So the plan grows
with the number of different schemas, not of tenants, and the publish takes
one statement for every 500 partitions and a few besides.  One folder whose rows
all carry one id is one partition: its files are read and written as they are
split, without a shuffle.  The tables of a schema are tagged and merged some at
a time, so that the small jobs of one leave no executor idle.
"""

from __future__ import annotations

import re
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .load import LoadError, Warehouse, stage

REGISTRY_SCHEMA = ("id_client int, client_name string, database_name string, "
                   "schema_name string, status string, created_at timestamp")
# Schemas never registered as tenants.
SYSTEM_SCHEMAS = ("INFORMATION_SCHEMA", "ACCOUNT_USAGE")
TENANT_COLUMN = "id_client"
SOURCE_COLUMN = "source_tenant"
#: Tables that are tagged or merged at a time.
WORKERS = 4


def catalog_schemas(spark, pattern: str | None = None, exclude=SYSTEM_SCHEMAS) -> DataFrame:
    """Schemas (catalog databases) that exist, optionally matching a SQL LIKE
    pattern -- the list of tenant schemas to register or merge."""
    names = [(d.name,) for d in spark.catalog.listDatabases()]
    df = spark.createDataFrame(names, "schema_name string")
    df = df.where(~F.upper("schema_name").isin(*[e.upper() for e in exclude]))
    return df.where(F.col("schema_name").like(pattern)) if pattern else df


def registry_sync(registry: DataFrame, found_schemas: DataFrame, database_name: str,
                  exclude=SYSTEM_SCHEMAS) -> DataFrame:
    """Registry after registering every found schema not yet known for
    ``database_name``: new ids continue after the largest id, in schema-name
    order; status 'Active', created now.  Running it twice adds nothing."""
    reg = registry.select("id_client", "client_name", "database_name", "schema_name", "status",
                          "created_at")
    known = reg.where(F.col("database_name") == database_name).select("schema_name")
    new = (found_schemas.select("schema_name").where(~F.col("schema_name").isin(*exclude))
           .distinct().join(known, on="schema_name", how="left_anti"))
    new_rows = new.select(
        F.lit(None).cast("int").alias("id_client"), F.col("schema_name").alias("client_name"),
        F.lit(database_name).alias("database_name"), "schema_name",
        F.lit("Active").alias("status"), F.current_timestamp().alias("created_at"))
    both = (reg.withColumn("_new", F.lit(False))
            .unionByName(new_rows.withColumn("_new", F.lit(True))))
    everything = Window.partitionBy()                      # registry-sized
    in_group = Window.partitionBy("_new").orderBy("schema_name")
    top = F.coalesce(F.max(F.when(~F.col("_new"), F.col("id_client"))).over(everything), F.lit(0))
    new_id = (top + F.row_number().over(in_group)).cast("int")
    return both.withColumn("id_client", F.when(F.col("_new"), new_id)
                           .otherwise(F.col("id_client"))).drop("_new")


def registry_dedupe(registry: DataFrame) -> DataFrame:
    """One schema per tenant id: the smallest schema name wins (the others
    are reported by ``registry_conflicts``)."""
    cols = [c for c in registry.columns if c not in (TENANT_COLUMN, "schema_name")]
    best = registry.groupBy(TENANT_COLUMN).agg(
        F.min(F.struct("schema_name", *cols)).alias("r"))
    return best.select(TENANT_COLUMN, "r.*")


def registry_conflicts(registry: DataFrame) -> DataFrame:
    kept = registry_dedupe(registry).select(TENANT_COLUMN, "schema_name")
    return registry.join(kept, on=[TENANT_COLUMN, "schema_name"], how="left_anti")


def select_tenants(registry: DataFrame, found_schemas: DataFrame, pattern: str,
                   database_name: str | None = None) -> DataFrame:
    """Registered tenants (of ``database_name`` when given) whose schema
    exists and matches the SQL LIKE ``pattern`` (``_`` is a one-character
    wildcard, as in SQL)."""
    if database_name is not None:
        registry = registry.where(F.col("database_name") == database_name)
    existing = found_schemas.where(F.col("schema_name").like(pattern)).select("schema_name")
    return (registry_dedupe(registry).join(existing, on="schema_name", how="left_semi")
            .select("schema_name", TENANT_COLUMN))


def tag_tenant(df: DataFrame, id_client: int) -> DataFrame:
    """Set the tenant id on every row (column added when missing)."""
    return df.withColumn(TENANT_COLUMN, F.lit(id_client).cast("int"))


def tag_tenant_default(df: DataFrame, id_client: int) -> DataFrame:
    """Add the tenant id only where the column is missing; existing values stay."""
    if TENANT_COLUMN in [c.lower() for c in df.columns]:
        return df
    return tag_tenant(df, id_client)


def tenant_id_of(registry: DataFrame, database_name: str) -> int:
    """The registered id of a tenant database (one scalar); unknown -> KeyError."""
    row = (registry.where(F.col("database_name") == database_name)
           .agg(F.min(TENANT_COLUMN).alias("id")).first())
    if row is None or row["id"] is None:
        raise KeyError(f"no tenant id registered for database {database_name!r}")
    return int(row["id"])


def tenant_view(df: DataFrame, id_client: int) -> DataFrame:
    """A tenant's rows of a merged table (partition-pruned on ``id_client``)."""
    return df.where(F.col(TENANT_COLUMN) == F.lit(id_client))


@dataclass
class MergeReport:
    table: str
    merged: list
    skipped: list


def merged_tenants(central: Warehouse, table: str) -> list[int]:
    """Source tenants already merged into a central table (catalog metadata)."""
    return central.partition_values(table, SOURCE_COLUMN) if central.exists(table) else []


def merged_rows(central: Warehouse, table: str) -> DataFrame:
    """The central table as its users see it."""
    return central.read(table).drop(SOURCE_COLUMN)


def merge_tenants(central: Warehouse, table: str, slices: dict[int, DataFrame],
                  refresh: bool = False) -> MergeReport:
    """Append every tenant's ``table`` into the central ``table``.

    Tenants merged before are skipped and their plans left out altogether
    (or, with ``refresh``, what they brought before is replaced).  Sources are
    unioned by name; a column one tenant lacks is NULL for it; a source that
    already carries ``id_client`` keeps its values.  A column new to the
    central table is added to it first.  The write is rebalanced, so a tenant
    holding a third of the rows is spread over tasks and files.
    """
    return _merge(central, table, {t: (df, None) for t, df in slices.items()}, refresh)


@dataclass(frozen=True)
class Folder:
    """A tenant's table: all parquet files of one folder."""
    path: str
    schema: StructType

    @property
    def key(self) -> str:
        return _folder_key(self.path)


#: Paths that a file's URI spells as they are; others are read as branches of their own.
PLAIN_PATH = re.compile(r"[\w./:=@-]+")


def _folder_key(path: str) -> str:
    return re.sub(r"^(\w+):/+", r"\1:/", path if re.match(r"\w+:/", path) else f"file:{path}").rstrip("/")


def merge_folders(central: Warehouse, table: str, folders: dict[int, Folder], refresh: bool = False) -> MergeReport:
    """``merge_tenants`` for tenants whose table is a folder each: one scan for
    all folders of a schema."""
    return _merge(central, table, {t: (None, f) for t, f in folders.items()}, refresh)


def _tagged(df: DataFrame, tenant) -> DataFrame:
    """Ledger column, and the tenant id where the source brings none."""
    df = df.withColumn(SOURCE_COLUMN, tenant.cast("int"))
    if TENANT_COLUMN in [c.lower() for c in df.columns]:
        return df
    return df.withColumn(TENANT_COLUMN, F.col(SOURCE_COLUMN))


def _scan(spark, folders: dict[int, Folder], schema: StructType) -> list[DataFrame]:
    """All tenants' files of one schema by one scan; a table that was declared
    and never filled may have no folder yet, and then each is looked at alone."""
    places = {t: f for t, f in folders.items() if PLAIN_PATH.fullmatch(f.path)}
    if len({f.key for f in places.values()}) < len(places) or len(places) == 1:
        places = {}          # two tenants share a folder: the path does not tell whose rows; or there is no choice
    try:
        frames = []
        if places:
            named = spark.createDataFrame([(f.key, t) for t, f in places.items()], "_folder string, _tenant int")
            # no regular expressions: this is done for every row
            path = F.replace(F.replace(F.col("_metadata.file_path"), F.lit(":///"), F.lit(":/")), F.lit("://"), F.lit(":/"))
            rows = spark.read.schema(schema).parquet(*[f.path for f in places.values()])
            # left: a path that were spelt otherwise raises below instead of losing its rows
            rows = rows.withColumn("_folder", F.left(path, F.length(path) - F.length(F.substring_index(path, "/", -1)) - 1)).join(named, "_folder", "left")
            owner = F.coalesce("_tenant", F.raise_error(F.concat(F.lit("no tenant for "), "_folder")).cast("int"))
            frames.append(_tagged(rows, owner).drop("_folder", "_tenant"))
        return frames + [_tagged(spark.read.schema(schema).parquet(f.path), F.lit(t)) for t, f in folders.items() if t not in places]
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        if len(folders) == 1:
            return [_tagged(spark.createDataFrame([], schema), F.lit(t)) for t in folders]
        return [d for t, f in folders.items() for d in _scan(spark, {t: f}, schema)]


def _one_partition(spark, folder: Folder) -> bool:
    """Whether all rows of a tenant's table carry one id, or none of their own.
    Only that column is read."""
    own = [c for c in folder.schema.names if c.lower() == TENANT_COLUMN]
    if not own:
        return True
    try:
        return len(spark.read.schema(folder.schema).parquet(folder.path).select(*own).distinct().take(2)) < 2
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return True


def _merge(central: Warehouse, table: str, sources: dict[int, tuple[DataFrame | None, Folder | None]], refresh: bool) -> MergeReport:
    done = set(merged_tenants(central, table))
    merged = [t for t in sources if refresh or t not in done]
    skipped = [t for t in sources if t not in merged]
    if not merged:
        return MergeReport(table, merged, skipped)
    parts = (SOURCE_COLUMN, TENANT_COLUMN)
    groups: dict[str, dict[int, Folder]] = {}
    tagged = []
    for t in merged:
        df, folder = sources[t]
        if folder is None:
            tagged.append(_tagged(df, F.lit(t)))
        else:
            groups.setdefault(folder.schema.simpleString(), {})[t] = folder
    folders: dict[int, Folder] = {}
    for folders in groups.values():
        tagged += _scan(central.spark, folders, next(iter(folders.values())).schema)
    union = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)
    if not central.exists(table):
        cols = [c for c in union.columns if c not in parts] + list(parts)
        central.create_like(table, union.select(*cols), parts)
    known = {c.lower() for c in central.columns(table)}
    for f in union.schema.fields:
        if f.name.lower() not in known:
            central.add_column_if_missing(table, f.name, f.dataType.simpleString())
    target = central.read(table)
    if len(merged) > 1 or not folders or not _one_partition(central.spark, folders[merged[0]]):
        union = union.hint("rebalance", *parts)
    staged = stage(union, central, table, target.schema, parts, missing="null")
    if staged.losses:
        raise LoadError(f"{central.name(table)}: values do not fit the central columns: {staged.losses}")
    replaced = set(merged)
    brought = [f for f in central.partitions(table) if _source_of(f) in replaced] if refresh else []
    central.swap_partitions(table, staged.path, drop=brought)
    return MergeReport(table, merged, skipped)


def _source_of(folder: str) -> int | None:
    for part in folder.split("/"):
        k, _, v = part.partition("=")
        if k == SOURCE_COLUMN:
            return int(v)
    return None


# -- whole-schema steps -------------------------------------------------------------------------
def tag_tables(wh: Warehouse, id_client: int, tables, only_if_missing: bool = False) -> dict:
    """Tag every listed table of a tenant schema with its id (a staged
    rewrite per table).  ``only_if_missing`` keeps tables that already carry
    the column (the constant-default variant).  Missing tables are reported,
    not fatal.  Returns ``{table: 'tagged' | 'kept' | 'missing'}``."""
    def tag(t):
        if not wh.exists(t):
            return "missing"
        df = wh.read(t)
        has = TENANT_COLUMN in [c.lower() for c in df.columns]
        if has and only_if_missing:
            return "kept"
        wh.publish(tag_tenant(df, id_client), t)
        return "tagged"
    names = list(dict.fromkeys(tables))
    return dict(zip(names, _each_table(wh.spark, tag, names)))


def _each_table(spark, work, names) -> list:
    """``work(name)`` of each table, some at a time, in order.  After an error
    no further table is begun.  The jobs keep the caller's job group and
    scheduler pool."""
    with ThreadPoolExecutor(WORKERS, thread_name_prefix="tenantmart") as pool:
        found = [pool.submit(inheritable_thread_target(spark)(work), n) for n in names]
        try:
            return [f.result() for f in found]
        finally:
            for f in found:
                f.cancel()


def tag_tables_from_registry(wh: Warehouse, registry: DataFrame, database_name: str, tables,
                             only_if_missing: bool = True) -> dict:
    """Look the tenant id up in the registry (unknown tenant -> KeyError),
    then tag its tables."""
    return tag_tables(wh, tenant_id_of(registry, database_name), tables, only_if_missing)


def merge_schemas(central: Warehouse, tenants: dict, tables, refresh: bool = False) -> list[tuple]:
    """Central merge of several tables: for each table, the tenants that have
    it are merged (``merge_tenants``); a tenant lacking the table is a
    reported skip, never an abort.  ``tenants``: id -> tenant ``Warehouse``.
    Returns ``(table, tenant, status)`` rows."""
    def merge(t):
        report, sources = [], {}
        done = set() if refresh else set(merged_tenants(central, t))
        for tid, wh in tenants.items():
            if not wh.exists(t):
                report.append((t, tid, "missing"))
                continue
            path = None if tid in done else wh.plain_folder(t)
            rows = None if tid in done else wh.read(t)
            sources[tid] = (None, Folder(path, rows.schema)) if path else (rows, None)
        res = _merge(central, t, sources, refresh)
        report += [(t, tid, "refreshed" if refresh else "merged") for tid in res.merged]
        report += [(t, tid, "skipped") for tid in res.skipped]
        return report
    names = list(tables)
    if len(set(names)) < len(names):
        return [row for t in names for row in merge(t)]      # a table named again is skipped the second time
    return [row for rows in _each_table(central.spark, merge, names) for row in rows]
