"""Load modes into a warehouse of catalog tables on shared storage.

Every load evaluates its source once, into files of a fresh version folder;
row counts, cast losses and over-long texts are observed during that write,
and key checks read the written files.  Only when everything is written and
checked is the catalog pointed at the new version.  The public name is a view
over a version table, and a whole load makes its version table beside the old one
and then replaces the view: one catalog statement.  A job that dies anywhere
leaves a complete table, the old one or the new one, partitions and declared
text lengths included.  A load of some partitions makes a version table whose
other partitions stay where they are, and switches the view as well.  A lost
executor only rewrites files of the new version.

A table without partitions that takes keyed loads is laid out by a hash of its
key: ``n`` folders that the public view hides.  A delta then reads, joins and
writes the buckets of its own keys alone.  The first keyed load that leaves rows in
place writes the layout, for as many rows as there are then; a whole load (replace, truncate + insert)
drops it, and the next keyed load lays out anew.

Modes: full replace (new schema), truncate + insert (target schema kept,
columns aligned by name), keyed upsert (full outer join on the keys:
matched rows take every source column, NULLs included, and keep
target-only columns; NULL keys never match) and, for tables whose key is not
unique at their grain, replacement of all rows of the source's keys.  A
partitioned table stays partitioned in every mode.  An empty source is skipped
(target kept) or published as an empty table, by choice.
"""

from __future__ import annotations

import json
import re
import uuid
from dataclasses import dataclass, field
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..schema import Table
from ..session import ensure_checkpoint_dir, shuffles_dropped

#: View property that names the version table.
VERSION = "tenantmart.version"
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"
#: Table property and hidden partition column of a layout by key hash.
LAYOUT = "tenantmart.layout"
BUCKET = "_key_bucket"
#: Rows of a bucket when a layout is made, and the most buckets (beyond, buckets grow).
ROWS_PER_BUCKET = 1_000_000
MAX_BUCKETS = 4_096
#: Touched partition values that are listed in a scan's filter; beyond, the scan is joined with them.
MAX_LISTED = 4_096
#: Source rows beyond which a load by key first finds the target's keys that stay.
MANY_ROWS = 1_000_000


class LoadError(RuntimeError):
    pass


@dataclass
class LoadResult:
    table: str
    mode: str
    status: str          # loaded | skipped_empty
    rows: int | None = None
    losses: dict = field(default_factory=dict)   # column -> values lost to a cast or over-long


@dataclass(frozen=True)
class Layout:
    """Rows lie in ``n`` folders by a hash of ``keys``."""
    keys: tuple
    n: int

    def bucket(self):
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.n)).cast("int")

    def property(self) -> str:
        text = json.dumps({"keys": list(self.keys), "n": self.n})
        return text.replace("\\", "\\\\").replace("'", "\\'")


def layout_for(keys, rows: int, rows_per_bucket: int | None = None) -> Layout | None:
    """A power of two of buckets for a table of ``rows`` rows; None if one would do."""
    wanted = min(-(-rows // (rows_per_bucket or ROWS_PER_BUCKET)), MAX_BUCKETS)
    return Layout(tuple(keys), 1 << (wanted - 1).bit_length()) if wanted > 1 else None


def _q(name: str) -> str:
    return ".".join(f"`{p}`" for p in name.split("."))


def _partition_values(folder: str) -> dict[str, str | None]:
    out = {}
    for part in folder.split("/"):
        k, _, v = part.partition("=")
        out[unquote(k)] = None if v == NULL_PARTITION else unquote(v)
    return out


def _partition_spec(folder: str) -> str:
    def literal(v):
        return "null" if v is None else "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return "PARTITION (" + ", ".join(f"`{k}`={literal(v)}" for k, v in _partition_values(folder).items()) + ")"


def _ddl(schema, lengths=None) -> str:
    kinds = {c: f"varchar({n})" for c, n in (lengths or {}).items()}
    return ", ".join(f"`{f.name}` {kinds.get(f.name, f.dataType.simpleString())}" for f in schema.fields)


def _folders(df: DataFrame, levels: int) -> dict[str, str]:
    """Partition folder -> place of the files that a frame reads; no job runs."""
    out = {}
    for file in df.inputFiles():
        where = unquote(file).rpartition("/")[0]
        out["/".join(where.split("/")[-levels:])] = where
    return out


def bucketed(df: DataFrame, layout: Layout) -> DataFrame:
    """``df`` with its bucket, one task for a bucket of usual size and several for a large one."""
    return df.withColumn(BUCKET, layout.bucket()).hint("rebalance", BUCKET)


class Warehouse:
    """One tenant schema (a catalog database) whose tables live under
    ``root`` on storage every executor sees."""

    def __init__(self, spark: SparkSession, database: str, root: str | None = None):
        self.spark = spark
        self.database = database
        base = root or (ensure_checkpoint_dir(spark).rstrip("/") + "/tenantmart/warehouse")
        self.root = f"{base.rstrip('/')}/{database}"
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {_q(database)} LOCATION '{self.root}'")

    # -- catalog -----------------------------------------------------------------------------
    def name(self, table: str) -> str:
        return f"{self.database}.{table}"

    def exists(self, table: str) -> bool:
        return self.spark.catalog.tableExists(f"{self.database}.{table}")

    def read(self, table: str) -> DataFrame:
        return self.spark.table(self.name(table))

    def columns(self, table: str) -> list[str]:
        return self.read(table).columns

    def _version_path(self, table: str) -> str:
        # apart from the folder that a managed table of this name would own (and take along when it is renamed or dropped)
        return f"{self.root}/_versions/{table}/v{uuid.uuid4().hex}"

    # -- publication -------------------------------------------------------------------------
    def write_version(self, df: DataFrame, table: str, partition_by=()) -> str:
        """Write ``df`` to a new version folder, which no table points at yet.  The
        shuffle files of a written version go at once: what a batch needs of disk is
        that of the writes that run at the same time."""
        path = self._version_path(table)
        w = df.write.mode("errorifexists").format("parquet").option("compression", "zstd")
        if partition_by:
            w = w.partitionBy(*partition_by)
        with shuffles_dropped(df.sparkSession):
            w.save(path)
        return path

    def publish(self, df: DataFrame, table: str, replace_schema: bool = False,
                partition_by=None, layout: Layout | None = None) -> str:
        """Write ``df`` to a new version folder, then point the table at it.

        Without ``partition_by`` an existing table keeps its partition columns,
        and without ``layout`` its layout by key hash.
        """
        if partition_by is None:
            partition_by = [c for c in self.partition_columns(table) if c in df.columns] \
                if self.exists(table) else []
        if layout is None and not partition_by:
            layout = self.layout(table)
            layout = layout if layout and set(layout.keys) <= set(df.columns) else None
        if layout:
            df, partition_by = bucketed(df, layout), [BUCKET]
        path = self.write_version(df, table, partition_by)
        self.point_at(table, path, df.schema, list(partition_by), replace_schema, layout)
        return path

    def point_at(self, table: str, path: str, schema, partition_by=(), replace_schema: bool = False,
                 layout: Layout | None = None):
        """Make a completely written version folder the content of ``table``."""
        lengths = {} if replace_schema or not self.exists(table) else self.text_lengths(table)
        self._switch(table, self._new_version(table, path, _ddl(schema, lengths), partition_by, layout=layout))

    def _new_version(self, table: str, path: str, columns: str, partition_by=(), repair: bool = True,
                     layout: Layout | None = None) -> str:
        """A version table over a folder, under a name of its own."""
        version = self.name(f"{table}__v{uuid.uuid4().hex}")
        part = f" PARTITIONED BY ({', '.join(f'`{c}`' for c in partition_by)})" if partition_by else ""
        props = f" TBLPROPERTIES ('{LAYOUT}' = '{layout.property()}')" if layout else ""
        self.spark.sql(f"CREATE TABLE {_q(version)} ({columns}) USING parquet{part} LOCATION '{path}'{props}")
        if partition_by and repair:
            self.spark.sql(f"MSCK REPAIR TABLE {_q(version)}")
        return version

    def _switch(self, table: str, version: str) -> None:
        """Let the public name show a version table."""
        name, before = self.name(table), self.version_table(table)
        shown = f"* EXCEPT (`{BUCKET}`)" if BUCKET in self.spark.table(version).columns else "*"
        view = f"CREATE OR REPLACE VIEW {_q(name)} TBLPROPERTIES ('{VERSION}' = '{version}') AS SELECT {shown} FROM {_q(version)}"
        if before != name:
            self.spark.sql(view)
        else:
            # a plain table, made elsewhere, is taken over once: it keeps its rows under another name
            aside = self.name(f"{table}__v{uuid.uuid4().hex}")
            self.spark.sql(f"ALTER TABLE {_q(name)} RENAME TO {_q(aside)}")
            try:
                self.spark.sql(view)
            except Exception:
                self.spark.sql(f"ALTER TABLE {_q(aside)} RENAME TO {_q(name)}")
                raise
            before = aside
        if before and before != version:
            self.spark.sql(f"DROP TABLE IF EXISTS {_q(before)}")      # external: files stay for readers of the old version

    def version_table(self, table: str) -> str | None:
        """The catalog table behind a public name; a table made elsewhere is its own."""
        if not self.exists(table):
            return None
        return self._properties(self.name(table)).get(VERSION, self.name(table))

    def _properties(self, name: str) -> dict[str, str]:
        return {r["key"]: r["value"] for r in self.spark.sql(f"SHOW TBLPROPERTIES {_q(name)}").collect()}

    def layout(self, table: str) -> Layout | None:
        """The layout by key hash of a table, if it has one."""
        version = self.version_table(table)
        text = self._properties(version).get(LAYOUT) if version else None
        if text is None:
            return None
        told = json.loads(text)
        return Layout(tuple(told["keys"]), told["n"])

    def plain_folder(self, table: str) -> str | None:
        """The one folder whose parquet files are all of a table's rows; None
        if it has partitions, a layout, another format or no folder."""
        rows = [(r["col_name"], r["data_type"]) for r in
                self.spark.sql(f"DESCRIBE TABLE EXTENDED {_q(self.version_table(table))}").collect()]
        names = [n for n, _ in rows]
        told = dict(rows[names.index("# Detailed Table Information"):])
        if "# Partition Information" in names or told.get("Provider", "").lower() != "parquet":
            return None
        return told.get("Location")

    def read_version(self, table: str) -> DataFrame:
        """The rows with the hidden bucket column, if there is a layout."""
        return self.spark.table(self.version_table(table))

    # -- partitions (catalog metadata; no data file is opened) ---------------------------------
    def partitions(self, table: str) -> list[str]:
        """Partition folders of a table as ``a=1/b=x``."""
        return [r[0] for r in self.spark.sql(f"SHOW PARTITIONS {_q(self.version_table(table))}").collect()]

    def swap_partitions(self, table: str, path: str | None, drop=(), columns: str | None = None) -> None:
        """Replace the partitions found under ``path`` and remove those of
        ``drop``; all others stay where they are.  ``columns`` declares the
        columns anew.

        The new version table names a folder for each partition, some hundred in
        a statement, and the view switches to it in one: a reader sees all of the
        old partitions or all of the new ones.
        """
        if self.version_table(table) == self.name(table):
            self.publish(self.read(table), table)          # made elsewhere: taken over once, whole
        before, layout = self.read_version(table), self.layout(table)
        parts = [BUCKET] if layout else self.partition_columns(table)
        gone = set(drop)
        at = {f: where for f, where in _folders(before, len(parts)).items() if f not in gone}
        if path is not None:
            at |= _folders(self.spark.read.schema(before.schema).parquet(path), len(parts))
        version = self._new_version(table, path or self._version_path(table), columns or _ddl(before.schema, self.text_lengths(table)),
                                    parts, False, layout)
        named = [f"{_partition_spec(f)} LOCATION '{where}'" for f, where in sorted(at.items())]
        for i in range(0, len(named), 500):
            self.spark.sql(f"ALTER TABLE {_q(version)} ADD " + " ".join(named[i:i + 500]))
        self._switch(table, version)

    def create_empty(self, table: Table, replace: bool = False) -> str:
        """Declared table with no rows (``varchar(n)`` kept in the catalog DDL)."""
        path = self._version_path(table.name)
        if not replace and self.exists(table.name):
            raise LoadError(f"table {self.name(table.name)} exists")
        self._switch(table.name, self._new_version(table.name, path, table.ddl_columns()))
        return path

    def create_like(self, table: str, like: DataFrame, partition_by=()) -> None:
        """Create ``table`` empty with the schema of ``like`` if it is absent."""
        if not self.exists(table):
            self._switch(table, self._new_version(table, self._version_path(table), _ddl(like.schema), partition_by, repair=False))

    def column_types(self, table: str) -> dict[str, str]:
        """Declared types by column, ``varchar(n)`` included, without a layout's hidden column."""
        rows = self.spark.sql(f"DESCRIBE TABLE {_q(self.version_table(table))}").collect()
        shown = set(self.columns(table))
        return {r["col_name"]: r["data_type"] for r in rows if r["col_name"] in shown}

    def text_lengths(self, table: str) -> dict[str, int]:
        """Declared ``varchar(n)`` lengths of a table's columns."""
        found = {c: re.fullmatch(r"varchar\((\d+)\)", t) for c, t in self.column_types(table).items()}
        return {c: int(m[1]) for c, m in found.items() if m}

    def partition_columns(self, table: str) -> list[str]:
        """Partition columns that users see (not the hidden one of a layout)."""
        return [c.name for c in self.spark.catalog.listColumns(self.version_table(table)) if c.isPartition and c.name != BUCKET]

    def partition_values(self, table: str, column: str) -> list[int]:
        """Integer values of a partition column, from the catalog."""
        values = (_partition_values(f).get(column) for f in self.partitions(table))
        return sorted({int(v) for v in values if v is not None})

    def add_column_if_missing(self, table: str, column: str, dtype: str) -> bool:
        if column.lower() in [c.lower() for c in self.columns(table)]:
            return False
        version = self.version_table(table)
        self.spark.sql(f"ALTER TABLE {_q(version)} ADD COLUMNS (`{column}` {dtype})")
        if version != self.name(table):
            self._switch(table, version)          # the view shows the column, too
        return True


# -- aligning a source to a target ------------------------------------------------------------
def align_by_name(df: DataFrame, target_schema, allow_missing: bool = False,
                  allow_extra: bool = False) -> DataFrame:
    """Select the target's columns by name (case-insensitive), cast to the
    target types; missing or extra source columns are an error unless
    allowed (missing ones then become typed NULLs).  A value that does not
    fit its type becomes NULL; ``loss_counts`` tells how many."""
    src = {c.lower(): c for c in df.columns}
    tgt = [f.name.lower() for f in target_schema.fields]
    missing = [f.name for f in target_schema.fields if f.name.lower() not in src]
    extra = [c for c in df.columns if c.lower() not in tgt]
    if (missing and not allow_missing) or (extra and not allow_extra):
        raise LoadError(f"column mismatch: missing {missing}, extra {extra}")
    return df.select(*[
        (F.col(src[f.name.lower()]).try_cast(f.dataType) if f.name.lower() in src
         else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in target_schema.fields])


def loss_counts(df: DataFrame, target_schema, lengths: dict[str, int]) -> dict:
    """Aggregates by name of a target column: source values that its type
    turns into NULL, plus texts over its declared length."""
    src = {c.lower(): c for c in df.columns}
    out = {}
    for f in target_schema.fields:
        if f.name.lower() not in src:
            continue
        c = F.col(src[f.name.lower()])
        lost = c.isNotNull() & c.try_cast(f.dataType).isNull()
        if f.name in lengths:
            lost = lost | (F.length(c.try_cast("string")) > lengths[f.name])
        out[f.name] = F.count_if(lost)
    return out


@dataclass
class Staged:
    """A source after its one evaluation: the files, and what was observed."""
    path: str
    rows: int
    losses: dict
    schema: object

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(self.schema).parquet(self.path)


def stage(df: DataFrame, wh: Warehouse, table: str, target_schema=None, partition_by=(),
          missing: str = "error") -> Staged:
    """Write the source, aligned to ``target_schema`` if given, and count in
    passing.  Target columns that the source lacks are an ``error``, left out
    (``drop``) or ``null``."""
    seen = Observation()
    counts = {} if target_schema is None else loss_counts(df, target_schema, wh.text_lengths(table))
    watched = df.observe(seen, F.count(F.lit(1)).alias("rows"), *[c.alias(f"lost {n}") for n, c in counts.items()])
    if target_schema is not None:
        watched = align_by_name(watched, target_schema, missing != "error")
        if missing == "drop":
            own = {c.lower() for c in df.columns}
            watched = watched.select(*[c for c in watched.columns if c.lower() in own])
    path = wh.write_version(watched, table, partition_by)
    got = seen.get
    losses = {n: got[f"lost {n}"] for n in counts if got.get(f"lost {n}")}
    return Staged(path, int(got.get("rows") or 0), losses, watched.schema)


def _check(staged: Staged, wh: Warehouse, table: str, mode: str, on_empty: str, on_loss: str):
    """Result of a load that stops here, if it does."""
    if staged.rows == 0 and on_empty == "keep":
        return LoadResult(table, mode, "skipped_empty", 0)
    if staged.losses and on_loss == "raise":
        raise LoadError(f"{wh.name(table)}: values do not fit the declared columns: {staged.losses}")
    return None


def _options(on_empty: str, on_loss: str = "raise") -> None:
    if on_empty not in ("keep", "truncate"):
        raise ValueError("on_empty must be 'keep' or 'truncate'")
    if on_loss not in ("raise", "report"):
        raise ValueError("on_loss must be 'raise' or 'report'")


# -- modes ------------------------------------------------------------------------------------
def load_full_replace(df: DataFrame, wh: Warehouse, table: str,
                      on_empty: str = "keep") -> LoadResult:
    """Replace rows and schema of ``table`` (created if absent)."""
    _options(on_empty)
    parts = [c for c in wh.partition_columns(table) if c in df.columns] if wh.exists(table) else []
    staged = stage(df, wh, table, partition_by=parts)
    stop = _check(staged, wh, table, "replace", on_empty, "raise")
    if stop:
        return stop
    wh.point_at(table, staged.path, df.schema, parts, replace_schema=True)
    return LoadResult(table, "replace", "loaded", staged.rows)


def _existing(wh: Warehouse, table: str) -> None:
    if not wh.exists(table):
        raise LoadError(f"table {wh.name(table)} does not exist; create it first")


def load_truncate_insert(df: DataFrame, wh: Warehouse, table: str, on_empty: str = "keep",
                         on_loss: str = "raise") -> LoadResult:
    """Replace the rows of an existing table, keeping its schema; columns are
    matched by name.  A missing target is an error, and so (unless
    ``on_loss='report'``) is a value that does not fit its column."""
    _options(on_empty, on_loss)
    _existing(wh, table)
    schema, parts = wh.read(table).schema, wh.partition_columns(table)
    staged = stage(df, wh, table, schema, parts)
    stop = _check(staged, wh, table, "truncate_insert", on_empty, on_loss)
    if stop:
        return stop
    wh.point_at(table, staged.path, schema, parts)
    return LoadResult(table, "truncate_insert", "loaded", staged.rows, staged.losses)


def duplicate_keys(df: DataFrame, keys) -> DataFrame:
    """Source keys (non-NULL) that occur more than once."""
    nonnull = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    return (df.where(nonnull).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") > 1))


def upsert_frame(target: DataFrame, source: DataFrame, keys) -> DataFrame:
    """The merged table: full outer join on the keys.  A source row that
    matches takes all its columns (NULLs included) and keeps the
    target-only columns; unmatched rows of either side are kept as they are.

    Rows with a NULL key part can never match, so they bypass the join and
    are appended directly: they would otherwise all hash to one shuffle
    partition of a full outer join, which AQE cannot split."""
    keys = list(keys)
    tcols, scols = target.columns, source.columns
    extra = [c for c in scols if c not in tcols]
    if extra:
        raise LoadError(f"source columns missing in target: {extra}")
    keyed = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    t = target.where(keyed).select(*[F.col(c).alias(f"t__{c}") for c in tcols],
                                   F.lit(True).alias("t__hit"))
    s = source.where(keyed).select(*[F.col(c).alias(f"s__{c}") for c in scols],
                                   F.lit(True).alias("s__hit"))
    cond = reduce(lambda a, b: a & b, [F.col(f"t__{k}") == F.col(f"s__{k}") for k in keys])
    j = t.join(s, cond, "full_outer")
    from_source = F.col("s__hit").isNotNull()
    out = []
    for f in target.schema.fields:
        c = f.name
        if c in scols:
            out.append(F.when(from_source, F.col(f"s__{c}").cast(f.dataType))
                       .otherwise(F.col(f"t__{c}")).alias(c))
        else:
            out.append(F.col(f"t__{c}").alias(c))
    unkeyed_source = source.where(~keyed).select(*[
        (F.col(f.name).cast(f.dataType) if f.name in scols
         else F.lit(None).cast(f.dataType)).alias(f.name) for f in target.schema.fields])
    return (j.select(*out)
            .unionByName(target.where(~keyed).select(*tcols))
            .unionByName(unkeyed_source))


def latest_per_key(df: DataFrame, keys, order_col: str) -> DataFrame:
    """One row per key: the one with the largest ``order_col`` (ties broken
    by the remaining columns, so the pick is deterministic).  A grouped
    ``max`` of a struct: partial aggregation map-side, so a key repeated a
    million times is collapsed before the shuffle.  NULL keys are kept as
    they are (they never match in an upsert)."""
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys and c != order_col]
    nonnull = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    best = (df.where(nonnull).groupBy(*keys)
            .agg(F.max(F.struct(order_col, *rest)).alias("_r"))
            .select(*keys, "_r.*"))
    return best.unionByName(df.where(~nonnull)).select(*df.columns)


def _same_key(left: DataFrame, right: DataFrame, keys):
    """Equal keys; NULL key parts equal each other.  ``right`` has them as ``s__<key>``."""
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[f"s__{k}"]) for k in keys])


def _keys_of(df: DataFrame, keys) -> DataFrame:
    return df.select(*[F.col(k).alias(f"s__{k}") for k in keys]).distinct()


def kept_keys(target: DataFrame, source: DataFrame, keys) -> DataFrame:
    """The target's keys that the source does not hold, as ``s__<key>``."""
    held = _keys_of(source, keys)
    there = target.select(*keys).distinct()
    return there.join(held, _same_key(there, held, keys), "left_anti").toDF(*held.columns)


def replace_keys_frame(target: DataFrame, source: DataFrame, keys, kept: DataFrame | None = None) -> DataFrame:
    """Target rows whose key the source does not hold, plus all source rows
    (missing columns NULL).  NULL key parts equal each other here, so loading
    a source twice is the same as loading it once.  ``kept`` may bring
    ``kept_keys``, already evaluated: if few keys stay, the planner broadcasts
    them, and the wide target rows are not shuffled."""
    if kept is None:
        held = _keys_of(source, keys)
        stays = target.join(held, _same_key(target, held, keys), "left_anti")
    else:
        stays = target.join(kept, _same_key(target, kept, keys), "left_semi")
    return stays.unionByName(align_by_name(source, target.schema, allow_missing=True))


def _touched(target: DataFrame, source: DataFrame, units) -> DataFrame:
    """Target rows in the partitions that the source's rows fall into."""
    wanted = source.select(*units).distinct()
    listed = wanted.limit(MAX_LISTED + 1).collect()
    if len(listed) > MAX_LISTED:
        named = wanted.select(*[F.col(u).alias(f"w__{u}") for u in units])
        return target.join(named, reduce(lambda a, b: a & b, [F.col(u).eqNullSafe(F.col(f"w__{u}")) for u in units]), "left_semi")
    # literal values, so the scan is pruned to these partitions
    if len(units) == 1 and all(r[0] is not None for r in listed):
        return target.where(F.col(units[0]).isin([r[0] for r in listed]))
    return target.where(reduce(lambda a, b: a | b, [
        reduce(lambda a, b: a & b, [F.col(u).eqNullSafe(F.lit(r[u])) for u in units]) for r in listed], F.lit(False)))


def _load_keyed(df, wh, table, keys, on_empty, on_loss, mode, prepare, merge, rows_per_bucket=None,
                merge_many=None, many_rows=MANY_ROWS) -> LoadResult:
    """Stage the source, let ``prepare`` check or reduce it, and publish what
    ``merge`` makes of target and source: the touched partitions (partition
    columns among the keys) or the touched buckets of the layout only, or the
    whole table, which then gets a layout if it has no partitions.  ``merge_many``
    takes the place of ``merge`` for a source of more than ``many_rows`` rows; it
    returns None if no target row stays, and a table without partitions and layout
    then is what was staged."""
    _options(on_empty, on_loss)
    if not keys:
        raise LoadError(f"no key declared for {table}")
    _existing(wh, table)
    target = wh.read(table)
    extra = [c for c in df.columns if c.lower() not in [t.lower() for t in target.columns]]
    if extra:
        raise LoadError(f"source columns missing in target: {extra}")
    staged = stage(df, wh, table, target.schema, missing="drop")
    stop = _check(staged, wh, table, mode, on_empty, on_loss)
    if stop:
        return stop
    source = prepare(staged.read(wh.spark))
    if merge_many is not None and staged.rows > many_rows:
        merge = merge_many
    parts, layout, columns = wh.partition_columns(table), wh.layout(table), target.columns

    def merged(there):
        rows = merge(there, source, keys)
        return (align_by_name(source, target.schema, allow_missing=True) if rows is None else rows).select(*columns)

    if parts and set(parts) <= set(keys):
        found = merged(_touched(target, source, parts))
        wh.swap_partitions(table, wh.write_version(found.hint("rebalance", *parts), table, parts))
    elif layout and set(layout.keys) <= set(keys):
        there = _touched(wh.read_version(table), source.withColumn(BUCKET, layout.bucket()), [BUCKET])
        wh.swap_partitions(table, wh.write_version(bucketed(merged(there.select(*columns)), layout), table, [BUCKET]))
    elif parts or layout:
        wh.publish(merged(target), table)
    else:
        rows = merge(target, source, keys)
        if rows is None:
            wh.point_at(table, staged.path, target.schema)      # the files hold the whole table; columns they lack are NULL
        else:
            wh.publish(rows.select(*columns), table, layout=layout_for(keys, target.count() + staged.rows, rows_per_bucket))
    return LoadResult(table, mode, "loaded", staged.rows, staged.losses)


def load_upsert(df: DataFrame, wh: Warehouse, table: str, keys, on_empty: str = "keep",
                dedupe_order: str | None = None, on_loss: str = "raise",
                rows_per_bucket: int | None = None) -> LoadResult:
    """Keyed upsert.  Source keys must be unique: a duplicate is an error,
    never a silent pick, unless ``dedupe_order`` names the column whose
    largest value wins.  A failure raises and leaves the target as it was --
    never an overwrite with the delta.  On a table partitioned by key
    columns only the touched partitions are read and written, on one laid out by
    key hash (``rows_per_bucket``) only the touched buckets."""
    def prepare(source):
        if dedupe_order is not None:
            return latest_per_key(source, keys, dedupe_order)
        if not duplicate_keys(source, keys).isEmpty():
            raise LoadError(f"source keys {list(keys)} are not unique for {table}")
        return source
    return _load_keyed(df, wh, table, keys, on_empty, on_loss, "upsert", prepare, upsert_frame, rows_per_bucket)


def load_replace_keys(df: DataFrame, wh: Warehouse, table: str, keys, on_empty: str = "keep",
                      on_loss: str = "raise", rows_per_bucket: int | None = None,
                      many_rows: int = MANY_ROWS) -> LoadResult:
    """Incremental load of a table whose declared key is not unique at its
    grain: all rows of the source's keys are replaced by the source's rows.  A
    source of more than ``many_rows`` rows usually brings most keys anew: the
    target's keys that stay are then found and written first.  If there are none,
    the target is not read again, and a table without layout is not written again."""
    def merge_many(target, source, keys):
        found = kept_keys(target, source, keys)
        kept = wh.spark.read.schema(found.schema).parquet(wh.write_version(found, table))
        return None if kept.isEmpty() else replace_keys_frame(target, source, keys, kept)
    return _load_keyed(df, wh, table, keys, on_empty, on_loss, "replace_keys", lambda s: s, replace_keys_frame, rows_per_bucket,
                       merge_many, many_rows)


def load(df: DataFrame, wh: Warehouse, table: str, mode: str = "full", keys=(),
         create_or_replace: bool = False, on_empty: str = "keep", unique: bool = True,
         dedupe_order: str | None = None, on_loss: str = "raise") -> LoadResult:
    """Dispatch like the original loader: ``full`` = replace when
    ``create_or_replace`` else truncate+insert; ``incremental`` = upsert, or
    replacement by key where the key is not ``unique`` and no ``dedupe_order``
    picks one row."""
    if mode == "full":
        if create_or_replace:
            return load_full_replace(df, wh, table, on_empty)
        return load_truncate_insert(df, wh, table, on_empty, on_loss)
    if mode == "incremental":
        if unique or dedupe_order is not None:
            return load_upsert(df, wh, table, keys, on_empty, dedupe_order, on_loss)
        return load_replace_keys(df, wh, table, keys, on_empty, on_loss)
    raise ValueError(f"unknown mode {mode!r}")


# -- bootstrap --------------------------------------------------------------------------------
_WHOLE = ("tinyint", "smallint", "int", "bigint")
#: Type changes besides those of whole numbers and decimals that keep every value.
_WIDER = {("tinyint", "float"), ("smallint", "float"), ("float", "double"), ("date", "timestamp"), ("date", "timestamp_ntz"),
          *((t, "double") for t in _WHOLE[:3])}


def _text(kind: str) -> bool:
    return kind == "string" or kind.startswith("varchar(")


def widens(old: str, new: str) -> bool:
    """Whether every value of type ``old`` has the same value in type ``new``."""
    if old == new or (old, new) in _WIDER:
        return True
    if old in _WHOLE and new in _WHOLE:
        return _WHOLE.index(old) < _WHOLE.index(new)
    a, b = (re.fullmatch(r"decimal\((\d+),(\d+)\)", t) for t in (old, new))
    if a and b:
        return int(a[2]) <= int(b[2]) and int(a[1]) - int(a[2]) <= int(b[1]) - int(b[2])
    return False


@dataclass(frozen=True)
class Diff:
    """What a declared table has that the existing one has not."""
    added: dict          # column -> type
    retyped: dict        # column -> (old, new): the rows are written anew
    relabelled: dict     # column -> (old, new): text lengths only
    unlike: dict         # column -> (old, new): no value-keeping change

    def __bool__(self):
        return bool(self.added or self.retyped or self.relabelled or self.unlike)

    def told(self) -> str:
        return ", ".join([f"+{c} {t}" for c, t in self.added.items()] +
                         [f"{c} {a} -> {b}" for d in (self.retyped, self.relabelled, self.unlike) for c, (a, b) in d.items()])


def schema_diff(wh: Warehouse, table: Table) -> Diff:
    """Declared against existing columns, by name in any case.  Columns that
    only the existing table has stay as they are."""
    have = {c.lower(): (c, t) for c, t in wh.column_types(table.name).items()}
    out = Diff({}, {}, {}, {})
    for col in table.columns:
        if col.name.lower() not in have:
            out.added[col.name] = col.type
            continue
        name, old = have[col.name.lower()]
        if old != col.type:
            both_text = _text(old) and _text(col.type)
            (out.relabelled if both_text else out.retyped if widens(old, col.type) else out.unlike)[name] = (old, col.type)
    return out


def alter_table(wh: Warehouse, table: Table, diff: Diff) -> None:
    """Bring an existing table to its declaration, in one switch of its view.

    New columns and other text lengths only change the declaration: the files
    stay, and a shorter length is accepted when no text is over it.  Wider
    types are written to a new version.  Anything else raises and changes nothing.
    """
    name = table.name
    if diff.unlike:
        raise LoadError(f"{wh.name(name)}: no widening: {diff.unlike}")
    types = {**wh.column_types(name), **diff.added, **{c: new for c, (_, new) in (diff.retyped | diff.relabelled).items()}}
    columns = ", ".join(f"`{c}` {t}" for c, t in types.items())
    lengths = {c: int(new[8:-1]) for c, (old, new) in diff.relabelled.items() if new != "string"
               and (old == "string" or int(old[8:-1]) > int(new[8:-1]))}
    if lengths:
        over = wh.read(name).agg(*[F.count_if(F.length(c) > n).alias(c) for c, n in lengths.items()]).first().asDict()
        if any(over.values()):
            raise LoadError(f"{wh.name(name)}: texts over the declared length: { {c: n for c, n in over.items() if n} }")
    parts, layout, folder = wh.partition_columns(name), wh.layout(name), wh.plain_folder(name)
    ours = wh.version_table(name) != wh.name(name)
    if not diff.retyped and ours and (parts or layout):
        hidden = f", `{BUCKET}` int" if layout else ""
        wh.swap_partitions(name, None, columns=columns + hidden)
    elif not diff.retyped and ours and folder:
        wh._switch(name, wh._new_version(name, folder, columns))
    else:
        # a layout is made anew by the next keyed load: its hash depends on the keys' types
        wider = wh.read(name).withColumns({c: F.col(c).cast(new) for c, (_, new) in diff.retyped.items()}
                                          | {c: F.lit(None).cast("string" if _text(t) else t) for c, t in diff.added.items()})
        path = wh.write_version(wider, name, parts)
        wh._switch(name, wh._new_version(name, path, columns, parts))


def ensure_tables(wh: Warehouse, tables, replace_existing: bool = False,
                  dry_run: bool = False, alter: bool = True) -> DataFrame:
    """Create the declared tables and bring existing ones to their
    declaration; returns one report row per table: created / replaced (with
    ``replace_existing``) / altered (with what changed) / skipped / error.  An error
    does not stop the others.  ``alter=False`` skips every existing table; a
    ``dry_run`` changes nothing and reports the same, but for texts over a
    length, which only the run itself finds."""
    rows = []
    for t in tables:
        try:
            there = wh.exists(t.name)
            if there and not replace_existing:
                diff = schema_diff(wh, t) if alter else None
                if not diff:
                    rows.append((t.name, "skipped", None, None))
                    continue
                if diff.unlike:
                    raise LoadError(f"{wh.name(t.name)}: no widening: {diff.unlike}")
                if not dry_run:
                    alter_table(wh, t, diff)
                rows.append((t.name, "altered", diff.told(), None))
                continue
            if not dry_run:
                wh.create_empty(t, replace=replace_existing)
            rows.append((t.name, "replaced" if there else "created", None, None))
        except Exception as e:  # noqa: BLE001 - reported per table
            rows.append((t.name, "error", None, str(e)[:500]))
    return wh.spark.createDataFrame(rows, "table_name string, action string, changes string, error string")
