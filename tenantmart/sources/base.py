"""Source callables: ``src(table_name) -> DataFrame``.

Models only ever call ``src(name)``; where the tables live is the source's
business.  Reads stay lazy, so filters and column pruning of the model reach
the scan (parquet row-group / JDBC ``WHERE`` push-down).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession


class ParquetSource:
    """Tables stored as ``<root>/<name>.parquet`` or ``<root>/<name>/``."""

    def __init__(self, spark: SparkSession, root: str, suffix: str = ".parquet"):
        self.spark, self.root, self.suffix = spark, root.rstrip("/"), suffix
        self._cache: dict[str, DataFrame] = {}

    def __call__(self, name: str) -> DataFrame:
        if name not in self._cache:
            self._cache[name] = self.spark.read.parquet(f"{self.root}/{name}{self.suffix}")
        return self._cache[name]


class CatalogSource:
    """Tables of one catalog database (e.g. a tenant schema)."""

    def __init__(self, spark: SparkSession, database: str):
        self.spark, self.database = spark, database

    def __call__(self, name: str) -> DataFrame:
        return self.spark.table(f"{self.database}.{name}")


@dataclass
class JdbcPartitioning:
    """Parallel JDBC read: ``num_partitions`` range queries on ``column``."""
    column: str
    lower: int
    upper: int
    num_partitions: int


@dataclass
class JdbcSource:
    """A tenant's operational database over JDBC, one read per base table.

    ``partitioning`` spreads a large table over several concurrent range
    queries (bounded by the database's connection budget); small tables are
    read in one query.  Filters of the model are pushed into the ``WHERE``.
    """
    spark: SparkSession
    url: str
    properties: dict = field(default_factory=dict)
    partitioning: dict = field(default_factory=dict)
    schema: str | None = None
    fetchsize: int = 10_000

    def options(self, name: str) -> dict:
        table = f"{self.schema}.{name}" if self.schema else name
        opts = {"url": self.url, "dbtable": table, "fetchsize": str(self.fetchsize),
                "pushDownPredicate": "true", **{k: str(v) for k, v in self.properties.items()}}
        p = self.partitioning.get(name)
        if p is not None:
            opts.update(partitionColumn=p.column, lowerBound=str(p.lower),
                        upperBound=str(p.upper), numPartitions=str(p.num_partitions))
        return opts

    def __call__(self, name: str) -> DataFrame:
        return self.spark.read.format("jdbc").options(**self.options(name)).load()
