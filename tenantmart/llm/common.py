"""Helpers shared by the corpus operators.

* ``take`` picks input columns by exact name and position, so further columns
  (also ones that differ only in case, or that carry the name of a result
  column) never make a reference ambiguous.
* ``materialise`` cuts lineage with a table on the shared folder named by
  ``spark.checkpoint.dir``: a lost executor costs a re-read, not a re-run.
* ``map_arrow`` runs a function over Arrow batches of bounded size.
* ``bounded`` proves the size of a frame before it is broadcast or read by
  the driver, and fails loudly beyond the bound.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

#: The white space of all contracts: space, tab, LF, VT, FF, CR.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def positional(df: DataFrame) -> DataFrame:
    """The same rows under the names ``_c0, _c1, ...``; ``toDF(*df.columns)`` undoes it."""
    return df.toDF(*[f"_c{i}" for i in range(len(df.columns))])


def position(df: DataFrame, name: str) -> str:
    """The positional name of the column called exactly ``name``."""
    if name not in df.columns:
        raise ValueError(f"no column {name!r} in {df.columns}")
    return f"_c{df.columns.index(name)}"


def take(df: DataFrame, *names: str) -> DataFrame:
    plain = positional(df)
    return plain.select(*[plain[position(df, n)].alias(n) for n in names])


def materialise(df: DataFrame, label: str) -> DataFrame:
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Rows in a batch for Python; long texts are bounded by bytes besides.
BATCH_ROWS = "500"
BATCH_BYTES = "16m"


def map_arrow(df: DataFrame, run, schema) -> DataFrame:
    """``mapInArrow`` with small batches, unless the session names other sizes.

    Spark's default of 10,000 rows is made for numbers; of whole texts, it would
    hold several copies of some hundred MB in each executor.
    """
    conf = df.sparkSession.conf
    if conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000":
        conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
        conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return df.mapInArrow(run, schema)


def bounded(df: DataFrame, most: int, what: str) -> list:
    """Rows of a frame whose size a parameter bounds."""
    rows = df.limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} {what}")
    return rows


def small_side(df: DataFrame, most: int = 100_000) -> DataFrame:
    """A written table as a join's small side: broadcast if it has at most
    ``most`` rows, otherwise left to the planner (whose joins of two written
    tables can split a hot key)."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def unit_interval(*cols: Column) -> Column:
    """A uniform number in (0, 1) that depends on the columns' values alone."""
    h = F.shiftrightunsigned(F.xxhash64(*cols), 11)
    return (h.cast("double") + F.lit(0.5)) / F.lit(float(1 << 53))
