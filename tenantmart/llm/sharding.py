"""Sharding by a two-pass external shuffle.

First pass: a seeded hash of each record (id and text) scatters the records
evenly over as many buckets as it takes for one to fit in memory.  Second pass:
each bucket is read as a whole, put in a canonical order, shuffled by
Fisher-Yates with the bucket's own seed, and written.

A record's place is the number of records in the buckets before its own plus
its place in the bucket; shard ``s`` of ``n`` holds the places from
``s * rows / n`` on, so shards' row counts are at most one apart (law
``rows``), and slots count from 0 in each.  A bucket writes to the one or two
shards it overlaps.

Texts may be null (size 16) or long; a record larger than a bucket gets one to
itself in effect.  Records of one id are spread by their texts, and copies of a
text by their ids.  Rows that are identical in both are counted, and numbered
from 0 (which of them has which number makes no difference); the number is part
of the hash, so they are spread as well.  The result depends on the records and
the seed alone.  Further columns, also with clashing names, are left out.  An
empty table gives empty shards.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path
from .common import materialise, take

SHARDS = 40
#: Text bytes that a bucket holds on average.
BUCKET = 16 << 20
#: Bytes that a record counts beside its text.
OVERHEAD = 16
SEED = 8
LAW = "rows"
#: Identical rows that one task makes from their count at a time.
RUN = 1_000


def record_size(text: str = "text"):
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + OVERHEAD


def _numbered(repeated: DataFrame, runs: int = RUN) -> DataFrame:
    """One row for each of the ``n`` identical rows, with its ``number``; a task makes a run of them, not all."""
    starts = repeated.withColumn("run", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(runs).cast("long"))))
    return (starts.repartition("mixed", "run")
            .withColumn("number", F.explode(F.expr(f"sequence(run, least(n, run + {runs}L) - 1)"))).drop("n", "run"))


def shuffled(docs: DataFrame, seed: int = SEED, bucket_bytes: int = BUCKET) -> tuple[DataFrame, int]:
    """``docs`` (doc_id, text) with every record's ``place`` in the shuffle, and the number of records."""
    docs, names = docs.withColumn("mixed", F.xxhash64(F.lit(seed), "doc_id", "text")), docs.columns
    light = materialise(docs.select("mixed", record_size().alias("size")), "shard-sizes")
    rows, size = light.agg(F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0))).first()
    buckets = int(size) // bucket_bytes + 1
    # Hashes that occur more than once: of identical rows, or (rarely) by chance.
    often = materialise(light.groupBy("mixed").count().where("count > 1").select("mixed"), "shard-repeated")
    copies = materialise(docs.join(often, "mixed", "left_semi").groupBy("mixed", *names).agg(F.count(F.lit(1)).alias("n")), "shard-copies")
    alone = F.pmod("mixed", F.lit(buckets)).alias("bucket")
    among = F.pmod(F.xxhash64("mixed", "number"), F.lit(buckets)).alias("bucket")
    # One row for each bucket.
    before = W.orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    filled = light.join(often, "mixed", "left_anti").select(alone).unionAll(_numbered(copies.select("mixed", "n")).select(among))
    starts = materialise(
        filled.groupBy("bucket").count()
        .select(F.col("bucket").alias("b"), F.coalesce(F.sum("count").over(before), F.lit(0)).alias("first")), "bucket-starts")
    records = docs.join(often, "mixed", "left_anti").select(*names, alone).unionAll(_numbered(copies).select(*names, among))
    scattered = records.join(starts, F.col("bucket") == F.col("b")).drop("b")

    def fisher_yates(key, records):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        number = key[0].as_py()
        records = records.take(pc.sort_indices(records, sort_keys=[(c, "ascending") for c in names]))
        order = np.arange(records.num_rows)
        np.random.default_rng([seed, number]).shuffle(order)
        places = pa.array(np.arange(records.num_rows)) if not records.num_rows else pc.add(records.column("first")[0], pa.array(np.arange(records.num_rows)))
        return records.select(names).take(pa.array(order)).append_column("place", places)

    schema = T.StructType([*docs.select(*names).schema.fields, T.StructField("place", T.LongType())])
    return scattered.groupBy("bucket").applyInArrow(fisher_yates, schema), rows


def write_shards(docs: DataFrame, path: str | None = None, shards: int = SHARDS, seed: int = SEED, bucket_bytes: int = BUCKET) -> str:
    """Write the shards as Parquet folders ``shard=<n>`` (doc_id, text, slot), and return the path."""
    path = path or scratch_path(docs.sparkSession, "shards")
    records, rows = shuffled(take(docs, "doc_id", "text"), seed, bucket_bytes)
    n = F.lit(max(rows, 1))
    shard = F.expr(f"int(place * {shards}L div {max(rows, 1)}L)")
    first = F.ceil(F.col("shard").cast("decimal(20,0)") * n / F.lit(shards)).cast("long")
    out = records.withColumn("shard", shard).withColumn("slot", F.col("place") - first).drop("place")
    out.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
    return path


def read_shards(spark: SparkSession, path: str, schema: str = "doc_id long, text string, slot long, shard int") -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def shard_digests(spark: SparkSession, path: str) -> DataFrame:
    """Per row of the shard files: doc_id, size, text_crc32, law, shard, slot, grown_shard."""
    return read_shards(spark, path).select(
        "doc_id", record_size().alias("size"), F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"),
        F.lit(LAW).alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
