"""Token ids in ORC files.

The files hold the documents in ascending doc_id order (nulls first, equal ids
by a hash of their text): ``doc_id``, ``place`` (ascending over all files) and
``ids``.  ORC keeps the ids as run-length encoded integers in stripes; a row
index every ``STRIDE`` rows and Bloom filters on doc_id let a reader skip
stripes and row groups by metadata alone, and stripes are read in parallel.

Ranges of ids are dealt to tasks, so files are in order among themselves and no
task sees more than its range; many rows of one doc_id are spread by the hash.
Null and empty texts have only the end id.  Repeated rows stay.  An empty table
gives an empty file set, which reads as an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import scratch_path
from .bpe import encode
from .common import map_arrow, materialise, take

END_ID = 2
STRIDE = 1_000
STRIPE = 16 << 20
#: monotonically_increasing_id puts the partition above this bit.
ROW_BITS = 33

OPTIONS = {
    "orc.bloom.filter.columns": "doc_id",
    "orc.bloom.filter.fpp": "0.01",
    "orc.create.index": "true",
    "orc.row.index.stride": str(STRIDE),
    "orc.stripe.size": str(STRIPE),
    "compression": "snappy",
}


def write_ids(docs: DataFrame, tokenizer: str, path: str | None = None, end_id: int = END_ID) -> str:
    """Encode all texts, write them as ORC, and return the folder."""
    path = path or scratch_path(docs.sparkSession, "token-files")
    rows = take(docs, "doc_id", "text").withColumn("tie", F.xxhash64("text"))
    ordered = rows.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    ids = encode(ordered.drop("tie"), tokenizer, by_library=True, end_id=end_id)
    ids.select("doc_id", F.monotonically_increasing_id().alias("place"), "ids").write.options(**OPTIONS).orc(path)
    return path


def read_ids(spark: SparkSession, path: str, schema: str = "doc_id long, place long, ids array<int>") -> DataFrame:
    return spark.read.schema(schema).orc(path)


def file_digests(spark: SparkSession, path: str) -> DataFrame:
    """Per row of the files: doc_id, start, n_tokens, ids_crc32."""

    def run(batches):
        import zlib

        import numpy as np
        import pyarrow as pa

        for batch in batches:
            lists = batch.column(2)
            offsets = np.asarray(lists.offsets)
            flat = np.asarray(lists.values).astype("<u4")
            crc = [zlib.crc32(flat[a:b].tobytes()) for a, b in zip(offsets, offsets[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(np.diff(offsets).astype("int64")), pa.array(crc, pa.int64())],
                names=["doc_id", "place", "n_tokens", "ids_crc32"])

    rows = materialise(map_arrow(read_ids(spark, path), run, "doc_id long, place long, n_tokens long, ids_crc32 long"), "token-rows")
    rows = rows.withColumn("part", F.shiftright("place", ROW_BITS))
    # One row for each file orders the files; each file's rows are summed by themselves.
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    parts = rows.groupBy("part").agg(F.sum("n_tokens").alias("n")).select(
        F.col("part").alias("p"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    own = W.partitionBy("part").orderBy("place").rowsBetween(W.unboundedPreceding, -1)
    return rows.join(parts, F.col("part") == F.col("p")).select(
        "doc_id", (F.col("base") + F.coalesce(F.sum("n_tokens").over(own), F.lit(0))).alias("start"), "n_tokens", "ids_crc32")
