"""Exact de-duplication through an extendible-hash index on shared files.

DataFrame operations only.  Two texts are equal when they agree after every
run of white space became one space; null counts as empty.

1. *Entries*: one light row for each document (row number, id, 64-bit key and
   SHA-256 of the normalised text), written once to the shared folder.
2. *Directory*: starts with one bucket; a bucket that holds more distinct keys
   than its capacity is split in two by the next key bit, and the directory
   doubles when a bucket as deep as the directory itself must split.  It is
   computed from the key counts of at most ``2 ** MAX_DEPTH`` prefixes, so its
   size is bounded whatever the input.
3. *Index files*: rows of one key form a chain, and grouping the chain by the
   normalised text itself compares the bytes: equal keys of different texts
   stay apart.  Copies are summed before the shuffle, so a text that a third of
   all rows share arrives as one row from each task.  Each owner task then
   writes its buckets, a key range each, in key order, without the texts.
4. Every entry finds its bucket by the directory, and in it the chain element
   of its key and digest.  Both sides are tables on shared files, so a hot
   bucket's or key's rows can be split over tasks.

Of equal texts the row with the smallest doc_id stays; null ids come last, and
of rows that share the smallest id exactly one stays.  An empty table gives an
empty result.  Very long texts are normalised and compared whole.  Further
columns of the input, also with clashing names, are ignored by ``exact_groups`` and
kept by ``exact_dedup``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, bounded, materialise, position, positional, take

#: Distinct keys that a bucket holds before it splits.
CAPACITY = 8_192
#: The directory has at most 2 ** MAX_DEPTH slots.
MAX_DEPTH = 14


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, " ")


def slot(key: Column, depth: int = MAX_DEPTH) -> Column:
    """The first ``depth`` bits of a key."""
    return F.shiftrightunsigned(key, 64 - depth).cast("int")


def build_directory(counts: dict[int, int], capacity: int = CAPACITY, max_depth: int = MAX_DEPTH) -> list[tuple[int, int]]:
    """Slots of a directory as (bucket's prefix, bucket's depth), from key counts by ``max_depth``-bit prefix.

    The result has ``2 ** depth`` slots for the smallest depth at which every
    bucket fits, or can't be split further.
    """
    loads: list[dict[int, int]] = [{} for _ in range(max_depth + 1)]    # by depth: keys under each prefix
    for p, n in counts.items():
        for depth in range(max_depth + 1):
            k = p >> (max_depth - depth)
            loads[depth][k] = loads[depth].get(k, 0) + n
    directory, depth = [(0, 0)], 0
    waiting = [(0, 0)]
    while waiting:
        prefix, own = waiting.pop()
        if own == max_depth or loads[own].get(prefix, 0) <= capacity:
            continue
        if own == depth:
            directory = [b for b in directory for _ in (0, 1)]
            depth += 1
        children = [(prefix * 2, own + 1), (prefix * 2 + 1, own + 1)]
        span = 1 << (depth - own)
        first = prefix * span
        half = span // 2
        directory[first:first + span] = [children[0]] * half + [children[1]] * half
        waiting += children
    return directory


def directory_frame(entries: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """(slot, bucket): the directory spread over all ``2 ** MAX_DEPTH`` prefixes."""
    spark = entries.sparkSession
    per_slot = entries.select("key").distinct().groupBy(slot(F.col("key")).alias("slot")).count()
    counts = {r["slot"]: r["count"] for r in bounded(per_slot, 1 << MAX_DEPTH, "directory slots")}
    directory = build_directory(counts, capacity)
    width = (1 << MAX_DEPTH) // len(directory)
    number = {b: i for i, b in enumerate(dict.fromkeys(directory))}
    rows = [(i * width + j, number[b]) for i, b in enumerate(directory) for j in range(width)]
    return spark.createDataFrame(rows, "slot int, bucket int")


def _bucketed(rows: DataFrame, directory: DataFrame) -> DataFrame:
    """``rows`` with the bucket that the directory names for their key."""
    return rows.join(F.broadcast(directory), slot(F.col("key")) == F.col("slot")).drop("slot")    # 2 ** MAX_DEPTH rows


def _index(texts: DataFrame, directory: DataFrame) -> DataFrame:
    """The index files: (bucket, key, digest, n, first) for each different text."""
    return materialise(
        _bucketed(texts, directory)
        .groupBy("bucket", "key", "norm")
        .agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("first"))    # the minimum passes over nulls
        .select("bucket", "key", F.unhex(F.sha2("norm", 256)).alias("digest"), "n", "first")
        .repartition("bucket").sortWithinPartitions("bucket", "key"),    # a bucket lies in one file, in key order
        "exact-index")


def _keyed(rows: DataFrame) -> DataFrame:
    return rows.withColumn("norm", normalised(F.col("text"))).withColumn("key", F.xxhash64("norm"))


def exact_groups(docs: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Per row: doc_id, keep_id, group_size, kept, text_sha256."""
    rows = _keyed(take(docs, "doc_id", "text"))
    # The row number only settles ties of rows with one id; it is fixed by being written.
    entries = materialise(
        rows.select(F.monotonically_increasing_id().alias("row"), "doc_id", "key", F.unhex(F.sha2("norm", 256)).alias("digest")),
        "exact-entries")
    directory = directory_frame(entries, capacity)
    index = _index(rows, directory)
    found = _bucketed(entries, directory).join(index, ["bucket", "key", "digest"])
    first = F.col("doc_id").eqNullSafe(F.col("first"))
    # Rows that share the smallest id: one of them stays.
    ties = (entries.groupBy("key", "digest", "doc_id").agg(F.count(F.lit(1)).alias("same"), F.min("row").alias("row1"))
            .where("same > 1").select(F.col("key").alias("k"), F.col("digest").alias("d"), F.col("doc_id").alias("i"), "row1"))
    out = found.join(ties, (F.col("key") == F.col("k")) & (F.col("digest") == F.col("d")) & first & F.col("doc_id").eqNullSafe(F.col("i")), "left")
    return out.select(
        "doc_id",
        F.col("first").alias("keep_id"),
        F.col("n").alias("group_size"),
        (first & (F.col("row1").isNull() | (F.col("row1") == F.col("row")))).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"))


def exact_dedup(docs: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``docs`` with one row for each different text (that of the smallest doc_id), all columns kept."""
    own, text = position(docs, "doc_id"), position(docs, "text")
    rows = positional(docs)
    keyed = _keyed(rows.withColumns({"doc_id": F.col(own), "text": F.col(text)}))
    entries = materialise(keyed.select("key", F.unhex(F.sha2("norm", 256)).alias("digest"), "doc_id"), "exact-entries")
    directory = directory_frame(entries, capacity)
    index = _index(keyed.select("key", "norm", "doc_id"), directory)
    # How many rows have the smallest id of their text; over 1 only for repeated rows.
    same = _bucketed(entries, directory).join(index, ["bucket", "key", "digest"]).where(F.col("doc_id").eqNullSafe(F.col("first"))).groupBy("key", "digest").agg(
        F.count(F.lit(1)).alias("same"), F.min("first").alias("i"))
    # Whole rows are joined by key and id, which spreads the rows of a hot text.
    wanted = materialise(same.select(F.col("key").alias("k"), F.col("digest").alias("d"), "i", "same"), "exact-kept")
    full = keyed.withColumn("digest", F.unhex(F.sha2("norm", 256))).drop("norm")
    stay = full.join(wanted, F.col("doc_id").eqNullSafe(F.col("i")) & (F.col("key") == F.col("k")) & (F.col("digest") == F.col("d")))
    once = stay.where("same = 1").select(*rows.columns)
    repeated = stay.where("same > 1").dropDuplicates(["k", "d"]).select(*rows.columns)
    return once.unionByName(repeated).toDF(*docs.columns)


#: DuckDB SQL for the query over exact_groups (documents have one row for each doc_id).
ORACLE_SQL = r"""
WITH n AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents
), g AS (SELECT norm, min(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY norm)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256
FROM n JOIN g USING (norm)
"""
