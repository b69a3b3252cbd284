import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from tenantmart.llm import sharding


def test_shards(spark):
    rows = [(i, f"text {i} " * (i % 40)) for i in range(1003)]
    rows += [(5000, None), (5001, ""), (5002, "é" * 300_000), (None, "no id"), (None, "no id either"), (7, "text 7 again"), (7, "text 7 again")]
    rows += [(6000 + i, "copy of one text") for i in range(400)]
    df = spark.createDataFrame([(t, 1, i, "b") for i, t in rows], "text string, slot int, doc_id long, bucket string").repartition(5)
    path = sharding.write_shards(df, shards=13, bucket_bytes=4_000)
    got = sharding.shard_digests(spark, path).collect()
    assert sorted((str(r.doc_id), r.size, r.text_crc32) for r in got) == sorted((str(i), len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in rows)
    sizes = Counter(r["shard"] for r in got)
    assert len(sizes) == 13 and max(sizes.values()) - min(sizes.values()) <= 1
    for s in range(13):
        assert sorted(r.slot for r in got if r["shard"] == s) == list(range(sizes[s]))
    again = sharding.shard_digests(spark, sharding.write_shards(df.repartition(3), shards=13, bucket_bytes=4_000)).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))
    # the order is a shuffle: ids don't follow places
    order = [r.doc_id for r in sorted(got, key=lambda r: (r["shard"], r.slot)) if r.doc_id is not None]
    assert abs(np.corrcoef(order, range(len(order)))[0, 1]) < 0.15


def test_fewer_rows_than_shards_and_empty(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "doc_id long, text string")
    got = sharding.shard_digests(spark, sharding.write_shards(df)).collect()
    assert len({r["shard"] for r in got}) == 3 and {r.slot for r in got} == {0}
    empty = sharding.write_shards(df.limit(0))
    assert sharding.shard_digests(spark, empty).count() == 0


def test_identical_rows_are_spread(spark):
    """40,000 equal rows without an id, 80 MB of text, and two smaller groups: no bucket holds them all, and reruns agree."""
    hot = spark.range(40_000).selectExpr("cast(null as long) AS doc_id", "repeat('x', 2000) AS text")
    rest = spark.range(3_000).selectExpr("id % 2000 AS doc_id", "IF(id % 2000 < 500, 'same', concat('text ', id)) AS text")
    df = hot.unionAll(rest).unionAll(spark.createDataFrame([(None, None)] * 2_500, "doc_id long, text string"))
    records, n = sharding.shuffled(df, bucket_bytes=1 << 20)
    assert n == 45_500
    got = records.groupBy("doc_id", F.length("text").alias("l")).count().where("doc_id IS NULL").collect()
    assert {(r.l, r["count"]) for r in got} == {(2000, 40_000), (None, 2_500)}
    assert records.select("place").distinct().count() == n and records.agg(F.max("place")).first()[0] == n - 1
    # runs of the hot row are broken by others all over the order, and it is at no end
    places = [r.place for r in records.where("text IS NULL").select("place").collect()]
    assert min(places) < n / 10 and max(places) > n * 9 / 10
    first = {r.place: (r.doc_id, r.text) for r in records.collect()}
    again, _ = sharding.shuffled(df.repartition(7), bucket_bytes=1 << 20)
    assert {r.place: (r.doc_id, r.text) for r in again.collect()} == first


def test_largest_bucket_of_identical_rows(spark):
    copies = spark.createDataFrame([(1, 50_000)], "mixed long, n long")
    numbered = sharding._numbered(copies)
    assert numbered.select("number").distinct().count() == numbered.count() == 50_000
    by = numbered.groupBy(F.pmod(F.xxhash64("mixed", "number"), F.lit(77))).count().agg(F.max("count"), F.count("*")).first()
    assert by[0] < 2 * 50_000 / 77 and by[1] == 77
