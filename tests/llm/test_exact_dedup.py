import hashlib
import random
import re

import pytest

from tenantmart.llm import exact_dedup as D


def brute(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(re.sub("[ \t-\r]+", " ", t or ""), []).append(i)
    out = []
    for n, ids in groups.items():
        keep = min([i for i in ids if i is not None], default=None)
        todo = True
        for i in ids:
            kept = i == keep and todo
            todo &= not kept
            out.append((i, keep, len(ids), kept, hashlib.sha256(n.encode()).hexdigest()))
    return sorted(out, key=str)


ROWS = ([(i, "hot  text\n") for i in range(50, 20, -1)] + [(100, "hot\ttext "), (21, "hot text "), (21, "hot text ")] +
        [(1, None), (2, ""), (3, " "), (4, "  \n "), (5, "a b"), (6, "a\x0bb"), (7, "a\xa0b"), (8, "A b"), (None, "a b"),
         (None, "only null"), (None, "only null"), (9, "x" * 200000), (10, "x" * 200000), (10, "x" * 200000), (11, "é ü"), (12, "é  ü")])


@pytest.mark.parametrize("capacity", [1, 3, 500_000])    # the directory is full, split, one bucket
def test_groups(spark, capacity):
    rows = ROWS[:]
    random.Random(3).shuffle(rows)
    df = spark.createDataFrame([(t, True, "k", i) for i, t in rows], "text string, kept boolean, key string, doc_id long").repartition(5)
    assert sorted(map(tuple, D.exact_groups(df, capacity).collect()), key=str) == brute(rows)
    left = D.exact_dedup(df, capacity)
    assert left.columns == df.columns
    assert sorted((r.doc_id, re.sub("[ \t-\r]+", " ", r.text or "")) for r in left.collect() if r.doc_id is not None) == sorted(
        {(min(i for i, u in rows if i is not None and re.sub("[ \t-\r]+", " ", u or "") == n), n)
         for n in {re.sub("[ \t-\r]+", " ", t or "") for i, t in rows if i is not None}})
    assert sum(r.doc_id is None for r in left.collect()) == 1


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert D.exact_groups(df).count() == 0
    assert D.exact_dedup(df).count() == 0


def test_directory_splits_only_overfull_buckets():
    counts = {0: 10, 1: 1, 2: 1, 3: 1, 8: 2}
    directory = D.build_directory(counts, capacity=3, max_depth=4)
    assert len(directory) == 16                       # slot 0 alone is over capacity at every depth
    assert directory[0] == (0, 4) and directory[1] == (1, 4)
    assert set(directory[8:]) == {(1, 1)}             # the upper half was never split
    assert directory[2:4] == [(1, 3)] * 2
    assert D.build_directory({5: 3}, capacity=3, max_depth=4) == [(0, 0)]
    for s, (prefix, depth) in enumerate(directory):
        assert s >> (4 - depth) == prefix


def test_buckets_split_at_ordinary_sizes(spark):
    """On 9,000 different texts, one of them on a third of all rows, the index has several buckets by key ranges."""
    rows = spark.range(13_500).selectExpr("id AS doc_id", "IF(id < 4500, 'hot', concat('text ', id)) AS text")
    entries = D._keyed(rows)
    directory = D.directory_frame(entries)
    index = D._index(entries, directory)
    per = {r["bucket"]: r for r in index.selectExpr("bucket", "shiftrightunsigned(key, 50) AS slot").groupBy("bucket").agg(
        {"*": "count", "slot": "max"}).collect()}
    assert len(per) > 1 and max(r["count(1)"] for r in per.values()) <= D.CAPACITY
    slots = {r["slot"]: r["bucket"] for r in directory.collect()}
    assert len(slots) == 1 << D.MAX_DEPTH and set(slots.values()) == set(per)
    files = index.selectExpr("bucket", "_metadata.file_path AS f").distinct().groupBy("bucket").count()
    assert {r["count"] for r in files.collect()} == {1}
    got = {(r.keep_id, r.group_size) for r in D.exact_groups(rows).where("group_size > 1").collect()}
    assert got == {(0, 4500)} and D.exact_dedup(rows).count() == 9_001
