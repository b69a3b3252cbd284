import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tenantmart.llm import mixing as M


def words(t):
    return len(re.findall("[^ \t-\r]+", t or ""))


def make(n=600, seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        s = rng.choice(["a", "a", "a", "a", "b", "C", "é", None, "d"])
        rows.append((i * 3, " ".join("w" * rng.randint(1, 9) for _ in range(rng.randint(1, 80))), s))
    rows += [(50_000, None, "a"), (50_001, "", "b"), (50_002, " \x0b\n", "zero"), (None, "x y", "b"), (None, "x y", "b"), (3, "again again", "C"),
             (50_003, "one\xa0word  two\n", "a"), (50_004, "w " * 3000, "d")]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(t, s, i, 1) for i, t, s in rows], "text string, source string, doc_id long, size int")


def test_targets():
    t = M.targets({"a": 100, "b": 100, "c": 100, None: 100})
    # shares 3:1:2:3 of 600; a and None stop at 200, the 200 left goes 1:2 to b and c
    assert t == {"a": 200.0, "b": pytest.approx(200 / 3), "c": pytest.approx(400 / 3), None: 200.0}
    assert M.targets({}) == {} and M.targets({"a": 0}) == {"a": 0.0}
    assert sum(M.targets({str(i): (i * 37) % 11 * 100 for i in range(50)}).values()) == pytest.approx(1.5 * sum((i * 37) % 11 * 100 for i in range(50)))


def test_plan(spark):
    rows = make()
    got = M.mix_plan(frame(spark, rows), block=200, shards=8).collect()
    assert sorted((r.doc_id, r.size) for r in got if r.doc_id is not None) == sorted((i, words(t)) for i, t, _ in rows if i is not None)
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + words(t)
    target = M.targets(sizes)
    source = {(i, words(t)): s for i, t, s in rows}
    taken = dict.fromkeys(sizes, 0)
    for r in got:
        s = source[r.doc_id, r.size]
        assert r.source_size == sizes[s] and r.target == target[s] and r.taken <= 2 * r.size and r.taken == r.size * len(r.drawn)
        assert all(0 <= d < 8 for d in r.drawn)
        taken[s] += r.taken
    for s in sizes:
        assert abs(taken[s] - target[s]) <= max(3, 0.01 * target[s]), (s, taken[s], target[s])
    again = M.mix_plan(frame(spark, rows[::-1]).repartition(3), block=200, shards=8).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))


def test_mix_rows(spark):
    rows = make(200)
    df = frame(spark, rows)
    plan = M.mix_plan(df, block=100, shards=4).collect()
    out = M.mix(df, "shard", block=100, shards=4)
    assert out.columns == [*df.columns, "shard"]
    copies = out.collect()
    assert len(copies) == sum(len(r.drawn) for r in plan)
    assert sorted((str(r.doc_id), words(r.text)) for r in copies) == sorted((str(r.doc_id), r.size) for r in plan for _ in r.drawn)
    per = [sum(words(r.text) for r in copies if r.shard == k) for k in range(4)]
    assert min(per) > 0.2 * max(per)      # one document is longer than 30 blocks


def test_tree_is_exact():
    q = np.array([1000, 3, 0, 250])
    out = M.split_quotas(q, 7)
    assert (out.sum(axis=0) == q).all() and (out >= 0).all()
    assert np.ptp(out.sum(axis=1)) <= 3
    assert M.split_quotas([], 4).shape == (4, 0)


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string, source string")
    assert M.mix_plan(df).count() == 0
    assert M.mix(df).count() == 0


def test_long_document_does_not_end_the_pass(spark):
    """A document larger than its source's target is passed over, wherever it stands."""
    rows = [(i, "w " * 10, s) for s, first in (("a", 0), ("b", 10_000)) for i in range(first, first + 1000)]
    rows += [(5000 + i, "w " * 30_000, "a") for i in range(1, 3)] + [(20_000 + i, "x " * 7, "a") for i in range(20)]
    got = M.mix_plan(frame(spark, rows), weights=(1.0, 1.0), total=0.2, block=500, shards=4).collect()
    size = 10_000 + 60_000 + 140
    target = M.targets({"a": size, "b": 10_000}, (1.0, 1.0), 0.2)["a"]
    assert 7_000 < target < 10_000
    own = [r for r in got if r.source_size == size]
    assert all(r.taken == 0 for r in own if r.size == 30_000)
    assert abs(sum(r.taken for r in own) - target) <= 4
    per = [sum(r.size for r in own for d in r.drawn if d == k) for k in range(4)]
    assert min(per) > 0.5 * max(per)      # what follows the long document is spread as well


def walk(sizes, left):
    """Places that the partial pass takes of documents in order, the gap, and the rounds."""
    taken, rounds, first = set(), 0, len(sizes)
    for i, n in enumerate(sizes):
        if n > left:
            first = i
            break
        taken.add(i)
        left -= n
    while True:
        rest = [i for i in range(first, len(sizes)) if 0 < sizes[i] <= left and i not in taken]
        small, gap, stop = [i for i in rest if 2 * sizes[i] <= left], left, None
        rounds += 1
        for i in small:
            if sizes[i] > left:
                stop = i
                break
            taken.add(i)
            left -= sizes[i]
        if stop is None:
            one = next((i for i in rest if 2 * sizes[i] > gap and sizes[i] <= left), None)
            return (taken, left, rounds) if one is None else (taken | {one}, left - sizes[one], rounds)
        first = stop + 1


def by_turn(rows):
    return sorted(rows, key=lambda r: (r.turn + (1 << 64)) % (1 << 64))


def test_partial_pass_against_the_walk(spark):
    """Sizes that stop many running sums."""
    rng = random.Random(5)
    rows = [(i, "w " * int(2 ** rng.uniform(0, 12)), rng.choice(["a", None])) for i in range(1500)]
    got = M.mixed(M._light(frame(spark, rows)), weights=(1.0, 2.0), total=0.3, block=300, shards=4).collect()
    for s in ("a", None):
        own = by_turn(r for r in got if r.source == s)
        taken, left, _ = walk([r.size for r in own], own[0].target)
        drawn = {i for i, r in enumerate(own) if r.drawn}
        assert drawn >= taken and len(drawn) <= len(taken) + 1
        assert left < min(r.size for i, r in enumerate(own) if i not in taken and r.size)


def test_falling_sizes_need_few_rounds(spark, monkeypatch):
    """2,000 documents each a little shorter than the one before: every one of them would stop a running sum."""
    seen, places = [], M.places
    monkeypatch.setattr(M, "places", lambda df, *rest: seen.append(1) or places(df, *rest))
    n = 2_000
    rows = spark.range(n).select(F.col("id").alias("doc_id"), F.lit("a").alias("source"), (3 * n - F.col("id")).alias("size"), F.col("id").alias("mark"))
    got = M.mixed(M.materialise(rows, "test-falling"), weights=(1.0,), total=0.501, block=1000, shards=4).collect()
    own = by_turn(got)
    taken, left, rounds = walk([r.size for r in own], own[0].target)
    assert {i for i, r in enumerate(own) if r.drawn} >= taken and rounds <= 40 and len(seen) <= rounds + 2
    # the same in the order of the sizes, where a walk that takes each document that fits has a stop for each
    assert walk(list(range(3 * n, n, -1)), 2.5 * n * n)[2] <= 40
