import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tenantmart.llm import hard_negatives as H

SCHEMA = "label int, embedding array<float>, rid long, vec_id long, rank string"


def brute(rows, anchor=lambda i: i % 5 == 0, positives=5, negatives=3):
    kept = [(i, label, [math.floor(256 * v) for v in x]) for label, x, i in rows
            if i is not None and label is not None and x is not None and all(v is not None and math.isfinite(v) for v in x)]
    out = []
    for n, (i, label, x) in enumerate(kept):
        if anchor(i):
            scored = sorted((-sum(p * q for p, q in zip(x, y)), j, m == label) for k, (j, m, y) in enumerate(kept) if k != n)
            for s, j, _ in [r for r in scored if r[2]][:positives]:
                band = [r for r in scored if not r[2] and 50 * -s <= 100 * -r[0] <= 95 * -s]
                out += [(i, j, k + 1, t, -s, -u) for k, (u, t, _) in enumerate(band[:negatives])]
    return Counter(out)


def frame(spark, rows):
    return spark.createDataFrame([(label, x, 1, i, "r") for label, x, i in rows], SCHEMA).repartition(4)


def found(df, **options):
    return Counter(map(tuple, H.hard_negatives(H.usable(df), F.col("vec_id") % 5 == 0, **options).collect()))


def vectors(n, dims, seed, labels=3, grain=64):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(8, dims))
    x = middle[rng.integers(0, 8, n)] + rng.normal(size=(n, dims)) * 0.7
    return [(int(rng.integers(0, labels)), [float(v) for v in np.round(r * grain) / 256], i) for i, r in enumerate(x)]


@pytest.mark.parametrize("dims, grain, block, anchor_block", [(64, 64, 4096, 1024), (7, 2, 40, 8), (17, 30, 16, 3)])
def test_against_brute_force(spark, dims, grain, block, anchor_block):
    rows = vectors(300, dims, dims, grain=grain)
    rows += [(rows[k][0], rows[k][1], 1000 + k) for k in range(0, 60, 7)]          # equal vectors
    want = brute(rows)
    assert len(want) > 100
    assert found(frame(spark, rows), block=block, anchor_block=anchor_block) == want


def test_nulls_lengths_ties_and_repeated_rows(spark):
    rng = random.Random(2)
    rows = [(rng.randrange(2), [rng.choice([0.0, 1 / 256, 2 / 256, -1 / 256]) for _ in range(rng.randrange(6))], i) for i in range(60)]
    rows += rows[:12] + [(None, [1.0], 100), (1, None, 105), (1, [None, 1.0], 110), (1, [float("nan")], 115), (1, [float("inf")], 120),
                         (1, [1.0], None), (1, [], 125), (9, [1.0, 1.0], 130)]
    want = brute(rows)
    assert want and max(want.values()) > 1
    assert found(frame(spark, rows), block=9, anchor_block=4) == want
    assert not found(frame(spark, [(1, None, 5)])) and not found(frame(spark, rows).limit(0))


def test_large_components_stay_exact(spark):
    rows = [(i % 2, [float((i * 7919 % 1000) << 10), float((i * 104729 % 1000) << 10), (1 + i % 5) / 256], i) for i in range(120)]
    want = brute(rows)
    assert max(r[4] for r in want) > 1 << 53 and found(frame(spark, rows), block=16) == want
    with pytest.raises(ValueError, match="do not fit"):
        found(frame(spark, [(1, [1e30], 1)]))


def test_bounds_hold_and_prune():
    rng = np.random.default_rng(1)
    a, b = (rng.integers(-200, 200, (n, 50)) + rng.integers(-300, 300, (n, 1)) for n in (40, 70))

    def block(x):
        row = {"n": len(x), "rid": np.arange(len(x)).tobytes(), "id": np.arange(len(x)).tobytes(), "label": np.zeros(len(x), np.int64).tobytes(),
               "x": x.astype("<i2").tobytes(), "parts": H.summaries(x).tobytes()}
        return H.Block.unpack(row, "", x.shape[1], "<i2", "float64")

    a, b, before = block(a), block(b), None
    exact, alive = a.x @ b.x.T, np.ones((40, 70), dtype=bool)
    for level in range(len(a.parts)):
        low, high = H.bounds(alive, a, slice(None), b, slice(None), level)
        assert (low <= exact).all() and (exact <= high).all()
        assert before is None or ((high - low) <= before + 1).all()      # each level is at least as sharp
        before = high - low
    sparse = rng.random((40, 70)) < 0.02
    assert (H.products(sparse, a.x, b.x)[sparse] == exact[sparse]).all()
    assert (np.diff([len(e) for e in H.levels(64)]) > 0).all() and set(H.levels(50)[1]) <= set(H.levels(50)[2])


def test_pairs_are_not_broadcast(spark):
    """Each group gets a copy of the anchors: a small file, but not a small side of a join."""
    rows = spark.range(64).selectExpr("id AS rid", "id AS vec_id", "id % 3 AS label", "array(id, id + 1) AS x")
    anchors, blocks = H.packed(rows.where("rid < 8"), 4, 2, "<i2", 8), H.packed(rows, 4, 2, "<i2", 64)
    pairs = H.paired(anchors, blocks)
    assert pairs.count() == anchors.count() * blocks.count()
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
