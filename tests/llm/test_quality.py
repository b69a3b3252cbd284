import math
import random
import re
import zlib

import numpy as np

from tenantmart.llm import quality as Q


def corpus(n=1500, seed=3):
    rng = random.Random(seed)
    vocab = ["".join(rng.choice("abcdefghi") for _ in range(rng.randint(2, 7))) for _ in range(800)]
    rows, labels = [], []
    for i in range(n):
        w = [rng.choice(vocab) for _ in range(rng.randint(30, 200))]
        bad = rng.random() < 0.2
        if bad:
            w = rng.choice([lambda: [x + "%%%" for x in w], lambda: " | ".join(w).split(), lambda: [x for x in w[:8] for _ in range(9)]])()
        rows.append((i, " ".join(w)))
        if i % 3:
            labels.append((i, int(not bad), 0))
    return rows, labels


def frames(spark, rows, labels):
    return (spark.createDataFrame([(t, 1.0, i, False) for i, t in rows], "text string, key double, doc_id long, kept boolean").repartition(3),
            spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))


def test_held_out_accuracy(spark):
    rows, labels = corpus()
    docs, marks = frames(spark, rows, labels)
    truth = {i: not ("%%%" in t or "|" in t or re.search(r"\b(\w+)( \1){5}", t)) for i, t in rows}
    got = {r.doc_id: r.kept for r in Q.quality(docs, marks).collect()}
    unseen = [i for i in truth if i % 3 == 0]
    assert all(got[i] for i in unseen if truth[i])
    assert sum(not got[i] for i in unseen if not truth[i]) >= 0.95 * sum(not truth[i] for i in unseen)
    kept = Q.keep_good(docs, marks)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {i for i, k in got.items() if k}
    share = Q.quality(docs, marks, share=0.5)
    assert share.where("kept").count() == 750
    best = sorted((r.key for r in share.collect()), reverse=True)[:750]
    assert sorted((r.key for r in share.where("kept").collect()), reverse=True) == best


def test_weights_equal_brute_force(spark):
    rows, labels = corpus(200)
    docs, marks = frames(spark, rows, labels)
    got = {r.doc_id: r for r in Q.quality(docs, marks).collect()}

    def grams(text):
        h = [zlib.crc32(t.encode()) for t in re.findall(r"\w+|[^\w\s]+", text)]
        h = [Q.REPEAT if i and h[i] == h[i - 1] else x for i, x in enumerate(h)]
        return [x % Q.BUCKETS for x in h] + [((a * 0x9E3779B97F4A7C15 + b * 0xC2B2AE3D27D4EB4F) % 2 ** 64 >> 40) % Q.BUCKETS for a, b in zip(h, h[1:])]

    fitted = {r.doc_id for r in marks.where("quality = 1").where(Q.unit_interval(Q.F.lit(Q.SEED + 1), Q.F.col("doc_id")) < Q.FITTED)
              .where(Q.unit_interval(Q.F.lit(Q.SEED), Q.F.col("doc_id")) < min(1.0, 0.9 * Q.LABELS / len(labels))).collect()}
    raw, target = np.zeros(Q.BUCKETS), np.zeros(Q.BUCKETS)
    for i, t in rows:
        for g in grams(t):
            raw[g] += 1
            target[g] += i in fitted
    ratio = np.log(target + Q.SMOOTHING) - np.log(raw * target.sum() / raw.sum() + Q.SMOOTHING)
    for i, t in rows:
        assert math.isclose(got[i].log_weight, sum(ratio[g] for g in grams(t)), abs_tol=1e-6)


def test_odd_rows(spark):
    rows, labels = corpus(300)
    rows += [(None, "null id"), (9000, None), (9001, ""), (9002, " \n"), (9003, "word " * 300_000), (1, rows[1][1]), (1, rows[1][1])]
    docs, marks = frames(spark, rows, [*labels, (1, 1, 0), (1, 1, None), (None, 0, 1), (4, None, None)])
    got = Q.quality(docs, marks).collect()
    assert len(got) == len(rows)
    assert [r.log_weight for r in got if r.doc_id in (9000, 9001, 9002)] == [0.0] * 3
    assert len({r.kept for r in got if r.doc_id == 1}) == 1
    assert Q.quality(docs.limit(0), marks).count() == 0
    assert all(r.kept for r in Q.quality(docs, marks.limit(0)).collect())


def test_threshold():
    assert Q.calibrated_threshold([]) == -math.inf
    assert Q.calibrated_threshold([(1.0, True), (0.0, False)]) == 0.5
    assert Q.calibrated_threshold([(1.0, False), (0.0, True)]) == -math.inf
