import random
import zlib

import numpy as np
import pytest

from tenantmart.llm import toxicity as T

WORDS = [f"w{i}" for i in range(300)]


def pairs(n, seed):
    """Toxic where two words meet that are harmless with others; each word alone says nothing."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        a, b = rng.randrange(2), rng.randrange(2)
        words = rng.sample(WORDS, 40) + [("insult", "praise")[a], ("people", "weather")[b]]
        rng.shuffle(words)
        rows.append((i, " ".join(words), int(a == b)))
    return rows


def frames(spark, rows):
    docs = spark.createDataFrame([(9.5, t, "x", i, True) for i, t, _ in rows], "score double, text string, lang string, doc_id long, toxic boolean").repartition(3)
    return docs, spark.createDataFrame([(i, m, 1) for i, _, m in rows], "doc_id long, toxic int, quality int")


def scores(spark, rows, labels=None):
    docs, own = frames(spark, rows)
    return sorted(map(tuple, T.toxicity(docs, own if labels is None else labels).collect()), key=str)


def held(i):
    return zlib.crc32(str(i).encode()) % 4 == 2


HELD, FREE = (next(i for i in range(99) if held(i) == h) for h in (True, False))


@pytest.fixture(scope="module")
def found(spark):
    rows = pairs(1000, 1)
    return rows, scores(spark, rows)


def test_pairs_are_learned(found):
    rows, got = found
    toxic = {i: m for i, _, m in rows}
    assert [r[0] for r in sorted(got)] == [r[0] for r in rows]
    assert all(r[1] == held(r[0]) and r[3] == (r[2] >= 0.3) for r in got)
    assert np.mean([r[3] == toxic[r[0]] for r in got if r[1]]) > 0.95


def test_additive_weights_cannot():
    rows = pairs(1000, 1)
    data = [T.Terms().passages([t])[0] for _, t, _ in rows]
    kept = [k for k, r in enumerate(rows) if not held(r[0])]
    edges = np.concatenate([[0], np.cumsum([len(data[k]) for k in kept])])
    toxic = np.array([float(rows[k][2]) for k in kept])
    m = T.fit(np.concatenate([data[k] for k in kept]), edges, np.arange(len(kept)), toxic, toxic.mean())
    m.factors[:] = 0
    right = [(m.log_odds(data[k], np.array([0, len(data[k])]))[0] > 0) == rows[k][2] for k in range(len(rows)) if held(rows[k][0])]
    assert np.mean(right) < 0.65


def test_held_out_labels_are_not_read(spark, found):
    rows, got = found
    docs, labels = frames(spark, [(i, t, 1 - m if held(i) else m) for i, t, m in rows])
    assert sorted(map(tuple, T.toxicity(docs, labels).collect()), key=str) == got       # and reruns agree


def test_log_odds_by_hand():
    rng = np.random.default_rng(0)
    m = T.Machine(-0.5, rng.normal(size=T.BUCKETS), rng.normal(size=(T.BUCKETS, 3)), rng.random(T.BUCKETS))
    passages = [np.array([1, 5, 9]), np.array([], dtype=int), np.array([7]), np.array([5, 8])]
    want = []
    for p in passages:
        odds = -0.5 + sum(m.weights[i] * m.scales[i] for i in p)
        odds += sum(m.factors[i] @ m.factors[j] * m.scales[i] * m.scales[j] for i in p for j in p if i < j)
        want.append(odds)
    assert m.log_odds(np.concatenate(passages), np.concatenate([[0], np.cumsum([len(p) for p in passages])])) == pytest.approx(want)


def test_terms_and_passages(monkeypatch):
    rng = random.Random(3)
    texts = [" ".join(f"w{rng.randrange(900)}" for _ in range(n)) for n in (0, 1, 63, 64, 65, 128, 129, 300, 1000, 2)] + [None, " \n"]
    want = []
    for i, text in enumerate(texts):
        ids = [zlib.crc32(w.encode()) & (T.BUCKETS - 1) for w in (text or "").split()]
        want += [(i, sorted(set(ids[k:k + T.SPAN]))) for k in range(0, max(1, len(ids) - T.STEP), T.STEP)]
    for piece in (T.PIECE, 128):
        monkeypatch.setattr(T, "PIECE", piece)
        terms, edges, doc = T.Terms().passages([t and t.upper() for t in texts])
        assert [(d, terms[a:b].tolist()) for d, a, b in zip(doc, edges, edges[1:])] == want
    beginnings = [zlib.crc32(n.encode()) & (T.BUCKETS - 1) for n in ("stupidly", "<stup", "<stupi", "<stupid", "<stupidl")]
    assert T.Terms().passages(["Stupidly"])[0].tolist() == sorted(beginnings)
    assert T.Terms().passages(["ÉÉÉÉÉ"])[0].tolist() == sorted(zlib.crc32(n.encode()) & (T.BUCKETS - 1) for n in ("ééééé", "<éééé"))
    assert [len(x) for x in T.Terms().passages([])] == [0, 1, 0]


def test_odd_rows(spark, found):
    rows, _ = found
    long = " ".join(WORDS * 300)
    odd = [(None, None, 1), (2001, None, None), (2002, "", 0), (2003, " \n", 0), (2004, long + " insult people", 0), (2005, long, 0), (0, rows[0][1], 0)]
    got = scores(spark, rows + odd)
    by = {r[0]: r for r in got}
    assert len(got) == len(rows) + len(odd) and sum(r[0] == 0 for r in got) == 2
    assert by[2001][2] == by[2002][2] == by[2003][2] == by[None][2] and by[None][1] is False
    assert by[2004][2] > by[2005][2]           # the last words of a text of 90,000


@pytest.mark.parametrize("marks, share", [([(FREE, 1)], 1.0), ([(FREE, 0)], 0.0), ([], 0.0), ([(HELD, 1), (None, 1), (FREE, None)], 0.0)])
def test_without_both_labels(spark, marks, share):
    labels = spark.createDataFrame([(i, m, None) for i, m in marks], "doc_id long, toxic int, quality int")
    rows = [(i, "a b", None) for i in range(9)]
    assert {round(r[2], 9) for r in scores(spark, rows, labels)} == {share}
    docs, _ = frames(spark, rows)
    assert T.toxicity(docs.limit(0), labels).collect() == []
