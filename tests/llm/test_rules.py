import random
import re

import numpy as np

from tenantmart.llm import rules


def brute(t):
    t = t or ""
    w = re.findall("[^ \t-\r]+", t)
    seen, dup = set(), 0
    for line in t.split("\n"):
        if re.search("[^ \t-\r]", line):
            dup += line in seen
            seen.add(line)
    windows = {}
    for i in range(len(w) - 2):
        windows.setdefault(tuple(w[i:i + 3]), []).append(i)
    rep = {j for v in windows.values() if len(v) > 1 for i in v for j in range(i, i + 3)}
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), dup, len(rep)


def corpus():
    rng = random.Random(3)
    rows = []
    for i in range(400):
        w = ["".join(rng.choice("abcdefghé") for _ in range(rng.randint(2, 9))) for _ in range(rng.randint(60, 200))]
        t = "".join(x + rng.choice([" ", " ", " ", "\n", "\t"]) for x in w)
        if i % 20 == 0:
            t = "".join(x + "### " for x in w)
        rows.append((i, t, rng.choice(["en", None]), rng.choice(["s1", "s1", "s2"])))
    rows += [(1000, None, "en", "s1"), (1001, "", None, None), (1002, " \n\x0b", "en", "s1"), (1003, "a b c a b c a b", "en", "s9"), (1004, "x " * 3000, "en", "s1"),
             (1005, "one\n\none\none \n\n one", "en", "s1"), (None, "no id here", "fr", "s1"), (3, "same row twice", "fr", "s1"), (3, "same row twice", "fr", "s1"),
             (1006, "a b c d a b c d", "en", "s1"), (1007, "a a a", "en", "s1"), (1008, "a a a a", "en", "s1"), (1009, "😀é | <x>", "en", "s1"), (1010, "a\xa0b\x1cc d", "en", "s1"),
             (1011, " ".join(str(i % 997) for i in range(20_000)), "en", "s1")]
    return rows


def test_counts_and_verdicts(spark):
    rows = corpus()
    df = spark.createDataFrame([(t, s, lang, i, "g") for i, t, lang, s in rows], "text string, source string, lang string, doc_id long, n_words string").repartition(4)
    got = rules.judged(df).collect()
    assert sorted((str(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got) == sorted((str(i), *brute(t)) for i, t, _, _ in rows)
    for r in got:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.base_failed and r.kept)
    regular = [r for r in got if r.doc_id is not None and r.doc_id < 400 and not r.base_failed]
    assert all(r.kept == (r.doc_id % 20 != 0) for r in regular)
    assert rules.judged(df.limit(0)).count() == 0


def test_distances_equal_numpy(spark):
    """The whole estimate against a plain numpy version, with exact borders."""
    rng = np.random.default_rng(0)
    x = rng.normal(size=(300, 4)) * [0.3, 0.2, 0.1, 0.2] + [1.7, 0.2, 0.1, 0.3]
    x[:40] += 4
    df = spark.createDataFrame([("g", *map(float, r)) for r in x], "group string, " + ", ".join(f"{n} double" for n in rules.NAMES))
    got = sorted(r["d2"] for r in rules.distances(df).collect())
    floor = np.diag([rules.FLOORS[n] ** 2 for n in rules.NAMES])

    def dist(sub):
        d = x - sub.mean(axis=0)
        return np.einsum("ij,jk,ik->i", d, np.linalg.inv(np.cov(sub.T, bias=True) + floor), d)

    k = 225
    d2 = (((x - np.sort(x, axis=0)[149]) / [rules.FLOORS[n] for n in rules.NAMES]) ** 2).sum(axis=1)
    for _ in range(rules.STEPS):
        d2 = dist(x[d2 <= np.sort(d2)[k - 1]])
    d2 = dist(x[d2 <= rules.CUTOFF])
    assert np.allclose(got, np.sort(d2), rtol=1e-6)
    assert (np.array(got) > rules.CUTOFF).sum() == 40


def third_bad(vary):
    """Two groups of 200 good texts and 100 bad ones: copies of one text, or texts that differ a little."""
    rng = random.Random(11)
    rows = []
    for s in ("s1", None):
        for i in range(200):
            w = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 9))) for _ in range(rng.randint(80, 200))]
            rows.append((i, " ".join(w), "en", s))
        bad = ["".join(rng.choice("abcdefgh") for _ in range(5)) + "##|" for _ in range(150)]
        for i in range(100):
            rows.append((1000 + i, " ".join(bad[:150 - i % 50 * vary] + ["x" * (1 + i % 7)] * vary), "en", s))
    return rows


def test_a_third_of_bad_texts_is_rejected(spark):
    for vary in (0, 1):
        rows = third_bad(vary)
        df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(4)
        got = rules.judged(df).collect()
        assert len(got) == len(rows) and not any(r.base_failed for r in got)
        assert all(r.kept == (r.doc_id < 1000) for r in got), vary


def test_consistency_factor():
    x = np.random.default_rng(1).normal(size=(200_000, 4))
    d2 = (x ** 2).sum(axis=1)
    for share, factor in ((0.5, rules.consistency(0.5)), (0.8, rules.consistency(0.8))):
        inside = x[d2 <= np.quantile(d2, share)]
        assert abs(factor * inside.var() - 1) < 0.02
    assert rules.consistency(1.0) == 1.0 and rules.SHARES[0] == rules.SUBSET and rules.SHARES[-1] == 1.0
