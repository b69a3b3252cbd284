import random
import re
import zlib
from collections import Counter

from tenantmart.llm import spelling as S

LETTERS = "".join(map(chr, range(0xC0, 0x100)))


def near(a, b):
    """Exactly one inserted, deleted or replaced code point."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(rows, odd=S.ODD, length=S.LENGTH, count=S.COUNT, ratio=S.RATIO):
    found = Counter()
    for i, text in rows:
        for run in re.findall(f"[A-Za-z{LETTERS}]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{i}:{run}".encode())
            if odd and i is not None and h % odd == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            found[run] += 1
    words = {w: n for w, n in found.items() if len(w) >= length and n >= count}
    form, n_near = {}, {}
    for w, n in words.items():
        others = sorted((-words[o], o) for o in words if near(w, o))
        n_near[w] = len(others)
        form[w] = others[0][1] if others and -others[0][0] >= ratio * n else None

    def root(w):
        return w if form[w] is None else root(form[w])

    return sorted((w, form[w], root(w), n, n_near[w], words.get(form[w])) for w, n in words.items())


def frame(spark, rows):
    return spark.createDataFrame([(t, "x", i, 7, "w") for i, t in rows], "text string, Text string, doc_id long, n long, word string").repartition(3)


def result(df):
    return sorted(map(tuple, df.collect()))


def test_variants_of_random_words(spark):
    rng = random.Random(4)
    texts = []
    for base in ("aaaaaa", "abcabc", "aabbcc", "Élèves", "zzzzzzz", "ÿÿÿÿÿÿ"):
        forms = {base}
        for _ in range(40):
            w = rng.choice(sorted(forms))
            i = rng.randrange(len(w) + 1)
            forms.add(rng.choice([w[:i] + rng.choice("abcé") + w[i:], w[:i] + w[i + 1:], w[:i] + rng.choice("abÀz") + w[i + 1:]]))
        for w in sorted(forms):
            texts += [w] * rng.choice([1, 4, 5, 6, 25, 125, 700])
    rng.shuffle(texts)
    rows = [(i, " ".join(texts[i * 20:i * 20 + 20])) for i in range(len(texts) // 20 + 1)]
    want = brute(rows)
    assert any(r[5] and r[2] != r[1] for r in want) and any(r[4] > 3 for r in want)      # chains, and crowded words
    assert result(S.spelling(frame(spark, rows), S.ODD)) == want
    assert result(S.spelling(frame(spark, rows))) == brute(rows, odd=None)


def test_every_third_run_loses_a_letter(spark):
    rows = [(i, "Planting PLANTING planted, planter's ÉLÈVES-élèves x×÷x") for i in range(60)]
    words = S.occurrences(frame(spark, rows), 3)
    assert result(S.variants(S.vocabulary(words))) == brute(rows, odd=3)


def test_null_empty_long_repeated_and_no_rows(spark):
    # nine occurrences of words of 300 letters that differ within, before and behind the border of WHOLE
    long = "ab" * 150
    others = [long[:10] + "z" + long[11:], long[:-3] + "z" + long[-2:], long + "q", long[1:]]
    rows = [(None, "letters letterz " * 6), (None, None), (1, None), (2, ""), (3, " \n1"), (5, "letters " * 40), (5, "letters " * 40),
            *[(i, " ".join([long] * 30 + others)) for i in range(6, 15)], (20, "longer " * 200_000), (21, "x" * 500_000)]
    want = brute(rows)
    assert {r[0] for r in want} >= {"letters", "letterz", long, *others}
    assert result(S.spelling(frame(spark, rows), S.ODD)) == want
    assert result(S.spelling(frame(spark, [(1, None)]), S.ODD)) == result(S.spelling(frame(spark, [(1, "x")]).limit(0), S.ODD)) == []
