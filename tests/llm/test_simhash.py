import random
import re

import pytest

pytest.importorskip("xxhash")
import xxhash  # noqa: E402

from tenantmart.llm import components, simhash  # noqa: E402


def brute_print(text, k=3):
    words = re.findall("[^ \t-\r]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    grams = [" ".join(words[i:i + k]) for i in range(len(words) - k + 1)] or ([" ".join(words)] if words else [])
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute(rows, radius=3):
    prints = [brute_print(t) for _, t in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= radius and group[i] != group[j]:
                a, b = group[i], group[j]
                group = [b if g == a else g for g in group]
    out = []
    for (d, _), f, g in zip(rows, prints, group):
        out.append((d, f"{f:016x}", min((rows[i][0] for i in range(len(rows)) if group[i] == g and rows[i][0] is not None), default=None)))
    return sorted(out, key=str)


def corpus():
    rng = random.Random(7)
    vocab = [f"w{i}é" if i % 9 == 0 else f"W{i}" for i in range(300)]
    rows = []
    for i in range(60):
        base = [rng.choice(vocab) for _ in range(rng.randint(1, 400))]
        rows.append((i * 10 + 9, " ".join(base)))
        for k in range(rng.randint(0, 4)):
            copy = base[:]
            for _ in range(rng.randint(0, 1 + len(base) // 60)):
                copy[rng.randrange(len(copy))] = rng.choice(vocab)
            rows.append((i * 10 + k, "\t".join(copy)))
    rows += [(9001, None), (9000, ""), (9002, " \n"), (9003, "one"), (9004, "ONE"), (9005, "one two"), (None, "one two"), (9005, "one two"),
             (9006, "a\xa0b c d"), (9007, "Ä ä É"), (None, "alone here now"), (None, "alone here now"), (9008, "long " * 200_000)]
    rng.shuffle(rows)
    return rows


def test_components_equal_brute_force(spark):
    rows = corpus()
    df = spark.createDataFrame([(t, "f", "s", i) for i, t in rows], "text string, fp string, shard string, doc_id long").repartition(4)
    assert len({r[2] for r in brute(rows)}) < len({r[1] for r in brute(rows)})
    for shard in (2000, 3):        # the small bound cuts shards to the last level
        assert sorted(map(tuple, simhash.simhash_groups(df, shard=shard).collect()), key=str) == brute(rows)
    kept = simhash.simhash_dedup(df).collect()
    assert sorted(r.doc_id for r in kept if r.doc_id is not None) == sorted({r[2] for r in brute(rows) if r[2] is not None})
    assert sum(r.doc_id is None for r in kept) == 1
    assert kept[0].__fields__ == df.columns


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.simhash_groups(df).count() == 0
    assert simhash.simhash_dedup(df).count() == 0


def test_tree_finds_all_within_radius():
    rng = random.Random(1)
    seeds = [rng.getrandbits(64) for _ in range(20)]
    values = list({s ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 6))) for s in seeds for _ in range(30)})
    tree = simhash.BkTree()
    for v in values:
        tree.add(v)
    for q in values[:200]:
        assert sorted(tree.values[i] for i in tree.within(q, 3)) == sorted(v for v in values if (v ^ q).bit_count() <= 3)


@pytest.mark.parametrize("radius", [0, 1, 2, 5])
def test_other_radii(spark, radius):
    rng = random.Random(radius)
    seeds = [rng.getrandbits(64) for _ in range(15)]
    values = list({s ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, radius + 1))) for s in seeds for _ in range(4)})
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    df = spark.createDataFrame([(v,) for v in signed], "fp long")
    star = {r.a: r.b for r in components.stars(simhash.links(df, radius, shard=2)).collect()}
    for i, a in enumerate(values):
        for j, b in enumerate(values[:i]):
            if (a ^ b).bit_count() <= radius:
                assert star.get(signed[i], signed[i]) == star.get(signed[j], signed[j])


def test_long_chain_of_links(spark):
    df = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (5, 5)], "a long, b long")
    found = {(r.a, r.b) for r in components.stars(df).collect()}
    assert found == {(i, 0) for i in range(1, 61)} | {(101, 100)}
