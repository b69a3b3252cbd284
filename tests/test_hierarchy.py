import pytest

from tenantmart.operators import hierarchy as H


def brute(links):
    out = []
    for n in links:
        at, d = links[n], 1
        while at is not None and at in links:
            out.append((n, at, d))
            at, d = links[at], d + 1
    return sorted(out)


def closure(df, **kw):
    return sorted(map(tuple, H.ancestors(df, "id", "parent", **kw).collect()))


def test_forest_with_odd_rows(spark):
    links = {i: (i - 1) // 3 if i else None for i in range(60)} | {100: 999, 101: 100, 200: None}
    rows = [(n, p, "x") for n, p in links.items()]
    df = spark.createDataFrame(rows + rows[:5] + [(None, 3, "y"), (None, None, "y"), (59, 40, "second parent, larger")], "id long, parent long, node string")
    assert closure(df) == brute(links)
    assert closure(df.limit(0)) == []
    assert H.cycle_nodes(df, "id", "parent").count() == 0


def test_chain_of_a_thousand(spark, monkeypatch):
    written = []
    keep = H._written
    monkeypatch.setattr(H, "_written", lambda df: written.append(1) or keep(df))
    df = spark.range(1_000).selectExpr("id", "nullif(id, 0) - 1 AS parent")
    got = H.ancestors(df, "id", "parent")
    assert got.count() == 1_000 * 999 // 2 and got.where("node - ancestor <> distance").isEmpty()
    assert len(written) <= 2 * 10 + 14           # rounds follow the logarithm of the chain


@pytest.mark.parametrize("length", [1, 2, 3, 7, 16])
def test_cycles_are_found_and_cut(spark, length):
    ring = [(i, (i + 1) % length) for i in range(length)]
    tail = [(100, 0), (101, 100), (102, 101), (200, None), (201, 200)]
    df = spark.createDataFrame(ring + tail, "id long, parent long")
    with pytest.raises(H.HierarchyCycle) as e:
        H.ancestors(df, "id", "parent")
    assert sorted(r.node for r in e.value.nodes.collect()) == list(range(length))
    assert closure(df, on_cycle="cut") == brute({i: None for i in range(length)} | dict(tail))
