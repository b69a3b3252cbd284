import uuid

import pytest

from pyspark.sql import functions as F

from tenantmart.operators import load as L
from tenantmart.schema import TABLES


@pytest.fixture()
def wh(spark):
    return L.Warehouse(spark, f"t_{uuid.uuid4().hex[:10]}")


def _key(r):
    return tuple((x is not None, x if x is not None else 0) for x in r)


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=_key)


def test_full_replace_takes_new_schema(spark, wh):
    wh.publish(spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k int, v string"), "t")
    new = spark.createDataFrame([(1, "x", 1.0), (2, "y", 2.0)], "k int, v string, w double")
    assert L.load_full_replace(new, wh, "t").status == "loaded"
    out = wh.read("t")
    assert out.columns == ["k", "v", "w"] and _rows(out) == [(1, "x", 1.0), (2, "y", 2.0)]


def test_truncate_insert_aligns_by_name_and_keeps_schema(spark, wh):
    wh.publish(spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k bigint, v string"), "t")
    src = spark.createDataFrame([("x", 1), ("y", 2)], "v string, k int")
    L.load_truncate_insert(src, wh, "t")
    out = wh.read("t")
    assert out.dtypes == [("k", "bigint"), ("v", "string")]
    assert _rows(out) == [(1, "x"), (2, "y")]
    with pytest.raises(L.LoadError):
        L.load_truncate_insert(spark.createDataFrame([(1,)], "k int"), wh, "t")
    with pytest.raises(L.LoadError):
        L.load_truncate_insert(src, wh, "missing_table")


def test_upsert_semantics(spark, wh):
    wh.publish(spark.createDataFrame([(1, "a", 7), (None, "x", 8), (3, "c", 9)],
                                     "k int, v string, id_client int"), "t")
    src = spark.createDataFrame([(1, None), (2, "b"), (None, "y")], "k int, v string")
    L.load_upsert(src, wh, "t", ["k"])
    assert _rows(wh.read("t")) == sorted(
        [(1, None, 7), (2, "b", None), (None, "x", 8), (None, "y", None), (3, "c", 9)],
        key=_key)
    # twice = once for keyed rows; a NULL key never matches, so it is inserted again
    L.load_upsert(src, wh, "t", ["k"])
    assert wh.read("t").where("k IS NOT NULL").count() == 3
    assert wh.read("t").where("k IS NULL").count() == 3


def test_upsert_rejects_duplicate_source_keys_and_keeps_target(spark, wh):
    wh.publish(spark.createDataFrame([(1, "a")], "k int, v string"), "t")
    dup = spark.createDataFrame([(1, "a"), (1, "b")], "k int, v string")
    with pytest.raises(L.LoadError):
        L.load_upsert(dup, wh, "t", ["k"])
    assert _rows(wh.read("t")) == [(1, "a")]


def test_empty_source_keeps_target_or_truncates(spark, wh):
    wh.publish(spark.createDataFrame([(1,), (2,), (3,)], "k int"), "t")
    empty = spark.createDataFrame([], "k int")
    assert L.load_truncate_insert(empty, wh, "t").status == "skipped_empty"
    assert wh.read("t").count() == 3
    L.load_truncate_insert(empty, wh, "t", on_empty="truncate")
    assert wh.read("t").count() == 0


def test_ensure_tables_report_and_idempotence(spark, wh):
    rep = {r.table_name: r.action for r in L.ensure_tables(wh, TABLES.values()).collect()}
    assert set(rep.values()) == {"created"} and len(rep) == 16
    rep2 = {r.table_name: r.action for r in L.ensure_tables(wh, TABLES.values()).collect()}
    assert set(rep2.values()) == {"skipped"}
    assert wh.read("fact_labour").columns == TABLES["fact_labour"].names


def test_add_column_if_missing(spark, wh):
    wh.publish(spark.createDataFrame([(1,)], "k int"), "t")
    assert wh.add_column_if_missing("t", "id_client", "int") is True
    assert wh.add_column_if_missing("t", "ID_CLIENT", "int") is False
    assert wh.read("t").columns == ["k", "id_client"]


def test_upsert_with_explicit_dedupe_order(spark, wh):
    wh.publish(spark.createDataFrame([(1, "a", 0)], "k int, v string, ts int"), "t")
    src = spark.createDataFrame([(1, "old", 1), (1, "new", 2), (2, "x", 5), (2, "y", 5)],
                                "k int, v string, ts int")
    L.load_upsert(src, wh, "t", ["k"], dedupe_order="ts")
    assert _rows(wh.read("t")) == [(1, "new", 2), (2, "y", 5)]


def test_dry_run_creates_nothing_and_create_like(spark, wh):
    rep = L.ensure_tables(wh, [TABLES["dim_staff"]], dry_run=True).collect()
    assert rep[0].action == "created" and not wh.exists("dim_staff")
    like = spark.createDataFrame([(1, "a")], "k int, v string")
    wh.create_like("t2", like)
    assert wh.read("t2").dtypes == like.dtypes and wh.read("t2").count() == 0


def test_upsert_rewrites_only_touched_partitions(spark, wh):
    tgt = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (2, 1, "c")],
                                "k int, id_client int, v string")
    wh.publish(tgt.select("k", "v", "id_client"), "p", partition_by=("id_client",))
    before = {r.k for r in wh.read("p").where("id_client = 2").select("k").collect()}
    src = spark.createDataFrame([(1, 1, "A"), (3, 1, "new")], "k int, id_client int, v string")
    L.load_upsert(src, wh, "p", ["id_client", "k"])
    rows = sorted((r.id_client, r.k, r.v) for r in wh.read("p").collect())
    assert rows == [(1, 1, "A"), (1, 2, "c"), (1, 3, "new"), (2, 1, "b")]
    assert {r.k for r in wh.read("p").where("id_client = 2").collect()} == before
    assert wh.partition_columns("p") == ["id_client"]


def _partitioned(spark, wh):
    wh.publish(spark.createDataFrame([(1, "a", "x"), (2, "b", "y"), (3, "c", None)], "k int, v string, p string"),
               "p", partition_by=("p",))


def test_every_mode_keeps_a_partitioned_table_whole(spark, wh):
    """Partition column outside the key: the whole table is rewritten, every partition with it."""
    _partitioned(spark, wh)
    L.load_upsert(spark.createDataFrame([(1, "A", "y"), (4, "d", "it's/50%")], "k int, v string, p string"), wh, "p", ["k"])
    assert _rows(wh.read("p").select("k", "v", "p")) == _rows(spark.createDataFrame(
        [(1, "A", "y"), (2, "b", "y"), (3, "c", None), (4, "d", "it's/50%")], "k int, v string, p string"))
    L.load_truncate_insert(spark.createDataFrame([("q", 9, "n")], "p string, k int, v string"), wh, "p")
    assert _rows(wh.read("p").select("k", "v", "p")) == [(9, "n", "q")] and wh.partition_columns("p") == ["p"]
    L.load_full_replace(spark.createDataFrame([("q", 8, 1.0), ("r", 9, 2.0)], "p string, k int, w double"), wh, "p")
    assert _rows(wh.read("p").select("k", "w", "p")) == [(8, 1.0, "q"), (9, 2.0, "r")] and wh.partition_columns("p") == ["p"]
    L.load_truncate_insert(spark.createDataFrame([], "p string, k int, w double"), wh, "p", on_empty="truncate")
    assert wh.read("p").count() == 0


def test_upsert_scans_only_touched_partitions(spark, wh):
    wh.publish(spark.range(20).selectExpr("id AS k", "id * 10 AS v", "cast(id % 20 as int) AS p"), "t", partition_by=("p",))
    seen = []
    keep = L.upsert_frame

    def spy(target, source, keys):
        seen.append(target._jdf.queryExecution().executedPlan().toString())
        return keep(target, source, keys)
    L.upsert_frame = spy
    try:
        L._load_keyed(spark.createDataFrame([(3, -1, 3), (99, -2, 3)], "k long, v long, p int"), wh, "t", ["k", "p"], "keep", "raise", "upsert", lambda s: s, spy)
    finally:
        L.upsert_frame = keep
    assert "PartitionFilters: [isnotnull(p" in seen[0] or "PartitionFilters: [(p" in seen[0]
    assert wh.read("t").count() == 21 and wh.read("t").where("v < 0").count() == 2


def test_null_partition_is_touched_too(spark, wh):
    _partitioned(spark, wh)
    L.load_replace_keys(spark.createDataFrame([(3, "C", None), (3, "CC", None)], "k int, v string, p string"), wh, "p", ["k", "p"])
    assert _rows(wh.read("p").select("k", "v")) == [(1, "a"), (2, "b"), (3, "C"), (3, "CC")]


def test_lost_values_raise_or_are_reported(spark, wh):
    wh.publish(spark.createDataFrame([(1,)], "k int"), "t")
    bad = spark.createDataFrame([("abc",), ("2",), (None,)], "k string")
    with pytest.raises(L.LoadError, match="'k': 1"):
        L.load_truncate_insert(bad, wh, "t")
    assert _rows(wh.read("t")) == [(1,)]
    res = L.load_truncate_insert(bad, wh, "t", on_loss="report")
    assert res.losses == {"k": 1} and res.rows == 3
    assert _rows(wh.read("t")) == [(None,), (None,), (2,)]


def test_over_long_text_raises(spark, wh):
    path = wh._version_path("v")
    spark.sql(f"CREATE TABLE {wh.name('v')} (a varchar(3)) USING parquet LOCATION '{path}'")
    with pytest.raises(L.LoadError):
        L.load_truncate_insert(spark.createDataFrame([("1234567",)], "a string"), wh, "v")
    assert L.load_truncate_insert(spark.createDataFrame([("123",)], "a string"), wh, "v").rows == 1
    with pytest.raises(L.LoadError):
        L.load_upsert(spark.createDataFrame([("1234567",)], "a string"), wh, "v", ["a"])
    L.load_upsert(spark.createDataFrame([("abc",)], "a string"), wh, "v", ["a"])
    assert wh.text_lengths("v") == {"a": 3} and _rows(wh.read("v")) == [("123",), ("abc",)]


@pytest.mark.parametrize("mode", ["replace", "truncate", "upsert", "keys"])
def test_source_is_evaluated_once(spark, wh, mode):
    wh.publish(spark.createDataFrame([(1, 1)], "k long, v long"), "t")
    acc = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            acc.add(len(b))
            yield b
    src = spark.range(50).selectExpr("id AS k", "id AS v").mapInPandas(count, "k long, v long")
    {"replace": lambda: L.load_full_replace(src, wh, "t"), "truncate": lambda: L.load_truncate_insert(src, wh, "t"),
     "upsert": lambda: L.load_upsert(src, wh, "t", ["k"]), "keys": lambda: L.load_replace_keys(src, wh, "t", ["k"])}[mode]()
    assert acc.value == 50 and wh.read("t").count() == 50


def test_replace_keys_twice_is_once(spark, wh):
    wh.publish(spark.createDataFrame([(1, "old"), (2, "keep"), (None, "old")], "k int, v string"), "t")
    src = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (None, "n")], "k int, v string")
    for _ in range(2):
        L.load_replace_keys(src, wh, "t", ["k"])
        assert _rows(wh.read("t")) == _rows(spark.createDataFrame(
            [(1, "a"), (1, "a"), (1, "b"), (None, "n"), (2, "keep")], "k int, v string"))


class Failing:
    """A session whose n-th catalog statement fails."""

    def __init__(self, spark, at):
        self.spark, self.at, self.seen = spark, at, 0

    def sql(self, text):
        if text.split()[0] in ("CREATE", "ALTER", "DROP", "MSCK"):
            self.seen += 1
            if self.seen == self.at:
                raise ConnectionError(text)
        return self.spark.sql(text)

    def __getattr__(self, name):
        return getattr(self.spark, name)


@pytest.mark.parametrize("kind", ["declared", "partitioned", "other_schema", "upsert", "plain", "some_partitions", "buckets"])
def test_a_failure_at_any_catalog_call_leaves_a_complete_table(spark, kind):
    from tenantmart.schema import Col, Table
    old, new = [(1, "a"), (2, "b")], [(3, "c"), (4, "d"), (5, "e")]
    frame = lambda rows: spark.createDataFrame(rows, "k int, v string")
    for at in range(1, 20):
        wh = L.Warehouse(spark, f"f_{uuid.uuid4().hex[:10]}")
        if kind == "declared":
            wh.create_empty(Table("t", (Col("k", "int"), Col("v", "varchar(3)"))))
            L.load_truncate_insert(frame(old), wh, "t")
        elif kind == "plain":
            spark.sql(f"CREATE TABLE {wh.name('t')} (k int, v varchar(3)) USING parquet LOCATION '{wh._version_path('t')}'")
            spark.sql(f"INSERT INTO {wh.name('t')} VALUES (1, 'a'), (2, 'b')")
        elif kind == "buckets":
            wh.publish(frame(old), "t", layout=L.Layout(("k",), 4))
        else:
            wh.publish(frame(old), "t", partition_by=("v",) if kind in ("partitioned", "some_partitions") else ())
        wh.spark = Failing(spark, at)
        merged = [*old, *new] if kind in ("upsert", "some_partitions", "buckets") else new
        try:
            if kind == "other_schema":
                L.load_full_replace(frame(new).withColumn("more", F.lit(1)), wh, "t")
            elif kind in ("upsert", "some_partitions", "buckets"):
                L.load_upsert(frame(new), wh, "t", ["k"] if kind != "some_partitions" else ["v", "k"])
            else:
                L.load_truncate_insert(frame(new), wh, "t")
        except ConnectionError:
            failed = True
        else:
            failed = False
        got = sorted((r.k, r.v) for r in spark.table(wh.name("t")).collect())
        assert got in (old, merged), (kind, at, got)
        if kind in ("declared", "plain"):
            wh.spark = spark
            assert wh.text_lengths("t") == {"v": 3}
        if not failed:
            assert got == merged and at > 2
            break
    else:
        raise AssertionError("never got through")


def _files(wh, table):
    return {f for f in wh.read_version(table).inputFiles()}


def test_layout_by_key_hash_follows_the_delta(spark, wh):
    """The first keyed load lays the table out; the next ones read and write the buckets of their own keys."""
    n = 4_000
    wh.publish(spark.range(n).selectExpr("id AS k", "id * 10 AS v", "7 AS id_client"), "t")
    first = spark.range(10).selectExpr("id AS k", "-1L AS v")
    L.load_upsert(first, wh, "t", ["k"], rows_per_bucket=50)
    layout = wh.layout("t")
    assert layout == L.Layout(("k",), 128) and wh.columns("t") == ["k", "v", "id_client"] and wh.partition_columns("t") == []
    before = _files(wh, "t")
    seen = []

    def spy(target, source, keys):
        seen.append(target._jdf.queryExecution().executedPlan().toString())
        return L.upsert_frame(target, source, keys)
    delta = spark.createDataFrame([(5, 55), (n + 1, 1), (n + 2, 2)], "k long, v int")
    L._load_keyed(delta, wh, "t", ["k"], "keep", "raise", "upsert", lambda s: s, spy)
    assert "PartitionFilters: [" in seen[0] and "_key_bucket" in seen[0].split("PartitionFilters: [")[1].split("]")[0]
    touched = {r[0] for r in delta.select(layout.bucket()).distinct().collect()}
    after = _files(wh, "t")
    changed = {f.split("_key_bucket=")[1].split("/")[0] for f in before ^ after}
    assert changed == {str(b) for b in touched} and len(before & after) >= 100
    got = {r.k: (r.v, r.id_client) for r in wh.read("t").collect()}
    want = {k: ((-1 if k < 10 else k * 10), 7) for k in range(n)} | {5: (55, 7), n + 1: (1, None), n + 2: (2, None)}
    assert got == want
    assert wh.layout("t") == layout


def test_layout_keeps_null_keys_and_replaces_by_key(spark, wh):
    rows = [(None, 1, "x"), (1, None, "y"), (1, 2, "z"), (3, 4, "w")]
    wh.publish(spark.createDataFrame(rows, "a int, b int, v string"), "t", layout=L.Layout(("a", "b"), 8))
    src = spark.createDataFrame([(None, 1, "new"), (1, 2, "Z"), (1, 2, "ZZ"), (9, 9, "q")], "a int, b int, v string")
    for _ in range(2):
        L.load_replace_keys(src, wh, "t", ["a", "b"])
        assert _rows(wh.read("t")) == _rows(spark.createDataFrame(
            [(None, 1, "new"), (1, None, "y"), (1, 2, "Z"), (1, 2, "ZZ"), (3, 4, "w"), (9, 9, "q")], "a int, b int, v string"))
    L.load_upsert(spark.createDataFrame([(None, 1, "more"), (3, 4, None)], "a int, b int, v string"), wh, "t", ["a", "b"])
    assert wh.read("t").where("a IS NULL").count() == 2 and wh.read("t").where("a = 3 AND v IS NULL").count() == 1
    # columns are added behind the hidden one; whole loads drop the layout
    wh.add_column_if_missing("t", "w", "double")
    assert wh.columns("t") == ["a", "b", "v", "w"] and wh.read("t").count() == 7
    L.load_truncate_insert(src.withColumn("w", F.lit(1.5)), wh, "t")
    assert wh.layout("t") is None and wh.read("t").count() == 4


def test_more_touched_partitions_than_are_listed(spark, wh, monkeypatch):
    monkeypatch.setattr(L, "MAX_LISTED", 3)
    wh.publish(spark.range(40).selectExpr("id AS k", "'old' AS v", "cast(nullif(id % 20, 19) as int) AS p"), "t", partition_by=("p",))
    before = _files(wh, "t")
    L.load_replace_keys(spark.range(10).selectExpr("id AS k", "'new' AS v", "cast(nullif(id, 9) as int) AS p"), wh, "t", ["k", "p"])
    assert wh.read("t").where("v = 'new'").count() == 10 and wh.read("t").count() == 41
    assert all("p=%d/" % p not in f for f in before ^ _files(wh, "t") for p in range(10, 19))


def test_a_table_made_elsewhere_takes_partition_loads(spark, wh):
    spark.sql(f"CREATE TABLE {wh.name('u')} (k bigint) USING parquet")
    spark.sql(f"INSERT INTO {wh.name('u')} VALUES (1), (2)")
    L.load_truncate_insert(spark.createDataFrame([(5,)], "k long"), wh, "u")
    assert _rows(wh.read("u")) == [(5,)]
    spark.sql(f"CREATE TABLE {wh.name('t')} (k bigint, p int) USING parquet PARTITIONED BY (p)")
    spark.sql(f"INSERT INTO {wh.name('t')} VALUES (1, 1), (2, 2)")
    L.load_upsert(spark.createDataFrame([(1, 1), (5, 1)], "k long, p int"), wh, "t", ["k", "p"])
    assert _rows(wh.read("t")) == [(1, 1), (2, 2), (5, 1)]


def _declared(spec):
    from tenantmart.schema import Table, _cols
    return Table("t", _cols(spec), ())


def _ensured(wh, spec, **kw):
    r = L.ensure_tables(wh, [_declared(spec)], **kw).first()
    return r.action, r.changes


@pytest.mark.parametrize("how", ["plain", "partitioned", "layout", "elsewhere"])
def test_bootstrap_alters_existing_tables(spark, wh, how):
    rows = spark.createDataFrame([(i, f"v{i}", i % 3) for i in range(30)], "k int, v string, p int")
    if how == "elsewhere":
        rows.write.saveAsTable(wh.name("t"))
    else:
        wh.publish(rows, "t", partition_by=("p",) if how == "partitioned" else None,
                   layout=L.Layout(("k",), 4) if how == "layout" else None)
    files = set(wh.read("t").inputFiles())
    assert _ensured(wh, "k int, p int, v varchar(3), w double", dry_run=True) == ("altered", "+w double, v string -> varchar(3)")
    assert wh.columns("t") == ["k", "v", "p"]
    assert _ensured(wh, "k int, p int, v varchar(3), w double") == ("altered", "+w double, v string -> varchar(3)")
    assert _ensured(wh, "k int, p int, v varchar(3), w double") == ("skipped", None)
    assert wh.text_lengths("t") == {"v": 3} and dict(wh.read("t").dtypes)["w"] == "double"
    assert (set(wh.read("t").inputFiles()) == files) == (how != "elsewhere")      # no row was written
    assert _ensured(wh, "K bigint, v varchar(9)") == ("altered", "k int -> bigint, v varchar(3) -> varchar(9)")
    assert dict(wh.read("t").dtypes)["k"] == "bigint" and wh.text_lengths("t") == {"v": 9}
    want = [(i, f"v{i}", i % 3, None) for i in range(30)]
    assert sorted((r.k, r.v, r.p, r.w) for r in wh.read("t").collect()) == want
    assert wh.partition_columns("t") == (["p"] if how == "partitioned" else [])
    L.load_upsert(spark.createDataFrame([(1, "new")], "k long, v string"), wh, "t", ["k"])
    assert wh.read("t").where("v = 'new'").count() == 1 and wh.read("t").count() == 30


def test_bootstrap_reports_what_it_cannot_alter(spark, wh):
    wh.publish(spark.createDataFrame([(1, "long text", 2**60)], "k int, v string, n bigint"), "t")
    for spec in ("k string", "n int", "n double", "v varchar(4)", "k date"):
        r = L.ensure_tables(wh, [_declared(spec + ", x int"), TABLES["dim_staff"]], dry_run=False).collect()
        assert r[0].action == "error" and r[0].error and r[1].action in ("created", "skipped")
    assert wh.read("t").dtypes == [("k", "int"), ("v", "string"), ("n", "bigint")]
    assert L.ensure_tables(wh, [_declared("k bigint")], alter=False).first().action == "skipped"
    assert L.ensure_tables(wh, [_declared("k bigint")], replace_existing=True).first().action == "replaced"


def test_widening_keeps_values():
    assert L.widens("int", "bigint") and L.widens("int", "double") and L.widens("decimal(5,2)", "decimal(9,3)")
    assert not any(L.widens(*p) for p in [("bigint", "double"), ("double", "float"), ("decimal(5,2)", "decimal(6,4)"), ("int", "string")])
