import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

from tenantmart.operators import tenants as T
from tenantmart.operators.load import Warehouse

REG = "id_client int, client_name string, database_name string, schema_name string, " \
      "status string, created_at timestamp"


def _registry(spark):
    now = dt.datetime(2024, 1, 1)
    return spark.createDataFrame([
        (1, "T1", "central", "TEN_1", "Active", now),
        (2, "T2", "central", "TEN_2", "Active", now),
        (2, "T2b", "central", "TEN_2B", "Active", now)], REG)


def _found(spark):
    return spark.createDataFrame([(s,) for s in ["TEN_1", "TEN_2", "TEN_2B", "TENX9", "OTHER",
                                                 "INFORMATION_SCHEMA"]], "schema_name string")


def test_registry_sync_adds_new_once(spark):
    once = T.registry_sync(_registry(spark), _found(spark), "central")
    new = sorted((r.schema_name, r.id_client) for r in once.where("id_client > 2").collect())
    assert new == [("OTHER", 3), ("TENX9", 4)]
    twice = T.registry_sync(once, _found(spark), "central")
    assert twice.count() == once.count() == 5


def test_registry_dedupe_smallest_schema_wins(spark):
    d = {r.id_client: r.schema_name for r in T.registry_dedupe(_registry(spark)).collect()}
    assert d == {1: "TEN_1", 2: "TEN_2"}
    assert [r.schema_name for r in T.registry_conflicts(_registry(spark)).collect()] == ["TEN_2B"]


def test_select_uses_sql_like_underscore_wildcard(spark):
    reg = T.registry_sync(_registry(spark), _found(spark), "central")
    got = sorted(r.schema_name for r in T.select_tenants(reg, _found(spark), "TEN_%").collect())
    assert got == sorted(["TEN_1", "TEN_2", "TENX9"])  # TEN_2B loses the id-2 de-duplication


def test_tag_and_default(spark):
    df = spark.createDataFrame([(1,)], "k int")
    assert T.tag_tenant(df, 5).first().id_client == 5
    tagged = df.withColumn("id_client", F.lit(9))
    assert T.tag_tenant_default(tagged, 5).first().id_client == 9
    assert T.tenant_id_of(_registry(spark), "central") == 1


def test_merge_is_incremental(spark):
    central = Warehouse(spark, f"c_{uuid.uuid4().hex[:10]}")
    a = spark.createDataFrame([(1, "x"), (2, "y")], "k int, v string")
    b = spark.createDataFrame([(3,)], "k int")                                  # lacks v
    c = spark.createDataFrame([(4, "z", 40)], "k int, v string, id_client int")  # own ids
    r1 = T.merge_tenants(central, "t", {1: a})
    assert r1.merged == [1]
    r2 = T.merge_tenants(central, "t", {1: a, 2: b, 3: c})
    assert r2.skipped == [1] and r2.merged == [2, 3]
    rows = sorted((tuple(r) for r in T.merged_rows(central, "t").collect()),
                  key=lambda r: tuple((x is not None, x if x is not None else "") for x in r))
    assert rows == [(1, "x", 1), (2, "y", 1), (3, None, 2), (4, "z", 40)]
    r3 = T.merge_tenants(central, "t", {1: a, 2: b})
    assert r3.merged == [] and central.read("t").count() == 4
    assert T.tenant_view(central.read("t"), 2).count() == 1


def test_merge_ledger_is_by_source(spark):
    """A source with ids of its own is merged once, also when they are
    another tenant's; a refresh replaces what the same source brought."""
    central = Warehouse(spark, f"c_{uuid.uuid4().hex[:10]}")
    own = spark.createDataFrame([(1, 77)], "k int, id_client int")
    clash = spark.createDataFrame([(2, 2), (3, None)], "k int, id_client int")    # tenant 1 writes id 2
    two = spark.createDataFrame([(4,)], "k int")
    for _ in range(2):
        T.merge_tenants(central, "t", {5: own})
        T.merge_tenants(central, "t", {1: clash})
        T.merge_tenants(central, "t", {1: clash, 2: two, 5: own})
    rows = sorted(tuple(r) for r in T.merged_rows(central, "t").fillna(-1).collect())
    assert rows == [(1, 77), (2, 2), (3, -1), (4, 2)]
    assert T.merged_tenants(central, "t") == [1, 2, 5]
    T.merge_tenants(central, "t", {1: spark.createDataFrame([(9, 4)], "k int, id_client int")}, refresh=True)
    rows = sorted(tuple(r) for r in T.merged_rows(central, "t").collect())
    assert rows == [(1, 77), (4, 2), (9, 4)]


def test_merge_raises_on_lost_values(spark):
    from tenantmart.operators.load import LoadError
    central = Warehouse(spark, f"c_{uuid.uuid4().hex[:10]}")
    T.merge_tenants(central, "t", {1: spark.createDataFrame([(1,)], "k int")})
    with pytest.raises(LoadError):
        T.merge_tenants(central, "t", {2: spark.createDataFrame([("abc",)], "k string")})
    assert T.merged_rows(central, "t").count() == 1 and T.merged_tenants(central, "t") == [1]


def test_refresh_through_merge_schemas(spark):
    t1, central = (Warehouse(spark, f"{n}_{uuid.uuid4().hex[:8]}") for n in "tc")
    t1.publish(spark.createDataFrame([(1,), (2,)], "k int"), "x")
    T.merge_schemas(central, {1: t1}, ["x"])
    t1.publish(spark.createDataFrame([(3,)], "k int"), "x")
    assert T.merge_schemas(central, {1: t1}, ["x"]) == [("x", 1, "skipped")]
    assert T.merge_schemas(central, {1: t1}, ["x"], refresh=True) == [("x", 1, "refreshed")]
    assert [r.k for r in T.merged_rows(central, "x").collect()] == [3]


def test_tag_tables_keeps_partitioning(spark):
    wh = Warehouse(spark, f"t_{uuid.uuid4().hex[:8]}")
    wh.publish(spark.createDataFrame([(1, "a"), (2, "b")], "k int, p string"), "x", partition_by=("p",))
    T.tag_tables(wh, 6, ["x"])
    assert wh.partition_columns("x") == ["p"]
    assert sorted((r.k, r.p, r.id_client) for r in wh.read("x").collect()) == [(1, "a", 6), (2, "b", 6)]


def test_merge_refresh_overwrites_only_that_tenant(spark):
    central = Warehouse(spark, f"c_{uuid.uuid4().hex[:10]}")
    a = spark.createDataFrame([(1, "x")], "k int, v string")
    b = spark.createDataFrame([(2, "y")], "k int, v string")
    T.merge_tenants(central, "t", {1: a, 2: b})
    assert central.partition_values("t", "id_client") == [1, 2]
    a2 = spark.createDataFrame([(10, "x2"), (11, "x3")], "k int, v string")
    T.merge_tenants(central, "t", {1: a2}, refresh=True)
    rows = sorted((r.k, r.id_client) for r in T.merged_rows(central, "t").collect())
    assert rows == [(2, 2), (10, 1), (11, 1)]


def test_tag_tables_and_merge_schemas(spark):
    from tenantmart.plans import merge_tables
    assert len(merge_tables()) == 9 and "dim_calendar" in merge_tables()
    t1 = Warehouse(spark, f"t1_{uuid.uuid4().hex[:8]}")
    t2 = Warehouse(spark, f"t2_{uuid.uuid4().hex[:8]}")
    t1.publish(spark.createDataFrame([(1, "a")], "k int, v string"), "x")
    t2.publish(spark.createDataFrame([(2, "b")], "k int, v string"), "x")
    t2.publish(spark.createDataFrame([(3,)], "k int"), "y")
    assert T.tag_tables(t1, 1, ["x", "y"]) == {"x": "tagged", "y": "missing"}
    assert T.tag_tables(t1, 5, ["x"], only_if_missing=True) == {"x": "kept"}
    assert t1.read("x").first().id_client == 1
    reg = _registry(spark)
    try:
        T.tag_tables_from_registry(t2, reg, "unknown_db", ["x"])
        raise AssertionError("expected KeyError")
    except KeyError:
        pass
    central = Warehouse(spark, f"c_{uuid.uuid4().hex[:8]}")
    rep = T.merge_schemas(central, {1: t1, 2: t2}, ["x", "y"])
    assert sorted(rep) == [("x", 1, "merged"), ("x", 2, "merged"), ("y", 1, "missing"),
                           ("y", 2, "merged")]
    assert sorted((r.k, r.id_client) for r in T.merged_rows(central, "x").collect()) == [(1, 1), (2, 2)]
    again = T.merge_schemas(central, {1: t1, 2: t2}, ["x"])
    assert sorted(again) == [("x", 1, "skipped"), ("x", 2, "skipped")]


class _Counted:
    """A session whose SQL statements are counted."""

    def __init__(self, spark):
        self._spark, self.statements = spark, []

    def sql(self, text, *a, **kw):
        self.statements.append(text)
        return self._spark.sql(text, *a, **kw)

    def __getattr__(self, name):
        return getattr(self._spark, name)


def test_two_thousand_tenants_are_one_scan_and_few_statements(spark, tmp_path):
    n = 2_000
    base = str(tmp_path / "all")
    rows = spark.range(3 * n).selectExpr("id AS k", "concat('v', id) AS v", f"cast(id % {n} AS int) AS t")
    rows.repartition(1).sortWithinPartitions("t").write.partitionBy("t").parquet(base)
    schema = spark.createDataFrame([], "k long, v string").schema
    folders = {t: T.Folder(f"{base}/t={t}", schema) for t in range(n)}
    scans = T._scan(spark, folders, schema)
    assert len(scans) == 1
    plan = scans[0]._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 1 and "Union" not in plan
    counted = _Counted(spark)
    central = Warehouse(counted, f"c_{uuid.uuid4().hex[:8]}")
    counted.statements.clear()
    assert T.merge_folders(central, "t", folders).merged == list(range(n))
    assert len(counted.statements) <= 20 + n // 500, len(counted.statements)
    merged = spark.table(central.name("t"))
    assert merged.count() == 3 * n
    assert merged.where(f"id_client <> k % {n} OR source_tenant <> id_client OR v <> concat('v', k)").count() == 0
    assert T.merge_folders(central, "t", folders).skipped == list(range(n))


def test_folders_of_unlike_schemas_and_none(spark, tmp_path):
    """Own ids, a missing column, a table never filled, two tenants of one folder, and a path that a URI spells otherwise."""
    def put(name, rows, schema):
        df = spark.createDataFrame(rows, schema)
        df.write.parquet(str(tmp_path / name))
        return T.Folder(str(tmp_path / name), df.schema)
    a = put("a", [(1, "x"), (2, None)], "k int, v string")
    b = put("b", [(3,)], "k int")
    c = put("c", [(4, "z", 40)], "k int, v string, id_client int")
    d = put("d e%20", [(5, "y")], "k int, v string")
    e = T.Folder(str(tmp_path / "never"), a.schema)
    central = Warehouse(spark, f"c_{uuid.uuid4().hex[:8]}")
    T.merge_folders(central, "t", {1: a, 2: b, 3: c, 4: d, 5: e})
    rows = sorted((r.k, r.v, r.id_client) for r in T.merged_rows(central, "t").collect())
    assert rows == [(1, "x", 1), (2, None, 1), (3, None, 2), (4, "z", 40), (5, "y", 4)]
    other = Warehouse(spark, f"c_{uuid.uuid4().hex[:8]}")
    T.merge_folders(other, "t", {1: a, 2: a})
    assert sorted((r.k, r.id_client) for r in T.merged_rows(other, "t").collect()) == [(1, 1), (1, 2), (2, 1), (2, 2)]


def test_merge_schemas_reads_partitioned_and_plain_tables(spark):
    t = {i: Warehouse(spark, f"p{i}_{uuid.uuid4().hex[:8]}") for i in (1, 2, 3)}
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "k int, p string")
    t[1].publish(rows, "x")
    t[2].publish(rows, "x", partition_by=("p",))
    t[3].create_like("x", rows)
    assert t[1].plain_folder("x") and t[2].plain_folder("x") is None
    central = Warehouse(spark, f"c_{uuid.uuid4().hex[:8]}")
    assert T.merge_schemas(central, t, ["x"]) == [("x", i, "merged") for i in (1, 2, 3)]
    assert sorted((r.k, r.p, r.id_client) for r in T.merged_rows(central, "x").collect()) == [
        (1, "a", 1), (1, "a", 2), (2, "b", 1), (2, "b", 2)]
