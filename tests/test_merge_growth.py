"""What the central merge does for each row: no path lookup or shuffle that is not needed."""
import uuid

import pytest

from tenantmart.operators import tenants as T
from tenantmart.operators.load import Warehouse


@pytest.fixture
def staged_plans(monkeypatch):
    plans, stage = [], T.stage

    def seen(df, *a, **kw):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return stage(df, *a, **kw)
    monkeypatch.setattr(T, "stage", seen)
    return plans


def _folder(spark, tmp_path, name, rows, schema):
    df = spark.createDataFrame(rows, schema)
    df.write.parquet(str(tmp_path / name))
    return T.Folder(str(tmp_path / name), df.schema)


def test_one_folder_is_merged_without_lookup_or_shuffle(spark, tmp_path, staged_plans):
    none = _folder(spark, tmp_path, "none", [(1, "a"), (2, None)], "k int, v string")
    own = _folder(spark, tmp_path, "own", [(3, "c", 7), (4, "d", 7)], "k int, v string, ID_client int")
    many = _folder(spark, tmp_path, "many", [(5, "e", 8), (6, "f", 9), (7, "g", None)], "k int, v string, id_client int")
    never = T.Folder(str(tmp_path / "never"), own.schema)
    central = Warehouse(spark, f"c_{uuid.uuid4().hex[:8]}")
    for t, f in enumerate((none, own, many, never), 1):
        T.merge_folders(central, "t", {t: f})
    assert ["RebalancePartitions" in p for p in staged_plans] == [False, False, True, False]
    assert not any("Join" in p or "file_path" in p for p in staged_plans)
    rows = sorted((r.k, r.v, r.id_client) for r in T.merged_rows(central, "t").collect())
    assert rows == [(1, "a", 1), (2, None, 1), (3, "c", 7), (4, "d", 7), (5, "e", 8), (6, "f", 9), (7, "g", None)]


def test_the_folder_of_a_row_is_found_without_regular_expressions(spark, tmp_path, staged_plans):
    a, b = (_folder(spark, tmp_path, n, [(i,)], "k int") for i, n in enumerate("ab"))
    central = Warehouse(spark, f"c_{uuid.uuid4().hex[:8]}")
    T.merge_folders(central, "t", {1: a, 2: b})
    assert "regexp" not in staged_plans[0] and "RebalancePartitions" in staged_plans[0]
    assert sorted((r.k, r.id_client) for r in T.merged_rows(central, "t").collect()) == [(0, 1), (1, 2)]


def test_tables_are_merged_some_at_a_time_and_reported_in_order(spark, monkeypatch):
    import threading
    both = threading.Barrier(2, timeout=60)
    one, central = (Warehouse(spark, f"{n}_{uuid.uuid4().hex[:8]}") for n in "oc")
    for n in ("x", "y"):
        one.publish(spark.createDataFrame([(1, n)], "k int, v string"), n)
    merge = T._merge

    def met(*a):
        both.wait()
        return merge(*a)
    monkeypatch.setattr(T, "_merge", met)
    spark.sparkContext.setLocalProperty("spark.scheduler.pool", "p")
    try:
        assert T.merge_schemas(central, {1: one}, ["x", "y"]) == [("x", 1, "merged"), ("y", 1, "merged")]
    finally:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", None)
    monkeypatch.undo()
    assert T.merge_schemas(central, {1: one}, ["y", "y"]) == [("y", 1, "skipped")] * 2
    assert T.merge_schemas(central, {2: one}, ["x", "x"]) == [("x", 2, "merged"), ("x", 2, "skipped")]


def test_an_error_stops_the_tables_not_begun(spark, monkeypatch):
    monkeypatch.setattr(T, "WORKERS", 1)
    done = []

    def work(n):
        if n == "b":
            raise ValueError(n)
        done.append(n)
    with pytest.raises(ValueError):
        T._each_table(spark, work, ["b", *[f"n{i}" for i in range(200)]])
    assert len(done) < 200
