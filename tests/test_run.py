import time
import uuid

import pytest

from tenantmart.operators.load import Warehouse, ensure_tables
from tenantmart.plans import FIXTURE_PARAMS, Model
from tenantmart.run import run_models, run_tenants
from tenantmart.schema import TABLES


def test_runner_isolates_failures_and_loads(spark, src):
    wh = Warehouse(spark, f"r_{uuid.uuid4().hex[:8]}")
    ensure_tables(wh, [TABLES["dim_staff"]])
    rep = {r.model: r for r in run_models(
        spark, src, wh, FIXTURE_PARAMS, models=["dim_staff", "dim_operation"]).collect()}
    assert rep["dim_staff"].status == "loaded" and rep["dim_staff"].rows == 10
    assert rep["dim_staff"].dropped_duplicates == 0
    # truncate+insert into a table that was never created: reported, others unaffected
    assert rep["dim_operation"].status == "failed" and "does not exist" in rep["dim_operation"].error
    assert wh.read("dim_staff").where("prenom_personnel IS NULL").count() == 1   # 'n/a' token


def test_runner_over_tenants_with_replace_and_upsert(spark, src):
    a = Warehouse(spark, f"a_{uuid.uuid4().hex[:8]}")
    b = Warehouse(spark, f"b_{uuid.uuid4().hex[:8]}")
    rep = run_tenants(spark, {"A": (src, a), "B": (src, b)}, FIXTURE_PARAMS,
                      models=["pl_accounts", "budget_versions"], create_or_replace=True)
    assert {(r.tenant, r.status) for r in rep.collect()} == {("A", "loaded"), ("B", "loaded")}
    up = run_models(spark, src, a, FIXTURE_PARAMS, models=["pl_accounts"], mode="incremental")
    assert up.first().status == "loaded"
    assert a.read("pl_accounts").count() == src("bdg_comptes_pl").count()


def test_incremental_run_of_all_models_twice_is_once(spark, src):
    from tenantmart.plans import CALENDAR, MODELS
    wh = Warehouse(spark, f"i_{uuid.uuid4().hex[:8]}")
    first = {r.model: r for r in run_models(spark, src, wh, FIXTURE_PARAMS, create_or_replace=True).collect()}
    assert set(first) == {*MODELS, CALENDAR.name} and {r.status for r in first.values()} == {"loaded"}
    before = {m: wh.read(m).count() for m in first}
    again = {r.model: r for r in run_models(spark, src, wh, FIXTURE_PARAMS, mode="incremental").collect()}
    assert {m: (r.status, r.error) for m, r in again.items()} == dict.fromkeys(first, ("loaded", None))
    assert {m: wh.read(m).count() for m in first} == before
    assert all(first[m].rows == again[m].rows == before[m] for m in first)
    assert first["farm_labour"].dropped_duplicates == again["farm_labour"].dropped_duplicates
    assert wh.read("dim_calendar").count() > 0


def test_dedupe_order_reaches_the_upsert(spark):
    wh = Warehouse(spark, f"d_{uuid.uuid4().hex[:8]}")
    rows = spark.createDataFrame([(1, "old", 1), (1, "new", 2)], "k int, v string, ts int")
    wh.publish(rows.limit(0), "m")
    m = Model("m", lambda s, p: rows, keys=("k",))
    assert run_models(spark, None, wh, models=[m], mode="incremental").first().status == "failed"
    assert run_models(spark, None, wh, models=[m], mode="incremental", dedupe_order={"m": "ts"}).first().status == "loaded"
    assert [r.v for r in wh.read("m").collect()] == ["new"]


def _rows(report):
    return [tuple(r)[:-1] for r in report.drop("target").collect()]      # without the time


def test_a_pool_reports_what_a_serial_run_does(spark, src):
    models = ["pl_accounts", "budget_versions", "dim_staff", "dim_operation"]

    def broken(name):
        raise RuntimeError(f"no {name}")

    def tenants(tag):
        return {t: (broken if t == "b" else src, Warehouse(spark, f"{tag}{t}_{uuid.uuid4().hex[:8]}")) for t in "abc"} | {"d": None}
    serial = run_tenants(spark, tenants("s"), FIXTURE_PARAMS, models=models, create_or_replace=True)
    pooled = run_tenants(spark, tenants("p"), FIXTURE_PARAMS, models=models, create_or_replace=True, workers=5)
    assert _rows(serial) == _rows(pooled)
    assert [(r.tenant, r.status) for r in pooled.collect()] == (
        [("a", "loaded")] * 4 + [("b", "failed")] * 4 + [("c", "loaded")] * 4 + [("d", "failed")])
    with pytest.raises(ValueError):
        run_models(spark, src, None, models=models, workers=0)


def test_a_model_over_its_time_is_cancelled_alone(spark):
    """The slow model's job (one task, so slots stay free) stops; the others, in the same pool, and the caller's own properties stay."""
    wh = Warehouse(spark, f"l_{uuid.uuid4().hex[:8]}")
    slow = Model("slow", lambda s, p: spark.range(0, 10**14, 1, 1).selectExpr("max(sqrt(id)) AS k"))
    quick = [Model(f"quick{i}", lambda s, p: spark.range(5).selectExpr("id AS k"), keys=("k",)) for i in range(3)]
    spark.sparkContext.setLocalProperty("spark.scheduler.pool", "mine")
    began = time.time()
    rep = {r.model: r for r in run_models(spark, None, wh, models=[slow, *quick], create_or_replace=True, clean=False,
                                          workers=2, limit_seconds=15).collect()}
    assert time.time() - began < 60
    assert rep["slow"].status == "failed" and "cancelled after 15 s" in rep["slow"].error
    assert {rep[m.name].status for m in quick} == {"loaded"}
    assert not wh.exists("slow")
    assert spark.sparkContext.getLocalProperty("spark.scheduler.pool") == "mine"
    spark.sparkContext.setLocalProperty("spark.scheduler.pool", None)
