"""What the removal of duplicates shuffles: whole fact rows only of timesheets that share a person and day with another."""
import datetime as dt
import uuid

import pytest

from tenantmart.operators.cleanse import dedupe_rows, shared_units
from tenantmart.operators.load import Warehouse
from tenantmart.operators.lookup import interval_lookup
from tenantmart.plans import FIXTURE_PARAMS, MODELS
from tenantmart.run import run_models


@pytest.fixture
def no_broadcast(spark):
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = {n: spark.conf.get(n, None) for n in names}
    for n in names:
        spark.conf.set(n, "-1")
    yield
    for n, v in before.items():
        spark.conf.unset(n) if v is None else spark.conf.set(n, v)


def _source(spark):
    """Timesheets 1 and 2 give equal rows; 3 has a person and a centre twice; 4 and 5 have no person, 6 no link;
    7 is there twice; 8 has another farm of the same name than 1, 9 another label."""
    day = dt.datetime(2024, 1, 3)
    sheets = [(1, 1, "op"), (2, 1, "op"), (3, 1, "op"), (4, 1, "op"), (5, 1, "op"), (6, 1, "op"), (7, 2, "op"), (7, 2, "op"), (8, 3, "op"),
              (9, 1, "other"), (None, 1, "op")]
    persons = [(1, 10), (2, 10), (3, 11), (3, 11), (6, 10), (7, 12), (8, 10), (9, 10), (None, 10)]
    centres = [(1, 5), (2, 5), (3, 6), (3, 6), (4, 5), (5, 5), (7, 5), (8, 5), (9, 5), (1, 77), (8, None), (None, 5)]
    t = {
        "pointage": spark.createDataFrame([(i, day, label, f, 1, 0.0) for i, f, label in sheets],
                                          "idpointage bigint, date timestamp_ntz, oper_liste string, idfermes bigint, operef_id int, cout_totale double"),
        "personnel_pointage": spark.createDataFrame(
            [(i, p, 8.0, 80.0, 8, *[0.0] * 6) for i, p in persons], "idpointage bigint, pers_id bigint, hj double, cout double, seuil_horaire int, "
            "hs_25 double, hs_50 double, hs_100 double, hs_nm double, cout_hscu double, hscu double"),
        "pointage_parcelleculturale": spark.createDataFrame([(1, 100, 3.0), (2, 100, 3.0), (9, 100, 3.0), (3, None, 1.0)],
                                                            "idpointage bigint, parccul_id bigint, cout double"),
        "cc_pointage": spark.createDataFrame([(i, c, 20.0) for i, c in centres], "idpointage bigint, idcentre_intermediaire bigint, cout double"),
        "parcelleculturale": spark.createDataFrame([(100, 1.5), (100, 0.5)], "id bigint, sup double"),
        "fermes": spark.createDataFrame([(1, "F"), (2, "G"), (3, "F")], "idfermes int, nom string"),
        "operation_ref": spark.createDataFrame([(1, "op")], "operef_id int, operef_intitule string"),
        "fermes_compagne": spark.createDataFrame([(7, dt.date(2024, 1, 1), dt.date(2024, 12, 31))], "id int, date_debut date, date_fin date"),
        "centre_intermediaire": spark.createDataFrame([(5,), (5,), (6,), (None,)], "idcentre_intermediaire int"),
    }
    return t.__getitem__


def _rows(df):
    return sorted(map(str, df.collect()))


def test_pieces_of_the_fact_are_its_different_rows(spark, no_broadcast):
    src, model = _source(spark), MODELS["fact_labour"]
    whole = model(src, FIXTURE_PARAMS).collect()
    alone, among = (dedupe_rows(*p, "copies") for p in model.in_pieces(src, FIXTURE_PARAMS))
    rows = [(r.asDict(), r["copies"]) for df in (alone, among) for r in df.collect()]
    assert sorted(str({k: v for k, v in r.items() if k != "copies"}) for r, _ in rows) == sorted({str(r.asDict()) for r in whole})
    assert sum(n for _, n in rows) == len(whole) == 30 and len(rows) == 13
    # a link's copies by the centre dimension count once, and a timesheet's statistics are its own
    assert {(r.id_personnel, r.cost_analytique_indirect) for r in whole if r.id_centre_cout == 5} == {(10, 40.0), (10, 80.0), (12, 80.0), (None, None)}
    plan = alone._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(idpointage" in plan and "hashpartitioning(date_pointage" not in plan


def test_a_batch_counts_the_rows_of_all_pieces(spark):
    src = _source(spark)
    wh = Warehouse(spark, f"g_{uuid.uuid4().hex[:8]}")

    def ran(source):
        r = run_models(spark, source, wh, FIXTURE_PARAMS, models=["fact_labour"], create_or_replace=True).first()
        return r.status, r.error, r.rows, r.dropped_duplicates
    assert ran(src) == ("loaded", None, 13, 17) and wh.read("fact_labour").count() == 13
    # no timesheet shares anything: that piece is empty, the other has duplicates
    assert ran(lambda t: src(t).where("idpointage IN (3, 9)") if t == "pointage" else src(t)) == ("loaded", None, 5, 5)


def test_shared_units(spark):
    parts = spark.createDataFrame([(1, "a", None), (2, "a", None), (3, "b", 1), (3, "b", 1), (4, None, 1), (5, None, 1), (6, "a", 1), (None, "b", 1),
                                   (7, None, None), (8, "x", 0), (8, "a", None)], "u int, v string, w int")
    assert sorted(r.u for r in shared_units(parts, "u").collect()) == [1, 2, 4, 5, 8]


def test_few_times_are_answered_without_a_shuffle_of_the_facts(spark, no_broadcast):
    t = dt.datetime
    seasons = spark.createDataFrame([(4, t(2024, 1, 1), t(2024, 6, 1, 12)), (2, t(2024, 6, 1), t(2024, 6, 2))], "id int, s timestamp_ntz, e timestamp_ntz")
    facts = spark.createDataFrame(list(enumerate([t(2024, 1, 1), t(2024, 6, 1, 12, 0, 0, 1), t(2024, 6, 1), t(1, 1, 1), t(9999, 12, 31, 23, 59, 59, 999999),
                                                  None, t(2024, 1, 1)])), "i int, ts timestamp_ntz")
    def asked(few):
        return interval_lookup(facts, "ts", seasons, "id", "s", "e", "hit", few=few)
    want = _rows(asked(0))
    assert asked(0).columns == asked(9).columns and [r.hit for r in asked(5).orderBy("i").collect()] == [4, 2, 2, None, None, None, 4]
    assert _rows(asked(4)) == want == _rows(asked(5))
    plans = [asked(few)._jdf.queryExecution().executedPlan().toString() for few in (4, 5)]
    assert ["Exchange hashpartitioning" in p for p in plans] == [True, False]
