"""What a task holds and what a shuffle moves: wide columns come after the lookups and sums."""
import datetime as dt

from pyspark.sql import functions as F

from tenantmart.operators import load as L
from tenantmart.plans import FIXTURE_PARAMS, sales

PLOT = "parcelle"


def _nodes(df, kind):
    out, todo = [], [df._jdf.queryExecution().optimizedPlan()]
    while todo:
        node = todo.pop()
        if node.nodeName() == kind:
            out.append(node)
        kids = node.children()
        todo += [kids.apply(i) for i in range(kids.size())]
    return out


def test_sale_headers_are_attached_after_the_plots(spark, src):
    frame = sales.sales_production(src, FIXTURE_PARAMS)
    lookups = [j for j in _nodes(frame, "Join") if PLOT in j.condition().toString() and "idvente" not in j.condition().toString()]
    assert lookups
    for j in lookups:
        kept = j.left().output().toString()
        assert "reference_vente#" not in kept and "date_vente#" not in kept


def _inputs_source(spark):
    day = dt.datetime(2024, 1, 9)
    rows = {
        "mouvement_stock": ([(1, day, 2.0, 1, 7), (2, day, 3.0, 1, 8), (3, day, None, 9, None)],
                            "idmouvement_stock int, date timestamp, cmup double, iddepots int, produit int"),
        "mouvementstock_parcelleculturale": ([(1, 4, 10.0), (1, 4, 1.0), (2, None, 5.0), (3, 4, 1.0)],
                                             "mouvement_stock int, parcelleculturale int, qantite double"),
        "depots": ([(1,)], "iddepots int"),
        # product 7: twice with the same labels, once with others; no product 8
        "produit": ([(7, "a", "b", None), (7, "a", "b", None), (7, "c", "d", "e"), (None, "x", "y", "z")],
                    "id int, categorie string, sous_categorie string, designation string"),
        "parcelleculturale": ([(4, day.date())], "id int, date_previsionnelle date"),
    }
    return lambda name: spark.createDataFrame(*rows[name])


def test_inputs_are_summed_before_they_get_their_labels(spark):
    frame = sales._cost_inputs(_inputs_source(spark), FIXTURE_PARAMS)
    got = {(r["charge_niv1"], r["charge_niv2"], r["idparcelleculturale"], r["cout"], r["quantite"], r["cout_unitaire"]) for r in frame.collect()}
    assert got == {(sales.LEVEL_INPUTS, "a", 4, 44.0, 22.0, 8.0), (sales.LEVEL_INPUTS, "c", 4, 22.0, 11.0, 4.0),
                   (sales.LEVEL_INPUTS, None, None, 15.0, 5.0, 3.0), (sales.LEVEL_INPUTS, None, 4, None, 1.0, None)}
    assert frame.count() == 4
    sums = [a for a in _nodes(frame, "Aggregate") if "sum(" in a.aggregateExpressions().toString()]
    assert sums
    for a in sums:
        assert "categorie" not in a.groupingExpressions().toString()


def test_keys_that_stay_give_the_same_load(spark, tmp_path):
    old = [(1, "a", "x"), (1, "a", "y"), (None, "a", "z"), (None, None, "n"), (2, None, "k"), (2, None, "k"), (3, "c", "s")]
    new = [(1, "a", "new"), (None, "a", "new"), (None, None, "new"), (9, "q", "new"), (9, "q", "new")]
    kinds, keys = "k int, l string, v string", ["k", "l"]
    found = []
    for i, limit in enumerate((0, 100)):
        wh = L.Warehouse(spark, f"tm_kept_{i}", str(tmp_path))
        wh.publish(spark.createDataFrame(old, kinds), "t")
        L.load_replace_keys(spark.createDataFrame(new, kinds), wh, "t", keys, many_rows=limit)
        found.append(sorted(map(str, wh.read("t").collect())))
        spark.sql(f"DROP DATABASE tm_kept_{i} CASCADE")
    assert found[0] == found[1] == sorted(map(str, spark.createDataFrame(
        [(2, None, "k"), (2, None, "k"), (3, "c", "s"), *new], kinds).collect()))


def test_few_keys_that_stay_are_broadcast_to_the_target(spark, tmp_path):
    target, source = (spark.range(a, b).select(F.col("id").alias("k"), F.lit("w").alias("v")) for a, b in ((0, 1000), (1, 1000)))
    at = str(tmp_path / "kept")
    kept = L.kept_keys(target, source, ["k"])
    kept.write.parquet(at)
    merged = L.replace_keys_frame(target, source, ["k"], spark.read.schema(kept.schema).parquet(at))
    assert "Exchange hashpartitioning" not in merged._jdf.queryExecution().executedPlan().toString()
    assert merged.count() == 1000 and merged.where("k = 0").count() == 1
