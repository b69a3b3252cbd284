"""What a batch leaves on disk and what it does twice."""
import threading
import time
import uuid

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from tenantmart.operators import load as L
from tenantmart.plans import FIXTURE_PARAMS, MODELS
from tenantmart.run import _distinct
from tenantmart.session import DROP_SHUFFLES, shuffles_dropped


@pytest.fixture()
def wh(spark):
    return L.Warehouse(spark, f"t_{uuid.uuid4().hex[:10]}")


def _shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {n for n in (files.apply(i).getName() for i in range(files.size())) if n.startswith("shuffle_")}


def test_a_written_version_leaves_no_shuffle_files(spark, wh):
    before, setting = _shuffle_files(spark), spark.conf.get(DROP_SHUFFLES)
    rows = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).agg(F.count(F.lit(1)).alias("n")).repartition(3, "n")
    wh.publish(rows, "t")
    until = time.time() + 20
    while (left := _shuffle_files(spark) - before) and time.time() < until:      # executors remove them in their own time
        time.sleep(0.2)
    assert not left and spark.conf.get(DROP_SHUFFLES) == setting
    assert wh.read("t").count() == 7 and rows.count() == 7      # the frame can be evaluated again


def test_the_setting_comes_back_after_the_last_of_several_writes(spark):
    setting, inside, leave = spark.conf.get(DROP_SHUFFLES), threading.Event(), threading.Event()

    def other():
        with shuffles_dropped(spark):
            inside.set()
            leave.wait(20)

    t = threading.Thread(target=other)
    t.start()
    inside.wait(20)
    with pytest.raises(ValueError), shuffles_dropped(spark):
        raise ValueError("a write that fails")
    assert spark.conf.get(DROP_SHUFFLES) == "true"
    leave.set()
    t.join()
    assert spark.conf.get(DROP_SHUFFLES) == setting


KINDS = "a int, b int, v string"


@pytest.mark.parametrize("layout", [None, L.Layout(("a", "b"), 4)])
def test_a_source_with_every_key_takes_the_table_over_as_staged(spark, wh, monkeypatch, layout):
    old = [(1, 1, "x", 7), (1, 1, "y", 8), (2, None, "z", 9)]
    new = [(1, 1, "n"), (2, None, "m"), (2, None, "m"), (3, 3, None)]
    wh.publish(spark.createDataFrame(old, f"{KINDS}, id_client int"), "t", layout=layout)
    written, write = [], L.Warehouse.write_version
    monkeypatch.setattr(L.Warehouse, "write_version", lambda self, df, *a: written.append(df.columns) or write(self, df, *a))
    source = spark.createDataFrame(new, KINDS).select("v", "b", "a")
    for _ in range(2):
        assert L.load_replace_keys(source, wh, "t", ("a", "b"), many_rows=1).rows == 4
    if layout is None:
        assert written == [["a", "b", "v"], ["s__a", "s__b"]] * 2
    assert wh.columns("t") == ["a", "b", "v", "id_client"] and wh.layout("t") == layout
    assert sorted(map(str, wh.read("t").collect())) == sorted(str(r) for r in spark.createDataFrame(
        [(*r, None) for r in new], f"{KINDS}, id_client int").collect())
    # a key that stays
    L.load_replace_keys(spark.createDataFrame(new[:2], KINDS), wh, "t", ("a", "b"), many_rows=1)
    assert sorted(r["a"] for r in wh.read("t").collect()) == [1, 2, 3]


@pytest.mark.parametrize("name", ["sales_production", "production_profile"])
def test_rows_of_a_distinct_model_are_compared_once(spark, src, name):
    seen, model = Observation(), MODELS[name]
    rows = _distinct(model, src, FIXTURE_PARAMS, seen)
    whole, todo, found = len(rows.columns), [rows._jdf.queryExecution().optimizedPlan()], 0
    while todo:
        node = todo.pop()
        found += node.nodeName() == "Aggregate" and node.output().size() == whole
        todo += [node.children().apply(i) for i in range(node.children().size())]
    assert found == 1
    n = len(rows.collect())
    assert seen.get["rows"] == n == model(src, FIXTURE_PARAMS).count() == rows.distinct().count()
