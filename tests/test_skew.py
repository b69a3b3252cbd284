"""A key holding a third of the lines: the plain left outer join cannot be
split by AQE, the fan-out form is (the planner marks the join skew=true)."""
from contextlib import contextmanager

from pyspark.sql import functions as F

from tenantmart.operators import skew
from tenantmart.operators.skew import fanout_left_join

CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.shuffle.partitions": "16",
}


@contextmanager
def conf(spark, values):
    old = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def _final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_header_key_is_split_only_in_fanout_form(spark):
    with conf(spark, CONF):
        header = spark.range(1000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("a"))
        lines = spark.range(300_000).select(
            F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 1000).alias("k"),
            F.col("id").alias("b"))
        plain = _final_plan(header.join(lines, "k", "left"))
        fanout_df = fanout_left_join(header, lines, "k")
        fanout = _final_plan(fanout_df)
        assert "skew=true" not in plain
        assert "SortMergeJoin(skew=true)" in fanout
        assert fanout_df.count() == header.join(lines, "k", "left").count()


def _hot_source(spark):
    """Timesheet 7 holds a third of the persons, timesheet 11 a third of the plot links."""
    n, lines = 2_000, 120_000
    hot = lambda k: F.when(F.col("id") % 3 == 0, F.lit(k)).otherwise(F.col("id") % n)
    zero = F.lit(0.0)
    t = {
        "pointage": spark.range(n).select(F.col("id").alias("idpointage"), F.lit("2024-01-03").cast("timestamp_ntz").alias("date"),
                                          F.lit("op").alias("oper_liste"), (F.col("id") % 5).alias("idfermes"), F.lit(1).alias("operef_id"),
                                          F.lit(10.0).alias("cout_totale")),
        "personnel_pointage": spark.range(0, lines, 1, 16).where(f"id % 3 = 0 or id % {n} != 11").select(
            hot(7).alias("idpointage"), F.col("id").alias("pers_id"), F.lit(8.0).alias("hj"), F.rand(1).alias("cout"), F.lit(8).alias("seuil_horaire"),
            *[zero.alias(c) for c in ("hs_25", "hs_50", "hs_100", "hs_nm", "cout_hscu", "hscu")]),
        "pointage_parcelleculturale": spark.range(0, lines, 1, 16).select(
            hot(11).alias("idpointage"), F.col("id").alias("parccul_id"), F.rand(2).alias("cout")).where("idpointage != 7"),
        "cc_pointage": spark.range(10).select(F.col("id").alias("idpointage"), F.lit(1).alias("idcentre_intermediaire"), zero.alias("cout")),
        "parcelleculturale": spark.range(100).select("id", F.lit(1.0).alias("sup")),
        "fermes": spark.range(5).select(F.col("id").alias("idfermes"), F.lit("f").alias("nom")),
        "operation_ref": spark.range(1).select(F.lit(1).alias("operef_id"), F.lit("op").alias("operef_intitule")),
        "fermes_compagne": spark.sql("SELECT 1 AS id, DATE'2024-01-01' AS date_debut, DATE'2024-12-31' AS date_fin"),
        "centre_intermediaire": spark.range(1, 2).select(F.col("id").cast("int").alias("idcentre_intermediaire")),
    }
    return t.__getitem__


def test_fact_labour_splits_hot_persons_and_hot_links(spark):
    from tenantmart.plans import MODELS
    with conf(spark, {**CONF, "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2"}):
        df = MODELS["fact_labour"](_hot_source(spark)).groupBy("type_affectation").count()
        assert sum(r["count"] for r in df.collect()) > 100_000
        plan = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        # the joins with exchanges of their own: timesheets with persons, then with links
        joins = [line for line in plan.splitlines() if "SortMergeJoin" in line and "_exchange" in line]
        assert len(joins) == 2 and all("skew=true" in j for j in joins), joins


def test_hot_keys_misses_none_and_is_bounded(spark):
    """Keys just over the share are found among many rare ones; NULL is none."""
    n = 200_000
    lines = spark.range(n).select(F.when(F.col("id") % 10 == 0, None).when(F.col("id") % 100 < 4, F.col("id") % 100).otherwise(F.col("id") + 1000).alias("k"))
    exact = {r["k"] for r in lines.where("k IS NOT NULL").groupBy("k").count().where(f"count >= {n // 200}").collect()}
    assert exact == {1, 2, 3} and set(skew.hot_keys([lines], "k", share=1 / 200, least=1_000)) == exact
    assert skew.hot_keys([lines], "k", share=1 / 200, least=n) == []
    assert skew.hot_keys([lines.limit(0)], "k") == []
    few = spark.range(300).select((F.col("id") % 2 + 50).alias("k"))          # each table's own rows count
    assert skew.hot_keys([few, lines], "k", share=1 / 200, least=100) == [1, 2, 3, 50, 51]


def test_routes_agree_whatever_is_hot(spark):
    """Rows without a line, without a header, repeated headers and NULL keys: every routing gives the plain join's rows."""
    header = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (3, "d"), (None, "e"), (5, "f")], "k int, h string")
    lines = spark.createDataFrame([(1, 10), (1, 11), (2, 20), (None, 30), (4, 40)] + [(5, i) for i in range(50)], "k int, v int")
    want = sorted(map(str, header.join(lines, "k", "left").collect()))
    for least in (1, 2, 40, 1_000):
        got = fanout_left_join(header, lines, "k", least=least)
        assert got.columns == ["k", "h", "v"] and sorted(map(str, got.collect())) == want, least


def test_fact_labour_is_the_same_on_both_routes(spark, src, monkeypatch):
    from tenantmart.plans import FIXTURE_PARAMS, MODELS
    from tenantmart.plans import labour
    plain = MODELS["fact_labour"](src, FIXTURE_PARAMS)
    monkeypatch.setattr(labour, "hot_keys", lambda tables, on: [1])
    both = MODELS["fact_labour"](src, FIXTURE_PARAMS)
    digest = lambda df: df.select(F.xxhash64(*df.columns).alias("h")).agg(
        F.count(F.lit(1)), F.sum(F.col("h").cast("decimal(38,0)"))).first()
    rounded = lambda df: df.withColumns({c: F.round(c, 4) for c, t in df.dtypes if t == "double"})
    assert digest(rounded(plain)) == digest(rounded(both))
