import datetime as dt
import math

from pyspark.sql import functions as F

from tenantmart.operators import cleanse as C

D = dt.date


def test_numeric_dates_by_magnitude(spark):
    cases = [(1704067200, D(2024, 1, 1)), (1704067200000, D(2024, 1, 1)),
             (1704067200000000000, D(2024, 1, 1)), (20240101, D(2024, 1, 1)),
             (20241301, None), (500, D(1970, 1, 1)), (0, None), (-5, None), (None, None),
             (1704153599, D(2024, 1, 1)), (1704153600, D(2024, 1, 2))]
    df = spark.createDataFrame([(i, v) for i, (v, _) in enumerate(cases)], "i int, v bigint")
    got = {r.i: r.d for r in df.select("i", C.date_from_number(F.col("v")).alias("d")).collect()}
    assert [got[i] for i in range(len(cases))] == [want for _, want in cases]


def test_numeric_dates_decided_per_row_not_by_first_value(spark):
    df = spark.createDataFrame([(1, 20240105), (2, 1704067200)], "i int, v bigint")
    got = sorted(df.select("i", C.date_from_number(F.col("v")).alias("d")).collect())
    assert [r.d for r in got] == [D(2024, 1, 5), D(2024, 1, 1)]


def test_text_dates(spark):
    cases = [("2024-01-01", D(2024, 1, 1)), ("2024-01-01 10:00:00", D(2024, 1, 1)),
             ("bad", None), ("NaT", None), ("", None), (None, None), ("2024/02/03", D(2024, 2, 3))]
    df = spark.createDataFrame([(i, v) for i, (v, _) in enumerate(cases)], "i int, t string")
    got = {r.i: r.t for r in C.clean_dates(df, ["t"]).collect()}
    assert [got[i] for i in range(len(cases))] == [w for _, w in cases]


def test_null_tokens_whole_cell_only(spark):
    vals = ["n/a", "N/A", "none", "NONE", "", "   ", "NaN", "-inf", "Nancy", "na na", "ok", None]
    df = spark.createDataFrame([(v,) for v in vals], "s string")
    got = [r.s for r in C.clean_null_tokens(df).collect()]
    assert got == [None, None, None, None, None, None, None, None, "Nancy", "na na", "ok", None]


def test_null_tokens_trim_option(spark):
    df = spark.createDataFrame([(" n/a ",), ("    ",)], "s string")
    assert [r.s for r in C.clean_null_tokens(df).collect()] == [" n/a ", "    "]
    assert [r.s for r in C.clean_null_tokens(df, trim=True).collect()] == [None, None]


def test_nonfinite_to_null(spark):
    df = spark.createDataFrame([(1.5,), (float("nan"),), (float("inf"),), (float("-inf"),)],
                               "x double")
    assert [r.x for r in C.clean_nonfinite(df).collect()] == [1.5, None, None, None]


def test_dedupe_treats_null_and_nan_as_equal(spark):
    df = spark.createDataFrame([(None, float("nan")), (None, float("nan")), (1, 1.0)],
                               "a int, b double")
    out = C.dedupe_rows(df).collect()
    assert len(out) == 2
    assert any(r.a is None and math.isnan(r.b) for r in out)


def test_duplicate_columns_keep_first_and_names_normalised(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int").toDF(" Id ", "id", "X")
    out = C.drop_duplicate_columns(C.normalize_column_names(df))
    assert out.columns == ["id", "x"]
    assert tuple(out.first()) == (1, 3)


def test_date_detection_opt_in_with_exclusions():
    cols = ["date_vente", "updatedby", "fin_saison", "montant"]
    assert C.detect_date_columns(cols, configured=["date_vente"]) == ["date_vente"]
    # the name heuristic also catches a user-name column; exclusions fix that
    assert C.detect_date_columns(cols, by_name=True) == ["date_vente", "updatedby", "fin_saison"]
    assert C.detect_date_columns(cols, by_name=True, exclude=["updatedby"]) == [
        "date_vente", "fin_saison"]


def test_cleanse_is_idempotent_after_first_pass(spark, src):
    spec = C.CleanseSpec(dedupe=False, date_columns=("date_code", "date_text"),
                         numeric_types={"qty_text": "bigint"})
    once = C.cleanse(src("raw_extract"), spec)
    twice = C.cleanse(once, spec)
    assert sorted(once.collect()) == sorted(twice.collect())


def test_format_dates_for_export(spark):
    df = spark.createDataFrame([(D(2024, 1, 5),)], "d date")
    assert C.format_dates(df, ["d"]).first().d == "2024-01-05"
