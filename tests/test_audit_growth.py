"""What the foreign-key audit does for each row."""
from tenantmart.operators import audit as A


def test_foreign_keys_are_counted_by_their_own_type(spark):
    child = spark.createDataFrame([(1, "a", 0.0), (1, "b", -0.0), (None, None, None), (9, "a", 2.0)], "k int, s string, d double")
    parent = spark.createDataFrame([(1, "a", 0.0), (2, "a", 2.0), (None, None, None)], "k bigint, s string, d double")
    audit = A.audit_foreign_keys({"c": child, "p": parent}, [("c", c, "p", c) for c in "ksd"] + [("c", "k", "p", "s")])
    plan = audit._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan and "explode" not in plan
    got = {(r.child_column, r.parent_column): (r.checked_rows, r.orphan_rows, r.orphan_keys) for r in audit.collect()}
    # as text, -0.0 is not 0.0
    assert got == {("k", "k"): (3, 1, 1), ("s", "s"): (3, 1, 1), ("d", "d"): (3, 1, 1), ("k", "s"): (3, 3, 2)}
