"""Data tests count failures like the SQL tests, and the gate stops a run."""

import pytest

from lakeline.operators import checks


def test_counts_and_gate(spark):
    parent = spark.createDataFrame([(1,), (2,), (2,)], "id int")
    child = spark.createDataFrame([(1, "a"), (3, "b"), (None, "zz"), (3, None), (4, "zz")], "pid int, r string")
    tests = [*checks.not_null("child", "pid", "r"), checks.unique("parent", "id"),
             checks.relationship("child", "pid", "parent", "id"),
             checks.accepted_values("child", "r", ["a", "b"])]
    got = {(r.test, r.model, r.column_name): r.failures for r in
           checks.run_tests({"parent": parent, "child": child}, tests).collect()}
    assert got == {
        ("not_null", "child", "pid"): 1, ("not_null", "child", "r"): 1,
        ("unique", "parent", "id"): 1,
        ("relationships", "child", "pid->parent.id"): 3,   # 3, 3, 4; NULL passes
        ("accepted_values", "child", "r"): 1,               # distinct bad values: 'zz'
    }
    with pytest.raises(checks.DataTestFailure, match="5 data test"):
        checks.gate(checks.run_tests({"parent": parent, "child": child}, tests))


def test_not_null_is_one_pass_per_table(spark):
    df = spark.range(10).selectExpr("id", "id AS a", "id AS b")
    plan = checks.not_null_results("t", df, ["id", "a", "b"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Range (") == 1 and plan.count("HashAggregate") <= 2


def test_blocked_models(spark):
    results = spark.createDataFrame([("not_null", "a", "x", 3), ("unique", "a", "x", 1), ("not_null", "b", "y", 0), ("unique", "e", "z", 5)],
                                    "test string, model string, column_name string, failures long")
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("a", "c"), ("d", "c"), ("c", "f")], "parent string, child string")
    got = checks.blocked_models(results, edges)
    assert sorted(map(tuple, got.collect())) == [
        ("a", "a", 0, 2, 4), ("b", "a", 1, 2, 4), ("c", "a", 1, 2, 4), ("e", "e", 0, 1, 5), ("f", "a", 2, 2, 4)]
    assert checks.blocked_models(results.where("failures = 0"), edges).collect() == []
