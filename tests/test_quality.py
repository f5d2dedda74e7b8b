import pytest

from assaymill.operators import quality as q


def test_check_nulls(spark):
    df = spark.createDataFrame([("a", 1), ("b", None), ("c", 2)], "name string, val int")
    assert q.check_nulls(df, ["val"], threshold=0.4) is True
    assert q.check_nulls(df, ["val"], threshold=0.2) is False
    assert q.check_nulls(df, ["name", "val"]) is False
    assert q.check_nulls(df.limit(0), ["val"]) is True


def test_check_unique(spark):
    df = spark.createDataFrame([("k1", 10), ("k2", 20), ("k1", 30)], ["pk", "val"])
    assert q.check_unique(df, ["pk"]) is False
    assert q.check_unique(df, ["pk", "val"]) is True
    assert q.check_unique(df.filter("val < 30"), ["pk"]) is True
    nulls = spark.createDataFrame([(None,), (None,)], "pk string")
    assert q.check_unique(nulls, ["pk"]) is False


def test_check_range(spark):
    df = spark.createDataFrame([(10,), (50,), (110,), (None,)], "val int")
    assert q.check_range(df, "val", 0, 100) is False
    assert q.check_range(df, "val", 0, 120) is True
    assert q.check_range(df, "val", 10, 110) is True


def test_check_allowed_values(spark):
    df = spark.createDataFrame([("delivered",), ("shipped",), ("unknown",), (None,)], "status string")
    allowed = ["delivered", "shipped", "canceled"]
    assert q.check_allowed_values(df, "status", allowed) is False
    assert q.check_allowed_values(df.filter("status <> 'unknown'"), "status", allowed) is True
    assert [r.status for r in q.offending_values(df, "status", allowed).collect()] == ["unknown"]


def test_anomaly_rules(spark):
    df = spark.createDataFrame(
        [("o1", "a", 150.5, 8.16), ("o2", "", -10.0, -120.0), ("o3", "c", 0.0, 99.0)],
        ["order_id", "customer_id", "value", "temperature"],
    )
    rules = [
        q.InRange("temperature", -50, 50),
        q.InRange("value", 0, 1e9),
        q.NotBlank("customer_id"),
    ]
    assert [r.failed for r in q.run_suite(df, rules, "t").collect()] == [2, 1, 1]


def test_suite_of_row_rules_is_one_scan(spark):
    df = spark.createDataFrame([(1, "x")], ["a", "b"])
    rules = [q.NotNull("a"), q.InRange("a", 0, 5), q.InSet("b", ("x",)), q.OfType("a", "bigint")]
    plan = q.run_suite(df, rules, "t")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1


def test_schema_rules_fail_on_wrong_shape(spark):
    df = spark.createDataFrame([(1, "x")], ["a", "b"])
    report = q.run_suite(df, [q.ColumnsInOrder(("b", "a")), q.OfType("a", "string")], "t")
    assert [r.passed for r in report.collect()] == [False, False]
    empty = q.run_suite(df.limit(0), [q.ColumnsInOrder(("b",))], "t")
    assert [r.passed for r in empty.collect()] == [False]


def test_enforce(spark):
    df = spark.createDataFrame([("k",), ("k",)], ["pk"])
    with pytest.raises(q.DataQualityError, match="unique_key"):
        q.enforce(q.run_suite(df, [q.UniqueKey(("pk",))], "t"))
    q.enforce(q.run_suite(df, [q.NotNull("pk")], "t"))
