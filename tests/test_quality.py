import math

import pytest

from silverlode.operators import quality as q


def run(df, *checks):
    return q.run_checks(df, "t", checks).collect()


def one(df, check):
    return run(df, check)[0]


def test_no_nulls(frame):
    assert one(frame([("a",), ("b",)], "x string"), q.no_nulls("x")).passed
    bad = one(frame([("a",), (None,), (None,)], "x string"), q.no_nulls("x"))
    assert not bad.passed and bad.violations == 2 and "2" in bad.message


def test_nan_counts_as_null(frame):
    assert one(frame([(1.0,), (math.nan,)], "x double"), q.no_nulls("x")).violations == 1


def test_values_in(frame):
    assert one(frame([("delivered",), (None,)], "x string"), q.values_in("x", ["delivered"])).passed
    bad = one(frame([("delivered",), ("UNKNOWN",)], "x string"), q.values_in("x", ["delivered"]))
    assert not bad.passed and "UNKNOWN" in bad.message


@pytest.mark.parametrize(
    "value, kind, allowed, passed",
    [(1, "int", (1, 2), True), (3, "int", (1, 2), False), (True, "boolean", (True,), True), (True, "boolean", (False,), False), (1, "int", ("1",), True)],
)
def test_values_in_of_any_type(frame, value, kind, allowed, passed):
    assert one(frame([(value,)], f"x {kind}"), q.values_in("x", allowed)).passed is passed


def test_values_in_shows_at_most_five(frame):
    bad = one(frame([(i,) for i in range(50)] * 2, "x int"), q.values_in("x", [100]))
    assert bad.violations == 100 and bad.message.endswith("such as: 0, 1, 2, 3, 4")


@pytest.mark.parametrize(
    "values, kind, mostly, passed, violations",
    [
        ([1.0, 3.0, 5.0], "double", 1.0, True, 0),
        ([1.0, 6.0, 3.0], "double", 1.0, False, 1),
        ([1.0] * 99 + [9.0], "double", 0.99, True, 1),
        ([1.0] * 98 + [9.0] * 2, "double", 0.99, False, 2),
        ([math.nan, 2.0], "double", 1.0, True, 0),
        ([math.inf, 2.0], "double", 1.0, False, 1),
        ([None, None], "double", 1.0, True, 0),
        (["2", "x", "7"], "string", 1.0, False, 1),
        (["x", "y"], "string", 1.0, True, 0),
    ],
)
def test_values_between(frame, values, kind, mostly, passed, violations):
    row = one(frame([(v,) for v in values], f"x {kind}"), q.values_between("x", 1, 5, mostly))
    assert (row.passed, row.violations) == (passed, violations)


def test_row_count(frame):
    df = frame([(i,) for i in range(100)], "x int")
    assert one(df, q.row_count(50, 200)).passed
    bad = one(df, q.row_count(500, 2000))
    assert not bad.passed and "100" in bad.message and "[500, 2,000]" in bad.message


def test_unique_ignores_nulls(frame):
    assert one(frame([("a",), ("b",), (None,), (None,)], "x string"), q.unique("x")).passed
    bad = one(frame([("a",), ("a",), ("a",), ("b",)], "x string"), q.unique("x"))
    assert not bad.passed and bad.violations == 2


def test_unknown_or_unfit_column_is_a_failed_check(frame):
    df = frame([("a",)], "x string").selectExpr("x", "current_date() AS d")
    rows = run(df, q.no_nulls("nope"), q.values_between("d", 0, 1), q.no_nulls("x"))
    assert [r.passed for r in rows] == [False, False, True]
    assert "nope" in rows[0].message


def test_empty_table(frame):
    rows = run(frame([], "x string"), q.no_nulls("x"), q.unique("x"), q.values_in("x", ["a"]), q.values_between("x", 0, 1))
    assert all(r.passed for r in rows)


def test_suite_counts_and_gate(frame):
    df = frame([("o1", "delivered"), ("o2", "INVALID")], "order_id string, status_code string")
    results = q.run_checks(df, "orders", [q.no_nulls("order_id"), q.values_in("status_code", q.ORDER_STATES)])
    assert q.summarize(results).first()[1:] == (1, 1, 2, False)
    assert q.overall(results).first() == (1, 2, False)
    with pytest.raises(q.QualityError) as error:
        q.require_quality(results)
    assert (error.value.passed, error.value.total) == (1, 2) and "INVALID" in str(error.value)
    assert q.require_quality(results.where("passed")) == {"checks_passed": 1, "checks_total": 1}


def test_suite_sizes():
    assert (len(q.orders_suite()), len(q.order_items_suite()), len(q.reviews_suite())) == (7, 5, 4)
    assert sum(map(len, q.GOLD_SUITES.values())) == 11


def test_counts_take_one_pass_without_a_row_shuffle(frame):
    df = frame([("a", 1.0)], "x string, y double")
    plan = q.run_checks(df, "t", [q.no_nulls("x"), q.no_nulls("y"), q.values_between("y", 0, 1)])
    assert plan._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1  # the one-row totals


def test_only_failed_checks_are_sampled(spark, monkeypatch):
    df = spark.createDataFrame([(1, "a", "x"), (2, "b", None), (3, "c", "z")], "k int, good string, bad string")
    looked = []
    monkeypatch.setattr(q, "_bad_sample", lambda df, check, name, old=q._bad_sample: looked.append(check.column) or old(df, check, name))
    checks = [q.unique("k"), q.values_in("good", ["a", "b", "c"]), q.values_in("bad", ["x"]), q.row_count(1, 5)]
    results = q.run_checks(df, "t", checks).collect()
    assert looked == ["bad"]
    assert [r.passed for r in results] == [True, True, False, True]
    assert results[2].violations == 1 and results[2].message.endswith("such as: z")
    assert [r.passed for r in q.run_checks(df.limit(0), "t", checks[:3]).collect()] == [True, True, True]
    assert looked == ["bad"]
