import datetime as dt

import numpy as np
import pandas as pd
import pytest

from silverlode.operators import features as f

ORDERS = "order_id string, customer_key string, order_date timestamp, days_to_deliver int, delivered_on_time boolean"
LAST = dt.datetime(2018, 10, 1)


def small(spark):
    days = lambda n, h=0: LAST - dt.timedelta(days=n, hours=h)
    orders = spark.createDataFrame(
        [
            ("o1", "c1", days(179, 23), 3, True),
            ("o2", "c2", days(180), 4, False),
            ("o3", "c2", days(400), None, None),
            ("o4", "c3", LAST, 7, False),
            ("o5", "c4", None, None, None),
            ("o6", None, days(-5), 1, True),
        ],
        ORDERS,
    )
    customers = spark.createDataFrame([("c1", "SP"), ("c2", "RJ"), ("c2", "RJ"), ("c3", None), ("c9", "AM")], "customer_key string, state_code string")
    items = spark.createDataFrame(
        [("o1", "10.10"), ("o1", "20.20"), ("o2", "5.00"), ("o3", "7.00"), ("o3", None), ("o4", None), ("zz", "9.00")],
        "order_id string, cost string",
    ).selectExpr("order_id", "CAST(cost AS DECIMAL(10,2)) AS total_item_cost_brl")
    reviews = spark.createDataFrame(
        [("r1", "o1", 5), ("r2", "o2", 1), ("r3", "o3", 4), ("r4", "o3", None), ("r5", "zz", 1)], "review_id string, order_id string, rating int"
    )
    payments = spark.createDataFrame(
        [("o1", "b"), ("o1", "a"), ("o2", "card"), ("o2", "card"), ("o3", "boleto"), ("o4", None), ("o4", None)],
        "order_id string, payment_type string",
    )
    return orders, customers, items, reviews, payments


def by_key(df, key="customer_key"):
    return {r[key]: r for r in df.collect()}


def test_churn_label_counts_full_days(spark):
    orders = small(spark)[0].where("order_id <> 'o6'")
    rows = by_key(f.churn_labels(orders))
    assert {k: (r["days_since_last_order"], r["churned"]) for k, r in rows.items()} == {
        "c1": (179, 0), "c2": (180, 1), "c3": (0, 0), "c4": (None, 0),
    }
    assert rows["c2"]["customer_lifetime_days"] == 220


def test_order_features(spark):
    rows = by_key(f.order_features(small(spark)[0]))
    assert set(rows) == {"c1", "c2", "c3", "c4"}
    assert (rows["c2"]["late_delivery_count"], rows["c2"]["late_delivery_rate"], rows["c2"]["avg_days_to_deliver"]) == (1, 0.5, 4.0)


def test_primary_payment_prefers_the_lowest_of_equals(spark):
    orders, _, _, _, payments = small(spark)
    rows = by_key(f.primary_payment(orders, payments))
    assert {k: r["primary_payment_type"] for k, r in rows.items()} == {"c1": "a", "c2": "card", "c3": None}


def test_feature_store(spark):
    out = f.build_features(*small(spark))
    assert tuple(out.columns) == f.FEATURE_STORE_COLUMNS
    rows = by_key(out)
    assert set(rows) == {"c1", "c2", "c3", "c4"}
    # the order without a customer sets the reference date five days later
    assert rows["c3"]["days_since_last_order"] == 5 and rows["c1"]["churned"] == 1
    assert rows["c1"]["total_spend"] == 30.3 and rows["c1"]["avg_order_value"] == pytest.approx(15.15)
    assert rows["c2"]["total_spend"] == 12.0 and rows["c2"]["avg_order_value"] == 6.0
    assert rows["c2"]["avg_rating"] == 2.5 and rows["c2"]["review_count"] == 3
    assert (rows["c3"]["total_spend"], rows["c3"]["avg_rating"], rows["c3"]["review_count"]) == (0.0, 3.0, 0)
    assert rows["c4"]["avg_days_to_deliver"] == 4.0  # median of 3, 4 and 7
    assert {k: r["payment_type_encoded"] for k, r in rows.items()} == {"c1": 0, "c2": 1, "c3": -1, "c4": -1}
    assert {k: r["state_encoded"] for k, r in rows.items()} == {"c1": 1, "c2": 0, "c3": -1, "c4": -1}


def test_long_category_lists_are_ranked_in_ranges(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("c",), ("a",)], "x string")
    coded = f.encode_categories(df, {"x": "code"})
    assert {r["x"]: r["code"] for r in coded.collect()} == {"a": 0, "b": 1, "c": 2, None: -1}
    assert coded.count() == 5


def test_the_orders_are_shuffled_once_by_order_and_once_by_customer(spark):
    schema = "order_id string, customer_key string, order_date timestamp, days_to_deliver int, delivered_on_time boolean"
    orders = f.materialize(spark.createDataFrame([], schema), "orders")
    items = spark.createDataFrame([], "order_id string, total_item_cost_brl decimal(10,2)")
    reviews = spark.createDataFrame([], "order_id string, review_id string, rating int")
    payments = spark.createDataFrame([], "order_id string, payment_type string")
    customers = spark.createDataFrame([], "customer_key string, state_code string")
    plan = f.assemble(orders, customers, items, reviews, payments)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1


def test_features_against_pandas(spark):
    rng = np.random.default_rng(5)
    n = 600
    hot = np.where(rng.random(n) < 0.33, 0, rng.integers(0, 60, n))
    orders = pd.DataFrame(
        {
            "order_id": [f"o{i}" for i in range(n)],
            "customer_key": [f"c{i}" for i in hot],
            "order_date": pd.Timestamp("2018-01-01") + pd.to_timedelta(rng.integers(0, 400 * 24, n), unit="h"),
            "days_to_deliver": rng.integers(1, 40, n).astype("int32"),
            "delivered_on_time": rng.random(n) < 0.7,
        }
    )
    lines = pd.DataFrame({"order_id": [f"o{i}" for i in rng.integers(0, n, 2000)], "total_item_cost_brl": rng.integers(100, 9999, 2000) / 100})
    lines.loc[:600, "order_id"] = "o3"  # a third of all lines on one order
    reviews = pd.DataFrame({"order_id": [f"o{i}" for i in rng.integers(0, n, 700)], "rating": rng.integers(1, 6, 700).astype("int32")})
    reviews["review_id"] = [f"r{i}" for i in range(700)]
    payments = pd.DataFrame({"order_id": [f"o{i}" for i in rng.integers(0, n, 900)], "payment_type": rng.choice(list("abcd"), 900)})
    customers = pd.DataFrame({"customer_key": [f"c{i}" for i in range(60)], "state_code": rng.choice(["SP", "RJ", "MG"], 60)})

    owner = orders[["order_id", "customer_key"]]
    want = orders.groupby("customer_key").agg(total_orders=("order_id", "count"), avg_days_to_deliver=("days_to_deliver", "mean"), last=("order_date", "max"))
    want["days_since_last_order"] = (orders["order_date"].max() - want["last"]).dt.days
    spend = lines.merge(owner).groupby("customer_key")["total_item_cost_brl"].agg(["sum", "mean"])
    want["total_spend"], want["avg_order_value"] = spend["sum"], spend["mean"]
    want["avg_rating"] = reviews.merge(owner).groupby("customer_key")["rating"].mean()
    want["primary_payment_type"] = payments.merge(owner).groupby("customer_key")["payment_type"].agg(lambda x: x.mode().iloc[0])

    to_spark = spark.createDataFrame
    items = to_spark(lines).selectExpr("order_id", "CAST(total_item_cost_brl AS DECIMAL(10,2)) AS total_item_cost_brl")
    got = f.build_features(to_spark(orders), to_spark(customers), items, to_spark(reviews), to_spark(payments)).toPandas().set_index("customer_key")
    assert len(got) == len(want)
    got = got.loc[want.index]
    for column in ("total_orders", "avg_days_to_deliver", "days_since_last_order"):
        np.testing.assert_allclose(got[column], want[column])
    np.testing.assert_allclose(got["total_spend"], want["total_spend"].fillna(0))
    np.testing.assert_allclose(got["avg_order_value"], want["avg_order_value"].fillna(0))
    np.testing.assert_allclose(got["avg_rating"], want["avg_rating"].fillna(3.0))
    assert got["primary_payment_type"].fillna("-").tolist() == want["primary_payment_type"].fillna("-").tolist()
    assert got["state_encoded"].tolist() == customers.set_index("customer_key").loc[want.index, "state_code"].astype("category").cat.codes.tolist()


def test_types_of_an_order_are_never_one_row(spark):
    """An order with very many payment types stays as many rows, and spend and ratings meet it in one aggregate."""
    orders, customers, items, reviews, _ = small(spark)
    payments = spark.range(1000).selectExpr("'o1' AS order_id", "concat('t', id % 500) AS payment_type")
    assembled = f.assemble(orders, customers, items, reviews, payments)
    plan = assembled._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" not in plan and "posexplode" not in plan
    row = by_key(assembled)["c1"]
    assert (row["total_orders"], row["primary_payment_type"], row["total_spend"]) == (1, "t0", 30.3)
    assert (row["avg_rating"], row["review_count"], row["avg_days_to_deliver"]) == (5.0, 1, 3.0)
