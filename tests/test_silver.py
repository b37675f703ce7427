import datetime as dt
import random

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from silverlode.operators import mapping, silver

RAW_ORDERS = (
    "order_id string, customer_id string, order_status string, order_purchase_timestamp string, order_approved_at string, "
    "order_delivered_carrier_date string, order_delivered_customer_date string, order_estimated_delivery_date string"
)


def order(order_id, customer="c1", status="delivered", bought="2017-10-02 10:56:33", delivered=None, estimated="2017-10-18 00:00:00"):
    return (order_id, customer, status, bought, bought, None, delivered, estimated)


def test_orders_are_renamed_and_typed(frame):
    out = silver.clean_orders(frame([order("o1", status="  DELIVERED ", delivered="2017-10-10 21:25:13")], RAW_ORDERS))
    assert out.columns == [f.target for f in mapping.get_mapping("orders")]
    row = out.first()
    assert row["customer_key"] == "c1" and row["status_code"] == "delivered"
    assert row["order_date"] == dt.datetime(2017, 10, 2, 10, 56, 33)
    assert row["days_to_deliver"] == 8 and row["delivered_on_time"] is True


def test_trim_takes_spaces_only(frame):
    assert silver.clean_orders(frame([order("o1", status="\tShipped\n")], RAW_ORDERS)).first()["status_code"] == "\tshipped\n"


@pytest.mark.parametrize(
    "delivered, estimated, days, on_time",
    [
        (None, "2017-10-18 00:00:00", None, None),
        ("2017-10-10 00:00:00", None, 8, None),
        ("2017-10-18 00:00:00", "2017-10-18 00:00:00", 16, True),
        ("2017-10-19 00:00:00", "2017-10-18 00:00:00", 17, False),
        ("2017-10-03 01:00:00", "2017-10-18 00:00:00", 1, True),
    ],
)
def test_delivery_columns(frame, delivered, estimated, days, on_time):
    rows = [order("o1", bought="2017-10-02 23:00:00", delivered=delivered, estimated=estimated)]
    row = silver.clean_orders(frame(rows, RAW_ORDERS)).first()
    assert (row["days_to_deliver"], row["delivered_on_time"]) == (days, on_time)


def test_null_keys_go_and_duplicates_keep_a_fixed_survivor(frame):
    rows = [order(None), order(None, "c2"), order("o1", "b"), order("o1", "a"), order("o2", None), order("o3")]
    random.Random(1).shuffle(rows)
    df = frame(rows, RAW_ORDERS).repartition(4)
    out = {r["order_id"]: r["customer_key"] for r in silver.clean_orders(df).collect()}
    assert out == {"o1": "a", "o3": "c1"}
    latest = silver.dedup(df, "order_id", ["customer_id"]).where("order_id = 'o1'").first()
    assert latest["customer_id"] == "a"


def test_dedup_keeps_one_row_of_the_null_key(frame):
    assert silver.dedup(frame([(None, 1), (None, 2), ("a", 1)], "k string, v int"), "k").count() == 2


def test_dedup_of_a_hot_key_is_cut_before_the_shuffle(spark):
    df = spark.range(20_000).select(F.when(F.col("id") % 3 > 0, F.col("id")).alias("k"), "id")
    kept = silver.dedup(df, "k")
    assert kept.count() == df.select("k").distinct().count()
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2  # before and after the exchange


def test_counts_are_observed_in_one_job(frame):
    before, after, kept = Observation("before"), Observation("after"), Observation("kept")
    df = frame([("a", 1), ("a", 2), ("b", None), (None, 3)], "k string, v int")
    silver.require_columns(silver.dedup(df, "k", None, before, after), ["k", "v"], None, kept).collect()
    assert (before.get["rows"], after.get["rows"], kept.get["rows"]) == (4, 3, 1)


def test_cleaning_losses(frame):
    df = frame([("a", 1), ("a", 2), ("b", None), (None, 3)], "k string, v int")
    assert silver.cleaning_losses(df, "k", ["k", "v"]).first().asDict() == {
        "rows_read": 4, "duplicates_removed": 1, "nulls_dropped": 2, "rows_kept": 1,
    }


def test_bad_timestamp_fails_or_becomes_null(frame):
    df = frame([order("o1", bought="nope")], RAW_ORDERS)
    with pytest.raises(Exception, match="CAST_INVALID_INPUT|CANNOT_PARSE_TIMESTAMP"):
        silver.clean_orders(df, on_error="fail").collect()
    assert silver.clean_orders(df, on_error="null").first()["order_date"] is None
    with pytest.raises(ValueError):
        silver.clean_orders(df, on_error="skip")


CUSTOMERS = (
    "customer_id string, customer_unique_id string, customer_zip_code_prefix string, customer_city string, customer_state string"
)


@pytest.mark.parametrize(
    "zip_code, city, state, expected",
    [
        ("1310", "SAO PAULO", "sp", ("01310", "Sao Paulo", "SP")),
        ("20040", "rio de janeiro", " RJ ", ("20040", "Rio De Janeiro", "RJ")),
        ("123456", "D'OESTE", "SP", ("12345", "D'oeste", "SP")),
        ("1310.0", " mogi-guacu ", None, ("1310.", "Mogi-guacu", None)),
        (None, None, "MG", (None, None, "MG")),
    ],
)
def test_customers(frame, zip_code, city, state, expected):
    row = silver.clean_customers(frame([("k", "u", zip_code, city, state)], CUSTOMERS)).first()
    assert (row["zip_prefix"], row["city"], row["state_code"]) == expected


ITEMS = "order_id string, order_item_id int, product_id string, seller_id string, shipping_limit_date string, price string, freight_value string"


@pytest.mark.parametrize(
    "price, freight, total",
    [("150.00", "12.50", "162.50"), ("0", "1", "1.00"), ("5", None, None), ("5", "-1", "4.00"), ("-1", "1", "gone"), (None, "1", "gone")],
)
def test_order_items(frame, price, freight, total):
    rows = silver.clean_order_items(frame([("o", 1, "p", "s", "2017-09-19 09:45:35", price, freight)], ITEMS)).collect()
    if total == "gone":
        assert rows == []
    else:
        assert (None if rows[0]["total_item_cost_brl"] is None else str(rows[0]["total_item_cost_brl"])) == total


def test_order_items_keep_duplicates_and_types(frame):
    df = frame([("o", 1, "p", "s", None, "1", "1")] * 2, ITEMS)
    out = silver.clean_order_items(df)
    assert out.count() == 2
    assert {f.target: out.schema[f.target].dataType.simpleString() for f in mapping.get_mapping("order_items")} == {
        f.target: f.type for f in mapping.get_mapping("order_items")
    }


def test_reviews(frame):
    schema = "review_id string, order_id string, review_score string, review_comment_message string, review_creation_date string"
    df = frame([("r1", "o", "5", "  ok ", "2018-01-18"), ("r2", "o", "1", "   ", None), ("r3", None, "1", "x", None)], schema)
    rows = {r["review_id"]: r for r in silver.clean_reviews(df).collect()}
    assert set(rows) == {"r1", "r2"}
    assert rows["r1"]["review_text"] == "ok" and rows["r1"]["rating"] == 5 and rows["r1"]["sentiment_label"] is None
    assert rows["r2"]["review_text"] is None


RATES = "base_currency string, target_currency string, exchange_rate double, rate_timestamp timestamp, fetched_at timestamp"


def test_latest_rate_per_currency(frame):
    day = lambda d: dt.datetime(2024, 1, d)
    df = frame(
        [
            ("usd", "brl", 4.0, day(1), day(1)),
            ("usd", "BRL", 5.0, day(1), day(2)),
            ("usd", "brl", 6.0, day(2), day(2)),
            ("usd", "eur", 0.9, day(1), None),
        ],
        RATES,
    )
    rows = {r["target_currency"]: r for r in silver.latest_rates(df).collect()}
    assert set(rows) == {"BRL", "EUR"}
    assert float(rows["BRL"]["rate"]) == 6.0 and rows["BRL"]["base_currency"] == "USD"


def test_mapping_lookup_and_content():
    assert set(mapping.MAPPINGS) == {"orders", "customers", "order_items", "reviews", "exchange_rates"}
    with pytest.raises(KeyError, match="orders, customers"):
        mapping.get_mapping("nope")
    for table in mapping.MAPPINGS:
        assert all(f.source or f.nullable for f in mapping.get_mapping(table))
        assert mapping.silver_schema(table).fieldNames() == [f.target for f in mapping.get_mapping(table)]


def test_mapping_table(spark):
    assert mapping.mapping_table(spark).where("table = 'orders'").count() == 10


def test_conformance_reports_missing_wrong_and_null(frame):
    df = frame([(None, "u", 7)], "customer_key string, customer_id string, city int")
    found = {r["target_col"]: r["problem"] for r in mapping.conformance(df, "customers").collect()}
    assert found == {
        "customer_key": "nulls not allowed",
        "customer_id": None,
        "city": "wrong type",
        "state_code": "missing column",
        "zip_prefix": "missing column",
    }
