import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from silverlode.operators import annotate, gold

DAY = dt.datetime(2017, 10, 2, 8)


def orders(spark, rows=None):
    rows = rows or [("o1", "c1"), ("o2", "c2"), ("o3", "c1"), (None, "c1"), ("o9", None)]
    return gold.stg_orders(
        spark.createDataFrame(
            [(o, c, "delivered", DAY, DAY, DAY, None, DAY, None, None) for o, c in rows],
            "order_id string, customer_key string, status_code string, order_date timestamp, approved_date timestamp, shipped_date timestamp, "
            "delivered_date timestamp, estimated_delivery_date timestamp, days_to_deliver int, delivered_on_time boolean",
        )
    )


def items(spark, rows=None):
    rows = rows or [("o1", 1, "10.00"), ("o1", 2, "20.00"), ("o2", 1, "7.55"), ("o3", 1, "1.00"), ("zz", 1, "5.00"), ("o3", 2, "-1.00")]
    return gold.stg_order_items(
        spark.createDataFrame([(o, n, "p", "s", DAY, p, "1.00", p) for o, n, p in rows],
            "order_id string, order_item_id int, product_key string, seller_id string, shipping_deadline timestamp, item_price_brl string, "
            "freight_cost_brl string, total_item_cost_brl string",
        ).selectExpr("* EXCEPT (item_price_brl, freight_cost_brl, total_item_cost_brl)",
            *[f"CAST({c} AS DECIMAL(10,2)) AS {c}" for c in ("item_price_brl", "freight_cost_brl", "total_item_cost_brl")])
    )


def reviews(spark, rows=None):
    rows = rows or [("r1", "o2", 5, DAY), ("r2", "o3", 1, DAY), ("r3", "o3", 2, DAY - dt.timedelta(days=1))]
    df = spark.createDataFrame([(*r[:3], "text", r[3]) for r in rows], "review_id string, order_id string, rating int, review_text string, review_date timestamp")
    return gold.stg_reviews(annotate.with_annotation_columns(df))


def rates(spark, rate="5.00"):
    rows = [("USD", "BRL", rate, DAY), ("USD", "EUR", "0.9", DAY)] if rate else [("USD", "EUR", "0.9", DAY)]
    df = spark.createDataFrame(rows, "base_currency string, target_currency string, rate string, captured_at timestamp")
    return gold.stg_exchange_rates(df.withColumn("rate", F.col("rate").cast("decimal(18,6)")))


def test_fact(spark):
    fact = gold.fact_orders(orders(spark), items(spark), reviews(spark), rates(spark))
    assert tuple(fact.columns) == gold.FACT_COLUMNS
    rows = fact.orderBy("fact_id").collect()
    # no review: one row per line; two reviews: two rows; orphan and negative lines: none
    assert [(r["fact_id"], r["order_id"], r["order_item_id"], r["review_rating"]) for r in rows] == [
        (1, "o1", 1, None), (2, "o1", 2, None), (3, "o2", 1, 5), (4, "o3", 1, 1), (5, "o3", 1, 2),
    ]
    assert rows[2]["item_price_usd"] == Decimal("1.51") and rows[2]["date_key"] == 20171002
    assert rows[2]["exchange_rate_used"] == Decimal("5.000000")


def test_fact_with_one_review_per_order(spark):
    fact = gold.fact_orders(orders(spark), items(spark), reviews(spark), rates(spark), single_review=True)
    assert [(r["order_id"], r["review_rating"]) for r in fact.orderBy("fact_id").collect()] == [("o1", None), ("o1", None), ("o2", 5), ("o3", 2)]


def test_fact_without_a_local_rate_is_empty(spark):
    assert gold.fact_orders(orders(spark), items(spark), reviews(spark), rates(spark, None)).count() == 0


def test_zero_rate_raises(spark):
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO|division by zero"):
        gold.fact_orders(orders(spark), items(spark), reviews(spark), rates(spark, "0")).collect()


def test_fact_with_a_hot_order(spark):
    many = [("o1", i % 50, f"{i % 9}.00") for i in range(300)] + [(f"o{i % 40}", 1, "3.00") for i in range(600)]
    stars = [(f"r{i}", "o2" if i % 3 == 0 else f"o{i % 40}", i % 5 + 1, DAY) for i in range(90)]
    sources = orders(spark, [(f"o{i}", f"c{i % 7}") for i in range(40)]), items(spark, many), reviews(spark, stars), rates(spark)
    plain = gold.fact_orders(*sources)
    cut = gold.fact_orders(*sources, hot_options={"rows_per_task": 20})
    assert plain.count() == cut.count() and plain.exceptAll(cut).count() == 0
    window = Window.orderBy("order_id", "order_item_id")
    checked = plain.withColumn("low", F.rank().over(window)).withColumn("ties", F.count("*").over(Window.partitionBy("order_id", "order_item_id")))
    assert checked.where("fact_id < low OR fact_id >= low + ties").count() == 0


def test_newest_rate(spark):
    rows = [("BRL", "4.0", DAY), ("BRL", "5.0", DAY + dt.timedelta(days=1)), ("EUR", "0.9", DAY + dt.timedelta(days=9))]
    df = spark.createDataFrame(rows, "target_currency string, rate string, captured_at timestamp").withColumn("rate", F.col("rate").cast("decimal(18,6)"))
    row = gold.stg_exchange_rates(df).first()
    assert float(row["brl_per_usd"]) == 5.0 and float(row["usd_per_brl"]) == pytest.approx(0.2)


@pytest.mark.parametrize("weight, name", [(500, "light"), (501, "medium"), (5000, "medium"), (5001, "heavy"), (None, "heavy")])
def test_weight_category(spark, weight, name):
    df = spark.createDataFrame([("p", None, weight, 1, 1, 1), (None, "x", 1, 1, 1, 1)],
        "product_id string, product_category_name string, product_weight_g int, product_length_cm int, product_height_cm int, product_width_cm int")
    rows = gold.dim_product(gold.stg_products(df)).collect()
    assert len(rows) == 1 and rows[0]["weight_category"] == name and rows[0]["category_name"] == "unknown"


def test_calendar(spark):
    rows = {r["date_key"]: r for r in gold.dim_date(gold.calendar_span(spark)).collect()}
    assert len(rows) == 1461 and min(rows) == 20160101 and max(rows) == 20191231
    first = rows[20160101]
    assert (first["week_of_year"], first["day_of_week"], first["day_name"], first["month_name"]) == (53, 5, "Friday   ", "January  ")
    assert rows[20160103]["is_weekend"] and rows[20160103]["day_of_week"] == 7
    assert (first["quarter_label"], first["year_month"]) == ("Q1", "2016-01")


def test_customer_dimension(spark):
    customers = spark.createDataFrame([(c, "u", "X", "SP", "01310") for c in ("c1", "c2", "c3", "c4")], "customer_key string, customer_id string, city string, state_code string, zip_prefix string")
    scores = spark.createDataFrame([("c1", 0.9, "high", 1), ("c2", 0.1, "low", None), ("c3", 0.0, None, 0), (None, 0.5, "medium", 1)],
        "customer_key string, churn_score double, churn_risk string, predicted_churn int")
    rows = {r["customer_key"]: r for r in gold.dim_customer(gold.stg_customers(customers), gold.stg_churn_scores(scores)).collect()}
    assert {k: (r["churn_score"], r["churn_risk"], r["predicted_churn"], r["customer_segment"]) for k, r in rows.items()} == {
        "c1": (0.9, "high", True, "At Risk"),
        "c2": (0.1, "low", False, "Loyal"),
        "c3": (0.0, "unknown", False, "Unknown"),
        "c4": (0.0, "unknown", False, "Unknown"),
    }


def test_fact_takes_its_reviews_once_and_writes_no_row_to_number_it(spark):
    """Reviews are told apart by their texts on the way; the search for hot orders and the joins share one pass over them."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    source = reviews(spark)
    counted = source.mapInArrow(count, source.schema)
    fact = gold.fact_orders(orders(spark), items(spark), counted, rates(spark))
    assert fact.count() == 5 and seen.value == 3
    assert not any("/numbered-" in path for path in fact.inputFiles())
