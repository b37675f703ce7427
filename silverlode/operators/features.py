"""Per-customer churn features from the silver tables.

Order lines, reviews and payments are reduced to one row per order (per order and payment type) before they meet
the orders, so neither a busy order nor a busy customer ever sends its raw rows to one task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import elapsed_days
from ..functions.numbering import number_rows
from ..functions.scratch import materialize
from ..functions.selection import exact_median

CHURN_DAYS = 180

# Values used where a customer has none.
DEFAULT_RATING = 3.0

FEATURE_STORE_COLUMNS = (
    "customer_key", "churned", "days_since_last_order", "customer_lifetime_days", "total_orders",
    "avg_days_to_deliver", "late_delivery_count", "late_delivery_rate", "total_spend", "avg_order_value",
    "avg_rating", "review_count", "primary_payment_type", "state_code", "payment_type_encoded", "state_encoded",
)


def _known_customers(orders: DataFrame) -> DataFrame:
    return orders.where(F.col("customer_key").isNotNull())


def reference_date(orders: DataFrame) -> DataFrame:
    """The last order date of the data, one row. The data is historical, so today would call everyone churned."""
    return orders.agg(F.max("order_date").alias("reference_date"))


def _recency(reference: DataFrame, customers: DataFrame, churn_days: int) -> DataFrame:
    since = elapsed_days(F.col("reference_date"), F.col("last_order_date"))
    return (
        customers.crossJoin(F.broadcast(reference))  # one row
        .withColumn("days_since_last_order", since)
        .withColumn("customer_lifetime_days", elapsed_days(F.col("last_order_date"), F.col("first_order_date")))
        .withColumn("churned", F.coalesce(F.col("days_since_last_order") >= churn_days, F.lit(False)).cast("int"))
        .drop("reference_date")
    )


def _order_dates() -> list[Column]:
    return [F.min("order_date").alias("first_order_date"), F.max("order_date").alias("last_order_date")]


def churn_labels(orders: DataFrame, churn_days: int = CHURN_DAYS) -> DataFrame:
    """Recency, lifetime and the label: churned when the last order is ``churn_days`` full days back."""
    customers = _known_customers(orders).groupBy("customer_key").agg(F.count("order_id").alias("total_orders"), *_order_dates())
    return _recency(reference_date(orders), customers, churn_days)


def _order_aggregates() -> list[Column]:
    return [
        F.count("order_id").alias("total_orders"),
        F.avg("days_to_deliver").alias("avg_days_to_deliver"),
        F.count_if(~F.col("delivered_on_time")).alias("late_delivery_count"),
    ]


def _late_rate() -> Column:
    late = F.try_divide(F.col("late_delivery_count").cast("double"), F.col("total_orders").cast("double"))
    return F.coalesce(late, F.lit(0.0))


def order_features(orders: DataFrame) -> DataFrame:
    return (
        _known_customers(orders)
        .groupBy("customer_key")
        .agg(*_order_aggregates())
        .withColumn("late_delivery_rate", _late_rate())
    )


def _spend_per_order(items: DataFrame) -> DataFrame:
    cost = F.col("total_item_cost_brl").cast("decimal(38,2)")
    return items.groupBy("order_id").agg(F.sum(cost).alias("order_cost"), F.count(cost).alias("order_lines"))


def _spend_aggregates() -> list[Column]:
    total = F.sum("order_cost").cast("double")
    return [
        F.coalesce(total, F.lit(0.0)).alias("total_spend"),
        F.try_divide(total, F.sum("order_lines").cast("double")).alias("avg_order_value"),
    ]


def spend_features(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Total spend and mean cost per line of the customers that bought something."""
    customers = _known_customers(orders).select("order_id", "customer_key")
    return customers.join(_spend_per_order(items), "order_id").groupBy("customer_key").agg(*_spend_aggregates())


def _ratings_per_order(reviews: DataFrame) -> DataFrame:
    return reviews.groupBy("order_id").agg(
        F.sum(F.col("rating").cast("long")).alias("order_rating"),
        F.count("rating").alias("order_ratings"),
        F.count("review_id").alias("order_reviews"),
    )


def _review_aggregates() -> list[Column]:
    return [
        F.try_divide(F.sum("order_rating").cast("double"), F.sum("order_ratings").cast("double")).alias("avg_rating"),
        F.sum("order_reviews").alias("review_count"),
    ]


def review_features(orders: DataFrame, reviews: DataFrame) -> DataFrame:
    customers = _known_customers(orders).select("order_id", "customer_key")
    return customers.join(_ratings_per_order(reviews), "order_id").groupBy("customer_key").agg(*_review_aggregates())


def _figures_per_order(items: DataFrame, reviews: DataFrame) -> DataFrame:
    """What ``_spend_per_order`` and ``_ratings_per_order`` give, in one aggregate: one shuffle and one row per order."""
    cost = F.col("total_item_cost_brl").cast("decimal(38,2)")
    nothing = F.lit(None)
    lines = items.select(
        F.col("order_id"), cost.alias("cost"), nothing.cast("long").alias("rating"), F.lit(False).alias("reviewed")
    )
    ratings = reviews.select(
        F.col("order_id"), nothing.cast("decimal(38,2)").alias("cost"), F.col("rating").cast("long").alias("rating"),
        F.col("review_id").isNotNull().alias("reviewed"),
    )
    return lines.unionByName(ratings).groupBy("order_id").agg(
        F.sum("cost").alias("order_cost"),
        F.count("cost").alias("order_lines"),
        F.sum("rating").alias("order_rating"),
        F.count("rating").alias("order_ratings"),
        F.count_if("reviewed").alias("order_reviews"),
    )


def _types_per_order(payments: DataFrame) -> DataFrame:
    """One row per payment type of an order: how often it occurs, and its place among the types of the order from 1."""
    counted = payments.groupBy("order_id", "payment_type").agg(F.count(F.lit(1)).alias("n"))
    return counted.withColumn("nth", F.row_number().over(Window.partitionBy("order_id").orderBy("payment_type")))


def _mode() -> Column:
    """Over rows (payment_type, n): most frequent first, then by name; a NULL type never counts."""
    rank = F.struct((-F.col("n")).alias("n"), "payment_type")
    return F.min(F.when(F.col("payment_type").isNotNull(), rank))["payment_type"]


def primary_payment(orders: DataFrame, payments: DataFrame) -> DataFrame:
    """Most frequent payment type per customer, the lowest name among equals; NULL when every type is NULL."""
    customers = _known_customers(orders).select("order_id", "customer_key")
    per_order = payments.groupBy("order_id", "payment_type").agg(F.count(F.lit(1)).alias("n"))
    counted = (
        customers.join(per_order, "order_id")
        .groupBy("customer_key", "payment_type")
        .agg(F.sum("n").alias("n"))
    )
    return counted.groupBy("customer_key").agg(_mode().alias("primary_payment_type"))


def customer_location(customers: DataFrame) -> DataFrame:
    return customers.select("customer_key", "state_code").distinct()


def assemble(
    orders: DataFrame, customers: DataFrame, items: DataFrame, reviews: DataFrame, payments: DataFrame
) -> DataFrame:
    """All aggregates per customer, before recency, encoding and filling. Orders without a customer form one row
    with a NULL key, since their dates count for the reference date.

    Spend and ratings join the orders as one row per order, payment types as one row each, and all are folded in the same
    aggregate as the order features, so the orders are shuffled once by order and once by customer.
    """
    typed_rows = (
        orders.select("order_id", "customer_key", "order_date", "days_to_deliver", "delivered_on_time")
        .join(_figures_per_order(items, reviews), "order_id", "left")
        .join(_types_per_order(payments), "order_id", "left")
    )
    # one row per payment type of an order; all but the first carry no other figures
    figures = ["order_id", "order_date", "days_to_deliver", "delivered_on_time", "order_cost", "order_lines",
               "order_rating", "order_ratings", "order_reviews"]
    typed = typed_rows.select(
        "customer_key",
        "payment_type",
        "n",
        *[F.when(F.coalesce("nth", F.lit(1)) == 1, F.col(c)).alias(c) for c in figures],
    )
    per_type = typed.groupBy("customer_key", "payment_type").agg(
        F.sum("n").alias("n"),
        *_order_dates(),
        F.count("order_id").alias("orders"),
        F.sum("days_to_deliver").alias("days"),
        F.count("days_to_deliver").alias("deliveries"),
        F.count_if(~F.col("delivered_on_time")).alias("late"),
        *[F.sum(c).alias(c) for c in ("order_cost", "order_lines", "order_rating", "order_ratings", "order_reviews")],
    )
    per_customer = per_type.groupBy("customer_key").agg(
        F.min("first_order_date").alias("first_order_date"),
        F.max("last_order_date").alias("last_order_date"),
        F.sum("orders").alias("total_orders"),
        F.try_divide(F.sum("days").cast("double"), F.sum("deliveries").cast("double")).alias("avg_days_to_deliver"),
        F.sum("late").alias("late_delivery_count"),
        *_spend_aggregates(),
        *_review_aggregates(),
        _mode().alias("primary_payment_type"),
    )
    return per_customer.withColumn("late_delivery_rate", _late_rate()).join(customer_location(customers), "customer_key", "left")


def category_codes(df: DataFrame, column: str, code: str) -> DataFrame:
    """The distinct values of ``column`` with their place 0, 1, 2... in sorted order, ranked in ranges."""
    values = df.where(F.col(column).isNotNull()).select(column).distinct()
    return number_rows(values, [column], "_n").select(column, (F.col("_n") - 1).cast("int").alias(code))


def encode_categories(source: DataFrame, codes: dict[str, str], df: DataFrame | None = None) -> DataFrame:
    """Add to ``df`` (by default ``source``) the sorted code of each column of ``codes`` (column -> code name);
    NULL becomes -1.

    The values come from ``source``, a written table; the columns hold text. All columns are numbered in one go and the codes
    of each start at its first number. The joins are left to adaptive execution, which knows how long the lists of values
    came out.
    """
    stacked = reduce(DataFrame.unionByName, [source.select(F.lit(c).alias("name"), F.col(c).alias("value")) for c in codes])
    numbered = number_rows(stacked.where(F.col("value").isNotNull()).distinct(), ["name", "value"], "_n")
    firsts = numbered.groupBy("name").agg(F.min("_n").alias("_first"))  # one row per column
    listed = numbered.join(F.broadcast(firsts), "name")
    coded = source if df is None else df
    for column, code in codes.items():
        own = listed.where(F.col("name") == column)
        own = own.select(F.col("value").alias(column), (F.col("_n") - F.col("_first")).cast("int").alias(code))
        coded = coded.join(own, column, "left")
        coded = coded.withColumn(code, F.coalesce(code, F.lit(-1)))
    return coded


def impute(df: DataFrame, source: DataFrame | None = None) -> DataFrame:
    """Fill what customers lack: a neutral rating, zero counts and sums, the median delivery time of ``source``."""
    median = exact_median(df if source is None else source, "avg_days_to_deliver", "_median")
    return (
        df.crossJoin(F.broadcast(median))  # one row
        .withColumn("avg_days_to_deliver", F.coalesce("avg_days_to_deliver", "_median"))
        .drop("_median")
        .fillna({"avg_rating": DEFAULT_RATING, "review_count": 0, "total_spend": 0.0, "avg_order_value": 0.0})
    )


def build_features(
    orders: DataFrame,
    customers: DataFrame,
    items: DataFrame,
    reviews: DataFrame,
    payments: DataFrame,
    churn_days: int = CHURN_DAYS,
) -> DataFrame:
    """The feature store, one row per customer with an order.

    The assembled aggregates are materialised once; the reference date, the codes and the median each read single
    columns of that table.
    """
    assembled = materialize(assemble(orders, customers, items, reviews, payments), "features")
    reference = assembled.agg(F.max("last_order_date").alias("reference_date"))
    known = _known_customers(assembled)
    filled = impute(_recency(reference, known, churn_days), known)
    codes = {"primary_payment_type": "payment_type_encoded", "state_code": "state_encoded"}
    return encode_categories(known, codes, filled).select(*FEATURE_STORE_COLUMNS)
