"""Silver to gold: staging projections, dimensions and the order-line fact table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.columns import MONEY, date_key
from ..functions.numbering import number_rows, running_total
from ..functions.scratch import free_shuffles, materialize
from ..functions.skew import count_keys, hot_counts, hot_keys, salted_join

LOCAL_CURRENCY = "BRL"

# First and last day of the calendar, weight limits in grams, and the segment of each risk tier.
CALENDAR = ("2016-01-01", "2019-12-31")
LIGHT_UP_TO, MEDIUM_UP_TO = 500, 5000
SEGMENTS = {"high": "At Risk", "medium": "Watch", "low": "Loyal"}

# What can tell two fact rows of the same order line apart; the order's own columns cannot.
LINE_COLUMNS = (
    "product_key", "item_price_brl", "freight_cost_brl", "total_amount_brl", "review_rating", "sentiment_label", "review_topic",
)

FACT_COLUMNS = (
    "fact_id", "order_id", "customer_key", "product_key", "date_key", "order_item_id", "status_code",
    "order_date", "delivered_date", "days_to_deliver", "delivered_on_time", "item_price_brl",
    "freight_cost_brl", "total_amount_brl", "item_price_usd", "freight_cost_usd", "total_amount_usd",
    "exchange_rate_used", "review_rating", "sentiment_label", "review_topic",
)


def _present(df: DataFrame, *columns: str) -> DataFrame:
    return df.dropna(how="any", subset=list(columns))


def stg_orders(orders: DataFrame) -> DataFrame:
    return _present(orders, "order_id", "customer_key", "order_date").select(
        "order_id", "customer_key", "status_code", "order_date", "approved_date", "shipped_date",
        "delivered_date", "estimated_delivery_date", "days_to_deliver", "delivered_on_time",
    )


def stg_customers(customers: DataFrame) -> DataFrame:
    return _present(customers, "customer_key").select("customer_key", "customer_id", "city", "state_code", "zip_prefix")


def stg_order_items(items: DataFrame) -> DataFrame:
    return (
        _present(items, "order_id", "product_key")
        .where(F.col("item_price_brl") >= 0)
        .select(
            "order_id", "order_item_id", "product_key", "seller_id", "shipping_deadline",
            *[F.col(c).cast(MONEY).alias(c) for c in ("item_price_brl", "freight_cost_brl", "total_item_cost_brl")],
        )
    )


def stg_reviews(reviews: DataFrame) -> DataFrame:
    """``reviews`` carries the annotation columns (see ``annotate.with_annotation_columns``)."""
    return _present(reviews, "review_id", "order_id").select(
        "review_id", "order_id", "rating", "review_text", "review_date",
        "sentiment_label", "annotation_confidence", "primary_topic",
    )


def stg_products(raw_products: DataFrame) -> DataFrame:
    return _present(raw_products, "product_id").select(
        F.col("product_id").alias("product_key"),
        F.coalesce("product_category_name", F.lit("unknown")).alias("category_name"),
        F.col("product_weight_g").alias("weight_grams"),
        F.col("product_length_cm").alias("length_cm"),
        F.col("product_height_cm").alias("height_cm"),
        F.col("product_width_cm").alias("width_cm"),
    )


def stg_exchange_rates(rates: DataFrame) -> DataFrame:
    """The newest local-currency rate: one row, or none."""
    return (
        rates.where(F.col("target_currency") == LOCAL_CURRENCY)
        .orderBy(F.desc_nulls_first("captured_at"), F.desc_nulls_last("rate"))
        .limit(1)
        .select(
            F.col("rate").alias("brl_per_usd"),
            (F.lit(1.0).cast("decimal(2,1)") / F.col("rate")).alias("usd_per_brl"),
            F.col("captured_at").alias("rate_date"),
        )
    )


def stg_churn_scores(scores: DataFrame) -> DataFrame:
    return _present(scores, "customer_key").select(
        "customer_key",
        F.col("churn_score").cast("double").alias("churn_score"),
        "churn_risk",
        F.coalesce(F.col("predicted_churn") == 1, F.lit(False)).alias("predicted_churn"),
    )


def customer_segment(risk: Column) -> Column:
    segment = F.lit("Unknown")
    for tier, name in SEGMENTS.items():
        segment = F.when(risk == tier, name).otherwise(segment)
    return segment


def dim_customer(customers: DataFrame, scores: DataFrame) -> DataFrame:
    """``customers`` and ``scores`` as staged. Both have one row per customer, so the join has no hot key."""
    return (
        customers.join(scores, "customer_key", "left")
        .withColumns(
            {
                "churn_score": F.coalesce("churn_score", F.lit(0.0)),
                "churn_risk": F.coalesce("churn_risk", F.lit("unknown")),
                "predicted_churn": F.coalesce("predicted_churn", F.lit(False)),
            }
        )
        .withColumn("customer_segment", customer_segment(F.col("churn_risk")))
    )


def dim_product(products: DataFrame) -> DataFrame:
    weight = F.col("weight_grams")
    return products.withColumn(
        "weight_category",
        F.when(weight <= LIGHT_UP_TO, "light").when(weight <= MEDIUM_UP_TO, "medium").otherwise("heavy"),
    )


def dim_date(span: DataFrame) -> DataFrame:
    """One row per day from ``first_day`` to ``last_day`` of the one-row ``span``."""
    day = F.col("full_date")
    weekday = F.weekday(day) + 1
    return span.select(F.explode(F.sequence("first_day", "last_day", F.expr("INTERVAL 1 DAY"))).alias("full_date")).select(
        date_key(day).alias("date_key"),
        "full_date",
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        F.rpad(F.date_format(day, "MMMM"), 9, " ").alias("month_name"),
        F.weekofyear(day).alias("week_of_year"),
        weekday.alias("day_of_week"),
        F.rpad(F.date_format(day, "EEEE"), 9, " ").alias("day_name"),
        (weekday >= 6).alias("is_weekend"),
        F.concat(F.lit("Q"), F.quarter(day).cast("string")).alias("quarter_label"),
        F.date_format(day, "yyyy-MM").alias("year_month"),
    )


def calendar_span(spark: SparkSession, first_day: str = CALENDAR[0], last_day: str = CALENDAR[1]) -> DataFrame:
    return spark.range(1).select(F.lit(first_day).cast("date").alias("first_day"), F.lit(last_day).cast("date").alias("last_day"))


def fixed_and(span: DataFrame, first_day: str = CALENDAR[0], last_day: str = CALENDAR[1]) -> DataFrame:
    """The fixed calendar, widened where the given span goes beyond it, so that every day of the data has a row."""
    first, last = F.lit(first_day).cast("date"), F.lit(last_day).cast("date")
    return span.select(F.least("first_day", first).alias("first_day"), F.greatest("last_day", last).alias("last_day"))


def span_of(df: DataFrame, column: str) -> DataFrame:
    """The calendar span a date column covers."""
    day = F.col(column).cast("date")
    return df.agg(F.min(day).alias("first_day"), F.max(day).alias("last_day"))


def one_review_per_order(reviews: DataFrame) -> DataFrame:
    """The first review of each order by date, then id."""
    first = Window.partitionBy("order_id").orderBy(F.asc_nulls_last("review_date"), "review_id")
    return reviews.withColumn("_nth", F.row_number().over(first)).where(F.col("_nth") == 1).drop("_nth")


def _parts_of_lines(
    orders: DataFrame, items: DataFrame, reviews: DataFrame, single_review: bool = False
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The columns of order lines, orders and reviews that fact rows are made of.

    Orders and reviews are deduplicated on the way here, the reviews by their texts too, and are read more than once below; so
    the few columns of them are written.
    """
    review_columns = (one_review_per_order(reviews) if single_review else reviews).select(
        "order_id",
        F.col("rating").alias("review_rating"),
        "sentiment_label",
        F.col("primary_topic").alias("review_topic"),
    )
    order_columns = orders.select(
        "order_id", "customer_key", "status_code", "order_date", "delivered_date", "days_to_deliver", "delivered_on_time"
    )
    item_columns = items.select(
        "order_id", "order_item_id", "product_key", "item_price_brl", "freight_cost_brl",
        F.col("total_item_cost_brl").alias("total_amount_brl"),
    )
    return item_columns, materialize(order_columns, "fact-orders"), materialize(review_columns, "fact-reviews")


def _matched_lines(items: DataFrame, orders: DataFrame, reviews: DataFrame, hot: DataFrame) -> DataFrame:
    """Order lines with their order, once per review of the order.

    Lines, orders and reviews meet on ``order_id``, so one shuffle of each serves both joins; an order holding
    very many lines or reviews is cut into pieces first.
    """
    return salted_join(items, [(orders, "inner"), (reviews, "left")], "order_id", hot)


def _with_usd(lines: DataFrame, rates: DataFrame) -> DataFrame:
    """Add the date key and the USD amounts. Without a local-currency rate no row is left."""
    rate = F.col("brl_per_usd")

    def in_usd(column: str) -> Column:
        return F.round(F.col(column) / rate, 2)

    return lines.crossJoin(F.broadcast(rates.select("brl_per_usd").limit(1))).withColumns(
        {
            "date_key": date_key(F.col("order_date")),
            "item_price_usd": in_usd("item_price_brl"),
            "freight_cost_usd": in_usd("freight_cost_brl"),
            "total_amount_usd": in_usd("total_amount_brl"),
            "exchange_rate_used": rate,
        }
    )


def order_lines(
    orders: DataFrame,
    items: DataFrame,
    reviews: DataFrame,
    rates: DataFrame,
    single_review: bool = False,
    hot_options: dict | None = None,
) -> DataFrame:
    """The fact rows without surrogate key: each order line, once per review of its order. Inputs as staged.

    ``hot_options`` are those of the search for hot orders (see ``hot_keys``).
    """
    items, orders, reviews = _parts_of_lines(orders, items, reviews, single_review)
    hot = hot_keys(items, None if single_review else reviews, "order_id", **(hot_options or {}))
    return _with_usd(_matched_lines(items, orders, reviews, hot), rates).select(*FACT_COLUMNS[1:])


def fact_orders(
    orders: DataFrame,
    items: DataFrame,
    reviews: DataFrame,
    rates: DataFrame,
    single_review: bool = False,
    hot_options: dict | None = None,
) -> DataFrame:
    """``order_lines`` with the surrogate key ``fact_id`` = 1..n by order and line.

    How many rows an order has follows from how often its key occurs in the three inputs. So the rows of all orders before it are
    summed over the keys alone, and its own rows are numbered where the joins bring them together: no fact row is moved or written
    to be numbered. Where an order is hot its rows must not come together; all rows are then dealt into ranges.
    """
    items, orders, reviews = _parts_of_lines(orders, items, reviews, single_review)
    counted = materialize(count_keys([items, reviews, orders], "order_id"), "order-counts")
    hot = hot_counts(counted, "order_id", **(hot_options or {}))
    lines = _matched_lines(items, orders, reviews, hot)
    if not hot.isEmpty():
        numbered = number_rows(lines, ["order_id", "order_item_id"], "fact_id", LINE_COLUMNS)
        return _with_usd(numbered, rates).select(*FACT_COLUMNS)
    rows = F.col("_n0") * F.greatest(F.col("_n1"), F.lit(1)) * F.col("_n2")
    before = running_total(counted.select("order_id", rows.alias("_rows")).where("_rows > 0"), "order_id", "_rows", "_before")
    free_shuffles(orders.sparkSession)  # those of the counts
    within = Window.partitionBy("order_id").orderBy(*[F.col(c).asc_nulls_first() for c in ("order_item_id", *LINE_COLUMNS)])
    numbered = lines.join(before, "order_id").withColumn("fact_id", F.col("_before") + F.row_number().over(within))
    return _with_usd(numbered, rates).select(*FACT_COLUMNS)
