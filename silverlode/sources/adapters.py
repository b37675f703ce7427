"""TPC-H-like tables projected to the bronze shapes of the retail data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_TEXT_TIME = "yyyy-MM-dd HH:mm:ss"


class Tables:
    """Parquet tables of one folder, read on demand."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def __getitem__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def _as_text(column):
    return F.date_format(column, _TEXT_TIME)


def raw_orders(t: Tables) -> DataFrame:
    ordered = F.col("o_orderdate").cast("timestamp")
    transit = F.make_dt_interval(days=(F.col("o_orderkey") % 60).cast("int"))
    status = F.col("o_orderstatus")
    return t["orders"].select(
        F.col("o_orderkey").cast("string").alias("order_id"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        F.when(status == "F", " Delivered ").when(status == "O", "SHIPPED").otherwise("processing").alias("order_status"),
        _as_text(ordered).alias("order_purchase_timestamp"),
        _as_text(ordered + F.expr("INTERVAL 1 HOUR")).alias("order_approved_at"),
        _as_text(ordered + F.expr("INTERVAL 2 DAYS")).alias("order_delivered_carrier_date"),
        F.when(status == "F", _as_text(ordered + transit)).alias("order_delivered_customer_date"),
        _as_text(ordered + F.expr("INTERVAL 45 DAYS")).alias("order_estimated_delivery_date"),
    )


def raw_customers(t: Tables) -> DataFrame:
    return (
        t["customer"]
        .join(t["nation"], F.col("c_nationkey") == F.col("n_nationkey"))
        .join(t["region"], F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("c_custkey").cast("string").alias("customer_id"),
            F.col("c_name").alias("customer_unique_id"),
            F.col("c_nationkey").alias("customer_zip_code_prefix"),
            F.col("n_name").alias("customer_city"),
            F.lower("r_name").alias("customer_state"),
        )
    )


def raw_order_items(t: Tables) -> DataFrame:
    return t["lineitem"].select(
        F.col("l_orderkey").cast("string").alias("order_id"),
        F.col("l_linenumber").alias("order_item_id"),
        F.col("l_partkey").cast("string").alias("product_id"),
        F.col("l_suppkey").cast("string").alias("seller_id"),
        _as_text(F.col("l_shipdate").cast("timestamp")).alias("shipping_limit_date"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_quantity").alias("freight_value"),
    )


def raw_products(t: Tables) -> DataFrame:
    return t["part"].select(
        F.col("p_partkey").cast("string").alias("product_id"),
        F.col("p_type").alias("product_category_name"),
        (F.col("p_size") * 200).alias("product_weight_g"),
        F.col("p_size").alias("product_length_cm"),
        (F.col("p_size") + 1).alias("product_height_cm"),
        (F.col("p_size") + 2).alias("product_width_cm"),
    )


def raw_reviews(t: Tables) -> DataFrame:
    """Three reviews for every fourth order, so the fan-out per order stays the same at any size."""
    return (
        t["events"]
        .join(t["documents"], F.col("event_id") == F.col("doc_id"), "left")
        .select(
            F.col("event_id").cast("string").alias("review_id"),
            F.expr("event_id div 3 * 4").cast("string").alias("order_id"),
            (F.col("event_id") % 5 + 1).alias("review_score"),
            F.col("text").alias("review_comment_message"),
            _as_text(F.col("ts").cast("timestamp")).alias("review_creation_date"),
        )
    )


def raw_payments(t: Tables) -> DataFrame:
    return t["orders"].select(
        F.col("o_orderkey").cast("string").alias("order_id"), F.col("o_orderpriority").alias("payment_type")
    )


def raw_exchange_rates(t: Tables) -> DataFrame:
    kind = F.col("event_type")
    return t["events"].select(
        F.lit("usd").alias("base_currency"),
        F.when(kind == "purchase", "brl").otherwise(kind).alias("target_currency"),
        (F.col("value") + 1).alias("exchange_rate"),
        F.col("ts").cast("timestamp").alias("rate_timestamp"),
        F.col("ts").cast("timestamp").alias("fetched_at"),
    )


def rate_payloads(t: Tables) -> DataFrame:
    """One JSON payload per event, the shape the rates service answers with, and when it was fetched."""
    rates = F.from_json("props", "map<string,double>")
    return t["events"].select(
        F.to_json(
            F.struct(
                F.unix_seconds(F.col("ts").cast("timestamp")).alias("timestamp"),
                F.lit("USD").alias("base"),
                F.map_concat(rates, F.create_map(F.upper("event_type"), F.col("value"))).alias("rates"),
            )
        ).alias("payload"),
        F.col("ts").cast("timestamp").alias("fetched_at"),
    )


def stage_log(t: Tables) -> DataFrame:
    """Events in the shape of the run-metrics table: one run per user, one stage row per event."""
    failed = F.col("event_type") == "error"
    return t["events"].select(
        F.col("user_id").cast("string").alias("run_id"),
        F.col("event_type").alias("stage"),
        F.when(failed, "failed").otherwise("success").alias("status"),
        F.col("event_id").alias("rows_processed"),
        F.col("value").alias("duration_seconds"),
        F.col("props").alias("extra_metrics"),
        F.when(failed, F.concat(F.lit("event "), F.col("event_id").cast("string"))).alias("error_message"),
        F.col("ts").cast("timestamp").alias("created_at"),
    )


BRONZE = {
    "raw_orders": raw_orders,
    "raw_customers": raw_customers,
    "raw_order_items": raw_order_items,
    "raw_products": raw_products,
    "raw_reviews": raw_reviews,
    "raw_payments": raw_payments,
    "raw_exchange_rates": raw_exchange_rates,
}
