"""Column mappings from bronze to silver, and the projection they drive."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import MONEY, RATE, blank_to_null, parse_as, parse_timestamp


@dataclass(frozen=True)
class Field:
    """One silver column. ``source`` is None for a column derived from other silver columns."""

    source: str | None
    target: str
    type: str
    rule: str = "copy"
    nullable: bool = True


# Source columns, silver columns, types and which columns may be NULL.
MAPPINGS: dict[str, tuple[Field, ...]] = {
    "orders": (
        Field("order_id", "order_id", "string", nullable=False),
        Field("customer_id", "customer_key", "string", nullable=False),
        Field("order_status", "status_code", "string", "lower", nullable=False),
        Field("order_purchase_timestamp", "order_date", "timestamp", "timestamp", nullable=False),
        Field("order_approved_at", "approved_date", "timestamp", "timestamp"),
        Field("order_delivered_carrier_date", "shipped_date", "timestamp", "timestamp"),
        Field("order_delivered_customer_date", "delivered_date", "timestamp", "timestamp"),
        Field("order_estimated_delivery_date", "estimated_delivery_date", "timestamp", "timestamp"),
        Field(None, "days_to_deliver", "int", "derived"),
        Field(None, "delivered_on_time", "boolean", "derived"),
    ),
    "customers": (
        Field("customer_id", "customer_key", "string", nullable=False),
        Field("customer_unique_id", "customer_id", "string", nullable=False),
        Field("customer_city", "city", "string", "title"),
        Field("customer_state", "state_code", "string", "upper"),
        Field("customer_zip_code_prefix", "zip_prefix", "string", "zip"),
    ),
    "order_items": (
        Field("order_id", "order_id", "string", nullable=False),
        Field("order_item_id", "order_item_id", "int"),
        Field("product_id", "product_key", "string", nullable=False),
        Field("seller_id", "seller_id", "string"),
        Field("shipping_limit_date", "shipping_deadline", "timestamp", "timestamp"),
        Field("price", "item_price_brl", MONEY, "number", nullable=False),
        Field("freight_value", "freight_cost_brl", MONEY, "number", nullable=False),
        Field(None, "total_item_cost_brl", MONEY, "derived"),
    ),
    "reviews": (
        Field("review_id", "review_id", "string", nullable=False),
        Field("order_id", "order_id", "string", nullable=False),
        Field("review_score", "rating", "int", "number", nullable=False),
        Field("review_comment_message", "review_text", "string", "text"),
        Field("review_creation_date", "review_date", "timestamp", "timestamp"),
        Field(None, "sentiment_label", "string", "derived"),
    ),
    "exchange_rates": (
        Field("base_currency", "base_currency", "string", "code", nullable=False),
        Field("target_currency", "target_currency", "string", "code", nullable=False),
        Field("exchange_rate", "rate", RATE, "number", nullable=False),
        Field("rate_timestamp", "rate_timestamp", "timestamp"),
        Field("fetched_at", "captured_at", "timestamp", nullable=False),
    ),
}


def get_mapping(table: str) -> tuple[Field, ...]:
    try:
        return MAPPINGS[table]
    except KeyError:
        raise KeyError(f"no mapping for table {table!r}; known tables: {', '.join(MAPPINGS)}") from None


def silver_schema(table: str) -> T.StructType:
    """The schema the mapping promises."""
    schema = T.StructType()
    for field in get_mapping(table):
        schema = schema.add(field.target, T.DataType.fromDDL(field.type), field.nullable)
    return schema


def _expression(field: Field, on_error: str) -> Column:
    column = F.col(field.source)
    match field.rule:
        case "copy":
            return column.cast(field.type)
        case "lower":
            return F.lower(F.trim(column))
        case "upper":
            return F.upper(F.trim(column))
        case "code":
            return F.upper(column)
        case "title":
            return F.initcap(F.trim(column))
        case "zip":
            return F.lpad(column.cast("string"), 5, "0")
        case "text":
            return blank_to_null(column)
        case "timestamp":
            return parse_timestamp(field.source, on_error)
        case "number":
            return parse_as(field.source, field.type, on_error)
    raise ValueError(f"no expression for rule {field.rule!r}")


def apply_mapping(df: DataFrame, table: str, on_error: str = "fail") -> DataFrame:
    """One projection: rename, clean and cast every column that has a source."""
    return df.select(
        *[_expression(f, on_error).alias(f.target) for f in get_mapping(table) if f.source is not None]
    )


def mapping_table(spark) -> DataFrame:
    """The registry itself as rows."""
    rows = [(t, f.source, f.target, f.type, f.rule, f.nullable) for t, fields in MAPPINGS.items() for f in fields]
    return spark.createDataFrame(
        rows, "table string, source_col string, target_col string, data_type string, rule string, nullable boolean"
    )


def conformance(df: DataFrame, table: str) -> DataFrame:
    """One row per mapped column: is it there, of the promised type, and free of NULLs where it must be?

    All NULL counts come from one aggregate over ``df``.
    """
    fields = get_mapping(table)
    counts = df.agg(
        *[
            (F.count_if(F.col(f.target).isNull()) if f.target in df.columns else F.lit(None).cast("long")).alias(f"n{i}")
            for i, f in enumerate(fields)
        ]
    )

    def row(i: int, f: Field) -> Column:
        found = df.schema[f.target].dataType.simpleString() if f.target in df.columns else None
        nulls = F.col(f"n{i}")
        if found is None:
            problem = F.lit("missing column")
        elif found != f.type:
            problem = F.lit("wrong type")
        elif f.nullable:
            problem = F.lit(None).cast("string")
        else:
            problem = F.when(nulls > 0, "nulls not allowed")
        return F.struct(
            F.lit(table).alias("table"),
            F.lit(f.target).alias("target_col"),
            F.lit(f.type).alias("expected_type"),
            F.lit(found).cast("string").alias("found_type"),
            nulls.alias("null_count"),
            problem.alias("problem"),
        )

    return counts.select(F.inline(F.array(*[row(i, f) for i, f in enumerate(fields)])))
