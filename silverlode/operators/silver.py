"""Bronze to silver: deduplicate, drop unusable rows, clean and type."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from ..functions.columns import MONEY, parse_timestamp
from .mapping import apply_mapping


def count_rows(df: DataFrame, observation: Observation | None, name: str) -> DataFrame:
    """Count rows as they pass, without a job of their own.

    The figure is for logs: rows of a task that runs again after an executor loss are counted again. Exact
    counts come from the written table.
    """
    return df if observation is None else df.observe(observation, F.count(F.lit(1)).alias(name))


def dedup(
    df: DataFrame,
    key: str,
    order_by: Sequence[str] | None = None,
    before: Observation | None = None,
    after: Observation | None = None,
) -> DataFrame:
    """Keep one row per key: the first in ``order_by``, then in all other columns, so the survivor is fixed.

    Rows with a NULL key count as one key. Spark keeps one row per key in each map task before the shuffle
    (window group limit), so a hot key costs one row per map task.
    """
    order_by = list(order_by or ())
    order_by += [c for c in df.columns if c != key and c not in order_by]
    first = F.row_number().over(Window.partitionBy(key).orderBy(*[F.col(c) for c in order_by] or [F.lit(1)]))
    kept = (
        count_rows(df, before, "rows").withColumn("_nth", first).where(F.col("_nth") == 1).drop("_nth")
    )
    return count_rows(kept, after, "rows")


def require_columns(
    df: DataFrame, columns: Sequence[str], before: Observation | None = None, after: Observation | None = None
) -> DataFrame:
    """Drop rows with a NULL in any of ``columns``. NaN is a value here."""
    return count_rows(count_rows(df, before, "rows").where(_present(columns)), after, "rows")


def _present(columns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns], F.lit(True))


def with_copies(df: DataFrame, key: str | None, order_by: Sequence[str] | None = None) -> DataFrame:
    """The rows ``dedup`` keeps, each with ``_copies``, the rows of its key; without a key all rows, each its own copy.

    The survivor of a key is the least row in ``order_by`` and then in all other columns; as a struct it is found with map-side
    combining, so a hot key costs one row per map task.
    """
    if key is None:
        return df.withColumn("_copies", F.lit(1).cast("long"))
    order = list(order_by or ())
    order += [c for c in df.columns if c not in order and c != key]
    least = F.min(F.struct(*[F.col(f"`{c}`") for c in order], F.lit(0).alias("_end")))
    unique = df.groupBy(F.col(f"`{key}`")).agg(F.count(F.lit(1)).alias("_copies"), least.alias("_least"))
    return unique.select(*[F.col(f"`{key}`") if c == key else F.col(f"_least.`{c}`") for c in df.columns], "_copies")


def usable_rows(
    df: DataFrame, key: str | None, required: Sequence[str], order_by: Sequence[str] | None = None, losses: Observation | None = None
) -> DataFrame:
    """``dedup`` by ``key``, if there is one, then ``require_columns``.

    With ``losses`` the rows are counted on their way, for ``observed_losses``. They are counted after the only shuffle, from the
    copies each row stands for, so in the tasks of the job that writes them when nothing that follows shuffles. Spark adds the
    counts of such a task when its result is accepted, once however often it is tried: they are exact also when executors are lost.
    """
    if losses is None:
        return require_columns(df if key is None else dedup(df, key, order_by), required)
    present = _present(required)
    counted = with_copies(df, key, order_by).observe(
        losses,
        F.coalesce(F.sum("_copies"), F.lit(0)).alias("rows_read"),
        F.count(F.lit(1)).alias("rows_unique"),
        F.count_if(present).alias("rows_kept"),
    )
    return counted.where(present).drop("_copies")


def observed_losses(losses: Observation) -> tuple[int, int, int]:
    """Rows read, duplicates removed and rows dropped for a NULL, once a job over the rows has ended; it waits for one.

    A job that Spark ends early as there are no rows counts nothing.
    """
    found = losses.get
    read, unique, kept = (found.get(name) or 0 for name in ("rows_read", "rows_unique", "rows_kept"))
    return read, read - unique, unique - kept


def cleaning_losses(df: DataFrame, key: str | None, required: Sequence[str]) -> DataFrame:
    """One row: rows read, rows ``dedup`` removes, rows ``require_columns`` drops after it, rows kept.

    Counted exactly, by a scan of its own; see ``usable_rows`` for counts that ride on a write. Without a key nothing is deduplicated.
    """
    counted = with_copies(df, key).agg(
        F.coalesce(F.sum("_copies"), F.lit(0)).alias("rows_read"),
        F.count(F.lit(1)).alias("rows_unique"),
        F.count_if(_present(required)).alias("rows_kept"),
    )
    return counted.select(
        "rows_read",
        (F.col("rows_read") - F.col("rows_unique")).alias("duplicates_removed"),
        (F.col("rows_unique") - F.col("rows_kept")).alias("nulls_dropped"),
        "rows_kept",
    )


# Silver table -> (key deduplicated on, columns that must not be NULL).
CLEANED_BY = {
    "orders": ("order_id", ["order_id", "customer_id"]),
    "customers": ("customer_id", ["customer_id", "customer_unique_id"]),
    "order_items": (None, ["order_id", "product_id"]),
    "reviews": ("review_id", ["review_id", "order_id"]),
}


def clean_orders(
    raw: DataFrame, on_error: str = "fail", order_by: Sequence[str] | None = None, losses: Observation | None = None
) -> DataFrame:
    rows = usable_rows(raw, *CLEANED_BY["orders"], order_by, losses)
    delivered = F.col("delivered_date")
    return apply_mapping(rows, "orders", on_error).withColumns(
        {
            "days_to_deliver": F.datediff(delivered, "order_date"),
            "delivered_on_time": F.when(delivered.isNotNull(), delivered <= F.col("estimated_delivery_date")),
        }
    )


def clean_customers(
    raw: DataFrame, on_error: str = "fail", order_by: Sequence[str] | None = None, losses: Observation | None = None
) -> DataFrame:
    rows = usable_rows(raw, *CLEANED_BY["customers"], order_by, losses)
    return apply_mapping(rows, "customers", on_error)


def clean_order_items(raw: DataFrame, on_error: str = "fail", losses: Observation | None = None) -> DataFrame:
    """Order lines are not deduplicated; a line needs a price of zero or more."""
    return (
        apply_mapping(usable_rows(raw, *CLEANED_BY["order_items"], losses=losses), "order_items", on_error)
        .where(F.col("item_price_brl") >= 0)
        .withColumn("total_item_cost_brl", (F.col("item_price_brl") + F.col("freight_cost_brl")).cast(MONEY))
    )


def clean_reviews(
    raw: DataFrame, on_error: str = "fail", order_by: Sequence[str] | None = None, losses: Observation | None = None
) -> DataFrame:
    rows = usable_rows(raw, *CLEANED_BY["reviews"], order_by, losses)
    return apply_mapping(rows, "reviews", on_error).withColumn("sentiment_label", F.lit(None).cast("string"))


def latest_rates(raw: DataFrame, on_error: str = "fail") -> DataFrame:
    """The most recent snapshot of each currency; equal times go to the later quote, then the higher rate."""
    newest = Window.partitionBy("target_currency").orderBy(
        F.desc_nulls_last("captured_at"), F.desc_nulls_last("rate_timestamp"), F.desc_nulls_last("rate"), "base_currency"
    )
    return (
        apply_mapping(raw, "exchange_rates", on_error)
        .withColumn("_nth", F.row_number().over(newest))
        .where(F.col("_nth") == 1)
        .drop("_nth")
    )


# Silver table -> (bronze table, transform)
SILVER_TABLES = {
    "orders": ("raw_orders", clean_orders),
    "customers": ("raw_customers", clean_customers),
    "order_items": ("raw_order_items", clean_order_items),
    "reviews": ("raw_reviews", clean_reviews),
    "exchange_rates": ("raw_exchange_rates", latest_rates),
}
