"""Declarative data-quality checks, many per pass over a table."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SAMPLE_SIZE = 5

RESULT_SCHEMA = "table string, check string, passed boolean, checked bigint, violations bigint, message string"


@dataclass(frozen=True)
class Check:
    kind: str
    description: str
    column: str | None = None
    allowed: tuple = ()
    low: float | None = None
    high: float | None = None
    mostly: float = 1.0


def no_nulls(column: str) -> Check:
    return Check("no_nulls", f"{column} has no nulls", column)


def values_in(column: str, allowed: Sequence, description: str | None = None) -> Check:
    return Check("values_in", description or f"{column} only contains known values", column, tuple(allowed))


def values_between(column: str, low, high, mostly: float = 1.0, description: str | None = None) -> Check:
    return Check("values_between", description or f"{column} is between {low:,} and {high:,}", column, (), low, high, mostly)


def row_count(low: int, high: int, description: str = "table has expected row count") -> Check:
    return Check("row_count", description, None, (), low, high)


def unique(column: str) -> Check:
    return Check("unique", f"{column} is unique", column)


# Known order states, review scores and the limits each table must keep.
ORDER_STATES = ("delivered", "shipped", "canceled", "unavailable", "invoiced", "processing", "created", "approved")
EXPECTED_ORDERS = (50_000, 200_000)
# Used unless limits are given: an upper limit would stop every larger run.
ANY_ORDERS = (1, 2**63 - 1)


def orders_suite(expected_rows: tuple[int, int] = ANY_ORDERS) -> list[Check]:
    return [
        no_nulls("order_id"),
        no_nulls("customer_key"),
        no_nulls("order_date"),
        values_in("status_code", ORDER_STATES),
        values_between("days_to_deliver", 0, 365, mostly=0.99),
        row_count(*expected_rows, description="orders table has expected row count"),
        unique("order_id"),
    ]


def order_items_suite() -> list[Check]:
    return [
        no_nulls("order_id"),
        no_nulls("product_key"),
        values_between("item_price_brl", 0, 10_000, mostly=0.999),
        values_between("freight_cost_brl", 0, 5_000, mostly=0.999, description="freight_cost_brl is not negative"),
        values_between("total_item_cost_brl", 0, 15_000, mostly=0.999, description="total_item_cost_brl is not negative"),
    ]


def reviews_suite() -> list[Check]:
    return [
        no_nulls("review_id"),
        no_nulls("order_id"),
        values_in("rating", (1, 2, 3, 4, 5), description="rating is 1 to 5 only"),
        values_between("rating", 1, 5),
    ]


# Columns the gold tables must keep unique and filled.
GOLD_SUITES: dict[str, list[Check]] = {
    "dim_customer": [unique("customer_key"), no_nulls("customer_key")],
    "dim_product": [unique("product_key"), no_nulls("product_key")],
    "dim_date": [unique("date_key"), no_nulls("date_key")],
    "fact_orders": [
        unique("fact_id"),
        no_nulls("fact_id"),
        no_nulls("customer_key"),
        no_nulls("date_key"),
        no_nulls("total_amount_usd"),
    ],
}


def _problem(df: DataFrame, check: Check) -> str | None:
    """Why a check cannot run on this frame, or None."""
    if check.column is None:
        return None
    if check.column not in df.columns:
        return f"column '{check.column}' not found"
    kind = df.schema[check.column].dataType
    if check.kind == "values_between" and not isinstance(kind, (T.NumericType, T.StringType, T.BooleanType)):
        return f"column '{check.column}' is {kind.simpleString()}, not a number"
    return None


def _outside(df: DataFrame, check: Check) -> Column:
    """True where a value is not one of the allowed ones; NULL where there is no value."""
    column = F.col(check.column)
    kind = df.schema[check.column].dataType
    flags = all(isinstance(v, bool) for v in check.allowed)
    numbers = not flags and all(isinstance(v, (int, float)) for v in check.allowed)
    if (isinstance(kind, T.NumericType) and numbers) or (isinstance(kind, T.BooleanType) and flags):
        return ~column.isin(*check.allowed)
    return ~column.cast("string").isin(*[str(v) for v in check.allowed])


def _counts(df: DataFrame, check: Check) -> tuple[Column, Column]:
    """Aggregates: rows the check looks at, and rows that break it."""
    rows = F.count(F.lit(1))
    if check.kind == "row_count":
        return rows, F.lit(0)
    column = F.col(check.column)
    if check.kind == "no_nulls":
        empty = column.isNull()
        if isinstance(df.schema[check.column].dataType, (T.FloatType, T.DoubleType)):
            empty = empty | F.isnan(column)
        return rows, F.count_if(empty)
    if check.kind == "values_in":
        return F.count(column), F.count_if(_outside(df, check))
    if check.kind == "values_between":
        value = column.try_cast("double")
        value = F.when(~F.isnan(value), value)
        return F.count(value), F.count_if((value < check.low) | (value > check.high))
    raise ValueError(f"unknown check {check.kind!r}")


def _distinct_counts(df: DataFrame, column: str, checked: str, violations: str) -> DataFrame:
    """Values and surplus copies of a column: counted per value first, so a hot value is combined map-side."""
    copies = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return copies.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias(checked),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias(violations),
    )


def _bad_sample(df: DataFrame, check: Check, name: str) -> DataFrame:
    """The smallest few values outside the allowed set, as one text."""
    worst = df.where(_outside(df, check)).select(F.col(check.column).alias("v")).distinct().orderBy("v").limit(SAMPLE_SIZE)
    return worst.agg(F.array_join(F.array_sort(F.collect_list("v")).cast("array<string>"), ", ").alias(name))


def _number(column: Column) -> Column:
    return F.format_number(column, 0)


def _verdict(check: Check, checked: Column, violations: Column, sample: Column | None) -> tuple[Column, Column]:
    """Whether the check passed, and what to say about it."""
    if check.kind == "row_count":
        passed = checked.between(check.low, check.high)
        limits = F.lit(f" [{check.low:,}, {check.high:,}]")
        word = F.when(passed, F.lit(" is within")).otherwise(F.lit(" is outside"))
        return passed, F.concat(F.lit("row count "), _number(checked), word, limits)
    name = f"'{check.column}'"
    if check.kind == "values_between":
        rate = F.try_divide(violations.cast("double"), checked.cast("double"))
        passed = F.coalesce(rate <= F.lit(1 - check.mostly), F.lit(True))
        bad = F.concat(
            _number(violations), F.lit(f" values in {name} outside [{check.low}, {check.high}], "),
            F.format_number(rate * 100, 1), F.lit("% of the values"),
        )
        good = F.when(checked == 0, F.lit(f"{name} holds no numbers to check")).otherwise(
            F.lit(f"{name} is between {check.low} and {check.high}")
        )
        return passed, F.when(passed, good).otherwise(bad)
    passed = violations == 0
    if check.kind == "no_nulls":
        good, bad = F.lit(f"no nulls in {name}"), F.concat(_number(violations), F.lit(f" nulls in {name}"))
    elif check.kind == "values_in":
        good = F.lit(f"{name} holds only allowed values")
        bad = F.concat(_number(violations), F.lit(f" values in {name} not allowed, such as: "), sample)
    else:
        good, bad = F.lit(f"{name} is unique"), F.concat(_number(violations), F.lit(f" duplicate values in {name}"))
    return passed, F.when(passed, good).otherwise(bad)


def run_checks(df: DataFrame, table: str, checks: Sequence[Check]) -> DataFrame:
    """One row per check.

    All counts come from a single aggregate without a shuffle of rows. Uniqueness needs one column, read separately so
    that the wide aggregate is not grouped by a key. With a check of allowed values the counts are made when this is
    called: a second look at a column, for a sample of its bad values, is taken only where there are some. A check
    that cannot run is a failed check.
    """
    fused, extra, rows, sampled = [], [], [], {}
    for i, check in enumerate(checks):
        problem = _problem(df, check)
        checked, violations, sample = F.lit(None).cast("bigint"), F.lit(None).cast("bigint"), None
        if problem is None:
            checked, violations = F.col(f"c{i}").cast("bigint"), F.col(f"v{i}").cast("bigint")
            if check.kind == "unique":
                extra.append(_distinct_counts(df, check.column, f"c{i}", f"v{i}"))
            else:
                counted, broken = _counts(df, check)
                fused += [counted.alias(f"c{i}"), broken.alias(f"v{i}")]
            if check.kind == "values_in":
                sampled[i] = check
                sample = F.col(f"s{i}")
            passed, message = _verdict(check, checked, violations, sample)
        else:
            passed, message = F.lit(False), F.lit(problem)
        rows.append(
            F.struct(
                F.lit(table).alias("table"),
                F.lit(check.description).alias("check"),
                passed.alias("passed"),
                checked.alias("checked"),
                violations.alias("violations"),
                message.alias("message"),
            )
        )
    frames = [df.agg(*fused)] if fused else []
    frames += extra
    if not frames:
        frames = [df.sparkSession.range(1)]
    # every frame is a global aggregate: exactly one row
    together = reduce(lambda a, b: a.crossJoin(F.broadcast(b)), frames)
    if sampled:
        counts = together.first()
        samples = [_bad_sample(df, c, "s").first()[0] if counts[f"v{i}"] else None for i, c in sampled.items()]
        fields = [*together.schema.fields, *[T.StructField(f"s{i}", T.StringType()) for i in sampled]]
        together = df.sparkSession.createDataFrame([(*counts, *samples)], T.StructType(fields))
    return together.select(F.inline(F.array(*rows)))


def summarize(results: DataFrame) -> DataFrame:
    """Passed, failed and total checks per table, and whether all passed."""
    return results.groupBy("table").agg(
        F.count_if("passed").alias("passed"),
        F.count_if(~F.col("passed")).alias("failed"),
        F.count(F.lit(1)).alias("total"),
        F.bool_and("passed").alias("success"),
    )


def validate(orders: DataFrame, items: DataFrame, reviews: DataFrame, expected_orders=ANY_ORDERS) -> DataFrame:
    """Results of the three silver suites."""
    return (
        run_checks(orders, "orders", orders_suite(expected_orders))
        .unionByName(run_checks(items, "order_items", order_items_suite()))
        .unionByName(run_checks(reviews, "reviews", reviews_suite()))
    )


def overall(results: DataFrame) -> DataFrame:
    """One row over all tables."""
    return results.agg(
        F.count_if("passed").alias("checks_passed"),
        F.count(F.lit(1)).alias("checks_total"),
        F.coalesce(F.bool_and("passed"), F.lit(True)).alias("success"),
    )


class QualityError(ValueError):
    """Raised by the gate; carries the counts for the metrics row."""

    def __init__(self, passed: int, total: int, failures: list[str]):
        super().__init__(f"{total - passed} of {total} data quality checks failed: " + "; ".join(failures))
        self.passed, self.total = passed, total


def require_quality(results: DataFrame) -> dict[str, int]:
    """Stop unless every check passed. Takes the results (one row per check) to the driver."""
    rows = results.select("table", "check", "passed", "message").collect()
    passed = sum(row.passed for row in rows)
    if passed < len(rows):
        raise QualityError(passed, len(rows), [f"{r.table}: {r.message}" for r in rows if not r.passed])
    return {"checks_passed": passed, "checks_total": len(rows)}
