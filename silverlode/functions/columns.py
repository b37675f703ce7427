"""Column expressions shared by the operators. Everything here stays inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(10,2)"
RATE = "decimal(18,6)"

DAY_MICROS = 86_400_000_000

ON_ERROR = ("fail", "null")


def check_on_error(on_error: str) -> None:
    if on_error not in ON_ERROR:
        raise ValueError(f"on_error must be one of {ON_ERROR}, got {on_error!r}")


def parse_timestamp(name: str, on_error: str = "fail") -> Column:
    """Text to timestamp. ``fail`` raises on malformed text under ANSI, ``null`` yields NULL."""
    check_on_error(on_error)
    return F.to_timestamp(name) if on_error == "fail" else F.try_to_timestamp(F.col(name))


def parse_as(name: str, type_name: str, on_error: str = "fail") -> Column:
    check_on_error(on_error)
    column = F.col(name)
    return column.cast(type_name) if on_error == "fail" else column.try_cast(type_name)


def blank_to_null(column: Column) -> Column:
    """Trim spaces; text with nothing left becomes NULL."""
    return F.nullif(F.trim(column), F.lit(""))


def elapsed_days(later: Column, earlier: Column) -> Column:
    """Whole 24-hour periods between two timestamps, rounded down (``datediff`` counts midnights)."""
    micros = F.unix_micros(later) - F.unix_micros(earlier)
    return ((micros - F.pmod(micros, F.lit(DAY_MICROS))) / F.lit(DAY_MICROS)).cast("long")


def date_key(column: Column) -> Column:
    """Date or timestamp to an integer such as 20171002."""
    return F.date_format(column, "yyyyMMdd").cast("int")


def risk_tier(probability: Column) -> Column:
    """Bins (0, 0.3] low, (0.3, 0.6] medium, (0.6, 1] high; anything outside is NULL."""
    return (
        F.when((probability > 0) & (probability <= 0.3), "low")
        .when((probability > 0.3) & (probability <= 0.6), "medium")
        .when((probability > 0.6) & (probability <= 1.0), "high")
    )
