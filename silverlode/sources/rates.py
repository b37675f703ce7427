"""Currency-rate payloads to rows of the rate history."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import check_on_error
from .tables import append_table, create_layers, layer

# Rates are read as text, so one that is no number does not take the others of its payload with it.
PAYLOAD_SCHEMA = "timestamp bigint, base string, rates map<string,string>"
HISTORY_TABLE = layer("bronze", "raw_exchange_rates")

# Currencies looked at after a load.
SAMPLE_CURRENCIES = ("BRL", "EUR", "GBP", "LKR")


def read_payloads(spark: SparkSession, path: str, one_per_line: bool = False) -> DataFrame:
    """Landed payloads: one JSON document per file, or per line."""
    return spark.read.text(path, wholetext=not one_per_line).withColumnRenamed("value", "payload")


def _payload_problem() -> Column:
    """What keeps a payload from being read, NULL for a good one. ``p`` is the parsed payload."""
    return (
        F.when(F.col("payload").isNull(), "no payload")
        .when(F.try_parse_json("payload").isNull(), "not JSON")
        .when(F.col("p.rates").isNull(), "no rates")
        .when(F.col("p.timestamp").isNull(), "no timestamp")
        .when(F.col("p.base").isNull(), "no base currency")
    )


def _rate_problem(rate: Column) -> Column:
    return F.when(rate.try_cast("double").isNull(), F.concat(F.lit("rate is not a number: "), F.coalesce(rate, F.lit("null"))))


def flatten_rates(payloads: DataFrame, fetched_at: Column | None = None, on_error: str = "fail") -> DataFrame:
    """One row per currency of each payload. ``fetched_at`` defaults to the time of the run.

    ``on_error="fail"`` raises on the first payload or rate that cannot be read. ``"null"`` leaves unreadable payloads
    out and gives unreadable rates as NULL; ``rate_rejects`` lists both.
    """
    check_on_error(on_error)
    fetched = F.current_timestamp() if fetched_at is None else fetched_at
    parsed = payloads.select("payload", F.from_json("payload", PAYLOAD_SCHEMA).alias("p"), fetched.alias("fetched_at"))
    problem = _payload_problem()
    if on_error == "fail":
        message = F.concat(F.lit("rate payload: "), problem, F.lit(": "), F.coalesce(F.left("payload", F.lit(200)), F.lit("null")))
        rates = F.when(problem.isNotNull(), F.raise_error(message)).otherwise(F.col("p.rates"))
    else:
        rates = F.when(problem.isNull(), F.col("p.rates"))
    rows = parsed.select("p", "fetched_at", F.explode(rates).alias("target_currency", "text"))
    rate = F.col("text").try_cast("double")
    if on_error == "fail":
        wrong = _rate_problem(F.col("text"))
        rate = F.when(wrong.isNotNull(), F.raise_error(F.concat("target_currency", F.lit(" "), wrong))).otherwise(rate)
    return rows.select(
        F.col("p.base").alias("base_currency"),
        "target_currency",
        rate.alias("exchange_rate"),
        F.timestamp_seconds("p.timestamp").alias("rate_timestamp"),
        "fetched_at",
    )


def rate_rejects(payloads: DataFrame) -> DataFrame:
    """What ``flatten_rates`` with ``on_error="null"`` could not read: payload, currency (NULL: all of it), reason."""
    parsed = payloads.select("payload", F.from_json("payload", PAYLOAD_SCHEMA).alias("p")).withColumn("reason", _payload_problem())
    whole = parsed.where(F.col("reason").isNotNull()).select("payload", F.lit(None).cast("string").alias("target_currency"), "reason")
    single = (
        parsed.where(F.col("reason").isNull())
        .select("payload", F.explode("p.rates").alias("target_currency", "text"))
        .select("payload", "target_currency", _rate_problem(F.col("text")).alias("reason"))
        .where(F.col("reason").isNotNull())
    )
    return whole.unionByName(single)


def append_rates(rates: DataFrame, table: str = HISTORY_TABLE) -> None:
    """Add a snapshot; earlier ones are kept. Partitioned by the day of the fetch."""
    create_layers(rates.sparkSession)
    append_table(rates.withColumn("fetch_date", F.to_date("fetched_at")), table, ["fetch_date"])


def verify_rates(history: DataFrame) -> DataFrame:
    """One row describing the history."""
    return history.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_distinct("target_currency").alias("currencies"),
        F.min("fetched_at").alias("first_fetch"),
        F.max("fetched_at").alias("latest_fetch"),
    )


def sample_currencies(rates: DataFrame, codes: tuple[str, ...] = SAMPLE_CURRENCIES) -> DataFrame:
    return rates.where(F.col("target_currency").isin(*codes))
