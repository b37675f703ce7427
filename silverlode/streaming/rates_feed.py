"""The append-only rate history fed from a landing folder, each payload file exactly once."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..sources.rates import flatten_rates, rate_rejects


def feed_rates(
    spark: SparkSession,
    landing: str,
    history: str,
    checkpoint: str,
    one_per_line: bool = False,
    on_error: str = "fail",
    rejects: str | None = None,
) -> StreamingQuery:
    """Append the payload files that arrived since the last call to the Parquet folder ``history`` and stop.

    ``checkpoint`` remembers which files were taken, so a rerun after a failure neither loses nor repeats one. A payload
    that cannot be read stops the feed and its file stays untaken; with ``on_error="null"`` it is appended to the Parquet folder
    ``rejects`` instead, which that mode requires.
    """
    if on_error == "null":
        if rejects is None:
            raise ValueError('on_error="null" needs a folder for the rejects')
        return _feed_both(spark, landing, history, checkpoint, one_per_line, rejects)
    payloads = spark.readStream.text(landing, wholetext=not one_per_line).withColumnRenamed("value", "payload")
    rates = flatten_rates(payloads, on_error=on_error).withColumn("fetch_date", F.to_date("fetched_at"))
    return (
        rates.writeStream.format("parquet")
        .option("path", history)
        .option("checkpointLocation", checkpoint)
        .partitionBy("fetch_date")
        .trigger(availableNow=True)
        .start()
    )


def _feed_both(
    spark: SparkSession, landing: str, history: str, checkpoint: str, one_per_line: bool, rejects: str
) -> StreamingQuery:
    """Rates and rejects of each micro-batch; a batch that runs again replaces what its first run wrote."""
    payloads = spark.readStream.text(landing, wholetext=not one_per_line).withColumnRenamed("value", "payload")

    def write(batch, number: int) -> None:
        rates = flatten_rates(batch, on_error="null").withColumn("fetch_date", F.to_date("fetched_at"))
        for rows, folder in ((rates, history), (rate_rejects(batch), rejects)):
            rows.write.mode("overwrite").parquet(f"{folder}/batch={number}")

    return payloads.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
