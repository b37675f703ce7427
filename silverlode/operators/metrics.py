"""Run metrics as an ordinary table, and the reports read from it."""

from __future__ import annotations

import json
import logging
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import append_table, create_layers, overwrite_table

log = logging.getLogger(__name__)

METRICS_TABLE = "monitoring.pipeline_runs"
METRICS_SCHEMA = (
    "run_id string, stage string, status string, rows_processed bigint, duration_seconds double, "
    "extra_metrics string, error_message string, created_at timestamp"
)
RECENT_RUNS, SUMMARY_RUNS = 10, 5
# A recorded stage is a file; more files than this are merged into one.
MOST_FILES = 64

# The tables whose presence tells the health of their layer, with a column that dates them.
HEALTH_TABLES = {
    "bronze.raw_orders": None,
    "silver.orders": "order_date",
    "gold.fact_orders": "order_date",
    "ml.churn_scores": None,
}


def setup_metrics_table(spark: SparkSession) -> None:
    create_layers(spark)
    if not spark.catalog.tableExists(METRICS_TABLE):
        overwrite_table(spark.createDataFrame([], METRICS_SCHEMA), METRICS_TABLE)


def compact_metrics(spark: SparkSession, most_files: int | None = None) -> bool:
    """Merge the files of the metrics table into one when there are more than ``most_files``; whether that was done.

    The merged file takes their place in one step, so readers find every row once. Rows that another application adds while the
    files are merged are looked for in the version before and added again; one that it commits after that look, having
    begun before the switch, stays in the version before.
    """
    files = spark.table(METRICS_TABLE).inputFiles()
    if len(files) <= (MOST_FILES if most_files is None else most_files):
        return False
    read = spark.read.schema(METRICS_SCHEMA)
    overwrite_table(read.parquet(*files).coalesce(1), METRICS_TABLE)  # a row is a recorded stage
    late = set(read.parquet(files[0].rsplit("/", 1)[0]).inputFiles()) - set(files)
    if late:
        append_table(read.parquet(*late), METRICS_TABLE)
    return True


def record_metric(
    spark: SparkSession,
    run_id: str,
    stage: str,
    status: str,
    rows_processed: int = 0,
    duration_seconds: float = 0.0,
    extra_metrics: dict | None = None,
    error_message: str | None = None,
) -> None:
    """Append one stage row. A failure here is logged and never stops the job."""
    try:
        row = (run_id, stage, status, rows_processed, duration_seconds, json.dumps(extra_metrics or {}), error_message)
        columns = [f for f in METRICS_SCHEMA.split(", ") if not f.startswith("created_at")]
        one = spark.createDataFrame([row], ", ".join(columns)).withColumn("created_at", F.current_timestamp())
        append_table(one.coalesce(1), METRICS_TABLE)
        compact_metrics(spark)
    except Exception as error:  # metrics must not break the job
        log.warning("could not record the metric of stage %s: %s", stage, error)


class Stage:
    """Times a block and records it: ``success``, or ``failed`` with the error, which then propagates.

    Unlike the rows of a finished stage, ``rows`` and ``extra`` set before a failure are kept with it.
    """

    def __init__(self, spark: SparkSession, run_id: str, stage: str, extra: dict | None = None):
        self.spark, self.run_id, self.stage = spark, run_id, stage
        self.rows, self.extra = 0, dict(extra or {})

    def __enter__(self) -> "Stage":
        self._start = time.monotonic()
        return self

    def __exit__(self, kind, error, trace) -> bool:
        record_metric(
            self.spark,
            self.run_id,
            self.stage,
            "success" if kind is None else "failed",
            self.rows,
            round(time.monotonic() - self._start, 2),
            self.extra,
            None if kind is None else str(error),
        )
        return False


def write_stage(df: DataFrame, table: str, run_id: str, stage: str, write: Callable = overwrite_table) -> int:
    """Write a table as one recorded stage and return the rows written, counted in the written table."""
    spark = df.sparkSession
    with Stage(spark, run_id, stage, {"table": table}) as timed:
        write(df, table)
        timed.rows = spark.table(table).count()
    return timed.rows


def recent_runs(metrics: DataFrame, limit: int = RECENT_RUNS) -> DataFrame:
    """The newest stage rows first."""
    return (
        metrics.orderBy(F.desc_nulls_first("created_at"), "run_id", "stage")
        .limit(limit)
        .select(
            "run_id", "stage", "status", "rows_processed",
            F.round(F.col("duration_seconds").cast("decimal(18,6)"), 1).alias("duration_s"),
            "extra_metrics", "error_message", "created_at",
        )
    )


def run_summary(metrics: DataFrame) -> DataFrame:
    """One row per run: when it ran, how its stages ended, rows and seconds in total."""
    return metrics.groupBy("run_id").agg(
        F.min("created_at").alias("run_start"),
        F.max("created_at").alias("run_end"),
        F.count(F.lit(1)).alias("total_stages"),
        F.count_if(F.col("status") == "success").alias("passed"),
        F.count_if(F.col("status") == "failed").alias("failed"),
        F.sum("rows_processed").alias("total_rows"),
        F.round(F.sum(F.col("duration_seconds").cast("decimal(18,6)")), 1).alias("total_duration_s"),
    )


def latest_runs(metrics: DataFrame, limit: int = SUMMARY_RUNS) -> DataFrame:
    return run_summary(metrics).orderBy(F.desc_nulls_first("run_start"), "run_id").limit(limit)


def table_health(df: DataFrame | None, name: str, spark: SparkSession, dated_by: str | None = None) -> DataFrame:
    """One row: rows of the table, ok / empty / missing, and its newest date if a column dates it."""
    if df is None:
        return spark.range(1).select(
            F.lit(name).alias("table"), F.lit(0).cast("bigint").alias("row_count"),
            F.lit("missing").alias("status"), F.lit(None).cast("timestamp").alias("newest"),
        )
    newest = F.max(dated_by).cast("timestamp") if dated_by else F.lit(None).cast("timestamp")
    return df.agg(F.count(F.lit(1)).alias("row_count"), newest.alias("newest")).select(
        F.lit(name).alias("table"),
        "row_count",
        F.when(F.col("row_count") > 0, "ok").otherwise("empty").alias("status"),
        "newest",
    )


def layer_health(spark: SparkSession, tables: dict[str, str | None] = HEALTH_TABLES) -> DataFrame:
    health = None
    for name, dated_by in tables.items():
        df = spark.table(name) if spark.catalog.tableExists(name) else None
        one = table_health(df, name, spark, dated_by)
        health = one if health is None else health.unionByName(one)
    return health


def model_summary(metrics: DataFrame, run_id: str, stage: str = "churn_model") -> DataFrame:
    """AUC and accuracy a run recorded, read back from its metrics row."""
    values = F.from_json("extra_metrics", "auc_roc double, accuracy double")
    return (
        metrics.where((F.col("run_id") == run_id) & (F.col("stage") == stage))
        .select("run_id", "status", values.alias("m"))
        .select("run_id", "status", "m.auc_roc", "m.accuracy")
    )
