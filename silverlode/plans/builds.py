"""Layer builds: silver with per-table fault isolation, gold, and the monitored run of everything."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from contextlib import contextmanager
from functools import partial, reduce

from pyspark.sql import DataFrame, Observation, SparkSession

from ..functions.scratch import free_shuffles, materialize, scratch_scope
from ..functions.together import run_together
from ..operators import annotate, answers, churn, features, gold, metrics, quality
from ..operators.silver import CLEANED_BY, SILVER_TABLES, observed_losses
from ..sources.csv import load_all_csv, total_rows
from ..sources.rates import append_rates, flatten_rates, read_payloads
from ..sources.tables import as_view, create_layers, layer, overwrite_table

ANNOTATIONS_TABLE = "silver.review_annotations"
STATUS_SCHEMA = (
    "table string, status string, rows bigint, error string, rows_read bigint, duplicates_removed bigint, nulls_dropped bigint"
)


class SilverError(RuntimeError):
    """Some silver tables failed; ``status`` has one row per table."""

    def __init__(self, failed: list[str], status: DataFrame):
        super().__init__(f"silver tables failed: {', '.join(failed)}")
        self.status = status


def build_silver(spark: SparkSession, bronze: Mapping[str, DataFrame], write=overwrite_table) -> DataFrame:
    """Build every silver table, all at once. One that fails is reported and does not stop the others; the error comes last.

    One row per table: rows written, rows read, duplicates removed and rows dropped for a NULL. Losses are counted as the table is
    written, so bronze is scanned once; ``write`` must run one job over the frame it is given, and add no shuffle to it. The rate
    history loses no rows to cleaning; its rows are counted without reading a column.
    """
    create_layers(spark)

    def build(table: str, source: str, transform) -> tuple:
        try:
            name = layer("silver", table)
            if table in CLEANED_BY:
                losses = Observation()
                write(transform(bronze[source], losses=losses), name)
                lost = observed_losses(losses)
            else:
                write(transform(bronze[source]), name)
                lost = bronze[source].count(), 0, 0
            return table, "success", spark.table(name).count(), None, lost[0], lost[1], lost[2]
        except Exception as error:  # recorded per table
            return table, "failed", None, f"{type(error).__name__}: {error}", None, None, None

    rows = run_together(spark, [partial(build, table, *how) for table, how in SILVER_TABLES.items()])
    status = spark.createDataFrame(rows, STATUS_SCHEMA)
    failed = [row[0] for row in rows if row[1] == "failed"]
    if failed:
        raise SilverError(failed, status)
    return status


def staging(spark: SparkSession) -> dict[str, DataFrame]:
    """The staging relations over the current tables, also registered as views."""
    silver = {t: spark.table(layer("silver", t)) for t in SILVER_TABLES}
    reviews = annotate.with_annotation_columns(silver["reviews"])
    annotations = annotate.read_annotations(spark, ANNOTATIONS_TABLE)
    if annotations is not None:
        reviews = annotate.annotated_reviews(reviews, annotations)
    staged = {
        "stg_orders": gold.stg_orders(silver["orders"]),
        "stg_customers": gold.stg_customers(silver["customers"]),
        "stg_order_items": gold.stg_order_items(silver["order_items"]),
        "stg_reviews": gold.stg_reviews(reviews),
        "stg_products": gold.stg_products(spark.table(layer("bronze", "raw_products"))),
        "stg_exchange_rates": gold.stg_exchange_rates(silver["exchange_rates"]),
        "stg_churn_scores": gold.stg_churn_scores(spark.table(layer("ml", "churn_scores"))),
    }
    for name, df in staged.items():
        as_view(df, name)
    return staged


def build_gold(
    spark: SparkSession,
    partition_fact: bool = False,
    write=overwrite_table,
    calendar: tuple[str, str] | None = None,
    **fact_options,
) -> int:
    """Write the four gold tables, all at once, and return the fact rows.

    The calendar has the days given; by default the fixed span and all days of the orders.
    ``partition_fact`` lays the fact out by ``date_key``; a rebalance first gives each day few, even files.
    """
    create_layers(spark)
    staged = staging(spark)

    def dates() -> None:
        span = gold.calendar_span(spark, *calendar) if calendar else gold.fixed_and(gold.span_of(staged["stg_orders"], "order_date"))
        write(gold.dim_date(span), "gold.dim_date")

    def facts() -> None:
        fact = gold.fact_orders(
            staged["stg_orders"], staged["stg_order_items"], staged["stg_reviews"], staged["stg_exchange_rates"], **fact_options
        )
        if partition_fact:
            write(fact.hint("rebalance", "date_key"), "gold.fact_orders", ["date_key"])
        else:
            write(fact, "gold.fact_orders")

    run_together(
        spark,
        [
            facts,
            lambda: write(gold.dim_customer(staged["stg_customers"], staged["stg_churn_scores"]), "gold.dim_customer"),
            lambda: write(gold.dim_product(staged["stg_products"]), "gold.dim_product"),
            dates,
        ],
    )
    return spark.table("gold.fact_orders").count()


def check_gold(spark: SparkSession) -> DataFrame:
    checks = [partial(quality.run_checks, spark.table(layer("gold", table)), table, suite) for table, suite in quality.GOLD_SUITES.items()]
    return reduce(DataFrame.unionByName, run_together(spark, checks))


def answer_store(spark: SparkSession) -> str:
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/annotation_answers"


def annotate_reviews(
    spark: SparkSession,
    annotator: annotate.Annotator,
    limit: int | None = annotate.QUEUE_LIMIT,
    store: str | None = None,
    pace: answers.Pace = answers.Pace(),
) -> DataFrame:
    """Annotate waiting reviews, append the answers to the annotation table, return the run summary.

    Answers cost money: each is kept in ``store`` (by default beside the tables) as soon as its call ends, and is not asked for
    again by a retry or another run.
    """
    reviews = spark.table("silver.reviews")
    queue = annotate.annotation_queue(reviews, annotate.read_annotations(spark, ANNOTATIONS_TABLE), limit)
    prompts = annotate.build_prompts(annotate.make_batches(queue))
    responses = materialize(answers.ask(prompts, annotator, store or answer_store(spark), pace), "responses")
    parsed = annotate.parse_annotations(responses)
    known = annotate.last_per_review(parsed).join(reviews.select("review_id"), "review_id", "left_semi")
    annotate.append_annotations(known, ANNOTATIONS_TABLE)
    annotate.compact_annotations(spark, ANNOTATIONS_TABLE)
    return annotate.run_summary(responses, parsed, reviews)


def run_everything(
    spark: SparkSession,
    run_id: str,
    csv_folder: str,
    payload_path: str,
    model_path: str,
    expected_orders: tuple[int, int] = quality.ANY_ORDERS,
    annotator: annotate.Annotator | None = None,
    model_options: dict | None = None,
    annotation_limit: int | None = None,
    annotation_pace: answers.Pace = answers.Pace(),
    calendar: tuple[str, str] | None = None,
    csv_loaded: Callable[[], None] | None = None,
) -> DataFrame:
    """The whole batch run, one metrics row per stage, and the summary of its model.

    A failing stage is recorded and ends the run. ``annotation_limit`` bounds the reviews annotated in this run; None takes all
    that wait. What a stage materialises lies in a scratch folder of its own that goes with the stage, as do its shuffle files.
    ``csv_loaded`` is called once the CSV files are in their tables and no longer read, to delete or archive them.
    """
    metrics.setup_metrics_table(spark)
    _run_stages(
        spark, run_id, csv_folder, payload_path, model_path, expected_orders, annotator, model_options or {},
        annotation_limit, annotation_pace, calendar, csv_loaded,
    )
    return metrics.model_summary(spark.table(metrics.METRICS_TABLE), run_id)


@contextmanager
def _stage(spark: SparkSession, run_id: str, name: str) -> Iterator[metrics.Stage]:
    """A recorded stage that leaves its tables and no other files."""
    try:
        with scratch_scope(spark), metrics.Stage(spark, run_id, name) as stage:
            yield stage
    finally:
        free_shuffles(spark)


def _run_stages(
    spark, run_id, csv_folder, payload_path, model_path, expected_orders, annotator, model_options,
    annotation_limit, annotation_pace, calendar, csv_loaded,
) -> None:

    with _stage(spark, run_id, "ingestion_csv") as stage:
        stage.rows = total_rows(load_all_csv(spark, csv_folder))
    if csv_loaded is not None:
        csv_loaded()
    with _stage(spark, run_id, "ingestion_api") as stage:
        before = spark.table("bronze.raw_exchange_rates").count() if spark.catalog.tableExists("bronze.raw_exchange_rates") else 0
        append_rates(flatten_rates(read_payloads(spark, payload_path)))
        stage.rows = spark.table("bronze.raw_exchange_rates").count() - before
    with _stage(spark, run_id, "spark_etl") as stage:
        sources = {source for source, _ in SILVER_TABLES.values()}
        status = build_silver(spark, {s: spark.table(layer("bronze", s)) for s in sources})
        stage.rows = sum(row["rows"] for row in status.collect())  # one row per table
    silver = {t: spark.table(layer("silver", t)) for t in SILVER_TABLES}

    with _stage(spark, run_id, "data_quality") as stage:
        results = quality.validate(silver["orders"], silver["order_items"], silver["reviews"], expected_orders)
        stage.rows = 3
        try:
            stage.extra.update(quality.require_quality(results))
        except quality.QualityError as error:
            stage.extra.update(checks_passed=error.passed, checks_total=error.total)
            raise
    with _stage(spark, run_id, "feature_engineering") as stage:
        table = features.build_features(
            silver["orders"], silver["customers"], silver["order_items"], silver["reviews"], spark.table("bronze.raw_payments")
        )
        overwrite_table(table, "ml.feature_store")
        stage.rows = spark.table("ml.feature_store").count()
    with _stage(spark, run_id, "churn_model") as stage:
        scores, measured, _ = churn.train_and_score(spark.table("ml.feature_store"), model_path, **model_options)
        overwrite_table(scores, "ml.churn_scores")
        stage.rows = spark.table("ml.churn_scores").count()
        stage.extra.update({name: round(value, 4) for name, value in measured.items()})
    with _stage(spark, run_id, "restore_annotation_columns") as stage:
        if annotator is not None:
            stage.rows = annotate_reviews(spark, annotator, annotation_limit, pace=annotation_pace).first()["annotations_saved"]
    with _stage(spark, run_id, "gold_layer") as stage:
        stage.rows = build_gold(spark, calendar=calendar)
        stage.extra["checks"] = quality.require_quality(check_gold(spark))
