import csv as pycsv
import json
import os
import shutil

import pytest
from pyspark.sql import functions as F

from silverlode.functions.scratch import materialize
from silverlode.operators import metrics, quality
from silverlode.plans import builds
from silverlode.plans.registry import QUERIES, keyword_annotator
from silverlode.sources import csv
from silverlode.sources.adapters import BRONZE, Tables

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def raw_files(spark, tmp_path_factory):
    """The bronze shapes as CSV files with header, prices lowered into the range the checks allow."""
    folder = tmp_path_factory.mktemp("raw")
    for table, file in csv.CSV_FILES.items():
        df = BRONZE[table](Tables(spark, SMALL))
        if table == "raw_order_items":
            df = df.withColumn("price", F.round(F.col("price") / 20, 2))
        rows = df.collect()
        with open(folder / file.name, "w", newline="") as out:
            writer = pycsv.writer(out)
            writer.writerow(df.columns)
            writer.writerows(rows)
    return folder


@pytest.fixture(scope="module")
def payloads(tmp_path_factory):
    folder = tmp_path_factory.mktemp("payloads")
    (folder / "a.json").write_text(json.dumps({"timestamp": 1700000000, "base": "USD", "rates": {"BRL": 5.25, "XTS": 1e-9}}))
    return folder


def test_the_whole_run(spark, raw_files, payloads, tmp_path):
    builds.run_everything(
        spark, "run-1", str(raw_files), str(payloads), str(tmp_path / "model"),
        expected_orders=(1_000, 2_000), annotator=keyword_annotator(), model_options={"trees": 5},
    )
    log = spark.table(metrics.METRICS_TABLE).where("run_id = 'run-1'")
    stages = {r["stage"]: r for r in log.collect()}
    assert list(stages) and all(r["status"] == "success" for r in stages.values()) and len(stages) == 8
    assert stages["ingestion_csv"]["rows_processed"] == 1500 + 150 + 6000 + 200 + 1000 + 1500
    assert json.loads(stages["data_quality"]["extra_metrics"]) == {"checks_passed": 16, "checks_total": 16}
    assert stages["gold_layer"]["rows_processed"] == spark.table("gold.fact_orders").count() > 6000

    expected = spark.table("silver.order_items").join(spark.table("silver.orders").select("order_id"), "order_id")
    per_order = spark.table("silver.reviews").groupBy("order_id").count()
    lines = expected.join(per_order, "order_id", "left").agg(F.sum(F.coalesce("count", F.lit(1)))).first()[0]
    assert spark.table("gold.fact_orders").count() == lines
    assert spark.table("gold.fact_orders").where("sentiment_label IS NOT NULL").count() > 0
    assert spark.table("silver.review_annotations").count() == spark.table("silver.reviews").where("review_text IS NOT NULL").count()

    model = metrics.model_summary(spark.table(metrics.METRICS_TABLE), "run-1").first()
    assert 0.5 < model["auc_roc"] <= 1 and model["status"] == "success"
    assert [r["status"] for r in metrics.layer_health(spark).collect()] == ["ok"] * 4

    # annotated reviews do not come up again, and a rebuilt silver keeps its annotations
    assert builds.annotate_reviews(spark, keyword_annotator()).first()["annotations_saved"] == 0
    builds.build_silver(spark, {s: spark.table(f"bronze.{s}") for s, _ in builds.SILVER_TABLES.values()})
    assert builds.staging(spark)["stg_reviews"].where("sentiment_label IS NOT NULL").count() > 0

    written = {}
    builds.build_gold(spark, partition_fact=True, write=lambda df, name, parts=None: written.update({name: (df, parts)}))
    assert {name: parts for name, (_, parts) in written.items()} == {
        "gold.dim_customer": None, "gold.dim_product": None, "gold.dim_date": None, "gold.fact_orders": ["date_key"],
    }
    assert written["gold.fact_orders"][0].count() == lines


def test_one_bad_silver_table_does_not_stop_the_others(spark):
    t = Tables(spark, SMALL)
    bronze = {name: make(t) for name, make in BRONZE.items()}
    bronze["raw_customers"] = bronze["raw_customers"].drop("customer_city")
    with pytest.raises(builds.SilverError, match="customers") as error:
        builds.build_silver(spark, bronze, write=lambda df, name: df.write.mode("overwrite").saveAsTable(name))
    status = {r["table"]: r["status"] for r in error.value.status.collect()}
    assert status == {"orders": "success", "customers": "failed", "order_items": "success", "reviews": "success", "exchange_rates": "success"}


def test_a_failed_stage_is_recorded_and_ends_the_run(spark, raw_files, payloads, tmp_path):
    with pytest.raises(quality.QualityError):
        builds.run_everything(spark, "run-2", str(raw_files), str(payloads), str(tmp_path / "m"), expected_orders=(10**6, 10**7))
    rows = {r["stage"]: r for r in spark.table(metrics.METRICS_TABLE).where("run_id = 'run-2'").collect()}
    assert rows["data_quality"]["status"] == "failed" and "row count" in rows["data_quality"]["error_message"]
    assert json.loads(rows["data_quality"]["extra_metrics"]) == {"checks_passed": 15, "checks_total": 16}
    assert "feature_engineering" not in rows


def test_stages_leave_only_their_tables(spark, raw_files, payloads, tmp_path):
    """What a stage materialises goes with it, and loaded CSV files may go before the next one."""
    metrics.setup_metrics_table(spark)
    with builds._stage(spark, "run-5", "demo") as stage:
        held = materialize(spark.range(10), "held")
        files = [path.removeprefix("file:") for path in held.inputFiles()]
        stage.rows = held.count()
        assert files and all(map(os.path.exists, files))
    assert not any(map(os.path.exists, files))
    assert spark.table(metrics.METRICS_TABLE).where("run_id = 'run-5'").first()["rows_processed"] == 10

    landed = shutil.copytree(raw_files, tmp_path / "landed")
    with pytest.raises(quality.QualityError):
        builds.run_everything(
            spark, "run-6", str(landed), str(payloads), str(tmp_path / "m"),
            expected_orders=(10**6, 10**7), csv_loaded=lambda: shutil.rmtree(landed),
        )
    assert not landed.exists()
    rows = {r["stage"]: r for r in spark.table(metrics.METRICS_TABLE).where("run_id = 'run-6'").collect()}
    assert rows["spark_etl"]["status"] == "success" and rows["ingestion_csv"]["rows_processed"] == 1500 + 150 + 6000 + 200 + 1000 + 1500


def test_write_stage_counts_the_written_rows(spark):
    metrics.setup_metrics_table(spark)
    assert metrics.write_stage(spark.range(7), "silver.stage_test", "run-3", "demo") == 7
    row = spark.table(metrics.METRICS_TABLE).where("run_id = 'run-3'").first()
    assert (row["status"], row["rows_processed"]) == ("success", 7) and row["duration_seconds"] >= 0


def test_failing_metrics_do_not_break_the_job(spark, monkeypatch):
    monkeypatch.setattr(metrics, "append_table", lambda *a: (_ for _ in ()).throw(OSError("disk")))
    metrics.record_metric(spark, "r", "s", "success")


def test_stage_lets_errors_through(spark):
    metrics.setup_metrics_table(spark)
    with pytest.raises(ZeroDivisionError):
        with metrics.Stage(spark, "run-4", "boom") as stage:
            stage.rows = 3
            1 / 0
    row = spark.table(metrics.METRICS_TABLE).where("run_id = 'run-4'").first()
    assert (row["status"], row["rows_processed"]) == ("failed", 3) and "division" in row["error_message"]


def test_missing_and_empty_tables(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS silver")
    spark.range(0).write.mode("overwrite").saveAsTable("silver.nothing")
    rows = metrics.layer_health(spark, {"silver.nothing": None, "gold.unknown": None}).collect()
    assert [(r["status"], r["row_count"]) for r in rows] == [("empty", 0), ("missing", 0)]


def test_entry_and_registry(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(QUERIES) <= set(entry.oracle_sql())
    assert entry.entry(spark).count() > 6000
