import pytest
from pyspark.sql import functions as F

from silverlode.operators import metrics
from silverlode.sources import tables


@pytest.fixture
def log(spark, monkeypatch):
    """A metrics table of its own."""
    monkeypatch.setattr(metrics, "METRICS_TABLE", "monitoring.files_test")
    tables.create_layers(spark)
    tables.drop_table(spark, metrics.METRICS_TABLE)
    metrics.setup_metrics_table(spark)
    yield metrics.METRICS_TABLE
    tables.drop_table(spark, metrics.METRICS_TABLE)


def test_files_stay_few_over_a_hundred_stages(spark, log, monkeypatch):
    monkeypatch.setattr(metrics, "MOST_FILES", 8)
    most = 0
    for n in range(100):
        metrics.record_metric(spark, f"run-{n // 10}", f"stage-{n % 10}", "success", n)
        most = max(most, len(spark.table(log).inputFiles()))
    assert most <= 8
    found = spark.table(log).agg(F.count("stage"), F.sum("rows_processed"), F.count_distinct("run_id", "stage")).first()
    assert tuple(found) == (100, sum(range(100)), 100)
    assert metrics.run_summary(spark.table(log)).where("total_stages = 10 AND passed = 10").count() == 10


def test_rows_added_during_a_compaction_are_kept(spark, log, monkeypatch):
    for n in range(3):
        metrics.record_metric(spark, "run", f"stage-{n}", "success", n)
    switch = metrics.overwrite_table

    def meanwhile(df, table):
        metrics.append_table(spark.table(table).where("stage = 'stage-0'").withColumn("stage", F.lit("late")), table)
        switch(df, table)

    monkeypatch.setattr(metrics, "overwrite_table", meanwhile)
    assert metrics.compact_metrics(spark, most_files=1)
    assert sorted(r["stage"] for r in spark.table(log).collect()) == ["late", "stage-0", "stage-1", "stage-2"]
    assert not metrics.compact_metrics(spark)
