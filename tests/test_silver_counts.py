import os
import subprocess
import sys

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from silverlode.operators import silver
from silverlode.plans import builds
from silverlode.sources.adapters import BRONZE, Tables

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SMALL = "/root/testdata/sf0.001"

# A session of its own, in which the first attempt of every writing task fails after it has passed its rows on.
RETRIED = """
import sys
from pyspark import TaskContext
from pyspark.sql import Observation, SparkSession, functions as F
from silverlode.operators import silver

spark = (SparkSession.builder.master("local[4,3]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "4")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "false").getOrCreate())
spark.sparkContext.setLogLevel("OFF")

def fail_first(batches):
    for batch in batches:
        yield batch
    if TaskContext.get().attemptNumber() == 0:
        raise RuntimeError("lost")

losses = Observation()
raw = spark.range(9000).select((F.col("id") % 1000).cast("string").alias("k"), F.when(F.col("id") % 10 != 0, F.col("id")).alias("v"))
raw = raw.withColumn("v", F.when(F.col("k") % 10 != 0, F.col("v")))
rows = silver.usable_rows(raw, "k", ["k", "v"], losses=losses)
rows.mapInArrow(fail_first, rows.schema).write.parquet(sys.argv[1])
print(spark.read.parquet(sys.argv[1]).count(), *silver.observed_losses(losses))
"""


def test_counts_stay_exact_when_writing_tasks_fail(tmp_path):
    env = {**os.environ, "PYTHONPATH": ROOT}
    done = subprocess.run([sys.executable, "-c", RETRIED, str(tmp_path / "out")], env=env, capture_output=True, text=True, timeout=240)
    assert done.stdout.split() == ["900", "9000", "8000", "100"], done.stderr[-2000:]


def test_counted_rows_are_the_rows_of_dedup(frame, tmp_path):
    rows = [("a", 2, None), ("a", 1, "x"), ("a", None, "y"), ("b", 1, "z"), ("b", 1, "z"), (None, 1, "w"), (None, 2, "w"), ("c", 5, None)]
    df = frame(rows, "k string, n int, v string")
    for order in (None, ["v"], ["v", "k"]):
        plain = silver.usable_rows(df, "k", ["k", "v"], order)
        losses = Observation()
        counted = silver.usable_rows(df, "k", ["k", "v"], order, losses)
        assert counted.columns == plain.columns and sorted(map(tuple, counted.collect()), key=str) == sorted(map(tuple, plain.collect()), key=str)
        unique = silver.dedup(df, "k", order)
        assert silver.observed_losses(losses) == (8, 8 - unique.count(), unique.count() - plain.count())


@pytest.mark.parametrize("key", ["k", None])
def test_no_rows(frame, key):
    losses = Observation()
    assert silver.usable_rows(frame([], "k string, v int"), key, ["v"], losses=losses).collect() == []
    assert silver.observed_losses(losses) == (0, 0, 0)


def test_silver_reads_bronze_once(spark):
    """Every bronze row passes a counting step once, but for the rates, which are also counted."""
    read = {name: spark.sparkContext.accumulator(0) for name in BRONZE}

    def watched(name, df):
        passed = read[name]

        def count(batches):
            for batch in batches:
                passed.add(batch.num_rows)
                yield batch

        return df.mapInArrow(count, df.schema)

    t = Tables(spark, SMALL)
    sources = {source for source, _ in builds.SILVER_TABLES.values()}
    bronze = {name: BRONZE[name](t) for name in sources}
    status = {r["table"]: r for r in builds.build_silver(spark, {name: watched(name, df) for name, df in bronze.items()}).collect()}
    for table, (source, _) in builds.SILVER_TABLES.items():
        rows = bronze[source].count()
        assert status[table]["rows_read"] == rows
        assert read[source].value == rows * (2 if table == "exchange_rates" else 1)
        if table in silver.CLEANED_BY:
            lost = silver.cleaning_losses(bronze[source], *silver.CLEANED_BY[table]).first()
            assert (status[table]["duplicates_removed"], status[table]["nulls_dropped"]) == (lost[1], lost[2])
