import threading

import pytest
from pyspark.sql import functions as F

from silverlode.functions.scratch import materialize, scratch_scope
from silverlode.functions.together import run_together
from silverlode.operators.silver import SILVER_TABLES
from silverlode.plans import builds
from silverlode.sources import csv
from silverlode.sources.adapters import BRONZE, Tables
from silverlode.sources.tables import overwrite_table


def test_steps_run_at_once_in_the_scope_of_the_caller(spark):
    meet = threading.Barrier(2, timeout=30)

    def step(n):
        def run():
            meet.wait()  # passes only if both steps run
            return materialize(spark.range(n), "together")

        return run

    with scratch_scope(spark) as path:
        frames = run_together(spark, [step(3), step(5)])
        assert [f.count() for f in frames] == [3, 5]
        assert all(path.rsplit("/", 1)[-1] in f.select(F.input_file_name()).first()[0] for f in frames)
    assert run_together(spark, []) == []


def test_an_error_comes_when_the_others_are_done(spark):
    done = []

    def fail():
        raise ValueError("no")

    with pytest.raises(ValueError, match="no"):
        run_together(spark, [fail, lambda: done.append(1)])
    assert done == [1]


def test_csv_files_are_loaded_at_once(spark, tmp_path, monkeypatch):
    meet = threading.Barrier(2, timeout=30)
    monkeypatch.setattr(csv, "load_csv", lambda *_: meet.wait() and 0 or 7)
    for name in "ab":
        (tmp_path / f"{name}.csv").write_text("x\n1\n")
    files = {name: csv.CsvFile(f"{name}.csv") for name in "abc"}
    assert csv.load_all_csv(spark, str(tmp_path), files) == {"a": 7, "b": 7, "c": None}


def test_silver_tables_are_built_at_once(spark):
    meet = threading.Barrier(len(SILVER_TABLES), timeout=60)

    def write(df, name):
        meet.wait()
        overwrite_table(df, name)

    bronze = {name: make(Tables(spark, "/root/testdata/sf0.001")) for name, make in BRONZE.items()}
    status = builds.build_silver(spark, bronze, write).collect()
    assert [(row["table"], row["status"]) for row in status] == [(table, "success") for table in SILVER_TABLES]
