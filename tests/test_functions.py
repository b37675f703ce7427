import datetime as dt
import math
import random
import statistics

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from silverlode.functions import selection
from silverlode.functions.columns import elapsed_days, risk_tier
from silverlode.functions.numbering import number_rows, running_total
from silverlode.functions.scratch import drop_scratch, materialize, scratch_root, scratch_scope
from silverlode.functions.selection import exact_median, lowest_share
from silverlode.functions.skew import hot_keys, salted_join
from silverlode.operators.silver import dedup

few = settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def test_numbering_equals_the_global_window(spark):
    df = spark.range(5_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 97).cast("string")).alias("k"),
        (F.col("id") % 7).alias("line"),
        F.when(F.col("id") % 11 > 0, F.col("id") % 5).alias("v"),
    )
    expected = df.withColumn("n", F.row_number().over(Window.orderBy("k", "line", "v"))).select("n", *df.columns)
    numbered = number_rows(df.repartition(5), ["k", "line"], "n")
    assert numbered.exceptAll(expected).count() == 0
    assert expected.exceptAll(numbered).count() == 0


def test_numbering_splits_exact_copies(spark):
    copies = spark.range(0, 40_000, 1, 16).select(F.lit("same").alias("k"))
    placed = number_rows(copies, ["k"], "n")
    assert placed.select(F.min("n"), F.max("n"), F.count_distinct("n")).first() == (1, 40_000, 40_000)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ranges = copies.withColumn("o", F.spark_partition_id()).repartitionByRange("k", "o")
        sizes = [r["count"] for r in ranges.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(sizes) == 8 and max(sizes) <= 10_000


@pytest.mark.parametrize("share", [0.0, 0.3, 1.0])
def test_numbering_by_keys_from_elsewhere(spark, share):
    rng = random.Random(3)
    rows = [(rng.choice([None, "", "a", f"k{rng.randrange(300)}", "hot"]), rng.choice([None, 1, 2]), i % 7) for i in range(3000)]
    df = spark.createDataFrame(rows, "k string, line int, v int").repartition(5)
    keys = df.where(F.rand(1) < share).select("k", "line")
    numbered = number_rows(df, ["k", "line"], "n", keys=keys)
    expected = df.withColumn("n", F.row_number().over(Window.orderBy("k", "line", "v"))).select("n", *df.columns)
    assert numbered.exceptAll(expected).count() == 0 and expected.exceptAll(numbered).count() == 0


def test_numbering_by_keys_runs_its_input_once(spark):
    """Without keys the rows are worked out for the ranges and again for the shuffle."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    base = spark.range(5000).selectExpr("id", "id % 17 AS v")
    number_rows(base.mapInArrow(count, "id long, v long"), ["id"], "n", keys=base.select("id")).collect()
    assert seen.value == 5000


def test_numbering_of_nothing(frame):
    assert number_rows(frame([], "k string"), ["k"], "n").count() == 0


@few
@given(st.lists(st.one_of(st.none(), st.floats(-50, 50).map(lambda x: round(x, 3))), max_size=40))
def test_exact_median(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x double").repartition(3)
    row = exact_median(df, "x", "m").collect()
    present = [v for v in values if v is not None]
    assert len(row) == 1
    assert row[0]["m"] == (pytest.approx(statistics.median(present)) if present else None)


@pytest.mark.parametrize("kind", ["spread", "ties", "two values", "tail", "nan"])
@pytest.mark.parametrize("n", [4000, 4001])
def test_exact_median_by_narrowing(spark, monkeypatch, kind, n):
    monkeypatch.setattr(selection, "FEW", 5)
    rng = random.Random(n)
    draw = {
        "spread": rng.random,
        "ties": lambda: rng.choice([0.25] * 9 + [rng.random()]),
        "two values": lambda: rng.choice([1.0, 2.0]),
        "tail": lambda: 10 ** rng.uniform(-300, 300),
        "nan": lambda: math.nan if rng.random() < 0.3 else rng.uniform(-1, 1),
    }[kind]
    values = [draw() for _ in range(n)]
    got = exact_median(spark.createDataFrame([(v,) for v in [*values, None]], "x double").repartition(3), "x", "m").first()["m"]
    in_order = sorted(values, key=lambda x: (math.isnan(x), x))
    assert got == (in_order[(n - 1) // 2] + in_order[n // 2]) / 2


def test_the_median_has_no_window_over_all_rows(spark):
    plan = exact_median(spark.range(100_000).selectExpr("cast(id % 1000 AS double) AS x"), "x", "m")._jdf.queryExecution().toString()
    assert "Window" not in plan and "SinglePartition" not in plan


@pytest.mark.parametrize("n, share, wanted", [(200, 0.2, 40), (7, 0.2, 1), (1, 0.2, 0), (2, 0.2, 0), (3, 0.2, 1)])
def test_lowest_share_is_exact_per_class(spark, n, share, wanted):
    df = spark.range(2 * n).select(
        (F.col("id") % 2).alias("label"), F.col("id").alias("key"), F.pmod(F.xxhash64("id"), F.lit(1 << 32)).alias("h")
    )
    out = lowest_share(df, "label", "h", "key", share, "chosen")
    rows = out.collect()
    assert len(rows) == 2 * n
    for label in (0, 1):
        mine = sorted((r["h"], r["key"]) for r in rows if r["label"] == label)
        assert sorted((r["h"], r["key"]) for r in rows if r["label"] == label and r["chosen"]) == mine[:wanted]


def _skewed(spark):
    left = spark.range(900).select(F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 40).cast("string")).alias("k"), (F.col("id") % 2).alias("a"))
    right = spark.range(120).select(F.when(F.col("id") % 4 == 0, "7").otherwise((F.col("id") % 60).cast("string")).alias("k"), "id")
    return left.repartition(6), right.repartition(5)


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("left_limit, right_limit", [(20, 10**6), (10**6, 3), (20, 3), (2, 1)])
def test_salted_join_equals_the_plain_join(spark, how, left_limit, right_limit):
    left, right = _skewed(spark)
    hot = hot_keys(left, right, "k", left_limit, right_limit)
    assert hot.count()
    got, expected = salted_join(left, [(right, how)], "k", hot), left.join(right, "k", how)
    assert got.columns == expected.columns
    assert got.exceptAll(expected).count() == 0 and expected.exceptAll(got).count() == 0


def test_salting_spreads_a_hot_key_of_exact_copies(spark):
    left = spark.range(0, 6_000, 1, 32).select(F.lit("hot").alias("k"))
    right = spark.createDataFrame([("hot", 1)], "k string, v int")
    hot = hot_keys(left, right, "k", 500)
    assert [tuple(r) for r in hot.collect()] == [("hot", 12, 1)]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        joined = salted_join(left, [(right, "inner")], "k", hot)
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(sizes) == 6_000 and len(sizes) > 2


def test_salted_join_without_hot_keys_is_the_plain_join(frame):
    left, right = frame([("a", 1)], "k string, x int"), frame([("a", 2)], "k string, y int")
    hot = hot_keys(left, right, "k")
    assert hot.count() == 0
    assert salted_join(left, [(right, "inner")], "k", hot).collect() == [("a", 1, 2)]
    with pytest.raises(ValueError):
        salted_join(left, [(right, "full")], "k", hot)


@pytest.mark.parametrize("hows", [("inner", "left"), ("left", "inner"), ("left", "left")])
def test_two_salted_joins_shuffle_the_left_once(spark, hows):
    left, last = _skewed(spark)
    middle = left.select("k").distinct().where("k <> '3'").withColumn("name", F.upper("k"))
    hot = hot_keys(left, last, "k", 3)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = salted_join(left, [(middle, hows[0]), (last, hows[1])], "k", hot)
        expected = left.join(middle, "k", hows[0]).join(last, "k", hows[1])
        assert got.exceptAll(expected).count() == 0 and expected.exceptAll(got).count() == 0
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert plan.count("hashpartitioning(k") == 4  # each frame on its way to the joins, and the distinct of the middle
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@few
@given(st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.integers(0, 3)), max_size=30))
def test_numbering_of_any_rows(spark, rows):
    df = spark.createDataFrame(rows, "k string, v int").repartition(3)
    numbered = sorted(tuple(r) for r in number_rows(df, ["k"], "n").collect())
    assert [r[0] for r in numbered] == list(range(1, len(rows) + 1))
    assert [r[1:] for r in numbered] == sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", r[1]))


@few
@given(st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.integers(0, 3)), max_size=30))
def test_dedup_of_any_rows(spark, rows):
    df = spark.createDataFrame(rows, "k string, v int").repartition(3)
    assert {tuple(r) for r in dedup(df, "k").collect()} == {(k, min(v for x, v in rows if x == k)) for k, _ in rows}


def test_elapsed_days_rounds_down(frame):
    later = dt.datetime(2020, 1, 1)
    rows = [(later, later - dt.timedelta(days=180)), (later, later - dt.timedelta(days=179, hours=23)), (later, later + dt.timedelta(hours=1)), (later, None)]
    out = frame(rows, "a timestamp, b timestamp").select(elapsed_days(F.col("a"), F.col("b")).alias("d"))
    assert [r["d"] for r in out.collect()] == [180, 179, -1, None]


def test_risk_tiers_are_closed_on_the_right(frame):
    values = [0.0, 0.3, 0.30001, 0.6, 1.0, 1.5]
    out = frame([(v,) for v in values], "p double").select(risk_tier(F.col("p")).alias("t"))
    assert [r["t"] for r in out.collect()] == [None, "low", "medium", "medium", "high", None]


def test_materialize_reads_what_it_wrote_from_the_shared_folder(spark):
    df = spark.range(10).withColumn("d", F.col("id").cast("decimal(10,2)"))
    written = materialize(df, "test")
    assert written.schema.simpleString() == df.schema.simpleString()
    assert written.exceptAll(df).count() == 0
    assert all(scratch_root(spark).removeprefix("file:") in f for f in written.inputFiles())


def test_a_scope_deletes_its_own_folder_only(spark):
    held = materialize(spark.range(5), "held")
    with scratch_scope(spark) as folder:
        inside = materialize(spark.range(3), "inside")
        assert folder in inside.inputFiles()[0] and inside.count() == 3
    assert held.count() == 5
    with pytest.raises(Exception, match="(?i)exist|not found"):
        spark.read.parquet(inside.inputFiles()[0]).count()
    with pytest.raises(ZeroDivisionError), scratch_scope(spark) as failed:
        materialize(spark.range(3), "inside")
        1 / 0
    path = spark._jvm.org.apache.hadoop.fs.Path(failed)
    assert not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def test_scratch_falls_back_to_the_warehouse(spark, monkeypatch):
    monkeypatch.setattr(type(spark.conf), "get", lambda self, key, *d, old=type(spark.conf).get: None if key == "spark.checkpoint.dir" else old(self, key, *d))
    assert scratch_root(spark).startswith(spark.conf.get("spark.sql.warehouse.dir").rstrip("/"))


def test_dropping_all_scratch(spark):
    materialize(spark.range(1), "gone")
    assert drop_scratch(spark)


@pytest.mark.parametrize("n", [0, 1, 3000])
def test_running_total(spark, n):
    rng = random.Random(5)
    rows = [(f"k{i}", rng.choice([0, 1, 5, 10**12])) for i in rng.sample(range(10 * n + 1), n)]
    got = running_total(spark.createDataFrame(rows, "k string, n long").repartition(5), "k", "n", "before")
    expected, total = [], 0
    for key, amount in sorted(rows):
        expected.append((key, total))
        total += amount
    assert sorted(map(tuple, got.collect())) == expected
