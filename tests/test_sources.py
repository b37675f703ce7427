import json

import pytest
from pyspark.sql import functions as F

from silverlode.sources import csv, jdbc, rates, tables
from silverlode.sources.adapters import BRONZE, Tables
from silverlode.streaming.rates_feed import feed_rates

SMALL = "/root/testdata/sf0.001"
PAYLOAD = {"timestamp": 1700000000, "base": "USD", "rates": {"BRL": 5.25, "XTS": 0, "IDR": 1.6e4, "BTC": 1e-9}}


def test_csv_quotes_line_breaks_and_na(spark, tmp_path):
    (tmp_path / "r.csv").write_text('id,score,text\n1,5,"two\nlines"\n2,NA,"say ""hi"""\n3,4,NA\n4,,""\nnull,1,N/A\n')
    rows = csv.read_csv(spark, str(tmp_path / "r.csv"), {"score": "int"}).collect()
    assert [tuple(r) for r in rows] == [
        ("1", 5, "two\nlines"), ("2", None, 'say "hi"'), ("3", 4, None), ("4", None, None), (None, 1, None),
    ]


def test_csv_columns_go_by_name(spark, tmp_path):
    (tmp_path / "r.csv").write_text("b,a\nx,1\n")
    df = csv.read_csv(spark, str(tmp_path / "r.csv"), {"a": "int"}, line_breaks=False)
    assert df.schema.simpleString() == "struct<b:string,a:int>" and df.first() == ("x", 1)


def test_load_all_csv_replaces_and_skips(spark, tmp_path):
    (tmp_path / csv.CSV_FILES["raw_orders"].name).write_text('k,"free text"\n7,"a ""b"""\n8,\n')
    for _ in range(2):
        rows = csv.load_all_csv(spark, str(tmp_path))
        assert rows["raw_orders"] == 2 and rows["raw_reviews"] is None and csv.total_rows(rows) == 2
        assert spark.table("bronze.raw_orders").count() == 2


@pytest.mark.parametrize("line_breaks", [False, True])
def test_csv_lines_with_too_many_fields(spark, tmp_path, line_breaks):
    (tmp_path / "r.csv").write_text('a,b\n1,2\n3,4,5\n6\n7,"x,y"\n8,,\n')
    path = str(tmp_path / "r.csv")
    with pytest.raises(Exception, match="more fields"):
        csv.read_csv(spark, path, line_breaks=line_breaks).collect()
    rows = csv.read_csv(spark, path, line_breaks=line_breaks, on_error="null").collect()
    assert sorted((r["a"], r["b"] or "") for r in rows) == [("1", "2"), ("6", ""), ("7", "x,y")]
    assert sorted(r["line"] for r in csv.csv_rejects(spark, path, line_breaks).collect()) == ["3,4,5", "8,,"]


def test_csv_folder_with_another_header_is_refused(spark, tmp_path):
    (tmp_path / "1.csv").write_text("a,b\n1,2\n")
    (tmp_path / "2.csv").write_text("b,a\n2,1\n")
    with pytest.raises(Exception, match="(?i)header"):
        csv.read_csv(spark, str(tmp_path), line_breaks=False).collect()


def test_six_files():
    assert set(csv.CSV_FILES) == {"raw_orders", "raw_customers", "raw_order_items", "raw_products", "raw_reviews", "raw_payments"}


def test_rates_are_flattened(spark, tmp_path):
    (tmp_path / "p.json").write_text(json.dumps(PAYLOAD, indent=1))
    df = rates.flatten_rates(rates.read_payloads(spark, str(tmp_path)))
    assert df.columns == ["base_currency", "target_currency", "exchange_rate", "rate_timestamp", "fetched_at"]
    rows = {r["target_currency"]: r for r in df.collect()}
    assert {k: r["exchange_rate"] for k, r in rows.items()} == PAYLOAD["rates"] and rows["BRL"]["base_currency"] == "USD"
    assert str(rows["BRL"]["rate_timestamp"]) == "2023-11-14 22:13:20"
    assert {r["target_currency"] for r in rates.sample_currencies(df).collect()} == {"BRL"}


BAD_PAYLOADS = {
    None: "no payload",
    '{"timestamp": 1': "not JSON",
    "plain text": "not JSON",
    '{"timestamp": 1, "base": "USD"}': "no rates",
    '{"timestamp": 1, "base": "USD", "rates": [1]}': "no rates",
    '{"base": "USD", "rates": {"BRL": 1}}': "no timestamp",
    '{"timestamp": 1, "rates": {"BRL": 1}}': "no base currency",
    '{"timestamp": 1, "base": "USD", "rates": {"BRL": "dear"}}': "rate is not a number: dear",
    '{"timestamp": 1, "base": "USD", "rates": {"BRL": null}}': "rate is not a number: null",
}


@pytest.mark.parametrize("payload", BAD_PAYLOADS)
def test_unreadable_payloads_raise_or_are_listed(spark, payload):
    good = json.dumps(PAYLOAD)
    df = spark.createDataFrame([(good,), (payload,)], "payload string")
    with pytest.raises(Exception, match="rate"):
        rates.flatten_rates(df).collect()
    kept = rates.flatten_rates(df, on_error="null").collect()
    assert len([r for r in kept if r["exchange_rate"] is not None]) == 4
    assert [(r["payload"], r["reason"]) for r in rates.rate_rejects(df).collect()] == [(payload, BAD_PAYLOADS[payload])]


def test_one_bad_rate_does_not_take_the_others(spark):
    df = spark.createDataFrame([('{"timestamp": 1, "base": "USD", "rates": {"BRL": "x", "EUR": 2}}',)], "payload string")
    assert {r["target_currency"]: r["exchange_rate"] for r in rates.flatten_rates(df, on_error="null").collect()} == {"BRL": None, "EUR": 2.0}


def test_feed_hands_out_rejects(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    (landing / "1.json").write_text(json.dumps(PAYLOAD))
    (landing / "2.json").write_text("broken")
    args = [spark, str(landing), *(str(tmp_path / n) for n in ("history", "checkpoint"))]
    with pytest.raises(Exception):
        feed_rates(*args).awaitTermination(60)
    with pytest.raises(ValueError):
        feed_rates(*args, on_error="null")
    args[2:] = [str(tmp_path / n) for n in ("history2", "checkpoint2")]
    assert feed_rates(*args, on_error="null", rejects=str(tmp_path / "rejects")).awaitTermination(60)
    assert spark.read.parquet(args[2]).count() == 4
    assert [r["payload"] for r in spark.read.parquet(str(tmp_path / "rejects")).collect()] == ["broken"]


def test_rate_history_grows(spark, tmp_path):
    (tmp_path / "p.json").write_text(json.dumps(PAYLOAD))
    for n in (1, 2):
        rates.append_rates(rates.flatten_rates(rates.read_payloads(spark, str(tmp_path))), "bronze.history_test")
        seen = rates.verify_rates(spark.table("bronze.history_test")).first()
        assert (seen["total_rows"], seen["currencies"]) == (4 * n, 4) and seen["first_fetch"] <= seen["latest_fetch"]


def test_feed_takes_each_file_once(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    args = (spark, str(landing), str(tmp_path / "history"), str(tmp_path / "checkpoint"))
    for n in (1, 2):
        (landing / f"{n}.json").write_text(json.dumps(PAYLOAD))
        for _ in range(2):  # the second call finds nothing new
            assert feed_rates(*args).awaitTermination(60)
        assert spark.read.parquet(str(tmp_path / "history")).count() == 4 * n


def test_jdbc_options():
    cut = jdbc.Partitioning("id", 0, 1000, 16)
    options = jdbc.read_options("jdbc:x:y", "bronze.raw_orders", {"user": "u"}, cut)
    assert options["dbtable"] == "bronze.raw_orders" and options["user"] == "u"
    assert (options["partitionColumn"], options["lowerBound"], options["upperBound"], options["numPartitions"]) == ("id", "0", "1000", "16")
    assert "partitionColumn" not in jdbc.read_options("jdbc:x:y", "t")
    assert jdbc.write_options("jdbc:x:y", "t", connections=4)["numPartitions"] == "4"


def test_text_ranges_meet_every_row_once(spark):
    values = spark.createDataFrame([(v,) for v in ("", "a", "b", "m'x", "m'y", "z", None)], "k string")
    for bounds in (["b"], ["m'x", "b"], ["a", "a", "z"]):
        parts = jdbc.text_ranges("k", bounds)
        assert len(parts) == len(set(bounds)) + 1
        assert sum(values.where(part).count() for part in parts) == 7
    assert jdbc.text_ranges("k", []) == []
    with pytest.raises(ValueError):
        jdbc.read_jdbc(spark, "jdbc:x:y", "t", partitioning=jdbc.Partitioning("i", 0, 1, 2), predicates=["1 = 1"])


def test_layers(spark):
    tables.create_layers(spark)
    assert {"bronze", "silver", "gold", "ml", "monitoring"} <= {d.name for d in spark.catalog.listDatabases()}
    assert tables.layer("gold", "fact_orders") == "gold.fact_orders"
    with pytest.raises(ValueError):
        tables.layer("golden", "x")


def test_overwrite_append_and_view(spark):
    tables.create_layers(spark)
    df = spark.range(3).withColumn("d", F.lit(1).cast("decimal(10,2)"))
    tables.overwrite_table(df, "silver.t_test")
    tables.overwrite_table(df, "silver.t_test")
    tables.append_table(df, "silver.t_test")
    assert tables.read_table(spark, "silver.t_test").count() == 6
    tables.as_view(tables.read_table(spark, "silver.t_test").limit(1), "t_view")
    assert spark.table("t_view").count() == 1


def test_describe_and_sample(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    assert [tuple(r) for r in tables.describe_table(df).collect()] == [(0, "a", "int", 2, 0), (1, "b", "string", 2, 1)]
    assert tables.sample_rows(df, 1).count() == 1


def test_adapters_have_the_bronze_columns(spark):
    columns = {name: set(make(Tables(spark, SMALL)).columns) for name, make in BRONZE.items()}
    assert {"order_id", "customer_id", "order_status"} <= columns["raw_orders"] and len(columns["raw_orders"]) == 8
    assert columns["raw_payments"] == {"order_id", "payment_type"}
