import csv as plain_csv
import io
import random

import pytest

from silverlode.sources import csv, csv_records


@pytest.fixture
def small_splits(spark):
    names = ["spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"]
    before = {name: spark.conf.get(name) for name in names}

    def use(size):
        for name in names:
            spark.conf.set(name, str(size))

    yield use
    for name, value in before.items():
        spark.conf.set(name, value)


def made_up_rows(rng, count):
    parts = ["a", "é", '"', '""', ",", "\n", "\r\n", "\n\n", " ", "word", "NA", "🙂", '",', '"\n']
    rows = []
    for i in range(count):
        text = "".join(rng.choices(parts, k=rng.choice([0, 1, 5, 60]))).strip()
        rows.append((str(i), text, rng.choice(["x", "5", ""])))
    return rows


def written(rows, end="\n", quoting=plain_csv.QUOTE_MINIMAL):
    out = io.StringIO()
    plain_csv.writer(out, lineterminator=end, quoting=quoting).writerows([("id", "text", "tail"), *rows])
    return out.getvalue()


def known(value):
    return None if value in csv.NA_SPELLINGS else value


@pytest.mark.parametrize("end,quoting,size", [("\n", plain_csv.QUOTE_MINIMAL, 700), ("\r\n", plain_csv.QUOTE_ALL, 97), ("\n", plain_csv.QUOTE_ALL, 10**6)])
def test_one_file_is_read_in_many_tasks(spark, tmp_path, small_splits, end, quoting, size):
    rows = made_up_rows(random.Random(size), 300)
    (tmp_path / "r.csv").write_text(written(rows, end, quoting), newline="")
    small_splits(size)
    df = csv.read_csv(spark, str(tmp_path / "r.csv"))
    assert df.rdd.getNumPartitions() >= min(8, len(written(rows)) // size)
    got = sorted(tuple(r) for r in df.collect())
    assert got == sorted(tuple(map(known, row)) for row in rows)
    if end != "\n":
        return
    # the reader of whole files agrees; with CR LF it changes line breaks inside fields
    whole = spark.read.csv(str(tmp_path / "r.csv"), header=True, multiLine=True, quote='"', escape='"')
    assert got == sorted(tuple(map(known, r)) for r in whole.collect())


def test_a_record_over_many_splits(spark, tmp_path, small_splits):
    long = "line\n" * 500 + 'with ""quotes"" and, commas\n' * 300
    (tmp_path / "r.csv").write_text(f'id,text\n1,"{long}"\n2,"b\n"\n')
    small_splits(64)
    got = {r.id: r.text for r in csv.read_csv(spark, str(tmp_path / "r.csv")).collect()}
    assert got == {"1": long.replace('""', '"'), "2": "b\n"}


def test_quotes_inside_bare_fields_are_text(spark, tmp_path, small_splits):
    (tmp_path / "r.csv").write_text('id,text\n1,5" pipe\n2,"a ""b"" c"\n3,x"y"z\n4,"two\nlines"\n' * 1)
    small_splits(8)
    got = {r.id: r.text for r in csv.read_csv(spark, str(tmp_path / "r.csv")).collect()}
    assert got == {"1": '5" pipe', "2": 'a "b" c', "3": 'x"y"z', "4": "two\nlines"}


def test_a_folder_of_files_with_blank_lines_and_marks(spark, tmp_path, small_splits):
    for k in range(3):
        (tmp_path / f"{k}.csv").write_bytes("﻿id,text\r\n\r\n{0}1,\"a\r\nb\"\r\n{0}2,c".format(k).encode())
    (tmp_path / "none.csv").write_text("")
    small_splits(10)
    got = sorted((r.id, r.text) for r in csv.read_csv(spark, str(tmp_path)).collect())
    assert got == sorted((f"{k}{i}", t) for k in range(3) for i, t in ((1, "a\r\nb"), (2, "c")))


def test_an_unclosed_quote(spark, tmp_path, small_splits):
    (tmp_path / "r.csv").write_text('a,b\n1,"x\ny"\n2,"open\n3,z\n4,w\n' + "5,v\n" * 100)
    path = str(tmp_path / "r.csv")
    for size in (16, 10**6):
        small_splits(size)
        with pytest.raises(csv_records.UnclosedQuote):
            csv.read_csv(spark, path)
        rows = {r.a: r.b for r in csv.read_csv(spark, path, on_error="null").collect()}
        assert set(rows) == {"1", "2"} and rows["1"] == "x\ny" and rows["2"].startswith("open")


def test_another_header_is_refused(spark, tmp_path):
    (tmp_path / "1.csv").write_text("a,b\n1,2\n")
    (tmp_path / "2.csv").write_text("b,a\n2,1\n")
    with pytest.raises(Exception, match="header"):
        csv.read_csv(spark, str(tmp_path)).collect()


def test_states_compose(spark):
    """The vectorised states of any lines equal those found one after the other, from either beginning."""
    import pyarrow as pa

    rng = random.Random(4)
    for _ in range(300):
        lines = ["".join(rng.choices(['"', '""', ",", "a", "b c"], k=rng.randint(0, 8))) for _ in range(12)]
        steps = csv_records._steps(pa.array(lines))
        for entry in (False, True):
            state, want = entry, []
            for line in lines:
                state = after(line, state)
                want.append(state)
            assert csv_records._open_after(*steps, entry).tolist() == want


def after(line, is_open):
    """Letter by letter: whether a quoted field is open after the line."""
    at, start = 0, True
    while at < len(line) or is_open:
        if at >= len(line):
            return True
        if is_open:
            if line[at] == '"' and line[at + 1 : at + 2] == '"':
                at += 1
            elif line[at] == '"':
                is_open = False
            start = False
        elif line[at] == '"' and start:
            is_open, start = True, False
        else:
            start = line[at] == ","
        at += 1
    return False


def test_each_record_is_parsed_once(spark, tmp_path):
    (tmp_path / "r.csv").write_text(written([("1", "a\nb", "x"), ("2", "c", "y")]), newline="")
    df = csv.read_csv(spark, str(tmp_path / "r.csv"))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_csv(") == plan.count("MapInArrow") == 1


def test_a_column_may_be_called_first(spark, tmp_path):
    (tmp_path / "r.csv").write_text('first,record\r\n1,"a\r\nb"\r\n2,"c"\r\n', newline="")
    rows = csv.read_csv(spark, str(tmp_path / "r.csv")).collect()
    assert sorted(map(tuple, rows)) == [("1", "a\r\nb"), ("2", "c")]
