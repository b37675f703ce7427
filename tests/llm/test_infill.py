import hashlib
import random
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from silverlode.llm import infill
from silverlode.llm.registry import ORACLES, QUERIES

SMALL = "/root/testdata/sf0.001"


def plain(doc_id, text, seed=7, rate=100, spm_share=50):
    """One text at a time, by the definition."""
    text = text or ""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    n = len(units)
    if not text or any(mark in text for mark in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return doc_id, n, "plain", None, None, text
    low, high = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = ("".join(part) for part in (units[:low], units[low:high], units[high:]))
    if h[3] % 100 < spm_share:
        return doc_id, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return doc_id, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def random_rows(count):
    rng = random.Random(5)
    parts = ["\n", "a", "Ünïcode 🙂", "\r", "\x0b", " ", "<P", ">", "<", "S>", " ", "\n\n", "中文"]
    rows = [(i, "".join(rng.choices(parts, k=rng.randint(0, 25)))) for i in range(count)]
    odd = ["", None, "\n", "\n\n\n", "x", "a<P>b", "a\n<S>", "<M>", "last line has no break\nx", "line\n" * 30_000]
    return rows + [(1000 + i, text) for i, text in enumerate(odd)] + [(None, "a\nb\nc\n"), (3, "a\nb"), (3, "a\nb")]


@pytest.mark.parametrize("rate,spm_share", [(100, 50), (40, 0), (100, 100), (0, 50)])
def test_equals_the_plain_version(frame, rate, spm_share):
    rows = random_rows(400)
    docs = frame([(i, t, 9, "x") for i, t in rows], "doc_id long, text string, n long, output string").repartition(3)
    made = infill.transform(docs, rate=rate, spm_share=spm_share)
    got = [tuple(row) for row in made.collect()]
    assert sorted(got, key=repr) == sorted((plain(i, t, 7, rate, spm_share) for i, t in rows), key=repr)


def test_texts_come_back(frame):
    docs = frame(random_rows(300), "doc_id long, text string")
    back = infill.transform(docs).select("doc_id", infill.restore(F.col("output"), F.col("form")).alias("text"))
    got = sorted(((r.doc_id, r.text) for r in back.collect()), key=repr)
    assert got == sorted(((i, t or "") for i, t in random_rows(300)), key=repr)


def test_slices_do_not_change_the_result(frame, monkeypatch):
    docs = frame(random_rows(200), "doc_id long, text string").coalesce(1)
    whole = sorted(map(repr, infill.transform(docs).collect()))
    monkeypatch.setattr(infill, "SLICE_BYTES", 40)
    assert sorted(map(repr, infill.transform(docs).collect())) == whole


def test_an_empty_table(frame):
    assert infill.transform(frame([], "doc_id long, text string")).collect() == []


def test_query_equals_sql(spark):
    got = sorted(tuple(r) for r in QUERIES["op13_fill_in_middle"](spark, SMALL).collect())
    documents = f"(SELECT * FROM '{SMALL}/documents.parquet')"
    assert got == sorted(duckdb.sql(ORACLES["op13_fill_in_middle"].replace("FROM documents", f"FROM {documents}")).fetchall())
