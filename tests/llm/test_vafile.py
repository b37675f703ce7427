import math
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from silverlode.llm import vafile
from silverlode.llm.registry import ORACLES, QUERIES

SMALL = "/root/testdata/sf0.001"


def plain(rows, every, k):
    usable = {}
    for vec_id, vec in rows:
        if vec_id is not None and vec is not None and all(x is not None and math.isfinite(x) for x in vec):
            usable.setdefault(vec_id, []).append([math.floor(256 * float(x)) for x in vec])
    out = []
    for query in sorted(q for q in usable if q % every == 0):
        mine = min(usable[query])
        scores = sorted(
            (-max(-(2**63), min(2**63 - 1, sum(a * b for a, b in zip(mine, vec)))), other)
            for other, vecs in usable.items()
            for vec in vecs
            if other != query and len(vec) == len(mine)
        )
        out += [(query, n + 1, other, -s) for n, (s, other) in enumerate(scores[:k])]
    return out


def got(df):
    return sorted(tuple(r) for r in df.select("query_id", "rank", "vec_id", "score").collect())


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<double>, score int, rank string")


def test_edge_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [0.5, 0.25]), (1, [0.5, 0.25]), (1, [0.5, 0.25]), (2, [1.0, -1.0]), (3, None), (4, [nan, 1.0]), (5, [None, 1.0])]
    rows += [(6, [inf, 0.0]), (None, [1.0, 1.0]), (8, [1.0, 2.0, 3.0]), (9, [1.0, 2.0, 3.0]), (10, []), (11, []), (12, [-0.5, 0.001])]
    df = frame(spark, rows)
    assert got(vafile.top_k(df, F.col("vec_id") % 2 == 0, k=3)) == plain(rows, 2, 3)
    assert vafile.top_k(df.limit(0), F.col("vec_id") % 2 == 0).count() == 0
    assert vafile.top_k(frame(spark, [(1, [1.0])]), F.col("vec_id") % 2 == 0).count() == 0


def test_large_components(spark):
    rows = [(i, [10.0 ** (i % 16), -3.0 * i]) for i in range(40)]
    assert got(vafile.top_k(frame(spark, rows), F.col("vec_id") % 4 == 0)) == plain(rows, 4, 5)


@pytest.mark.parametrize("bits", [1, 6])
def test_many_ties_and_blocks(spark, bits, monkeypatch):
    rng = random.Random(3)
    common = [rng.gauss(0, 0.1) for _ in range(8)]
    rows = [(i, common if i % 3 == 0 else [rng.gauss(0, 0.1) for _ in range(8)]) for i in range(2600)]
    df = frame(spark, rows).repartition(3)
    assert got(vafile.top_k(df, F.col("vec_id") % 40 == 0, bits=bits)) == plain(rows, 40, 5)


def test_bounds_hold():
    rng = np.random.default_rng(1)
    matrix, queries = rng.integers(-90, 90, (300, 12)), rng.integers(-90, 90, (20, 12))
    grids = vafile._grids({12: (matrix.min(axis=0), matrix.max(axis=0))}, 4)
    low, width = grids[12]
    cells = ((matrix - low) // width.astype(np.int64)).astype(np.uint8)
    assert cells.max() < 16
    lower, upper = vafile.bounds(queries, cells, low, width)
    scores = queries @ matrix.T
    assert (lower <= scores).all() and (scores <= upper).all()


def test_query_against_sql(spark):
    duckdb.sql(f"CREATE OR REPLACE VIEW embeddings AS SELECT * FROM '{SMALL}/embeddings.parquet'")
    want = duckdb.sql(ORACLES["op2_va_file_top_k"]).select("query_id, rank, vec_id, score").fetchall()
    assert got(QUERIES["op2_va_file_top_k"](spark, SMALL)) == sorted(want)
