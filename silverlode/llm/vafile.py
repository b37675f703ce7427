"""Exact top-k search by inner product with a vector-approximation file.

Vectors are packed into blocks. A block holds the ids, the cell of every component on a grid of ``2**bits`` equal
cells between the least and the largest value of its dimension (over all vectors), and the exact components. The search
first scans the cells alone: a cell bounds its component, so a cell row bounds the inner product with a query from both
sides. The k-th largest lower bound of a query over all blocks is a floor for its results. The second pass visits the
vectors whose upper bound reaches the floor, reads their exact components in the order of their bounds, best first, and
stops once the k-th exact score is above every bound still to come.

Queries come in blocks too. Each block of queries meets each block of vectors in one row of an equi-join on a grid, and a
task hands on at most k candidates per query.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scratch import materialize

BLOCK_ROWS = 1024
QUERY_ROWS = 4096
GRID = 64
EXACT = 2**52  # below this, sums of products are whole numbers in doubles
LONG = 2**63 - 1


def integer_vectors(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """``vec_id``, ``vec`` with floor(scale * x) per component. Rows without a usable vector are left out.

    Left out are null ids, null vectors and vectors with a null or non-finite component.
    """
    cells = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale).cast("long"))
    broken = F.exists(
        "embedding", lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf"))
    )
    return vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & ~broken).select(
        F.col("vec_id").cast("long"), cells.alias("vec")
    )


def _arrays(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Ids and a matrix for each length of vector in the batch."""
    ids = batch.column(0).to_numpy(zero_copy_only=False)
    offsets = batch.column(1).offsets.to_numpy()
    flat = batch.column(1).values.to_numpy(zero_copy_only=False)
    lengths = np.diff(offsets)
    for dims in np.unique(lengths):
        rows = np.flatnonzero(lengths == dims)
        places = offsets[rows][:, None] + np.arange(dims)
        yield ids[rows], flat[places].astype(np.int64)


def _extremes(vectors: DataFrame) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Least and largest value of each component, by vector length: a few numbers per dimension."""

    def run(batches):
        for batch in batches:
            for _, matrix in _arrays(batch):
                dims = matrix.shape[1]
                if dims:
                    columns = [np.full(dims, dims), np.arange(dims), matrix.min(axis=0), matrix.max(axis=0)]
                    names = ["dims", "at", "low", "high"]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)

    found = vectors.mapInArrow(run, "dims long, at long, low long, high long")
    rows = found.groupBy("dims", "at").agg(F.min("low"), F.max("high")).orderBy("dims", "at").collect()
    out: dict[int, tuple[list, list]] = {}
    for dims, _, low, high in rows:
        lows, highs = out.setdefault(dims, ([], []))
        lows.append(low)
        highs.append(high)
    return {dims: (np.array(a, dtype=np.int64), np.array(b, dtype=np.int64)) for dims, (a, b) in out.items()}


def _grids(extremes, bits: int):
    """Origin and cell width of each dimension, by vector length."""
    cells = 1 << bits
    return {
        dims: (low, np.array([-((int(a) - int(b) - 1) // cells) for a, b in zip(low, high)], dtype=object))
        for dims, (low, high) in extremes.items()
    }


def _pack(grids, block_rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for ids, matrix in _arrays(batch):
                dims = matrix.shape[1]
                low, width = grids.get(dims, (np.zeros(0, dtype=np.int64), np.ones(0, dtype=object)))
                for at in range(0, len(ids), block_rows):
                    part = matrix[at : at + block_rows]
                    cells = np.floor_divide(part.astype(object) - low, width) if np.abs(part).max(initial=0) > 2**52 else (
                        (part - low) // width.astype(np.int64)
                    )
                    columns = [
                        pa.array([number]),
                        pa.array([dims]),
                        pa.array([np.ascontiguousarray(ids[at : at + block_rows], dtype=np.int64).tobytes()], pa.binary()),
                        pa.array([cells.astype(np.uint8).tobytes()], pa.binary()),
                        pa.array([np.ascontiguousarray(part).tobytes()], pa.binary()),
                    ]
                    number += 1
                    yield pa.RecordBatch.from_arrays(columns, ["block", "dims", "ids", "cells", "exact"])

    return run


def _product(queries: np.ndarray, matrix: np.ndarray) -> np.ndarray:
    """Exact inner products; whole numbers of any size where doubles would round."""
    largest = max(1, queries.shape[1])
    for side in (queries, matrix):
        largest *= int(np.abs(side.astype(np.float64)).max(initial=0)) + 1
    if largest < EXACT:
        return queries.astype(np.float64) @ matrix.T.astype(np.float64)
    return queries.astype(object) @ matrix.T.astype(object)


def bounds(queries: np.ndarray, cells: np.ndarray, low: np.ndarray, width: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of the inner products, from the cells alone."""
    if not queries.shape[1]:
        nothing = np.zeros((len(queries), len(cells)))
        return nothing, nothing
    sizes = [int(np.abs(queries.astype(np.float64)).max(initial=0)) + 1]
    sizes.append(int(np.abs(low.astype(np.float64)).max()) + (int(max(width)) << 8) + 1)
    if 4 * queries.shape[1] * sizes[0] * sizes[1] >= EXACT:  # too large for whole numbers in doubles: no bound
        shape = (len(queries), len(cells))
        return np.full(shape, -np.inf), np.full(shape, np.inf)
    width = width.astype(np.int64)
    middles = (low + cells * width).astype(np.float64) + (width - 1) / 2
    about = queries.astype(np.float64) @ middles.T
    slack = np.abs(queries).astype(np.float64) @ ((width - 1) / 2)
    return about - slack[:, None], about + slack[:, None]


def _matrix(raw: bytes, kind, dims: int, rows: int) -> np.ndarray:
    return np.frombuffer(raw, dtype=kind).reshape(rows, dims)


def _pairs(batches: Iterator[pa.RecordBatch]):
    """One dictionary per pair of blocks."""
    for batch in batches:
        for row in range(batch.num_rows):
            yield {name: batch.column(k)[row].as_py() for k, name in enumerate(batch.schema.names)}


def _floors(grids, k: int):
    """Scan the cells: the k largest lower bounds of each query over the blocks of this task."""

    def run(batches):
        best: dict[int, np.ndarray] = {}
        for pair in _pairs(batches):
            dims = pair["dims"]
            asked = np.frombuffer(pair["query_ids"], dtype=np.int64)
            queries = _matrix(pair["queries"], np.int64, dims, len(asked))
            ids = np.frombuffer(pair["ids"], dtype=np.int64)
            cells = _matrix(pair["cells"], np.uint8, dims, len(ids))
            lower, _ = bounds(queries, cells, *grids.get(dims, (None, None)))
            lower = np.where(asked[:, None] == ids, -np.inf, lower)
            top = np.partition(lower, -k, axis=1)[:, -k:] if len(ids) > k else lower
            for query, values in zip(zip([dims] * len(asked), asked.tolist()), top):
                merged = np.concatenate([best.get(query, values[:0]), values])
                best[query] = np.sort(merged)[-k:]
        if best:
            columns = [[q[0] for q in best], [q[1] for q in best], [v[np.isfinite(v)].tolist() for v in best.values()]]
            kinds = [pa.int64(), pa.int64(), pa.list_(pa.float64())]
            arrays = [pa.array(c, kind) for c, kind in zip(columns, kinds)]
            yield pa.RecordBatch.from_arrays(arrays, ["dims", "query_id", "bounds"])

    return run


def visit(query: np.ndarray, upper: np.ndarray, ids: np.ndarray, exact: np.ndarray, k: int) -> list[tuple[int, int]]:
    """The k best (score, id) of the given vectors, read in the order of their upper bounds."""
    order = np.argsort(-upper, kind="stable")
    best: list[tuple[int, int]] = []
    for at in range(0, len(order), 64):
        if len(best) == k and -best[-1][0] > upper[order[at]]:
            break
        part = order[at : at + 64]
        scores = _product(query[None, :], exact[part])[0]
        best = sorted(best + [(-max(-LONG - 1, min(LONG, int(s))), int(i)) for s, i in zip(scores, ids[part])])[:k]
    return [(-s, i) for s, i in best]


def _visits(grids, k: int):
    """Second pass: exact scores where the upper bound reaches the floor of the query."""

    def run(batches):
        for pair in _pairs(batches):
            dims = pair["dims"]
            asked = np.frombuffer(pair["query_ids"], dtype=np.int64)
            queries = _matrix(pair["queries"], np.int64, dims, len(asked))
            floors = np.frombuffer(pair["floors"], dtype=np.float64)
            ids = np.frombuffer(pair["ids"], dtype=np.int64)
            cells = _matrix(pair["cells"], np.uint8, dims, len(ids))
            _, upper = bounds(queries, cells, *grids.get(dims, (None, None)))
            reach = (upper >= floors[:, None]) & (asked[:, None] != ids)
            exact = _matrix(pair["exact"], np.int64, dims, len(ids))
            found = []
            for q in np.flatnonzero(reach.any(axis=1)):
                rows = np.flatnonzero(reach[q])
                for score, vec in visit(queries[q], upper[q][rows], ids[rows], exact[rows], k):
                    found.append((int(asked[q]), vec, score))
            if found:
                columns = [pa.array(c, pa.int64()) for c in zip(*found)]
                yield pa.RecordBatch.from_arrays(columns, ["query_id", "vec_id", "score"])

    return run


def top_k(vectors: DataFrame, is_query, k: int = 5, scale: int = 256, bits: int = 6) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id``, ``score``: the k best other vectors of each query.

    ``vectors`` has ``vec_id`` and ``embedding``; ``is_query`` is a condition on ``vec_id``. Equal scores rank by the
    smaller ``vec_id``; fewer candidates than k give fewer rows. A row with the id of a query is never its candidate, so
    a repeated row does not find itself; repeated candidates take a place each. Vectors are compared with vectors of
    their own length. Scores beyond a long are cut to its range. A repeated query id is answered once, from the first
    of its vectors in the order of the components. Unusable vectors (see ``integer_vectors``) take no part; an empty table gives an
    empty result; other columns are ignored.
    """
    spark = vectors.sparkSession
    usable = integer_vectors(vectors, scale)
    grids = _grids(_extremes(usable), bits)
    schema = "block long, dims long, ids binary, cells binary, exact binary"
    blocks = materialize(usable.mapInArrow(_pack(grids, BLOCK_ROWS), schema), "vector-blocks")

    asked = usable.where(is_query).groupBy("vec_id").agg(F.min("vec").alias("vec"))
    count = asked.count()
    parts = max(1, -(-count // QUERY_ROWS))
    asked = asked.repartition(parts, F.xxhash64("vec_id"))
    questions = materialize(
        asked.mapInArrow(_pack(grids, QUERY_ROWS), schema).select(
            F.col("block").alias("query_block"), "dims", F.col("ids").alias("query_ids"), F.col("exact").alias("queries")
        ),
        "query-blocks",
    )

    names = questions.select("query_block", "dims")
    cell = F.pmod(F.xxhash64("block"), F.lit(GRID)).cast("int")
    placed = blocks.withColumn("cell", cell).join(names, "dims")
    every_cell = F.explode(F.sequence(F.lit(0), F.lit(GRID - 1))).alias("cell")

    def meet(vector_columns: list[str], asking: DataFrame) -> DataFrame:
        left = placed.select("cell", "query_block", *vector_columns)
        right = asking.select("*", every_cell)
        # merged, never broadcast: the side of the queries is copied to every cell of the grid
        return left.join(right.hint("merge"), ["cell", "query_block"]).drop("cell", "query_block")

    scanned = meet(["ids", "cells"], questions).mapInArrow(
        _floors(grids, k), "dims long, query_id long, bounds array<double>"
    )
    floors = (
        scanned.select("dims", "query_id", F.explode("bounds").alias("bound"))
        .select("*", F.row_number().over(Window.partitionBy("dims", "query_id").orderBy(F.desc("bound"))).alias("nth"))
        .where(F.col("nth") == k)
        .select("dims", "query_id", "bound")
    )
    floored = materialize(_attach_floors(questions, floors), "query-floors")
    found = meet(["ids", "cells", "exact"], floored).mapInArrow(
        _visits(grids, k), "query_id long, vec_id long, score long"
    )
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.select("*", F.row_number().over(best).alias("rank")).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _attach_floors(questions: DataFrame, floors: DataFrame) -> DataFrame:
    """Query blocks with the floor of each of their queries, minus infinity where there is none."""

    def ids(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                asked = np.frombuffer(batch.column(2)[row].as_py(), dtype=np.int64)
                same = [np.full(len(asked), batch.column(k)[row].as_py(), dtype=np.int64) for k in (0, 1)]
                columns = [pa.array(c) for c in (*same, np.arange(len(asked)), asked)]
                yield pa.RecordBatch.from_arrays(columns, ["query_block", "dims", "at", "query_id"])

    places = questions.select("query_block", "dims", "query_ids").mapInArrow(
        ids, "query_block long, dims long, at long, query_id long"
    )
    lists = (
        places.join(floors, ["dims", "query_id"], "left")
        .groupBy("query_block")
        .agg(F.sort_array(F.collect_list(F.struct("at", F.coalesce("bound", F.lit(float("-inf"))).alias("bound")))).alias("l"))
        .select("query_block", F.col("l.bound").alias("floors"))
    )

    def pack(batches):
        for batch in batches:
            values = [np.array(v, dtype=np.float64).tobytes() for v in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values, pa.binary())], ["query_block", "floors"])

    return questions.join(lists.mapInArrow(pack, "query_block long, floors binary"), "query_block")
