"""Equi-joins whose hot keys are spread over several tasks."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import materialize

# A key with more rows than this is split. About one comfortable task of order lines.
ROWS_PER_TASK = 2_000_000
# A longer list of hot keys than this is joined by shuffle instead of broadcast.
BROADCAST_KEYS = 100_000


def count_keys(frames: Sequence[DataFrame], key: str) -> DataFrame:
    """One row per value of ``key`` with its rows in each of ``frames``, as ``_n0``, ``_n1`` and so on.

    The key columns are counted exactly, with map-side combining; rows without a key are left out.
    """
    rows = [df.select(F.col(key), *[F.lit(int(i == k)).alias(f"_n{k}") for k in range(len(frames))]) for i, df in enumerate(frames)]
    together = reduce(DataFrame.unionByName, rows).where(F.col(key).isNotNull())
    return together.groupBy(key).agg(*[F.sum(f"_n{k}").alias(f"_n{k}") for k in range(len(frames))])


def hot_keys(
    left: DataFrame, last: DataFrame | None, key: str, rows_per_task: int = ROWS_PER_TASK, last_rows_per_task: int | None = None
) -> DataFrame:
    """Keys that deserve more than one task, with the tasks their rows in ``left`` and in ``last`` should get.

    The list is a written table of at most one row per ``rows_per_task`` rows of input.
    """
    counted = count_keys([left] if last is None else [left, last], key)
    return hot_counts(counted if last is not None else counted.withColumn("_n1", F.lit(0)), key, rows_per_task, last_rows_per_task)


def hot_counts(counted: DataFrame, key: str, rows_per_task: int = ROWS_PER_TASK, last_rows_per_task: int | None = None) -> DataFrame:
    """``hot_keys`` where the keys are counted already: ``_n0`` rows on the left, ``_n1`` in the last frame."""
    pieces = counted.select(
        key,
        F.greatest(F.lit(1), F.ceil(F.col("_n0") / rows_per_task)).cast("int").alias("_left_pieces"),
        F.greatest(F.lit(1), F.ceil(F.col("_n1") / (last_rows_per_task or rows_per_task))).cast("int").alias("_last_pieces"),
    )
    return materialize(pieces.where("_left_pieces > 1 OR _last_pieces > 1"), "hot-keys")


def salted_join(
    left: DataFrame,
    rights: Sequence[tuple[DataFrame, str]],
    key: str,
    hot: DataFrame,
) -> DataFrame:
    """``left.join(right, key, how)`` for each ``(right, how)`` in turn, hot keys cut into pieces.

    ``hot`` is what ``hot_keys`` found in ``left`` and the last right frame. The left rows of a hot key are dealt into
    pieces and the right rows of that key are copied to each piece. A key hot in the last right frame is dealt there and its
    left rows are copied. All joins use the same keys, so the left rows are shuffled once. Where no key is hot these are
    the plain joins.
    """
    if any(how not in ("inner", "left") for _, how in rights):
        raise ValueError("salted_join handles inner and left joins")
    found = hot.limit(BROADCAST_KEYS + 1).count()
    if not found:
        return reduce(lambda joined, right: joined.join(right[0], key, right[1]), rights, left)
    pieces = F.broadcast(hot) if found <= BROADCAST_KEYS else hot

    def with_pieces(df: DataFrame) -> DataFrame:
        return df.join(pieces, key, "left").fillna(1, ["_left_pieces", "_last_pieces"])

    def copied_to(count: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(count) - 1))

    columns = [key, *(c for c in left.columns if c != key)]
    joined = with_pieces(left).withColumn("_l", _deal(left, "_left_pieces")).withColumn("_r", copied_to("_last_pieces"))
    for i, (right, how) in enumerate(rights, 1):
        columns += [c for c in right.columns if c != key]
        piece = with_pieces(right).withColumn("_l", copied_to("_left_pieces"))
        if i < len(rights):
            piece = piece.withColumn("_r", copied_to("_last_pieces"))
        else:
            piece = piece.withColumn("_r", _deal(right, "_last_pieces")).withColumn("_hit", F.lit(True))
        joined = joined.join(piece.drop("_left_pieces", "_last_pieces"), [key, "_l", "_r"], how)
    if rights[-1][1] == "left":
        # A left row copied to several pieces of the last frame finds its matches in some of them. A key hot there
        # has matches for certain, so its unmatched copies are leftovers of the copying.
        joined = joined.where((F.col("_last_pieces") == 1) | F.col("_hit"))
    return joined.select(*columns)


def _deal(df: DataFrame, pieces: str) -> Column:
    """Piece number of a row. The partition number spreads exact copies of a row; unlike a random number it
    gives the same row the same piece when a task is retried."""
    spread = F.xxhash64(F.spark_partition_id(), *[F.col(c) for c in df.columns])
    return F.pmod(spread, F.col(pieces)).cast("int")
