"""Order statistics that never gather a whole column in one task."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .scratch import materialize


# So many values may come to the driver and be sorted there.
FEW = 10_000


def exact_median(df: DataFrame, column: str, name: str) -> DataFrame:
    """One row with the interpolated median of a double column, NULL if it holds no value.

    The bracket that holds the middle ranks is narrowed until it has at most ``FEW`` values, however many rows there are. An
    approximate percentile of what is left gives the next bracket: its error, one in 10,000 ranks, is well inside the two in 1,000 to
    either side. The values at both ends, which may be most of the rows, are counted apart, so ties cannot keep a bracket
    large. This runs a job or two for every factor of about 200 in the rows.
    """
    spark = df.sparkSession

    def result(low: float | None, high: float | None) -> DataFrame:
        middle = None if low is None else (low + high) / 2
        return spark.createDataFrame([(middle,)], f"`{name}` double")

    left = df.where(F.col(column).isNotNull()).select(F.col(column).cast("double").alias("v"))
    n = left.count()
    if not n:
        return result(None, None)
    low_rank, high_rank = (n + 1) // 2, (n + 2) // 2  # from 1, among what is left
    margin = 0.002
    while n > FEW:
        shares = [max(0.0, low_rank / n - margin), min(1.0, high_rank / n + margin)]
        a, b = left.agg(F.percentile_approx("v", shares, 10_000)).first()[0]
        v, end_a, end_b = F.col("v"), F.lit(a), F.lit(b)
        inside = (v > end_a) & (v < end_b)
        below, at_a, between, above, least, most = left.agg(
            F.count_if(v < end_a), F.count_if(v == end_a), F.count_if(inside), F.count_if(v > end_b),
            F.min(F.when(inside, v)), F.max(F.when(inside, v)),
        ).first()
        if low_rank <= below or high_rank > n - above:  # not bracketed
            margin *= 4
            continue

        def value(rank: int) -> float | None:
            """The value of a rank, if it is at an end or next to one; what is inside otherwise stays to be looked at."""
            if rank <= below + at_a:
                return a
            if rank > below + at_a + between:
                return b
            return least if rank == below + at_a + 1 else most if rank == below + at_a + between else None

        low, high = value(low_rank), value(high_rank)
        if low is not None and high is not None:
            return result(low, high)
        left = materialize(left.where(inside), "middle")
        n, low_rank, high_rank = between, low_rank - below - at_a, high_rank - below - at_a
    values = sorted((row[0] for row in left.collect()), key=lambda x: (math.isnan(x), x))
    return result(values[low_rank - 1], values[high_rank - 1])


def lowest_share(
    df: DataFrame, group: str, rank_by: str, tie: str, share: float, flag: str, cells: int = 4096
) -> DataFrame:
    """Flag exactly ``round(share * n)`` rows per group: those with the lowest (``rank_by``, ``tie``).

    ``rank_by`` is a whole number spread evenly over [0, 2^32). Counts per (group, cell) find the cell in which
    the cut falls, and only the rows of that cell, about n / ``cells`` of them, are ranked; all others are compared with
    the last row taken, without a shuffle. Groups must be few, as class labels are: the cuts, one row per group, are
    broadcast.
    """
    placed = df.withColumn("_cell", F.expr(f"`{rank_by}` div {(1 << 32) // cells}"))
    before = Window.partitionBy(group).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(group)
    cuts = (
        placed.groupBy(group, "_cell")
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_skipped", F.coalesce(F.sum("_n").over(before), F.lit(0)))
        .withColumn("_wanted", F.round(F.sum("_n").over(whole) * F.lit(share)).cast("long"))
        .where("_wanted > _skipped AND _wanted <= _skipped + _n")
        .select(F.col(group), F.col("_cell").alias("_cut"), (F.col("_wanted") - F.col("_skipped")).alias("_take"))
    )
    # only the rows of the cut cells are ranked; the last one taken of each group is a row of its own
    within_cell = Window.partitionBy(group).orderBy(rank_by, tie)
    last = (
        placed.join(F.broadcast(cuts), group)
        .where(F.col("_cell") == F.col("_cut"))
        .withColumn("_position", F.row_number().over(within_cell))
        .where(F.col("_position") == F.col("_take"))
        .select(group, F.struct(rank_by, tie).alias("_last"))
    )
    chosen = F.struct(rank_by, tie) <= F.col("_last")
    return df.join(F.broadcast(last), group, "left").select(*df.columns, F.coalesce(chosen, F.lit(False)).alias(flag))
