"""Global row numbers without sending all rows to one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .scratch import materialize

# monotonically_increasing_id packs the partition number above bit 33 and the row position below it.
_POSITION_BITS = 33


# Keys drawn for each range: ranges then differ by about a tenth in size.
_DRAWS = 100


def _boundaries(keys: DataFrame, order_by: Sequence[str], ranges: int) -> list:
    """At most ``ranges - 1`` keys that cut the rows of ``keys`` into parts of about equal size, in order."""
    key = F.struct(*order_by).alias("key")
    rate = ranges * _DRAWS / max(1, keys.count())
    drawn = keys.select(key).where(F.rand(17) < rate).orderBy("key").collect()  # about _DRAWS a range
    cuts = [drawn[len(drawn) * k // ranges]["key"] for k in range(1, ranges)] if drawn else []
    return [cut for k, cut in enumerate(cuts) if k == 0 or cut != cuts[k - 1]]


def _range_of(df: DataFrame, order_by: Sequence[str], cuts: list) -> DataFrame:
    """``df`` with ``_range``: how many of the keys ``cuts`` are not above the key of the row, by bisection."""
    fields = ", ".join(f"`{f.name}`: {f.dataType.simpleString()}" for f in df.select(*order_by).schema.fields)
    one_row = df.sparkSession.createDataFrame([(cuts,)], f"_cuts array<struct<{fields}>>")
    steps = [1 << k for k in reversed(range(len(cuts).bit_length()))]

    def onward(found, step):
        reached = (found + step <= len(cuts)) & (F.get("_cuts", found + step - 1) <= F.struct(*order_by))
        return F.when(reached, found + step).otherwise(found)

    place = F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), onward) if cuts else F.lit(0)
    return df.crossJoin(F.broadcast(one_row)).withColumn("_range", place).drop("_cuts")


def number_rows(
    df: DataFrame, order_by: Sequence[str], name: str, ties: Sequence[str] | None = None, keys: DataFrame | None = None
) -> DataFrame:
    """Add ``name`` = 1..n in the order of ``order_by``, ties broken by ``ties`` (default: every other column).

    The result equals ``row_number()`` over an unpartitioned window with that full ordering (NULLs first). Leave
    long texts out of ``ties``: Spark finds the ranges from a sample of the ordering columns on the driver.

    Rows are range-partitioned on the full ordering, so one hot leading key spreads over many tasks; the
    originating partition number comes last and lets even exact copies be split. Each row's place within its
    range is stored in a materialised table, so the per-range counts and the final ids come from the same
    ranges however often a task is retried. The offsets table has one row per range partition (at most
    ``spark.sql.shuffle.partitions``), which is why it may be broadcast.

    To find its ranges Spark works out ``df`` once more. Where that is dear, ``keys`` may have the ``order_by`` columns of about
    the same rows from an earlier point, before a join say: the ranges then come from a sample of these, whatever they are, and
    only their sizes depend on how alike the keys are. Rows of one key stay in one range then.
    """
    if ties is None:
        ties = [c for c in df.columns if c not in order_by]
    ordering = [F.col(c).asc_nulls_first() for c in [*order_by, *ties]]
    if keys is None:
        origin = F.col("_origin").asc()
        dealt = df.withColumn("_origin", F.spark_partition_id()).repartitionByRange(*ordering, origin)
        dealt = dealt.sortWithinPartitions(*ordering, origin).drop("_origin")
    else:
        cuts = _boundaries(keys, order_by, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
        dealt = _range_of(df, order_by, cuts).repartitionById(len(cuts) + 1, "_range").sortWithinPartitions(*ordering).drop("_range")
    placed = (
        dealt.withColumn("_place", F.monotonically_increasing_id())
        .withColumn("_range", F.shiftright("_place", _POSITION_BITS).cast("int"))
        .withColumn("_place", F.col("_place").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1)))
    )
    placed = materialize(placed, "numbered")
    preceding = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_range")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("_range", F.coalesce(F.sum("_rows").over(preceding), F.lit(0)).alias("_offset"))
    )
    return placed.join(F.broadcast(offsets), "_range").select(
        (F.col("_offset") + F.col("_place") + 1).alias(name), *df.columns
    )


def running_total(df: DataFrame, key: str, amount: str, name: str) -> DataFrame:
    """``key`` and ``name``: the sum of ``amount`` over all rows with a smaller ``key``, which must be unique.

    Rows are dealt into ranges of the key, which are written with the rows, so sums inside ranges and the offsets of the ranges
    fit together however often a task is retried. ``df`` should be a written table, as Spark draws a sample of its keys first.
    """
    ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.select(key, amount).repartitionByRange(ranges, key).withColumn("_range", F.spark_partition_id())
    placed = materialize(dealt, "ranges")
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_range")
        .agg(F.sum(amount).alias("_sum"))
        .select("_range", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_offset"))
    )
    before = F.sum(amount).over(Window.partitionBy("_range").orderBy(key).rowsBetween(Window.unboundedPreceding, -1))
    summed = placed.repartitionById(ranges, "_range").select("_range", key, F.coalesce(before, F.lit(0)).alias("_before"))
    return summed.join(F.broadcast(offsets), "_range").select(key, (F.col("_offset") + F.col("_before")).alias(name))
