"""Shards of near-equal bytes by sampled splitters.

Records are ordered by the checksum of their text, then by id, so that equal texts stand together. A sample of keys,
drawn with chances in proportion to record size, gives the quantile boundaries of many more ranges than shards. The
bytes of each range are then summed exactly; a range found overfull is subdivided by a denser sample of its own
records, which also cuts a text with very many copies into runs of ids, and of rows where ids repeat. Running sums inside the ranges, moved by
the exact sums before each range, give every record its place on the line of all bytes, and the shard is the part of
the line it lies in. The sample only decides how work is dealt: sums, shards and slots are exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scratch import materialize

OVERHEAD = 16
DRAWS_PER_RANGE = 8
LEAST = -(2**63)

# checksum of the text, id, stored number of the row: no two rows are equal in all three
Key = tuple[int, int, int]


def _in_range(rows: DataFrame, splitters: list[Key]) -> DataFrame:
    """``rows`` with column ``range``: how many splitters are not above the key."""
    edges = np.array(splitters, dtype=np.int64).reshape(-1, 3)
    names = rows.columns
    key_at = [names.index(name) for name in ("text_crc32", "place", "row")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [np.concatenate([edges[:, k], batch.column(at).to_numpy()]) for k, at in enumerate(key_at)]
            is_row = np.arange(len(keys[0])) >= len(edges)
            order = np.lexsort((is_row, *keys[::-1]))  # a splitter comes before a row of its key
            below = np.empty(len(order), dtype=np.int32)
            below[order] = np.cumsum(~is_row[order])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(below[len(edges) :])], [*names, "range"])

    fields = ", ".join(f"{name} {kind}" for name, kind in rows.dtypes)
    return rows.mapInArrow(run, f"{fields}, range int")


def split_ranges(rows: DataFrame, total: int, ranges: int, large: set[int], seed: int = 7) -> tuple[DataFrame, dict]:
    """``rows`` with their range, and bytes per range. About ``DRAWS_PER_RANGE * ranges`` keys reach the driver.

    Only texts whose checksum is in ``large`` have boundaries inside; before all others a boundary goes in front of all copies.
    Overfull ranges are cut again until none is left that a boundary can cut.
    """

    def draw(where: DataFrame, rate, step: int, nth: int) -> set[Key]:
        picked = where.where(F.rand(seed + nth) < rate).select("text_crc32", "place", "row").collect()
        chosen = sorted(tuple(r) for r in picked)[step::step]
        return {key if key[0] in large else (key[0], LEAST, LEAST) for key in chosen}

    chance = F.col("size") * (ranges * DRAWS_PER_RANGE / max(total, 1))
    splitters = draw(rows, chance, DRAWS_PER_RANGE, 0)
    full = max(2 * total // ranges, 1)
    nth = 0
    while True:
        placed = _in_range(rows, sorted(splitters))
        held = placed.groupBy("range").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n"))
        found = held.collect()  # as many rows as ranges
        over = [r["range"] for r in found if r["bytes"] > full and r["n"] > 1]
        nth += 1
        finer = draw(placed.where(F.col("range").isin(over)), chance * 2, DRAWS_PER_RANGE, nth) - splitters if over else set()
        if not finer:
            return placed, {r["range"]: r["bytes"] for r in found}
        splitters |= finer


def assign_shards(docs: DataFrame, shards: int = 40, ranges_per_shard: int = 64, keep_together: float = 0.02) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``size``, ``text_crc32``, ``law`` ("bytes"), ``shard``, ``slot``.

    Size is the UTF-8 bytes of the text plus 16. All copies of a text share a shard as long as they hold at most
    ``keep_together`` of a shard's bytes; more copies than that are dealt out. So a shard's bytes differ from an equal
    part by that share or one record. Slots count from 0 in each shard without gaps. ``grown_shard`` is null under
    this law. A null text has 16 bytes and the checksum of an empty text; null ids come first; repeated rows are
    kept, each with a slot. An empty table gives an empty result; other columns are ignored.
    """
    text = F.col("text").cast("string")
    rows = materialize(
        docs.select(
            F.col("doc_id").cast("long"),
            (F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + OVERHEAD).alias("size"),
            F.crc32(F.coalesce(text, F.lit(""))).alias("text_crc32"),
            F.coalesce(F.col("doc_id").cast("long"), F.lit(LEAST)).alias("place"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "sizes",
    )
    total = rows.agg(F.sum("size")).first()[0] or 0
    most = keep_together * total / shards
    # at most shards / keep_together of them
    copies = rows.groupBy("text_crc32").agg(F.sum("size").alias("bytes")).where(F.col("bytes") > most)
    large = {r[0] for r in copies.select("text_crc32").collect()}
    placed, sizes = split_ranges(rows, total, shards * ranges_per_shard, large)
    spark = docs.sparkSession
    before, starts = 0, []
    for k in sorted(sizes):
        starts.append((k, before))
        before += sizes[k]
    starts = spark.createDataFrame(starts, "range int, before long")

    in_order = Window.partitionBy("range").orderBy("text_crc32", "place", "row")
    copies = Window.partitionBy("range", "text_crc32")
    summed = placed.select(
        "*",
        F.row_number().over(in_order).alias("nth"),
        F.sum("size").over(in_order.rowsBetween(Window.unboundedPreceding, 0)).alias("upto"),
    ).select(
        "*", F.sum("size").over(copies).alias("group_size"), F.max("upto").over(copies).alias("group_upto")
    )
    together = ~F.col("text_crc32").isin(list(large))  # such a group is whole in one range
    # the middle of the record, or of its group, on the line of all bytes; doubled to stay whole
    middle = F.col("before") * 2 + F.when(together, F.col("group_upto") * 2 - F.col("group_size")).otherwise(
        F.col("upto") * 2 - F.col("size")
    )
    shard = F.least(F.floor(middle * F.lit(shards / (2 * max(total, 1)))), F.lit(shards - 1)).cast("int")
    sharded = materialize(
        summed.join(F.broadcast(starts), "range").select(
            "doc_id", "size", "text_crc32", "range", "nth", shard.alias("shard")
        ),
        "sharded",
    )
    # a range meets few shards: one row for each such pair, at most ranges + shards of them
    pieces = sorted(tuple(r) for r in sharded.groupBy("range", "shard").agg(F.count(F.lit(1))).collect())
    filled: dict[int, int] = {}
    offsets, within, current = [], 0, None
    for k, s, n in pieces:
        within = within if k == current else 0
        current = k
        offsets.append((k, s, filled.get(s, 0) - within))
        filled[s] = filled.get(s, 0) + n
        within += n
    offsets = spark.createDataFrame(offsets, "range int, shard int, shift long")
    return sharded.join(F.broadcast(offsets), ["range", "shard"]).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("nth") - 1 + F.col("shift")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
