"""Best-fit packing into sequences of several permitted lengths.

The number of documents of each length, at most one entry per token of the largest capacity, says all that packing
needs. So the plan is made on that histogram, for whole runs of equal documents and equal bins at once, and the rows are
then dealt into the plan by their place among the rows of their length.

The plan is best fit over decreasing lengths: documents go to the open bin with the least room they fit in; filling a bin with
as many of one length as it holds is what best fit does, as a bin just used has the least room. When none fits, bins are
opened in the size with the least cost per token, judged with all permitted sizes and with the shorter documents still to come, as
far as those last. At the end every bin is downsized to the smallest permitted length that holds its contents.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scratch import materialize

CAPACITIES = (1024, 2048, 4096, 8192)
SPACES = r"[\x20\x09-\x0D]+"


@dataclass
class Plan:
    """Runs: documents ``item`` … of ``length``, ``per_bin`` to a bin from ``bin`` on, at ``offset``. Bins by their first."""

    runs: list[tuple[int, int, int, int, int]] = field(default_factory=list)  # length, item, bin, offset, per_bin
    bins: list[tuple[int, int, int, int]] = field(default_factory=list)  # bin, count, used, capacity


class _Packer:
    def __init__(self, histogram: dict[int, int], capacities: tuple[int, ...], overhead: int):
        self.sizes = tuple(sorted(capacities))
        self.overhead = overhead
        self.plan = Plan()
        self.rooms: list[int] = []  # sorted rooms that open groups have
        self.open: dict[int, list[tuple[int, int, int]]] = {}  # room: groups of equal bins (first, count, used)
        self.next_bin = 0
        self.lengths = sorted(histogram)
        self.tokens = np.concatenate([[0], np.cumsum([n * histogram[n] for n in self.lengths], dtype=object)])
        self.promised = 0
        self.histogram = histogram

    def add_group(self, first: int, count: int, used: int, room: int) -> None:
        if room not in self.open:
            insort(self.rooms, room)
            self.open[room] = []
        self.open[room].append((first, count, used))

    def downsized(self, used: int) -> int:
        return self.sizes[bisect_left(self.sizes, used)]

    def place(self, length: int, item: int, count: int) -> int:
        """Put documents into open bins, the least room first. Returns how many found a place."""
        done = 0
        while done < count:
            at = bisect_left(self.rooms, length)
            if at == len(self.rooms):
                break
            room = self.rooms[at]
            first, bins, used = self.open[room].pop()
            if not self.open[room]:
                del self.open[room], self.rooms[at]
            left = count - done
            per_bin = min(room // length, left)
            served = min(bins, left // per_bin)
            self.plan.runs.append((length, item + done, first, used, per_bin))
            self.add_group(first, served, used + per_bin * length, room - per_bin * length)
            if served < bins:
                self.add_group(first + served, bins - served, used, room)
            done += served * per_bin
        return done

    def choose(self, length: int, supply: int) -> tuple[int, int, float]:
        """Capacity with the least cost per token, and the room in it left to shorter documents."""
        best = None
        for size in self.sizes:
            if size < length:
                continue
            own = size // length * length
            shorter = bisect_left(self.lengths, min(length, size - own + 1))
            filled = min(size - own, supply) if shorter else 0
            cost = (self.downsized(own + filled) + self.overhead) / (own + filled)
            if best is None or cost < best[2] - 1e-12:
                best = (size, filled, cost)
        return best

    def open_bins(self, length: int, count: int) -> None:
        shorter = self.tokens[bisect_left(self.lengths, length)]
        supply = max(0, int(shorter) - self.promised)
        size, filled, _ = self.choose(length, supply)
        bins = -(-count // (size // length))
        if filled and bins * filled > supply:  # the rest of the bins gets no company: judge them without
            bins = max(1, supply // filled)
        self.promised += bins * filled
        self.add_group(self.next_bin, bins, 0, size)
        self.next_bin += bins

    def run(self) -> Plan:
        for length in reversed(self.lengths):
            done, count = 0, self.histogram[length]
            while done < count:
                done += self.place(length, done, count - done)
                if done < count:
                    self.open_bins(length, count - done)
        for groups in self.open.values():
            self.plan.bins += [(first, count, used, self.downsized(used)) for first, count, used in groups if used]
        self.plan.bins.sort()
        self.plan.runs.sort()
        return self.plan


def make_plan(histogram: dict[int, int], capacities: tuple[int, ...] = CAPACITIES, overhead: int = 32) -> Plan:
    """Pack ``histogram[n]`` documents of n tokens, n up to the largest capacity. ``overhead`` is the cost of a bin itself."""
    return _Packer({n: c for n, c in histogram.items() if c}, capacities, overhead).run()


def word_tokens(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``n_tokens``: the words of the text and one end token."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    words = F.size(F.array_remove(F.split(text, SPACES), ""))
    return docs.select(F.col("doc_id").cast("long"), (words + 1).cast("long").alias("n_tokens"))


def _dealer(plan: Plan):
    runs = np.array(plan.runs, dtype=np.int64).reshape(-1, 5)
    bins = np.array(plan.bins, dtype=np.int64).reshape(-1, 4)
    keys = (runs[:, 0] << 40) + runs[:, 1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, item = (batch.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in (3, 4))
            found = runs[np.searchsorted(keys, (length << 40) + item, "right") - 1]
            nth = item - found[:, 1]
            bin_id = found[:, 2] + nth // found[:, 4]
            offset = found[:, 3] + nth % found[:, 4] * length
            own = bins[np.searchsorted(bins[:, 0], bin_id, "right") - 1]
            columns = [*batch.columns[:4], *map(pa.array, (bin_id, offset, own[:, 3], own[:, 2]))]
            yield pa.RecordBatch.from_arrays(columns, NAMES)

    return run


NAMES = ["doc_id", "piece", "first_token", "length", "bin_id", "offset", "capacity", "used"]


def pack(
    lengths: DataFrame, capacities: tuple[int, ...] = CAPACITIES, overhead: int = 32, group_rows: int | None = None
) -> DataFrame:
    """Places of documents in bins: ``doc_id``, ``piece``, ``first_token``, ``length``, ``bin_id``, ``offset``, ``capacity``,
    ``used``; one row per piece.

    ``lengths`` has ``doc_id`` and ``n_tokens``. Documents above the largest capacity are cut into pieces of that size and a
    rest; others are one piece. ``bin_id`` counts from 0 without gaps; ``capacity`` is the downsized length of the bin
    and ``used`` the tokens in it. A null, zero or negative length has nothing to pack and gives no row. Rows with a
    null id and repeated rows are packed each. An empty table gives an empty result; other columns are ignored.

    Rows of one length are counted off in groups of about ``group_rows``, so a length that most documents have is
    counted off by many tasks.
    """
    largest = max(capacities)
    tokens = F.col("n_tokens").cast("long")
    cut = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((tokens - 1) / largest)))
    pieces = lengths.where(tokens > 0).select(F.col("doc_id").cast("long"), tokens.alias("n"), cut.alias("piece"))
    start = F.col("piece") * largest
    pieces = materialize(
        pieces.select(
            "doc_id",
            "piece",
            start.alias("first_token"),
            F.least(F.lit(largest), F.col("n") - start).alias("length"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "pieces",
    )
    histogram = {r[0]: r[1] for r in pieces.groupBy("length").count().collect()}
    plan = make_plan(histogram, tuple(capacities), overhead)
    if not plan.runs:
        plan.runs, plan.bins = [(1, 0, 0, 0, 1)], [(0, 1, 1, min(capacities))]  # for no row at all

    total = sum(histogram.values())
    rows = group_rows or max(256, min(1_000_000, total // 4096))
    spark = lengths.sparkSession
    groups = spark.createDataFrame([(n, -(-c // rows)) for n, c in histogram.items()], "length long, groups long")
    grouped = pieces.join(F.broadcast(groups), "length").withColumn("part", F.pmod(F.xxhash64("row"), F.col("groups")))
    counted = grouped.groupBy("length", "part").count()
    before = F.sum("count").over(Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    starts = counted.select("length", "part", F.coalesce(before, F.lit(0)).alias("before"))
    nth = F.row_number().over(Window.partitionBy("length", "part").orderBy("row")) - 1
    numbered = grouped.withColumn("nth", nth).join(starts, ["length", "part"])
    items = numbered.select("doc_id", "piece", "first_token", "length", (F.col("nth") + F.col("before")).alias("item"))
    kinds = ", ".join(f"{name} long" for name in NAMES)
    return items.mapInArrow(_dealer(plan), kinds)
