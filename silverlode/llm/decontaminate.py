"""Benchmark passages in documents: SimHash over item-sized windows, a multi-index over Hamming blocks, exact check.

Everything here is DataFrame and SQL functions. A text is its words, lower-cased runs of letters and digits, and its
shingles are five words each, hashed to 64 bits. A window is as many shingles of a document as an item has. A window can be
similar only if enough of its shingles are also ones of items of that size; windows are laid at every start where
that many are, so none is lost. To find these shingles, a fixed-size bit table of all item shingles is tested inside each
document row; what passes is joined with the item shingles themselves.

Each window and each item has a SimHash fingerprint: a bit is set when more than half of the shingles set it. Two
fingerprints that differ in at most ``radius`` bits agree in at least one of ``radius + 1`` blocks whole, so an equi-join on
(size, block, value) finds all of them. The pairs within the radius are then verified: weighted Jaccard similarity of the
shingles, each weighted by how often it occurs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scratch import materialize

WORDS = 5
BETWEEN_WORDS = r"[^\p{L}\p{N}]+"
SLOT_BITS = 19
PROBES = 3

FINGERPRINT = """aggregate(sequence(0, 63), 0L, (mark, b) -> mark | if(
    2 * aggregate(part, 0L, (ones, h) -> ones + (shiftrightunsigned(h, b) & 1L)) > size(part), shiftleft(1L, b), 0L))"""


def shingle_hashes(text: Column, table: DataFrame, *kept: str | Column) -> DataFrame:
    """``kept`` columns of ``table`` and ``hashes``: the hash of each run of five words. Shorter texts have none."""
    words = F.array_remove(F.split(F.lower(F.coalesce(text.cast("string"), F.lit(""))), BETWEEN_WORDS), "")
    worded = table.select(*kept, words.alias("words"))
    starts = F.sequence(F.lit(0), F.size("words") - WORDS)
    hashed = F.transform(starts, lambda i: F.xxhash64(*[F.get("words", i + k) for k in range(WORDS)]))
    none = F.array().cast("array<bigint>")
    names = worded.columns[:-1]
    return worded.select(*names, F.when(F.size("words") >= WORDS, hashed).otherwise(none).alias("hashes"))


def _slot(hashed: Column, probe: int) -> Column:
    return F.shiftrightunsigned(hashed, SLOT_BITS * probe).bitwiseAND(F.lit((1 << SLOT_BITS) - 1)).cast("int")


def _slot_table(hashes: DataFrame) -> bytes:
    """One byte per slot, set where a hash falls: always ``2**SLOT_BITS`` bytes, however many hashes there are."""
    slots = hashes.select(F.explode(F.array(*[_slot(F.col("h"), p) for p in range(PROBES)])).alias("slot")).distinct()
    table = bytearray(1 << SLOT_BITS)
    for (slot,) in slots.collect():
        table[slot] = 1
    return bytes(table)


def _maybe(hashed: Column, table: Column) -> Column:
    # the table is named once, else it would be a column of every row
    slots = F.array(*[_slot(hashed, p) for p in range(PROBES)])
    return F.forall(slots, lambda slot: F.substring(table, slot + 1, F.lit(1)) == F.lit(b"\x01"))


def _blocks(mark: Column, radius: int) -> Column:
    """Array of (block, value): the fingerprint in ``radius + 1`` blocks."""
    edges = [64 * k // (radius + 1) for k in range(radius + 2)]
    return F.array(
        *[
            F.struct(
                F.lit(k).alias("block"),
                F.shiftrightunsigned(mark, a).bitwiseAND(F.lit((1 << (b - a)) - 1)).alias("value"),
            )
            for k, (a, b) in enumerate(zip(edges, edges[1:]))
        ]
    )


def find_leaks(
    docs: DataFrame, items: DataFrame, similarity: float = 0.8, radius: int = 24, key: str = "doc_id"
) -> DataFrame:
    """Documents that hold a benchmark item: one row per document row and item.

    ``docs`` has ``key`` and ``text``, ``items`` has ``item_id`` and ``text``. Columns: ``key``, ``item_id``, ``start``
    (word at which the most similar window begins), ``n_words``, ``differing_bits``, ``similarity``; the earliest of
    equally similar windows. A document shorter than an item is one window whole. Items of fewer than five words and null
    texts match nothing. Repeated rows, and rows with a null key, are answered each; repeated items too. Empty
    tables give an empty result; other columns are ignored.

    At a similarity of 0.8 fingerprints differ in about 10 bits. A radius of 16 left out up to one in a hundred of the pairs
    just similar enough; of 40,000 simulated pairs a case none was beyond 24.
    """
    wanted = shingle_hashes(F.col("text"), items, "item_id").where(F.size("hashes") > 0)
    wanted = materialize(
        wanted.select(
            F.monotonically_increasing_id().alias("item"), "item_id", F.size("hashes").alias("n"), F.col("hashes").alias("part")
        ).withColumn("item_mark", F.expr(FINGERPRINT)),
        "items",
    )
    item_shingles = wanted.select("n", F.explode("part").alias("h")).distinct()

    # a subquery, not a literal: plans would carry its megabyte as text, and Spark's driver keeps the texts of its plans
    table = docs.sparkSession.createDataFrame([(_slot_table(item_shingles.select("h")),)], "slots binary")
    hashed = shingle_hashes(F.col("text"), docs, F.col(key).alias("key"))
    # with the number of the task the hashes stay a projection of their own, and the optimiser moves the table from the rows to its one use
    hashed = hashed.withColumn("dealt", F.spark_partition_id()).withColumn("slots", table.scalar())
    last = F.size("hashes") - 1
    at = F.filter(F.sequence(F.lit(0), last), lambda i: _maybe(F.get("hashes", i), F.col("slots")))
    none = F.array().cast("array<int>")
    # the running number keeps the condition below from being moved down and computed twice
    marked = hashed.select(
        F.monotonically_increasing_id().alias("row"), "dealt", "key", "hashes", F.when(last >= 0, at).otherwise(none).alias("at")
    ).where(F.size("at") > 0)
    marked = materialize(marked, "hits")

    seeds = marked.select(
        "row",
        F.size("hashes").alias("have"),
        F.explode(F.transform("at", lambda i: F.struct(i.alias("pos"), F.get("hashes", i).alias("h")))).alias("seed"),
    )
    # similarity s of sizes a and b takes s / (1 + s) * (a + b) common shingles
    width = F.least("have", "n")
    need = F.ceil(F.lit(similarity / (1 + similarity)) * (width + F.col("n")) - 1e-9).cast("int")
    found = (
        seeds.join(item_shingles, F.col("seed.h") == item_shingles["h"])
        .groupBy("row", "have", "n")
        .agg(F.sort_array(F.collect_list("seed.pos")).alias("found"))
        .withColumn("need", F.greatest(F.lit(1), need))
        .where(F.size("found") >= F.col("need"))
    )

    def starts(i: Column) -> Column:
        """Starts of the windows that hold the i-th of the found shingles and ``need`` of them from there on."""
        low = F.greatest(F.lit(0), F.get("found", i + F.col("need") - 1) - F.col("n") + 1)
        high = F.least(F.get("found", i), F.col("have") - width)
        return F.when(low <= high, F.sequence(low, high)).otherwise(F.array().cast("array<int>"))

    runs = F.transform(F.sequence(F.lit(0), F.size("found") - F.col("need")), starts)
    windows = found.select("row", "n", F.explode(F.array_distinct(F.flatten(runs))).alias("start"))
    windows = windows.join(marked.select("row", "key", "hashes"), "row").select(
        "row", "key", "start", "n", F.slice("hashes", F.col("start") + 1, F.col("n")).alias("part")
    )
    windows = materialize(windows.withColumn("mark", F.expr(FINGERPRINT)), "windows")

    left = windows.select("row", "start", "n", "mark", F.explode(_blocks(F.col("mark"), radius)).alias("b"))
    right = wanted.select("item", "n", "item_mark", F.explode(_blocks(F.col("item_mark"), radius)).alias("b"))
    differing = F.bit_count(F.col("mark").bitwiseXOR(F.col("item_mark"))).alias("differing_bits")
    near = (
        left.select("row", "start", "n", "mark", "b.block", "b.value")
        .join(right.select("item", "n", "item_mark", "b.block", "b.value"), ["n", "block", "value"])
        .select("row", "start", "n", "item", differing)
        .where(F.col("differing_bits") <= radius)
        .distinct()
    )

    window_weights = (
        windows.select("row", "start", "n", F.size("part").alias("have"), F.explode("part").alias("h"))
        .groupBy("row", "start", "n", "have", "h")
        .agg(F.count(F.lit(1)).alias("weight"))
    )
    item_weights = (
        wanted.select("item", "item_id", F.col("n").alias("want"), F.explode("part").alias("h"))
        .groupBy("item", "item_id", "want", "h")
        .agg(F.count(F.lit(1)).alias("item_weight"))
    )
    common = (
        near.join(window_weights, ["row", "start", "n"])
        .join(item_weights, ["item", "h"])
        .groupBy("row", "start", "n", "item", "item_id", "differing_bits", "have", "want")
        .agg(F.sum(F.least("weight", "item_weight")).alias("common"))
    )
    share = F.col("common") / (F.col("have") + F.col("want") - F.col("common"))
    best = (
        common.withColumn("similarity", share)
        .where(F.col("similarity") >= similarity)
        .groupBy("row", "item", "item_id")
        .agg(F.max(F.struct("similarity", (-F.col("start")).alias("back"), "have", "differing_bits")).alias("b"))
    )
    return best.join(marked.select("row", "key"), "row").select(
        F.col("key").alias(key),
        "item_id",
        (-F.col("b.back")).alias("start"),
        (F.col("b.have") + WORDS - 1).alias("n_words"),
        "b.differing_bits",
        "b.similarity",
    )
