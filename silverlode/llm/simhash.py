"""Near-duplicate groups by SimHash with a Gray-order hierarchical index.

Every text becomes a 64-bit fingerprint: a bit is set when it is set in more than half of the XXH64 hashes (seed 42)
of its word shingles. Two fingerprints link when they differ in at most ``radius`` bits; a group is a connected
component of links.

The index over the distinct fingerprints is a tree of masked bit patterns. Its top level has ``radius + 1`` families
of nodes, one for each block of bits: a fingerprint hangs below the node of its value in each block. Two
fingerprints within the radius agree in at least one block whole, so each link lies below a common top node, and top
nodes can be searched in separate tasks. A node with more members than a task should hold is factored once more by the
blocks of its remaining bits, for the same reason without loss. Below a top node the members are sorted by Gray rank, so
that neighbours share most bits; runs of them form leaves, runs of leaves form upper nodes, and every node keeps the
pattern of the bits all its members share. A pair of nodes is dropped, with all it holds, once the differences of
their shared bits exceed the radius. What a dense node still exceeds is dealt as pairs of chunks. Each task hands
on a spanning forest of the links it found, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scratch import materialize

SEED = 42
BITS = 64
LEAF = 16
FAN_OUT = 16
LEAF_PAIRS = 512  # compared at once, LEAF * LEAF fingerprints each


def fingerprint(text: str | None, words_per_shingle: int = 4) -> int:
    """The unsigned 64-bit fingerprint of a text; zero when it has no word."""
    words = text.encode().lower().split() if text else []
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= words_per_shingle:
        return xxhash.xxh64_intdigest(joined, SEED)
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[: len(words) - words_per_shingle + 1].tolist()
    hashes = np.array(
        [xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in zip(starts, ends[words_per_shingle - 1 :].tolist())],
        dtype=">u8",
    )
    ones = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(hashes), 8192):  # bounds the unpacked bits of a very long text
        part = hashes[at : at + 8192].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > len(hashes)).tobytes(), "big")


def with_fingerprints(docs: DataFrame, words_per_shingle: int = 4) -> DataFrame:
    """``doc_id`` and the fingerprint as a signed long, one row per row of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = [fingerprint(text.as_py(), words_per_shingle) for text in batch.column(1)]
            signed = np.array(marks, dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(signed)], ["doc_id", "mark"])

    chosen = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return chosen.mapInArrow(run, "doc_id long, mark long")


def hex_mark(mark: Column) -> Column:
    return F.lower(F.lpad(F.hex(mark), 16, "0"))


# --- the search below one top node, in plain arrays ---


def gray_rank(marks: np.ndarray) -> np.ndarray:
    """Place of each bit pattern in the reflected Gray sequence."""
    rank = marks.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


def _levels(marks: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Shared-bit masks and patterns of the nodes, leaves first. ``marks`` is sorted by Gray rank."""
    starts = np.arange(0, len(marks), LEAF)
    ones, zeros = np.bitwise_and.reduceat(marks, starts), np.bitwise_and.reduceat(~marks, starts)
    levels = [(ones | zeros, ones)]
    while len(ones) > 1:
        starts = np.arange(0, len(ones), FAN_OUT)
        ones, zeros = np.bitwise_and.reduceat(ones, starts), np.bitwise_and.reduceat(zeros, starts)
        levels.append((ones | zeros, ones))
    return levels


def _children(nodes: np.ndarray, fan_out: int, count: int) -> tuple[np.ndarray, np.ndarray]:
    """For each node the places of its children, and which of those exist."""
    places = nodes[:, None] * fan_out + np.arange(fan_out)
    return places, places < count


def close_pairs(marks: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places (i, j), i < j, of fingerprints within the radius; ``marks`` is distinct and sorted by Gray rank."""
    if len(marks) <= 4 * LEAF:
        left, right = np.triu_indices(len(marks), 1)
        near = np.bitwise_count(marks[left] ^ marks[right]) <= radius
        yield left[near], right[near]
        return
    levels = _levels(marks)
    left = right = np.zeros(1, dtype=np.int64)
    for depth in range(len(levels) - 2, -1, -1):
        masks, patterns = levels[depth]
        a, has_a = _children(left, FAN_OUT, len(masks))
        b, has_b = _children(right, FAN_OUT, len(masks))
        exists = has_a[:, :, None] & has_b[:, None, :] & (a[:, :, None] <= b[:, None, :])
        node, i, j = np.nonzero(exists)
        left, right = a[node, i], b[node, j]
        differences = np.bitwise_count((patterns[left] ^ patterns[right]) & masks[left] & masks[right])
        left, right = left[differences <= radius], right[differences <= radius]
    for at in range(0, len(left), LEAF_PAIRS):
        a, has_a = _children(left[at : at + LEAF_PAIRS], LEAF, len(marks))
        b, has_b = _children(right[at : at + LEAF_PAIRS], LEAF, len(marks))
        exists = has_a[:, :, None] & has_b[:, None, :] & (a[:, :, None] < b[:, None, :])
        node, i, j = np.nonzero(exists)
        x, y = a[node, i], b[node, j]
        near = np.bitwise_count(marks[x] ^ marks[y]) <= radius
        yield x[near], y[near]


def forest(marks: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (member, root) that join exactly the fingerprints connected within ``marks``."""
    marks = np.unique(marks)
    marks = marks[np.argsort(gray_rank(marks), kind="stable")]
    root = np.arange(len(marks))
    for left, right in close_pairs(marks, radius):
        while True:
            a, b = root[left], root[right]
            apart = a != b
            if not apart.any():
                break
            left, right, a, b = left[apart], right[apart], a[apart], b[apart]
            np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
            while (root[root] != root).any():
                root = root[root]
    members = np.nonzero(root != np.arange(len(marks)))[0]
    return marks[members], marks[root[members]]


def _search(radius: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by node; a node may go over from one batch to the next."""
        held: list[np.ndarray] = []
        node = None
        found: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def close() -> None:
            nonlocal size
            marks = np.concatenate(held) if len(held) > 1 else held[0]
            if len(marks) > 1:
                links = forest(marks.view(np.uint64), radius)
                found.append(links)
                size += len(links[0])

        def flush() -> pa.RecordBatch:
            arrays = [pa.array(np.concatenate(side).view(np.int64)) for side in zip(*found)]
            return pa.RecordBatch.from_arrays(arrays, ["a", "b"])

        for batch in batches:
            keys, marks = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
            if not len(keys):
                continue
            cuts = np.flatnonzero(keys[1:] != keys[:-1]) + 1
            for first, last in zip([0, *cuts.tolist()], [*cuts.tolist(), len(keys)]):
                if keys[first] != node:
                    if held:
                        close()
                    node, held = keys[first], []
                held.append(marks[first:last].copy())
            if size > 50_000:
                yield flush()
                found, size = [], 0
        if held:
            close()
        if size:
            yield flush()

    return run


def _blocks(width: int, count: int) -> list[tuple[int, int]]:
    """Offset and width of ``count`` blocks that cover ``width`` bits."""
    edges = [width * k // count for k in range(count + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def _field(mark: Column, offset: int, width: int) -> Column:
    return F.shiftrightunsigned(mark, offset).bitwiseAND(F.lit((1 << width) - 1))


def links(marks: DataFrame, radius: int = 4, node_rows: int = 1024) -> DataFrame:
    """Spanning links (a, b) of the fingerprints in column ``mark`` (distinct) that differ in at most ``radius`` bits.

    ``node_rows`` bounds the members a task holds at once: fuller nodes are factored by their remaining bits, and what
    is still fuller is dealt as pairs of chunks, each pair meeting in one task.
    """
    blocks = _blocks(BITS, radius + 1)
    mark = F.col("mark")
    top = marks.select(
        mark,
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(k).alias("block"), _field(mark, *block).alias("value"))
                    for k, block in enumerate(blocks)
                ]
            )
        ).alias("t"),
    ).select("mark", F.xxhash64("t.block", "t.value").alias("node"), "t.block")
    first, fuller = _by_size(top, node_rows)

    # the block's bits go to the top by rotation; the rest is cut into blocks of its own
    def sub_nodes(k: int) -> Column:
        offset, width = blocks[k]
        turn = BITS - offset - width
        turned = F.shiftleft(mark, turn).bitwiseOR(F.shiftrightunsigned(mark, BITS - turn)) if turn else mark
        rest = _blocks(BITS - width, radius + 1)
        return F.array(*[F.xxhash64("node", F.lit(i), _field(turned, *block)) for i, block in enumerate(rest)])

    choice = sub_nodes(0)
    for k in range(1, len(blocks)):
        choice = F.when(F.col("block") == k, sub_nodes(k)).otherwise(choice)
    second, dense = _by_size(fuller.select("mark", "block", F.explode(choice).alias("node")), node_rows)

    chunks = F.ceil(F.col("members") * 2 / node_rows).cast("int")
    own = F.pmod(F.xxhash64("mark"), chunks).cast("int")
    other = F.explode(F.sequence(F.lit(0), chunks - 1))
    pairs = dense.select("mark", "node", own.alias("own"), other.alias("other")).select(
        "mark", F.xxhash64("node", F.least("own", "other"), F.greatest("own", "other")).alias("node")
    )
    members = first.select("node", "mark").unionByName(second.select("node", "mark")).unionByName(pairs)
    dealt = members.repartition("node").sortWithinPartitions("node")
    return dealt.mapInArrow(_search(radius), "a long, b long").distinct()


def _by_size(members: DataFrame, node_rows: int) -> tuple[DataFrame, DataFrame]:
    """The members of nodes a task can hold, and those of fuller nodes with the count of their node."""
    full = members.groupBy("node").agg(F.count(F.lit(1)).alias("members")).where(F.col("members") > node_rows)
    return members.join(full, "node", "left_anti"), members.join(full, "node")


# --- groups ---


def components(marks: DataFrame, edges: DataFrame) -> DataFrame:
    """Smallest ``own`` reachable from each vertex: columns ``mark``, ``smallest``.

    ``marks``: columns ``mark`` (distinct), ``own``; ``edges``: columns ``a``, ``b``. Labels travel along links and then
    jump to the label of the label, so that their number of rounds grows with the logarithm of a chain, not its
    length. Each round is written out; a lost executor costs no more than its part of one round.
    """
    there, back = F.struct(F.col("a"), F.col("b")), F.struct(F.col("b").alias("a"), F.col("a").alias("b"))
    both = materialize(edges.select(F.explode(F.array(there, back)).alias("link")).select("link.*").distinct(), "links")
    linked = both.select(F.col("a").alias("mark")).distinct()
    start = marks.join(linked, "mark", "left_semi")
    labels = materialize(
        start.select("mark", F.struct(F.col("own"), F.col("mark").alias("at")).alias("label")), "labels"
    )
    while True:
        sent = (
            both.join(labels, both["a"] == labels["mark"])
            .groupBy("b")
            .agg(F.min("label").alias("sent"))
            .withColumnRenamed("b", "mark")
        )
        near = materialize(
            labels.join(sent, "mark", "left").select(
                "mark", F.least("label", F.coalesce("sent", "label")).alias("label"), F.col("label").alias("old")
            ),
            "labels",
        )
        far = near.select(F.col("mark").alias("at"), F.col("label").alias("next"))
        labels = materialize(
            near.withColumn("at", F.col("label.at"))
            .join(far, "at")
            .select("mark", F.least("label", "next").alias("label"), "old"),
            "labels",
        )
        if labels.where(F.col("label") != F.col("old")).isEmpty():
            break
        labels = labels.select("mark", "label")
    reached = labels.select("mark", F.col("label.own").alias("smallest"))
    return marks.join(reached, "mark", "left").select("mark", F.coalesce("smallest", "own").alias("smallest"))


def near_duplicates(
    docs: DataFrame, radius: int = 4, words_per_shingle: int = 4, node_rows: int = 1024
) -> DataFrame:
    """``doc_id``, ``fingerprint`` (hex) and ``component_id`` of every row of ``docs`` (columns ``doc_id``, ``text``).

    A null text counts as empty; all texts without a word have fingerprint zero and are linked like any other. Repeated
    rows are kept, each with the same answer. Rows with a null id take part in links but name no group: the component
    is the smallest id that is not null, null only where no member has an id. Other columns are ignored. An empty
    table gives an empty result.
    """
    last = 2**63 - 1  # stands for "no id" while labels are compared
    marked = materialize(with_fingerprints(docs, words_per_shingle), "fingerprints")
    marks = materialize(
        marked.groupBy("mark").agg(F.coalesce(F.min("doc_id"), F.lit(last)).alias("own")), "marks"
    )
    groups = components(marks, links(marks.select("mark"), radius, node_rows))
    smallest = F.nullif(F.col("smallest"), F.lit(last))
    return marked.join(groups, "mark").select(
        "doc_id", hex_mark(F.col("mark")).alias("fingerprint"), smallest.alias("component_id")
    )
