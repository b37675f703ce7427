"""Exact links between sets that meet in blocks, as spanning stars instead of all pairs.

A block is a key under which similar sets meet: a band of a signature, a common shingle, a group of fingerprints. Every two
sets of a block that are not joined yet are compared by all their hashes, inside the task that holds the block; pairs
are never rows. Starting from the largest joined group of a block, the sets outside it that are similar to one of its
members join it and are looked at in turn; what stays outside is similar to none of them. So a block of a
thousand near copies costs about one comparison a member, and no link between different groups is missed.

Two rounds keep sets from being sent around with every block they are in. The first looks at one block of each set and joins
most of what belongs together. The second takes all blocks that still hold members of different groups, one of each choice of
members. A block too large for a task is dealt: in the first round as chunks that share one anchor, in the second so that each
member outside the largest group of the block meets every other one in some task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scratch import materialize
from .simhash import components

TASK_HASHES = 1_000_000
MATCHES = 500_000  # looked at together; a task holds about a hundred bytes for each

def is_similar(common: np.ndarray, total: np.ndarray, similarity: tuple[int, int]) -> np.ndarray:
    """Whether Jaccard similarity is at least the fraction, in whole numbers. ``total``: both sizes added."""
    numerator, denominator = similarity
    return denominator * common >= numerator * (total - common)


def _index(sets: list[np.ndarray], members: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All hashes of some sets in order, and the set of each."""
    hashes = np.concatenate([sets[m] for m in members])
    owners = np.repeat(members, [len(sets[m]) for m in members])
    order = np.argsort(hashes, kind="stable")
    return hashes[order], owners[order]


def _common(
    sets: list[np.ndarray], inside: np.ndarray, outside: np.ndarray, index: tuple[np.ndarray, np.ndarray]
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Places (x, y) of sets inside and outside that share hashes, and how many they share; a part at a time."""
    hashes, owners = index
    wanted = np.zeros(len(sets), dtype=bool)
    wanted[outside] = True
    start = 0
    while start < len(inside):
        # as many sets as have few enough matches together, one at least
        stop, matches, asked, found = start, 0, 0, []
        while stop < len(inside):
            first, last = (np.searchsorted(hashes, sets[inside[stop]], side) for side in ("left", "right"))
            count = int((last - first).sum())
            if found and (matches + count > MATCHES or asked + len(first) > MATCHES):
                break
            asked += len(first)
            matches += count
            found.append((first, last - first))
            stop += 1
        lengths = np.concatenate([n for _, n in found])
        firsts = np.concatenate([first for first, _ in found])
        asking = np.repeat(np.repeat(inside[start:stop], [len(n) for _, n in found]), lengths)
        within = np.arange(matches) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        answering = owners[np.repeat(firsts, lengths) + within]
        met = wanted[answering]
        pairs, shared = np.unique(asking[met] * len(sets) + answering[met], return_counts=True)
        yield pairs // len(sets), pairs % len(sets), shared
        start = stop


def spanning_links(labels: np.ndarray, sets: list[np.ndarray], similarity: tuple[int, int]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places (x, y) of similar sets that join all groups (equal ``labels``) which any similar pair joins."""
    sizes = np.array([len(s) for s in sets])
    _, group = np.unique(labels, return_inverse=True)
    members = np.argsort(group, kind="stable")
    counts = np.bincount(group)
    starts = np.cumsum(counts) - counts
    left = np.arange(len(sets))
    index, indexed = _index(sets, left), len(left)
    done = np.zeros(len(counts), dtype=bool)
    for largest in np.argsort(-counts, kind="stable"):
        if done[largest]:
            continue
        done[largest] = True
        inside = members[starts[largest] : starts[largest] + counts[largest]]
        outside = left[~done[group[left]]]
        while len(inside) and len(outside):
            if 2 * len(outside) < indexed:
                index, indexed = _index(sets, outside), len(outside)
            for x, y, shared in _common(sets, inside, outside, index):
                near = is_similar(shared, sizes[x] + sizes[y], similarity)
                x, y = x[near], y[near]
                fresh = ~done[group[y]]
                x, y = x[fresh], y[fresh]
                _, first = np.unique(group[y], return_index=True)  # one link joins a group whole
                yield x[first], y[first]
                done[group[y]] = True
            moved = done[group[outside]]
            inside, outside = outside[moved], outside[~moved]
        left = outside
        if not len(left):
            return


def stars(count: int, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (member, smallest member) that join what the links (x, y) among ``count`` places join."""
    root = np.arange(count)
    while len(x):
        a, b = root[x], root[y]
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while (root[root] != root).any():
            root = root[root]
        apart = root[x] != root[y]
        x, y = x[apart], y[apart]
    members = np.flatnonzero(root != np.arange(count))
    return members, root[members]


def _search(similarity: tuple[int, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by task; the rows of a task may go over from one batch to the next."""
        task, held = None, []

        def links() -> Iterator[pa.RecordBatch]:
            ids = np.concatenate([batch.column(1).to_numpy() for batch in held])
            labels = np.concatenate([batch.column(2).to_numpy() for batch in held])
            if len(ids) < 2 or (labels == labels[0]).all():
                return
            ids, places = np.unique(ids, return_index=True)
            sets = [part.values.to_numpy() for batch in held for part in batch.column(3)]
            found = list(spanning_links(labels[places], [sets[place] for place in places], similarity))
            if any(len(x) for x, _ in found):
                members, roots = stars(len(ids), *(np.concatenate(side) for side in zip(*found)))
                yield pa.RecordBatch.from_arrays([pa.array(ids[members]), pa.array(ids[roots])], ["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch.column(0).to_numpy()
            cuts = (np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist()
            for first, last in zip([0, *cuts], [*cuts, len(keys)]):
                if keys[first] != task:
                    if held:
                        yield from links()
                    task, held = keys[first], []
                held.append(batch.slice(first, last - first))
        if held:
            yield from links()

    return run


def _searched(dealt: DataFrame, hashes: DataFrame, similarity: tuple[int, int]) -> DataFrame:
    """Links (a, b) that join what similar sets of the tasks of ``dealt`` (task, id, label) join."""
    members = dealt.join(hashes, "id").select("task", "id", "label", "hashes")
    return materialize(members.repartition("task").sortWithinPartitions("task").mapInArrow(_search(similarity), "a long, b long"), "found")


def _dealt_whole(blocks: DataFrame, weights: DataFrame) -> DataFrame:
    """``task``, ``id``, ``label`` of a first look at blocks (block, id): chunks, with the smallest id of a block in each."""
    weighed = blocks.join(weights, "id")
    size = weighed.groupBy("block").agg(
        F.sum("weight").alias("size"), F.min("id").alias("anchor"), F.count(F.lit(1)).alias("members")
    )
    chunks = F.greatest(F.ceil(F.col("size") / TASK_HASHES), F.lit(1)).cast("int")
    size = size.where("members > 1").select("block", "anchor", chunks.alias("chunks"))
    own = F.array(F.pmod(F.xxhash64("id", F.lit(7)), F.col("chunks")).cast("int"))
    places = F.when(F.col("id") == F.col("anchor"), F.sequence(F.lit(0), F.col("chunks") - 1)).otherwise(own)
    dealt = blocks.join(size, "block").select("block", "id", F.explode(places).alias("chunk"))
    return dealt.select(F.xxhash64("block", "chunk").alias("task"), "id", F.col("id").alias("label"))


def _dealt_apart(blocks: DataFrame, labels: DataFrame, weights: DataFrame) -> DataFrame:
    """``task``, ``id``, ``label`` of the blocks (block, id) whose members are in different groups.

    Blocks of equal members are one. The members of the largest group of a block are main, the others rest; chunks of rest
    meet chunks of main and each other, so that no pair of a block in different groups is left out.
    """
    labelled = materialize(blocks.join(labels, "id").join(weights, "id"), "labelled")
    mark = F.xxhash64("id", F.lit(11))
    parts = labelled.groupBy("block", "label").agg(
        F.sum("weight").alias("weight"), F.count(F.lit(1)).alias("n"), F.sum(F.shiftright(mark, 16)).alias("sum"), F.bit_xor(mark).alias("xor")
    )
    # whole numbers that equal sets of members share and different ones do not, as good as surely
    whole = parts.groupBy("block").agg(
        F.count(F.lit(1)).alias("groups"),
        F.sum("n").alias("n"),
        F.sum("sum").alias("sum"),
        F.bit_xor("xor").alias("xor"),
        F.sum("weight").alias("weight"),
        F.max(F.struct("weight", "label")).alias("main"),
    )
    mixed = whole.where("groups > 1").groupBy("n", "sum", "xor").agg(
        F.min("block").alias("block"), F.first("weight").alias("weight"), F.first("main").alias("main")
    )
    half = TASK_HASHES / 2
    small = F.col("weight") <= TASK_HASHES
    mixed = mixed.select(
        "block",
        F.col("main.label").alias("main_label"),
        F.when(small, 1).otherwise(F.ceil(F.col("main.weight") / half)).cast("int").alias("mains"),
        F.when(small, 1).otherwise(F.ceil((F.col("weight") - F.col("main.weight")) / half)).cast("int").alias("rests"),
    )
    is_main = F.col("label") == F.col("main_label")
    own = F.pmod(F.xxhash64("id", F.lit(13)), F.when(is_main, F.col("mains")).otherwise(F.col("rests"))).cast("int")
    member = labelled.join(mixed, "block").select("block", "id", "label", "mains", "rests", is_main.alias("is_main"), own.alias("own"))

    def with_main(rest, main):
        return F.xxhash64("block", F.lit(0), rest, main)

    def with_rest(one, other):
        return F.xxhash64("block", F.lit(1), F.least(one, other), F.greatest(one, other))

    one = F.col("own")
    all_rests, all_mains = F.sequence(F.lit(0), F.col("rests") - 1), F.sequence(F.lit(0), F.col("mains") - 1)
    of_main = F.transform(all_rests, lambda rest: with_main(rest, one))
    of_rest = F.concat(
        F.transform(all_mains, lambda main: with_main(one, main)),
        # a chunk of rest meets itself where it meets the main group
        F.transform(F.filter(all_rests, lambda rest: rest != one), lambda rest: with_rest(one, rest)),
    )
    tasks = F.when(F.col("is_main"), of_main).otherwise(of_rest)
    return member.select(F.explode(tasks).alias("task"), "id", "label")


def groups(ids: DataFrame, first: DataFrame, blocks: DataFrame, hashes: DataFrame, similarity: tuple[int, int]) -> DataFrame:
    """``id``, ``label``: the smallest id that links lead to, for every row of ``ids`` (``id``, distinct, and ``weight``).

    ``first`` has (block, id) with at most one block an id, ``blocks`` (block, id) with any number. ``hashes`` (id,
    hashes) has the sorted distinct hashes of all ids in blocks, as many as ``weight`` says. Sets link where their Jaccard similarity is at least the fraction
    ``similarity``, compared exactly; all links of pairs that share a block are found. An id without a block is alone.
    """
    weights = ids.select("id", "weight")
    marks = ids.select(F.col("id").alias("mark"), F.col("id").alias("own"))
    near = _searched(_dealt_whole(first, weights), hashes, similarity)
    labels = materialize(components(marks, near).select(F.col("mark").alias("id"), F.col("smallest").alias("label")), "near-labels")
    far = _searched(_dealt_apart(blocks, labels, weights), hashes, similarity)
    # what the first round joined is a star now, which takes fewer rounds than its links
    joined = components(marks, far.unionByName(labels.where("id <> label").select(F.col("id").alias("a"), F.col("label").alias("b"))))
    return joined.select(F.col("mark").alias("id"), F.col("smallest").alias("label"))
