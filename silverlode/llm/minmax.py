"""Near-duplicates by min-max hashing: banded signatures propose, full sets of shingles confirm.

A signature keeps two values a permutation, the smallest and the largest of the permuted shingle hashes. Each is equal for two
sets with their Jaccard similarity as probability, so half the permutations give the values that smallest ones alone would
need, and a similarity read from both varies less. Bands of ``BAND`` values are blocks; a band never takes both values of one
permutation. With 26 bands of 5 values a pair of similarity 0.85 misses all bands once in four million times.

A permutation is the exclusive or of the 64-bit hash with one number times another, odd one, both drawn from a fixed seed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scratch import materialize
from . import linking

SEED = 42
BAND = 5
BANDS = 26
SLICE = 4096
REMEMBERED = 100_000
MIX = np.uint64(0x9E3779B97F4A7C15)  # odd multiplier


def shingles(text: bytes, words_per_shingle: int = 5) -> np.ndarray:
    """Sorted distinct XXH64 hashes of the word shingles. A shorter text is one shingle whole, one without words none."""
    words = text.lower().split()
    joined = b" ".join(words)
    if len(words) <= words_per_shingle:
        found = [xxhash.xxh64_intdigest(joined, SEED)] if words else []
        return np.array(found, dtype=np.uint64)
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[: len(words) - words_per_shingle + 1].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = [digest(joined[a:b], SEED) for a, b in zip(starts, ends[words_per_shingle - 1 :].tolist())]
    return np.unique(np.array(hashes, dtype=np.uint64))


def permutations(count: int) -> tuple[np.ndarray, np.ndarray]:
    drawn = np.random.default_rng(SEED).integers(0, 2**63, size=(2, count, 1), dtype=np.uint64)
    return drawn[0], drawn[1] * np.uint64(2) + np.uint64(1)


def signature(hashes: np.ndarray, turns: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """The smallest values of all permutations, then the largest."""
    low, high = [], []
    for at in range(0, len(hashes), SLICE):  # bounds the permuted hashes of a very long text
        permuted = (hashes[at : at + SLICE] ^ turns) * factors
        low.append(permuted.min(axis=1))
        high.append(permuted.max(axis=1))
    return np.concatenate([np.minimum.reduce(low), np.maximum.reduce(high)])


def band_keys(values: np.ndarray, band: int) -> np.ndarray:
    """One signed 64-bit key a band; equal bands in different places have different keys."""
    rows = values.reshape(-1, band)
    keys = np.arange(1, len(rows) + 1, dtype=np.uint64) * MIX
    for k in range(band):
        keys = (keys ^ rows[:, k]) * MIX
        keys ^= keys >> np.uint64(32)
    return keys.view(np.int64)


def with_hashes(docs: DataFrame) -> DataFrame:
    """``doc_id``, the text as bytes and its hash, by which it is found again."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long"), text.cast("binary").alias("text"), F.xxhash64(text).alias("text_hash"))


def signatures(texts: DataFrame, words_per_shingle: int, band: int, bands: int) -> DataFrame:
    """``doc_id``, ``text_hash``, ``n`` (size of the set), ``same`` (equal for equal sets), ``bands``.

    A task leaves out the bands of a set it has met before.
    """
    turns, factors = permutations(-(-band * bands // 2))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: set[bytes] = set()
        for batch in batches:
            sizes, same, keys = [], [], []
            for text in batch.column(1):
                hashes = shingles(text.as_py(), words_per_shingle)
                sizes.append(len(hashes))
                same.append(xxhash.xxh3_128_digest(hashes.tobytes()))
                if len(hashes) and same[-1] not in met:
                    if len(met) >= REMEMBERED:
                        met.clear()
                    met.add(same[-1])
                    keys.append(band_keys(signature(hashes, turns, factors)[: band * bands], band))
                else:
                    keys.append(None)
            columns = [batch.column(0), batch.column(2), pa.array(sizes, pa.int64()), pa.array(same, pa.binary()), pa.array(keys, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_hash", "n", "same", "bands"])

    return texts.mapInArrow(run, "doc_id long, text_hash long, n long, same binary, bands array<long>")


def _sets(texts: DataFrame, classes: DataFrame, words_per_shingle: int) -> DataFrame:
    """``id``, ``hashes``: the sets of classes (``id``, ``same``, ``text_hash``), made again from one text of each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: set[bytes] = set()
        for batch in batches:
            for text in batch.column(0):
                text = text.as_py()
                digest = xxhash.xxh3_128_digest(text)
                if digest in met:
                    continue
                if len(met) >= REMEMBERED:
                    met.clear()
                met.add(digest)
                hashes = shingles(text, words_per_shingle)
                same = xxhash.xxh3_128_digest(hashes.tobytes())
                columns = [pa.array([same], pa.binary()), pa.array([np.sort(hashes.view(np.int64))], pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(columns, ["same", "hashes"])

    found = texts.join(classes.select("text_hash"), "text_hash", "left_semi").select("text")
    made = found.mapInArrow(run, "same binary, hashes array<long>").dropDuplicates(["same"])
    return classes.select("id", "same").join(made, "same").select("id", "hashes")


def classes_of(signed: DataFrame) -> DataFrame:
    """One row per different set: ``id``, ``same``, ``own`` (smallest doc_id, null last), ``weight``, ``text_hash``, ``bands``."""
    classes = signed.groupBy("same").agg(
        F.min(F.coalesce("doc_id", F.lit(2**63 - 1))).alias("own"),
        F.max("n").alias("weight"),
        F.min("text_hash").alias("text_hash"),
        F.first("bands", ignorenulls=True).alias("bands"),
    )
    return classes.withColumn("id", F.monotonically_increasing_id())


def components_of(
    texts: DataFrame, classes: DataFrame, similarity: tuple[int, int], words_per_shingle: int, first: DataFrame | None = None
) -> DataFrame:
    """``id``, ``same``, ``own`` and the ``smallest`` own that links of similar sets lead to, for every class (a written table).

    ``first`` has (block, id), one row an id at most: the blocks to look at first; by default the fullest band of each.
    """
    banded = classes.select("id", F.explode("bands").alias("block"))
    shared = banded.groupBy("block").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    blocks = materialize(banded.join(shared, "block"), "blocks")
    if first is None:
        first = blocks.groupBy("id").agg(F.max(F.struct("members", "block")).alias("b")).select("b.block", "id")
    met = blocks.select("id").union(first.select("id")).distinct()
    hashes = materialize(_sets(texts, classes.join(met, "id", "left_semi"), words_per_shingle), "shingle-sets")
    joined = linking.groups(classes.select("id", "weight"), first, blocks.select("block", "id"), hashes, similarity)
    labelled = materialize(classes.select("id", "same", "own").join(joined, "id"), "labelled-classes")
    smallest = labelled.groupBy("label").agg(F.min("own").alias("smallest"))
    return labelled.join(smallest, "label").select("id", "same", "own", "smallest")


def near_duplicates(
    docs: DataFrame, similarity: tuple[int, int] = (85, 100), words_per_shingle: int = 5, band: int = BAND, bands: int = BANDS
) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id``, ``kept`` of every row of ``docs`` (columns ``doc_id``, ``text``).

    Documents link where their sets of shingles have at least the Jaccard similarity, confirmed on the full sets; the
    component is the smallest id that links lead to and ``kept`` marks the document of that id. A null text counts as empty. A text
    without words links with nothing, its copies included. Repeated rows are kept with the same answer. Rows with a null id
    take part in links but name no component, which is null only where no member has an id; the kept rows of such a component
    are its members without one. Other columns are ignored. An empty table gives an empty result.
    """
    last = 2**63 - 1  # stands for "no id" while labels are compared
    texts = with_hashes(docs)
    signed = materialize(signatures(texts, words_per_shingle, band, bands), "signatures")
    classes = materialize(classes_of(signed.where("n > 0")), "classes")
    smallest = components_of(texts, classes, similarity, words_per_shingle).select("same", "smallest")
    answered = signed.select("doc_id", "n", "same").join(smallest, "same", "left")
    component = F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.nullif(F.col("smallest"), F.lit(last)))
    return answered.select(
        "doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept")
    )
