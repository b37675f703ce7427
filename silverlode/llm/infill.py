"""Fill-in-the-middle texts: a text is cut into units, and a middle run of them is moved to the end behind markers.

A batch of texts is worked on as Arrow arrays, never text by text: the texts are split into lists of units, the lists are
flattened with the index of their text, the place of each unit in its text is computed, units are filtered by the role
their place gives them, the lists of each role are built again and joined, and the pieces are joined with the markers.

Units are lines with their line break; what follows the last line break is a unit as well unless it is empty. Four numbers
from the SHA-256 of seed and id decide on form and cuts, so a row gets the same output wherever and however often it is
worked on. ``restore`` gives the text back from output and form alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# What stands before prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SLICE_BYTES = 8 << 20


def numbers(doc_id: Column, seed: int) -> list[Column]:
    """The first four groups of eight hex digits of the SHA-256 of ``seed:id``. A null id counts as the empty text."""
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    digest = F.sha2(named, 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long").alias(f"h{k + 1}") for k in range(4)]


def _slices(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about ``SLICE_BYTES`` of text each, one row at least."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    parts = np.cumsum(sizes) // SLICE_BYTES
    edges = [0, *(np.flatnonzero(parts[1:] != parts[:-1]) + 1).tolist(), len(parts)]
    for first, last in zip(edges, edges[1:]):
        if last > first:
            yield batch.slice(first, last - first)


def _units(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """All units of the texts, the index of the text of each, and its place there."""
    pieces = pc.split_pattern(texts, "\n")
    flat, parents = pc.list_flatten(pieces), pc.list_parent_indices(pieces).to_numpy().astype(np.int64)
    lengths = pc.list_value_length(pieces).to_numpy().astype(np.int64)
    places = np.arange(len(flat)) - (np.cumsum(lengths) - lengths)[parents]
    ends = places == lengths[parents] - 1
    units = pc.binary_join_element_wise(flat, pc.if_else(pa.array(ends), "", "\n"), "")
    filled = pc.binary_length(units).to_numpy() > 0
    return units.filter(pa.array(filled)), parents[filled], places[filled]


def _chosen(units: pa.Array, parents: np.ndarray, chosen: np.ndarray, rows: int) -> pa.Array:
    """The chosen units of each text joined."""
    offsets = np.concatenate([[0], np.cumsum(np.bincount(parents[chosen], minlength=rows))]).astype(np.int32)
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets), units.filter(pa.array(chosen))), "")


def _rearranged(texts: pa.Array, h: list[np.ndarray], rate: int, spm_share: int) -> list[pa.Array]:
    """n, form, code points of prefix and of middle, output of each text."""
    rows = len(texts)
    units, parents, places = _units(texts)
    n = np.bincount(parents, minlength=rows).astype(np.int64)
    cuts = h[0] % (n + 1), h[1] % (n + 1)
    low, high = np.minimum(*cuts), np.maximum(*cuts)
    roles = (places >= low[parents]).astype(np.int8) + (places >= high[parents])
    prefix, middle, suffix = (_chosen(units, parents, roles == role, rows) for role in range(3))

    marked = [pc.match_substring(texts, mark).to_numpy(zero_copy_only=False) for mark in (PREFIX, SUFFIX, MIDDLE)]
    plain = (n == 0) | np.logical_or.reduce(marked) | (h[2] % 100 >= rate)
    spm = pa.array(h[3] % 100 < spm_share)
    moved = pc.if_else(
        spm,
        pc.binary_join_element_wise(SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle, ""),
        pc.binary_join_element_wise(PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle, ""),
    )
    whole = pa.array(plain)
    counts = [pc.if_else(whole, None, pc.cast(pc.utf8_length(piece), pa.int64())) for piece in (prefix, middle)]
    return [
        pa.array(n),
        pc.if_else(whole, "plain", pc.if_else(spm, "spm", "psm")),
        *counts,
        pc.if_else(whole, texts, moved),
    ]


def transform(docs: DataFrame, seed: int = 7, rate: int = 100, spm_share: int = 50) -> DataFrame:
    """``doc_id``, ``n`` (units), ``form`` (``plain``, ``psm`` or ``spm``), ``prefix_chars``, ``middle_chars``, ``output``.

    ``rate`` percent of the texts are rearranged, ``spm_share`` percent of those with the suffix first. Empty texts and
    texts that hold a marker stay as they are. A null text counts as empty, a null id as the empty text in the hash; rows with
    equal id and text get equal output, none is dropped. Other columns are ignored. An empty table gives an empty
    result. Only ``SLICE_BYTES`` of text, or one longer text, is worked on at once.
    """
    schema = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"
    names = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _slices(batch, 1):
                h = [part.column(k).to_numpy() for k in range(2, 6)]
                columns = _rearranged(part.column(1), h, rate, spm_share)
                yield pa.RecordBatch.from_arrays([part.column(0), *columns], names)

    text = F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    chosen = docs.select(F.col("doc_id").cast("long"), text, *numbers(F.col("doc_id").cast("long"), seed))
    return chosen.mapInArrow(run, schema)


def restore(output: Column, form: Column) -> Column:
    """The text an output came from. A rearranged text holds no marker of its own, so the markers part its pieces."""
    pieces = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1)
    return (
        F.when(form == "psm", F.concat(pieces[1], pieces[3], pieces[2]))
        .when(form == "spm", F.concat(pieces[2], pieces[3], pieces[1]))
        .otherwise(output)
    )
