"""Records of CSV files whose quoted fields may hold line breaks, read in many tasks.

Whether a line break ends a record depends on the quotes of all the file before it. A line by itself only tells what
becomes of each of two states, outside or inside a quoted field; so does a whole split of a file, as states compose. One
pass finds these for every split, the driver follows them along each file (one row per split), and a second pass, now
knowing the state each split begins in, joins lines to records. A record that goes over the end of a split is put
together from the pieces of the few splits concerned.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A field: quoted with doubled quotes inside, or bare, or empty. After the closing quote no other quote may follow.
_FIELD = r'(?:"(?:[^"]|"")*"(?:[^",][^,]*)?|[^",][^,]*|)'
# Lines after which the state is outside a quoted field, by the state before them.
_ENDS_OUTSIDE = f"^{_FIELD}(?:,{_FIELD})*$"
_ENDS_INSIDE = f'^(?:[^"]|"")*"(?:[^",][^,]*)?(?:,{_FIELD})*$'

_SPLIT_SCHEMA = "file long, block long, from_outside boolean, from_inside boolean, closes boolean"
_RECORD_SCHEMA = "file long, origin long, block long, whole boolean, first boolean, record string"


class UnclosedQuote(ValueError):
    """A file ends inside a quoted field."""


def _steps(lines: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Whether a field is open after each line, if none was before it and if one was."""
    quoted = pc.match_substring(lines, '"')
    places = np.flatnonzero(quoted.to_numpy(zero_copy_only=False))
    from_outside, from_inside = np.zeros(len(lines), dtype=bool), np.ones(len(lines), dtype=bool)
    if len(places):
        some = lines.filter(quoted)
        from_outside[places] = ~pc.match_substring_regex(some, _ENDS_OUTSIDE).to_numpy(zero_copy_only=False)
        from_inside[places] = ~pc.match_substring_regex(some, _ENDS_INSIDE).to_numpy(zero_copy_only=False)
    return from_outside, from_inside


def _open_after(from_outside: np.ndarray, from_inside: np.ndarray, entry: bool) -> np.ndarray:
    """Whether a field is open after each line, beginning with ``entry``."""
    fixed = from_outside == from_inside
    flips = np.cumsum(from_outside & ~from_inside)
    last = np.maximum.accumulate(np.where(fixed, np.arange(len(fixed)), -1))
    start = np.where(last >= 0, from_outside[last], entry)
    flipped = (flips - np.where(last >= 0, flips[last], 0)) % 2 == 1
    return start ^ flipped


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple[int, int], pa.Array]]:
    """Split and lines of each run of lines of one split."""
    files, blocks = batch.column(1).to_numpy(), batch.column(2).to_numpy()
    cuts = np.flatnonzero((files[1:] != files[:-1]) | (blocks[1:] != blocks[:-1])) + 1
    for first, last in zip([0, *cuts.tolist()], [*cuts.tolist(), len(files)]):
        if last > first:
            yield (int(files[first]), int(blocks[first])), batch.column(0).slice(first, last - first)


def _survey(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per split: the states it leads to, and whether a field open at its start is closed in it."""
    names = ["file", "block", "from_outside", "from_inside", "closes"]
    current, outside, inside, closes = None, False, True, False
    for batch in batches:
        for split, lines in _runs(batch):
            if split != current:
                if current is not None:
                    yield pa.RecordBatch.from_pylist([dict(zip(names, (*current, outside, inside, closes)))])
                current, outside, inside, closes = split, False, True, False
            steps = _steps(lines)
            after_inside = _open_after(*steps, inside)
            closes = closes or not after_inside.all()
            outside, inside = bool(_open_after(*steps, outside)[-1]), bool(after_inside[-1])
    if current is not None:
        yield pa.RecordBatch.from_pylist([dict(zip(names, (*current, outside, inside, closes)))])


def _without_cr(records: pa.Array) -> pa.Array:
    """The records without a carriage return at their end."""
    ended = pc.ends_with(records, "\r")
    return pc.if_else(ended, pc.utf8_slice_codeunits(records, 0, -1), records) if pc.any(ended).as_py() else records


def _joined(lines: pa.Array, ends: np.ndarray) -> pa.Array:
    """The lines up to each end, joined."""
    offsets = pa.array(np.concatenate([[0], ends + 1]).astype(np.int32))
    return pc.binary_join(pa.ListArray.from_arrays(offsets, lines), "\n")


def _assembler(states, wanted_whole: bool):
    """Whole records, or else the pieces of records that go over the end of a split."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entries = states.value
        current, entry, origin, open_field, ended = None, False, 0, False, False
        held: list[str] = []

        def rows(records: pa.Array, whole: bool, first: np.ndarray) -> pa.RecordBatch:
            n = len(records)
            columns = [pa.array([value] * n, pa.int64()) for value in (current[0], origin, current[1])]
            return pa.RecordBatch.from_arrays(
                [*columns, pa.array([whole] * n, pa.bool_()), pa.array(first), records], ["file", "origin", "block", "whole", "first", "record"]
            )

        def close() -> Iterator[pa.RecordBatch]:
            """What is left of a split is the beginning or the middle of a record."""
            if held and not wanted_whole:
                yield rows(pa.array(["\n".join(held)]), False, np.array([current[1] == 0 and not ended]))

        for batch in batches:
            for split, lines in _runs(batch):
                if split != current:
                    if current is not None:
                        yield from close()
                    if split not in entries:
                        raise RuntimeError("the files or the size of their splits have changed since they were surveyed")
                    current, held, ended = split, [], False
                    entry, origin = entries[split]
                    open_field = entry
                after = _open_after(*_steps(lines), open_field)
                open_field = bool(after[-1])
                ends = np.flatnonzero(~after)
                if not len(ends):
                    held.extend(lines.to_pylist())
                    continue
                records = _joined(lines.slice(0, int(ends[-1]) + 1), ends)
                if held:
                    begun = "\n".join([*held, records[0].as_py()])
                    records = pa.concat_arrays([pa.array([begun], records.type), records.slice(1)])
                first = np.zeros(len(records), dtype=bool)
                first[0] = current[1] == 0 and not ended
                if entry and not ended:  # the end of a record that began in a split before
                    if not wanted_whole:
                        yield rows(records.slice(0, 1), False, first[:1])
                    records, first = records.slice(1), first[1:]
                ended, origin = True, current[1]
                if wanted_whole and len(records):
                    yield rows(_without_cr(records), True, first)
                held = lines.slice(int(ends[-1]) + 1).to_pylist()
        if current is not None:
            yield from close()

    return run


def _entries(found: list[tuple]) -> tuple[dict[tuple[int, int], tuple[bool, int]], set[tuple[int, int]], dict[int, int]]:
    """State at the start and origin of the record there for every split; the splits that hold pieces; for every file that
    ends in an open field, the origin of its last record."""
    entries, pieces, unclosed = {}, set(), {}
    before, is_open, origin = None, False, 0
    for file, block, from_outside, from_inside, closes in sorted(found):
        if before is None or before[0] != file:
            is_open = False
        entries[file, block] = (is_open, origin if is_open else block)
        if is_open:
            pieces |= {before, (file, block)}
        origin = origin if is_open and not closes else block
        is_open = from_inside if is_open else from_outside
        before = (file, block)
        unclosed.pop(file, None)
        if is_open:
            unclosed[file] = origin
    return entries, pieces, unclosed


def read_records(spark: SparkSession, path: str, on_unclosed: str = "fail") -> DataFrame:
    """``record`` and ``first`` (the record begins its file) of all records of the files, without empty ones.

    Records end at a line break outside quotes, CR LF or LF. A quoted field still open at the end of a file raises
    ``UnclosedQuote``; with ``on_unclosed="cut"`` the record in which it opens is cut at the end of its split. This runs a job
    over the files; the records must be read with splits of the same size.
    """
    lines = spark.read.option("lineSep", "\n").text(path)
    lines = lines.select(
        "value", F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")
    )
    found = [tuple(row) for row in lines.mapInArrow(_survey, _SPLIT_SCHEMA).collect()]  # one row per split
    entries, pieces, unclosed = _entries(found)
    if unclosed and on_unclosed == "fail":
        raise UnclosedQuote(f"{len(unclosed)} of the files of {path} end inside a quoted field")
    states = spark.sparkContext.broadcast(entries)
    records = lines.mapInArrow(_assembler(states, True), _RECORD_SCHEMA).select("record", "first")
    pieces = {split for split in pieces | set(unclosed.items()) if split[1] <= unclosed.get(split[0], split[1])}
    if pieces:
        concerned = spark.createDataFrame(sorted(pieces), "file long, block long")
        parts = lines.join(F.broadcast(concerned), ["file", "block"], "left_semi").select("value", "file", "block")
        parts = parts.mapInArrow(_assembler(states, False), _RECORD_SCHEMA)
        in_order = F.array_sort(F.collect_list(F.struct("block", "record")))  # the splits one record goes over
        text = F.regexp_replace(F.array_join(F.transform(in_order, lambda part: part["record"]), "\n"), "\r$", "")
        stitched = parts.groupBy("file", "origin").agg(text.alias("record"), F.max("first").alias("first"))
        records = records.unionByName(stitched.select("record", "first"))
    record = F.when(F.col("first"), F.regexp_replace("record", "^\uFEFF", "")).otherwise(F.col("record"))
    return records.select(record.alias("record"), "first").where("record <> ''")
