"""Class-based n-gram scores (Brown et al.): exchange clustering, class transitions, word emissions, smoothed perplexity.

A text is its words, A-Z lower-cased, and one end token; the end token of the text before is the context of the first word.
The probability of a token is that of its class after the class before it, times that of the token in its class.

Every word of the training text has a class of its own choice; only words never seen take that of their ending. Classes
form in three steps. First the exchange algorithm moves a bounded set of items: the most frequent words, and all other
words pooled by the hash of their ending. A round sums, for every item, how often each class comes before and after
it, and moves a third of the items to the class that raises the likelihood of the training text most. Then every other
frequent word (the head, bounded, at hand in every task) leaves its ending's class for the best one, and last every
remaining word does; these stay a table, however many they are. Both steps group what stands next to a word under the
word and choose inside the tasks, from the class pairs of the step before. Head moves that lower the likelihood together are
undone. The driver holds items times classes numbers and the head, nothing that grows.

Scoring reads each text once more. The words outside the head leave the task as (text, word, class before, class after,
times), neighbours that are both outside it as a pair, and meet the table of words in joins, which so have no hot key.
Every class keeps the mass of its words seen once for words never seen, so the probabilities after any context
add up to 1.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scratch import materialize

END = b""  # no word is empty
CLASSES = 64  # class 0 holds the end token alone
ITEM_WORDS = 8192
ENDINGS = 2048
ITEMS = 1 + ITEM_WORDS + ENDINGS
HEAD_WORDS = 200_000
HEAD_BYTES = 64 * HEAD_WORDS
HEAD_LENGTH = 1024
ROUNDS = 9
SHARE = 3
TRANSITION_WEIGHT = 5.0
UNSEEN = 0.5
COUNTED = 400_000
CHOSEN = 500  # words that choose together
BLOCKS = 1024  # counts are dealt over
HELD = 4_000_000  # counts that wait to be summed


def words_of(raw: bytes | None) -> list[bytes]:
    return raw.lower().split() if raw else []


def ending_item(word: bytes) -> int:
    return 1 + ITEM_WORDS + zlib.crc32(word[-3:]) % ENDINGS


class Codes(dict):
    """Word to place in the head; other words to minus their item, kept for a while."""

    def __init__(self, head: list[bytes]):
        super().__init__(zip(head, range(len(head))))
        self.head = len(head)

    def __missing__(self, word: bytes) -> int:
        code = -ending_item(word)
        if len(self) > self.head + COUNTED:
            for other in [w for w, c in self.items() if c < 0]:
                del self[other]
        self[word] = code
        return code


def _texts(batches: Iterator[pa.RecordBatch], column: int):
    for batch in batches:
        for value in batch.column(column):
            yield value.as_py()


# --- counts as a few packed rows instead of a row each ---


def _bytes(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """The values between neighbouring bounds, as bytes."""
    offsets = (bounds * values.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(values))])


def _packed(keys: np.ndarray, times: np.ndarray, block: np.ndarray) -> Iterator[pa.RecordBatch]:
    """``block``, ``keys``, ``times``: all counts of a block in one row. ``keys`` are at most 31 bits."""
    for at in range(0, len(keys), HELD):
        own = block[at : at + HELD]
        order = np.argsort(own, kind="stable")
        own = own[order]
        starts = np.flatnonzero(np.diff(own, prepend=-1))
        bounds = np.append(starts, len(own))
        columns = keys[at : at + HELD].astype(np.int32)[order], times[at : at + HELD].astype(np.int64)[order]
        yield pa.RecordBatch.from_arrays([pa.array(own[starts], pa.int64()), *(_bytes(c, bounds) for c in columns)], ["block", "keys", "times"])


PACKED = "block long, keys binary, times binary"


def _sum(keys: list[np.ndarray], times: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    every, place = np.unique(np.concatenate([np.zeros(0, dtype=np.int32), *keys]), return_inverse=True)
    sums = np.bincount(place, np.concatenate([np.zeros(0, dtype=np.int64), *times]), minlength=len(every))
    return every, sums.astype(np.int64)


def _unpacked(batches: Iterator[pa.RecordBatch]) -> tuple[np.ndarray, np.ndarray]:
    """The keys of all blocks of a task in order, and the sums of their times."""
    keys, times, size = [], [], 0
    for batch in batches:
        for held, column, kind in ((keys, 1, np.int32), (times, 2, np.int64)):
            held.append(np.frombuffer(b"".join(batch.column(column).to_pylist()), kind))
        size += len(keys[-1])
        if size > HELD:
            keys, times = ([part] for part in _sum(keys, times))
            size = 0
    return _sum(keys, times)


def count_words(texts: DataFrame) -> DataFrame:
    """``word``, ``n`` over all rows of ``texts`` (one binary column); the end token counts once per row."""

    def run(batches):
        known: Counter[bytes] = Counter()

        def rows():
            arrays = [pa.array(list(known), pa.binary()), pa.array(list(known.values()), pa.int64())]
            return pa.RecordBatch.from_arrays(arrays, ["word", "n"])

        for raw in _texts(batches, 0):
            known.update(words_of(raw))
            known[END] += 1
            if len(known) > COUNTED:
                yield rows()
                known.clear()
        if known:
            yield rows()

    return texts.mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def head_of(counts: DataFrame, most: int = HEAD_WORDS) -> tuple[list[bytes], np.ndarray]:
    """The words from a count on that at most ``most`` words of bounded bytes reach, by falling count; the end token first."""
    level = F.floor(F.log2("n") * 8).cast("int")
    length = F.octet_length("word")
    short = counts.where((length <= HEAD_LENGTH) & (length > 0))
    sizes = short.groupBy(level.alias("level")).agg(F.count(F.lit(1)).alias("words"), F.sum(length).alias("bytes"))
    least, total, size = None, 0, 0
    for row in sizes.orderBy(F.desc("level")).collect():
        total, size = total + row.words, size + row.bytes
        if total > most or size > HEAD_BYTES:
            break
        least = row.level
    ends = counts.where(F.octet_length("word") == 0).collect()
    rows = [] if least is None else short.where(level >= least).collect()
    rows = sorted(((r.word, r.n) for r in rows), key=lambda r: (-r[1], r[0]))
    words = [END, *(bytes(w) for w, _ in rows)]
    return words, np.array([ends[0].n if ends else 0, *(n for _, n in rows)], dtype=np.int64)


def _sequence(raw: bytes | None, codes: Codes, endings: np.ndarray) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Words, their codes, and their items."""
    words = words_of(raw)
    found = np.fromiter(map(codes.__getitem__, words), dtype=np.int64, count=len(words))
    return words, found, np.where(found < 0, -found, endings[np.maximum(found, 0)])


def head_items(head: list[bytes]) -> np.ndarray:
    """Item of each word of the head: its own while there are such, else that of its ending."""
    return np.array([k if k <= ITEM_WORDS else ending_item(word) for k, word in enumerate(head)], dtype=np.int64)


def count_pairs(texts: DataFrame, head: list[bytes]) -> DataFrame:
    """``a``, ``b``, ``n``: how often item b follows item a, over all rows of ``texts`` (one binary column)."""
    shared = texts.sparkSession.sparkContext.broadcast(head)

    def run(batches):
        codes, endings = Codes(shared.value), head_items(shared.value)
        held, size = [], 0
        known = none = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)

        def rows():
            return _packed(*known, known[0] % BLOCKS)

        def merged():
            sequence = np.concatenate([[0], *held])
            pairs, times = np.unique((sequence[:-1] * ITEMS + sequence[1:]).astype(np.int32), return_counts=True)
            return _sum([known[0], pairs], [known[1], times])

        for raw in _texts(batches, 0):
            held += [_sequence(raw, codes, endings)[2], [0]]
            size += len(held[-2]) + 1
            if size > 2_000_000:
                known, held, size = merged(), [], 0
                if len(known[0]) > 10 * COUNTED:
                    yield from rows()
                    known = none
        if held:
            known = merged()
        yield from rows()

    def unpack(batches):
        pairs, times = _unpacked(batches)
        for at in range(0, len(pairs), 100_000):
            part = pairs[at : at + 100_000].astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in (part // ITEMS, part % ITEMS, times[at : at + 100_000])], ["a", "b", "n"])

    return texts.mapInArrow(run, PACKED).repartition("block").mapInArrow(unpack, "a long, b long, n long")


# --- exchange ---


def start_classes() -> np.ndarray:
    """Items dealt over the classes in turn; the end token alone in class 0."""
    classes = 1 + np.arange(ITEMS) % (CLASSES - 1)
    classes[0] = 0
    return classes


def neighbours(sides: DataFrame, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per item, how often each class follows it and how often each class comes before it."""
    shared = sides.sparkSession.sparkContext.broadcast(classes)

    def run(batches):
        sums = np.zeros(ITEMS * 2 * CLASSES)
        for batch in batches:
            for cells in zip(*(column.to_pylist() for column in batch.columns)):
                row, other, n = (np.frombuffer(c, kind) for c, kind in zip(cells, (np.int32, np.int32, np.int64)))
                np.add.at(sums, row.astype(np.int64) * CLASSES + shared.value[other], n.astype(np.float64))
        vectors = sums.reshape(-1, CLASSES)
        rows = np.flatnonzero(vectors.any(axis=1))
        offsets = pa.array(np.arange(len(rows) + 1, dtype=np.int32) * CLASSES)
        arrays = [pa.array(rows), pa.ListArray.from_arrays(offsets, pa.array(vectors[rows].ravel()))]
        yield pa.RecordBatch.from_arrays(arrays, ["row", "sums"])

    out = np.zeros((ITEMS * 2, CLASSES))
    for batch in sides.mapInArrow(run, "row long, sums array<double>").toArrow().to_batches():
        sums = batch.column(1).values.to_numpy().reshape(-1, CLASSES)
        np.add.at(out, batch.column(0).to_numpy(), sums)
    return out[0::2], out[1::2]


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-300))


def class_pairs(after: np.ndarray, classes: np.ndarray) -> np.ndarray:
    pairs = np.zeros((CLASSES, CLASSES))
    np.add.at(pairs, classes, after)
    return pairs


def likelihood(pairs: np.ndarray) -> float:
    """The part of the log-likelihood of the training text that depends on the classes."""
    return float(_xlogx(pairs).sum() - _xlogx(pairs.sum(axis=1)).sum() - _xlogx(pairs.sum(axis=0)).sum())


def moves(after: np.ndarray, before: np.ndarray, classes: np.ndarray, movable: np.ndarray) -> np.ndarray:
    """Best class of each movable item, one after the other. The class pairs follow each move; what stands next to the
    other items is that of the start of the round."""
    pairs = class_pairs(after, classes)
    best = classes.copy()
    target = np.arange(1, CLASSES)
    for item in movable:
        right, left, own = after[item], before[item], classes[item]
        total = right.sum()
        if not total:
            continue
        rest = pairs.copy()
        rest[own] -= right
        rest[:, own] -= left
        rest = np.maximum(rest, 0)
        r, l = np.flatnonzero(right), np.flatnonzero(left)
        gain = (_xlogx(rest[1:][:, r] + right[r]) - _xlogx(rest[1:][:, r])).sum(axis=1)
        gain += (_xlogx(rest[l][:, 1:] + left[l][:, None]) - _xlogx(rest[l][:, 1:])).sum(axis=0)
        rows, columns = rest.sum(axis=1)[1:], rest.sum(axis=0)[1:]
        gain -= _xlogx(rows + total) - _xlogx(rows) + _xlogx(columns + total) - _xlogx(columns)
        choice = int(np.argmax(gain))
        if gain[choice] > gain[own - 1] + 1e-9:
            best[item] = target[choice]
            rest[best[item]] += right
            rest[:, best[item]] += left
            pairs = rest
    return best


def exchange(pairs: DataFrame, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Classes of the items, and counts of class pairs. A set of moves that lowers the likelihood together is undone."""
    forward = pairs.select((F.col("a") * 2).cast("int").alias("row"), F.col("b").cast("int").alias("other"), "n")
    backward = pairs.select((F.col("b") * 2 + 1).cast("int").alias("row"), F.col("a").cast("int").alias("other"), "n")

    def pack(batches):
        for batch in batches:
            if batch.num_rows:
                bounds = np.array([0, batch.num_rows])
                arrays = [_bytes(c.to_numpy(zero_copy_only=False).astype(k), bounds) for c, k in zip(batch.columns, (np.int32, np.int32, np.int64))]
                yield pa.RecordBatch.from_arrays(arrays, ["row", "other", "n"])

    # a row is all neighbours of an item on one side, at most ITEMS of them; each task hands on sums of its own rows
    sides = forward.union(backward).repartition("row").mapInArrow(pack, "row binary, other binary, n binary")
    sides = materialize(sides, "pair-sides")  # every round reads it
    classes = start_classes()
    after, before = neighbours(sides, classes)
    value = likelihood(class_pairs(after, classes))
    shares = np.array([zlib.crc32(b"%d" % k) % SHARE for k in range(ITEMS)])
    moved = [ITEMS] * SHARE
    for turn in range(rounds):
        movable = np.flatnonzero(shares == turn % SHARE)
        tried = moves(after, before, classes, movable[movable > 0])
        next_after, next_before = neighbours(sides, tried)
        next_value = likelihood(class_pairs(next_after, tried))
        moved[turn % SHARE] = int((tried != classes).sum()) if next_value > value else 0
        if next_value > value:
            classes, after, before, value = tried, next_after, next_before, next_value
        if sum(moved) < ITEMS // 500:
            break
    return classes, class_pairs(after, classes)


# --- classes of all other words ---


def best_classes(right: np.ndarray, left: np.ndarray, own: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    """The best class of each word, all others staying: how often each class follows it, how often each precedes it, its
    class, and the class pairs that hold it there. A word moves only where that raises the likelihood."""
    gain = np.zeros(right.shape)
    for side, other, table in ((right, left, pairs.T), (left, right, pairs)):
        word, near = np.nonzero(side)
        if not len(word):
            continue
        n = side[word, near]
        rest = table[near].astype(np.float64)  # pairs of ``near`` and each class, the word taken out
        rest[np.arange(len(word)), own[word]] -= n
        inside = near == own[word]
        rest[inside] -= other[word[inside]]
        rest = np.maximum(rest, 0)
        first = np.flatnonzero(np.diff(word, prepend=-1))
        gain[word[first]] += np.add.reduceat(_xlogx(rest + n[:, None]) - _xlogx(rest), first, axis=0)
    total = right.sum(axis=1, keepdims=True)
    for sizes in (pairs.sum(axis=0), pairs.sum(axis=1)):
        rest = np.repeat(sizes[None].astype(np.float64), len(own), axis=0)
        rest[np.arange(len(own)), own] -= total[:, 0]
        rest = np.maximum(rest, 0)
        gain -= _xlogx(rest + total) - _xlogx(rest)
    gain[:, 0] = -np.inf
    best = gain.argmax(axis=1)
    places = np.arange(len(own))
    return np.where(gain[places, best] > gain[places, own] + 1e-9, best, own)


def _classes(found: np.ndarray, words: np.ndarray, items: np.ndarray) -> np.ndarray:
    """Class of each code: that of the word of the head, or of the ending."""
    return np.where(found < 0, items[np.maximum(-found, 0)], words[np.maximum(found, 0)])


def _sides(size: int, word: np.ndarray, at: np.ndarray, n: np.ndarray) -> np.ndarray:
    return np.bincount(word * CLASSES + at, n, minlength=size * CLASSES).reshape(size, CLASSES)


def move_head(texts: DataFrame, head: list[bytes], words: np.ndarray, items: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    """Classes of the words of the head after each one that is no item of its own has moved to its best class."""
    if len(head) <= ITEM_WORDS + 1:
        return words
    shared = texts.sparkSession.sparkContext.broadcast((head, words, items, pairs))

    def count(batches):
        head, words, items, _ = shared.value
        codes = Codes(head)
        held, size = [], 0

        def rows():
            found = np.concatenate([[0], *held])
            classes = _classes(found, words, items)
            after, before = np.flatnonzero(found[:-1] > ITEM_WORDS), 1 + np.flatnonzero(found[1:] > ITEM_WORDS)
            keys = np.concatenate([found[after] * 2 * CLASSES + classes[after + 1], (found[before] * 2 + 1) * CLASSES + classes[before - 1]])
            keys, times = np.unique(keys, return_counts=True)
            return _packed(keys, times, keys // (2 * CLASSES) % BLOCKS)

        for raw in _texts(batches, 0):
            words_here = words_of(raw)
            held += [np.fromiter(map(codes.__getitem__, words_here), dtype=np.int64, count=len(words_here)), [0]]
            size += len(words_here) + 1
            if size > 4_000_000:
                yield from rows()
                held, size = [], 0
        if held:
            yield from rows()

    def choose(batches):
        _, words, _, pairs = shared.value
        cells, n = _unpacked(batches)  # at most 2 * CLASSES a word, all of one block
        word, of, at = *np.unique(cells // (2 * CLASSES), return_inverse=True), cells % (2 * CLASSES)
        for start in range(0, len(word), CHOSEN):
            own = word[start : start + CHOSEN]
            part = slice(*np.searchsorted(of, [start, start + len(own)]))
            here, near, times = of[part] - start, at[part], n[part]
            after = near < CLASSES
            right = _sides(len(own), here[after], near[after], times[after])
            left = _sides(len(own), here[~after], near[~after] - CLASSES, times[~after])
            best = best_classes(right, left, words[own], pairs)
            yield pa.RecordBatch.from_arrays([pa.array(own, pa.int64()), pa.array(best)], ["word", "class"])

    out = words.copy()
    dealt = texts.mapInArrow(count, PACKED).repartition("block")
    for batch in dealt.mapInArrow(choose, "word long, class long").toArrow().to_batches():
        out[batch.column(0).to_numpy()] = batch.column(1).to_numpy()
    return out


def count_tail(texts: DataFrame, head: list[bytes], words: np.ndarray, items: np.ndarray) -> DataFrame:
    """What stands next to words outside the head: ``word``, ``other``, ``before``, ``after``, ``n``, summed per task.

    Three kinds of rows: the word with the classes around it; the word and the ``other`` that follows it, both outside
    the head; and, without a word, pairs of classes. A class from ``CLASSES`` on is that of the ending of a word outside the head.
    """
    shared = texts.sparkSession.sparkContext.broadcast((head, words, items))
    names = ["word", "other", "before", "after", "n"]
    kinds = [pa.binary(), pa.binary(), pa.int32(), pa.int32(), pa.int64()]

    def run(batches):
        head, word_classes, items = shared.value
        codes = Codes(head)
        pairs = np.zeros(4 * CLASSES * CLASSES, dtype=np.int64)
        known: Counter[tuple] = Counter()

        def rows():
            columns = [*zip(*known)], list(known.values())
            arrays = [pa.array(c, kind) for c, kind in zip([*columns[0], columns[1]], kinds)]
            return pa.RecordBatch.from_arrays(arrays, names)

        for raw in _texts(batches, 0):
            words = words_of(raw)
            found = np.array([0, *map(codes.__getitem__, words), 0], dtype=np.int64)
            classes = _classes(found, word_classes, items) + CLASSES * (found < 0)
            np.add.at(pairs, classes[:-1] * 2 * CLASSES + classes[1:], 1)
            places = np.flatnonzero(found < 0)
            for at in range(0, len(places), COUNTED):  # bounds what one text adds
                k = places[at : at + COUNTED]
                known.update(zip([words[j] for j in (k - 1).tolist()], repeat(None), classes[k - 1].tolist(), classes[k + 1].tolist()))
                k = k[found[k + 1] < 0].tolist()
                known.update(zip([words[j - 1] for j in k], [words[j] for j in k], repeat(None), repeat(None)))
                if len(known) > COUNTED:
                    yield rows()
                    known.clear()
        if known:
            yield rows()
        at = np.flatnonzero(pairs)
        empty = pa.nulls(len(at), pa.binary())
        before, after = (pa.array(c, pa.int32()) for c in (at // (2 * CLASSES), at % (2 * CLASSES)))
        yield pa.RecordBatch.from_arrays([empty, empty, before, after, pa.array(pairs[at])], names)

    return texts.mapInArrow(run, "word binary, other binary, before int, after int, n long")


def _table(rows: DataFrame, before: str, after: str, size: int) -> np.ndarray:
    out = np.zeros((size, size))
    for a, b, n in rows.groupBy(before, after).agg(F.sum("n")).collect():
        out[a, b] = n
    return out


def move_tail(tail: DataFrame, items: np.ndarray, pairs: np.ndarray) -> tuple[DataFrame, np.ndarray]:
    """``word``, ``n``, ``class`` of every word outside the head, and the class pairs of the whole training text.

    ``tail`` is from ``count_tail``; ``pairs`` are the class pairs while each such word has its ending's class.
    """
    shared = tail.sparkSession.sparkContext.broadcast((items, pairs))

    def choose(batches):
        items, pairs = shared.value
        own_pairs = np.zeros((CLASSES, CLASSES), dtype=np.int64)
        for batch in batches:
            for start in range(0, batch.num_rows, CHOSEN):
                part = batch.slice(start, CHOSEN)
                lists = part.column(1)
                of = np.repeat(np.arange(part.num_rows), lists.value_lengths().to_numpy())
                before, after, n = (c.to_numpy() for c in lists.flatten().flatten())
                own = items[[ending_item(word) for word in part.column(0).to_pylist()]]
                right, left = (_sides(len(own), of, c % CLASSES, n) for c in (after, before))
                best = best_classes(right, left, own, pairs)
                inside = before < CLASSES
                np.add.at(own_pairs, (before[inside], best[of[inside]]), n[inside])
                inside = after < CLASSES
                np.add.at(own_pairs, (best[of[inside]], after[inside]), n[inside])
                total = np.bincount(of, n, minlength=len(own)).astype(np.int64)
                empty = pa.nulls(len(own), pa.int64())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(total), pa.array(best), empty], names)
        a, b = np.nonzero(own_pairs)
        yield pa.RecordBatch.from_arrays([pa.nulls(len(a), pa.binary()), pa.array(own_pairs[a, b]), pa.array(a), pa.array(b)], names)

    names = ["word", "n", "class", "after"]
    around = tail.where("word IS NOT NULL AND other IS NULL").select("word", "before", "after", "n")
    # at most 4 * CLASSES * CLASSES cells a word
    cells = around.repartition("word").groupBy("word", "before", "after").agg(F.sum("n").alias("n"))
    grouped = cells.groupBy("word").agg(F.collect_list(F.struct("before", "after", "n")).alias("cells"))
    chosen = materialize(grouped.mapInArrow(choose, "word binary, n long, class long, after long"), "word-classes")
    table = chosen.where("word IS NOT NULL").select("word", "n", "class")
    both = tail.where("other IS NOT NULL").groupBy("word", "other").agg(F.sum("n").alias("n"))
    first = table.select("word", F.col("class").alias("a"))
    second = table.select(F.col("word").alias("other"), F.col("class").alias("b"))
    met = both.join(first, "word").join(second, "other")
    inner = f"word IS NULL AND before < {CLASSES} AND after < {CLASSES}"
    sums = _table(tail.where(inner), "before", "after", CLASSES)
    return table, sums + _table(chosen.where("word IS NULL"), "class", "after", CLASSES) + _table(met, "a", "b", CLASSES)


# --- the model ---


@dataclass
class Model:
    head: list[bytes]
    counts: np.ndarray  # of the head
    classes: np.ndarray  # of the head
    items: np.ndarray  # classes of the items of the first exchange, for endings
    transitions: np.ndarray  # log10, class before by class
    norms: np.ndarray  # log10 of what emissions of a class are divided by
    unseen: np.ndarray  # log10 of the count that words never seen have in a class
    tokens: int
    types: int

    def divisor(self) -> float:
        return float(max(1, self.tokens + self.types + 1))


def transitions(pairs: np.ndarray) -> np.ndarray:
    """log10 of smoothed class transitions: counts, filled up in proportion to how frequent the class is."""
    sizes = pairs.sum(axis=0)
    shares = (sizes + UNSEEN) / (sizes.sum() + UNSEEN * CLASSES)
    return np.log10((pairs + TRANSITION_WEIGHT * shares) / (pairs.sum(axis=1, keepdims=True) + TRANSITION_WEIGHT))


def train(texts: DataFrame, rounds: int = ROUNDS) -> tuple[Model, DataFrame]:
    """The model and the table of words outside its head (``word``, ``n``, ``class``), from a frame with one column ``text``;
    null texts are empty ones."""
    raw = texts.select(F.col("text").cast("string").cast("binary"))
    counts = materialize(count_words(raw), "word-counts")
    size = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    head, head_counts = head_of(counts)
    item_pairs = materialize(count_pairs(raw, head), "item-pairs")
    items, by_class = exchange(item_pairs, rounds)
    started = items[head_items(head)]
    for classes in (move_head(raw, head, started, items, by_class), started):
        tail = materialize(count_tail(raw, head, classes, items), "tail")
        pairs = _table(tail.where("word IS NULL"), "before", "after", 2 * CLASSES)
        pairs = pairs.reshape(2, CLASSES, 2, CLASSES).sum(axis=(0, 2))
        if likelihood(pairs) >= likelihood(by_class):
            break
    table, pairs = move_tail(tail, items, pairs)
    once = np.bincount(classes[1:], head_counts[1:] == 1, minlength=CLASSES)
    for row in table.where("n = 1").groupBy("class").count().collect():
        once[row[0]] += row[1]
    unseen = once + UNSEEN
    norms = np.log10(pairs.sum(axis=0) + unseen)
    norms[0] = 0.0  # the end token is all of its class
    return Model(head, head_counts, classes, items, transitions(pairs), norms, np.log10(unseen), int(size[0]), int(size[1])), table


def score(docs: DataFrame, model: Model, table: DataFrame, held_out: Column) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score``,
    ``perplexity``.

    ``base_score`` is the add-one unigram log10 probability, ``score`` that of the class model. A null text counts as
    empty: one end token. Null ids and repeated rows are answered like any other; with no training text every token
    is unknown. An empty table gives an empty result; other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    fields = [
        *(("row", "long"), ("doc_id", "long"), ("held_out", "boolean"), ("n_tokens", "long"), ("n_known", "long")),
        *(("base", "double"), ("score", "double"), ("word", "binary"), ("other", "binary"), ("before", "int")),
        *(("after", "int"), ("guess", "int"), ("times", "long")),
    ]
    arrow = {"long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "double": pa.float64(), "binary": pa.binary()}
    names, kinds = [n for n, _ in fields], [arrow[k] for _, k in fields]

    def nulls(size, of):
        return [pa.nulls(size, kind) for kind in of]

    def whole(columns):
        return pa.RecordBatch.from_arrays([*columns, *nulls(len(columns[0]), kinds[len(columns) :])], names)

    def run(batches):
        known = shared.value
        codes = Codes(known.head)
        divisor = math.log10(known.divisor())
        logs, plus = np.log10(np.maximum(known.counts, 1)), np.log10(known.counts + 1)
        seen = known.counts > 0
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                lines: list[tuple] = []
                tails: list[list] = [[] for _ in names[7:]]
                sizes = []
                for doc_id, held, raw in zip(*(c.to_pylist() for c in batch.slice(at, 500).columns)):
                    words = words_of(raw)
                    found = np.array([0, *map(codes.__getitem__, words), 0], dtype=np.int64)
                    classes = _classes(found, known.classes, known.items)
                    inside = found >= 0
                    both = inside[:-1] & inside[1:]
                    own = found[1:-1][inside[1:-1]]
                    total = known.transitions[classes[:-1][both], classes[1:][both]].sum()
                    total += logs[own].sum() - known.norms[known.classes[own]].sum() - known.norms[0]
                    base = plus[own].sum() + plus[0] - (len(own) + 1) * divisor
                    lines.append((doc_id, held, len(words) + 1, int(seen[own].sum() + seen[0]), float(base), float(total)))
                    # -1: the neighbour is outside the head, too, and counts as a pair
                    k, near = np.flatnonzero(~inside), np.where(inside, classes, -1)
                    outside = [words[j] for j in (k - 1).tolist()]
                    tail = Counter(zip(outside, repeat(None), near[k - 1].tolist(), near[k + 1].tolist(), classes[k].tolist()))
                    k = k[~inside[k + 1]]
                    first, second = ([words[j] for j in (k + step).tolist()] for step in (-1, 0))
                    tail.update(zip(first, second, classes[k].tolist(), classes[k + 1].tolist(), repeat(None)))
                    sizes.append(len(tail))
                    for column, values in zip(tails, zip(*tail)):
                        column += values
                    tails[5] += tail.values()
                rows = np.arange(row, row + len(lines))
                row += len(lines)
                columns = [rows, *zip(*lines)]
                yield whole([pa.array(c, kind) for c, kind in zip(columns, kinds)])
                yield whole([pa.array(np.repeat(rows, sizes)), *nulls(sum(sizes), kinds[1:7]), *(pa.array(c, kind) for c, kind in zip(tails, kinds[7:]))])

    def worth(batches):
        known = shared.value
        divisor = math.log10(known.divisor())
        for batch in batches:
            row, times, n, own, before, after = (c.to_numpy() for c in batch.columns)
            value = np.zeros(len(row))
            for near, a, b in ((before, before, own), (after, own, after)):
                at = near >= 0
                value[at] += known.transitions[a[at], b[at]]
            emission = np.where(n > 0, np.log10(np.maximum(n, 1)), known.unseen[own]) - known.norms[own]
            value += np.where(n >= 0, emission, 0)
            base = np.where(n >= 0, np.log10(np.maximum(n, 0) + 1) - divisor, 0)
            arrays = [pa.array(c) for c in (row, np.where(n > 0, times, 0), times * base, times * value)]
            yield pa.RecordBatch.from_arrays(arrays, ["row", "known", "more_base", "more_score"])

    chosen = docs.select(F.col("doc_id").cast("long"), held_out.alias("held_out"), F.col("text").cast("string").cast("binary"))
    parts = materialize(chosen.mapInArrow(run, ", ".join(f"{n} {k}" for n, k in fields)), "scored")
    single = parts.where("word IS NOT NULL AND other IS NULL").join(table, "word", "left")
    single = single.select(
        "row", "times", F.coalesce("n", F.lit(0)).cast("long").alias("n"), F.coalesce("class", "guess").cast("int").alias("own"), "before", "after"
    )
    first = table.select("word", F.col("class").alias("first"))
    second = table.select(F.col("word").alias("other"), F.col("class").alias("second"))
    double = parts.where("other IS NOT NULL").join(first, "word", "left").join(second, "other", "left")
    double = double.select(
        "row",
        "times",
        F.lit(-1).cast("long").alias("n"),
        F.coalesce("second", "after").cast("int").alias("own"),
        F.coalesce("first", "before").cast("int").alias("before"),
        F.lit(-1).alias("after"),
    )
    met = single.union(double).mapInArrow(worth, "row long, known long, more_base double, more_score double")
    sums = met.groupBy("row").agg(F.sum("known").alias("known"), F.sum("more_base").alias("more_base"), F.sum("more_score").alias("more_score"))
    joined = parts.where("word IS NULL").select("row", "doc_id", "held_out", "n_tokens", "n_known", "base", "score").join(sums, "row", "left")
    total = F.col("score") + F.coalesce("more_score", F.lit(0.0))
    return joined.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("known", F.lit(0))).alias("n_known"),
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more_base", F.lit(0.0))).alias("base_score"),
        total.alias("score"),
        F.pow(F.lit(10.0), -total / F.col("n_tokens")).alias("perplexity"),
    )
