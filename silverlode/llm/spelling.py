"""Spelling variants: words one edit apart, found by a dictionary of pairs of trie nodes.

Every beginning of a word is a node of a trie, every ending a node of the trie of reversed words, and all nodes are
numbered. Cutting a word before a place gives a pair (beginning, ending) of node numbers; skipping the letter at a place
gives one too. Words with equal skipped pairs differ in that one letter; a word whose cut pair equals the skipped pair of
another is the other without that letter. So neighbours are exactly the words that meet under a pair of numbers, and no
two words are compared.

Under one pair stand the words that put any one letter between the same beginning and ending, at most one for each letter
of the alphabet, and the word without that letter. A letter next to its like can be skipped at several places with one
result; only the first place of such a run meets the shorter word, so every two neighbours meet once.

Words are numbered by their rank, the most frequent first and equal counts in code-point order, so the best of some
neighbours is the one of smallest rank.

Where a noise rule is given, it spoils some occurrences on purpose, which gives the corpus known misspellings.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbering import number_rows
from ..functions.scratch import materialize
from .common import growing

# Fixed value: the letters of a word, A-Z lower-cased, as UTF-8 bytes.
RUN = re.compile(rb"(?:[a-z]|\xc3[\x80-\xbf])+")
HELD_WORDS = 100_000
PIECE_BYTES = 1 << 20
LONG_PART = 64


def _runs(text: bytes) -> Counter:
    """Times of each run of letters, with A-Z lower-cased. A long text is counted in parts cut at a byte outside runs."""
    found: Counter = Counter()
    start = 0
    while start < len(text):
        stop = start + PIECE_BYTES
        if stop < len(text):
            outside = re.compile(rb"[\x00-@\[-`{-\x7f]").search(text, stop)
            stop = outside.end() if outside else len(text)
        found.update(RUN.findall(text[start:stop].lower()))
        start = stop
    return found


def _spoilt(run: bytes, draw: int) -> bytes:
    """The run without the code point at ``draw`` modulo its length."""
    letters = run.decode()
    at = draw % len(letters)
    return (letters[:at] + letters[at + 1 :]).encode()


def word_counts(docs: DataFrame, spoil_one_in: int | None = 199, least_letters: int = 6, least_times: int = 5) -> DataFrame:
    """``word``, ``n``: words of at least ``least_letters`` code points that occur at least ``least_times`` in all texts.

    In a document, a run whose CRC-32 of ``doc_id:run`` is a multiple of ``spoil_one_in`` loses one code point; None
    spoils nothing. Counts are combined in tasks before they are shuffled.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def flush() -> pa.RecordBatch:
            words = pa.array(list(held), pa.binary()).cast(pa.string())
            return pa.RecordBatch.from_arrays([words, pa.array(held.values(), pa.int64())], ["word", "n"])

        for batch in batches:
            for doc_id, text in zip(*batch.columns):
                named = doc_id.as_py().encode() + b":"
                seed = zlib.crc32(named)
                for word, times in _runs(text.as_py()).items():
                    if spoil_one_in:
                        draw = zlib.crc32(word, seed)
                        if draw % spoil_one_in == 0:
                            word = _spoilt(word, draw)
                    # every letter beyond ASCII is two bytes that begin with the same one
                    if len(word) - word.count(b"\xc3") >= least_letters:
                        held[word] += times
                if len(held) > HELD_WORDS:
                    yield flush()
                    held.clear()
        if held:
            yield flush()

    text = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    chosen = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id"), text.alias("text"))
    counted = chosen.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.where(F.col("n") >= least_times)


def _numbered(strings: DataFrame, name: str, number: str) -> DataFrame:
    """The different strings of a column with a number each, written so that they keep it."""
    return materialize(strings.select(name).distinct().withColumn(number, F.monotonically_increasing_id()), f"{number}-nodes")


def _short(part: Column) -> Column:
    """A part of a word, or its length and SHA-256, so that the parts of a very long word do not fill a disk."""
    digest = F.concat_ws(":", F.length(part).cast("string"), F.sha2(part, 256))
    return F.when(F.length(part) > LONG_PART, digest).otherwise(part)


def pair_dictionary(words: DataFrame) -> DataFrame:
    """All pairs of node numbers of the words (columns ``word``, ``rank``): ``beginning``, ``ending``, ``rank``,
    ``skipped`` (a letter is left out between them) and ``first`` (the letter before it is another)."""
    at, length = F.col("at"), F.length("word")
    cuts = words.select("word", "rank", F.explode(F.sequence(F.lit(0), length)).alias("at")).select(
        "rank",
        "at",
        _short(F.substring("word", F.lit(1), at)).alias("prefix"),
        _short(F.substring("word", at + 1, length)).alias("suffix"),
        ((at == 0) | (F.substring("word", at, F.lit(1)) != F.substring("word", at + 1, F.lit(1)))).alias("first"),
    )
    forward, backward = _numbered(cuts, "prefix", "beginning"), _numbered(cuts, "suffix", "ending")
    nodes = cuts.join(growing(forward), "prefix").join(growing(backward), "suffix")
    node = F.struct("at", "beginning", "ending", "first")
    of_word = nodes.groupBy("rank").agg(F.array_sort(F.collect_list(node)).alias("nodes"))

    def cut(one: Column) -> Column:
        return F.struct(one["beginning"].alias("beginning"), one["ending"].alias("ending"), F.lit(False).alias("skipped"), F.lit(True).alias("first"))

    def skipping(one: Column, place: Column) -> Column:
        ending = F.get("nodes", place + 1)["ending"]
        return F.struct(one["beginning"].alias("beginning"), ending.alias("ending"), F.lit(True).alias("skipped"), one["first"].alias("first"))

    inner = F.slice("nodes", F.lit(1), F.size("nodes") - 1)
    pairs = F.concat(F.transform("nodes", cut), F.transform(inner, skipping))
    return of_word.select("rank", F.inline(pairs))


def neighbours(words: DataFrame) -> DataFrame:
    """``rank``, ``n_near`` and the smallest rank of a near word as ``best``, for words that have any."""
    met = (
        pair_dictionary(words)
        .groupBy("beginning", "ending")
        # at most one word for each letter of the alphabet and one without
        .agg(F.count(F.lit(1)).alias("members"), F.array_sort(F.collect_list(F.struct("rank", "skipped", "first"))).alias("found"))
        .where("members > 1")
    )

    def near(one: Column, other: Column) -> Column:
        replaced = one["skipped"] & other["skipped"] & (one["rank"] != other["rank"])
        return replaced | ((one["skipped"] != other["skipped"]) & one["first"] & other["first"])

    def with_others(one: Column) -> Column:
        return F.struct(one["rank"].alias("rank"), F.filter("found", lambda other: near(one, other)).alias("near"))

    each = met.select(F.inline(F.transform("found", with_others))).where(F.size("near") > 0)
    count = F.sum(F.size("near")).cast("long")
    return each.groupBy("rank").agg(count.alias("n_near"), F.min(F.element_at("near", 1)["rank"]).alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """``word``, ``root`` of the words that have a ``form``: the last word of its chain of forms.

    Every round doubles the steps taken, so a chain is done after the logarithm of its length. Chains have no loop, as
    counts rise along them.
    """
    steps = materialize(forms.select("word", F.col("form").alias("root")), "forms")
    while True:
        onward = steps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        longer = steps.join(growing(onward), "root", "left")
        longer = materialize(longer.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "forms")
        if longer.where("moved").isEmpty():
            return longer.select("word", "root")
        steps = longer.select("word", "root")


def variants(docs: DataFrame, ratio: int = 5, spoil_one_in: int | None = 199, least_letters: int = 6, least_times: int = 5) -> DataFrame:
    """``word``, ``form``, ``root``, ``n``, ``n_near``, ``form_n``: one row per word of ``word_counts``.

    ``form`` is the near word (one inserted, deleted or replaced code point) of largest count, ties to the smaller in
    code-point order, if it occurs at least ``ratio`` times as often; else null. ``root`` is the last word along the forms.
    A null text holds no word, a null id counts as the empty text in the noise rule, repeated rows count as often as they
    come. Other columns are ignored. An empty table gives an empty result.
    """
    if ratio < 2:
        raise ValueError("a form must be more frequent than its word, or chains of forms might be loops")
    counts = word_counts(docs, spoil_one_in, least_letters, least_times).withColumn("minus_n", -F.col("n"))
    words = materialize(number_rows(counts, ["minus_n", "word"], "rank").drop("minus_n"), "words")
    best = words.select(F.col("rank").alias("best"), F.col("word").alias("best_word"), F.col("n").alias("best_n"))
    formed = F.col("best_n") >= ratio * F.col("n")
    judged = words.join(growing(neighbours(words)), "rank", "left").join(growing(best), "best", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(formed, F.col("best_word")).alias("form"),
        F.when(formed, F.col("best_n")).alias("form_n"),
    )
    judged = materialize(judged, "judged-words")
    ends = roots(judged.where(F.col("form").isNotNull()))
    return judged.join(growing(ends), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
