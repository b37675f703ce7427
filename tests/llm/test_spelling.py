import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from silverlode.functions.scratch import materialize
from silverlode.llm import spelling
from silverlode.llm.registry import QUERIES

SMALL = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def one_edit(a, b):
    """True if exactly one inserted, deleted or replaced code point makes one word the other."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(a) + 1 == len(b) and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_counts(rows, least_letters=6, least_times=5):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= least_letters and n >= least_times}


def plain_variants(counts, ratio=5):
    near = {w: [v for v in counts if v != w and one_edit(v, w)] for w in counts}
    forms = {}
    for word, others in near.items():
        best = min(others, key=lambda v: (-counts[v], v), default=None)
        forms[word] = best if best is not None and counts[best] >= ratio * counts[word] else None
    rows = set()
    for word in counts:
        root = word
        while forms[root] is not None:
            root = forms[root]
        form = forms[word]
        rows.add((word, form, root, counts[word], len(near[word]), counts[form] if form else None))
    return rows


def made_up_rows(count, seed):
    rng = random.Random(seed)
    stems = ["banana", "letter", "bookkeeper", "niñera", "aaaaaa", "abcdef", "Straße", "ÀÉÎÕÜÿ", "mississippi"]
    rows = []
    for i in range(count):
        words = []
        for _ in range(rng.randint(0, 40)):
            word = rng.choice(stems[: rng.randint(1, len(stems))])
            while rng.random() < 0.3:
                at, kind = rng.randrange(len(word)), rng.randrange(3)
                word = word[:at] + (rng.choice("abÿ") if kind else "") + word[at + (kind < 2) :]
                if len(word) < 2:
                    break
            words.append(word.upper() if rng.random() < 0.1 else word)
        rows.append((i, rng.choice([" ", ", ", "1", "_", "\n"]).join(words)))
    return rows + [(None, "banana letter " * 20), (None, None), (7, None), (8, ""), (9, "÷×÷×÷×÷ " * 5), (3, rows[3][1]), (3, rows[3][1])]


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_the_plain_version(frame, seed):
    rows = made_up_rows(300, seed)
    docs = frame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, word string, n long").repartition(4)
    got = {tuple(r) for r in spelling.variants(docs).select("word", "form", "root", "n", "n_near", "form_n").collect()}
    want = plain_variants(plain_counts(rows))
    assert got == want


def test_chains_of_forms_are_followed_to_their_end(frame):
    words = {f"abcdef{'x' * k}": 5 * 5**k for k in range(6)}
    docs = frame([(1, " ".join(" ".join([w] * n) for w, n in words.items()))], "doc_id long, text string")
    got = {tuple(r) for r in spelling.variants(docs, spoil_one_in=None).select("word", "form", "root", "n", "n_near", "form_n").collect()}
    assert got == plain_variants(words)
    assert {r[2] for r in got} == {"abcdefxxxxx"}


def test_long_texts_are_counted_whole(frame, monkeypatch):
    monkeypatch.setattr(spelling, "PIECE_BYTES", 10)
    text = "abcdefghijkl" * 5 + " übergängeé Übergang-übergang " * 30
    got = {r.word: r.n for r in spelling.word_counts(frame([(1, text)], "doc_id long, text string")).collect()}
    assert got == plain_counts([(1, text)])


def test_few_held_words_change_nothing(frame, monkeypatch):
    docs = frame(made_up_rows(100, 3), "doc_id long, text string")
    whole = {tuple(r) for r in spelling.word_counts(docs).collect()}
    monkeypatch.setattr(spelling, "HELD_WORDS", 3)
    assert {tuple(r) for r in spelling.word_counts(docs).collect()} == whole


def test_all_words_of_one_pattern(frame):
    """Every letter between the same ends: each word is near to all others and to the word without the letter."""
    words = [f"abc{chr(c)}def" for c in [*range(97, 123), *range(0xC0, 0x100)]] + ["abcdef"]
    docs = frame([(i, " ".join([w] * (5 + k))) for k, w in enumerate(words) for i in [k]], "doc_id long, text string")
    near = {r.word: r.n_near for r in spelling.variants(docs, spoil_one_in=None).collect()}
    assert set(near.values()) == {len(words) - 1} and len(near) == len(words)


def test_a_very_long_word(frame):
    long = "abcdefghij" * 400
    words = [long, long[:1500] + long[1501:], long[:-1], long + "a", long[:2000] + "é" + long[2001:]]
    docs = frame([(i, " ".join([w] * (5 + 30 * (i == 0)))) for i, w in enumerate(words)], "doc_id long, text string")
    got = {tuple(r) for r in spelling.variants(docs, spoil_one_in=None).select("word", "form", "root", "n", "n_near", "form_n").collect()}
    assert got == plain_variants({w: 5 + 30 * (w == long) for w in words})


def test_an_empty_table(frame):
    empty = frame([], "doc_id long, text string")
    assert spelling.variants(empty).collect() == []


def test_a_ratio_that_allows_loops_is_refused(frame):
    with pytest.raises(ValueError):
        spelling.variants(frame([], "doc_id long, text string"), ratio=1)


def test_no_table_of_words_or_their_parts_is_broadcast(frame, monkeypatch):
    """Spark takes the exploded parts of words for no larger than the words; the driver cannot hold them."""
    plans = []

    def recorded(df, label):
        if label != "words":  # numbered with the offsets of ranges, one row each
            plans.append(df._jdf.queryExecution().executedPlan().toString())
        return materialize(df, label)

    monkeypatch.setattr(spelling, "materialize", recorded)
    result = spelling.variants(frame(made_up_rows(50, 4), "doc_id long, text string"))
    plans.append(result._jdf.queryExecution().executedPlan().toString())
    assert sum(plan.count("SortMergeJoin") for plan in plans) >= 6
    assert not [plan for plan in plans if "Broadcast" in plan]


def test_query(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    result = QUERIES["op12_spelling_variants"](spark, SMALL)
    assert {tuple(r) for r in result.collect()} == plain_variants(plain_counts(rows))
    assert result.where(F.col("word") == F.col("form")).isEmpty()
