import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from silverlode.llm import brown
from silverlode.llm.registry import QUERIES

SMALL = "/root/testdata/sf0.001"


def tokens(text):
    return [*(text or "").encode().lower().split(), b""]


def plain_base(train, texts):
    counts = Counter(t for text in train for t in tokens(text))
    total, types = counts.total(), len(counts)
    return [sum(math.log10((counts[t] + 1) / max(1, total + types + 1)) for t in tokens(text)) for text in texts], counts


def class_of(model, table):
    """Class of a word: its own in the head or the table, else that of its ending."""
    own = {word: int(c) for word, c in zip(model.head, model.classes)}
    own |= {bytes(r.word): r["class"] for r in table.collect()}
    return lambda word: own.get(word, int(model.items[brown.ending_item(word)]))


def plain_score(model, table, counts, text, find=None):
    """The class model token by token, from the fitted classes and the full counts."""
    find = find or class_of(model, table)
    before, out = 0, 0.0
    for token in tokens(text):
        own = find(token) if token else 0
        out += model.transitions[before, own]
        if token != b"":
            out += (math.log10(counts[token]) if counts[token] else model.unseen[own]) - model.norms[own]
        before = own
    return out


def grammar(rng, words=30):
    """Texts of nouns and verbs in turn, so that classes pay."""
    return " ".join(f"n{rng.randrange(40)}" if k % 2 else f"v{rng.randrange(40)}" for k in range(words))


@pytest.fixture(scope="module")
def trained(spark):
    rng = random.Random(1)
    train = [grammar(rng) for _ in range(300)] + ["rare " + "x" * 100, None, ""]
    df = spark.createDataFrame([(t,) for t in train], "text string")
    model, table = brown.train(df)
    return train, model, table


def test_exchange_finds_the_classes(trained):
    _, model, _ = trained
    place = {word: k for k, word in enumerate(model.head)}
    nouns = [int(model.classes[place[b"n%d" % k]]) for k in range(40)]
    verbs = [int(model.classes[place[b"v%d" % k]]) for k in range(40)]
    assert sum(c in verbs for c in nouns) <= 2
    assert model.classes[0] == 0 and (model.classes[1:] > 0).all()


def test_a_round_raises_the_likelihood(spark):
    rng = random.Random(5)
    pairs = Counter()
    for _ in range(4000):  # three kinds of items, each kind followed by the next
        a = rng.randrange(1, 301)
        pairs[a, 1 + (a // 100 + 1) % 3 * 100 + rng.randrange(100)] += 1
    table = spark.createDataFrame([(a, b, n) for (a, b), n in pairs.items()], "a long, b long, n long")
    start = brown.start_classes()
    dense = np.zeros((brown.ITEMS, brown.CLASSES))
    for (a, b), n in pairs.items():
        dense[a, start[b]] += n
    classes, by_class = brown.exchange(table, rounds=6)
    assert by_class.sum() == 4000
    assert brown.likelihood(by_class) > brown.likelihood(brown.class_pairs(dense, start))


def test_chances_add_up_to_one(trained):
    train, model, table = trained
    counts = plain_base(train, [])[1]
    find = class_of(model, table)
    for before in range(brown.CLASSES):
        total = 10 ** model.transitions[before, 0]
        for word, n in counts.items():
            if word:
                own = find(word)
                total += 10 ** (model.transitions[before, own] + math.log10(n) - model.norms[own])
        total += sum(10 ** (model.transitions[before, c] + model.unseen[c] - model.norms[c]) for c in range(1, brown.CLASSES))
        assert math.isclose(total, 1, rel_tol=1e-9)


def test_scores_against_token_by_token(spark, trained, monkeypatch):
    train, model, counts_table = trained
    rng = random.Random(2)
    texts = [None, "", "Rare " + "X" * 100, "unknown words here", grammar(rng), grammar(rng, 4000), "é\x0bn1\tN2"]
    rows = [(k, t, 3.0, True) for k, t in enumerate(texts)] + [(None, "n1", 0.0, False), (0, None, 1.0, True)]
    df = spark.createDataFrame(rows, "doc_id long, text string, score double, held_out boolean")
    base, counts = plain_base(train, [r[1] for r in rows])
    got = brown.score(df, model, counts_table, F.lit(True)).collect()
    want = [(d, len(tokens(t)), sum(counts[x] > 0 for x in tokens(t)), counts.total(), round(b, 6), round(plain_score(model, counts_table, counts, t), 6)) for (d, t, *_), b in zip(rows, base)]
    key = lambda r: str(r)
    assert sorted(((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6)) for r in got), key=key) == sorted(want, key=key)
    assert brown.score(df.limit(0), model, counts_table, F.lit(True)).count() == 0


def test_small_head_gives_the_same_base(spark, monkeypatch):
    """Words outside the head take the join; the answer does not depend on which do."""
    rng = random.Random(3)
    train = [grammar(rng) for _ in range(50)]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(train)], "doc_id long, text string")
    counts = brown.materialize(brown.count_words(df.select(F.col("text").cast("binary"))), "counts")
    assert len(brown.head_of(counts, 10)[0]) <= 11
    monkeypatch.setattr(brown, "head_of", lambda c, most=10, old=brown.head_of: old(c, 10))
    model, table = brown.train(df.select("text"))
    base, plain_counts = plain_base(train, train)
    got = {r.doc_id: r for r in brown.score(df, model, table, F.lit(False)).collect()}
    for k, text in enumerate(train):
        assert math.isclose(got[k].base_score, base[k], rel_tol=1e-9)
        assert math.isclose(got[k].score, plain_score(model, table, plain_counts, text), rel_tol=1e-9)


def plain_pairs(find, texts):
    pairs = np.zeros((brown.CLASSES, brown.CLASSES))
    for text in texts:
        line = [0, *(find(t) if t else 0 for t in tokens(text))]
        np.add.at(pairs, (line[:-1], line[1:]), 1)
    return pairs


def test_every_word_finds_its_class(spark, monkeypatch):
    """Words outside the items choose a class as well, inside the head and outside it; the class pairs are those of the texts."""
    items, most, kinds = brown.ITEM_WORDS, 9000, 6000
    monkeypatch.setattr(brown, "head_of", lambda c, old=brown.head_of: old(c, most))
    seen = {}
    monkeypatch.setattr(brown, "transitions", lambda pairs, old=brown.transitions: seen.update(pairs=pairs) or old(pairs))
    rng = random.Random(4)

    def word(kind):
        return f"{kind}{int(kinds * rng.random() ** 2)}"

    train = [" ".join(word("nv"[k % 2]) for k in range(200)) for _ in range(600)] + [None, "", "once"]
    model, table = brown.train(spark.createDataFrame([(t,) for t in train], "text string"))
    words = {t for text in train for t in tokens(text)} - {b""}
    assert {bytes(r.word) for r in table.collect()} | set(model.head[1:]) == words
    find, start = class_of(model, table), lambda w: int(model.items[brown.ending_item(w)])
    assert items < len(model.head) < len(words)
    items_own = dict(zip(model.head[1 : items + 1], model.classes[1 : items + 1]))
    for others in (set(model.head[items + 1 :]), words - set(model.head)):
        assert np.mean([find(w) != start(w) for w in others]) > 0.5
    assert (plain_pairs(find, train) == seen["pairs"]).all()
    before = plain_pairs(lambda w: items_own.get(w, start(w)), train)
    assert brown.likelihood(seen["pairs"]) > brown.likelihood(before)


def test_best_class_against_all_moves():
    """The chosen class is the one with the largest likelihood when the pairs are counted anew for each class."""
    rng = random.Random(6)
    line = [0] + [rng.randrange(1, 60) for _ in range(3000)] + [0]
    line = [b for a, b in zip([None, *line], line) if a != b]  # a word next to itself moves on both sides at once
    classes = np.array([0] + [rng.randrange(1, 8) for _ in range(59)])

    def pairs_of(classes):
        pairs = np.zeros((brown.CLASSES, brown.CLASSES))
        np.add.at(pairs, (classes[line[:-1]], classes[line[1:]]), 1)
        return pairs

    right, left = np.zeros((2, 60, brown.CLASSES))
    np.add.at(right, (line[:-1], classes[line[1:]]), 1)
    np.add.at(left, (line[1:], classes[line[:-1]]), 1)
    best = brown.best_classes(right[1:], left[1:], classes[1:], pairs_of(classes))
    for word in range(1, 60):
        values = {}
        for c in range(1, 9):
            moved = classes.copy()
            moved[word] = c
            values[c] = brown.likelihood(pairs_of(moved))
        moved = classes.copy()
        moved[word] = best[word - 1]
        assert brown.likelihood(pairs_of(moved)) >= max(values.values()) - 1e-6


def test_no_training_text(spark):
    df = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    model, counts = brown.train(df.limit(0).select("text"))
    rows = brown.score(df, model, counts, F.lit(True)).collect()
    assert all(r.n_known == 0 and r.train_tokens == 0 and math.isfinite(r.score) and r.score < 0 for r in rows)


def test_codes_forget_but_agree(monkeypatch):
    monkeypatch.setattr(brown, "COUNTED", 10)
    codes = brown.Codes([b"", b"a"])
    for k in range(100):
        word = b"w%d" % k
        assert codes[word] == -brown.ending_item(word) and codes[b"a"] == 1
    assert len(codes) <= 13


def test_query_beats_the_base_on_held_out_texts(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    held = {d for d in docs if zlib.crc32(str(d).encode()) % 7 == 2}
    base, counts = plain_base([t for d, t in docs.items() if d not in held], docs.values())
    want = dict(zip(docs, base))
    rows = QUERIES["op1_brown_class_scores"](spark, SMALL).collect()
    assert len(rows) == len(docs)
    for r in rows:
        assert r.held_out == (r.doc_id in held) and r.train_tokens == counts.total()
        assert math.isclose(r.base_score, want[r.doc_id], rel_tol=1e-9)
        assert math.isclose(r.perplexity, 10 ** (-r.score / r.n_tokens), rel_tol=1e-9)
    assert np.mean([r.score > r.base_score for r in rows if r.held_out]) > 0.9


def test_counts_are_packed(spark, monkeypatch):
    """Counts go through shuffles and rounds as a few rows of bytes, also where they are summed a part at a time."""
    monkeypatch.setattr(brown, "HELD", 50)
    rng = random.Random(8)
    texts = [grammar(rng) for _ in range(60)] + [None, ""]
    head = [b"", *sorted({t for text in texts for t in tokens(text)} - {b""})]
    place = {word: k for k, word in enumerate(head)}
    want = Counter()
    for text in texts:
        line = [0, *(place[t] for t in tokens(text))]
        want.update(zip(line, line[1:]))
    df = spark.createDataFrame([(t,) for t in texts], "text string").select(F.col("text").cast("binary"))
    pairs = brown.count_pairs(df.repartition(3), head)
    assert "Aggregate" not in pairs._jdf.queryExecution().optimizedPlan().toString()
    assert {(r.a, r.b): r.n for r in pairs.collect()} == want
    noted = {}
    monkeypatch.setattr(brown, "materialize", lambda df, label, old=brown.materialize: noted.setdefault(label, old(df, label)))
    assert brown.exchange(pairs, rounds=1)[1].sum() == sum(want.values())
    assert noted["pair-sides"].count() < len(want) / 10
