import random
from collections import Counter

import numpy as np
import pytest

from silverlode.llm import linking, minmax
from silverlode.llm.registry import QUERIES

SMALL = "/root/testdata/sf0.01"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    words = [w for w in (text or "").translate(LOWER).translate({c: " " for c in range(9, 14)}).split(" ") if w]
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def plain(rows, numerator=85, denominator=100):
    """The set size, component and kept flag of each row, by all pairs."""
    sets = [shingles(text) for _, text in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    by_shingle = {}
    for x, one in enumerate(sets):
        shared = Counter(y for s in one for y in by_shingle.get(s, ()))
        for s in one:
            by_shingle.setdefault(s, []).append(x)
        for y, common in shared.items():
            if denominator * common >= numerator * (len(one) + len(sets[y]) - common):
                p, q = sorted((find(x), find(y)))
                root[q] = p
    smallest = {}
    for x, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            smallest[find(x)] = min(smallest.get(find(x), doc_id), doc_id)
    answers = []
    for x, (doc_id, _) in enumerate(rows):
        component = smallest.get(find(x)) if sets[x] else doc_id
        answers.append((doc_id, len(sets[x]), component, doc_id == component))
    return sorted(answers, key=repr)


def made_up_rows(seed, groups=40):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(500)]
    line = rng.choices(words, k=30)
    texts = [None, "", " \n", "\x0b", "one", "ONE ", "two", "a b c d e", "A b\tc d e", "a b c d e f", "é x", "É x", "a b", "a b"]
    for group in range(groups):
        base = rng.choices(words, k=rng.randint(6, 150)) + line * (group % 3)
        for _ in range(rng.choice([1, 2, 12])):
            copy = list(base)
            for _ in range(rng.randint(0, max(1, len(copy) // 30))):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            texts.append(" ".join(copy))
            if rng.random() < 0.2:
                texts.append(" \n".join(copy).upper())
    ids = list(range(len(texts)))
    rng.shuffle(ids)
    rows = list(zip(ids, texts))
    return rows + [(None, texts[20]), (None, "alone without an id but with words"), (None, None), rows[21], rows[21], (rows[30][0], "other text")]


def answers(docs, **options):
    return sorted((tuple(r) for r in minmax.near_duplicates(docs, **options).collect()), key=repr)


@pytest.mark.parametrize("seed,task_hashes", [(1, None), (2, 300)])
def test_equals_all_pairs(frame, monkeypatch, seed, task_hashes):
    if task_hashes:  # blocks are dealt as chunks
        monkeypatch.setattr(linking, "TASK_HASHES", task_hashes)
    rows = made_up_rows(seed)
    docs = frame([(i, t, 1, "x", True) for i, t in rows], "doc_id long, text string, id long, same string, kept boolean")
    want = plain(rows)
    assert len({r[2] for r in want}) < len(want) - 50
    assert answers(docs.repartition(5)) == want


def test_another_similarity(frame):
    rows = made_up_rows(3, groups=25)
    docs = frame(rows, "doc_id long, text string")
    assert answers(docs, similarity=(8, 10), band=4, bands=32) == plain(rows, 8, 10)


def test_one_block_of_many_different_near_copies(frame, monkeypatch):
    monkeypatch.setattr(linking, "TASK_HASHES", 5_000)
    rng = random.Random(9)
    words = [f"v{i}" for i in range(3000)]
    base = rng.choices(words, k=80)
    rows = []
    for i in range(400):
        copy = list(base)
        copy[rng.randrange(80)] = rng.choice(words)
        rows.append((i, " ".join(copy)))
    far = base[:60] + rng.choices(words, k=20)  # shares much, links to none
    rows += [(500 + k, " ".join(far[: 60 + k])) for k in (2, 3, 20)]
    docs = frame(rows, "doc_id long, text string").repartition(3)
    assert answers(docs) == plain(rows)


def test_spanning_links_join_what_all_pairs_join():
    rng = np.random.default_rng(3)
    for _ in range(60):
        bases = [rng.integers(0, 60, rng.integers(1, 30)) for _ in range(4)]
        sets = []
        for _ in range(rng.integers(2, 40)):
            one = bases[rng.integers(4)].copy()
            one[rng.random(len(one)) < 0.08] = rng.integers(0, 60)
            sets.append(np.unique(one))
        labels = rng.integers(0, len(sets), len(sets)) if rng.random() < 0.5 else np.arange(len(sets))

        def joined(links):
            root = {}

            def find(x):
                while root.setdefault(x, x) != x:
                    x = root[x]
                return x

            for label in labels:
                find(label)
            for x, y in links:
                root[find(labels[x])] = find(labels[y])
            groups = {}
            for x, label in enumerate(labels):
                groups.setdefault(find(label), set()).add(x)
            return sorted(map(sorted, groups.values()))

        near = [
            (x, y)
            for x in range(len(sets))
            for y in range(x)
            if 5 * (c := len(np.intersect1d(sets[x], sets[y]))) >= 4 * (len(sets[x]) + len(sets[y]) - c)
        ]
        found = [(x, y) for part in linking.spanning_links(labels, sets, (4, 5)) for x, y in zip(*part)]
        assert set(map(tuple, found)) <= set(near) | {(y, x) for x, y in near}
        assert joined(found) == joined(near)
        assert len(found) < len(set(labels.tolist()))


def test_both_ends_of_a_signature_estimate_the_similarity():
    rng = np.random.default_rng(5)
    turns, factors = minmax.permutations(400)
    universe = rng.integers(0, 2**64, 400, dtype=np.uint64)
    one, other = universe[:340], universe[60:]  # 280 of 400 in common
    equal = minmax.signature(one, turns, factors) == minmax.signature(other, turns, factors)
    assert abs(equal[:400].mean() - 0.7) < 0.08 and abs(equal[400:].mean() - 0.7) < 0.08


def test_a_long_text_has_the_signature_of_its_slices(monkeypatch):
    turns, factors = minmax.permutations(10)
    hashes = np.random.default_rng(1).integers(0, 2**64, 10_000, dtype=np.uint64)
    whole = minmax.signature(hashes, turns, factors)
    monkeypatch.setattr(minmax, "SLICE", 17)
    assert (minmax.signature(hashes, turns, factors) == whole).all()


def test_empty_tables(frame):
    empty = frame([], "doc_id long, text string")
    assert answers(empty) == []
    assert answers(frame([(1, ""), (2, None), (None, None)], "doc_id long, text string")) == plain([(1, ""), (2, None), (None, None)])


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted((tuple(r) for r in QUERIES["op11_min_max_near_duplicates"](spark, SMALL).collect()), key=repr)
    assert got == plain(rows)
