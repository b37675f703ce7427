import random
from collections import Counter, defaultdict

import pytest

from silverlode.llm import packing
from silverlode.llm.registry import QUERIES

SMALL = "/root/testdata/sf0.001"


def check_rows(rows, lengths, capacities):
    """Every token of every document in one place; bins hold what they say, without overlap, in the least size."""
    largest = max(capacities)
    pieces = defaultdict(list)
    bins = defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append((r.first_token, r.length))
        bins[r.bin_id].append(r)
    for doc, wanted in lengths.items():
        cover = sorted(pieces.pop(doc))
        expected = sorted((a, min(largest, n - a)) for n in wanted for a in range(0, n, largest))
        assert cover == expected
    assert not pieces
    assert sorted(bins) == list(range(len(bins)))
    for members in bins.values():
        at = 0
        for r in sorted(members, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert {r.used for r in members} == {at}
        assert {r.capacity for r in members} == {min(c for c in capacities if c >= at)}


@pytest.mark.parametrize("seed", range(6))
def test_plan_against_one_by_one_best_fit(seed):
    """With one capacity the plan is best fit over decreasing lengths, bin for bin."""
    rng = random.Random(seed)
    items = sorted((min(100, max(1, int(rng.expovariate(1 / 25)))) for _ in range(400)), reverse=True)
    rooms = []
    for n in items:
        fitting = [k for k, room in enumerate(rooms) if room >= n]
        if fitting:
            rooms[min(fitting, key=lambda k: rooms[k])] -= n
        else:
            rooms.append(100 - n)
    plan = packing.make_plan(Counter(items), (100,))
    used = sorted(u for _, count, u, _ in plan.bins for _ in range(count))
    assert used == sorted(100 - room for room in rooms)


def test_several_sizes_waste_less_than_the_largest_alone():
    rng = random.Random(1)
    histogram = Counter(min(8192, max(1, int(rng.lognormvariate(6, 1.2)))) for _ in range(20000))
    for n in list(histogram):
        histogram[n] *= 1000  # counts do not change the work
    tokens = sum(n * c for n, c in histogram.items())
    for sizes in (packing.CAPACITIES, (8192,)):
        plan = packing.make_plan(histogram, sizes)
        assert sum(c * u for _, c, u, _ in plan.bins) == tokens
        waste = sum(count * (size - used) for _, count, used, size in plan.bins) / tokens
        assert waste < 0.02
        assert len(plan.runs) < 200_000


def test_edge_rows(spark):
    docs = [(1, 5), (1, 5), (None, 3), (2, 0), (3, None), (4, -2), (5, 33), (6, 16), (7, 1)]
    df = spark.createDataFrame([(d, n, "x", 1) for d, n in docs], "doc_id long, n_tokens int, bin_id string, row int")
    rows = packing.pack(df, (4, 8, 16)).collect()
    check_rows(rows, {1: [5, 5], None: [3], 5: [33], 6: [16], 7: [1]}, (4, 8, 16))
    assert packing.pack(df.limit(0)).count() == 0


def test_hot_length_in_small_groups(spark):
    df = spark.createDataFrame([(i, 7 if i % 3 else i % 50 + 1) for i in range(900)], "doc_id long, n_tokens long")
    rows = packing.pack(df, (10, 20, 40), group_rows=10).collect()
    check_rows(rows, {i: [7 if i % 3 else i % 50 + 1] for i in range(900)}, (10, 20, 40))


def test_word_tokens(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, " a\tb\n c "), (4, "é")], "doc_id long, text string")
    assert {r.doc_id: r.n_tokens for r in packing.word_tokens(df).collect()} == {1: 1, 2: 1, 3: 4, 4: 2}


def test_query(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    rows = QUERIES["op6_variable_best_fit"](spark, SMALL).collect()
    check_rows(rows, {d.doc_id: [len(d.text.split()) + 1] for d in docs}, packing.CAPACITIES)
    assert sum(r.length for r in rows) / sum({r.bin_id: r.capacity for r in rows}.values()) > 0.95
