import random
import tracemalloc

import numpy as np
import pytest
import xxhash

from silverlode.llm import simhash
from silverlode.llm.registry import QUERIES

SMALL = "/root/testdata/sf0.001"


def plain_mark(text):
    words = [w for w in (text or "").encode().lower().split()]
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def plain_groups(rows, radius=4):
    marks = [plain_mark(text) for _, text in rows]
    group = list(range(len(rows)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (marks[i] ^ marks[j]).bit_count() <= radius:
                group[root(i)] = root(j)
    ids = {}
    for i, (doc, _) in enumerate(rows):
        ids.setdefault(root(i), []).append(doc)
    return sorted(
        (doc if doc is not None else -1, f"{marks[i]:016x}", min((d for d in ids[root(i)] if d is not None), default=-1))
        for i, (doc, _) in enumerate(rows)
    )


def got(df):
    return sorted(
        (r.doc_id if r.doc_id is not None else -1, r.fingerprint, r.component_id if r.component_id is not None else -1)
        for r in df.collect()
    )


def test_fingerprint_matches_definition():
    for text in [None, "", " \t\n", "One", "a b c", "A b c D", "é ü one two three four", "x " * 500, "w1 w2 w3 w4 w5\x0bw6"]:
        assert simhash.fingerprint(text) == plain_mark(text)


def test_gray_rank_inverts_gray_code():
    codes = np.arange(1000, dtype=np.uint64)
    assert (simhash.gray_rank(codes ^ (codes >> np.uint64(1))) == codes).all()


@pytest.mark.parametrize("count", [3, 200, 1500])
def test_forest_connects_what_all_pairs_connect(count):
    rng = random.Random(count)
    centres = [rng.getrandbits(64) for _ in range(max(1, count // 10))]
    marks = []
    for _ in range(count):
        mark = rng.choice(centres)
        for _ in range(rng.randint(0, 6)):
            mark ^= 1 << rng.randrange(64)
        marks.append(mark)
    array = np.array(marks, dtype=np.uint64)
    unique = np.unique(array)
    pairs = {(i, j) for i in range(len(unique)) for j in np.flatnonzero(np.bitwise_count(unique ^ unique[i]) <= 4) if i < j}
    seen = set()
    ranked = unique[np.argsort(simhash.gray_rank(unique), kind="stable")]
    place = {int(m): i for i, m in enumerate(unique)}
    for a, b in simhash.close_pairs(ranked, 4):
        seen |= {tuple(sorted((place[int(ranked[x])], place[int(ranked[y])]))) for x, y in zip(a, b)}
    assert seen == pairs
    members, roots = simhash.forest(array, 4)
    label = {int(m): int(m) for m in unique} | {int(m): int(r) for m, r in zip(members, roots)}
    for i, j in pairs:
        assert label[int(unique[i])] == label[int(unique[j])]


def test_edge_rows(spark):
    rows = [(1, None), (2, ""), (3, " \n"), (4, "one two"), (4, "one two"), (None, "one two"), (None, "alone here now"), (9, "long " * 30000), (8, "long " * 30001)]
    df = spark.createDataFrame([(d, t, "x", 0, "y") for d, t in rows], "doc_id long, text string, mark string, own int, component_id string")
    assert got(simhash.near_duplicates(df)) == plain_groups(rows)
    assert simhash.near_duplicates(df.limit(0)).count() == 0


@pytest.mark.parametrize("node_rows", [8, 1024])
def test_dense_nodes_lose_no_link(spark, node_rows):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(60)]
    rows = []
    for doc in range(150):
        copy = list(words)
        copy[rng.randrange(60)] = f"v{rng.randrange(5)}"
        rows.append((doc, " ".join(copy)))
    rows += [(1000 + i, " ".join(rng.choices(words, k=30))) for i in range(50)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(simhash.near_duplicates(df, node_rows=node_rows)) == plain_groups(rows)


def test_query_against_all_pairs(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    assert got(QUERIES["op9_simhash_near_duplicates"](spark, SMALL)) == plain_groups(rows)


def test_links_are_searched_once(spark):
    searched = spark.sparkContext.accumulator(0)

    def pass_on(batches):
        for batch in batches:
            searched.add(batch.num_rows)
            yield batch

    marks = spark.range(4).selectExpr("id AS mark", "id AS own")
    edges = spark.createDataFrame([(0, 1), (2, 3)], "a long, b long").mapInArrow(pass_on, "a long, b long")
    found = {row["mark"]: row["smallest"] for row in simhash.components(marks, edges).collect()}
    assert found == {0: 0, 1: 0, 2: 2, 3: 2} and searched.value == 2


def test_a_dense_node_is_compared_in_little_memory():
    marks = np.sort(np.arange(1 << 11, dtype=np.uint64))
    marks = marks[np.argsort(simhash.gray_rank(marks), kind="stable")]
    tracemalloc.start()
    pairs = sum(len(left) for left, _ in simhash.close_pairs(marks, 11))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert pairs == len(marks) * (len(marks) - 1) // 2 and peak < 20e6
