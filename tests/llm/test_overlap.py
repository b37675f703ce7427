import random

import corpus_pipeline as pipeline
from silverlode.llm import overlap

SMALL = "/root/testdata/sf0.01"


def shingles(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def plain(docs, least=0.8):
    """The smallest id of each document's component, by all pairs."""
    sets, root = {d: shingles(t) for d, t in docs}, {d: d for d, _ in docs}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    for a, x in sets.items():
        for b, y in sets.items():
            if a < b and (common := len(x & y)) and common / (len(x) + len(y) - common) >= least:
                p, q = find(a), find(b)
                root[max(p, q)] = min(p, q)
    return {d: find(d) for d in root}


def test_groups_against_all_pairs(spark):
    rng = random.Random(4)
    words = [f"w{i}" for i in range(400)]
    line = rng.choices(words, k=25)
    docs = [(1, None), (2, ""), (3, " \n"), (4, "one"), (5, "ONE "), (6, "two"), (7, "a b c d e"), (8, "a b c d e f")]
    for group in range(12):
        base = rng.choices(words, k=rng.randint(6, 120)) + line * (group % 3)
        for _ in range(rng.choice([1, 2, 12])):
            copy = list(base)
            for _ in range(rng.randint(0, max(1, len(copy) // 40))):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            docs.append((len(docs) + 1, " ".join(copy)))
    df = spark.createDataFrame(docs, "key long, text string").repartition(5)
    want = plain(docs)
    assert len(set(want.values())) > 20 and len(docs) - len(set(want.values())) > 20
    assert {r.key: r.component for r in overlap.groups(df).collect()} == want
    assert overlap.groups(df.limit(0)).count() == 0


def test_stage_keeps_one_of_each_similar_group(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    want = set(plain([(r.doc_id, r.text) for r in docs.collect()]).values())
    kept = [r.doc_id for r in pipeline.drop_near_duplicates(spark, docs, SMALL).select("doc_id").collect()]
    assert sorted(kept) == sorted(want)
    assert not {255, 770, 875, 944} & want  # near copies beyond 4 differing bits
