import random
from collections import Counter

import regex
from pyspark.sql import functions as F

from silverlode.llm import decontaminate
from silverlode.llm.registry import QUERIES

SMALL = "/root/testdata/sf0.001"


def shingles(text):
    words = regex.findall(r"[\p{L}\p{N}]+", (text or "").lower())
    return [tuple(words[i : i + 5]) for i in range(len(words) - 4)]


def similar(a, b):
    a, b = Counter(a), Counter(b)
    common = (a & b).total()
    return common / (a.total() + b.total() - common)


def plain(docs, items, least=0.8):
    """Every window of each item's size, without fingerprints."""
    out = []
    for doc, text in docs:
        have = shingles(text)
        seen = set(have)
        for item, item_text in items:
            want = shingles(item_text)
            if want and seen & set(want):
                last = max(0, len(have) - len(want))
                best = max(similar(have[i : i + len(want)], want) for i in range(last + 1))
                if best >= least:
                    out.append((doc, item, round(best, 9)))
    return sorted(out, key=str)


def got(df):
    return sorted(((r.doc_id, r.item_id, round(r.similarity, 9)) for r in df.collect()), key=str)


def frames(spark, docs, items):
    left = spark.createDataFrame([(d, t, 1, "x") for d, t in docs], "doc_id long, text string, row int, part string")
    right = spark.createDataFrame([(i, t, 2, "y") for i, t in items], "item_id long, text string, n int, mark string")
    return left, right


def test_exact_and_near_passages(spark):
    rng = random.Random(2)
    words = [f"w{i}" for i in range(3000)]
    items = [(i, " ".join(rng.choices(words, k=rng.randint(5, 60)))) for i in range(40)]
    docs = []
    for d in range(120):
        body = rng.choices(words, k=rng.randint(0, 200))
        if d % 2:
            passage = rng.choice(items)[1].split()
            if d % 6 == 1 and len(passage) > 30:
                passage[rng.randrange(2)] = "other"
            if d % 6 == 3 and len(passage) > 40:
                passage.insert(len(passage) - 2, "extra")
            at = rng.randint(0, len(body))
            body[at:at] = [w.upper() + "," for w in passage]
        docs.append((d, " ".join(body)))
    left, right = frames(spark, docs, items)
    want = plain(docs, items)
    assert len(want) > 50
    assert got(decontaminate.find_leaks(left, right)) == want


def test_windows_between_alignments(spark):
    """Changed at both ends with words put in between, and two halves in turned order: no shingle is in its place."""
    rng = random.Random(7)
    words = [f"w{i}" for i in range(3000)]
    items = [(i, " ".join(rng.choices(words, k=59))) for i in range(10)]
    docs = []
    for i, item in items:
        passage = item.split()
        passage[0], passage[-1] = "first", "last"
        body = rng.choices(words, k=50)
        docs.append((i, " ".join([*body, *passage[:30], "put", "between", *passage[30:], *body])))
        passage = item.split()
        docs.append((100 + i, " ".join([*body, *passage[25:], *passage[:25], *body])))
    left, right = frames(spark, docs, items)
    want = plain(docs, items)
    assert len(want) == 20
    assert got(decontaminate.find_leaks(left, right)) == want


def test_no_pair_just_similar_enough_is_lost(spark):
    """Three words changed at either end of 59: similarity 0.803, fingerprints sometimes over 16 bits apart."""
    rng = random.Random(8)
    items = [(i, " ".join(f"w{rng.randrange(3000)}" for _ in range(59))) for i in range(10)]
    docs = []
    for d in range(2000):
        passage = items[d % 10][1].split()
        for at in (0, 1, 2, -3, -2, -1):
            passage[at] = f"d{rng.randrange(10**6)}"
        docs.append((d, " ".join(passage)))
    left, right = frames(spark, docs, items)
    found = decontaminate.find_leaks(left, right).collect()
    assert len(found) == 2000 and all(r.item_id == r.doc_id % 10 for r in found)
    assert max(r.differing_bits for r in found) > 16


def test_edge_rows(spark):
    item = "one two three four five six seven"
    loop = "tick " * 30
    items = [(1, item), (2, None), (3, ""), (4, "too short text"), (5, loop), (None, item), (1, item)]
    docs = [(1, None), (2, ""), (3, item), (3, item), (None, f"before {item} after"), (4, "one two three four five six"), (6, loop * 50), (7, "a " * 40000 + item), (8, "one two three four five eight")]
    left, right = frames(spark, docs, items)
    assert got(decontaminate.find_leaks(left, right)) == plain(docs, items)
    assert decontaminate.find_leaks(left.limit(0), right).count() == 0
    assert decontaminate.find_leaks(left, right.limit(0)).count() == 0


def test_blocks_cover_the_fingerprint(spark):
    rows = spark.range(1).select(F.explode(decontaminate._blocks(F.lit(-1).cast("long"), 16)).alias("b")).select("b.*").collect()
    assert sum(r["value"].bit_count() for r in rows) == 64 and len(rows) == 17


def test_no_python_in_the_plan(spark):
    left, right = frames(spark, [(1, "one two three four five six")], [(1, "one two three four five six")])
    plan = decontaminate.find_leaks(left, right)._jdf.queryExecution().toString()
    assert not any(name in plan for name in ("Python", "Arrow", "Pandas"))


def test_query_against_all_windows(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    want = plain(docs, items)
    assert got(QUERIES["op10_benchmark_leaks"](spark, SMALL)) == want and want


def test_plans_do_not_carry_the_table(spark, monkeypatch):
    """Half a million slots stay out of the text of every plan, and out of the rows."""
    plans = []

    def noted(df, label, old=decontaminate.materialize):
        plans.append(df._jdf.queryExecution().toString())
        return old(df, label)

    monkeypatch.setattr(decontaminate, "materialize", noted)
    text = "one two three four five six seven"
    docs = spark.createDataFrame([(1, f"zero {text} eight"), (2, "nothing of it"), (3, None)], "doc_id long, text string")
    items = spark.createDataFrame([(7, text)], "item_id long, text string")
    assert [(r.doc_id, r.item_id) for r in decontaminate.find_leaks(docs, items).collect()] == [(1, 7)]
    assert plans and max(map(len, plans)) < 100_000
    assert any("substring(Subquery" in plan for plan in plans) and not any(" AS slots" in plan.split("== Physical Plan ==")[1] for plan in plans)
