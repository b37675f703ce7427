import random

import numpy as np
from pyspark.sql import functions as F

from silverlode.llm import quality
from silverlode.llm.registry import QUERIES

SMALL = "/root/testdata/sf0.01"


def good(rng):
    return " ".join("".join(rng.choices("ka lo mi tu ra se".split(), k=rng.randint(1, 4))) for _ in range(60)) + "."


def bad(rng):
    return " ".join("".join(rng.choices("ka lo mi tu ra se".split(), k=2)).upper() + rng.choice(["!!", "***"]) for _ in range(60))


def test_curve_is_monotone_and_honest():
    rng = np.random.default_rng(1)
    differences = rng.normal(0, 1, 4000)
    labels = (rng.random(4000) < 1 / (1 + np.exp(-(2 * differences + 0.5)))).astype(int)
    slope, offset = quality.fit_curve(differences, labels)
    assert abs(slope - 2) < 0.2 and abs(offset - 0.5) < 0.2
    assert quality.fit_curve(np.zeros(4), np.array([1, 1, 1, 0]))[0] >= 0


def test_separates_unseen_texts():
    rng = random.Random(1)
    rows = [(make(rng), label) for _ in range(120) for make, label in ((good, 1), (bad, 0))]
    parts = [[p for text, label in rows[:180] if label == wanted for p in quality.pieces(text.encode())] for wanted in (1, 0)]
    model = quality.Model(*map(quality.build_dictionary, parts))
    sides = quality.compressor(model.good), quality.compressor(model.bad)
    quality.calibrate(model, [(quality.difference(text, *sides), label) for text, label in rows[180:]])
    scores = [(model.score(quality.difference(make(rng), *sides)), label) for _ in range(50) for make, label in ((good, 1), (bad, 0))]
    assert all((score >= 0.7) == bool(label) for score, label in scores)


def test_edge_rows(spark):
    rng = random.Random(2)
    rows = [(i, good(rng) if i % 2 else bad(rng)) for i in range(80)]
    docs = spark.createDataFrame([(d, t, 0.1, 5) for d, t in rows], "doc_id long, text string, score double, quality int")
    marks = [(i, i % 2) for i in range(80)] + [(None, 1), (900, 1), (3, None), (4, 7), (5, 1)]
    labels = spark.createDataFrame([(d, q, "x") for d, q in marks], "doc_id long, quality int, text string")
    model = quality.train(docs, labels)
    odd = spark.createDataFrame([(1, None), (1, None), (None, ""), (7, " ".join(good(rng) for _ in range(300))), (8, " ".join(bad(rng) for _ in range(300)))], "doc_id long, text string")
    out = quality.score_texts(odd, model, F.lit(False)).collect()
    assert out[0].score == out[1].score == out[2].score and [r.predicted for r in out[3:]] == [1, 0]
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in out)
    assert quality.score_texts(odd.limit(0), model, F.lit(True)).count() == 0
    untaught = quality.train(docs, labels.limit(0))
    assert {r.score for r in quality.score_texts(odd, untaught, F.lit(True)).collect()} == {0.5}


def test_query_held_out_accuracy(spark):
    out = QUERIES["op3_compression_quality"](spark, SMALL)
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    assert out.count() == docs.count()
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    rows = out.where("held_out").join(labels, "doc_id").collect()
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.9


def test_all_of_a_long_text_can_teach(spark):
    long = "".join(f"{k:07d}|" for k in range(20_000)) + "é" * 700
    rows = spark.createDataFrame([(1, long, 1), (2, "short", 0), (2, "", 0), (3, None, 1)], "doc_id long, text string, quality int")
    every = quality.sampled_pieces(rows, 1000)
    assert sorted(every[1]) == sorted(quality.pieces(long.encode())) and every[0] == [b"short"]
    some = quality.sampled_pieces(rows, 40)[1]
    places = [int(p[:7]) for p in some if p[:7].isdigit()]
    assert 20 <= len(some) <= 80 and min(places) < 5_000 and max(places) > 15_000
    assert some == quality.sampled_pieces(rows.repartition(3), 40)[1]


def test_scores_against_one_by_one(spark):
    rng = random.Random(3)
    rows = [(i, good(rng) if i % 2 else bad(rng)) for i in range(200)]
    docs = spark.createDataFrame([*rows, (900, None), (901, "")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)], "doc_id long, quality int")
    model = quality.train(docs, labels)
    sides = quality.compressor(model.good), quality.compressor(model.bad)
    got = {r.doc_id: r.score for r in quality.score_texts(docs, model, F.lit(False)).collect()}
    for doc_id, text in [*rows, (900, None), (901, "")]:
        raw = (text or "").encode()
        parts = [raw[k : k + 1024] for k in range(0, len(raw), 1024)]
        gap = sum(len(sides[1].compress(p)) - len(sides[0].compress(p)) for p in parts) / max(1, len(raw))
        assert abs(got[doc_id] - 1 / (1 + np.exp(-(model.slope * gap + model.offset)))) < 1e-12
    # the model itself, from the rows the hash deals to dictionary and curve
    placed = {r.doc_id: r.place for r in docs.select("doc_id", quality.place_of("doc_id").alias("place")).collect()}
    inputs = [(quality.difference(t, *sides), i % 2) for i, t in rows if placed[i] < 0.25]
    plain = quality.Model(model.good, model.bad)
    quality.calibrate(plain, inputs)
    ones = sum(label for _, label in inputs)
    assert abs(plain.slope - model.slope) < 1e-9
    assert abs(plain.offset - np.log(ones / (len(inputs) - ones)) - model.offset) < 1e-9
