import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from silverlode.llm import langid
from silverlode.llm.registry import QUERIES

SMALL = "/root/testdata/sf0.01"
SYLLABLES = {"aa": "ka lo mi tu ra".split(), "bb": "sch ung ei ver ch".split(), "cc": "ción os ñe ue rr".split()}


def text(rng, lang, words=40):
    return " ".join("".join(rng.choices(SYLLABLES[lang], k=rng.randint(1, 3))) for _ in range(words))


def test_counts_do_not_depend_on_parts(monkeypatch):
    rng = random.Random(1)
    for sample in ["a", "  Ab  c, d!", "é1é", "…", "", None] + [text(rng, "cc", 200) for _ in range(3)]:
        monkeypatch.setattr(langid, "PART", 1 << 20)
        whole = langid.ngram_counts(sample)
        for part in (1, 2, 7):
            monkeypatch.setattr(langid, "PART", part)
            cut = langid.ngram_counts(sample)
            assert np.array_equal(whole[0], cut[0]) and np.array_equal(whole[1], cut[1])


def test_counts_against_a_plain_count():
    places, found = langid.ngram_counts("Ab, a")  # " ab a" after the leading space: 5 single signs, 4 pairs, 3 triples
    assert found.sum() == 5 - 1 + 4 + 3


def test_learns_and_is_sparse():
    rng = random.Random(2)
    rows = [(lang, *langid.ngram_counts(text(rng, lang))) for lang in SYLLABLES for _ in range(60)]
    rng.shuffle(rows)
    model = langid.fit(rows)
    assert all(model.predict(text(rng, lang))[0] == lang for lang in SYLLABLES for _ in range(30))
    assert (model.weights == 0).mean() > 0.9
    assert model.predict(None) == model.predict("12 -- 3") == ("und", 0.0)


def test_edge_rows(spark):
    rng = random.Random(3)
    rows = [(i, text(rng, lang), lang) for lang in ("aa", "bb") for i in range(30)]
    rows += [(None, text(rng, "aa"), "aa"), (1, "no label", None), (2, None, "aa"), (3, "", "bb")]
    df = spark.createDataFrame([(d, t, l, 1.0, "z") for d, t, l in rows], "doc_id long, text string, lang string, score double, lang_pred string")
    model = langid.train(df)
    assert model.languages == ["aa", "bb"]
    odd = [(1, None), (1, None), (None, "1 2 3"), (5, text(rng, "bb", 30000)), (6, "k")]
    asked = spark.createDataFrame([(d, t, "q") for d, t in odd], "doc_id long, text string, lang string")
    out = langid.identify(asked, model, F.lit(True)).collect()
    assert [r.lang_pred for r in out][:4] == ["und", "und", "und", "bb"] and out[4].lang_pred in model.languages
    assert all(0 <= r.score <= 1 for r in out)
    assert langid.identify(asked.limit(0), model, F.lit(False)).count() == 0
    untaught = langid.train(df.limit(0))
    assert {r.lang_pred for r in langid.identify(asked, untaught, F.lit(True)).collect()} == {"und"}


@pytest.mark.parametrize("folder", [SMALL])
def test_query_held_out_accuracy(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang")
    out = QUERIES["op7_language_id"](spark, folder)
    assert out.count() == docs.count()
    right = out.join(docs, "doc_id").where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right > 0.97


def test_temperature_follows_the_answers():
    rng = np.random.default_rng(2)
    truth = rng.integers(0, 3, 4000)
    logits = rng.normal(size=(4000, 3))
    for temperature in (0.5, 1.0, 4.0):
        chances = langid.softmax(logits / temperature)
        drawn = (chances.cumsum(axis=1) < rng.random((4000, 1))).sum(axis=1)
        assert abs(np.log(langid.best_temperature(logits, drawn) / temperature)) < 0.25
    sure = np.eye(3)[truth] * 5  # no mistake among them
    found = langid.best_temperature(sure, truth)
    assert 0.1 < found < 5 and langid.softmax(sure / found).max() < 1 - 1e-5
    assert langid.best_temperature(sure[:10], truth[:10]) > found  # fewer texts can show less


def test_held_out_scores_are_calibrated(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    answers = QUERIES["op7_language_id"](spark, "/root/testdata/sf0.1").where("held_out").join(docs.select("doc_id", "lang"), "doc_id")
    rows = [(r.score, r.lang == r.lang_pred) for r in answers.where("lang IS NOT NULL AND lang_pred <> 'und'").select("score", "lang", "lang_pred").collect()]
    scores, right = np.array([s for s, _ in rows]), np.array([r for _, r in rows])
    assert right.mean() > 0.99 and abs(scores.mean() - right.mean()) < 0.02
    assert np.quantile(scores, 0.01) < 0.999


def test_too_many_labels_are_refused(frame):
    docs = frame([(i, f"text {i}", f"l{i}") for i in range(30)], "doc_id long, text string, lang string")
    with pytest.raises(ValueError):
        langid.sample(docs, "lang", 5, labels=20)


def test_the_same_rows_teach_however_they_are_dealt(frame):
    docs = frame([(1, f"text {i}", "en") for i in range(300)], "doc_id long, text string, lang string")
    chosen = [sorted(r.text for r in langid.sample(docs.repartition(n), "lang", 10).collect()) for n in (1, 7)]
    assert chosen[0] == chosen[1]
