import random
from collections import defaultdict

import pytest

import corpus_pipeline as pipeline
from silverlode.llm import pii, simhash
from test_decontaminate import plain as plain_leaks
from test_overlap import plain as plain_groups
from test_packing import check_rows

SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def frame(spark, rows):
    return spark.createDataFrame([(d, t, l, "s", len(t or "")) for d, t, l in rows], SCHEMA)


@pytest.fixture(scope="module")
def stages(spark):
    """Every stage's input and output over the small tables."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    out = [docs]
    for _, stage in pipeline.STAGES:
        out.append(pipeline.materialize(stage(spark, out[-1], SMALL), "stage"))
    return out


def rows(df):
    return {r.doc_id: r for r in df.collect()}


def test_all_but_the_last_keep_the_columns(stages):
    for df in stages[1:-1]:
        assert df.columns == stages[0].columns and dict(df.dtypes) == dict(stages[0].dtypes)


def test_language_keeps_what_has_a_language(stages):
    before, after = rows(stages[0]), rows(stages[1])
    gone = set(before) - set(after)
    assert len(gone) <= len(before) * 0.02
    assert {d for d, r in before.items() if not any(c.isalpha() for c in r.text)} <= gone


def test_one_of_each_group_stays(stages):
    before = rows(stages[1])
    assert set(rows(stages[2])) == set(plain_groups([(d, r.text) for d, r in before.items()]).values())


def test_leaks_go(spark, stages):
    before = rows(stages[2])
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    leaks = {d for d, _, _ in plain_leaks([(d, r.text) for d, r in before.items()], items)}
    assert set(rows(stages[3])) == set(before) - leaks and leaks


def test_personal_data_is_masked_and_the_rest_kept(stages):
    before, after = rows(stages[3]), rows(stages[4])
    assert set(before) == set(after)
    changed = 0
    for d, r in after.items():
        assert not pii.base_spans(r.text) and r.n_chars == len(r.text)
        changed += r.text != before[d].text
        if not pii.base_spans(before[d].text) and not pii.segments(before[d].text):
            assert r.text == before[d].text
    assert changed


def test_packing_holds_every_token(stages):
    lengths = {d: [len(r.text.split()) + 1] for d, r in rows(stages[4]).items()}
    check_rows(stages[5].collect(), lengths, (1024, 2048, 4096, 8192))


def test_run_gives_the_last_stage(spark, stages):
    got, want = pipeline.run(spark, SMALL), stages[-1]
    assert got.columns == want.columns and got.count() == want.count()


def test_odd_rows_do_not_break_a_stage(spark):
    rng = random.Random(1)
    words = "and the of with for that this is to be in on".split()
    text = lambda: " ".join(rng.choices(words, k=60))
    copy = text()
    odd = [(1, None, None), (1, None, None), (2, "", "en"), (None, "1 2 3", "en"), (None, copy, "en"), (7, copy, "en"), (7, copy, "en"), (9, copy, None)]
    docs = frame(spark, odd + [(20 + k, text(), "en") for k in range(20)] + [(50, text() * 500, "en"), (None, text(), "en")])
    for _, stage in pipeline.STAGES:
        assert stage(spark, docs.limit(0), SMALL).count() == 0
        stage(spark, docs, SMALL).count()
    kept = pipeline.drop_near_duplicates(spark, docs, SMALL).collect()
    assert [r.doc_id for r in kept if r.text == copy] == [7]
    assert len([r for r in kept if not (r.text or "").split()]) == 1
    known = pipeline.identify_language(spark, docs, SMALL).collect()
    assert all(r.text and any(c.isalpha() for c in r.text) for r in known) and sum(r.text == copy for r in known) == 4


def test_of_repeated_rows_the_same_one_stays_and_names_may_clash(spark):
    rng = random.Random(2)
    texts = [" ".join(rng.choices("abcdefghijklmnop", k=40)) for _ in range(6)]
    rows = [(i, t, "en", source, 1, i, t, True) for i, t in enumerate(texts) for source in ("b", "a", "c")]
    names = "doc_id long, text string, lang string, source string, key long, component long, doc string, answer boolean"
    docs = spark.createDataFrame(rows, names).repartition(7)
    for name, stage in pipeline.STAGES[:-1]:
        assert stage(spark, docs, SMALL).columns == docs.columns, name
    for order in (docs, docs.orderBy("source")):
        kept = pipeline.drop_near_duplicates(spark, order, SMALL).collect()
        assert sorted((r.doc_id, r.source) for r in kept) == [(i, "a") for i in range(6)]


def test_junk_of_letters_has_no_language(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    junk = ["xqzj kjw vbnm qwpx zzk jjq", "zzzzzz kkkk", "asdf jkl qwer uiop", "lkjh gfds mnbv poiu ytre wqas", "日本語のテキスト"]
    junk_rows = spark.createDataFrame([(10**9 + i, text, None, "s", len(text)) for i, text in enumerate(junk)], SCHEMA)
    kept = pipeline.identify_language(spark, docs.unionByName(junk_rows), SMALL)
    assert kept.where(f"doc_id >= {10**9}").isEmpty()
    before = docs.where("text RLIKE '(?U)[[:alpha:]]{3,}' AND length(text) > 200").count()
    assert kept.where("length(text) > 200").count() >= 0.995 * before
