import random

import pytest
import sentencepiece
from tokenizers import Tokenizer

from silverlode.llm import tokens
from silverlode.llm.registry import QUERIES, tokenizer_path

SMALL = "/root/testdata/sf0.001"
PIECES = tokenizer_path("piece_bpe_32k.model")
ALPHABET = ["a", "the", " ", "  ", "\n", "\t", "é", "▁", "1", "42", ".", "🙂", "<s>", "</s>", "　", "中", "\x00", "<unk>", " x", "ing", " "]


def plain(texts):
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    return [len(model.encode(text)) for text in texts]


def random_texts(count, seed):
    rng = random.Random(seed)
    return ["".join(rng.choices(ALPHABET, k=rng.randint(0, 40))) for _ in range(count)]


def test_split_parts_add_up():
    texts = random_texts(3000, 1) + ["", " ", "  ", " a", "a ", "a" * 5000, "x y " * 4000, "▁ ▁a b▁ c"]
    assert list(tokens.counts(texts, PIECES)) == plain(texts)


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_json_tokenizers(name):
    path = tokenizer_path(name)
    tokenizer = Tokenizer.from_file(path)
    texts = random_texts(1000, 2) + ["<|endoftext|> a b<|endoftext|>", "a " * 3000]
    assert list(tokens.counts(texts, path)) == [len(tokenizer.encode(t, add_special_tokens=False).ids) for t in texts]


def test_shares_forget_but_agree(monkeypatch):
    monkeypatch.setattr(tokens, "SHARE_BYTES", 200)
    monkeypatch.setattr(tokens, "REMEMBERED", 20)
    texts = random_texts(400, 3)
    assert list(tokens.counts(texts, PIECES)) == plain(texts)


def test_edge_rows(spark):
    rows = [(1, None), (2, ""), (None, "a b"), (4, "a b"), (4, "a b"), (5, "word " * 5000)]
    df = spark.createDataFrame([(d, t, 7, True) for d, t in rows], "doc_id long, text string, n_tokens int, over_limit boolean")
    got = tokens.count_tokens(df, PIECES).collect()
    want = {(d, len((t or "").encode()), n, n > 4096) for (d, t), n in zip(rows, plain([t or "" for _, t in rows]))}
    assert {tuple(r) for r in got} == want and len(got) == len(rows)
    assert tokens.count_tokens(df.limit(0), PIECES).count() == 0


def test_query_against_whole_texts(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    got = {r.doc_id: r.n_tokens for r in QUERIES["op8_token_counts"](spark, SMALL).collect()}
    assert got == dict(zip(docs, plain(docs.values())))
