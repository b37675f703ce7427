"""Token counts of whole texts by a given tokenizer file.

Texts are counted in Arrow batches, and only counts leave the task. A batch is taken in shares of about equal bytes.
Where the vocabulary allows it, texts are split at safe boundaries: places no token can span, so that the counts of
the parts add up to the count of the whole. Parts that occur more than once in a share are encoded once, and a
bounded memory carries counts from share to share; it holds results only, so a restarted task gives the same counts.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SHARE_BYTES = 4 << 20
REMEMBERED = 400_000
REMEMBERED_LENGTH = 64

SPACE = "▁"  # how sentencepiece writes a space; a text that holds this sign means a space by it
_BETWEEN_WORDS = re.compile(rf"(?<=[^ {SPACE}]) (?=[^ {SPACE}])")
_BEFORE_SPACE = re.compile(r"(?<=\S)(?= )")

Split = Callable[[str], list[str]]
Count = Callable[[list[str]], list[int]]


def split_words(text: str) -> list[str]:
    """Cut at single spaces between words and drop those spaces, as every part gets a leading space of its own."""
    if "  " in text or SPACE in text or text[:1] == " " or text[-1:] == " ":
        return _BETWEEN_WORDS.split(text)
    return text.split(" ")


def split_before_spaces(text: str) -> list[str]:
    return _BEFORE_SPACE.split(text)


def whole(text: str) -> list[str]:
    return [text]


def _sentencepiece(path: str) -> tuple[Split, Count]:
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = (model.id_to_piece(i) for i in range(model.get_piece_size()))
    # safe when no piece goes on with a space after another sign, and spaces are kept and put before the text
    spanning = any(SPACE in piece.lstrip(SPACE) for piece in pieces)
    kept = model.encode("a b") == model.encode("a") + model.encode("b") and model.encode("a  b") != model.encode("a b")

    def count(texts: list[str]) -> list[int]:
        return [len(ids) for ids in model.encode(texts, num_threads=1)]

    return (split_words if kept and not spanning else whole), count


def _tokenizers(path: str) -> tuple[Split, Count]:
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    steps = spec.get("pre_tokenizer") or {}
    byte_level = steps.get("type") == "ByteLevel" and not steps.get("add_prefix_space") and steps.get("use_regex", True)
    # no pre-token has a space after another sign, unless texts are rewritten first or special strings may hold one
    plain = not spec.get("normalizer") and not any(" " in t["content"] or t.get("rstrip") or t.get("lstrip") for t in spec["added_tokens"])

    def count(texts: list[str]) -> list[int]:
        return [len(e.ids) for e in tokenizer.encode_batch(texts, add_special_tokens=False)]

    return (split_before_spaces if byte_level and plain else whole), count


@lru_cache(maxsize=4)
def tokenizer(path: str) -> tuple[Split, Count]:
    return _tokenizers(path) if path.endswith(".json") else _sentencepiece(path)


def _shares(texts: Iterable[str]) -> Iterator[list[str]]:
    share, size = [], 0
    for text in texts:
        if share and size + len(text) > SHARE_BYTES:
            yield share
            share, size = [], 0
        share.append(text)
        size += len(text)
    if share:
        yield share


def counts(texts: Iterable[str], path: str, known: dict[str, int] | None = None) -> Iterator[int]:
    split, count = tokenizer(path)
    known = {} if known is None else known
    for share in _shares(texts):
        parts = [split(text) if text else [] for text in share]
        fresh = list({part for each in parts for part in each if part not in known})
        for batch in _shares(fresh):
            known.update(zip(batch, count(batch)))
        for each in parts:
            yield sum(map(known.__getitem__, each))
        if len(known) > REMEMBERED or sum(map(len, fresh)) > SHARE_BYTES // 2:
            short = [part for part in known if len(part) <= REMEMBERED_LENGTH] if len(known) <= REMEMBERED else []
            kept = {part: known[part] for part in short}
            known.clear()
            known.update(kept)


def count_tokens(docs: DataFrame, path: str, limit: int = 4096) -> DataFrame:
    """``doc_id``, ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit`` of every row of ``docs``.

    ``path`` names a ``.model`` file (sentencepiece) or a ``.json`` file (tokenizers) that every executor can open. No
    begin, end or added special tokens, no truncation, no padding; special strings inside a text are treated as the
    library does by default. A null text counts as empty: no bytes, no tokens. Rows with a null id and repeated rows
    are answered like any other. An empty table gives an empty result; other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, int] = {}
        for batch in batches:
            found = list(counts((text.as_py() or "" for text in batch.column(2)), path, known))
            columns = [batch.column(0), batch.column(1), pa.array(found, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_bytes", "n_tokens"])

    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    chosen = docs.select(F.col("doc_id").cast("long"), F.octet_length(text).cast("long").alias("n_bytes"), text)
    counted = chosen.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
