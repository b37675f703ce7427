"""Language of a text: sparse multinomial logistic regression on TF-IDF character n-grams.

A text is lower-cased, everything but letters becomes one space, and all runs of one to three signs are counted in
hashed buckets. Weights are 1 + log of the count, times the inverse document frequency in the training sample, to
length 1. Follow-the-regularised-leader with an L1 and an L2 penalty trains one weight column per language; the L1
penalty leaves most weights at zero. A last share of the sample sets the temperature that makes the largest probability
an honest one.

The model is trained on the driver from a bounded sample: about ``per_language`` labelled rows of each language, chosen
by a hash of the id. Executors turn the sampled texts into counts, so the driver receives at most ``BUCKETS`` numbers a
row. Scoring reads every text whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 1 << 16
LONGEST = 3
PART = 1 << 20
UNKNOWN = "und"
_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], dtype=np.uint64)  # odd, well mixed


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)


def ngram_counts(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Buckets that occur, and how often; none if the text has no letter. Long texts are taken part by part."""
    totals = np.zeros(BUCKETS, dtype=np.int64)
    space, found = np.uint32(32), False
    tail = np.array([space], dtype=np.uint32)
    text = text or ""
    for at in range(0, len(text), PART):
        signs = np.frombuffer(text[at : at + PART].lower().encode("utf-32-le", "replace"), dtype=np.uint32)
        is_letter = _letters()[signs]
        found = found or bool(is_letter.any())
        signs = np.where(is_letter, signs, space)
        before = np.concatenate([tail[-1:], signs[:-1]])
        signs = signs[(signs != space) | (before != space)]
        joined = np.concatenate([tail, signs])
        codes = joined.astype(np.uint64)
        mixed = np.zeros(len(codes), dtype=np.uint64)
        for n in range(1, LONGEST + 1):  # mixed[i] covers the n signs that begin at i
            size = len(codes) - n + 1
            if size <= 0:
                break
            mixed = (mixed[:size] + codes[n - 1 :]) * _FACTORS[n - 1]
            mixed ^= mixed >> np.uint64(29)
            fresh = max(0, len(tail) - n + 1)  # runs that end in the tail were counted with the part before
            totals += np.bincount((mixed[fresh:] >> np.uint64(13)).astype(np.int64) & (BUCKETS - 1), minlength=BUCKETS)
        tail = joined[-(LONGEST - 1) :]
    if not found:
        totals[:] = 0
    places = np.flatnonzero(totals)
    return places, totals[places]


@dataclass
class Model:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray  # a row per bucket, a column per language; the last row is the intercept
    temperature: float

    def vector(self, places: np.ndarray, found: np.ndarray) -> np.ndarray:
        values = (1 + np.log(found)) * self.idf[places]
        return values / max(1e-12, float(np.sqrt(values @ values)))

    def logits(self, places: np.ndarray, found: np.ndarray) -> np.ndarray:
        return self.vector(places, found) @ self.weights[places] + self.weights[-1]

    def predict(self, text: str | None) -> tuple[str, float]:
        places, found = ngram_counts(text)
        if not len(places) or not self.languages:
            return UNKNOWN, 0.0
        chances = softmax(self.logits(places, found) / self.temperature)
        best = int(np.argmax(chances))
        return self.languages[best], float(min(1.0, chances[best]))


def softmax(logits: np.ndarray) -> np.ndarray:
    raised = np.exp(logits - logits.max(axis=-1, keepdims=True))
    return raised / raised.sum(axis=-1, keepdims=True)


def best_temperature(logits: np.ndarray, truth: np.ndarray) -> float:
    """The temperature of least cross entropy.

    As if one more text had each language at even chances, the target of a text's own language is a little below 1: where
    all texts are right, ever lower temperatures would otherwise win, and scores would claim what so few texts cannot show.
    """
    share = 1 / (len(truth) + 2)
    target = np.full(logits.shape, share / max(1, logits.shape[1] - 1))
    target[np.arange(len(truth)), truth] = 1 - share

    def loss(log_t: float) -> float:
        scaled = logits / np.exp(log_t)
        scaled = scaled - scaled.max(axis=1, keepdims=True)
        return -(target * (scaled - np.log(np.exp(scaled).sum(axis=1, keepdims=True)))).sum(axis=1).mean()

    low, high = -8.0, 8.0
    for _ in range(100):  # the loss is convex in 1 / temperature, so it has one valley
        a, b = low + (high - low) / 3, high - (high - low) / 3
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def fit(
    rows: list[tuple[str, np.ndarray, np.ndarray]],
    epochs: int = 3,
    rate: float = 2.0,
    l1: float = 0.02,
    l2: float = 0.02,
    held_for_temperature: float = 0.2,
    seed: int = 11,
) -> Model:
    """Train from (language, buckets, counts). Rows without a letter teach nothing."""
    rows = [row for row in rows if len(row[1])]
    languages = sorted({row[0] for row in rows})
    model = Model(languages, np.zeros(BUCKETS), np.zeros((BUCKETS + 1, len(languages))), 1.0)
    if not rows:
        return model
    seen = np.zeros(BUCKETS)
    for _, places, _ in rows:
        seen[places] += 1
    model.idf = np.log((1 + len(rows)) / (1 + seen)) + 1
    order = np.random.default_rng(seed).permutation(len(rows))
    cut = max(1, int(len(rows) * (1 - held_for_temperature)))
    learn, check = order[:cut], order[cut:]
    number = {name: k for k, name in enumerate(languages)}
    pulls, squares = np.zeros_like(model.weights), np.zeros_like(model.weights)

    def current(at: np.ndarray) -> np.ndarray:
        pull = pulls[at]
        steps = (1 + np.sqrt(squares[at])) / rate + l2
        return np.where(np.abs(pull) > l1, (np.sign(pull) * l1 - pull) / steps, 0.0)

    for _ in range(epochs):
        for r in learn:
            name, places, found = rows[r]
            at, values = np.append(places, BUCKETS), np.append(model.vector(places, found), 1.0)
            weights = current(at)
            error = softmax(values @ weights)
            error[number[name]] -= 1
            slope = values[:, None] * error
            power = squares[at]
            pulls[at] += slope - (np.sqrt(power + slope * slope) - np.sqrt(power)) / rate * weights
            squares[at] = power + slope * slope
    model.weights = current(np.arange(BUCKETS + 1))
    if len(check):
        logits = np.array([model.logits(*rows[r][1:]) for r in check])
        truth = np.array([number[rows[r][0]] for r in check])
        model.temperature = best_temperature(logits, truth)
    return model


def sample(labelled: DataFrame, label: str, per_label: int, labels: int = 1000) -> DataFrame:
    """About ``per_label`` rows of each label, by a hash of ``doc_id``; never above twice that for all labels together.

    More than ``labels`` different labels are refused, as a model of so many has another size than was planned for.
    """
    sizes = {r[0]: r[1] for r in labelled.groupBy(label).count().orderBy(F.desc("count"), label).limit(labels + 1).collect()}
    if len(sizes) > labels:
        raise ValueError(f"more than {labels} different values of {label}")
    rate = F.lit(0.0)
    for name, count in sizes.items():
        rate = F.when(F.col(label) == name, min(1.0, per_label / count)).otherwise(rate)
    place = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit(5)), F.lit(1 << 40)) / float(1 << 40)
    chosen = labelled.where(place < rate)
    # rows of one hash, such as repeated ones, could still be too many: then the first by hash and content
    most = 2 * per_label * max(1, len(sizes))
    return chosen.orderBy(place, "doc_id", F.xxhash64(*[F.col(name) for name in labelled.columns])).limit(most)


def train(labelled: DataFrame, per_language: int = 1000) -> Model:
    """Train on ``labelled`` (``doc_id``, ``text``, ``lang``). Rows with a null language are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                found = [ngram_counts(text.as_py()) for text in part.column(1)]
                arrays = [part.column(0)] + [pa.array([f[k].tolist() for f in found], pa.list_(pa.int32())) for k in (0, 1)]
                yield pa.RecordBatch.from_arrays(arrays, ["lang", "places", "found"])

    chosen = sample(labelled.where(F.col("lang").isNotNull()).select("doc_id", "text", "lang"), "lang", per_language)
    counted = chosen.select(F.col("lang").cast("string"), F.col("text").cast("string")).mapInArrow(
        run, "lang string, places array<int>, found array<int>"
    )
    rows = []
    for batch in counted.toArrow().to_batches():
        for lang, places, found in zip(*batch.columns):
            # views of the received buffers, not copies
            rows.append((lang.as_py(), places.values.to_numpy(), found.values.to_numpy()))
    rows.sort(key=lambda row: (row[0], len(row[1]), row[1].tobytes(), row[2].tobytes()))  # order of tasks must not matter
    return fit(rows)


def predictor(docs: DataFrame, model: Model):
    """A function from a text column to a struct (lang_pred, score), for any query of the session of ``docs``."""
    used = np.flatnonzero(model.weights.any(axis=1))
    slim = docs.sparkSession.sparkContext.broadcast(
        (model.languages, model.idf, used, model.weights[used], model.weights.shape, model.temperature)
    )

    @F.pandas_udf("lang_pred string, score double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        languages, idf, rows, values, shape, temperature = slim.value
        weights = np.zeros(shape)
        weights[rows] = values
        known = Model(languages, idf, weights, temperature)
        for texts in batches:
            yield pd.DataFrame([known.predict(text) for text in texts], columns=["lang_pred", "score"])

    return predict.asNondeterministic()  # not to be moved and run twice by the optimiser


def identify(docs: DataFrame, model: Model, held_out: Column) -> DataFrame:
    """``doc_id``, ``held_out``, ``lang_pred`` and ``score`` of every row of ``docs``.

    A null text and a text without a letter are ``und`` with score 0, as is every text when nothing was there to learn
    from. Null ids and repeated rows are answered like any other; ties go to the language that sorts first. An empty
    table gives an empty result; other columns are ignored.
    """
    answer = predictor(docs, model)(F.col("text").cast("string"))
    return docs.select(F.col("doc_id").cast("long"), held_out.alias("held_out"), answer.alias("answer")).select(
        "doc_id", "held_out", "answer.lang_pred", "answer.score"
    )
