"""Text quality by compression: how much better a text fits a dictionary of good texts than one of bad texts.

Two zstandard dictionaries are built, from good and from bad labelled texts. A text is compressed with either, in
pieces of about a kilobyte so that the dictionary, not what the text said before, decides. The difference of the two
sizes, per byte of text, is the raw score. A logistic curve over it, fitted on labelled rows that did not enter the
dictionaries, makes it a probability of good quality.

Learning uses a bounded sample: about ``per_class`` labelled rows of each class, by a hash of the id; three in four build
the dictionaries, one in four fits the curve. Texts of sampled rows are taken whole: the executors cut them into pieces, of
which about ``pieces_per_class`` of each class, by a hash of the piece, make a dictionary, so that every part of a text is as
likely to teach; differences for the curve are computed there too. Scoring compresses every text whole.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scratch import materialize
from .langid import sample

PIECE = 1024
LEVEL = 3
DICTIONARY_BYTES = 110_000
LEAST_SAMPLES = 8


def pieces(raw: bytes) -> list[bytes]:
    return [raw[at : at + PIECE] for at in range(0, len(raw), PIECE)]


def build_dictionary(parts: list[bytes]) -> bytes:
    """A dictionary from pieces of texts; the pieces themselves where they are too few to train one."""
    size = min(DICTIONARY_BYTES, max(256, sum(map(len, parts)) // 8))
    try:
        return zstandard.train_dictionary(size, parts).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"".join(parts)[:size]


def compressor(dictionary: bytes) -> zstandard.ZstdCompressor | None:
    if len(dictionary) < LEAST_SAMPLES:
        return None
    kept = zstandard.ZstdCompressionDict(dictionary)
    kept.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=kept, write_content_size=False, write_dict_id=False)


@dataclass
class Model:
    good: bytes
    bad: bytes
    slope: float = 0.0
    offset: float = 0.0

    def score(self, difference: float) -> float:
        power = self.slope * difference + self.offset
        return 1 / (1 + math.exp(-power)) if power > -700 else 0.0


def difference(text: str | None, good, bad) -> float:
    """Size under the bad dictionary less size under the good one, per byte; 0 for an empty text."""
    raw = text.encode() if text else b""
    if not raw or good is None or bad is None:
        return 0.0
    return sum(len(bad.compress(p)) - len(good.compress(p)) for p in pieces(raw)) / len(raw)


def fit_curve(differences: np.ndarray, labels: np.ndarray, rounds: int = 100) -> tuple[float, float]:
    """Slope and offset of the logistic curve, by Newton steps with a weak penalty; targets kept off 0 and 1."""
    ones, zeros = labels.sum(), (1 - labels).sum()
    targets = np.where(labels == 1, (ones + 1) / (ones + 2), 1 / (zeros + 2))
    scale = max(1e-9, float(np.abs(differences).max(initial=0)))
    inputs = np.stack([differences / scale, np.ones(len(differences))], axis=1)
    weights = np.zeros(2)
    for _ in range(rounds):
        chances = 1 / (1 + np.exp(-np.clip(inputs @ weights, -500, 500)))
        slope = inputs.T @ (chances - targets) + 1e-3 * weights
        curve = (inputs * (chances * (1 - chances))[:, None]).T @ inputs + 1e-3 * np.eye(2)
        step = np.linalg.solve(curve, slope)
        weights = weights - step * min(1.0, 5 / max(1e-12, float(np.abs(step).max())))
        if np.abs(step).max() < 1e-9:
            break
    return float(max(0.0, weights[0]) / scale), float(weights[1])


def calibrate(model: Model, rows: list[tuple[float, int]]) -> None:
    """Fit the curve of the model to (difference, quality) of rows that are in no dictionary."""
    if rows:
        differences, labels = (np.array(c) for c in zip(*sorted(rows)))
        model.slope, model.offset = fit_curve(differences, labels)


def place_of(*columns: str) -> Column:
    """A hash of the columns, from 0 to 1."""
    return F.pmod(F.xxhash64(*columns, F.lit(7)), F.lit(1 << 40)) / float(1 << 40)


def sampled_pieces(rows: DataFrame, most: int) -> dict[int, list[bytes]]:
    """About ``most`` pieces of the texts of each class, never above twice that, by a hash of row and piece."""
    raw = rows.select("doc_id", "quality", F.col("text").cast("binary").alias("raw")).where(F.octet_length("raw") > 0)
    count = F.ceil(F.octet_length("raw") / PIECE).cast("int")
    sizes = {r.quality: r.pieces for r in raw.groupBy("quality").agg(F.sum(count).alias("pieces")).collect()}
    cut = F.transform(F.sequence(F.lit(0), count - 1), lambda k: F.substring(F.col("raw"), k * PIECE + 1, F.lit(PIECE)))
    every = raw.select("doc_id", "quality", F.posexplode(cut).alias("k", "piece"))
    out: dict[int, list[bytes]] = {0: [], 1: []}
    for label, total in sizes.items():
        place = place_of("doc_id", "k", "piece")
        chosen = every.where((F.col("quality") == label) & (place < min(1.0, most / total)))
        out[label] = [bytes(r.piece) for r in chosen.orderBy(place, "piece").limit(2 * most).select("piece").collect()]
    return out


def _difference_of(model: Model, text: Column, spark) -> Column:
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def measure(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        good, bad = compressor(shared.value.good), compressor(shared.value.bad)
        for texts in batches:
            yield pd.Series([difference(one, good, bad) for one in texts], dtype="float64")

    return measure.asNondeterministic()(text)


def train(docs: DataFrame, labels: DataFrame, per_class: int = 3000, pieces_per_class: int = 12_000) -> Model:
    """Learn from rows of ``labels`` with quality 0 or 1 whose document is in ``docs``; null texts teach nothing."""
    known = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
    chosen = sample(known.select("doc_id", F.col("quality").cast("int").alias("quality")).distinct(), "quality", per_class)
    rows = (
        docs.where(F.col("text").isNotNull())
        .select("doc_id", F.col("text").cast("string").alias("text"))
        .join(F.broadcast(chosen), "doc_id")  # at most 4 * per_class rows
    )
    rows = materialize(rows, "quality-sample")
    curve = place_of("doc_id") < 0.25
    pieces_of = sampled_pieces(rows.where(~curve), pieces_per_class)
    model = Model(build_dictionary(pieces_of[1]), build_dictionary(pieces_of[0]))
    # repeated documents could make many rows of one id: then the first by hash and content
    checked = rows.where(curve).orderBy(place_of("doc_id"), F.xxhash64("text"), "quality").limit(4 * per_class)
    measured = checked.select("quality", _difference_of(model, F.col("text"), docs.sparkSession).alias("difference")).collect()
    calibrate(model, [(r.difference, r.quality) for r in measured])
    # the sample evens out the classes; the curve is moved back to how often each occurs
    all_rows = {r.quality: r["count"] for r in known.groupBy("quality").count().collect()}
    drawn = {label: sum(r.quality == label for r in measured) for label in (0, 1)}
    if all(drawn.values()):
        model.offset += math.log(all_rows[1] / all_rows[0]) - math.log(drawn[1] / drawn[0])
    return model


def score_texts(docs: DataFrame, model: Model, held_out: Column, threshold: float = 0.7) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` (0 to 1) and ``predicted`` (1 from ``threshold`` on) of every row of ``docs``.

    A null or empty text has difference 0 and the score the curve gives to that. Null ids and repeated rows are
    answered like any other; without labelled rows every score is 0.5. An empty table gives an empty result; other
    columns are ignored.
    """
    measured = _difference_of(model, F.col("text").cast("string"), docs.sparkSession)
    power = F.col("difference") * model.slope + model.offset
    score = F.when(power > -700, 1 / (1 + F.exp(-power))).otherwise(0.0)
    scored = docs.select(F.col("doc_id").cast("long"), held_out.alias("held_out"), measured.alias("difference"))
    scored = scored.select("doc_id", "held_out", score.alias("score"))
    return scored.withColumn("predicted", F.when(F.col("score") >= threshold, 1).otherwise(0))
