"""The store of annotator answers: every answer is kept under the hash of its prompt, and no answered prompt is paid again.

One task makes one call and writes its answers, which are committed to the store when the task ends, whatever becomes of
the job. So a lost executor costs the calls it was in the middle of, and a run that is started again asks only for what the
store does not hold. Answers that cannot be read, and calls that failed, are stored as well: a prompt is asked again until it
has had its attempts, and is a dead letter then.
"""

from __future__ import annotations

import time
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numbering import number_rows
from ..functions.scratch import materialize
from ..sources.csv import path_exists
from .annotate import Annotator, call_annotator, read_responses

ANSWER_SCHEMA = "request string, response string, error string, attempts int, answered_at timestamp"
# A call is a task and a small file; more calls than this are more than one job.
CALLS_PER_JOB = 10_000
# A list of this many requests, each with its batch and call, takes some 60 MB.
BROADCAST_REQUESTS = 500_000


@dataclass(frozen=True)
class Pace:
    """How fast and how often the annotator is called.

    ``calls_per_second`` is the rate of all tasks together, of which at most ``slots`` run at once; None sets no rate. A prompt
    without an answer is tried ``tries`` times in a task, after a wait that begins with ``first_wait`` seconds and doubles.
    """

    calls_per_second: float | None = None
    slots: int = 1
    tries: int = 1
    first_wait: float = 1.0
    longest_wait: float = 60.0

    def limited(self, annotator: Annotator) -> Annotator:
        """The annotator with a token bucket of one token: every call waits for its share of the rate of one slot."""
        if self.calls_per_second is None:
            return annotator
        interval = self.slots / self.calls_per_second
        ready = time.monotonic() + interval  # the task before in this slot may have called just now

        def call(prompts):
            nonlocal ready
            time.sleep(max(0.0, ready - time.monotonic()))
            ready = time.monotonic() + interval
            return annotator(prompts)

        return call

    def wait(self, after_try: int) -> float:
        return min(self.longest_wait, self.first_wait * 2 ** (after_try - 1))


def with_requests(prompts: DataFrame) -> DataFrame:
    """Add ``request``, the key an answer is stored under."""
    return prompts.withColumn("request", F.sha2("prompt", 256))


def read_answers(spark: SparkSession, path: str) -> DataFrame:
    if not path_exists(spark, path):
        return spark.createDataFrame([], ANSWER_SCHEMA)
    return spark.read.schema(ANSWER_SCHEMA).parquet(path)


def answer_state(answers: DataFrame) -> DataFrame:
    """One row per request: attempts so far, the newest readable answer, and the newest error of one that has none."""
    readable = F.col("error").isNull()
    return (
        read_responses(answers)
        .groupBy("request")
        .agg(
            F.sum("attempts").cast("int").alias("attempts"),
            F.max_by(F.when(readable, F.col("response")), F.when(readable, F.col("answered_at"))).alias("response"),
            F.max_by("error", F.when(~readable, F.col("answered_at"))).alias("error"),
        )
        .withColumn("error", F.when(F.col("response").isNull(), F.col("error")))
    )


def waiting_requests(prompts: DataFrame, answers: DataFrame, most_attempts: int) -> DataFrame:
    """``request``, ``batch_id`` of the prompts to ask, equal ones once: no readable answer, and attempts left. No text is moved."""
    wanted = with_requests(prompts).groupBy("request").agg(F.min("batch_id").alias("batch_id"))
    known = answer_state(answers).where(F.col("response").isNotNull() | (F.col("attempts") >= most_attempts))
    return wanted.join(known, "request", "left_anti")


def _asking(annotator: Annotator, pace: Pace):
    def ask(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        limited = pace.limited(annotator)
        for frame in frames:
            prompts = frame["prompt"].tolist()
            given: list = [None] * len(prompts)
            tried, open_places = [0] * len(prompts), list(range(len(prompts)))
            for nth in range(1, pace.tries + 1):
                if nth > 1:
                    time.sleep(pace.wait(nth - 1))
                for place, one in zip(open_places, call_annotator(limited, [prompts[place] for place in open_places])):
                    given[place], tried[place] = one, nth
                open_places = [place for place in open_places if isinstance(given[place], Exception)]
                if not open_places:
                    break
            failed = [isinstance(one, Exception) for one in given]
            yield pd.DataFrame(
                {
                    "request": frame["request"],
                    "response": [None if bad else one for one, bad in zip(given, failed)],
                    "error": [f"{type(one).__name__}: {one}" if bad else None for one, bad in zip(given, failed)],
                    "attempts": tried,
                }
            )

    return ask


def ask(
    prompts: DataFrame,
    annotator: Annotator,
    path: str,
    pace: Pace = Pace(),
    most_attempts: int = 3,
    prompts_per_call: int = 1,
    written: bool = False,
) -> DataFrame:
    """Ask for the prompts the store at ``path`` has no answer to, and return the answers to all of ``prompts``
    (``batch_id``, which no two of them share, ``batch_size``, ``prompt``): columns ``batch_id``, ``batch_size``, ``response``, ``error``.

    When it raises, as when the driver is lost, what was answered until then is in the store. The prompts are read more than once;
    they are written first unless they come from a table that is, as ``written`` tells.

    Calls are numbered by the requests alone, and the texts are moved once, to the task of their call. The list of requests to ask
    is broadcast up to ``BROADCAST_REQUESTS`` and joined by shuffle beyond; where calls are more than a job has, the texts are
    written in order of their calls, so that each job reads its own.
    """
    spark = prompts.sparkSession
    prompts = prompts if written else materialize(prompts, "prompts")
    waiting = waiting_requests(prompts, read_answers(spark, path), most_attempts)
    placed = number_rows(waiting, ["request"], "place", ["batch_id"]).withColumn("call", F.expr(f"(place - 1) div {prompts_per_call}"))
    requests = placed.count()
    calls = -(-requests // prompts_per_call)
    listed = placed.select("request", "batch_id", "call")
    listed = F.broadcast(listed) if requests <= BROADCAST_REQUESTS else listed
    texts = with_requests(prompts).join(listed, ["request", "batch_id"]).select("call", "request", "prompt")
    if calls > CALLS_PER_JOB:
        texts = materialize(texts.repartitionByRange("call").sortWithinPartitions("call"), "calls")
    for first in range(0, calls, CALLS_PER_JOB):
        count = min(CALLS_PER_JOB, calls - first)
        of_job = texts.where((F.col("call") >= first) & (F.col("call") < first + count))
        each = of_job.repartitionById(count, (F.col("call") - first).cast("int")).select("request", "prompt")
        asked = each.mapInPandas(_asking(annotator, pace), "request string, response string, error string, attempts int")
        asked = asked.withColumn("answered_at", F.current_timestamp())
        # version 2 moves the files of a task to the store when the task ends, not when the job does
        asked.write.mode("append").option("mapreduce.fileoutputcommitter.algorithm.version", "2").parquet(path)
    return answered(prompts, read_answers(spark, path))


def answered(prompts: DataFrame, answers: DataFrame) -> DataFrame:
    """``batch_id``, ``batch_size``, ``response``, ``error`` of each prompt, by what the store holds."""
    state = answer_state(answers)
    error = F.when(F.col("response").isNull(), F.coalesce("error", F.lit("not asked yet"))).alias("error")
    return with_requests(prompts).join(state, "request", "left").select("batch_id", "batch_size", "response", error)


def dead_letters(prompts: DataFrame, answers: DataFrame, most_attempts: int = 3) -> DataFrame:
    """Prompts that had their attempts without a readable answer: ``batch_id``, ``batch_size``, ``attempts``, ``error``."""
    dead = answer_state(answers).where(F.col("response").isNull() & (F.col("attempts") >= most_attempts))
    return with_requests(prompts).join(dead, "request").select("batch_id", "batch_size", "attempts", "error")
