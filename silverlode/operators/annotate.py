"""Review annotation as tables: a queue, batched requests, responses, merged annotations.

The annotator is the caller's function from a list of prompts to a list of JSON answers; nothing here talks to a
network. Annotations live in a table of their own, so rebuilding the reviews does not lose them.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numbering import number_rows
from ..sources.tables import append_table, overwrite_table
from .quality import Check, no_nulls, run_checks, values_between, values_in

# Batch size, queue length, and the words an annotation may use.
BATCH_SIZE = 10
QUEUE_LIMIT = 500
# Prompts handed to the annotator at once where nothing is stored: a few MB of text.
PROMPTS_PER_CALL = 100
SENTIMENTS = ("positive", "neutral", "negative")
TOPICS = ("delivery", "product_quality", "pricing", "customer_service", "packaging", "other")

# So many runs may lie in the annotation log beside the state before they are folded into it.
COMPACT_AFTER = 20
# Table property of the log: the runs that the state holds.
_MERGED = "runs.merged"

INSTRUCTIONS = f"""Annotate the customer reviews below. Answer with a JSON array only, one object per review, holding:
- review_id: as given
- sentiment: {", ".join(SENTIMENTS)}
- confidence: a number from 0.0 to 1.0
- primary_topic: {", ".join(TOPICS)}
- needs_human_review: true when the text is ambiguous, offensive or unclear
Reviews may be in Portuguese; judge the meaning. The star rating is a hint, the text decides.
"""

# Annotation fields and their types.
ANNOTATION_COLUMNS = {
    "sentiment_label": "string",
    "annotation_confidence": "double",
    "primary_topic": "string",
    "needs_human_review": "boolean",
}
# Answers are read as text fields first: a value of the wrong type spoils its own annotation, not the answer.
_ITEMS = "array<map<string,string>>"

Annotator = Callable[[Sequence[str]], Sequence["str | Exception"]]


def annotation_queue(reviews: DataFrame, annotations: DataFrame | None = None, limit: int | None = QUEUE_LIMIT) -> DataFrame:
    """Reviews with text and no annotation yet, the first ``limit`` by id; None takes them all."""
    waiting = reviews.where(F.trim("review_text") != "")
    if "sentiment_label" in reviews.columns:
        waiting = waiting.where(F.col("sentiment_label").isNull())
    if annotations is not None:
        done = annotations.where(F.col("sentiment_label").isNotNull()).select("review_id")
        waiting = waiting.join(done, "review_id", "left_anti")
    waiting = waiting.select("review_id", "order_id", "rating", "review_text")
    return waiting if limit is None else waiting.orderBy("review_id").limit(limit)


def make_batches(queue: DataFrame, size: int = BATCH_SIZE) -> DataFrame:
    """``batch_id`` and up to ``size`` reviews each, numbered in id order."""
    numbered = number_rows(queue.select("review_id", "rating", "review_text"), ["review_id"], "position", ["rating"])
    review = F.struct("position", "review_id", "rating", "review_text")
    return (
        numbered.withColumn("batch_id", F.expr(f"(position - 1) div {size}"))
        .groupBy("batch_id")
        .agg(F.array_sort(F.collect_list(review)).alias("reviews"))  # at most ``size`` reviews
    )


def build_prompts(batches: DataFrame) -> DataFrame:
    """Add the request text of each batch."""
    def block(review, index):
        return F.concat(
            F.lit("\nReview "), (index + 1).cast("string"),
            F.lit(":\n  review_id: "), review["review_id"],
            F.lit("\n  rating: "), F.coalesce(review["rating"].cast("string"), F.lit("")),
            F.lit("\n  text: "), review["review_text"], F.lit("\n"),
        )

    prompt = F.concat(F.lit(INSTRUCTIONS), F.array_join(F.transform("reviews", block), ""))
    return batches.select("batch_id", F.size("reviews").alias("batch_size"), prompt.alias("prompt"))


def call_annotator(annotator: Annotator, prompts: list[str]) -> list:
    """An answer or an exception for each prompt. When a call for several raises, they are asked one by one."""
    try:
        given = list(annotator(prompts))
        if len(given) != len(prompts):
            raise ValueError(f"{len(given)} answers to {len(prompts)} prompts")
        return given
    except Exception as error:  # the annotator is foreign code
        return [error] if len(prompts) == 1 else [one for prompt in prompts for one in call_annotator(annotator, [prompt])]


def apply_annotator(prompts: DataFrame, annotator: Annotator, tasks: int | None = None) -> DataFrame:
    """Run the caller's function over the prompts, ``PROMPTS_PER_CALL`` to a call. Nothing is stored; see ``answers.ask``.

    It returns one answer, or one exception, per prompt. When a call for several prompts raises, they are asked one by
    one, so an error marks its own batch only. Only the prompts of a call are Python objects, however many Spark hands over.

    ``tasks`` is the number of parallel callers: annotators wait on a network, so the size of the prompts says
    nothing about it.
    """

    names = ["batch_id", "batch_size", "response", "error"]

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, PROMPTS_PER_CALL):
                part = batch.slice(first, PROMPTS_PER_CALL)
                given = call_annotator(annotator, part.column("prompt").to_pylist())
                failed = [isinstance(one, Exception) for one in given]
                answers = [None if bad else one for one, bad in zip(given, failed)]
                errors = [f"{type(one).__name__}: {one}" if bad else None for one, bad in zip(given, failed)]
                texts = [pa.array(answers, pa.string()), pa.array(errors, pa.string())]
                yield pa.RecordBatch.from_arrays([part.column("batch_id"), part.column("batch_size"), *texts], names)

    if tasks is not None:
        prompts = prompts.repartition(tasks, "batch_id")
    return prompts.select("batch_id", "batch_size", "prompt").mapInArrow(ask, "batch_id bigint, batch_size int, response string, error string")


def read_responses(responses: DataFrame) -> DataFrame:
    """Find the array of annotations in each answer: the answer itself, or the first list inside an object.

    Adds ``items`` (one map of text per annotation), ``warning`` for an answer without a list, which counts as
    empty, and ``error`` for text that is no JSON or a list of something else than objects. An object that repeats a key
    says two things at once and counts as no JSON.
    """
    text = F.btrim("response", F.lit(" \t\r\n"))
    # The parser stops at the end of the first value. Put into an object before a key only this text can have, the
    # answer must be one value and nothing else for that key, and just two keys, to come out again; text that is no JSON
    # breaks the object.
    mark = F.md5(text)
    wrapped = F.concat(F.lit('{"v":'), text, F.lit(',"'), mark, F.lit('":1}'))
    keys = F.map_keys(F.try_variant_get(F.try_parse_json(wrapped), "$", "map<string,variant>"))
    whole = F.coalesce((F.size(keys) == 2) & F.array_contains(keys, mark), F.lit(False))
    members = F.map_values(F.from_json(text, "map<string,variant>"))
    first_list = F.try_element_at(F.filter(members, lambda v: F.schema_of_variant(v).startswith("ARRAY")), F.lit(1))
    listed = F.when(text.startswith("["), text).when(text.startswith("{"), F.to_json(first_list))
    return (
        responses.withColumn("_parsed", whole)
        .withColumn("_list", listed)
        .withColumn("items", F.when(F.col("_parsed"), F.from_json(F.coalesce("_list", F.lit("[]")), _ITEMS)))
        .withColumn(
            "error",
            F.when(F.col("error").isNotNull(), F.col("error"))
            .when(~F.col("_parsed"), "response is not JSON")
            .when(F.col("items").isNull(), "list items are not objects"),
        )
        .withColumn("warning", F.when(F.col("error").isNull() & F.col("_list").isNull(), "response holds no list"))
        .drop("_parsed", "_list")
    )


def parse_annotations(responses: DataFrame) -> DataFrame:
    """One row per annotation with its batch and place in the answer.

    A missing confidence is 0.0 and a missing flag false; a confidence that is null or no number is an
    ``item_error`` and the annotation is not saved.

    An answer that cannot be read has NULL ``items``. They are told from the others after they are laid out in rows: Spark would
    put a condition on ``items`` or ``error`` before the parser, and parse, and make, every answer again for each of its parts.
    """
    item = F.col("item")
    confidence = F.when(F.map_contains_key(item, "confidence"), item["confidence"].try_cast("double")).otherwise(F.lit(0.0))
    return (
        read_responses(responses.where(F.col("error").isNull()))
        .select("batch_id", F.posexplode_outer("items").alias("place", "item"))
        .where(F.col("place").isNotNull())
        .select(
            "batch_id",
            "place",
            item["review_id"].alias("review_id"),
            item["sentiment"].alias("sentiment_label"),
            confidence.alias("annotation_confidence"),
            item["primary_topic"].alias("primary_topic"),
            F.coalesce(item["needs_human_review"].try_cast("boolean"), F.lit(False)).alias("needs_human_review"),
        )
        .withColumn("item_error", F.when(F.col("annotation_confidence").isNull(), "confidence is not a number"))
    )


def last_per_review(annotations: DataFrame) -> DataFrame:
    """The last annotation of each review; earlier ones are overwritten. Combined map-side per review."""
    kept = annotations.where(F.col("item_error").isNull() & F.col("review_id").isNotNull())
    fields = F.struct(*ANNOTATION_COLUMNS)
    return (
        kept.groupBy("review_id")
        .agg(F.max_by(fields, F.struct("batch_id", "place")).alias("last"))
        .select("review_id", "last.*")
    )


def upsert_annotations(existing: DataFrame, new: DataFrame) -> DataFrame:
    """The annotation table after a run: all four fields of a review in ``new`` replace those in ``existing``."""
    columns = ["review_id", *ANNOTATION_COLUMNS]
    kept = existing.join(new.select("review_id"), "review_id", "left_anti")
    return kept.select(*columns).unionByName(new.select(*columns))


def append_annotations(new: DataFrame, table: str) -> None:
    """Add a run's annotations to the annotation log, as a partition of its own; none is rewritten."""
    run = f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    stamped = new.select("review_id", *ANNOTATION_COLUMNS, F.current_timestamp().alias("annotated_at"), F.lit(run).alias("run"))
    append_table(stamped, table, ["run"])


def fold_annotations(log: DataFrame, state: DataFrame | None = None) -> DataFrame:
    """One row per review with ``annotated_at``: the newest of its rows in ``log`` and in ``state``, which has one a review.

    Rows found in both do no harm, so a log may overlap the state it was folded into. Of rows of one time the one with the
    greatest fields is taken. A state in buckets of ``review_id``, at least as many as Spark shuffles into, is not shuffled.
    """
    newest = F.struct("annotated_at", *ANNOTATION_COLUMNS)
    folded = log.groupBy("review_id").agg(F.max(newest).alias("last"))
    if state is not None:
        known = state.select("review_id", newest.alias("known"))
        folded = known.join(folded, "review_id", "full_outer").select("review_id", F.greatest("known", "last").alias("last"))
    return folded.select("review_id", *[F.col(f"last.{c}") for c in (*ANNOTATION_COLUMNS, "annotated_at")])


def current_annotations(log: DataFrame, state: DataFrame | None = None) -> DataFrame:
    """The annotation in force for each review: the one appended last."""
    return fold_annotations(log, state).drop("annotated_at")


def state_table(table: str) -> str:
    return f"{table}_state"


def _runs(spark: SparkSession, table: str) -> tuple[list[str], list[str]]:
    """The runs in the log of ``table``, and those of them that its state holds already."""
    runs = sorted(row[0].partition("=")[2] for row in spark.sql(f"SHOW PARTITIONS {table}").collect())
    merged = spark.sql(f"SHOW TBLPROPERTIES {table}").where(F.col("key") == _MERGED).first()
    merged = set(merged["value"].split(",")) if merged else set()
    return runs, [run for run in runs if run in merged]


def _log_and_state(spark: SparkSession, table: str) -> tuple[DataFrame, DataFrame | None]:
    """The runs of the log that the state lacks, and the state, if there is one yet."""
    state = spark.table(state_table(table)) if spark.catalog.tableExists(state_table(table)) else None
    merged = _runs(spark, table)[1] if state is not None else []
    return spark.table(table).where(~F.col("run").isin(merged)), state


def read_annotations(spark: SparkSession, table: str) -> DataFrame | None:
    """The annotation in force for each review, from the state of ``table`` and the runs since; None before the first run."""
    return current_annotations(*_log_and_state(spark, table)) if spark.catalog.tableExists(table) else None


def compact_annotations(spark: SparkSession, table: str, after: int = COMPACT_AFTER, buckets: int | None = None) -> bool:
    """Fold the log into the state when it holds ``after`` runs that the state lacks; whether that was done.

    The new state is written whole before it takes the place of the old one. The runs it holds leave the log with the next
    compaction, so queries that read them can end; reads and compactions cost the state and at most ``after`` runs however many
    there were. A run appended meanwhile stays in the log, and after a crash at any point rows are at worst folded again. The
    state lies in ``buckets`` by review, by default as many as Spark shuffles into.
    """
    if not spark.catalog.tableExists(table):
        return False
    runs, merged = _runs(spark, table)
    waiting = [run for run in runs if run not in merged]
    if len(waiting) < max(1, after):
        return False
    log, state = _log_and_state(spark, table)
    folded = fold_annotations(log.where(F.col("run").isin(waiting) & F.col("review_id").isNotNull()), state)
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    overwrite_table(folded, state_table(table), bucket_by=(buckets, "review_id"))
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{_MERGED}' = '{','.join(waiting)}')")
    for run in merged:
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION (run = '{run}')")
    return True


def with_annotation_columns(reviews: DataFrame) -> DataFrame:
    """Add the annotation columns a reviews table lacks, all NULL."""
    missing = {c: F.lit(None).cast(t) for c, t in ANNOTATION_COLUMNS.items() if c not in reviews.columns}
    return reviews.withColumns(missing) if missing else reviews


def annotated_reviews(reviews: DataFrame, annotations: DataFrame) -> DataFrame:
    """Reviews with their annotations; fields a review already carries stay where it has no annotation."""
    reviews = with_annotation_columns(reviews)
    found = annotations.select("review_id", F.struct(*ANNOTATION_COLUMNS).alias("_new"))
    joined = reviews.join(found, "review_id", "left")
    fields = {c: F.when(F.col("_new").isNotNull(), F.col(f"_new.{c}")).otherwise(F.col(c)) for c in ANNOTATION_COLUMNS}
    return joined.withColumns(fields).drop("_new")


def run_summary(responses: DataFrame, annotations: DataFrame, reviews: DataFrame) -> DataFrame:
    """One row: reviews processed, annotations saved, of which matched a review or not, batch errors, success rate."""
    batches = read_responses(responses).agg(
        F.coalesce(F.sum("batch_size"), F.lit(0)).alias("reviews_processed"),
        F.count_if(F.col("error").isNotNull()).alias("batches_with_errors"),
        F.count_if(F.col("warning").isNotNull()).alias("batches_without_list"),
    )
    known = reviews.select("review_id", F.lit(True).alias("_known"))
    # Annotations are counted per review before they meet the reviews.
    saved = (
        annotations.where(F.col("item_error").isNull())
        .groupBy("review_id")
        .agg(F.count(F.lit(1)).alias("n"))
        .join(known, "review_id", "left")
        .agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("annotations_saved"),
            F.coalesce(F.sum(F.when(F.col("_known"), F.col("n"))), F.lit(0)).alias("matched"),
            F.coalesce(F.sum(F.when(F.col("_known").isNull(), F.col("n"))), F.lit(0)).alias("unmatched"),
        )
    )
    rate = F.try_divide(F.col("annotations_saved").cast("double"), F.col("reviews_processed").cast("double"))
    return batches.crossJoin(F.broadcast(saved)).withColumn("success_rate", rate)  # one row each


def annotation_suite() -> list[Check]:
    return [
        no_nulls("review_id"),
        values_in("sentiment_label", SENTIMENTS),
        values_in("primary_topic", TOPICS),
        values_between("annotation_confidence", 0, 1),
    ]


def check_annotations(annotations: DataFrame) -> DataFrame:
    return run_checks(annotations, "annotations", annotation_suite())


def top_annotations(reviews: DataFrame, n: int = 10) -> DataFrame:
    """The most confident annotations with the start of their text, for a look at the quality."""
    return (
        reviews.where(F.col("sentiment_label").isNotNull())
        .orderBy(F.desc_nulls_first("annotation_confidence"), "review_id")
        .limit(n)
        .select(
            "rating", "sentiment_label", "annotation_confidence", "primary_topic",
            F.left("review_text", F.lit(80)).alias("preview"),
        )
    )
