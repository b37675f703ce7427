"""From raw documents to packed training sequences: the stages in their order, each a call of one operator.

Texts are matched with decisions on them by a 64-bit hash of the text, so null and repeated ids do no harm. Every stage
but the last returns the columns of ``documents``; the last returns the places of the documents in their sequences.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from silverlode.functions.scratch import materialize
from silverlode.llm import decontaminate, langid, overlap, packing, pii
from silverlode.llm.common import held_out, read, write_and_free

LEAST_CERTAINTY = 1 / 6  # of the way from a guess among the languages to a score of 1


def text_key() -> Column:
    return F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without a letter go, and those whose language is hardly likelier than by a guess among all that are known.

    The language is only used to reject; the column ``lang`` stays as it came.
    """
    model = langid.train(docs.where(~held_out(F.col("doc_id"), 3, 1)))
    answer = langid.predictor(docs, model)(F.col("text").cast("string"))
    columns = [F.col(name) for name in docs.columns]
    judged = docs.select(F.struct(*columns).alias("doc"), answer.alias("answer"))
    guess = 1 / max(1, len(model.languages))
    least = guess + LEAST_CERTAINTY * (1 - guess)
    known = (F.col("answer.lang_pred") != langid.UNKNOWN) & (F.col("answer.score") >= least)
    return judged.where(known).select("doc.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays: the smallest id, null last; of rows that repeat id and text the
    one whose other columns come first as JSON.

    Texts link when their sets of five-word shingles have a Jaccard similarity of at least 0.8.
    """
    last = F.lit(2**63 - 1)

    def find_kept() -> DataFrame:
        slim = docs.select(F.col("doc_id").cast("long"), text_key().alias("key"))
        slim = slim.groupBy("key").agg(F.min(F.coalesce("doc_id", last)).alias("first_id"))
        # groups of different texts, named by the hash of a text; equal texts are one already
        groups = overlap.groups(docs.select(text_key().alias("key"), "text"))
        kept = slim.join(groups, "key").groupBy("component").agg(F.min(F.struct("first_id", "key")).alias("kept"))
        return kept.select("kept.first_id", "kept.key")

    kept = write_and_free(spark, find_kept, "kept")
    same = (F.coalesce(docs["doc_id"].cast("long"), last) == kept["first_id"]) & (text_key() == kept["key"])
    others = F.to_json(F.struct(*[F.col(name) for name in docs.columns if name != "text"]))
    first = F.row_number().over(Window.partitionBy("doc_id", text_key()).orderBy(others))
    nth = F.struct(*[F.col(name) for name in docs.columns])
    return docs.join(kept, same, "left_semi").select(nth.alias("doc"), first.alias("nth")).where("nth = 1").select("doc.*")


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""

    def find_leaks() -> DataFrame:
        texts = docs.select(text_key().alias("key"), "text")
        return decontaminate.find_leaks(texts, read(spark, sf_dir, "benchmark"), key="key").select("key").distinct()

    leaks = write_and_free(spark, find_leaks, "leaks")
    return docs.join(leaks, text_key() == leaks["key"], "left_anti").select(docs.columns)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in texts gives way to its kind in brackets; ``n_chars`` is counted anew."""
    mask = pii.masker(docs, pii.train(docs)).asNondeterministic()
    text = mask(F.col("text").cast("string"))
    masked = docs.withColumn("text", text)
    if "n_chars" in docs.columns:
        masked = masked.withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast(docs.schema["n_chars"].dataType))
    return masked.select(docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all documents in sequences of the permitted lengths; see ``packing.pack``."""
    return packing.pack(packing.word_tokens(docs))


STAGES = [
    ("language_id", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_benchmark_leaks),
    ("personal_data", mask_personal_data),
    ("packing", pack_sequences),
]

ORACLE_SQL = None  # models, fingerprints and packing have no SQL form; tests hold each stage against a plain version


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn over the documents; each result but the last is written and read again."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
