"""Groups of similar texts: SimHash groups first, then every link of a Jaccard similarity between them.

Fingerprints of similar texts differ in few bits, but two texts of similarity 0.8 differ in about ten of 64, more than an
index over fingerprints can be asked for. So the SimHash operator gathers copies and nearly equal texts, whose sets of
shingles are compared inside each group; bands of min-max signatures then bring together what lies in different groups, and
the same exact comparison finds all links there. No link rests on a fingerprint or signature alone.

With 32 bands of 4 values a pair of similarity 0.8 that is in different SimHash groups misses all bands once in twenty
million times.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scratch import materialize
from . import minmax, simhash

BAND = 4
BANDS = 32


def groups(texts: DataFrame, similarity: tuple[int, int] = (8, 10), words_per_shingle: int = 5, radius: int = 4) -> DataFrame:
    """``key``, ``component``: the smallest key linked with it. ``texts`` has ``key`` (long, not null) and ``text``; one row
    per different key. Sets of shingles link at a Jaccard similarity of ``similarity``. Texts without a word are similar to
    each other, null ones included. Other columns are ignored.
    """
    docs = texts.select(F.col("key").cast("long").alias("doc_id"), F.col("text").cast("string")).dropDuplicates(["doc_id"])
    hashed = minmax.with_hashes(docs)
    signed = materialize(minmax.signatures(hashed, words_per_shingle, BAND, BANDS), "signatures")
    classes = materialize(minmax.classes_of(signed), "classes")
    marked = simhash.near_duplicates(docs, radius, words_per_shingle).select(F.col("doc_id").alias("own"), F.col("component_id").alias("block"))
    placed = materialize(classes.where("weight > 0").select("id", "own").join(marked, "own").select("block", "id"), "simhash-groups")
    several = placed.groupBy("block").agg(F.count(F.lit(1)).alias("members")).where("members > 1").select("block")
    linked = minmax.components_of(hashed, classes, similarity, words_per_shingle, placed.join(several, "block", "left_semi"))
    answered = signed.select("doc_id", "same").join(linked.select("same", "smallest"), "same")
    return answered.select(F.col("doc_id").alias("key"), F.col("smallest").alias("component"))
