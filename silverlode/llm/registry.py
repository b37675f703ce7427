"""The operators of this subpackage as queries over the given tables, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import brown, decontaminate, infill, langid, minmax, packing, pii, quality, shards, simhash, spelling, tokens, vafile
from .common import held_out, read

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op1_brown_class_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    kept_back = held_out(F.col("doc_id"), 7, 2)
    model, counts = brown.train(docs.where(~kept_back).select("text"))
    return brown.score(docs, model, counts, kept_back)


@query
def op2_va_file_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vafile.top_k(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


ORACLES["op2_va_file_top_k"] = """
WITH v AS (
    SELECT vec_id, [floor(256 * x::DOUBLE) FOR x IN embedding] AS vec
    FROM embeddings
    WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.vec, c.vec) AS BIGINT) AS score
    FROM v AS q JOIN v AS c ON q.vec_id <> c.vec_id
    WHERE q.vec_id % 50 = 0
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM scored
QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 5
"""


@query
def op3_compression_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    kept_back = held_out(F.col("doc_id"), 4, 2)
    model = quality.train(docs, labels.where(~kept_back))
    return quality.score_texts(docs, model, kept_back)


@query
def op4_semi_markov_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return pii.find(docs, pii.train(docs))


@query
def op5_sampled_splitters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.assign_shards(read(spark, sf_dir, "documents"), shards=40)


@query
def op6_variable_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(packing.word_tokens(read(spark, sf_dir, "documents")))


@query
def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    kept_back = held_out(F.col("doc_id"), 3, 1)
    return langid.identify(docs, langid.train(docs.where(~kept_back)), kept_back)


@query
def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.count_tokens(read(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))


@query
def op9_simhash_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read(spark, sf_dir, "documents"))


@query
def op10_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


@query
def op11_min_max_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minmax.near_duplicates(read(spark, sf_dir, "documents"))


@query
def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(read(spark, sf_dir, "documents"))


@query
def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = infill.transform(read(spark, sf_dir, "documents"))
    restored = infill.restore(F.col("output"), F.col("form"))
    return made.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored, 256).alias("restored_sha256"),
    )


ORACLES["op13_fill_in_middle"] = r"""
WITH texts AS (
    SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS units,
           sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS d
    FROM documents
), drawn AS (
    SELECT doc_id, t, units, CAST(len(units) AS BIGINT) AS n, CAST('0x' || d[1:8] AS BIGINT) AS h1,
           CAST('0x' || d[9:16] AS BIGINT) AS h2, CAST('0x' || d[17:24] AS BIGINT) AS h3, CAST('0x' || d[25:32] AS BIGINT) AS h4
    FROM texts
), cut AS (
    SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS low, greatest(h1 % (n + 1), h2 % (n + 1)) AS high,
           CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 100 THEN 'plain'
                WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
    FROM drawn
), pieces AS (
    SELECT *, array_to_string(list_slice(units, 1, low), '') AS p, array_to_string(list_slice(units, low + 1, high), '') AS m,
           array_to_string(list_slice(units, high + 1, n), '') AS s
    FROM cut
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                        ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM pieces
"""
