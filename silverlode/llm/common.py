"""Small helpers that several operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scratch import free_shuffles, scratch_path, scratch_scope


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def held_out(doc_id: Column, modulus: int, remainder: int) -> Column:
    """True for rows kept from training: crc32 of the id as text, modulo. A null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % modulus == remainder


def batches_of(columns, rows: int):
    """Cut parallel Arrow columns into slices of at most ``rows`` rows."""
    for start in range(0, len(columns[0]), rows):
        yield [c.slice(start, rows) for c in columns]


def growing(df: DataFrame) -> DataFrame:
    """A side of a join that grows with the input: both sides are shuffled, neither is broadcast.

    Spark takes the size of a table from its files and that of an explode from the rows before it, so it would broadcast tables
    many times larger than it allows.
    """
    return df.hint("merge")


def write_and_free(spark: SparkSession, make: Callable[[], DataFrame], label: str) -> DataFrame:
    """The result of ``make`` as a written table; what was materialised to make it is deleted, its shuffle files too."""
    path = scratch_path(spark, label)
    with scratch_scope(spark):
        result = make()
        schema = result.schema
        result.write.parquet(path)
    del result
    free_shuffles(spark)
    return spark.read.schema(schema).parquet(path)
