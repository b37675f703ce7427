"""JDBC tables as source and sink. The driver jar is the caller's (``spark.jars``)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

READ_BATCH, WRITE_BATCH = 10_000, 1_000


@dataclass(frozen=True)
class Partitioning:
    """How a scan is cut into parallel queries: by ranges of a numeric, date or timestamp column."""

    column: str
    lower: str | int
    upper: str | int
    partitions: int


def read_options(
    url: str, table: str, properties: Mapping[str, str] | None = None, partitioning: Partitioning | None = None,
    batch: int = READ_BATCH,
) -> dict[str, str]:
    options = {"url": url, "dbtable": table, "fetchsize": str(batch), **(properties or {})}
    if partitioning:
        options |= {
            "partitionColumn": partitioning.column,
            "lowerBound": str(partitioning.lower),
            "upperBound": str(partitioning.upper),
            "numPartitions": str(partitioning.partitions),
        }
    return options


def text_ranges(column: str, bounds: Sequence[str]) -> list[str]:
    """Conditions that cut a text column at the given bounds, for ``predicates``: every row meets exactly one."""
    quoted = ["'" + bound.replace("'", "''") + "'" for bound in sorted(set(bounds))]
    if not quoted:
        return []
    inner = [f"{column} >= {low} AND {column} < {high}" for low, high in zip(quoted, quoted[1:])]
    return [f"{column} < {quoted[0]} OR {column} IS NULL", *inner, f"{column} >= {quoted[-1]}"]


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    properties=None,
    partitioning: Partitioning | None = None,
    predicates: Sequence[str] | None = None,
) -> DataFrame:
    """Lazy; filters and projections are pushed into the query.

    ``partitioning`` cuts the scan by a number or date; ``predicates`` are conditions read by a task each, for tables keyed by
    text (see ``text_ranges``). Without either one task reads it all.
    """
    if predicates:
        if partitioning:
            raise ValueError("give partitioning or predicates, not both")
        settings = {"fetchsize": str(READ_BATCH), **(properties or {})}
        return spark.read.jdbc(url, table, predicates=list(predicates), properties=settings)
    return spark.read.format("jdbc").options(**read_options(url, table, properties, partitioning)).load()


def write_options(
    url: str, table: str, properties: Mapping[str, str] | None = None, connections: int | None = None,
    batch: int = WRITE_BATCH,
) -> dict[str, str]:
    options = {"url": url, "dbtable": table, "batchsize": str(batch), **(properties or {})}
    if connections:
        options["numPartitions"] = str(connections)
    return options


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "overwrite", properties=None, connections: int | None = None) -> None:
    """``mode`` as Spark understands it. ``connections`` caps the parallel connections to the database."""
    df.write.format("jdbc").options(**write_options(url, table, properties, connections)).mode(mode).save()
