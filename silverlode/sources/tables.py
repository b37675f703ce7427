"""Layer tables in the catalog: namespaces, full refresh, append, views."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scratch import delete_folder

# The layers a table name may start with.
LAYERS = ("bronze", "silver", "gold", "ml", "monitoring")

# Tables last, so they are packed closer than what Spark writes by default.
CODEC = "zstd"

# Table property: the folder of the version before the newest.
_BEFORE = "version.before"


def layer(name: str, table: str) -> str:
    if name not in LAYERS:
        raise ValueError(f"unknown layer {name!r}; layers: {', '.join(LAYERS)}")
    return f"{name}.{table}"


def create_layers(spark: SparkSession, root: str | None = None) -> None:
    """Create the layers that do not exist yet, under ``root`` or else in the warehouse."""
    for name in LAYERS:
        place = f" LOCATION '{root}/{name}'" if root else ""
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}{place}")


def _qualified(spark: SparkSession, table: str) -> tuple[str, str]:
    database, _, name = table.rpartition(".")
    return database or spark.catalog.currentDatabase(), name


def _versions_folder(spark: SparkSession, table: str) -> str:
    database, name = _qualified(spark, table)
    return f"{spark.catalog.getDatabase(database).locationUri.rstrip('/')}/_versions/{name}"


def _described(spark: SparkSession, table: str) -> dict[str, str]:
    """What the catalog knows of a table beyond its columns: ``Type``, ``Location``, ``Provider`` and so on."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()
    start = next(i for i, row in enumerate(rows) if row["col_name"].startswith("# Detailed"))
    return {row["col_name"]: row["data_type"] for row in rows[start + 1 :]}


def _version_before(spark: SparkSession, table: str) -> str | None:
    found = spark.sql(f"SHOW TBLPROPERTIES {table}").where(F.col("key") == _BEFORE).first()
    return found["value"] if found else None


def _sql_text(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def overwrite_table(
    df: DataFrame, table: str, partition_by: list[str] | None = None, bucket_by: tuple[int, str] | None = None
) -> None:
    """Full refresh: readers find the old rows until the new ones are written whole, and keep them when the write fails.

    Every version of a table has a folder of its own under ``_versions`` of the database; the table is an external one that
    points at the newest. A refresh of the same columns changes that pointer in one step of the catalog. Where columns
    change, and wherever there are partitions or buckets, two renames put a new table in place of the old one, and for the
    moment between them there is no table. The version before stays until the next refresh, for queries that still read it; so ``df`` may read the table.
    ``bucket_by`` are the number of buckets and their column, in which each bucket is sorted.
    """
    spark = df.sparkSession
    database, name = _qualified(spark, table)
    table = f"{database}.{name}"
    version = uuid.uuid4().hex
    folder = f"{_versions_folder(spark, table)}/{version}"
    writer = df.write.format("parquet").option("path", folder).option("compression", CODEC)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if bucket_by:
        writer = writer.bucketBy(*bucket_by).sortBy(bucket_by[1])
    try:
        if not spark.catalog.tableExists(table):
            writer.saveAsTable(table)
            return
        plain = not partition_by and not bucket_by and _plain_columns(spark, table) == df.dtypes
        if plain:
            writer.save()
            _point_at(spark, table, folder)
        else:
            staged = f"{table}__{version}"
            writer.saveAsTable(staged)
            _put_in_place(spark, staged, table)
    except Exception:
        if not _points_at(spark, table, folder):
            spark.sql(f"DROP TABLE IF EXISTS {table}__{version}")
            delete_folder(spark, folder)
        raise


def _plain_columns(spark: SparkSession, table: str) -> list[tuple[str, str]] | None:
    """Names and types of the columns of a table that may be pointed at another folder; None for any other table."""
    known = _described(spark, table)
    movable = known.get("Type") == "EXTERNAL" and known.get("Provider", "").lower() == "parquet" and "Num Buckets" not in known
    parted = any(column.isPartition for column in spark.catalog.listColumns(table))
    return spark.table(table).dtypes if movable and not parted else None


def _points_at(spark: SparkSession, table: str, folder: str) -> bool:
    return spark.catalog.tableExists(table) and _described(spark, table).get("Location", "").endswith(folder.rsplit("/", 1)[-1])


def _forget(spark: SparkSession, table: str, folder: str | None) -> None:
    """Delete a version that is neither the newest of ``table`` nor the one before; folders of others are left alone."""
    if folder and f"/_versions/{_qualified(spark, table)[1]}/" in folder:
        delete_folder(spark, folder)


def _point_at(spark: SparkSession, table: str, folder: str) -> None:
    before, oldest = _described(spark, table)["Location"], _version_before(spark, table)
    spark.sql(f"ALTER TABLE {table} SET LOCATION {_sql_text(folder)}")
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ({_sql_text(_BEFORE)} = {_sql_text(before)})")
    spark.catalog.refreshTable(table)
    _forget(spark, table, oldest)


def _put_in_place(spark: SparkSession, staged: str, table: str) -> None:
    known, oldest = _described(spark, table), _version_before(spark, table)
    retired = f"{table}__old_{uuid.uuid4().hex}"
    if known["Type"] == "EXTERNAL":
        spark.sql(f"ALTER TABLE {staged} SET TBLPROPERTIES ({_sql_text(_BEFORE)} = {_sql_text(known['Location'])})")
    spark.sql(f"ALTER TABLE {table} RENAME TO {retired}")
    try:
        spark.sql(f"ALTER TABLE {staged} RENAME TO {table}")
    except Exception:
        spark.sql(f"ALTER TABLE {retired} RENAME TO {table}")
        raise
    spark.sql(f"DROP TABLE {retired}")
    _forget(spark, table, oldest)


def drop_table(spark: SparkSession, table: str) -> None:
    """Drop a table with all its versions."""
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    delete_folder(spark, _versions_folder(spark, table))


def append_table(df: DataFrame, table: str, partition_by: list[str] | None = None) -> None:
    writer = df.write.mode("append")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(table)


def as_view(df: DataFrame, name: str) -> None:
    df.createOrReplaceTempView(name)


def read_table(spark: SparkSession, table: str) -> DataFrame:
    """Lazy: later projections and filters reach the scan."""
    return spark.table(table)


def describe_table(df: DataFrame) -> DataFrame:
    """One row per column: position, name, type, and the rows and NULLs of the table. One aggregate."""
    fields = list(enumerate(df.schema.fields))
    counts = df.agg(
        F.count(F.lit(1)).alias("rows"), *[F.count_if(F.col(f.name).isNull()).alias(f"n{i}") for i, f in fields]
    )
    return counts.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(i).alias("position"),
                        F.lit(f.name).alias("column"),
                        F.lit(f.dataType.simpleString()).alias("type"),
                        F.col("rows").alias("row_count"),
                        F.col(f"n{i}").alias("null_count"),
                    )
                    for i, f in fields
                ]
            )
        )
    )


def sample_rows(df: DataFrame, n: int = 3) -> DataFrame:
    """A few rows to look at."""
    return df.limit(n)
