"""Materialise an intermediate result so that later steps read it instead of recomputing it.

The result is written as Parquet to the shared folder named by ``spark.checkpoint.dir``, so it outlives the
loss of any executor and, unlike an RDD checkpoint, can be read with column pruning. Where that is unset, a folder
under the warehouse is taken, which a cluster shares as well.
"""

from __future__ import annotations

import gc
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_scope: ContextVar[str | None] = ContextVar("scratch_scope", default=None)


def scratch_root(spark: SparkSession) -> str:
    root = spark.conf.get("spark.checkpoint.dir", None)
    return root.rstrip("/") if root else f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"


def _folder(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def delete_folder(spark: SparkSession, path: str) -> bool:
    folder, files = _folder(spark, path)
    return files.delete(folder, True)


def _application_path(spark: SparkSession) -> str:
    return f"{scratch_root(spark)}/silverlode/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path of the scope in force, or of the application; a fresh name per call, so nothing is ever overwritten."""
    folder, files = _folder(spark, _application_path(spark))
    files.mkdirs(folder)
    files.deleteOnExit(folder)
    return f"{_scope.get() or folder.toString()}/{label}-{uuid.uuid4().hex}"


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[str]:
    """What is materialised inside lies in a folder of its own, deleted at the end, also when an error ends it.

    DataFrames over materialised tables must not be used after the scope; those of other scopes and of the application
    are left alone.
    """
    path = f"{_application_path(spark)}/scope-{uuid.uuid4().hex}"
    token = _scope.set(path)
    try:
        yield path
    finally:
        _scope.reset(token)
        delete_folder(spark, path)


def free_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of plans that nothing refers to any more.

    It does so once the driver has collected such a plan as garbage, which a large heap may put off for the whole of a job.
    """
    gc.collect()
    spark._jvm.System.gc()


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and return a scan of the written table. It lasts as long as the application."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_scratch(spark: SparkSession) -> bool:
    """Delete all this application materialised outside of scopes and in them: for its very end."""
    return delete_folder(spark, _application_path(spark))
