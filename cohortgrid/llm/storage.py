"""Written tables in the shared folder that the session names.

A written table cuts lineage and survives lost executors; a retried task
rereads it and sees the same rows. An operator writes its working tables
in a scratch folder and its narrow result outside of it; the scratch
folder goes when the operator returns.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

from cohortgrid.sources.sinks import checkpoint_dir

_scratch: ContextVar[str | None] = ContextVar("scratch", default=None)


def workspace(spark: SparkSession) -> str:
    """One folder per application."""
    root = checkpoint_dir(spark).rstrip("/")
    return f"{root}/cohortgrid-llm/{spark.sparkContext.applicationId}"


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables written inside stand in a folder that is deleted at the end;
    what must outlive it is written with ``kept``."""
    folder = f"{workspace(spark)}/scratch-{uuid.uuid4().hex}"
    token = _scratch.set(folder)
    try:
        yield
    finally:
        _scratch.reset(token)
        _delete(spark, folder)


def _write(df: DataFrame, folder: str, name: str) -> DataFrame:
    path = f"{folder}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet (in the scratch folder, if there is one) and
    read it back."""
    return _write(df, _scratch.get() or workspace(df.sparkSession), name)


def kept(df: DataFrame, name: str) -> DataFrame:
    """Write an operator's result where it outlives its scratch folder."""
    return _write(df, workspace(df.sparkSession), name)


def clear_workspace(spark: SparkSession) -> None:
    """Delete this application's results. Call it once no DataFrame
    returned by an operator is needed any more."""
    _delete(spark, workspace(spark))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
