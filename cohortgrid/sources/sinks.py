"""Stage outputs and lineage cuts.

Every stage publishes a new version of its path; none is overwritten (S3).
Lineage is cut with a written table or ``checkpoint()`` in the shared
folder the cluster names in ``spark.checkpoint.dir``; a local default is
set only when the session has none (tests).
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def checkpoint_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder; sets a scratch one only if unset."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder for cluster runs")
        d = tempfile.mkdtemp(prefix="cohortgrid-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return d


def run_folder(spark: SparkSession) -> str:
    """This application's folder of written stage tables."""
    return f"{checkpoint_dir(spark).rstrip('/')}/cohortgrid/{spark.sparkContext.applicationId}"


def clear_run(spark: SparkSession) -> None:
    """Delete this application's stage tables, once no DataFrame that reads
    them is needed any more."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(run_folder(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as parquet under the shared checkpoint folder and read it
    back: cuts lineage (later plans start from a scan with real size
    statistics, column pruning and filter pushdown) and survives lost
    executors. Used at stage boundaries on stage-sized results."""
    spark = df.sparkSession
    path = f"{run_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.mode("errorifexists").parquet(path)
    return spark.read.parquet(path)


def _fs(spark: SparkSession, path: str):
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    p = hadoop.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop.Path


MANIFESTS = "_manifests"


def versions(spark: SparkSession, path: str) -> list[str]:
    """The folders of the committed versions of ``path``, oldest first."""
    fs, P = _fs(spark, path)
    folder = P(f"{path}/{MANIFESTS}")
    if not fs.exists(folder):
        return []
    names = sorted(f.getPath().getName() for f in fs.listStatus(folder) if not f.getPath().getName().startswith((".", "_")))
    return [f"{path}/{name.split('.', 1)[1]}" for name in names]


def publish(df: DataFrame, path: str, partition_by: list[str] | None = None) -> str:
    """S3: write ``df`` as a new version under ``path`` and commit it with a
    manifest, an empty file ``<number>.<version>``; returns the version's
    folder. Readers of ``read_stage`` see the latest committed version, whole:
    a run that fails commits nothing, and a version that is being read stays
    until ``vacuum``. Of two runs that publish at once, both commit, and the
    one that began later has the higher number or, at one number, the greater
    name."""
    spark, path = df.sparkSession, path.rstrip("/")
    number = len(versions(spark, path))
    version = f"v-{uuid.uuid4().hex}"
    w = df.write.mode("errorifexists")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(f"{path}/{version}")
    fs, P = _fs(spark, path)
    fs.create(P(f"{path}/{MANIFESTS}/{number:010d}.{version}"), False).close()
    return f"{path}/{version}"


def vacuum(spark: SparkSession, path: str, keep: int = 1) -> None:
    """Delete all but the last ``keep`` committed versions, their manifests
    first, and folders that no manifest names."""
    path = path.rstrip("/")
    fs, P = _fs(spark, path)
    kept = set(versions(spark, path)[-keep:])
    folder = P(f"{path}/{MANIFESTS}")
    for f in list(fs.listStatus(folder)) if fs.exists(folder) else []:
        name = f.getPath().getName()
        if not name.startswith((".", "_")) and f"{path}/{name.split('.', 1)[1]}" not in kept:
            fs.delete(f.getPath(), False)
    for f in list(fs.listStatus(P(path))) if fs.exists(P(path)) else []:
        name = f.getPath().getName()
        if name.startswith("v-") and f"{path}/{name}" not in kept:
            fs.delete(f.getPath(), True)


def write_stage(df: DataFrame, path: str, partition_by: list[str] | None = None) -> str:
    """One output per stage, published as a new version of its path;
    returns the version's folder."""
    return publish(df, path, partition_by)


def read_stage(spark: SparkSession, path: str) -> DataFrame:
    """The latest committed version of a stage's path."""
    found = versions(spark, path.rstrip("/"))
    if not found:
        raise FileNotFoundError(f"{path} has no committed version")
    return spark.read.parquet(found[-1])
