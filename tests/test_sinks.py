import os

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from cohortgrid.sources.sinks import MANIFESTS, publish, read_stage, vacuum, versions


def rows(df):
    return sorted(r.id for r in df.collect())


def test_versions(spark, tmp_path):
    path = f"{tmp_path}/stage"
    with pytest.raises(FileNotFoundError):
        read_stage(spark, path)
    first = publish(spark.range(3), path)
    held = read_stage(spark, path)
    second = publish(read_stage(spark, path).filter("id > 0"), path)  # from the version before
    assert versions(spark, path) == [first, second]
    assert rows(read_stage(spark, path)) == [1, 2]
    assert rows(held) == [0, 1, 2], "a reader keeps what it opened"


def test_failed_write_leaves_the_old_version(spark, tmp_path):
    path = f"{tmp_path}/stage"
    publish(spark.range(3), path)
    broken = spark.range(1000).select(F.when(F.col("id") < 990, F.col("id")).otherwise(F.raise_error(F.lit("lost"))).cast("long").alias("id"))
    with pytest.raises(PySparkException):
        publish(broken, path)
    assert rows(read_stage(spark, path)) == [0, 1, 2] and len(versions(spark, path)) == 1


def test_uncommitted_folders_are_not_read(spark, tmp_path):
    path = f"{tmp_path}/stage"
    good = publish(spark.range(2), path)
    spark.range(9).write.parquet(f"{path}/v-torn")  # a run that died before its manifest
    assert rows(read_stage(spark, path)) == [0, 1]
    publish(spark.range(1), path)
    vacuum(spark, path, keep=2)
    assert os.path.isdir(good) and not os.path.isdir(f"{path}/v-torn")
    vacuum(spark, path)
    assert rows(read_stage(spark, path)) == [0] and not os.path.isdir(good)
    assert len([f for f in os.listdir(f"{path}/{MANIFESTS}") if not f.startswith(".")]) == 1


def test_two_writers(spark, tmp_path):
    """Both began before either committed: both versions are whole, and all
    readers agree on the latest."""
    path = f"{tmp_path}/stage"
    a, b = publish(spark.range(1), path), publish(spark.range(2), path)
    name = lambda p: os.path.basename(p)
    manifests = f"{path}/{MANIFESTS}"
    os.rename(f"{manifests}/{1:010d}.{name(b)}", f"{manifests}/{0:010d}.{name(b)}")
    assert versions(spark, path) == sorted([a, b])
    assert rows(read_stage(spark, path)) == rows(spark.read.parquet(max(a, b)))
