"""Cutting lineage in a way that survives the loss of executors."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from weftline.session import checkpoint_dir


#: Bytes up to which ``spread`` may shuffle a table.
SMALL = 1 << 30


def spread(df: DataFrame, key: str) -> DataFrame:
    """A small ``df`` over at least as many partitions as there are cores, for work that is heavy per row.

    A small table often is one file and would keep one core busy. What is
    estimated at more than SMALL bytes is split by its scan (see
    spark.sql.files.maxPartitionBytes) and never shuffled here, whatever the
    number of cores; nor is what already fills the cores.
    """
    if int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) > SMALL:
        return df
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores, key)


_WRITTEN: list[str] = []


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it back.

    Unlike a checkpointed RDD the copy is columnar and compressed, so later
    reads prune columns and push filters; unlike a local checkpoint it does
    not depend on any executor staying alive. Void columns become strings.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/cut-{uuid.uuid4().hex}"
    for name, kind in df.dtypes:
        if kind == "void":
            df = df.withColumn(name, df[name].cast("string"))
    df.write.parquet(path)
    _WRITTEN.append(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._weftline_path = path
    return out


def forget(df: DataFrame) -> None:
    """Delete the files behind a ``cut`` result that is no longer read."""
    path = getattr(df, "_weftline_path", None)
    if path:
        remove(df.sparkSession, path)


def forget_all(spark: SparkSession) -> int:
    """Delete every copy this process has made; call it when no result that reads one is open any more."""
    n = len(_WRITTEN)
    while _WRITTEN:
        remove(spark, _WRITTEN.pop())
    return n


@contextmanager
def scope(spark: SparkSession) -> Iterator[None]:
    """Delete the copies made inside once the block ends: write or collect its results before."""
    before = len(_WRITTEN)
    try:
        yield
    finally:
        while len(_WRITTEN) > before:
            remove(spark, _WRITTEN.pop())


def remove(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
