"""Sinks: partition overwrite, append, atomic snapshots, delimited text."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def overwrite_partitions(df: DataFrame, path: str, cols: list[str]) -> None:
    """Replace exactly the partitions that ``df`` has rows in; one set of files per partition value."""
    df.repartition(*cols).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*cols).parquet(path)


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def publish_snapshot(df: DataFrame, root: str) -> str:
    """Write a new version under ``root`` and only then point readers to it; returns its path.

    The pointer is a small file that is replaced by a rename, so readers see
    the old version or the new one whole, and a path being read is never
    overwritten.
    """
    spark = df.sparkSession
    path = f"{root.rstrip('/')}/v{time.time_ns()}"
    df.write.parquet(path)
    replace_file(spark, f"{root}/current.txt", path)
    return path


def publish_tables(tables: dict[str, DataFrame], root: str) -> None:
    """New versions of several tables, which readers see together: one pointer names them all."""
    import json

    version = time.time_ns()
    paths = {name: f"{root.rstrip('/')}/v{version}/{name}" for name in tables}
    for name, df in tables.items():
        df.write.parquet(paths[name])
    replace_file(next(iter(tables.values())).sparkSession, f"{root}/tables.json", json.dumps(paths))


def current_tables(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The tables that ``publish_tables`` made last, none before the first."""
    import json

    return {name: spark.read.parquet(path) for name, path in json.loads(read_file(spark, f"{root}/tables.json") or "{}").items()}


def replace_file(spark: SparkSession, path: str, content: str) -> None:
    """Write a small file beside ``path`` and rename it over it."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    now, new = jvm.org.apache.hadoop.fs.Path(path), jvm.org.apache.hadoop.fs.Path(f"{path}.next")
    fs = now.getFileSystem(conf)
    out = fs.create(new, True)
    out.write(content.encode())
    out.close()
    fs.delete(now, False)
    if not fs.rename(new, now):
        raise OSError(f"{path} could not be written")


def read_file(spark: SparkSession, path: str) -> str | None:
    """Content of a small file, None if there is none."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def current_snapshot(spark: SparkSession, root: str) -> DataFrame | None:
    """The version that ``publish_snapshot`` made last, None before the first."""
    path = read_file(spark, f"{root}/current.txt")
    return None if path is None else spark.read.parquet(path)


def write_copy_text(df: DataFrame, path: str, null: str = "\\N") -> None:
    """Tab-separated text for bulk loading: null marker, tabs and line breaks in values as spaces."""
    clean = [F.regexp_replace(c, r"[\t\r\n]", " ").alias(c) if t == "string" else F.col(c) for c, t in df.dtypes]
    df.select(*clean).write.mode("overwrite").option("sep", "\t").option("nullValue", null).option("emptyValue", "").option("quote", "\u0000").csv(path)


def write_csv_bom(df: DataFrame, path: str) -> None:
    """CSV with a byte order mark in front of every file's header."""
    head = df.columns[0]
    df.withColumnRenamed(head, f"﻿{head}").write.mode("overwrite").option("header", True).option("lineSep", "\n").csv(path)
