"""Data-quality operators."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, and how often."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def assert_unique(df: DataFrame, keys: list[str]) -> DataFrame:
    if rows := duplicates(df, keys).take(1):
        raise ValueError(f"more than one row with {', '.join(f'{k}={rows[0][k]}' for k in keys)}")
    return df


def assert_fresh(df: DataFrame, column: str, as_of: datetime.datetime, max_age: datetime.timedelta) -> DataFrame:
    newest = df.agg(F.max(column)).first()[0]
    if newest is None or as_of - newest > max_age:
        raise ValueError(f"newest {column} is {newest}, more than {max_age} before {as_of}")
    return df


def assert_rows(df: DataFrame, least: int = 1) -> DataFrame:
    if len(df.take(least)) < least:
        raise ValueError(f"fewer than {least} rows")
    return df


def quarantine(df: DataFrame, rules: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """(good rows, bad rows with ``reason``): the first rule that holds names the reason; an unknown rule doesn't hold."""
    reason = F.lit(None).cast("string")
    for name, bad in reversed(rules.items()):
        reason = F.when(F.coalesce(bad, F.lit(False)), name).otherwise(reason)
    marked = df.withColumn("reason", reason)
    return marked.where(F.col("reason").isNull()).drop("reason"), marked.where(F.col("reason").isNotNull())


def coverage(df: DataFrame, cols: list[str]) -> DataFrame:
    """Rows and known values of each column."""
    return df.agg(F.count(F.lit(1)).alias("rows"), *[F.count(c).alias(c) for c in cols])


def freshness(df: DataFrame, column: str, as_of: datetime.datetime, max_age: datetime.timedelta) -> DataFrame:
    """(newest, fresh): whether the newest time is at most ``max_age`` before ``as_of``; an empty table isn't fresh."""
    newest = F.max(column)
    return df.agg(newest.alias("newest"), F.coalesce(newest >= F.lit(as_of - max_age), F.lit(False)).alias("fresh"))


def objects(spark: SparkSession, wanted: dict[str, list[str]]) -> DataFrame:
    """(kind, name, present) of functions, views and tables that something needs."""
    have = {"function": spark.catalog.functionExists, "view": spark.catalog.tableExists, "table": spark.catalog.tableExists}
    return spark.createDataFrame([(kind, n, bool(have[kind](n))) for kind, names in wanted.items() for n in names], "kind string, name string, present boolean")


def reachable(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(path, reachable): whether each path is there; one whose store doesn't answer is not."""

    def there(path: str) -> bool:
        try:
            p = spark._jvm.org.apache.hadoop.fs.Path(path)
            return bool(p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p))
        except Exception:  # noqa: BLE001
            return False

    return spark.createDataFrame([(p, there(p)) for p in paths], "path string, reachable boolean")


def skip_batches(df: DataFrame, keys: list[str], bad: Column) -> DataFrame:
    """Rows of the batches (by ``keys``) without a bad row: a bad batch is passed over whole. Null keys are a batch."""
    spoilt = df.where(bad).select(*[F.col(k).alias(f"__{k}") for k in keys]).distinct()
    return df.join(spoilt, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys], "left_anti")


def recount(df: DataFrame, source: str, row_id: str, items: str, stated: str) -> DataFrame:
    """Per source: rows, repeated ids, and rows whose stated count isn't that of their items (null counts as none)."""
    counted = F.coalesce(F.size(F.col(items)), F.lit(0))
    return df.groupBy(source).agg(F.count(F.lit(1)).alias("posts"), (F.count(F.lit(1)) - F.countDistinct(row_id)).alias("repeated"), F.count_if(counted != F.coalesce(F.col(stated), F.lit(0))).alias("differing"))
