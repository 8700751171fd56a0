"""Named Parquet tables of a directory."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from weftline.session import ship


def table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return ship(spark).read.parquet(f"{directory}/{name}.parquet")


def jdbc_query(spark: SparkSession, url: str, query: str, *, column: str | None = None, lower: object = None, upper: object = None, parts: int = 1, **options: str) -> DataFrame:
    """Result of a query of a database; with ``column`` it is read in ``parts`` ranges of it between ``lower`` and ``upper``.

    Rows outside the bounds come with the first and last range, and nulls with
    the first, so the bounds drop nothing. What is filtered and selected
    afterwards is pushed to the database. ``options``: user, password, driver,
    fetchsize and the like.
    """
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", f"({query}) q").options(**options)
    if column:
        reader = reader.option("partitionColumn", column).option("lowerBound", lower).option("upperBound", upper).option("numPartitions", parts)
    return reader.load()
