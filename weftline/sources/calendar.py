"""Business-day calendars and sweeps over days."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def business_days(spark: SparkSession, first: datetime.date, last: datetime.date, holidays: DataFrame | None = None) -> DataFrame:
    """(date): Mondays to Fridays that aren't holidays."""
    days = spark.range(1).select(F.explode(F.sequence(F.lit(first), F.lit(last))).alias("date")).where(F.weekday("date") < 5)
    return days if holidays is None else days.join(holidays.select("date"), "date", "left_anti")


def month_end_business_days(spark: SparkSession, first_year: int, last_year: int, ref: datetime.date, holidays: DataFrame | None = None, hold_back: int = 43) -> DataFrame:
    """(date): last business day of every month, a business day earlier in December, up to ``hold_back`` days before ``ref``."""
    days = business_days(spark, datetime.date(first_year, 1, 1), datetime.date(last_year, 12, 31), holidays)
    top = days.groupBy(F.date_trunc("month", "date").cast("date").alias("m")).agg(F.slice(F.sort_array(F.collect_list("date"), asc=False), 1, 2).alias("d"))
    date = F.when(F.month("m") == 12, F.coalesce(F.get("d", F.lit(1)), F.get("d", F.lit(0)))).otherwise(F.get("d", F.lit(0)))
    return top.select(date.alias("date")).where(F.col("date") <= F.date_sub(F.lit(ref), hold_back))


def sweep(days: DataFrame, exchanges: list[str]) -> DataFrame:
    """(date, exchange): every day for every exchange, the partitions of a historical load."""
    return days.select("date", F.explode(F.array(*[F.lit(e) for e in exchanges])).alias("exchange"))
