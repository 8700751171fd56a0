"""Changes between the full listings of each exchange, and their queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.operators.snapshots import snapshot_changes
from weftline.sources.tables import table


def collapse_space(c: Column) -> Column:
    """Trim and collapse white space of any kind; (?U) makes \\s follow Unicode."""
    return F.trim(F.regexp_replace(c, r"(?U)[\s\u001C-\u001F]+", " "))


def ticker_code(c: Column) -> Column:
    """A listing code with its leading zeros; longer codes stay whole."""
    t = F.trim(F.regexp_replace(c, r"(?U)\s+", ""))
    return F.when(F.length(t) >= 6, t).when(F.length(t) > 0, F.lpad(t, 6, "0"))


def listing_changes(listing: DataFrame) -> DataFrame:
    canonical = listing.select("exchange", F.col("date").cast("date").alias("date"), ticker_code(F.col("ticker")).alias("ticker"), collapse_space(F.col("name")).alias("name"))
    out = snapshot_changes(canonical, ["exchange"], "date", ["ticker"], ["name"])
    return out.select("exchange", F.date_format("date", "yyyy-MM-dd").alias("date"), "ticker", "change")


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return listing_changes(table(spark, d, "stockcodename"))


QUERIES = {"p2_found": p2_found}

SPACE = r"[\s\x{0B}\x{1C}-\x{1F}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+"

SQL = {
    "p2_found": rf"""
WITH r AS (
  SELECT exchange, date, lpad(trim(ticker), 6, '0') AS ticker, max(trim(regexp_replace(name, '{SPACE}', ' ', 'g'))) AS name
  FROM stockcodename WHERE exchange IS NOT NULL AND date IS NOT NULL AND ticker IS NOT NULL GROUP BY ALL),
s AS (SELECT exchange, date, lag(date) OVER (PARTITION BY exchange ORDER BY date) AS before FROM (SELECT DISTINCT exchange, date FROM r)),
n AS (SELECT r.*, s.before FROM r JOIN s USING (exchange, date) WHERE s.before IS NOT NULL),
o AS (SELECT r.exchange, s.date, r.ticker, r.name FROM r JOIN s ON r.exchange = s.exchange AND r.date = s.before)
SELECT coalesce(n.exchange, o.exchange) AS exchange, strftime(coalesce(n.date, o.date), '%Y-%m-%d') AS date, coalesce(n.ticker, o.ticker) AS ticker,
  CASE WHEN o.ticker IS NULL THEN 'added' WHEN n.ticker IS NULL THEN 'removed' ELSE 'changed' END AS change
FROM n FULL JOIN o ON n.exchange = o.exchange AND n.date = o.date AND n.ticker = o.ticker
WHERE o.ticker IS NULL OR n.ticker IS NULL OR (n.name <> o.name)
""",
}
