"""Structured Streaming forms of the operators."""

from __future__ import annotations

import datetime
import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from weftline.operators.lineage import cut, forget, remove
from weftline.sources.sinks import read_file, replace_file


def trend_stream(df: DataFrame, key: str, ts: str, value: str, order: str, length: str = "30 minutes", slide: str = "10 minutes", late: str = "1 hour") -> DataFrame:
    """(window_start, window_end, key, first, last, delta, n) per sliding window; rows later than ``late`` are dropped.

    ``ts`` is cast to a time with zone, as watermarks need one.
    """
    o = F.struct(ts, order)
    w = df.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, late)
    g = w.groupBy(F.window(ts, length, slide), key).agg(F.min_by(value, o).alias("first"), F.max_by(value, o).alias("last"), F.count(F.lit(1)).alias("n"))
    return g.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), key, "first", "last", (F.col("last") - F.col("first")).alias("delta"), "n")


def session_stream(df: DataFrame, key: str, ts: str, gap: str = "20 minutes", late: str = "1 hour") -> DataFrame:
    """(session_start, session_end, key, n): runs of rows less than ``gap`` apart."""
    w = df.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, late)
    g = w.groupBy(F.session_window(ts, gap), key).agg(F.count(F.lit(1)).alias("n"))
    return g.select(F.col("session_window.start").alias("session_start"), F.col("session_window.end").alias("session_end"), key, "n")


def dedupe_stream(df: DataFrame, keys: list[str], ts: str, late: str = "1 hour") -> DataFrame:
    """First row of each key; keys are remembered for ``late``."""
    return df.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, late).dropDuplicatesWithinWatermark(keys)


def step(state: tuple[int, float, float], at: float, gap: float, hits: int, cooldown: float) -> tuple[tuple[int, float, float], bool]:
    """One showing at ``at``: (consecutive, last, suppressed until) and whether it is shown.

    A gap longer than ``gap`` starts the count anew; the ``hits``-th showing
    in a row stores 0 and suppresses until ``cooldown`` later.
    """
    consecutive, last, until = state
    if at < until:
        return state, False
    consecutive = consecutive + 1 if consecutive and at - last <= gap else 1
    return ((0, at, at + cooldown) if consecutive >= hits else (consecutive, at, until)), True


def rotation_stream(df: DataFrame, key: str, ts: str, *, gap: int = 1200, hits: int = 3, cooldown: int = 86400, late: str = "1 hour") -> DataFrame:
    """(key, at, consecutive, suppressed_until, shown) of every showing, with the counter kept as keyed state.

    The state of a key ends once the watermark is ``gap + cooldown`` past its
    last showing: from then on it couldn't matter. Rows later than ``late`` are
    dropped; of the others, one that comes after a later row of its key had
    been counted isn't shown and changes nothing.
    """

    def update(k: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        now = tuple(state.get) if state.exists else (0, 0.0, 0.0)
        out = []
        for at in sorted(x for f in frames for x in f["__at"]):
            now, shown = step(now, at, gap, hits, cooldown) if at >= now[1] else (now, False)
            out.append((k[0], at, now[0], now[2], shown))
        state.update(now)
        state.setTimeoutTimestamp(max(int((now[1] + gap + cooldown) * 1000), state.getCurrentWatermarkMs() + 1))
        yield pd.DataFrame(out, columns=["key", "at", "consecutive", "suppressed_until", "shown"])

    rows = df.withColumn("__ts", F.col(ts).cast("timestamp")).withWatermark("__ts", late)
    rows = rows.select(F.col(key).cast("string").alias("key"), "__ts", F.unix_timestamp("__ts").cast("double").alias("__at"))
    return rows.groupBy("key").applyInPandasWithState(update, "key string, at double, consecutive int, suppressed_until double, shown boolean", "consecutive int, last double, until double", "append", GroupStateTimeout.EventTimeTimeout)


def to_table(stream: DataFrame, root: str, checkpoint: str, keys: list[str] | None = None, mode: str | None = None, *, buckets: int = 16, every: str | None = None):
    """Start a query that keeps a table under ``root``; returns it. ``every`` is a processing time, without it all that has come is read once.

    Without ``keys`` rows are appended: an epoch is a folder of its own, which
    a replay of the epoch overwrites. With ``keys`` rows replace those of equal
    keys: the table is hashed into ``buckets`` by key, an epoch writes new
    versions of the buckets it touches and nothing else, and a manifest, which
    is replaced by a rename, then names the version of every bucket. An epoch
    the manifest has is not applied again. Versions that were replaced stay
    for one more epoch, for those who read them, and are deleted then.
    """
    apply = (lambda batch, epoch: merge_epoch(batch, epoch, root, keys, buckets)) if keys else (lambda batch, epoch: batch.write.mode("overwrite").parquet(f"{root}/epoch={epoch}"))
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return stream.writeStream.outputMode(mode or ("update" if keys else "append")).foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(**trigger).start()


def merge_epoch(batch: DataFrame, epoch: int, root: str, keys: list[str], buckets: int = 16) -> None:
    """Put the rows of one epoch in the place of those with equal keys; see ``to_table``."""
    spark = batch.sparkSession
    now = read_manifest(spark, root) or {"epoch": -1, "buckets": {}, "stale": []}
    if now["epoch"] >= epoch:
        return
    rows = cut(batch.withColumn("__bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")))
    touched = [str(r[0]) for r in rows.select("__bucket").distinct().collect()]
    old = [now["buckets"][b] for b in touched if b in now["buckets"]]
    new = rows
    if old:
        before = spark.read.schema(batch.schema).parquet(*old).withColumn("__bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))
        new = before.join(rows.select(*[F.col(k).alias(f"__{k}") for k in keys]), [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys], "left_anti").unionByName(rows)
    if touched:
        new.repartition("__bucket").write.mode("overwrite").partitionBy("__bucket").parquet(f"{root}/epoch={epoch}")
    write_manifest(spark, root, {"epoch": epoch, "buckets": now["buckets"] | {b: f"{root}/epoch={epoch}/__bucket={b}" for b in touched}, "stale": old})
    for path in now["stale"]:
        remove(spark, path)
    forget(rows)


def read_manifest(spark: SparkSession, root: str) -> dict | None:
    content = read_file(spark, f"{root}/_manifest.json")
    return None if content is None else json.loads(content)


def write_manifest(spark: SparkSession, root: str, manifest: dict) -> None:
    replace_file(spark, f"{root}/_manifest.json", json.dumps(manifest))


def current_table(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """What ``to_table`` has kept so far under ``root``; empty before its first epoch."""
    manifest = read_manifest(spark, root)
    if manifest:
        paths = list(manifest["buckets"].values())
        return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)
    p = spark._jvm.org.apache.hadoop.fs.Path(root)
    if not p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(root).select(*schema.names)


def table_stream(spark: SparkSession, directory: str, name: str, files: int = 1000) -> DataFrame:
    """A Parquet table of a folder as a stream of its files."""
    schema = spark.read.parquet(f"{directory}/{name}.parquet").schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).option("recursiveFileLookup", True).parquet(f"{directory}/{name}.parque*")


def fresh(progress: dict, as_of: datetime.datetime, max_age: datetime.timedelta) -> bool:
    """Whether a query's last progress is recent enough."""
    at = datetime.datetime.fromisoformat(progress["timestamp"].replace("Z", "+00:00")).replace(tzinfo=None)
    return as_of - at <= max_age
