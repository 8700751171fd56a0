"""File sources: crawler JSON, CSV in unknown encodings, positional CSV, folder scans, logs."""

from __future__ import annotations

import datetime
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.functions.text import date_from_filename
from weftline.session import ship

POST = T.StructType([T.StructField(n, T.StringType()) for n in ("post_id", "id", "url", "site", "board", "title", "author", "timestamp", "category", "content", "contentHtml", "content_hash", "crawledAt")] + [T.StructField(n, T.LongType()) for n in ("view_count", "like_count", "dislike_count", "comment_count")] + [T.StructField("tags", T.ArrayType(T.StringType())), T.StructField("images", T.ArrayType(T.StringType())), T.StructField("comments", T.StringType())])
META = T.StructType([T.StructField(n, T.StringType()) for n in ("site", "board", "crawled_at", "crawler_version")] + [T.StructField(n, T.LongType()) for n in ("total_posts", "pages_crawled")])
DOCUMENT = T.StructType([T.StructField("meta", META), T.StructField("posts", T.ArrayType(POST))])
#: Encodings tried in this order.
ENCODINGS = ("utf-8-sig", "cp949", "euc-kr", "latin-1")


def read_posts(spark: SparkSession, path: str) -> DataFrame:
    """One row per post of crawler files: file, meta.*, post.*; a root may be a list or one object.

    Recursive comments stay JSON text. An unreadable file fails the read.
    """
    return explode_posts(spark.read.schema(DOCUMENT).option("multiLine", True).option("mode", "FAILFAST").json(path))


def explode_posts(docs: DataFrame) -> DataFrame:
    """One row per post of documents read with the schema DOCUMENT."""
    return docs.select(F.col("_metadata.file_name").alias("file"), "meta", F.explode("posts").alias("post")).select("file", F.col("meta.site").alias("meta_site"), F.col("meta.crawled_at").alias("crawled_at"), "post.*")


def read_posts_stream(spark: SparkSession, folder: str, max_files: int = 100) -> DataFrame:
    """New files of a folder as a stream of posts; a file is read once, by its path."""
    docs = spark.readStream.schema(DOCUMENT).option("multiLine", True).option("maxFilesPerTrigger", max_files).json(folder)
    return docs.select("meta", F.explode("posts").alias("post")).select(F.col("meta.site").alias("meta_site"), "post.*")


def arrivals(spark: SparkSession, folder: str, cursor: DataFrame | None, pattern: str = "*.json") -> DataFrame:
    """(file, mtime, kind) of files that are new or were written again since ``cursor`` (file, mtime), in the order of their names.

    A file stream reads a path once; this also tells files that changed under
    their path. The result without ``kind`` is what the next cursor takes up.
    """
    now = _scan(spark, folder, pattern, ["path", "modificationTime"]).select(F.url_decode(F.replace(F.element_at(F.split("path", "/"), -1), F.lit("+"), F.lit("%2B"))).alias("file"), F.col("modificationTime").alias("mtime"))
    if cursor is None:
        return now.withColumn("kind", F.lit("new")).orderBy("file")
    known = now.join(cursor.select("file", F.col("mtime").alias("__seen")), "file", "left")
    kind = F.when(F.col("__seen").isNull(), "new").when(F.col("mtime") > F.col("__seen"), "changed")
    return known.withColumn("kind", kind).where("kind is not null").select("file", "mtime", "kind").orderBy("file")


def post_id_counts(posts: DataFrame) -> DataFrame:
    """Posts, distinct ids and repeated ids of every file."""
    return posts.groupBy("file").agg(F.count(F.lit(1)).alias("posts"), F.countDistinct("post_id").alias("ids")).withColumn("repeated", F.col("posts") - F.col("ids"))


def _scan(spark: SparkSession, folder: str, pattern: str, columns: list[str]) -> DataFrame:
    """Files of a folder; empty ones too, which the scan itself passes over."""
    full = _read(spark, folder, pattern, columns)
    jvm, root = spark._jvm, spark._jvm.org.apache.hadoop.fs.Path(folder)
    listed = root.getFileSystem(spark._jsc.hadoopConfiguration()).listFiles(root, True)
    empty = []
    while listed.hasNext():
        f = listed.next()
        if f.getLen() == 0 and jvm.org.apache.hadoop.fs.GlobPattern(pattern).matches(f.getPath().getName()):
            empty.append({"path": f.getPath().toString(), "modificationTime": datetime.datetime.fromtimestamp(f.getModificationTime() / 1000), "length": 0, "content": bytearray()})
    if not empty:
        return full
    return full.unionByName(spark.createDataFrame([tuple(e[c] for c in columns) for e in empty], full.schema))


def _read(spark: SparkSession, folder: str, pattern: str, columns: list[str]) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(folder).select(*columns)


def file_versions(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """(stem, version, mtime): version is the md5 of the bytes."""
    f = _scan(spark, folder, pattern, ["path", "modificationTime", "content"])
    return f.select(F.regexp_extract("path", r"([^/]+?)(?:\.[^./]*)?$", 1).alias("stem"), F.md5("content").alias("version"), F.col("modificationTime").alias("mtime"))


def changed_files(now: DataFrame, seen: DataFrame) -> DataFrame:
    """Files that are new or whose version differs from the one seen, by name."""
    return now.join(seen.select("stem", F.col("version").alias("__v")), "stem", "left").where(~F.col("version").eqNullSafe(F.col("__v"))).drop("__v").orderBy("stem")


def dated_files(spark: SparkSession, folder: str, pattern: str = "*.csv") -> DataFrame:
    """(file, month) of non-empty files with a date in their names."""
    f = _scan(spark, folder, pattern, ["path", "length"]).where("length > 0").select(F.element_at(F.split("path", "/"), -1).alias("file"))
    return f.withColumn("month", F.date_format(date_from_filename(F.url_decode("file")), "yyyy-MM")).where("month is not null")


def check_files(spark: SparkSession, folder: str, least: int = 100_000, suffix: str = ".csv") -> DataFrame:
    """(file, valid, reason, size): the first check that fails names the reason."""
    f = _scan(spark, folder, "*", ["path", "length", "content"])
    head = F.split_part(F.decode(F.substring("content", 1, 4096), "ISO-8859-1"), F.lit("\n"), F.lit(1))
    reason = F.when(F.col("length") < least, "too small").when(F.trim(head) == "", "empty first line").when(~head.rlike("[,\t]"), "no delimiter").when(~F.lower("path").endswith(suffix), "suffix")
    return f.select(F.element_at(F.split("path", "/"), -1).alias("file"), reason.isNull().alias("valid"), reason.alias("reason"), F.col("length").alias("size"))


def read_csv_probe(spark: SparkSession, folder: str, columns: list[str], pattern: str = "*.csv", encodings: tuple[str, ...] = ENCODINGS) -> DataFrame:
    """All-string rows (file, line, columns) of CSV files, each in the first encoding that decodes it.

    If none does, bytes that can't be decoded are replaced. Rows of another
    width are left out; '' is null. A file is read by one task: keep files to
    what a task can hold.
    """
    import csv
    import io

    ship(spark)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, content in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                for e in encodings:
                    try:
                        text = content.decode(e)
                        break
                    except UnicodeDecodeError:
                        continue
                else:
                    text = content.decode("utf-8", errors="replace")
                out = [(path.rpartition("/")[2], i, *(x or None for x in row)) for i, row in enumerate(csv.reader(io.StringIO(text))) if i and len(row) == len(columns)]
                yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in out], pa.string()), pa.array([r[1] for r in out], pa.int64()), *(pa.array([r[k + 2] for r in out], pa.string()) for k in range(len(columns)))], ["file", "line", *columns])

    schema = ", ".join(["file string", "line long", *(f"`{c}` string" for c in columns)])
    return _scan(spark, folder, pattern, ["path", "content"]).mapInArrow(run, schema)


def read_positional_csv(spark: SparkSession, path: str, schema: T.StructType, encoding: str = "UTF-8") -> DataFrame:
    """CSV whose header is skipped and whose columns are named by position; splittable.

    All columns are read as text and cast; ``_bad`` marks rows with a value
    that could not be cast.
    """
    raw = spark.read.option("header", True).option("enforceSchema", True).option("encoding", encoding).schema(T.StructType([T.StructField(f.name, T.StringType()) for f in schema])).csv(path)
    bad = F.lit(False)
    for f in schema:
        bad = bad | (F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull())
    return raw.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema], bad.alias("_bad"))


def parse_run_log(df: DataFrame, text: str, keep: list[str] = ()) -> DataFrame:
    """(keep..., at, level, message, code) of log lines HH:mm:ss LEVEL message rc=code in a text column."""
    line = F.explode(F.split(text, "\n")).alias("line")
    e = df.select(*keep, line)
    part = lambda i: F.regexp_extract("line", r"^([0-9]{2}:[0-9]{2}:[0-9]{2}) ([A-Z]+) (.*?)(?: rc=([0-9]+))?$", i)
    return e.select(*keep, part(1).alias("at"), part(2).alias("level"), part(3).alias("message"), part(4).try_cast("int").alias("code")).where("at <> ''")


def with_defaults(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Schema-tolerant read: columns that are missing appear as nulls of the given type."""
    have = set(df.columns)
    return df.select("*", *[F.lit(None).cast(t).alias(c) for c, t in columns.items() if c not in have])


def cast_columns(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Columns cast without failing; a value that can't be cast is null."""
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in types.items()})

