"""Queries of sources, sinks, checks and triggers over files that they write from the tables first."""

from __future__ import annotations

import datetime
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.functions import names, text, values
from weftline.operators import checks, state, trees
from weftline.session import checkpoint_dir
from weftline.sources import files, market, sinks
from weftline.sources.tables import table
from weftline.streaming import streams

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def _folder(s: SparkSession, name: str) -> str:
    return f"{checkpoint_dir(s).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _write_files(s: SparkSession, folder: str, content: dict[str, str]) -> None:
    """A handful of small files with given names."""
    for name, x in content.items():
        sinks.replace_file(s, f"{folder}/{name}", x)


# ---- sources


def _crawled(s: SparkSession, d: str) -> str:
    """Crawler files with the posts of all sites, some hundreds a file; posts with one id stand in one file."""
    p = table(s, d, "ss_normalized_posts")
    n = max(1, p.count() // 400)
    post = F.struct("post_id", "url", "title", "author", "content", F.col("channel").alias("board"), F.col("comments_count").cast("long").alias("comment_count"))
    docs = p.groupBy(F.regexp_extract("url", "^[a-zA-Z]+://([^/?#]+)", 1).alias("site"), F.pmod(F.xxhash64("post_id"), F.lit(n)).alias("part")).agg(F.collect_list(post).alias("posts"))
    path = _folder(s, "crawl")
    docs.select(F.struct("site", F.lit("2024-01-01T00:00:00Z").alias("crawled_at")).alias("meta"), "posts").repartition(min(n, 200), "site", F.xxhash64("posts")).write.json(path)
    return path


@query("SELECT regexp_extract(url, '^[a-zA-Z]+://([^/?#]+)', 1) AS meta_site, post_id, url, title, author, comments_count::BIGINT AS comment_count FROM ss_normalized_posts")
def s01_posts(s: SparkSession, d: str) -> DataFrame:
    # one document a line here; a file of one document reads the same
    docs = s.read.schema(files.DOCUMENT).json(_crawled(s, d))
    return files.explode_posts(docs).select("meta_site", "post_id", "url", "title", "author", "comment_count")


@query("SELECT regexp_extract(url, '^[a-zA-Z]+://([^/?#]+)', 1) AS meta_site, count(*) AS posts FROM ss_normalized_posts GROUP BY 1")
def s02_posts_stream(s: SparkSession, d: str) -> DataFrame:
    docs = s.readStream.schema(files.DOCUMENT).option("maxFilesPerTrigger", 50).json(_crawled(s, d))
    posts = files.explode_posts(docs).select("meta_site", "post_id")
    root = _folder(s, "arrived")
    streams.to_table(posts, f"{root}/table", f"{root}/state").awaitTermination()
    return streams.current_table(s, f"{root}/table", posts.schema).groupBy("meta_site").agg(F.count(F.lit(1)).alias("posts"))


@query("SELECT n_name || '.json' AS file, CASE WHEN n_regionkey = 1 THEN 'changed' ELSE 'new' END AS kind FROM nation WHERE n_regionkey <> 0")
def s02_changed_files(s: SparkSession, d: str) -> DataFrame:
    """One run per file that is new or was touched since the cursor; the cursor knows regions 0 and 1, the latter at an older time."""
    nations = [(r["n_name"], r["n_regionkey"]) for r in table(s, d, "nation").select("n_name", "n_regionkey").collect()]
    folder = _folder(s, "sensor")
    _write_files(s, folder, {f"{n}.json": f'{{"meta": null, "posts": [], "n": "{n}"}}' for n, _ in nations})
    now = files.arrivals(s, folder, None)
    old = s.createDataFrame([(f"{n}.json", r == 1) for n, r in nations if r in (0, 1)], "file string, older boolean")
    cursor = now.join(old, "file").select("file", F.when(F.col("older"), F.col("mtime") - F.expr("interval 1 hour")).otherwise(F.col("mtime")).alias("mtime"))
    return files.arrivals(s, folder, cursor).select("file", "kind")


@query("SELECT n_name AS stem, md5(n_name || ' ' || n_nationkey) AS version FROM nation")
def s03_versions(s: SparkSession, d: str) -> DataFrame:
    folder = _folder(s, "versions")
    _write_files(s, folder, {f"{r['n_name']}.json": f"{r['n_name']} {r['n_nationkey']}" for r in table(s, d, "nation").collect()})
    return files.file_versions(s, folder, "*.json").select(F.url_decode(F.replace("stem", F.lit("+"), F.lit("%2B"))).alias("stem"), "version")


@query("SELECT count(*) AS posts, count(DISTINCT post_id) AS ids, count(*) - count(DISTINCT post_id) AS repeated FROM ss_normalized_posts")
def s04_id_counts(s: SparkSession, d: str) -> DataFrame:
    """Diagnostics of all files, added up: posts with one id stand in one file."""
    docs = s.read.schema(files.DOCUMENT).json(_crawled(s, d))
    per = files.post_id_counts(files.explode_posts(docs))
    return per.agg(F.sum("posts").alias("posts"), F.sum("ids").alias("ids"), F.sum("repeated").alias("repeated"))


@query("SELECT company_id::VARCHAR AS id, canonical_name AS name, addr_key FROM dim_company")
def s05_probe(s: SparkSession, d: str) -> DataFrame:
    """Files in two Korean encodings; both are read as what they are."""
    folder = _folder(s, "encodings")
    c = table(s, d, "dim_company").select(F.col("company_id").cast("string").alias("id"), F.col("canonical_name").alias("name"), "addr_key")
    before = s.conf.get("spark.sql.legacy.javaCharsets")
    s.conf.set("spark.sql.legacy.javaCharsets", "true")
    try:
        for k, encoding in enumerate(("UTF-8", "x-windows-949")):
            c.where(F.pmod(F.col("id").cast("long"), F.lit(2)) == k).write.option("header", True).option("encoding", encoding).option("quoteAll", True).mode("append").csv(folder)
    finally:
        s.conf.set("spark.sql.legacy.javaCharsets", before)
    return files.read_csv_probe(s, folder, ["id", "name", "addr_key"]).select("id", "name", "addr_key")


@query("SELECT o_orderpriority, count(*) AS n, round(sum(o_totalprice), 2) AS total, count(*) FILTER (WHERE o_orderkey % 10 = 0) AS bad FROM orders GROUP BY 1")
def s06_positional(s: SparkSession, d: str) -> DataFrame:
    """Columns by position; every tenth key is no number."""
    path = _folder(s, "positional")
    o = table(s, d, "orders").select(F.when(F.col("o_orderkey") % 10 == 0, "x").otherwise(F.col("o_orderkey").cast("string")).alias("a"), F.col("o_totalprice").alias("b"), F.col("o_orderpriority").alias("c"))
    o.write.option("header", True).csv(path)
    schema = T.StructType([T.StructField("key", T.LongType()), T.StructField("total", T.DoubleType()), T.StructField("o_orderpriority", T.StringType())])
    r = files.read_positional_csv(s, path, schema)
    return r.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("total"), 2).alias("total"), F.count_if("_bad").alias("bad"))


@query("SELECT DISTINCT strftime(data_created_ym, '%Y%m%d') || '_list.csv' AS file, strftime(data_created_ym, '%Y-%m') AS month FROM pension")
def s07_dated_files(s: SparkSession, d: str) -> DataFrame:
    """A file a month; an empty one and one without a date are passed over."""
    folder = _folder(s, "dated")
    months = [r[0] for r in table(s, d, "pension").select(F.date_format("data_created_ym", "yyyyMMdd")).distinct().collect()]
    _write_files(s, folder, {f"{m}_list.csv": "a,b\n" for m in months} | {"19990101_list.csv": "", "none.csv": "a,b\n"})
    return files.dated_files(s, folder)


@query("SELECT strftime(date, '%Y-%m-%d') AS date, ticker, exchange, name FROM stockcodename")
def s08_market(s: SparkSession, d: str) -> DataFrame:
    """Every day and exchange is an input partition that reads its own folder."""
    path = _folder(s, "market")
    t = table(s, d, "stockcodename").select("date", "ticker", "exchange", "name")
    t.repartition("date", "exchange").write.partitionBy("date", "exchange").parquet(f"{path}/names")
    listed = t.select("date", "exchange").distinct().collect()
    s.dataSource.register(market.MarketSource)
    r = s.read.format("weftline_market").option("path", path).option("kind", "names").option("dates", ",".join(sorted({str(x["date"]) for x in listed}))).option("exchanges", ",".join(sorted({x["exchange"] for x in listed}))).load()
    return r.select(F.date_format("date", "yyyy-MM-dd").alias("date"), "ticker", "exchange", "name")


@query("""WITH f AS (SELECT r_name AS file, string_agg(n_name, ',' ORDER BY n_name) AS line FROM region JOIN nation ON n_regionkey = r_regionkey GROUP BY 1)
SELECT file || '.csv' AS file, length(line) >= 44 AS valid, CASE WHEN length(line) < 44 THEN 'too small' END AS reason, length(line) AS size FROM f UNION ALL SELECT file || '.txt', false, CASE WHEN length(line) < 44 THEN 'too small' ELSE 'suffix' END, length(line) FROM f""")
def s18_file_checks(s: SparkSession, d: str) -> DataFrame:
    folder = _folder(s, "checks")
    r, n = table(s, d, "region"), table(s, d, "nation")
    lines = r.join(n, F.col("n_regionkey") == F.col("r_regionkey")).groupBy("r_name").agg(F.array_join(F.array_sort(F.collect_list("n_name")), ",").alias("line")).collect()
    _write_files(s, folder, {f"{x['r_name']}.{e}": x["line"] for x in lines for e in ("csv", "txt")})
    return files.check_files(s, folder, least=44).withColumn("file", F.url_decode("file"))


# ---- sinks


@query("SELECT exchange, strftime(date, '%Y-%m') AS month, count(*) AS n, count(name) AS named FROM (SELECT exchange, date, CASE WHEN strftime(date, '%m') = '03' THEN upper(name) ELSE name END AS name FROM stockcodename) GROUP BY ALL")
def w02_replace_pairs(s: SparkSession, d: str) -> DataFrame:
    """All (exchange, month) pairs of a March are deleted and loaded again, in bulk."""
    path = _folder(s, "pairs")
    t = table(s, d, "stockcodename").withColumn("month", F.date_format("date", "yyyy-MM"))
    sinks.overwrite_partitions(t, path, ["exchange", "month"])
    sinks.overwrite_partitions(t.where("month like '%-03'").withColumn("name", F.upper("name")), path, ["exchange", "month"])
    r = s.read.parquet(path)
    return r.groupBy("exchange", F.col("month").cast("string").alias("month")).agg(F.count(F.lit(1)).alias("n"), F.count("name").alias("named"))


@query(r"SELECT post_id, regexp_replace(title, '[\t\r\n]', ' ', 'g') AS title, city FROM ss_normalized_posts WHERE title <> ''")
def w03_copy_text(s: SparkSession, d: str) -> DataFrame:
    path = _folder(s, "copy")
    sinks.write_copy_text(table(s, d, "ss_normalized_posts").where("title <> ''").select("post_id", "title", "city"), path)
    t = s.read.text(path).select(F.split("value", "\t").alias("v"))
    null = lambda i: F.nullif(F.get("v", F.lit(i)), F.lit("\\N"))
    return t.select(F.get("v", F.lit(0)).alias("post_id"), F.get("v", F.lit(1)).alias("title"), null(2).alias("city"))


@query("SELECT coalesce(n.k, o.k) AS p_partkey, CASE WHEN n.k IS NOT NULL THEN n.v ELSE o.v END AS price FROM (SELECT p_partkey AS k, p_retailprice AS v FROM part) o FULL JOIN (SELECT p_partkey + 7 AS k, p_retailprice * 2 AS v FROM part WHERE p_size > 25) n ON n.k = o.k")
def w04_upsert_sink(s: SparkSession, d: str) -> DataFrame:
    """Two epochs into a table of buckets: the second updates and inserts."""
    root = _folder(s, "upsert")
    p = table(s, d, "part")
    first = p.select("p_partkey", F.col("p_retailprice").alias("price"))
    streams.merge_epoch(first, 0, root, ["p_partkey"])
    streams.merge_epoch(p.where("p_size > 25").select((F.col("p_partkey") + 7).alias("p_partkey"), (F.col("p_retailprice") * 2).alias("price")), 1, root, ["p_partkey"])
    return streams.current_table(s, root, first.schema)


@query("SELECT c_custkey::VARCHAR AS id, c_name AS name, true AS marked FROM customer")
def w05_csv_bom(s: SparkSession, d: str) -> DataFrame:
    """Files begin with the byte order mark, which readers see in the first column's name."""
    path = _folder(s, "bom")
    sinks.write_csv_bom(table(s, d, "customer").select(F.col("c_custkey").cast("string").alias("id"), F.col("c_name").alias("name")), path)
    head = s.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(path).agg(F.bool_and(F.hex(F.substring("content", 1, 3)) == "EFBBBF").alias("marked"))
    return s.read.option("header", True).schema("id string, name string").option("enforceSchema", True).csv(path).crossJoin(F.broadcast(head))


@query("SELECT 'customer' AS name, count(*) AS n FROM customer WHERE c_acctbal > 0 UNION ALL SELECT 'supplier', count(*) FROM supplier WHERE s_acctbal > 0")
def w06_rebuild(s: SparkSession, d: str) -> DataFrame:
    """Two tables are rebuilt together: readers see both old versions or both new ones."""
    root = _folder(s, "rebuild")
    t = {n: table(s, d, n) for n in ("customer", "supplier")}
    sinks.publish_tables(t, root)
    old = sinks.current_tables(s, root)
    sinks.publish_tables({n: df.where(f"{n[0]}_acctbal > 0") for n, df in old.items()}, root)
    counts = [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(n).alias("name"), "n") for n, df in sinks.current_tables(s, root).items()]
    return counts[0].unionByName(counts[1])


@query("SELECT event_type AS message, count(*) AS n FROM events GROUP BY 1 UNION ALL SELECT 'late ' || event_type, count(*) FROM events WHERE value IS NULL OR value > 50 GROUP BY 1")
def w08_append_log(s: SparkSession, d: str) -> DataFrame:
    path = _folder(s, "log")
    e = table(s, d, "events")
    sinks.append(e.select(F.col("event_type").alias("message")), path)
    sinks.append(e.where("value is null or value > 50").select(F.concat(F.lit("late "), "event_type").alias("message")), path)
    return s.read.parquet(path).groupBy("message").agg(F.count(F.lit(1)).alias("n"))


# ---- trees, markup, numbers


@query("""WITH n AS (SELECT *, row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) AS i FROM nation) SELECT r_regionkey::VARCHAR AS post_id, 'r' || r_regionkey AS id, NULL AS parent_id, 'r' || r_regionkey AS root_id, '001' AS path, 0 AS depth, r_name AS author FROM region
UNION ALL SELECT n_regionkey::VARCHAR, 'n' || n_nationkey, 'r' || n_regionkey, 'r' || n_regionkey, '001.' || lpad(i::VARCHAR, 3, '0'), 1, n_name FROM n
UNION ALL SELECT n_regionkey::VARCHAR, 'x' || n_nationkey, 'n' || n_nationkey, 'r' || n_regionkey, '001.' || lpad(i::VARCHAR, 3, '0') || '.001', 2, NULL FROM n""")
def f07_flatten(s: SparkSession, d: str) -> DataFrame:
    """A region is a comment, its nations are replies and have one reply each."""
    n = table(s, d, "nation").withColumn("reply", F.struct(F.concat(F.lit("n"), "n_nationkey").alias("id"), F.col("n_name").alias("author"), F.array(F.struct(F.concat(F.lit("x"), "n_nationkey").alias("id"))).alias("replies")))
    r = n.groupBy("n_regionkey").agg(F.transform(F.array_sort(F.collect_list(F.struct("n_nationkey", "reply"))), lambda x: x["reply"]).alias("replies"))
    posts = table(s, d, "region").join(r, F.col("n_regionkey") == F.col("r_regionkey")).select("r_regionkey", F.to_json(F.array(F.struct(F.concat(F.lit("r"), "r_regionkey").alias("id"), F.col("r_name").alias("author"), "replies"))).alias("js"))
    return trees.flatten_comments(posts, "r_regionkey", "js").select("post_id", "id", "parent_id", "root_id", "path", "depth", "author")


@query("""WITH RECURSIVE e AS (SELECT doc_id, CASE WHEN thread_id <> doc_id THEN thread_id END AS parent FROM documents), i AS (SELECT *, row_number() OVER (PARTITION BY parent ORDER BY doc_id)::VARCHAR AS i FROM e),
t AS (SELECT doc_id AS node, lpad(i, greatest(3, length(i))::INT, '0') AS path FROM i WHERE parent IS NULL UNION ALL SELECT i.doc_id, t.path || '.' || lpad(i.i, greatest(3, length(i.i))::INT, '0') FROM i JOIN t ON i.parent = t.node) SELECT node, path FROM t""")
def f08_paths(s: SparkSession, d: str) -> DataFrame:
    e = table(s, d, "documents").select("doc_id", F.when(F.col("thread_id") != F.col("doc_id"), F.col("thread_id")).alias("parent"))
    return trees.build_paths(e, "doc_id", "parent", "doc_id").select("node", "path")


@query("""WITH b AS (SELECT p_partkey, unnest([{k: 'text', v: p_name || ' of ' || p_brand}, {k: 'image', v: 'https://a.example/' || p_partkey || '.png'}, {k: 'text', v: p_type || ' <' || p_size || '>'}, {k: 'image', v: 'b/' || p_size || '.jpg'}]) AS b, unnest([0, 1, 2, 3]) AS i FROM part) SELECT p_partkey, i::INT AS "at", b.k AS kind, b.v AS value FROM b""")
def f16_blocks(s: SparkSession, d: str) -> DataFrame:
    html = F.concat(F.lit("<p>"), "p_name", F.lit("&nbsp;of <b>"), "p_brand", F.lit("</b></p>\n<img class='x' src=\"https://a.example/"), "p_partkey", F.lit(".png\" alt=''>"), "p_type", F.lit(" &lt;"), "p_size", F.lit("&gt;<IMG SRC=b/"), "p_size", F.lit(".jpg>"))
    return table(s, d, "part").select("p_partkey", F.posexplode(text.html_blocks(html)).alias("at", "b")).select("p_partkey", "at", "b.kind", "b.value")


@query("SELECT c_custkey, round_even(c_acctbal, 1) AS half_even, round(c_acctbal, 1) AS half_up, CASE WHEN c_nationkey > 0 THEN round_even(c_custkey / 7, 3) END AS ratio, exp(-abs(c_acctbal) / 1000) AS faded FROM customer")
def f50_rounding(s: SparkSession, d: str) -> DataFrame:
    b = F.col("c_acctbal")
    return table(s, d, "customer").select("c_custkey", F.bround(b, 1).alias("half_even"), F.round(b, 1).alias("half_up"), values.ratio(F.col("c_custkey"), F.when(F.col("c_nationkey") > 0, 7).otherwise(0), 3).alias("ratio"), values.decay(F.lit(1.0), F.abs(b), 1000.0).alias("faded"))


@query("SELECT event_id, CASE event_id % 6 WHEN 0 THEN 'image/png' WHEN 1 THEN 'image/jpeg' WHEN 2 THEN 'image/gif' WHEN 3 THEN 'image/webp' WHEN 4 THEN 'image/bmp' END AS mime FROM events")
def f52_mime(s: SparkSession, d: str) -> DataFrame:
    heads = F.array(*[F.lit(x) for x in ("89504E470D0A1A0A00000000", "FFD8FFE000104A4649460001", "474946383961010001008000", "524946461A00000057454250", "424D46000000000000003600", "3C68746D6C3E0A3C68656164")])
    e = table(s, d, "events").select("event_id", F.unhex(F.get(heads, (F.col("event_id") % 6).cast("int"))).alias("content"))
    return e.select("event_id", values.image_mime(F.col("content")).alias("mime"))


@query("SELECT 'clogo-' || c_custkey || '.png' AS file, c_custkey AS id FROM customer UNION ALL SELECT 'logo_' || s_suppkey, NULL FROM supplier")
def f53_stem_id(s: SparkSession, d: str) -> DataFrame:
    f = table(s, d, "customer").select(F.concat(F.lit("clogo-"), "c_custkey", F.lit(".png")).alias("file")).unionByName(table(s, d, "supplier").select(F.concat(F.lit("logo_"), "s_suppkey").alias("file")))
    return f.select("file", names.stem_id(F.col("file"), "clogo").alias("id"))


# ---- queues


_COHORT = "WITH c AS (SELECT o_orderkey AS k, o_custkey FROM orders WHERE o_orderstatus = 'O' AND o_totalprice > 200000)"


@query(_COHORT + """ SELECT 'jobs' AS queue, o_orderkey AS k, CASE WHEN c.k IS NOT NULL THEN 'X' ELSE o_orderstatus END AS status FROM orders LEFT JOIN c ON c.k = o_orderkey
UNION ALL SELECT 'lines', l_orderkey * 10 + l_linenumber, CASE WHEN c.k IS NOT NULL THEN 'held' ELSE l_linestatus END FROM lineitem LEFT JOIN c ON c.k = l_orderkey
UNION ALL SELECT 'fused', k, 'queued' FROM c""")
def u09_cohort(s: SparkSession, d: str) -> DataFrame:
    """One cohort of due orders changes two queues and fills a third; all three see the same cohort."""
    o, l = table(s, d, "orders"), table(s, d, "lineitem")  # noqa: E741
    jobs = o.select("o_orderkey", "o_orderstatus", "o_totalprice")
    lines = l.select("l_orderkey", "l_linenumber", "l_linestatus")
    changed = state.apply_cohort(
        jobs.where("o_orderstatus = 'O' and o_totalprice > 200000").select(F.col("o_orderkey").alias("k")),
        {"jobs": (jobs, F.col("o_orderkey"), {"o_orderstatus": F.lit("X")}), "lines": (lines, F.col("l_orderkey"), {"l_linestatus": F.lit("held")})},
    )
    a = changed["jobs"].select(F.lit("jobs").alias("queue"), F.col("o_orderkey").alias("k"), F.col("o_orderstatus").alias("status"))
    b = changed["lines"].select(F.lit("lines").alias("queue"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("k"), F.col("l_linestatus").alias("status"))
    c = changed["cohort"].select(F.lit("fused").alias("queue"), "k", F.lit("queued").alias("status"))
    return a.unionByName(b).unionByName(c)


@query("SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' AND o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'N') THEN 'canceled' ELSE o_orderstatus END AS status FROM orders")
def u12_supersede(s: SparkSession, d: str) -> DataFrame:
    """Open orders give way to lines of their own."""
    q = table(s, d, "orders").select("o_orderkey", F.col("o_orderstatus").alias("status"))
    newer = table(s, d, "lineitem").where("l_returnflag = 'N'").select(F.col("l_orderkey").alias("o_orderkey"))
    return state.supersede(q, newer, ["o_orderkey"], F.col("status") == "O", {"status": F.lit("canceled")})


@query("""WITH n AS (SELECT DISTINCT company_id, normalized_alias AS h FROM company_alias WHERE company_id IS NOT NULL AND normalized_alias IS NOT NULL), o AS (SELECT company_id, normalized_name AS h FROM dim_company WHERE normalized_name IS NOT NULL)
SELECT n.company_id, n.h, (row_number() OVER (PARTITION BY n.company_id ORDER BY n.h) + CASE WHEN EXISTS (SELECT 1 FROM o WHERE o.company_id = n.company_id) THEN 1 ELSE 0 END)::INT AS version FROM n WHERE NOT EXISTS (SELECT 1 FROM o WHERE o.company_id = n.company_id AND o.h = n.h)""")
def u18_versions(s: SparkSession, d: str) -> DataFrame:
    """Every name of a company that isn't its own is a further version of it."""
    from weftline.operators.relational import next_version

    a = table(s, d, "company_alias").where("company_id is not null and normalized_alias is not null").select("company_id", F.col("normalized_alias").alias("h"))
    history = table(s, d, "dim_company").where("normalized_name is not null").select("company_id", F.col("normalized_name").alias("h"), F.lit(1).alias("version"))
    return next_version(a, history, "company_id", "h", ["h"])


# ---- triggers


@query("SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def t01_source(s: SparkSession, d: str) -> DataFrame:
    stream = streams.table_stream(s, d, "events").select("event_type")
    root = _folder(s, "source")
    streams.to_table(stream, f"{root}/table", f"{root}/state").awaitTermination()
    return streams.current_table(s, f"{root}/table", stream.schema).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT count(*) AS rows, 2 AS runs FROM orders")
def t02_schedule(s: SparkSession, d: str) -> DataFrame:
    """A scheduled job is the same query started again: the second run reads only what came after the first."""
    folder, root = _folder(s, "inbox"), _folder(s, "scheduled")
    o = table(s, d, "orders").select("o_orderkey")
    runs = 0
    for even in (0, 1):
        o.where(F.col("o_orderkey") % 2 == even).write.mode("append").parquet(folder)
        stream = s.readStream.schema(o.schema).parquet(folder)
        q = streams.to_table(stream, f"{root}/table", f"{root}/state")
        q.awaitTermination()
        runs += any(p["numInputRows"] for p in q.recentProgress)
    return streams.current_table(s, f"{root}/table", o.schema).agg(F.count(F.lit(1)).alias("rows")).select("rows", F.lit(runs).alias("runs"))


@query("SELECT true AS fresh, false AS later, count(*) AS rows FROM events")
def t09_fresh(s: SparkSession, d: str) -> DataFrame:
    """A run that has just ended is fresh, and isn't an hour later."""
    stream = streams.table_stream(s, d, "events").select("event_id")
    root = _folder(s, "fresh")
    q = streams.to_table(stream, f"{root}/table", f"{root}/state")
    q.awaitTermination()
    at = datetime.datetime.fromisoformat(q.lastProgress["timestamp"].replace("Z", "+00:00")).replace(tzinfo=None)
    age = datetime.timedelta(minutes=10)
    fresh, later = (streams.fresh(q.lastProgress, at + datetime.timedelta(minutes=m), age) for m in (1, 60))
    return streams.current_table(s, f"{root}/table", stream.schema).agg(F.count(F.lit(1)).alias("rows")).select(F.lit(fresh).alias("fresh"), F.lit(later).alias("later"), "rows")


@query("SELECT count(DISTINCT o_orderpriority) AS batches, count(*) AS rows FROM orders")
def t10_batch_size(s: SparkSession, d: str) -> DataFrame:
    """One file a batch: as many batches as files."""
    folder, root = _folder(s, "files"), _folder(s, "batches")
    o = table(s, d, "orders").select("o_orderkey", "o_orderpriority")
    o.repartition("o_orderpriority").write.partitionBy("o_orderpriority").parquet(folder)
    stream = s.readStream.schema("o_orderkey long, o_orderpriority string").option("maxFilesPerTrigger", 1).parquet(folder).select("o_orderkey")
    q = streams.to_table(stream, f"{root}/table", f"{root}/state")
    q.awaitTermination()
    batches = sum(p["numInputRows"] > 0 for p in q.recentProgress)
    return streams.current_table(s, f"{root}/table", stream.schema).agg(F.count(F.lit(1)).alias("rows")).select(F.lit(batches).cast("long").alias("batches"), "rows")


# ---- checks


@query("SELECT strftime(max(data_created_ym), '%Y-%m') AS newest, max(data_created_ym) >= TIMESTAMP '2021-01-01' AS fresh FROM pension")
def q_b_fresh(s: SparkSession, d: str) -> DataFrame:
    return checks.freshness(table(s, d, "pension"), "data_created_ym", datetime.datetime(2021, 2, 1), datetime.timedelta(days=31)).select(F.date_format("newest", "yyyy-MM").alias("newest"), "fresh")


@query("SELECT count(*) AS rows FROM lineitem")
def q_d_blocking(s: SparkSession, d: str) -> DataFrame:
    """What follows is only planned if the table has rows."""
    return checks.assert_rows(table(s, d, "lineitem")).agg(F.count(F.lit(1)).alias("rows"))


@query("SELECT * FROM (VALUES ('function', 'levenshtein', true), ('function', 'no_such_function', false), ('view', 'weftline_nations', true), ('view', 'weftline_nothing', false)) v(kind, name, present)")
def q_e_objects(s: SparkSession, d: str) -> DataFrame:
    table(s, d, "nation").createOrReplaceTempView("weftline_nations")
    return checks.objects(s, {"function": ["levenshtein", "no_such_function"], "view": ["weftline_nations", "weftline_nothing"]})


@query("SELECT * FROM (VALUES ('nation.parquet', true), ('nothing.parquet', false)) v(name, reachable)")
def q_f_reachable(s: SparkSession, d: str) -> DataFrame:
    r = checks.reachable(s, [f"{d}/nation.parquet", f"{d}/nothing.parquet"])
    return r.select(F.element_at(F.split("path", "/"), -1).alias("name"), "reachable")


@query("SELECT c_nationkey, count(*) AS n, round(sum(c_acctbal), 2) AS total FROM customer WHERE c_nationkey NOT IN (SELECT c_nationkey FROM customer WHERE c_acctbal < -990) GROUP BY 1")
def q_g_skip(s: SparkSession, d: str) -> DataFrame:
    """Batches (here nations) with a value that can't be are passed over whole, the others go on."""
    good = checks.skip_batches(table(s, d, "customer"), ["c_nationkey"], F.col("c_acctbal") < -990)
    return good.groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("c_acctbal"), 2).alias("total"))


@query("""WITH p AS (SELECT regexp_extract(url, '^[a-zA-Z]+://([^/?#]+)', 1) AS site, post_id, CASE WHEN content <> '' THEN len(string_split(content, ' ')) ELSE 0 END AS words, comments_count FROM ss_normalized_posts)
SELECT site, count(*) AS posts, count(*) - count(DISTINCT post_id) AS repeated, count(*) FILTER (WHERE words <> comments_count) AS differing FROM p GROUP BY 1""")
def q_i_recount(s: SparkSession, d: str) -> DataFrame:
    """Counts that files state are held against what is counted: here words against comments_count, which mostly differ."""
    p = table(s, d, "ss_normalized_posts").select(F.regexp_extract("url", "^[a-zA-Z]+://([^/?#]+)", 1).alias("site"), "post_id", F.when(F.col("content") != "", F.split("content", " ")).otherwise(F.array().cast("array<string>")).alias("items"), "comments_count")
    return checks.recount(p, "site", "post_id", "items", "comments_count")
