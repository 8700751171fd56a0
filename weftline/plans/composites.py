"""Queries of state changes, checks, sources, streams and composite pipelines."""

from __future__ import annotations

import datetime
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from weftline.functions import hashing, text
from weftline.operators import checks, pairs, relational as rel, state
from weftline.operators.lineage import cut, spread
from weftline.plans import clusters, pipelines as pipe
from weftline.plans.functions import _MAPS, _SHINGLES, _TOKENS, key_a_sql, normalized_sql
from weftline.plans.relational import _LISTS, _TRIGRAMS, RANGES, _listings
from weftline.session import checkpoint_dir
from weftline.sources import calendar, files
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


KEY = ["exchange", "ticker"]
_ON = "n.exchange = o.exchange AND n.ticker = o.ticker"

# ---- state


@query(_LISTS + f"SELECT coalesce(n.exchange, o.exchange) AS exchange, coalesce(n.ticker, o.ticker) AS ticker, CASE WHEN n.ticker IS NULL THEN o.name ELSE n.name END AS name, CASE WHEN o.ticker IS NULL THEN 'inserted' WHEN n.ticker IS NULL THEN 'kept' WHEN n.name IS DISTINCT FROM o.name THEN 'updated' ELSE 'unchanged' END AS _action FROM n FULL JOIN o ON {_ON}")
def u01_upsert(s: SparkSession, d: str) -> DataFrame:
    old, new = _listings(s, d)
    return state.upsert(old, new, KEY)


@query(_LISTS + f"SELECT exchange, ticker, name FROM o UNION ALL SELECT n.exchange, n.ticker, n.name FROM n LEFT JOIN o ON {_ON} WHERE o.ticker IS NULL")
def u02_insert_new(s: SparkSession, d: str) -> DataFrame:
    old, new = _listings(s, d)
    return state.insert_new(old, new, KEY, ["name"])


@query(_LISTS + f"SELECT o.exchange, o.ticker, o.name AS old_name, n.name AS name FROM o JOIN n ON {_ON} WHERE n.name IS DISTINCT FROM o.name")
def u03_update_from(s: SparkSession, d: str) -> DataFrame:
    old, new = _listings(s, d)
    return state.update_from(old, new, KEY, ["name"])


@query(_LISTS + f"SELECT coalesce(n.exchange, o.exchange) AS exchange, coalesce(n.ticker, o.ticker) AS ticker, CASE WHEN o.ticker IS NULL THEN n.name WHEN n.ticker IS NOT NULL AND o.exchange <> 'MAIN' THEN least(o.name, n.name) ELSE o.name END AS name FROM n FULL JOIN o ON {_ON}")
def u04_guarded(s: SparkSession, d: str) -> DataFrame:
    old, new = _listings(s, d)
    old, new = (x.withColumn("main", F.col("exchange") == "MAIN") for x in (old, new))
    out = state.upsert(old, new, KEY, update={"name": F.least("t.name", "s.name")}, when=~F.col("t.main"))
    return out.select("exchange", "ticker", "name")


@query(_LISTS + f"SELECT coalesce(n.exchange, o.exchange) AS exchange, coalesce(n.ticker, o.ticker) AS ticker, coalesce(n.name, o.name) AS name FROM n FULL JOIN o ON {_ON}")
def u05_sparse(s: SparkSession, d: str) -> DataFrame:
    old, new = _listings(s, d)
    return state.upsert(old, new, KEY, merge="sparse").select("exchange", "ticker", "name")


@query(_LISTS + f"SELECT CASE WHEN o.ticker IS NULL THEN 'inserted' WHEN n.ticker IS NULL THEN 'kept' WHEN n.name IS DISTINCT FROM o.name THEN 'updated' ELSE 'unchanged' END AS _action, count(*) AS n FROM n FULL JOIN o ON {_ON} GROUP BY 1")
def u06_outcomes(s: SparkSession, d: str) -> DataFrame:
    old, new = _listings(s, d)
    return state.upsert(old, new, KEY).groupBy("_action").agg(F.count(F.lit(1)).alias("n"))


@query(_LISTS + f"SELECT coalesce(n.exchange, o.exchange) AS exchange, coalesce(n.ticker, o.ticker) AS ticker, coalesce(o.name, n.name) AS name FROM n FULL JOIN o ON {_ON}")
def u08_fill(s: SparkSession, d: str) -> DataFrame:
    old, new = _listings(s, d)
    return state.upsert(old, new, KEY, merge="fill").select("exchange", "ticker", "name")


@query("WITH o AS (SELECT o_orderkey, o_orderstatus FROM orders), c AS (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'O' ORDER BY o_orderdate, o_orderkey LIMIT 110) SELECT o.o_orderkey, CASE WHEN c.o_orderkey IS NOT NULL THEN 'X' ELSE o_orderstatus END AS o_orderstatus FROM o LEFT JOIN c ON o.o_orderkey = c.o_orderkey")
def u10_claim(s: SparkSession, d: str) -> DataFrame:
    q = table(s, d, "orders").select("o_orderkey", "o_orderdate", "o_orderstatus")
    return state.claim(q, ["o_orderkey"], F.col("o_orderstatus") == "O", [F.col("o_orderdate"), F.col("o_orderkey")], 110, {"o_orderstatus": F.lit("X")}).select("o_orderkey", "o_orderstatus")


@query("SELECT o_orderkey, CASE WHEN k IS NOT NULL THEN 'D' ELSE o_orderstatus END AS o_orderstatus FROM orders LEFT JOIN (SELECT DISTINCT l_orderkey AS k FROM lineitem WHERE l_returnflag = 'R') ON k = o_orderkey")
def u11_apply(s: SparkSession, d: str) -> DataFrame:
    q = table(s, d, "orders").select("o_orderkey", "o_orderstatus")
    done = table(s, d, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey")).distinct()
    return state.apply_to(q, done, ["o_orderkey"], {"o_orderstatus": F.lit("D")})


@query(_LISTS + f", k AS (SELECT *, CASE WHEN substr(ticker, 1, 1) = '1' THEN DATE '2021-01-05' END AS delisted FROM o WHERE substr(ticker, 1, 1) <> '2') SELECT coalesce(n.exchange, k.exchange) AS exchange, coalesce(n.ticker, k.ticker) AS ticker, coalesce(n.name, k.name) AS name, strftime(CASE WHEN n.ticker IS NULL THEN coalesce(delisted, DATE '2021-12-31') END, '%Y-%m-%d') AS delisted, CASE WHEN k.ticker IS NULL THEN 'listed' WHEN n.ticker IS NOT NULL AND delisted IS NOT NULL THEN 'relisted' WHEN n.ticker IS NOT NULL AND n.name IS NOT NULL AND n.name IS DISTINCT FROM k.name THEN 'renamed' WHEN n.ticker IS NULL AND delisted IS NULL THEN 'delisted' ELSE 'same' END AS action FROM n FULL JOIN k ON n.exchange = k.exchange AND n.ticker = k.ticker")
def u13_scd(s: SparkSession, d: str) -> DataFrame:
    old, new = _listings(s, d)
    head = F.substring("ticker", 1, 1)
    known = old.where(head != "2").select(*KEY, "name", F.lit(datetime.date(2020, 1, 1)).alias("listed"), F.when(head == "1", F.lit(datetime.date(2021, 1, 5))).alias("delisted"))
    out = state.scd_apply(known, new, KEY, "name", F.lit(datetime.date(2021, 12, 31)))
    return out.select(*KEY, "name", F.date_format("delisted", "yyyy-MM-dd").alias("delisted"), "action")


@query("WITH n AS (SELECT DISTINCT ticker, regexp_extract(name, '^[^ ]+') AS issuer FROM stockcodename WHERE name IS NOT NULL) SELECT ticker, issuer, md5(issuer) AS parent FROM n")
def u14_find_or_create(s: SparkSession, d: str) -> DataFrame:
    c = table(s, d, "stockcodename").where("name is not null").select("ticker", F.regexp_extract("name", "^[^ ]+", 0).alias("issuer")).distinct()
    none = c.select(F.md5("issuer").alias("parent"), "issuer").limit(0)
    children, _ = state.find_or_create(c, none, "issuer", "parent")
    return children.select("ticker", "issuer", "parent")


@query("SELECT 'pension' AS name, strftime(max(data_created_ym), '%Y-%m') AS last FROM pension")
def u16_control(s: SparkSession, d: str) -> DataFrame:
    p = table(s, d, "pension").select(F.date_format("data_created_ym", "yyyy-MM").alias("ym"))
    old = s.range(1).select(F.lit("pension").alias("name"), F.lit("1999-01").alias("last"))
    return state.advance_control(old, p, "pension", "ym")


@query("""WITH t AS (SELECT DISTINCT company_id, alias FROM company_alias WHERE company_id IS NOT NULL), c AS (SELECT company_id, canonical_name AS alias FROM dim_company WHERE company_id % 2 = 0 AND canonical_name IS NOT NULL)
SELECT company_id, alias FROM t WHERE company_id NOT IN (SELECT company_id FROM c) UNION ALL SELECT company_id, alias FROM c""")
def w10_replace_children(s: SparkSession, d: str) -> DataFrame:
    t = table(s, d, "company_alias").where("company_id is not null").select("company_id", "alias").distinct()
    c = table(s, d, "dim_company").where("company_id % 2 = 0 and canonical_name is not null").select("company_id", F.col("canonical_name").alias("alias"))
    return state.replace_children(t, c, "company_id", ["alias"])


# ---- checks


@query("SELECT business_reg_num, strftime(data_created_ym, '%Y-%m') AS ym, count(*) AS n FROM pension GROUP BY ALL HAVING count(*) > 1")
def q_a_duplicates(s: SparkSession, d: str) -> DataFrame:
    return checks.duplicates(table(s, d, "pension").select("business_reg_num", F.date_format("data_created_ym", "yyyy-MM").alias("ym")), ["business_reg_num", "ym"])


@query("SELECT count(*) AS rows, count(business_reg_num) AS business_reg_num, count(addr_sigungu_code) AS addr_sigungu_code, count(industry_code) AS industry_code FROM pension")
def q_c_coverage(s: SparkSession, d: str) -> DataFrame:
    return checks.coverage(table(s, d, "pension"), ["business_reg_num", "addr_sigungu_code", "industry_code"])


@query("SELECT reason, count(*) AS n FROM (SELECT CASE WHEN upfront < 0 THEN 'negative' WHEN source_posted_at IS NULL THEN 'no date' WHEN capacity IS NULL THEN 'no capacity' END AS reason FROM deals) WHERE reason IS NOT NULL GROUP BY 1")
def q_h_quarantine(s: SparkSession, d: str) -> DataFrame:
    _, bad = checks.quarantine(table(s, d, "deals").select("upfront", "source_posted_at", "capacity"), {"negative": F.col("upfront") < 0, "no date": F.col("source_posted_at").isNull(), "no capacity": F.col("capacity").isNull()})
    return bad.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


# ---- sources


@query("SELECT strftime(d, '%Y-%m-%d') AS date, e AS exchange FROM (SELECT unnest(generate_series(DATE '2021-03-01', DATE '2021-06-30', INTERVAL 1 DAY)) AS d), (VALUES ('GROWTH'), ('MAIN'), ('STARTUP')) v(e) WHERE isodow(d) < 6")
def s09_sweep(s: SparkSession, d: str) -> DataFrame:
    days = calendar.business_days(s, datetime.date(2021, 3, 1), datetime.date(2021, 6, 30))
    return calendar.sweep(days, ["GROWTH", "MAIN", "STARTUP"]).select(F.date_format("date", "yyyy-MM-dd").alias("date"), "exchange")


@query("""WITH b AS (SELECT d, row_number() OVER (PARTITION BY date_trunc('month', d) ORDER BY d DESC) AS r FROM (SELECT unnest(generate_series(DATE '2019-01-01', DATE '2021-12-31', INTERVAL 1 DAY))::DATE AS d) WHERE isodow(d) < 6 AND strftime(d, '%m-%d') <> '12-31')
SELECT strftime(d, '%Y-%m-%d') AS date FROM b WHERE r = CASE WHEN month(d) = 12 THEN 2 ELSE 1 END AND d <= DATE '2021-09-30' - 43""")
def s10_month_ends(s: SparkSession, d: str) -> DataFrame:
    holidays = s.range(2019, 2022).select(F.make_date(F.col("id").cast("int"), F.lit(12), F.lit(31)).alias("date"))
    return calendar.month_end_business_days(s, 2019, 2021, datetime.date(2021, 9, 30), holidays).select(F.date_format("date", "yyyy-MM-dd").alias("date"))


@query("""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS l FROM documents) SELECT regexp_extract(l, '^([0-9]{2}:[0-9]{2}:[0-9]{2}) ([A-Z]+) (.*?)(?: rc=([0-9]+))?$', 2) AS level, TRY_CAST(regexp_extract(l, '^([0-9]{2}:[0-9]{2}:[0-9]{2}) ([A-Z]+) (.*?)(?: rc=([0-9]+))?$', 4) AS INT) AS code, count(*) AS lines, count(DISTINCT doc_id) AS logs
FROM l WHERE regexp_matches(l, '^([0-9]{2}:[0-9]{2}:[0-9]{2}) ([A-Z]+) (.*?)(?: rc=([0-9]+))?$') GROUP BY ALL""")
def s17_run_log(s: SparkSession, d: str) -> DataFrame:
    lines = files.parse_run_log(table(s, d, "documents"), "text", ["doc_id"])
    return lines.groupBy("level", "code").agg(F.count(F.lit(1)).alias("lines"), F.countDistinct("doc_id").alias("logs"))


# ---- composites


@query("""WITH b AS (SELECT to_timestamp((floor(epoch(max(ts)))::BIGINT // 600) * 600 + 600) AT TIME ZONE 'UTC' AS top FROM events), r AS (SELECT e.* FROM events e, b WHERE ts > top - INTERVAL 7 DAY),
f AS (SELECT user_id, arg_min(value, struct_pack(a := ts, b := event_id)) AS a, arg_max(value, struct_pack(a := ts, b := event_id)) AS z, arg_min(event_id, struct_pack(a := ts, b := event_id)) AS i, arg_max(event_id, struct_pack(a := ts, b := event_id)) AS j FROM r GROUP BY 1),
s AS (SELECT user_id, round(coalesce(z, 0) - coalesce(a, 0), 4) AS value_delta, j - i AS event_id_delta, round((coalesce(z, 0) - coalesce(a, 0)) + 0.01 * (j - i), 4) AS score FROM f) SELECT *, row_number() OVER (ORDER BY score DESC, user_id) AS rank FROM s""")
def c01_trends(s: SparkSession, d: str) -> DataFrame:
    e = table(s, d, "events").select("user_id", "ts", "event_id", "value")
    top = e.agg(F.max("ts").alias("top")).select(F.timestamp_seconds(F.floor(F.unix_timestamp(F.col("top").cast("timestamp")) / 600) * 600 + 600)).first()[0]
    t = pipe.post_trends(e, "user_id", "ts", "event_id", {"value": 1.0, "event_id": 0.01}, F.lit(top), 7 * 86400)
    t = t.select("user_id", F.round("value_delta", 4).alias("value_delta"), "event_id_delta", F.round("score", 4).alias("score"))
    return rel.global_rank(t, [F.desc("score"), F.col("user_id")])


@query(f"""WITH p AS (SELECT DISTINCT post_id, title, source_posted_at AS dt FROM ss_normalized_posts WHERE source_posted_at IS NOT NULL), b AS (SELECT max(dt) AS top FROM p), r AS (SELECT * FROM (VALUES ('3d', 3), ('7d', 7), ('14d', 14)) v(range, days)),
k AS (SELECT post_id, dt, unnest(list_distinct({_TOKENS.format('title')})) AS keyword FROM p) SELECT range, keyword, count(*) AS count FROM k, b, r WHERE top - dt <= days AND dt <= top GROUP BY ALL""")
def c02_keywords(s: SparkSession, d: str) -> DataFrame:
    p = table(s, d, "ss_normalized_posts").where("source_posted_at is not null").select("post_id", "title", "source_posted_at").distinct()
    top = p.agg(F.max("source_posted_at").cast("timestamp")).first()[0]
    out = pipe.keyword_trends(p, text.tokens(F.col("title")), "source_posted_at", RANGES, F.lit(top))
    return out


@query(f"""WITH RECURSIVE t AS MATERIALIZED (SELECT doc_id, {_TOKENS.format('text')} AS t FROM documents), k AS MATERIALIZED (SELECT doc_id, array_to_string(t, ' ') AS k, t FROM t WHERE len(t) > 0),
u AS MATERIALIZED (SELECT min(doc_id) AS id, count(*) AS copies, any_value(t) AS t, k FROM k GROUP BY k), g AS MATERIALIZED (SELECT id, list_distinct({_SHINGLES}) AS g FROM u), x AS MATERIALIZED (SELECT id, len(g) AS n, unnest(g) AS s FROM g),
l AS MATERIALIZED (SELECT a.id AS a, b.id AS b FROM x a JOIN x b ON a.s = b.s AND a.id < b.id GROUP BY a.id, b.id, a.n, b.n HAVING count(*) / (a.n + b.n - count(*)) >= 0.8 - 1e-9), e AS MATERIALIZED (SELECT a AS x, b AS y FROM l UNION ALL SELECT b, a FROM l),
c(x, c) AS (SELECT id, id FROM u UNION SELECT e.y, c.c FROM c JOIN e ON e.x = c.x), m AS (SELECT x, min(c) AS class_id FROM c GROUP BY 1), n AS (SELECT x, count(*) AS links FROM e GROUP BY 1)
SELECT d.doc_id, coalesce(m.class_id, d.doc_id) AS class_id, coalesce(u.copies, 1) AS copies, coalesce(n.links, 0) AS links FROM documents d LEFT JOIN k ON d.doc_id = k.doc_id LEFT JOIN u ON u.k = k.k LEFT JOIN m ON m.x = u.id LEFT JOIN n ON n.x = u.id""")
def c03_near_duplicates(s: SparkSession, d: str) -> DataFrame:
    return pairs.near_duplicates(table(s, d, "documents"), "doc_id", "text")


@query()
def c03_sketch_links(s: SparkSession, d: str) -> DataFrame:
    """Links of documents found by MinHash bands and confirmed on their shingles; tests compare it with the exact join."""
    return pairs.sketch_links(table(s, d, "documents"), "doc_id", "text")


_PERM128 = ", ".join(f"({i}, {a}, {b})" for i, (a, b) in enumerate(map(hashing.permutation, range(128))))
_SORTS = (("text", "title"), ("gallery", "content"), ("embed", "comments_text"))


@query(f"""WITH RECURSIVE p AS MATERIALIZED (SELECT post_id, min(title) AS title, min(content) AS content, min(comments_text) AS comments_text, max(comments_count)::DOUBLE AS score FROM ss_normalized_posts GROUP BY 1),
w AS MATERIALIZED ({' UNION ALL '.join(f"SELECT post_id, '{k}' AS kind, {_TOKENS.format(c)} AS w FROM p" for k, c in _SORTS)}),
h AS MATERIALIZED (SELECT post_id, kind, ('0x' || substr(md5(x), 1, 7))::BIGINT AS h FROM (SELECT post_id, kind, unnest(list_distinct(w)) AS x FROM w)),
k AS MATERIALIZED (SELECT post_id, kind, i, min((h * a + b) % {hashing.PRIME}) AS v FROM h, (VALUES {_PERM128}) q(i, a, b) GROUP BY ALL),
y AS (SELECT post_id, len(w) AS n, unnest(list_transform(w, lambda x: ('0x' || substr(md5('0|' || x), 1, 15))::BIGINT)) AS h FROM w WHERE kind = 'text'),
z AS (SELECT post_id, sum(CASE WHEN 2 * c > n THEN (1::BIGINT << i) ELSE 0 END)::BIGINT AS s FROM (SELECT post_id, i, sum((h >> i) & 1) AS c, max(n) AS n FROM y, range(0, 60) r(i) GROUP BY post_id, i) GROUP BY 1),
u AS MATERIALIZED (SELECT post_id, 's' || i || ':' || ((s >> (15 * i)) & 32767) AS u FROM z, range(0, 4) r(i) UNION ALL SELECT post_id, 't' || (i // 4) || ':' || string_agg(v, ',' ORDER BY i) FROM k WHERE kind = 'text' GROUP BY post_id, i // 4),
c AS MATERIALIZED (SELECT DISTINCT a.post_id AS a, b.post_id AS b FROM u a JOIN u b ON a.u = b.u AND a.post_id < b.post_id),
j AS MATERIALIZED (SELECT a, b, count(*) FILTER (WHERE x.kind = 'text') / 128 AS t, count(*) FILTER (WHERE x.kind = 'gallery') / 128 AS g, count(*) FILTER (WHERE x.kind = 'embed') / 128 AS e FROM c JOIN k x ON x.post_id = a JOIN k y ON y.post_id = b AND x.kind = y.kind AND x.i = y.i AND x.v = y.v GROUP BY ALL),
l AS MATERIALIZED (SELECT a, b, CASE WHEN t >= 0.75 THEN t WHEN g >= 0.8 AND t >= 0.55 THEN (g + t) / 2 ELSE greatest(e, (t + g) / 2) END AS similarity, CASE WHEN t >= 0.75 THEN 'text' WHEN g >= 0.8 AND t >= 0.55 THEN 'both' ELSE 'embed' END AS kind FROM j WHERE t >= 0.75 OR (g >= 0.8 AND t >= 0.55) OR (e >= 0.85 AND (t >= 0.5 OR g >= 0.6))),
e AS MATERIALIZED (SELECT a AS x, b AS y, similarity, kind FROM l UNION ALL SELECT b, a, similarity, kind FROM l),
r(x, c) AS (SELECT DISTINCT x, x FROM e UNION SELECT e.y, r.c FROM r JOIN e ON e.x = r.x), m AS MATERIALIZED (SELECT x AS post_id, min(c) AS component FROM r GROUP BY 1),
o AS (SELECT component, min('k' || substr(post_id, 8)) AS old FROM m WHERE substr(post_id, 9) < '3' GROUP BY 1),
d AS (SELECT component, arg_min(post_id, struct_pack(a := -score, b := post_id)) AS rep, count(*) AS size FROM m JOIN p USING (post_id) GROUP BY 1)
SELECT coalesce(old, 'c' || m.component) AS cluster, m.post_id, round(coalesce(e.similarity, 0), 6) AS similarity, e.kind, m.post_id = rep AS is_representative, size FROM m JOIN d USING (component) LEFT JOIN o USING (component) LEFT JOIN e ON e.x = rep AND e.y = m.post_id""")
def c03_clusters(s: SparkSession, d: str) -> DataFrame:
    """Clusters of posts by their titles, contents and comments, as three kinds of evidence; a third of the posts belong to clusters already."""
    p = table(s, d, "ss_normalized_posts").groupBy("post_id").agg(*[F.min(c).alias(c) for _, c in _SORTS], F.max("comments_count").cast("double").alias("score"))
    words = cut(spread(p, "post_id").select("post_id", "score", *[text.tokens(F.col(c)).alias(k) for k, c in _SORTS]))
    posts = hashing.add_simhash(words, F.col("text"), "simhash")
    # word hashes, from which sketches are made where they are compared: a twentieth of a sketch's size
    posts = posts.withColumns({k: F.transform(F.array_distinct(F.col(k)), lambda x: hashing.small_hash(x).cast("int")) for k, _ in _SORTS})
    known = p.where(F.substring("post_id", 9, 1) < "3").select(F.concat(F.lit("k"), F.substring("post_id", 8, 2)).alias("cluster"), "post_id")
    return clusters.build_clusters(posts, known).withColumn("similarity", F.round("similarity", 6))


_MERGED = "WITH c AS (SELECT n_nationkey AS k, CASE WHEN n_regionkey > 1 THEN min(n_nationkey) OVER (PARTITION BY n_regionkey) ELSE n_nationkey END AS kept FROM nation), m AS (SELECT DISTINCT kept AS cluster, c_mktsegment || c_custkey % 40 AS post_id FROM customer JOIN c ON k = c_nationkey)"


@query(_MERGED + ", r AS (SELECT cluster, min(post_id) AS representative, count(*) AS size FROM m GROUP BY 1) SELECT m.cluster, post_id, post_id = representative AS is_representative, size FROM m JOIN r USING (cluster)")
def u17_merge_bookkeeping(s: SparkSession, d: str) -> DataFrame:
    """Nations are clusters of customers' segments; those of one region merge, in regions above 1. A segment both had is a member once."""
    n = table(s, d, "nation").select("n_nationkey", "n_regionkey")
    m = table(s, d, "customer").select(F.col("c_nationkey").alias("cluster"), F.concat("c_mktsegment", (F.col("c_custkey") % 40).cast("string")).alias("post_id")).distinct().withColumns({"score": F.lit(0.0), "is_representative": F.lit(False)})
    first = n.groupBy("n_regionkey").agg(F.min("n_nationkey").alias("kept"))
    merges = n.where("n_regionkey > 1").join(first, "n_regionkey").select(F.col("n_nationkey").alias("cluster"), "kept")
    before = m.groupBy("cluster").agg(F.min("post_id").alias("representative"), F.count(F.lit(1)).alias("size"))
    after, members = clusters.apply_merges(before, m, merges)
    return members.join(after, "cluster").select("cluster", "post_id", (F.col("post_id") == F.col("representative")).alias("is_representative"), "size")


@query("""WITH RECURSIVE m AS (SELECT c_nationkey AS g, c_acctbal AS v, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS r FROM customer QUALIFY r <= 8),
p AS (SELECT a.n_nationkey AS a, b.n_nationkey AS b FROM nation a JOIN nation b ON a.n_regionkey = b.n_regionkey AND a.n_nationkey < b.n_nationkey),
x AS (SELECT p.a, p.b, ma.r, max(1 / (1 + abs(ma.v - mb.v) / 1000)) AS s FROM p JOIN m ma ON ma.g = p.a JOIN m mb ON mb.g = p.b GROUP BY ALL),
l AS (SELECT a, b, list(s ORDER BY s DESC) AS s FROM x GROUP BY ALL), k AS (SELECT a, b FROM l WHERE coalesce(s[3], 0) >= 0.97 OR (coalesce(s[1], 0) + coalesce(s[2], 0) + coalesce(s[3], 0)) / 3 >= 0.97),
e AS MATERIALIZED (SELECT a AS x, b AS y FROM k UNION ALL SELECT b, a FROM k), c(x, c) AS (SELECT DISTINCT x, x FROM e UNION SELECT e.y, c.c FROM c JOIN e ON e.x = c.x) SELECT x AS cluster, min(c) AS kept FROM c GROUP BY 1""")
def c04_merge_clusters(s: SparkSession, d: str) -> DataFrame:
    c, n = table(s, d, "customer"), table(s, d, "nation")
    m = c.select(F.col("c_nationkey").alias("group"), F.col("c_acctbal").alias("v"), F.row_number().over(Window.partitionBy("c_nationkey").orderBy("c_custkey")).alias("rank"))
    p = pairs.candidate_pairs(n, "n_nationkey", F.array(F.col("n_regionkey").cast("string")))
    return pipe.merge_clusters(m, p, 1 / (1 + F.abs(F.col("ma.v") - F.col("mb.v")) / 1000), least=0.97)


@query("""WITH b AS (SELECT max(ts) AS top FROM events), u AS (SELECT user_id AS cluster, count(*) AS n, max(ts) AS dt FROM events GROUP BY 1), t AS (SELECT count(*) AS t FROM u),
p AS (SELECT cluster, (t - (rank() OVER (ORDER BY n DESC) - 1)) / t * exp(-greatest(floor(epoch(top)) - floor(epoch(dt)), 0) / 3600.0 / 48) AS score FROM u, t, b)
SELECT cluster, CASE WHEN cluster % 3 = 0 THEN 0 WHEN cluster % 3 = 1 THEN 2 ELSE 1 END AS consecutive, round(score, 6) AS score FROM p WHERE cluster % 7 <> 0 ORDER BY p.score DESC, cluster LIMIT 20""")
def c05_rotation(s: SparkSession, d: str) -> DataFrame:
    return _rotated(s, d)[1].select("cluster", "consecutive", F.round("score", 6).alias("score"))


def _rotated(s: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """(state before, clusters shown now)."""
    e = table(s, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    as_of = F.lit(e.agg(F.max("ts")).first()[0])
    scores = e.groupBy(F.col("user_id").alias("cluster")).agg(F.count(F.lit(1)).alias("score"), F.max("ts").alias("at"))
    ago = lambda seconds: F.timestamp_seconds(F.unix_timestamp(as_of) - seconds)
    old = scores.select("cluster", (2 - F.col("cluster") % 3).cast("int").alias("consecutive"), ago(F.when(F.col("cluster") % 3 == 2, 3600).otherwise(600)).alias("last_shown"), F.when(F.col("cluster") % 7 == 0, ago(-60)).alias("suppressed_until"))
    return old, pipe.rotate(scores, old, as_of)


@query("""WITH f AS (SELECT d.store, d.id, a.name AS item, a.fee AS m, a.note AS note FROM (SELECT DISTINCT store, id, addons_detail FROM deals WHERE store IS NOT NULL) d, unnest(addons_detail) u(a)),
n AS (SELECT store, item, count(*) AS k FROM f GROUP BY ALL), t AS (SELECT *, row_number() OVER (PARTITION BY store ORDER BY k DESC, item) AS r FROM n QUALIFY r <= 3)
SELECT store, round(avg(m), 3) AS mean, max(m) AS top, (SELECT string_agg(item, ',' ORDER BY r) FROM t WHERE t.store = f.store) AS top_items, count(*) AS items FROM f GROUP BY store""")
def c06_rollup(s: SparkSession, d: str) -> DataFrame:
    deals = table(s, d, "deals").where("store is not null").select("store", "id", "addons_detail").dropDuplicates(["id"])
    items = deals.groupBy("store").agg(F.sum(F.size("addons_detail")).alias("items"))
    out = pipe.nested_rollup(deals, ["store"], "addons_detail", "name", "fee", "note", ["id"], k=3)
    return out.join(items, "store").select("store", "mean", "top", "top_items", "items")


_IMAGES = """WITH d AS (SELECT DISTINCT post_id, id, move_type, flags, contract_type, payment, addons_detail, channel, addons_count, advertorial_score FROM deals WHERE post_id IS NOT NULL),
l AS (SELECT post_id, name, count(*) AS n FROM (SELECT post_id, unnest(flags) AS name FROM d) GROUP BY ALL), lt AS (SELECT *, row_number() OVER (PARTITION BY post_id ORDER BY n DESC, name) AS r FROM l WHERE name IS NOT NULL QUALIFY r <= 20),
o AS (SELECT post_id, o.name AS name, sum(o.months)::BIGINT AS n, round(avg(o.fee / 9973), 3) AS confidence FROM (SELECT post_id, unnest(addons_detail) AS o FROM d) GROUP BY ALL), ot AS (SELECT *, row_number() OVER (PARTITION BY post_id ORDER BY n DESC NULLS LAST, name) AS r FROM o WHERE name IS NOT NULL QUALIFY r <= 20),
c AS (SELECT post_id, channel AS name, round(sum(addons_count / 8), 3) AS ratio FROM d GROUP BY ALL), ct AS (SELECT *, row_number() OVER (PARTITION BY post_id ORDER BY ratio DESC NULLS LAST, name) AS r FROM c WHERE name IS NOT NULL QUALIFY r <= 10),
t AS (SELECT post_id, id, unnest([contract_type, payment]) AS name, unnest([0, 1]) AS line FROM d), p AS (SELECT post_id, name, count(*) AS n FROM t WHERE name IS NOT NULL GROUP BY ALL), pt AS (SELECT *, row_number() OVER (PARTITION BY post_id ORDER BY n DESC, name) AS r FROM p QUALIFY r <= 5),
a AS (SELECT post_id, count(*) AS images, round(avg(addons_count / 8), 3) AS mean, max(addons_count / 8) AS top, string_agg(move_type, ' | ' ORDER BY id) FILTER (WHERE trim(move_type) <> '') AS captions FROM d GROUP BY 1), x AS (SELECT post_id, string_agg(name, ' | ' ORDER BY id, line) FILTER (WHERE trim(name) <> '') AS ocr FROM t GROUP BY 1),
ls AS (SELECT post_id, string_agg(concat_ws(':', name, n), ',' ORDER BY r) AS labels FROM lt GROUP BY 1), os AS (SELECT post_id, string_agg(concat_ws(':', name, n), ',' ORDER BY r) AS objects, max(name) FILTER (WHERE r = 1) AS top_object, max(n) FILTER (WHERE r = 1) AS top_count, max(confidence) FILTER (WHERE r = 1) AS top_confidence FROM ot GROUP BY 1),
cs AS (SELECT post_id, string_agg(name, ',' ORDER BY r) AS colors, max(ratio) FILTER (WHERE r = 1) AS top_ratio FROM ct GROUP BY 1), ps AS (SELECT post_id, string_agg(name, ',' ORDER BY r) AS phrases FROM pt GROUP BY 1),
v AS (SELECT a.*, ocr, labels, objects, top_object, top_count, top_confidence, colors, top_ratio, phrases, md5(concat_ws('|', coalesce(captions, ''), coalesce(ocr, ''), coalesce(labels, ''), coalesce(objects, ''), coalesce(colors, ''))) AS revision FROM a LEFT JOIN x USING (post_id) LEFT JOIN ls USING (post_id) LEFT JOIN os USING (post_id) LEFT JOIN cs USING (post_id) LEFT JOIN ps USING (post_id)) """


def _seen(s: SparkSession, d: str) -> DataFrame:
    """Deals of a post as its images."""
    deals = table(s, d, "deals").where("post_id is not null").select("post_id", "id", "move_type", "flags", "contract_type", "payment", "addons_detail", "channel", "addons_count").dropDuplicates(["id"])
    share = F.col("addons_count") / 8
    objects = F.transform("addons_detail", lambda a: F.struct(a["name"].alias("name"), a["months"].cast("long").alias("count"), (a["fee"] / 9973).alias("confidence")))
    images = deals.select("post_id", "id", F.col("move_type").alias("caption"), F.col("flags").alias("labels"), F.array("contract_type", "payment").alias("ocr"), objects.alias("objects"), F.array(F.struct(F.col("channel").alias("name"), share.alias("ratio"))).alias("colors"), share.alias("nsfw"), share.alias("violence"))
    return pipe.image_rollup(images, "post_id", ["id"])


@query(_IMAGES + "SELECT post_id, images, captions, ocr, coalesce(labels, '') AS labels, revision, mean AS nsfw_mean, top AS violence_max FROM v")
def c06_image_rollup(s: SparkSession, d: str) -> DataFrame:
    said = lambda c: F.coalesce(F.array_join(F.transform(c, lambda x: F.concat_ws(":", x["name"], x["count"].cast("string"))), ","), F.lit(""))
    return _seen(s, d).select("post_id", "images", "captions", "ocr", said("labels").alias("labels"), "revision", "nsfw_mean", "violence_max")


@query(_IMAGES + "SELECT post_id, revision FROM v WHERE post_id NOT IN (SELECT post_id FROM v WHERE images > 1)")
def c06_changes(s: SparkSession, d: str) -> DataFrame:
    """Posts to be fused again: those of several images are known as they are now, some others as they were."""
    now = cut(_seen(s, d))
    known = now.where("images > 1").select("post_id", "revision").unionByName(now.where("images = 1 and violence_max > 0.2").select("post_id", F.lit("before").alias("revision")))
    return pipe.changed_revisions(now, known, "post_id")


@query(_IMAGES + "SELECT post_id, top_object, top_count, top_confidence, colors, top_ratio, coalesce(phrases, '') AS phrases FROM v")
def c07_vlm_rollup(s: SparkSession, d: str) -> DataFrame:
    o, c = F.get("objects", F.lit(0)), F.get("colors", F.lit(0))
    named = lambda x: F.array_join(F.transform(x, lambda y: y["name"]), ",")
    return _seen(s, d).select("post_id", o["name"].alias("top_object"), o["count"].alias("top_count"), o["confidence"].alias("top_confidence"), named("colors").alias("colors"), c["ratio"].alias("top_ratio"), F.coalesce(named("phrases"), F.lit("")).alias("phrases"))


@query("""WITH m AS (SELECT business_reg_num, zip_code, data_created_ym AS ym, company_name AS name, industry_code AS industry, count(*) AS n FROM pension WHERE business_reg_num IS NOT NULL AND zip_code IS NOT NULL GROUP BY ALL),
l AS (SELECT * FROM m QUALIFY ym = max(ym) OVER (PARTITION BY business_reg_num, zip_code)), s AS (SELECT business_reg_num, zip_code, min(ym) AS first, max(ym) AS last FROM m GROUP BY ALL),
a AS (SELECT business_reg_num, zip_code, name FROM (SELECT business_reg_num, zip_code, name, sum(n) AS n FROM l GROUP BY ALL) WHERE name IS NOT NULL QUALIFY row_number() OVER (PARTITION BY business_reg_num, zip_code ORDER BY n DESC, length(name) DESC, name) = 1),
i AS (SELECT business_reg_num, zip_code, industry FROM (SELECT business_reg_num, zip_code, industry, sum(n) AS n FROM l GROUP BY ALL) WHERE industry IS NOT NULL QUALIFY row_number() OVER (PARTITION BY business_reg_num, zip_code ORDER BY n DESC, length(industry) DESC, industry) = 1)
SELECT s.business_reg_num, s.zip_code, strftime(first, '%Y-%m') AS first, strftime(last, '%Y-%m') AS last, name, industry FROM s LEFT JOIN a USING (business_reg_num, zip_code) LEFT JOIN i USING (business_reg_num, zip_code)""")
def c10_rebuild_dim(s: SparkSession, d: str) -> DataFrame:
    raw = table(s, d, "pension").select("business_reg_num", "zip_code", F.col("data_created_ym").alias("ym"), F.col("company_name").alias("name"), F.col("industry_code").alias("industry"))
    out = pipe.rebuild_dim(raw, ["business_reg_num", "zip_code"], "ym", "name", "industry")
    return out.select("business_reg_num", "zip_code", F.date_format("first", "yyyy-MM").alias("first"), F.date_format("last", "yyyy-MM").alias("last"), "name", "industry")


_CANDIDATES = f"""WITH p AS MATERIALIZED (SELECT id AS raw_id, {normalized_sql('company_name')} AS n, business_reg_num AS number, addr_sigungu_code || '-' || legal_dong_addr_code AS addr, industry_code AS industry FROM pension),
d AS MATERIALIZED (SELECT company_id, {normalized_sql('canonical_name')} AS dn, business_reg_num AS dnum, addr_key AS daddr, industry_code AS dind FROM dim_company), a AS MATERIALIZED (SELECT DISTINCT company_id, {normalized_sql('alias')} AS n FROM company_alias WHERE company_id IS NOT NULL),
al AS (SELECT DISTINCT company_id, n FROM (SELECT company_id, n FROM a UNION ALL SELECT company_id, dn FROM d) WHERE length(n) >= 3),
f AS MATERIALIZED (SELECT raw_id, company_id, 1 AS r, 0.95::DOUBLE AS sim FROM p JOIN d ON number = dnum AND addr = daddr UNION ALL SELECT raw_id, company_id, 2, 0.92::DOUBLE FROM p JOIN al USING (n)), t AS MATERIALIZED (SELECT * FROM p WHERE raw_id NOT IN (SELECT raw_id FROM f)),
gl AS (SELECT l, len(g) AS nl, unnest(g) AS w FROM (SELECT l, {_TRIGRAMS.format('l')} AS g FROM (SELECT DISTINCT n AS l FROM t WHERE n IS NOT NULL))), gr AS (SELECT r, len(g) AS nr, unnest(g) AS w FROM (SELECT r, {_TRIGRAMS.format('r')} AS g FROM (SELECT DISTINCT dn AS r FROM d WHERE dn IS NOT NULL))),
k AS MATERIALIZED (SELECT l, r, count(*) / (nl + nr - count(*)) AS sim FROM gl JOIN gr USING (w) GROUP BY l, r, nl, nr QUALIFY row_number() OVER (PARTITION BY l ORDER BY sim DESC, r) <= 3),
c AS (SELECT * FROM f UNION ALL SELECT raw_id, company_id, 3, sim FROM t JOIN k ON n = l JOIN d ON k.r = dn), s AS MATERIALIZED (SELECT DISTINCT raw_id, company_id, ['NUMBER_ADDR', 'ALIAS', 'NAME_KNN'][r] AS rule, r,
  round(CASE WHEN r = 1 THEN least(1, 0.95::DOUBLE + 0.1::DOUBLE * i + 0.1::DOUBLE * o) ELSE greatest(0, least(1, sim + 0.2::DOUBLE * i + 0.2::DOUBLE * o)) END, 6) AS score
  FROM (SELECT c.*, coalesce(industry = dind, false)::INT AS i, coalesce(addr = daddr, false)::INT AS o FROM c JOIN p USING (raw_id) JOIN d USING (company_id))),
b AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY raw_id ORDER BY score DESC, r, company_id) AS place FROM s),
e AS MATERIALIZED (SELECT DISTINCT p.raw_id, company_id, rule, score, CASE WHEN score IS NULL THEN 'NO_CANDIDATE' WHEN score >= 0.9 THEN 'ACCEPTED' WHEN score >= 0.75 THEN 'REVIEW' ELSE 'REJECTED' END AS decision FROM p LEFT JOIN b ON b.raw_id = p.raw_id AND place = 1) """


def _resolution(s: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(raw records, aliases, scored candidates)."""
    p, c, a = (table(s, d, n) for n in ("pension", "dim_company", "company_alias"))
    raw = p.select(F.col("id").alias("raw_id"), F.col("company_name").alias("name"), F.col("business_reg_num").alias("number"), F.concat("addr_sigungu_code", F.lit("-"), "legal_dong_addr_code").alias("addr_key"), F.col("industry_code").alias("industry"), F.date_format("data_created_ym", "yyyy-MM").alias("ym"), "subscriber_count")
    dim = c.select("company_id", F.col("canonical_name").alias("name"), F.col("business_reg_num").alias("number"), "addr_key", F.col("industry_code").alias("industry"))
    alias = a.where("company_id is not null").select("company_id", F.col("alias").alias("name")).distinct()
    return raw, alias, cut(pipe.score_candidates(raw, dim, alias))


@query(_CANDIDATES + "SELECT * FROM e")
def c09_resolve(s: SparkSession, d: str) -> DataFrame:
    """Decision on every record."""
    raw, _, scored = _resolution(s, d)
    return pipe.decide(raw, scored)


@query(_CANDIDATES + "SELECT raw_id, place::INT AS place, company_id, rule, score FROM b WHERE place <= 3")
def c09_audit(s: SparkSession, d: str) -> DataFrame:
    return pipe.audit(_resolution(s, d)[2])


@query(_CANDIDATES + ", q AS (SELECT raw_id, company_id, 0.5::DOUBLE AS score, 'DONE' AS status FROM e WHERE decision = 'REVIEW' AND raw_id % 2 = 0) SELECT * FROM q UNION ALL SELECT raw_id, company_id, score, 'PENDING' FROM e WHERE decision = 'REVIEW' AND raw_id % 2 <> 0")
def c09_review_queue(s: SparkSession, d: str) -> DataFrame:
    """Records with even ids have been reviewed before."""
    raw, _, scored = _resolution(s, d)
    decisions = cut(pipe.decide(raw, scored))
    queue = decisions.where("decision = 'REVIEW' and raw_id % 2 = 0").select("raw_id", "company_id", F.lit(0.5).alias("score"), F.lit("DONE").alias("status"))
    return pipe.review_queue(decisions, queue)


@query(_CANDIDATES + "SELECT DISTINCT e.company_id, p.n AS name FROM e JOIN p USING (raw_id) WHERE decision = 'ACCEPTED' AND length(p.n) >= 3 AND NOT EXISTS (SELECT 1 FROM a WHERE a.company_id = e.company_id AND a.n = p.n)")
def c09_aliases(s: SparkSession, d: str) -> DataFrame:
    raw, alias, scored = _resolution(s, d)
    return pipe.learned_aliases(raw, pipe.decide(raw, scored), alias)


@query(_CANDIDATES + ", m AS (SELECT company_id, min(company_id) OVER (PARTITION BY canonical_name) AS rollup_id FROM dim_company), y AS (SELECT id AS raw_id, strftime(data_created_ym, '%Y-%m') AS ym, subscriber_count FROM pension) SELECT rollup_id, ym, sum(subscriber_count)::BIGINT AS subscriber_count, count(*) AS records FROM e JOIN y USING (raw_id) JOIN m USING (company_id) WHERE decision = 'ACCEPTED' GROUP BY ALL")
def c09_rollup_facts(s: SparkSession, d: str) -> DataFrame:
    """Subscribers of accepted records by month, by the first company of a name."""
    raw, _, scored = _resolution(s, d)
    c = table(s, d, "dim_company").select("company_id", "canonical_name")
    rollup = c.join(c.groupBy("canonical_name").agg(F.min("company_id").alias("rollup_id")), "canonical_name").select("company_id", "rollup_id")
    return pipe.monthly_facts(raw, pipe.decide(raw, scored), rollup, "ym", ["subscriber_count"])[1].select("rollup_id", "ym", "subscriber_count", "records")


@query("""SELECT c_custkey, o_totalprice, strftime(o_orderdate, '%Y-%m-%d') AS order_date, l_extendedprice, strftime(l_shipdate, '%Y-%m-%d') AS ship_date FROM customer
LEFT JOIN (SELECT o_custkey, o_totalprice, o_orderdate FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1) o ON o.o_custkey = c_custkey
LEFT JOIN (SELECT o_custkey, l_extendedprice, l_shipdate FROM lineitem JOIN orders ON l_orderkey = o_orderkey QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC) = 1) l ON l.o_custkey = c_custkey""")
def c11_serve_latest(s: SparkSession, d: str) -> DataFrame:
    c, o, l = (table(s, d, n) for n in ("customer", "orders", "lineitem"))  # noqa: E741
    lines = l.select("l_orderkey", "l_linenumber", "l_extendedprice", "l_shipdate").join(o.select("o_orderkey", F.col("o_custkey").alias("c_custkey")), F.col("l_orderkey") == F.col("o_orderkey"))
    facts = {"order": (o.withColumnRenamed("o_custkey", "c_custkey"), ["o_orderdate", "o_orderkey"], ["o_totalprice"]), "ship": (lines, ["l_shipdate", "l_orderkey", "l_linenumber"], ["l_extendedprice"])}
    out = pipe.serve_latest(c.select("c_custkey"), "c_custkey", facts)
    return out.select("c_custkey", "o_totalprice", F.date_format("order_date", "yyyy-MM-dd").alias("order_date"), "l_extendedprice", F.date_format("ship_date", "yyyy-MM-dd").alias("ship_date"))


@query("""WITH m AS (SELECT strftime(o_orderdate, '%Y') AS year, c_nationkey, round(sum(o_totalprice - 250000), 2) AS spend FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL HAVING round(sum(o_totalprice - 250000), 2) > 0), r AS (SELECT *, row_number() OVER (PARTITION BY year ORDER BY spend DESC, c_nationkey)::INT AS rank FROM m),
p AS (SELECT year, c_nationkey, rank, lag(rank) OVER (PARTITION BY c_nationkey ORDER BY year) AS prior_rank FROM r) SELECT * FROM p WHERE rank IS DISTINCT FROM prior_rank""")
def c12_rank_changes(s: SparkSession, d: str) -> DataFrame:
    o, c = table(s, d, "orders"), table(s, d, "customer")
    m = o.select("o_custkey", F.date_format("o_orderdate", "yyyy").alias("year"), "o_totalprice").join(c.select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey")).groupBy("year", "c_nationkey").agg(F.round(F.sum(F.col("o_totalprice") - 250000), 2).alias("spend"))
    return pipe.rank_changes(m, "c_nationkey", "year", "spend")


@query("""WITH v AS (SELECT DISTINCT title FROM ss_normalized_posts WHERE title IS NOT NULL), t AS (SELECT name, unnest(aliases_keyb) AS term FROM phone_models), u AS (SELECT term, min(name) AS name FROM t WHERE term <> '' GROUP BY 1),
a AS (SELECT '(' || string_agg(regexp_escape(term), '|' ORDER BY length(term) DESC, term) || ')' AS p, map(list(term), list(name)) AS names FROM u), k AS (SELECT title, replace(KEY_A, ' ', '') AS k FROM v, m)
SELECT title, array_to_string(list_transform(regexp_extract_all(k, p, 1), lambda x: names[x]), ',') AS names FROM k, a""".replace("KEY_A", key_a_sql("title")).replace("WITH v", f"WITH {_MAPS}, v"))
def c15_dictionary(s: SparkSession, d: str) -> DataFrame:
    terms = {r["term"]: r["name"] for r in table(s, d, "phone_models").select("name", F.explode("aliases_keyb").alias("term")).where("term <> ''").groupBy("term").agg(F.min("name").alias("name")).limit(text.MOST_TERMS + 1).collect()}
    p = table(s, d, "ss_normalized_posts").select("title").where("title is not null").distinct()
    return pipe.match_dictionary(p, "title", terms).select("title", F.array_join("names", ",").alias("names"))


@query("""WITH r AS (SELECT regexp_extract(url, '^[a-zA-Z]+://([^/?#]+)', 1) AS site, post_id, comments_count, content FROM ss_normalized_posts) SELECT site, count(*) AS posts, count(DISTINCT post_id) AS ids, sum(comments_count)::BIGINT AS comments, count(*) FILTER (WHERE coalesce(content, '') = '') AS empty, round(count(*) FILTER (WHERE coalesce(content, '') = '') / count(*), 6) AS empty_rate FROM r GROUP BY 1""")
def c16_crawl_statistics(s: SparkSession, d: str) -> DataFrame:
    r = table(s, d, "ss_normalized_posts").select(F.regexp_extract("url", "^[a-zA-Z]+://([^/?#]+)", 1).alias("site"), "post_id", "comments_count", (F.coalesce("content", F.lit("")) == "").alias("e"))
    return r.groupBy("site").agg(F.count(F.lit(1)).alias("posts"), F.countDistinct("post_id").alias("ids"), F.sum("comments_count").alias("comments"), F.count_if("e").alias("empty"), F.round(F.count_if("e") / F.count(F.lit(1)), 6).alias("empty_rate"))


# ---- streams, run to their end


def _run(s: SparkSession, stream: DataFrame, keys: list[str] | None) -> DataFrame:
    """The table that a stream leaves behind after all that has arrived."""
    root = f"{checkpoint_dir(s).rstrip('/')}/stream-{uuid.uuid4().hex}"
    streams.to_table(stream, f"{root}/table", f"{root}/state", keys).awaitTermination()
    return streams.current_table(s, f"{root}/table", stream.schema)


@query("""WITH w AS (SELECT user_id, event_id, value, ts, unnest([0, 1, 2]) AS k FROM events), x AS (SELECT user_id, event_id, value, ts, (floor(epoch(ts))::BIGINT // 28800 - k) * 28800 AS a FROM w)
SELECT strftime(to_timestamp(a) AT TIME ZONE 'UTC', '%Y-%m-%d %H:%M:%S') AS window_start, user_id, arg_min(value, struct_pack(a := ts, b := event_id)) AS first, arg_max(value, struct_pack(a := ts, b := event_id)) AS last, count(*) AS n FROM x GROUP BY a, user_id""")
def t03_trend_stream(s: SparkSession, d: str) -> DataFrame:
    e = streams.table_stream(s, d, "events")
    t = streams.trend_stream(e, "user_id", "ts", "value", "event_id", "24 hours", "8 hours", "40 days")
    out = _run(s, t, ["window_start", "user_id"])
    return out.select(F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("window_start"), "user_id", "first", "last", "n")


@query("""WITH g AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 6 HOUR THEN 0 ELSE 1 END AS new FROM events), n AS (SELECT user_id, ts, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM g)
SELECT user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS session_start, count(*) AS n FROM n GROUP BY user_id, k""")
def t04_sessions(s: SparkSession, d: str) -> DataFrame:
    e = table(s, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return streams.session_stream(e, "user_id", "ts", "6 hours").select("user_id", F.date_format("session_start", "yyyy-MM-dd HH:mm:ss").alias("session_start"), "n")


@query("""WITH g AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 6 HOUR THEN 0 ELSE 1 END AS new FROM events), n AS (SELECT user_id, ts, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM g)
SELECT user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS session_start, count(*) AS n FROM n GROUP BY user_id, k HAVING max(ts) + INTERVAL 6 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR""")
def t04_session_stream(s: SparkSession, d: str) -> DataFrame:
    """A session comes out once the watermark, an hour behind the latest row, has passed its end."""
    e = streams.session_stream(streams.table_stream(s, d, "events"), "user_id", "ts", "6 hours", "1 hour")
    return _run(s, e, None).select("user_id", F.date_format("session_start", "yyyy-MM-dd HH:mm:ss").alias("session_start"), "n")


@query("""WITH t AS (SELECT ts - INTERVAL 5 DAY AS mark FROM events WHERE event_id % 2 = 0 ORDER BY ts DESC, event_id DESC LIMIT 1 OFFSET 1) SELECT strftime(ts, '%Y-%m-%d') AS day, event_type, count(*) AS n FROM events, t WHERE event_id % 2 = 0 OR date_trunc('day', ts) + INTERVAL 1 DAY > mark GROUP BY ALL""")
def t05_late_rows(s: SparkSession, d: str) -> DataFrame:
    """Events with odd ids arrive after all others: those of days that had ended five days before the latest but one of the others come too late.

    Rows are held against the watermark of the batch before, so the latest
    row with an even id is a batch of its own in between.
    """
    folder = f"{checkpoint_dir(s).rstrip('/')}/arrivals-{uuid.uuid4().hex}"
    e = table(s, d, "events").select(F.col("ts").cast("timestamp").alias("ts"), "event_type", "event_id")
    even = e.where(F.col("event_id") % 2 == 0)
    latest = even.orderBy(F.desc("ts"), F.desc("event_id")).limit(1)
    for arrival in (even.join(latest.select("event_id"), "event_id", "left_anti"), latest, e.where(F.col("event_id") % 2 != 0)):
        arrival.select("ts", "event_type").coalesce(1).write.mode("append").parquet(folder)
    stream = s.readStream.schema("ts timestamp, event_type string").option("maxFilesPerTrigger", 1).parquet(folder)
    days = stream.withWatermark("ts", "5 days").groupBy(F.window("ts", "1 day"), "event_type").agg(F.count(F.lit(1)).alias("n"))
    out = _run(s, days.select(F.date_format("window.start", "yyyy-MM-dd").alias("day"), "event_type", "n"), ["day", "event_type"])
    return out.select("day", "event_type", "n")


@query("SELECT DISTINCT user_id, event_type FROM events")
def t06_dedupe_stream(s: SparkSession, d: str) -> DataFrame:
    e = streams.table_stream(s, d, "events").select("user_id", "event_type", "ts")
    return _run(s, streams.dedupe_stream(e, ["user_id", "event_type"], "ts", "60 days"), None).select("user_id", "event_type")


@query()
def t07_rotation_stream(s: SparkSession, d: str) -> DataFrame:
    """Counter with gaps and cooldown per user, as keyed state; tests compare it with a plain loop."""
    e = streams.table_stream(s, d, "events")
    return _run(s, streams.rotation_stream(e, "user_id", "ts", gap=6 * 3600, hits=3, cooldown=86400), None)


@query("SELECT user_id, count(*) AS n, max(event_id) AS last FROM events GROUP BY 1")
def t08_stream_upsert(s: SparkSession, d: str) -> DataFrame:
    e = streams.table_stream(s, d, "events")
    return _run(s, e.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), F.max("event_id").alias("last")), ["user_id"])


@query("""WITH l AS (SELECT o_custkey, strftime(o_orderdate, '%Y') AS year, round(sum(o_totalprice), 2)::DOUBLE AS spend, count(*)::DOUBLE AS orders FROM orders GROUP BY ALL), u AS (UNPIVOT l ON spend, orders INTO NAME metric VALUE value),
r AS (SELECT year, o_custkey, metric, value, row_number() OVER (PARTITION BY year, metric ORDER BY value DESC NULLS LAST, o_custkey)::INT AS rank FROM u), p AS (SELECT *, lag(rank) OVER (PARTITION BY o_custkey, metric ORDER BY year) AS prior_rank FROM r)
SELECT o_custkey, metric, year, value, rank, prior_rank FROM p WHERE year = (SELECT max(year) FROM l)""")
def c13_rank_history(s: SparkSession, d: str) -> DataFrame:
    m = table(s, d, "orders").groupBy("o_custkey", F.date_format("o_orderdate", "yyyy").alias("year")).agg(F.round(F.sum("o_totalprice"), 2).alias("spend"), F.count(F.lit(1)).cast("double").alias("orders"))
    ranks = rel.rank_metrics(m, "o_custkey", ["spend", "orders"], ["year"])
    day = m.agg(F.max("year")).first()[0]
    now, before = ranks.where(F.col("year") == day), ranks.where(F.col("year") < F.lit(day))
    return rel.asof_prior(now, before.select("o_custkey", "metric", "year", "rank"), ["o_custkey", "metric"], "year", ["rank"])


@query("SELECT exchange, strftime(date, '%Y-%m') AS month, count(*) FILTER (WHERE exchange <> 'MAIN' OR name IS NOT NULL) AS n FROM stockcodename GROUP BY ALL HAVING n > 0")
def w01_overwrite_partitions(s: SparkSession, d: str) -> DataFrame:
    """All partitions are written, then those of one exchange again without nameless rows."""
    from weftline.sources.sinks import overwrite_partitions

    path = f"{checkpoint_dir(s).rstrip('/')}/partitions-{uuid.uuid4().hex}"
    t = table(s, d, "stockcodename").withColumn("month", F.date_format("date", "yyyy-MM"))
    overwrite_partitions(t, path, ["exchange", "month"])
    overwrite_partitions(t.where("exchange = 'MAIN' and name is not null"), path, ["exchange", "month"])
    return s.read.parquet(path).groupBy("exchange", F.col("month").cast("string").alias("month")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT c_mktsegment, count(*) AS n FROM customer WHERE c_acctbal > 0 GROUP BY 1")
def w09_snapshot(s: SparkSession, d: str) -> DataFrame:
    """Two versions are published; readers see the second."""
    from weftline.sources.sinks import current_snapshot, publish_snapshot

    root = f"{checkpoint_dir(s).rstrip('/')}/snapshot-{uuid.uuid4().hex}"
    publish_snapshot(table(s, d, "customer"), root)
    publish_snapshot(current_snapshot(s, root).where("c_acctbal > 0"), root)
    return current_snapshot(s, root).groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n"))


@query("""WITH p AS (SELECT company_id, min(company_id) OVER (PARTITION BY canonical_name) AS rollup_id FROM dim_company), q AS (SELECT company_id, rollup_id FROM p WHERE company_id <> rollup_id AND company_id % 3 = 0)
SELECT company_id, coalesce((SELECT rollup_id FROM q WHERE q.company_id = p.company_id), company_id) AS rollup_id FROM p""")
def u15_rollup(s: SparkSession, d: str) -> DataFrame:
    """Reviews approve that a third of the companies of one name belong to its first; before, each stands for itself."""
    c = table(s, d, "dim_company").select("company_id", "canonical_name")
    first = c.groupBy("canonical_name").agg(F.min("company_id").alias("rollup_id"))
    q = c.join(first, "canonical_name").where("company_id <> rollup_id").select("company_id", "rollup_id", F.when(F.col("company_id") % 3 == 0, "ACCEPTED").otherwise("REJECTED").alias("decision"))
    return pipe.apply_rollup_review(q, c.select("company_id", F.col("company_id").alias("rollup_id")))


@query("""WITH p AS (SELECT strftime(data_created_ym, '%Y-%m') AS ym FROM pension), m AS (SELECT ym FROM (SELECT DISTINCT ym FROM p) ORDER BY ym LIMIT 1 OFFSET 5), r AS (SELECT min(ym) AS first, max(ym) AS last, count(*) AS rows FROM p WHERE ym <= (SELECT ym FROM m) UNION ALL SELECT min(ym), max(ym), count(*) FROM p WHERE ym > (SELECT ym FROM m))
SELECT md5('pension|' || first || '|' || last) AS run_id, 'pension' AS name, first, last, rows FROM r""")
def u16_run_log(s: SparkSession, d: str) -> DataFrame:
    """Two runs, the second repeated: the first takes six months, the second all later ones."""
    p = table(s, d, "pension").select(F.date_format("data_created_ym", "yyyy-MM").alias("ym"))
    sixth = p.distinct().orderBy("ym").limit(6).agg(F.max("ym")).first()[0]
    control = s.range(0).select(F.lit("").alias("name"), F.lit("").alias("last"))
    log = s.range(0).select(F.lit("").alias("run_id"), F.lit("").alias("name"), F.lit("").alias("first"), F.lit("").alias("last"), F.col("id").alias("rows"))
    once, log = pipe.run_step(control, log, p.where(F.col("ym") <= sixth), "pension", "ym")
    _, log = pipe.run_step(once, log, p, "pension", "ym")
    return pipe.run_step(once, log, p, "pension", "ym")[1]


@query("""WITH b AS (SELECT max(ts) AS top FROM events), u AS (SELECT user_id AS cluster, count(*) AS n, max(ts) AS dt FROM events GROUP BY 1), t AS (SELECT count(*) AS t FROM u),
p AS (SELECT cluster, (t - (rank() OVER (ORDER BY n DESC) - 1)) / t * exp(-greatest(floor(epoch(top)) - floor(epoch(dt)), 0) / 3600.0 / 48) AS score FROM u, t, b),
s AS (SELECT cluster, CASE WHEN cluster % 3 = 0 THEN 0 WHEN cluster % 3 = 1 THEN 2 ELSE 1 END AS consecutive FROM p WHERE cluster % 7 <> 0 ORDER BY p.score DESC, cluster LIMIT 20)
SELECT cluster, coalesce(s.consecutive, 2 - cluster % 3)::INT AS consecutive, s.cluster IS NOT NULL AS shown FROM u LEFT JOIN s USING (cluster)""")
def c05_state(s: SparkSession, d: str) -> DataFrame:
    """State of every cluster after a round of rotation, also of those not shown."""
    old, shown = _rotated(s, d)
    after = pipe.rotation_state(old, shown)
    return after.join(shown.select("cluster", F.lit(True).alias("shown")), "cluster", "left").select("cluster", "consecutive", F.coalesce("shown", F.lit(False)).alias("shown"))


@query(_LISTS + f", k AS (SELECT coalesce(n.exchange, o.exchange) AS exchange, coalesce(n.ticker, o.ticker) AS ticker, coalesce(n.name, o.name) AS name FROM n FULL JOIN o ON {_ON}) SELECT exchange, count(*) AS n, count(name) AS named FROM k GROUP BY 1")
def u07_merge_policies(s: SparkSession, d: str) -> DataFrame:
    """Sparse merge: what is unknown in the new listing keeps its known name."""
    old, new = _listings(s, d)
    return state.upsert(old, new, KEY, merge="sparse").groupBy("exchange").agg(F.count(F.lit(1)).alias("n"), F.count("name").alias("named"))


@query("SELECT company_id, alias FROM (SELECT DISTINCT company_id, alias FROM company_alias WHERE company_id IS NOT NULL AND alias IS NOT NULL UNION SELECT company_id, canonical_name FROM dim_company WHERE company_id % 3 = 0 AND canonical_name IS NOT NULL)")
def u15_review(s: SparkSession, d: str) -> DataFrame:
    a = table(s, d, "company_alias").where("company_id is not null and alias is not null").select("company_id", F.col("alias").alias("name")).distinct()
    q = table(s, d, "dim_company").where("canonical_name is not null").select("company_id", F.col("canonical_name").alias("name"), F.when(F.col("company_id") % 3 == 0, "ACCEPTED").otherwise("REJECTED").alias("decision"))
    return pipe.apply_review(q, a).select("company_id", F.col("name").alias("alias"))
