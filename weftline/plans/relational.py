"""Queries of selections, joins, aggregates, ranks and set operators.

Keys begin with the operator's id in the survey (``pr`` for predicates and
projections, so that they aren't taken for the numbered problems).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from weftline.functions import hashing, values
from weftline.operators import pairs, relational as rel
from weftline.sources.tables import table

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def _t(s: SparkSession, d: str, *names: str):
    return [table(s, d, n) for n in names] if len(names) > 1 else table(s, d, names[0])


# ---- predicates and projections


@query("SELECT l_orderkey, l_linenumber, year(l_shipdate)::INT AS year, month(l_shipdate)::INT AS month, 'K' AS country, l_extendedprice * (1 - l_discount) AS net FROM lineitem")
def pr01_project(s: SparkSession, d: str) -> DataFrame:
    return _t(s, d, "lineitem").select("l_orderkey", "l_linenumber", F.year("l_shipdate").alias("year"), F.month("l_shipdate").alias("month"), F.lit("K").alias("country"), (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("net"))


@query("SELECT l_orderkey, l_linenumber, l_discount, l_tax FROM lineitem WHERE NOT (l_discount = 0 AND l_tax = 0)")
def pr02_drop_all_zero(s: SparkSession, d: str) -> DataFrame:
    return rel.drop_all_zero(_t(s, d, "lineitem"), ["l_discount", "l_tax"]).select("l_orderkey", "l_linenumber", "l_discount", "l_tax")


@query("SELECT n_nationkey, n_name FROM nation WHERE (SELECT bool_and(n_regionkey >= 0) FROM nation)")
def pr03_all_or_nothing(s: SparkSession, d: str) -> DataFrame:
    return rel.all_or_nothing(_t(s, d, "nation"), F.col("n_regionkey") >= 0).select("n_nationkey", "n_name")


@query("SELECT alias_id, alias, normalized_alias FROM (SELECT DISTINCT alias_id, alias, normalized_alias FROM company_alias) WHERE alias IS DISTINCT FROM normalized_alias")
def pr04_changed(s: SparkSession, d: str) -> DataFrame:
    return _t(s, d, "company_alias").where(values.changed(F.col("alias"), F.col("normalized_alias"))).select("alias_id", "alias", "normalized_alias").distinct()


@query("SELECT c_mktsegment, count(*) AS n FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY') AND NOT (c_nationkey IN (1, 2, 3)) GROUP BY 1")
def pr05_any_of(s: SparkSession, d: str) -> DataFrame:
    c = _t(s, d, "customer")
    wanted = F.array(F.lit("BUILDING"), F.lit("MACHINERY"))
    return c.where(F.array_contains(wanted, F.col("c_mktsegment")) & ~F.col("c_nationkey").isin(1, 2, 3)).groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT p_partkey, p_name FROM part WHERE p_name ILIKE '%A%' AND p_size < 20")
def pr06_optional_filters(s: SparkSession, d: str) -> DataFrame:
    df, filters = _t(s, d, "part"), {"like": "%A%", "below": 20, "brand": None}
    for name, f in (("like", F.col("p_name").ilike("%A%")), ("below", F.col("p_size") < 20), ("brand", F.col("p_brand") == F.lit(filters["brand"]))):
        df = df.where(f) if filters[name] is not None else df
    return df.select("p_partkey", "p_name")


@query("SELECT o_orderpriority, CASE WHEN o_totalprice > 300000 THEN 'P0' WHEN o_totalprice > 150000 THEN 'P1' ELSE 'P2' END AS priority, count(*) AS n FROM orders GROUP BY ALL")
def pr07_case(s: SparkSession, d: str) -> DataFrame:
    p = F.when(F.col("o_totalprice") > 300000, "P0").when(F.col("o_totalprice") > 150000, "P1").otherwise("P2")
    return _t(s, d, "orders").groupBy("o_orderpriority", p.alias("priority")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT DISTINCT id, coalesce(plan_high_fee, 0) AS fee, nullif(capacity, '1TB') AS capacity, least('P0', 'P1') AS priority, greatest(plan_high_months, plan_after_months) AS months FROM deals")
def pr08_coalesce(s: SparkSession, d: str) -> DataFrame:
    return _t(s, d, "deals").select("id", F.coalesce("plan_high_fee", F.lit(0)).alias("fee"), F.nullif("capacity", F.lit("1TB")).alias("capacity"), F.least(F.lit("P0"), F.lit("P1")).alias("priority"), F.greatest("plan_high_months", "plan_after_months").alias("months")).distinct()


@query("WITH b AS (SELECT max(ts) AS top FROM events) SELECT event_id, user_id FROM events, b WHERE ts > top - INTERVAL 3 DAY")
def pr09_bounds(s: SparkSession, d: str) -> DataFrame:
    e = _t(s, d, "events")
    # the bound is one value, fetched first: as a literal it reaches the scan
    top = e.agg(F.max("ts")).first()[0]
    return e.where(F.col("ts") > F.lit(top).cast("timestamp_ntz") - F.expr("interval 3 days")).select("event_id", "user_id")


@query("SELECT event_type, count(*) AS n FROM events WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 72 HOUR GROUP BY 1")
def pr10_since(s: SparkSession, d: str) -> DataFrame:
    e = _t(s, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    as_of = e.agg(F.max("ts")).first()[0]
    return e.where(values.since(F.col("ts"), F.lit(as_of), 72 * 3600)).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT doc_id, (contains(text, '조건')::INT + contains(text, '가격')::INT + contains(text, 'price')::INT) AS hits FROM documents WHERE text IS NOT NULL AND (contains(text, '조건') OR contains(text, '가격') OR contains(text, 'price'))")
def pr11_count_hits(s: SparkSession, d: str) -> DataFrame:
    from weftline.functions.text import count_hits

    return _t(s, d, "documents").select("doc_id", count_hits(F.col("text"), ["조건", "가격", "price"]).alias("hits")).where("hits > 0")


# ---- joins


@query("SELECT n_name, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1")
def j01_inner(s: SparkSession, d: str) -> DataFrame:
    c, n = _t(s, d, "customer", "nation")
    return c.groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("n")).join(n, F.col("c_nationkey") == F.col("n_nationkey")).select("n_name", "n")


@query("""SELECT c_custkey, coalesce(n, 0) AS orders, coalesce(f, 0) AS finished FROM customer
LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) a ON a.o_custkey = c_custkey LEFT JOIN (SELECT o_custkey, count(*) AS f FROM orders WHERE o_orderstatus = 'F' GROUP BY 1) b ON b.o_custkey = c_custkey""")
def j02_left_chain(s: SparkSession, d: str) -> DataFrame:
    c, o = _t(s, d, "customer", "orders")
    # the chain of rollups by one key is one aggregate
    a = o.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("o_orderstatus") == "F").alias("f"))
    return c.join(a, F.col("c_custkey") == F.col("o_custkey"), "left").select("c_custkey", F.coalesce("n", F.lit(0)).alias("orders"), F.coalesce("f", F.lit(0)).alias("finished"))


_LISTS = """WITH r AS (SELECT exchange, date, lpad(trim(ticker), 6, '0') AS ticker, max(name) AS name FROM stockcodename GROUP BY ALL), b AS (SELECT exchange, min(date) AS a, max(date) AS z FROM r GROUP BY 1),
o AS (SELECT r.exchange, ticker, name FROM r JOIN b ON r.exchange = b.exchange AND date = a), n AS (SELECT r.exchange, ticker, name FROM r JOIN b ON r.exchange = b.exchange AND date = z) """


def _listings(s: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """(first, last) listing of each exchange."""
    from weftline.functions.names import pad_ticker

    r = _t(s, d, "stockcodename").groupBy("exchange", "date", pad_ticker(F.trim("ticker")).alias("ticker")).agg(F.max("name").alias("name"))
    b = r.groupBy("exchange").agg(F.min("date").alias("a"), F.max("date").alias("z"))
    return tuple(r.join(b.select("exchange", F.col(x).alias("date")), ["exchange", "date"]).select("exchange", "ticker", "name") for x in "az")


@query(_LISTS + """SELECT coalesce(n.exchange, o.exchange) AS exchange, coalesce(n.ticker, o.ticker) AS ticker, CASE WHEN o.ticker IS NULL THEN 'added' WHEN n.ticker IS NULL THEN 'removed' WHEN n.name IS DISTINCT FROM o.name THEN 'changed' ELSE 'same' END AS action
FROM n FULL JOIN o ON n.exchange = o.exchange AND n.ticker = o.ticker""")
def j03_full_outer(s: SparkSession, d: str) -> DataFrame:
    old, new = _listings(s, d)
    return rel.diff_outer(new, old, ["exchange", "ticker"], ["name"]).select("exchange", "ticker", "action")


@query("SELECT c_custkey, c_name FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 200000)")
def j04_semi(s: SparkSession, d: str) -> DataFrame:
    c, o = _t(s, d, "customer", "orders")
    return c.join(o.where("o_totalprice > 200000"), F.col("c_custkey") == F.col("o_custkey"), "left_semi").select("c_custkey", "c_name")


@query("SELECT o_orderkey, o_custkey FROM orders WHERE (o_custkey, o_orderdate) IN (SELECT o_custkey, max(o_orderdate) FROM orders GROUP BY 1)")
def j05_row_value_in(s: SparkSession, d: str) -> DataFrame:
    o = _t(s, d, "orders")
    last = o.groupBy("o_custkey").agg(F.max("o_orderdate").alias("o_orderdate"))
    return o.join(last, ["o_custkey", "o_orderdate"], "left_semi").select("o_orderkey", "o_custkey")


@query("SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 300000)")
def j06_anti(s: SparkSession, d: str) -> DataFrame:
    c, o = _t(s, d, "customer", "orders")
    return c.join(o.where("o_totalprice > 300000"), F.col("c_custkey") == F.col("o_custkey"), "left_anti").select("c_custkey")


@query("SELECT p_partkey FROM part LEFT JOIN (SELECT DISTINCT l_partkey FROM lineitem WHERE l_quantity > 49) a ON l_partkey = p_partkey LEFT JOIN (SELECT DISTINCT l_partkey AS k FROM lineitem WHERE l_discount = 0) b ON k = p_partkey WHERE l_partkey IS NULL AND k IS NULL")
def j07_double_anti(s: SparkSession, d: str) -> DataFrame:
    p, l = _t(s, d, "part", "lineitem")  # noqa: E741
    on = F.col("p_partkey") == F.col("l_partkey")
    return p.join(l.where("l_quantity > 49 or l_discount = 0"), on, "left_anti").select("p_partkey")


RANGES = {"3d": 3 * 86400, "7d": 7 * 86400, "14d": 14 * 86400}


@query("""WITH b AS (SELECT max(ts) AS top FROM events), r AS (SELECT * FROM (VALUES ('3d', 259200), ('7d', 604800), ('14d', 1209600)) v(range, sec))
SELECT range, event_type, count(*) AS n FROM events, b, r WHERE ts >= top - to_seconds(sec) AND ts <= top GROUP BY ALL""")
def j08_ranges(s: SparkSession, d: str) -> DataFrame:
    e = _t(s, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    as_of = e.agg(F.max("ts")).first()[0]
    # the ranges nest: counting by age class before the explosion keeps it small
    return rel.range_explode(e, "ts", RANGES, F.lit(as_of)).groupBy("range", "event_type").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT c_custkey, o_orderkey, o_totalprice FROM customer JOIN (SELECT * FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1) ON o_custkey = c_custkey")
def j09_latest(s: SparkSession, d: str) -> DataFrame:
    c, o = _t(s, d, "customer", "orders")
    last = rel.latest_by(o.select("o_custkey", "o_orderdate", "o_orderkey", "o_totalprice"), ["o_custkey"], ["o_orderdate", "o_orderkey"])
    return c.select("c_custkey").join(last, F.col("c_custkey") == F.col("o_custkey")).select("c_custkey", "o_orderkey", "o_totalprice")


_TRIGRAMS = "list_distinct(flatten(list_transform(list_filter(regexp_split_to_array(trim(regexp_replace(lower({0}), '[^0-9a-z가-힣]+', ' ', 'g')), ' +'), lambda w: w <> ''), lambda w: list_transform(range(1, length(w) + 2), lambda i: substr('  ' || w || ' ', i, 3)))))"


@query(f"""WITH n AS (SELECT DISTINCT p_name AS l, {_TRIGRAMS.format('p_name')} AS g FROM part), x AS (SELECT l, len(g) AS n, unnest(g) AS t FROM n),
m AS (SELECT a.l, b.l AS r, a.n AS nl, b.n AS nr, count(*) AS k FROM x a JOIN x b ON a.t = b.t GROUP BY ALL)
SELECT l, r, round(k / (nl + nr - k), 6) AS similarity, row_number() OVER (PARTITION BY l ORDER BY k / (nl + nr - k) DESC, r)::INT AS place FROM m QUALIFY place <= 3""")
def j10_knn_trigram(s: SparkSession, d: str) -> DataFrame:
    p = _t(s, d, "part")
    return pairs.knn_trigram(p, p, "p_name", 3).select("l", "r", F.round("similarity", 6).alias("similarity"), "place")


@query("SELECT id, a.name AS addon, a.fee AS fee FROM (SELECT DISTINCT id, addons_detail FROM deals), unnest(addons_detail) u(a)")
def j11_explode(s: SparkSession, d: str) -> DataFrame:
    return _t(s, d, "deals").select("id", "addons_detail").dropDuplicates(["id"]).select("id", F.explode("addons_detail").alias("a")).select("id", F.col("a.name").alias("addon"), F.col("a.fee").alias("fee"))


@query("SELECT company_id, t AS company_type FROM dim_company LEFT JOIN LATERAL (SELECT unnest(company_types) AS t) ON true")
def j12_explode_outer(s: SparkSession, d: str) -> DataFrame:
    return _t(s, d, "dim_company").select("company_id", F.explode_outer("company_types").alias("company_type"))


_MONTHS = "WITH m AS (SELECT o_custkey, strftime(o_orderdate, '%Y-%m') AS month, round(sum(o_totalprice), 2) AS spend FROM orders GROUP BY ALL)"


def _months(s: SparkSession, d: str) -> DataFrame:
    return _t(s, d, "orders").groupBy("o_custkey", F.date_format("o_orderdate", "yyyy-MM").alias("month")).agg(F.round(F.sum("o_totalprice"), 2).alias("spend"))


@query(_MONTHS + " SELECT o_custkey, month, spend, lag(spend) OVER (PARTITION BY o_custkey ORDER BY month) AS prior_spend FROM m")
def j13_prior(s: SparkSession, d: str) -> DataFrame:
    m = _months(s, d)
    return rel.asof_prior(m, m, ["o_custkey"], "month", ["spend"])


@query("SELECT o_custkey, arg_min(o_totalprice, struct_pack(a := o_orderdate, b := o_orderkey)) AS first_o_totalprice, arg_max(o_totalprice, struct_pack(a := o_orderdate, b := o_orderkey)) AS last_o_totalprice FROM orders GROUP BY 1")
def j14_first_last(s: SparkSession, d: str) -> DataFrame:
    return rel.first_last(_t(s, d, "orders"), ["o_custkey"], ["o_orderdate", "o_orderkey"], ["o_totalprice"])


@query("""WITH a AS (SELECT alias_id, min(company_id) AS company_id, min(normalized_alias) AS normalized_alias FROM company_alias GROUP BY 1), k AS (SELECT normalized_alias, min(company_id) AS cid FROM company_alias WHERE company_id IS NOT NULL AND normalized_alias IS NOT NULL GROUP BY 1)
SELECT alias_id, coalesce(a.company_id, cid) AS company_id FROM a LEFT JOIN k USING (normalized_alias)""")
def j15_enrich_null_fk(s: SparkSession, d: str) -> DataFrame:
    t = _t(s, d, "company_alias")
    a = t.groupBy("alias_id").agg(F.min("company_id").alias("company_id"), F.min("normalized_alias").alias("normalized_alias"))
    k = t.where("company_id is not null and normalized_alias is not null").groupBy("normalized_alias").agg(F.min("company_id").alias("company_id"))
    return rel.enrich_null_fk(a, k, ["normalized_alias"], "company_id", []).select("alias_id", "company_id")


@query("SELECT DISTINCT a.company_id AS a, b.company_id AS b FROM dim_company a JOIN dim_company b ON (a.addr_key = b.addr_key OR a.business_reg_num = b.business_reg_num) AND a.company_id < b.company_id")
def j16_candidate_pairs(s: SparkSession, d: str) -> DataFrame:
    keys = F.array_compact(F.array(F.concat(F.lit("a"), "addr_key"), F.concat(F.lit("b"), "business_reg_num")))
    return pairs.candidate_pairs(_t(s, d, "dim_company"), "company_id", keys)


@query("""WITH m AS (SELECT c_nationkey AS g, c_acctbal AS v, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS r FROM customer QUALIFY r <= 8),
p AS (SELECT a.n_nationkey AS a, b.n_nationkey AS b FROM nation a JOIN nation b ON a.n_regionkey = b.n_regionkey AND a.n_nationkey < b.n_nationkey),
x AS (SELECT p.a, p.b, ma.r, max(1 / (1 + abs(ma.v - mb.v))) AS s FROM p JOIN m ma ON ma.g = p.a JOIN m mb ON mb.g = p.b GROUP BY ALL),
l AS (SELECT a, b, list(s ORDER BY s DESC) AS s FROM x GROUP BY ALL)
SELECT a, b, round(coalesce(s[1], 0), 9) AS best1, round(coalesce(s[2], 0), 9) AS best2, round(coalesce(s[3], 0), 9) AS best3 FROM l""")
def j17_best_matches(s: SparkSession, d: str) -> DataFrame:
    c, n = _t(s, d, "customer", "nation")
    m = c.select(F.col("c_nationkey").alias("group"), F.col("c_acctbal").alias("v"), F.row_number().over(Window.partitionBy("c_nationkey").orderBy("c_custkey")).alias("rank"))
    p = pairs.candidate_pairs(n, "n_nationkey", F.array(F.col("n_regionkey").cast("string")))
    out = pairs.best_matches(p, m, 1 / (1 + F.abs(F.col("ma.v") - F.col("mb.v"))))
    return out.select("a", "b", *[F.round(x, 9).alias(x) for x in ("best1", "best2", "best3")])


@query("SELECT DISTINCT id, carrier FROM deals WHERE carrier IN (SELECT name FROM carriers)")
def j18_dictionary(s: SparkSession, d: str) -> DataFrame:
    deals, c = _t(s, d, "deals", "carriers")
    return deals.select("id", "carrier").join(F.broadcast(c.select(F.col("name").alias("carrier"))), "carrier").select("id", "carrier").distinct()


@query("""WITH a AS (SELECT DISTINCT alias, normalized_alias FROM company_alias WHERE alias IS NOT NULL), n AS (SELECT DISTINCT canonical_name, normalized_name FROM dim_company),
m AS (SELECT alias, canonical_name, 1 AS tier FROM a JOIN n ON alias = canonical_name UNION ALL SELECT alias, canonical_name, 2 FROM a JOIN n ON normalized_alias = normalized_name UNION ALL SELECT alias, canonical_name, 3 FROM a JOIN n ON substr(normalized_alias, 1, 4) = substr(normalized_name, 1, 4))
SELECT alias, canonical_name, tier FROM m QUALIFY row_number() OVER (PARTITION BY alias ORDER BY tier, canonical_name) = 1""")
def j19_tiers(s: SparkSession, d: str) -> DataFrame:
    a = _t(s, d, "company_alias").select("alias", "normalized_alias").where("alias is not null").distinct()
    n = _t(s, d, "dim_company").select("canonical_name", "normalized_name").distinct()
    # one join on tagged keys for all tiers
    keys = lambda *cols: F.explode(F.array_compact(F.array(*[F.when(c.isNotNull(), F.struct(F.lit(i + 1).alias("tier"), c.alias("k"))) for i, c in enumerate(cols)]))).alias("x")
    l = a.select("alias", keys(F.col("alias"), F.col("normalized_alias"), F.substring("normalized_alias", 1, 4))).select("alias", "x.*")  # noqa: E741
    r = n.select("canonical_name", keys(F.col("canonical_name"), F.col("normalized_name"), F.substring("normalized_name", 1, 4))).select("canonical_name", "x.*")
    return rel.keep_first(l.join(r, ["tier", "k"]).select("alias", "canonical_name", "tier"), ["alias"], ["tier", "canonical_name"])


@query()
def j19_ratio(s: SparkSession, d: str) -> DataFrame:
    """Aliases of a company against its names: as written, normalised, else alike as sequences; a plain loop in the tests, as SQL has no such ratio."""
    a = _t(s, d, "company_alias").where("company_id is not null and alias is not null").select("company_id", "alias", F.col("alias").alias("as_is"), F.col("normalized_alias").alias("plain")).dropDuplicates(["company_id", "alias"])
    n = _t(s, d, "dim_company").select("company_id", "canonical_name", F.col("canonical_name").alias("as_is"), F.col("normalized_name").alias("plain"))
    return pairs.tiered_matches(a, n, ["company_id"], "alias", "canonical_name", ["as_is", "plain"])


@query("SELECT id, len(list_filter(addons_detail, lambda a: a.fee > 6000)) AS costly, len(list_filter(addons_detail, lambda a: coalesce(a.fee <= 6000, false))) AS cheap FROM (SELECT DISTINCT id, addons_detail FROM deals) WHERE len(addons_detail) > 0")
def j20_split_array(s: SparkSession, d: str) -> DataFrame:
    deals = _t(s, d, "deals").select("id", "addons_detail").dropDuplicates(["id"]).where(F.size("addons_detail") > 0)
    return deals.select("id", F.size(F.filter("addons_detail", lambda a: a["fee"] > 6000)).cast("long").alias("costly"), F.size(F.filter("addons_detail", lambda a: F.coalesce(a["fee"] <= 6000, F.lit(False)))).cast("long").alias("cheap"))


# ---- aggregates


@query("SELECT n_name, round(sum(s_acctbal), 2) AS total, count(*) AS n FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY 1 HAVING sum(s_acctbal) > 0")
def a01_having(s: SparkSession, d: str) -> DataFrame:
    p, n = _t(s, d, "supplier", "nation")
    g = p.groupBy("s_nationkey").agg(F.sum("s_acctbal").alias("t"), F.count(F.lit(1)).alias("n")).where("t > 0")
    return g.join(F.broadcast(n), F.col("s_nationkey") == F.col("n_nationkey")).select("n_name", F.round("t", 2).alias("total"), "n")


@query("SELECT max(o_orderdate)::DATE::VARCHAR AS last_day, count(*) AS n, max(o_totalprice) AS top FROM orders")
def a02_global(s: SparkSession, d: str) -> DataFrame:
    return _t(s, d, "orders").agg(F.date_format(F.max("o_orderdate"), "yyyy-MM-dd").alias("last_day"), F.count(F.lit(1)).alias("n"), F.max("o_totalprice").alias("top"))


@query("SELECT strftime(date_trunc('month', data_created_ym), '%Y-%m-%d') AS month, business_reg_num, sum(subscriber_count)::BIGINT AS subscribers, sum(monthly_notice_amount)::BIGINT AS amount FROM pension GROUP BY ALL")
def a03_monthly(s: SparkSession, d: str) -> DataFrame:
    return _t(s, d, "pension").groupBy(F.date_format(F.date_trunc("month", "data_created_ym"), "yyyy-MM-dd").alias("month"), "business_reg_num").agg(F.sum("subscriber_count").alias("subscribers"), F.sum("monthly_notice_amount").alias("amount"))


@query("SELECT o_orderpriority, count(*) FILTER (WHERE o_orderstatus = 'F') AS f, count(*) FILTER (WHERE o_orderstatus = 'O') AS o, count(*) FILTER (WHERE o_orderstatus = 'P') AS p, count(*) AS total FROM orders GROUP BY 1")
def a04_status_counts(s: SparkSession, d: str) -> DataFrame:
    return rel.status_counts(_t(s, d, "orders"), ["o_orderpriority"], "o_orderstatus", ["F", "O", "P"])


@query("""WITH v AS (SELECT id, any_value(model) AS model, any_value(capacity) AS capacity, any_value(source_posted_at) AS day, min(upfront) AS upfront FROM deals GROUP BY 1)
SELECT model, capacity, strftime(day, '%Y-%m-%d') AS day, min(upfront) AS min, round(quantile_cont(upfront, 0.25))::BIGINT AS p25, round(quantile_cont(upfront, 0.5))::BIGINT AS median, round(quantile_cont(upfront, 0.75))::BIGINT AS p75, max(upfront) AS max, round(avg(upfront))::BIGINT AS avg, count(*) AS n FROM v GROUP BY ALL""")
def a05_percentiles(s: SparkSession, d: str) -> DataFrame:
    v = _t(s, d, "deals").groupBy("id").agg(F.first("model").alias("model"), F.first("capacity").alias("capacity"), F.date_format(F.first("source_posted_at"), "yyyy-MM-dd").alias("day"), F.min("upfront").alias("upfront"))
    return rel.group_percentiles(v, ["model", "capacity", "day"], "upfront", {"p25": 0.25, "median": 0.5, "p75": 0.75}, as_int=True)


@query("SELECT o_custkey, string_agg(o_orderpriority, ' | ' ORDER BY o_orderdate DESC, o_orderkey) AS joined FROM orders GROUP BY 1")
def a06_ordered_concat(s: SparkSession, d: str) -> DataFrame:
    return rel.ordered_concat(_t(s, d, "orders"), ["o_custkey"], "o_orderpriority", [F.desc("o_orderdate"), F.col("o_orderkey")])


@query("""WITH n AS (SELECT c_nationkey, c_mktsegment, count(*) AS k FROM customer GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY k DESC, c_mktsegment) AS r FROM n QUALIFY r <= 3)
SELECT c_nationkey, string_agg(c_mktsegment, ',' ORDER BY r) AS items FROM r GROUP BY 1""")
def a07_top_k_list(s: SparkSession, d: str) -> DataFrame:
    return rel.top_k_list(_t(s, d, "customer"), ["c_nationkey"], "c_mktsegment", 3).select("c_nationkey", F.array_join("items", ",").alias("items"))


@query("SELECT addr_key, string_agg(DISTINCT industry_code, ',' ORDER BY industry_code) AS industries FROM dim_company WHERE industry_code IS NOT NULL GROUP BY 1")
def a08_distinct_list(s: SparkSession, d: str) -> DataFrame:
    return _t(s, d, "dim_company").where("industry_code is not null").groupBy("addr_key").agg(F.array_join(F.sort_array(F.collect_set("industry_code")), ",").alias("industries"))


@query("SELECT event_type, round(avg((props->>'k')::DOUBLE), 6) AS mean, max((props->>'k')::DOUBLE) AS top FROM events GROUP BY 1")
def a09_json_numbers(s: SparkSession, d: str) -> DataFrame:
    k = F.get_json_object("props", "$.k").try_cast("double")
    return _t(s, d, "events").groupBy("event_type").agg(F.round(F.avg(k), 6).alias("mean"), F.max(k).alias("top"))


@query("""WITH n AS (SELECT business_reg_num, company_name, count(*) AS n FROM pension WHERE business_reg_num IS NOT NULL GROUP BY ALL)
SELECT business_reg_num, company_name, n FROM n QUALIFY row_number() OVER (PARTITION BY business_reg_num ORDER BY n DESC, length(company_name) DESC, company_name) = 1""")
def a10_mode(s: SparkSession, d: str) -> DataFrame:
    return rel.mode_by(_t(s, d, "pension").where("business_reg_num is not null"), ["business_reg_num"], "company_name", [F.desc(F.length("company_name"))])


@query("SELECT business_reg_num, sum(subscriber_count)::BIGINT AS subscribers, count(*) AS n FROM (SELECT * FROM pension WHERE business_reg_num IS NOT NULL QUALIFY data_created_ym = max(data_created_ym) OVER (PARTITION BY business_reg_num)) GROUP BY 1")
def a11_latest_month(s: SparkSession, d: str) -> DataFrame:
    p = _t(s, d, "pension").where("business_reg_num is not null")
    # sums by month first, then the last month of each key: no window over raw rows
    m = p.groupBy("business_reg_num", "data_created_ym").agg(F.sum("subscriber_count").alias("subscribers"), F.count(F.lit(1)).alias("n"))
    return rel.latest_by(m, ["business_reg_num"], ["data_created_ym"]).select("business_reg_num", "subscribers", "n")


@query("""WITH a AS (SELECT d.carrier, a.name AS name, a.fee AS fee, a.months AS months FROM (SELECT DISTINCT id, carrier, addons_detail FROM deals) d, unnest(addons_detail) u(a)),
g AS (SELECT carrier, name, count(*) AS n, round(avg(fee), 3) AS fee, sum(months)::BIGINT AS months FROM a GROUP BY ALL)
SELECT carrier, name, n, fee, months FROM g QUALIFY row_number() OVER (PARTITION BY carrier ORDER BY n DESC, name) <= 2""")
def a12_weighted_items(s: SparkSession, d: str) -> DataFrame:
    a = _t(s, d, "deals").select("id", "carrier", "addons_detail").dropDuplicates(["id"]).select("carrier", F.explode("addons_detail").alias("a"))
    g = a.groupBy("carrier", F.col("a.name").alias("name")).agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("a.fee"), 3).alias("fee"), F.sum("a.months").alias("months"))
    return g.withColumn("r", F.row_number().over(Window.partitionBy("carrier").orderBy(F.desc("n"), "name"))).where("r <= 2").drop("r")


@query("SELECT deal_hash, count(*) AS n FROM deals GROUP BY 1 HAVING count(*) > 1")
def a13_duplicates(s: SparkSession, d: str) -> DataFrame:
    from weftline.operators.checks import duplicates

    return duplicates(_t(s, d, "deals"), ["deal_hash"])


@query("""WITH o AS (SELECT o_orderpriority, o_totalprice, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice) - 1 AS i, count(*) OVER (PARTITION BY o_orderpriority) AS n FROM orders)
SELECT o_orderpriority, max(o_totalprice) FILTER (WHERE i = round_even((n - 1) * 0.5, 0)) AS p50, max(o_totalprice) FILTER (WHERE i = round_even((n - 1) * 0.9, 0)) AS p90 FROM o GROUP BY 1""")
def a14_nearest_rank(s: SparkSession, d: str) -> DataFrame:
    return rel.percentile_nearest(_t(s, d, "orders"), ["o_orderpriority"], "o_totalprice", {"p50": 0.5, "p90": 0.9})


@query("SELECT min(n) AS low, quantile_cont(n, 0.5) AS p50, quantile_cont(n, 0.9) AS p90, max(n) AS high FROM (SELECT addr_key, count(*) AS n FROM dim_company GROUP BY 1)")
def a15_bucket_occupancy(s: SparkSession, d: str) -> DataFrame:
    n = _t(s, d, "dim_company").groupBy("addr_key").agg(F.count(F.lit(1)).alias("n"))
    return n.agg(F.min("n").alias("low"), F.percentile("n", F.lit(0.5)).alias("p50"), F.percentile("n", F.lit(0.9)).alias("p90"), F.max("n").alias("high"))


@query(_LISTS + "SELECT CASE WHEN o.ticker IS NULL THEN 'added' WHEN n.ticker IS NULL THEN 'removed' ELSE 'kept' END AS kind, count(*) AS n FROM n FULL JOIN o ON n.exchange = o.exchange AND n.ticker = o.ticker GROUP BY 1")
def a16_delta_counts(s: SparkSession, d: str) -> DataFrame:
    old, new = _listings(s, d)
    a = rel.diff_outer(new, old, ["exchange", "ticker"], ["name"])
    return a.groupBy(F.when(F.col("action").isin("same", "changed"), "kept").otherwise(F.col("action")).alias("kind")).agg(F.count(F.lit(1)).alias("n"))


@query("""WITH m AS (SELECT company_id, min(company_id) OVER (PARTITION BY canonical_name) AS rollup_id FROM dim_company), a AS (SELECT company_id, count(*) AS aliases FROM (SELECT DISTINCT alias_id, company_id FROM company_alias WHERE company_id IS NOT NULL) GROUP BY 1)
SELECT coalesce(rollup_id, a.company_id) AS rollup_id, sum(aliases)::BIGINT AS aliases FROM a LEFT JOIN m USING (company_id) GROUP BY 1""")
def a17_rollup(s: SparkSession, d: str) -> DataFrame:
    c, al = _t(s, d, "dim_company", "company_alias")
    first = c.groupBy("canonical_name").agg(F.min("company_id").alias("rollup_id"))
    m = c.join(first, "canonical_name").select("company_id", "rollup_id")
    a = al.where("company_id is not null").select("alias_id", "company_id").distinct().withColumn("aliases", F.lit(1))
    return rel.rollup_via(a, m, "company_id", "rollup_id", [], ["aliases"])


@query("SELECT o_orderpriority, count(*) FILTER (WHERE o_orderstatus = 'O') AS queued, count(*) FILTER (WHERE o_orderstatus = 'F') / 15.0 AS per_minute, count(*) FILTER (WHERE o_orderstatus = 'O') / greatest(count(*) FILTER (WHERE o_orderstatus = 'F') / 15.0, 0.0001) AS eta FROM orders GROUP BY 1")
def a18_eta(s: SparkSession, d: str) -> DataFrame:
    return rel.queue_eta(_t(s, d, "orders"), F.col("o_orderstatus") == "O", F.col("o_orderstatus") == "F", 15.0, ["o_orderpriority"])


# ---- ranks and order


@query("SELECT o_orderkey, o_totalprice, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS rank FROM orders")
def n01_global_rank(s: SparkSession, d: str) -> DataFrame:
    return rel.global_rank(_t(s, d, "orders").select("o_orderkey", "o_totalprice"), [F.desc("o_totalprice"), F.col("o_orderkey")])


@query("""WITH l AS (SELECT o_custkey, strftime(o_orderdate, '%Y') AS year, sum(o_totalprice)::DOUBLE AS spend, count(*)::DOUBLE AS orders FROM orders GROUP BY ALL), u AS (UNPIVOT l ON spend, orders INTO NAME metric VALUE value)
SELECT year, o_custkey, metric, round(value, 2) AS value, row_number() OVER (PARTITION BY year, metric ORDER BY round(value, 2) DESC NULLS LAST, o_custkey)::INT AS rank FROM u""")
def n02_metric_ranks(s: SparkSession, d: str) -> DataFrame:
    m = _t(s, d, "orders").groupBy("o_custkey", F.date_format("o_orderdate", "yyyy").alias("year")).agg(F.round(F.sum("o_totalprice"), 2).alias("spend"), F.count(F.lit(1)).cast("double").alias("orders"))
    return rel.rank_metrics(m, "o_custkey", ["spend", "orders"], ["year"])


@query("SELECT c_nationkey, c_custkey, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal, c_custkey)::INT AS rank FROM customer")
def n03_rank_first(s: SparkSession, d: str) -> DataFrame:
    return _t(s, d, "customer").select("c_nationkey", "c_custkey", F.row_number().over(Window.partitionBy("c_nationkey").orderBy("c_acctbal", "c_custkey")).alias("rank"))


@query("SELECT o_custkey, o_orderkey FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) = 1 OR row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1")
def n04_first_and_last(s: SparkSession, d: str) -> DataFrame:
    f = rel.first_last(_t(s, d, "orders"), ["o_custkey"], ["o_orderdate", "o_orderkey"], ["o_orderkey"])
    return f.select("o_custkey", F.explode(F.array_distinct(F.array("first_o_orderkey", "last_o_orderkey"))).alias("o_orderkey"))


@query("SELECT p_brand, p_type, n FROM (SELECT p_brand, p_type, count(*) AS n FROM part GROUP BY ALL) QUALIFY row_number() OVER (PARTITION BY p_brand ORDER BY n DESC, p_type) <= 2")
def n05_top_k(s: SparkSession, d: str) -> DataFrame:
    n = _t(s, d, "part").groupBy("p_brand", "p_type").agg(F.count(F.lit(1)).alias("n"))
    return n.withColumn("r", F.row_number().over(Window.partitionBy("p_brand").orderBy(F.desc("n"), "p_type"))).where("r <= 2").drop("r")


@query("SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_suppkey ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber) <= 8")
def n06_top_members(s: SparkSession, d: str) -> DataFrame:
    w = Window.partitionBy("l_suppkey").orderBy(F.desc("l_extendedprice"), "l_orderkey", "l_linenumber")
    # Spark turns the bound on the row number into a limit per group before the shuffle
    return _t(s, d, "lineitem").select("l_suppkey", "l_orderkey", "l_linenumber", "l_extendedprice").withColumn("r", F.row_number().over(w)).where("r <= 8").select("l_orderkey", "l_linenumber", "l_extendedprice")


@query("SELECT l_partkey, l_suppkey, q FROM (SELECT l_partkey, l_suppkey, sum(l_quantity) AS q FROM lineitem GROUP BY ALL) QUALIFY row_number() OVER (PARTITION BY l_partkey ORDER BY q DESC, l_suppkey) = 1")
def n07_best_candidate(s: SparkSession, d: str) -> DataFrame:
    q = _t(s, d, "lineitem").groupBy("l_partkey", "l_suppkey").agg(F.sum("l_quantity").alias("q")).withColumn("k", -F.col("q"))
    return rel.keep_first(q, ["l_partkey"], ["k", "l_suppkey"]).select("l_partkey", "l_suppkey", "q")


@query("SELECT DISTINCT ON (user_id) user_id, event_id, event_type FROM events ORDER BY user_id, ts DESC, event_id DESC")
def n08_distinct_on(s: SparkSession, d: str) -> DataFrame:
    return rel.latest_by(_t(s, d, "events").select("user_id", "ts", "event_id", "event_type"), ["user_id"], ["ts", "event_id"]).select("user_id", "event_id", "event_type")


@query("WITH u AS (SELECT user_id, count(*) AS n FROM events GROUP BY 1), t AS (SELECT count(*) AS t FROM u) SELECT user_id, n, round((t - (rank() OVER (ORDER BY n DESC) - 1)) / t, 9) AS percentile FROM u, t")
def n09_percentile_rank(s: SparkSession, d: str) -> DataFrame:
    u = _t(s, d, "events").groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    return rel.percentile_desc(u, "n").select("user_id", "n", F.round("percentile", 9).alias("percentile"))


@query("WITH b AS (SELECT max(o_orderdate) AS top FROM orders) SELECT o_orderkey, round(o_totalprice * exp(-greatest(epoch(top) - epoch(o_orderdate), 0) / 3600.0 / 8760), 4) AS score FROM orders, b")
def n10_decay(s: SparkSession, d: str) -> DataFrame:
    o = _t(s, d, "orders").withColumn("at", F.col("o_orderdate").cast("timestamp"))
    as_of = F.lit(o.agg(F.max("at")).first()[0])
    return o.select("o_orderkey", F.round(values.decay(F.col("o_totalprice"), (F.unix_timestamp(as_of) - F.unix_timestamp("at")) / 3600.0, 8760.0), 4).alias("score"))


@query("""WITH p AS (SELECT post_id, md5(coalesce(title, '')) AS h FROM ss_normalized_posts), o AS (SELECT DISTINCT substr(post_id, 1, 7) AS k, h FROM p WHERE right(post_id, 1) < '5'),
ov AS (SELECT k, h, row_number() OVER (PARTITION BY k ORDER BY h) AS version FROM o), n AS (SELECT substr(post_id, 1, 7) AS k, h, min(post_id) AS f FROM p GROUP BY ALL)
SELECT n.k, n.h, (row_number() OVER (PARTITION BY n.k ORDER BY n.f, n.h) + coalesce((SELECT max(version) FROM ov WHERE ov.k = n.k), 0))::INT AS version FROM n LEFT JOIN ov ON n.k = ov.k AND n.h = ov.h WHERE ov.h IS NULL""")
def n11_next_version(s: SparkSession, d: str) -> DataFrame:
    p = _t(s, d, "ss_normalized_posts").select(F.substring("post_id", 1, 7).alias("k"), hashing.md5_key("title").alias("h"), "post_id")
    old = p.where(F.substring("post_id", -1, 1) < "5").select("k", "h").distinct()
    history = old.withColumn("version", F.row_number().over(Window.partitionBy("k").orderBy("h")))
    return rel.next_version(p, history, "k", "h", ["post_id"])


@query("SELECT company_id, alias, (row_number() OVER (PARTITION BY company_id ORDER BY alias) - 1)::INT AS position FROM (SELECT DISTINCT company_id, alias FROM company_alias WHERE company_id IS NOT NULL)")
def n12_position(s: SparkSession, d: str) -> DataFrame:
    a = _t(s, d, "company_alias").where("company_id is not null").select("company_id", "alias").distinct()
    return a.withColumn("position", F.row_number().over(Window.partitionBy("company_id").orderBy("alias")) - 1)


@query("SELECT c_custkey, c_acctbal FROM customer ORDER BY c_acctbal DESC NULLS LAST, c_custkey LIMIT 25")
def n13_top(s: SparkSession, d: str) -> DataFrame:
    return _t(s, d, "customer").select("c_custkey", "c_acctbal").orderBy(F.desc_nulls_last("c_acctbal"), "c_custkey").limit(25)


@query("SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderstatus = 'O' ORDER BY CASE WHEN o_orderpriority LIKE '1%' THEN 0 ELSE 1 END, o_orderdate, o_orderkey LIMIT 33")
def n14_dequeue(s: SparkSession, d: str) -> DataFrame:
    from weftline.operators.state import dequeue

    o = _t(s, d, "orders")
    return dequeue(o, F.col("o_orderstatus") == "O", [F.when(F.col("o_orderpriority").like("1%"), 0).otherwise(1), F.col("o_orderdate"), F.col("o_orderkey")], 33).select("o_orderkey", "o_orderpriority")


@query("SELECT doc_id, n_chars, row_number() OVER (ORDER BY n_chars DESC NULLS LAST, doc_id) AS turn FROM documents")
def n15_schedule(s: SparkSession, d: str) -> DataFrame:
    """Turns of a job that takes the largest items first, so that none is left for the end."""
    docs = _t(s, d, "documents").select("doc_id", "n_chars")
    return rel.before(docs, [], [F.desc_nulls_last("n_chars"), F.col("doc_id")]).select("doc_id", "n_chars", (F.col("before") + 1).alias("turn"))


@query("""WITH RECURSIVE e AS (SELECT doc_id, CASE WHEN thread_id <> doc_id THEN thread_id END AS parent FROM documents), t AS (SELECT doc_id AS node, doc_id AS root, 0 AS depth FROM e WHERE parent IS NULL UNION ALL SELECT e.doc_id, t.root, t.depth + 1 FROM e JOIN t ON e.parent = t.node) SELECT node, root, depth FROM t""")
def n16_tree(s: SparkSession, d: str) -> DataFrame:
    from weftline.operators.trees import build_paths

    e = _t(s, d, "documents").select("doc_id", F.when(F.col("thread_id") != F.col("doc_id"), F.col("thread_id")).alias("parent"))
    return build_paths(e, "doc_id", "parent", "doc_id").select("node", "root", "depth")


# ---- sets


@query("SELECT 'customer' AS kind, c_name AS name FROM customer UNION ALL SELECT 'supplier', s_name FROM supplier")
def e01_union(s: SparkSession, d: str) -> DataFrame:
    c, p = _t(s, d, "customer", "supplier")
    return rel.union_all(c.select(F.lit("customer").alias("kind"), F.col("c_name").alias("name")), p.select(F.lit("supplier").alias("kind"), F.col("s_name").alias("name")))


@query("SELECT o_orderpriority, o_orderdate::DATE::VARCHAR AS day FROM orders WHERE o_orderstatus = 'F' UNION ALL SELECT o_orderpriority, NULL FROM orders WHERE o_orderstatus = 'P'")
def e02_concat(s: SparkSession, d: str) -> DataFrame:
    o = _t(s, d, "orders")
    return rel.union_all(o.where("o_orderstatus = 'F'").select("o_orderpriority", F.date_format("o_orderdate", "yyyy-MM-dd").alias("day")), o.where("o_orderstatus = 'P'").select("o_orderpriority"))


@query("SELECT DISTINCT l_returnflag, l_linestatus FROM lineitem")
def e03_distinct(s: SparkSession, d: str) -> DataFrame:
    return _t(s, d, "lineitem").select("l_returnflag", "l_linestatus").distinct()


@query("SELECT id, company_name, business_reg_num, zip_code FROM pension QUALIFY row_number() OVER (PARTITION BY data_created_ym, company_name, business_reg_num, zip_code, industry_code, subscriber_count ORDER BY id) = 1")
def e04_keep_first(s: SparkSession, d: str) -> DataFrame:
    p = _t(s, d, "pension").select("id", "data_created_ym", "company_name", "business_reg_num", "zip_code", "industry_code", "subscriber_count")
    return rel.keep_first(p, ["data_created_ym", "company_name", "business_reg_num", "zip_code", "industry_code", "subscriber_count"], ["id"]).select("id", "company_name", "business_reg_num", "zip_code")


@query("SELECT post_id, url, min(coalesce(title, '')) AS title FROM ss_normalized_posts GROUP BY ALL")
def e05_keep_first_pair(s: SparkSession, d: str) -> DataFrame:
    p = _t(s, d, "ss_normalized_posts").select("post_id", "url", F.coalesce("title", F.lit("")).alias("title"))
    return rel.keep_first(p, ["post_id", "url"], ["title"])


@query("SELECT min(doc_id) AS doc_id, count(*) AS copies FROM documents GROUP BY md5(coalesce(text, ''))")
def e06_content_hash(s: SparkSession, d: str) -> DataFrame:
    return _t(s, d, "documents").groupBy(hashing.md5_key("text").alias("h")).agg(F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("copies")).drop("h")


@query("SELECT DISTINCT alias FROM company_alias WHERE alias NOT IN (SELECT canonical_name FROM dim_company WHERE canonical_name IS NOT NULL UNION SELECT normalized_name FROM dim_company WHERE normalized_name IS NOT NULL)")
def e07_difference(s: SparkSession, d: str) -> DataFrame:
    a, c = _t(s, d, "company_alias", "dim_company")
    have = c.select(F.explode(F.array("canonical_name", "normalized_name")).alias("alias"))
    return a.select("alias").where("alias is not null").distinct().join(have, "alias", "left_anti")


@query("SELECT exchange, count(DISTINCT date) AS snapshots FROM stockcodename WHERE exchange <> 'STARTUP' GROUP BY 1")
def e08_without(s: SparkSession, d: str) -> DataFrame:
    return _t(s, d, "stockcodename").where("exchange <> 'STARTUP'").groupBy("exchange").agg(F.countDistinct("date").alias("snapshots"))


@query("SELECT name, array_to_string(list_transform(list_sort(list_transform(list_distinct(aliases), lambda x: struct_pack(p := list_position(aliases, x), x := x))), lambda y: y.x)[1:4], '|') AS aliases FROM phone_models")
def e09_unique_capped(s: SparkSession, d: str) -> DataFrame:
    return _t(s, d, "phone_models").select("name", F.array_join(values.unique_capped(F.col("aliases"), 4), "|").alias("aliases"))
