"""Queries of the operators in this package and their SQL, where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.llm import entities, freevalues, leaks, lookalikes, packing, percentiles, quality, variants
from weftline.operators.lineage import cut
from weftline.plans.functions import _MAPS, _mapped
from weftline.sources.tables import table

GROUP = ["model", "capacity", "day"]
CAPACITY = 8192


def _deals(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "deals").select("id", "model", "capacity", F.col("source_posted_at").alias("day"), "upfront")


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    """Rows of aggregates_daily whose median or p25 is off by more than ten points of rank."""
    stored = table(spark, d, "aggregates_daily").select("model", "capacity", F.col("ts").alias("day"), "median", "p25")
    off = percentiles.stored_figures_off(_deals(spark, d), stored, GROUP, "upfront", {"median": 0.50, "p25": 0.25}, tolerance=0.10, row_id="id")
    return off.select("model", "capacity", F.date_format("day", "yyyy-MM-dd").alias("ts"))


def p1_percentiles(spark: SparkSession, d: str) -> DataFrame:
    """Median and 25th percentile of every model, capacity and day, with their certified rank errors."""
    return percentiles.certified_quantiles(_deals(spark, d), GROUP, "upfront", {"median": 0.50, "p25": 0.25}, row_id="id")


def p1_merged(spark: SparkSession, d: str) -> DataFrame:
    """Daily digests merged into one per capacity: separate days combine."""
    daily = percentiles.build_digest(_deals(spark, d), ["capacity", "day"], "upfront", row_id="id")
    return percentiles.quantiles(percentiles.merge_digests(daily, ["capacity"]), ["capacity"], {"p25": 0.25, "median": 0.50, "p75": 0.75, "p99": 0.99})


def p1_lines(spark: SparkSession, d: str) -> DataFrame:
    """Quantiles of all prices by return flag (a handful of groups hold every row), and whether their certified errors keep within bounds."""
    ps = {"p01": 0.01, "p25": 0.25, "median": 0.50, "p99": 0.99}
    q = percentiles.certified_quantiles(table(spark, d, "lineitem"), ["l_returnflag"], "l_extendedprice", ps)
    return q.select("l_returnflag", "n", *[(F.col(f"{p}_error") <= b).alias(f"{p}_ok") for p, b in (("p01", 0.002), ("p25", 0.008), ("median", 0.008), ("p99", 0.002))])


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    """Listed model or carrier meant by each typed value that isn't itself a listed name."""
    lists = {"model": "phone_models", "carrier": "carriers"}
    reference = [table(spark, d, t).select(F.lit(f).alias("field"), "name", F.concat(F.coalesce("aliases", F.array()), F.coalesce("aliases_keyb", F.array())).alias("spellings")) for f, t in lists.items()]
    return freevalues.map_column_values(table(spark, d, "deals"), "id", list(lists), reference[0].unionByName(reference[1]))


def _looks(spark: SparkSession, d: str) -> DataFrame:
    """(field, key, text) of titles and aliases."""
    titles = table(spark, d, "ss_normalized_posts").select(F.lit("ss_normalized_posts.title").alias("field"), F.col("post_id").alias("key"), F.col("title").alias("text"))
    for name in ("phone_models", "carriers"):
        aliases = table(spark, d, name).select(F.lit(f"{name}.aliases").alias("field"), "name", F.posexplode("aliases").alias("at", "text"))
        titles = titles.unionByName(aliases.select("field", F.concat_ws("#", "name", F.col("at").cast("string")).alias("key"), "text"))
    return titles


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of titles, or of aliases, that look the same but differ in their characters."""
    return lookalikes.same_look_pairs(_looks(spark, d), "field", "key", "text")


def p6_canonical(spark: SparkSession, d: str) -> DataFrame:
    """Every title and alias beside its consistent form."""
    return lookalikes.canonical_text(_looks(spark, d).distinct(), ["field", "key"], "text")


def p7_containers(spark: SparkSession, d: str) -> DataFrame:
    """Every document, or piece of an oversized one, in a container of 8,192 byte tokens."""
    return packing.pack(table(spark, d, "documents"), "doc_id", F.octet_length("text"), CAPACITY)


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    """Documents that packing had to split."""
    return p7_containers(spark, d).groupBy("doc_id").agg(F.max("part").alias("part"), F.sum("size").alias("size")).where((F.col("part") > 0) & (F.col("size") > CAPACITY)).select("doc_id")


def p7_verified(spark: SparkSession, d: str) -> DataFrame:
    """What p7_containers holds: documents, pieces, bytes, faults of each kind, and whether it needs at most one per cent and one more containers than the total size."""
    c = cut(p7_containers(spark, d))
    fill = c.groupBy("container").agg(F.sum("size").alias("fill")).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("fill") > CAPACITY).alias("overfull"), F.sum("fill").alias("bytes"))
    docs = c.groupBy("doc_id").agg(F.count(F.lit(1)).alias("pieces"), F.sum("size").alias("size"), F.max(F.col("start") + F.col("size")).alias("end"))
    docs = docs.agg(F.count(F.lit(1)).alias("documents"), F.sum("pieces").alias("pieces"), F.count_if((F.col("pieces") > 1) & (F.col("size") <= CAPACITY)).alias("split"), F.count_if(F.col("end") != F.col("size")).alias("gaps"))
    return docs.crossJoin(fill).select("documents", "pieces", "bytes", "overfull", "split", "gaps", (F.col("n") <= F.ceil(F.col("bytes") / CAPACITY) * 1.01 + 1).alias("tight"))


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    """Documents and the test items they share a run of at least 60 letters and digits with."""
    return leaks.leaked_items(table(spark, d, "documents"), "doc_id", "text", table(spark, d, "benchmark"), "item_id", "text")


def p8_items(spark: SparkSession, d: str) -> DataFrame:
    """Leaked test items and the number of documents that hold them."""
    return p8_found(spark, d).groupBy("item_id").agg(F.count("doc_id").alias("documents"))


def p9_shares(spark: SparkSession, d: str) -> DataFrame:
    """Shares of every document's characters in lines of prose, lists, tables and junk."""
    return quality.line_shares(table(spark, d, "documents"), "doc_id", "text", table(spark, d, "common_words"))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    """Documents more than half of whose characters aren't natural prose."""
    return p9_shares(spark, d).where("prose < 0.5").select("doc_id").distinct()


def p9_statistics(spark: SparkSession, d: str) -> DataFrame:
    return quality.statistics(table(spark, d, "documents"), "doc_id", "text", table(spark, d, "common_words"))


def p5_linked(spark: SparkSession, d: str) -> DataFrame:
    """The established name that every alias stands for."""
    aliases = table(spark, d, "company_alias")
    return variants.link_variants(aliases, "alias_id", ["alias", "normalized_alias", "alias_canonical"], table(spark, d, "dim_company"), "canonical_name", "company_id", "company_id")


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    """All pairs of aliases that name the same organisation."""
    return variants.variant_pairs(p5_linked(spark, d), "alias_id")


def p3_matches(spark: SparkSession, d: str) -> DataFrame:
    """The workplace that every pension record describes, with a confidence."""
    p, c = table(spark, d, "pension"), table(spark, d, "dim_company")
    records = p.select(
        F.col("id").alias("raw_id"), F.col("company_name").alias("name"), F.col("business_reg_num").alias("number"), F.col("addr_sido_code").alias("sido"), F.col("addr_sigungu_code").alias("sigungu"),
        F.col("legal_dong_addr_code").alias("dong"), F.col("addr_emdong_code").alias("emdong"), F.col("industry_code").alias("industry"), F.nullif(F.regexp_extract("lot_number_address", r"([0-9]+(?:-[0-9]+)?)\s*$", 1), F.lit("")).alias("lot"),
    )
    companies = c.select("company_id", F.col("canonical_name").alias("name"), F.col("business_reg_num").alias("number"), F.split_part("addr_key", F.lit("-"), F.lit(1)).alias("sigungu"), F.split_part("addr_key", F.lit("-"), F.lit(2)).alias("dong"), F.col("industry_code").alias("industry"))
    return entities.match_entities(records, companies)


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return p3_matches(spark, d).select("company_id", "raw_id").distinct()


QUERIES = {
    "p1_found": p1_found,
    "p1_percentiles": p1_percentiles,
    "p1_merged": p1_merged,
    "p1_lines": p1_lines,
    "p3_found": p3_found,
    "p3_matches": p3_matches,
    "p4_found": p4_found,
    "p5_found": p5_found,
    "p5_linked": p5_linked,
    "p6_found": p6_found,
    "p6_canonical": p6_canonical,
    "p7_found": p7_found,
    "p7_containers": p7_containers,
    "p7_verified": p7_verified,
    "p8_found": p8_found,
    "p8_items": p8_items,
    "p9_found": p9_found,
    "p9_shares": p9_shares,
    "p9_statistics": p9_statistics,
}



def letters_sql(c: str) -> str:
    """Letters and digits of a column in NFKC and lower case, beside a row of ``_MAPS``."""
    return f"regexp_replace(lower(nfc_normalize({_mapped(c, 'compatible')})), '[^\\p{{L}}\\p{{N}}]', '', 'g')"


SQL = {
    "p9_statistics": r"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, t, list_filter(regexp_split_to_array(t, '[ \t\r\n]+'), lambda x: x <> '') AS w, list_filter(string_split(t, chr(10)), lambda x: trim(regexp_replace(x, '[\t\r]', '', 'g')) <> '') AS l FROM t),
c AS (SELECT list(DISTINCT lower(trim(word))) AS c FROM common_words)
SELECT doc_id, len(w)::INT AS words,
  CASE WHEN len(w) > 0 THEN round(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) / len(w), 6) END AS mean_word_length,
  CASE WHEN length(t) > 0 THEN round(length(regexp_replace(t, '[^!-/:-@\[-`{-~]', '', 'g')) / length(t), 6) END AS symbol_ratio,
  CASE WHEN len(l) > 0 THEN round(len(list_filter(l, lambda x: regexp_matches(x, '[.!?][ \t\r]*$'))) / len(l), 6) END AS closed_lines,
  CASE WHEN len(w) > 0 THEN round(len(list_filter(w, lambda x: list_contains(c, lower(regexp_replace(x, '^[!-/:-@\[-`{-~]+|[!-/:-@\[-`{-~]+$', '', 'g'))))) / len(w), 6) END AS common_share
FROM w, c
""".replace("\\\\", "\\"),
    "p1_lines": "SELECT l_returnflag, count(l_extendedprice) AS n, true AS p01_ok, true AS p25_ok, true AS median_ok, true AS p99_ok FROM lineitem GROUP BY 1",
    "p8_found": f"""
WITH {_MAPS}, i AS (SELECT item_id, {letters_sql('text')} AS s FROM benchmark, m WHERE text IS NOT NULL), w AS MATERIALIZED (SELECT DISTINCT item_id, unnest(list_transform(range(1, length(s) - 58), lambda k: substr(s, k, 60))) AS w FROM i WHERE length(s) >= 60),
d AS (SELECT doc_id, {letters_sql('text')} AS s FROM documents, m WHERE text IS NOT NULL), v AS (SELECT doc_id, unnest(list_transform(range(1, length(s) - 58), lambda k: substr(s, k, 60))) AS w FROM d WHERE length(s) >= 60)
SELECT DISTINCT doc_id, item_id FROM v JOIN w USING (w)
""",
    "p7_verified": "SELECT count(*) AS documents, sum(CASE WHEN n > 8192 THEN (n + 8191) // 8192 ELSE 1 END)::BIGINT AS pieces, sum(n)::BIGINT AS bytes, 0::BIGINT AS overfull, 0::BIGINT AS split, 0::BIGINT AS gaps, true AS tight FROM (SELECT doc_id, coalesce(max(strlen(text)), 0) AS n FROM documents GROUP BY 1)",
    "p7_found": "SELECT DISTINCT doc_id FROM documents WHERE strlen(text) > 8192",
    "p1_found": """
WITH v AS (SELECT id, any_value(model) AS model, any_value(capacity) AS capacity, any_value(source_posted_at) AS ts, min(upfront) AS u FROM deals GROUP BY id),
f AS (SELECT DISTINCT model, capacity, ts, unnest([0.5, 0.25]) AS p, unnest([median, p25]) AS x FROM aggregates_daily),
c AS (SELECT f.model, f.capacity, f.ts, p, x, count(*) AS n, count(*) FILTER (WHERE u < x) AS below, count(*) FILTER (WHERE u <= x) AS upto
  FROM f JOIN v USING (model, capacity, ts) WHERE x IS NOT NULL AND u IS NOT NULL GROUP BY ALL)
SELECT DISTINCT model, capacity, strftime(ts, '%Y-%m-%d') AS ts FROM c WHERE below > (p + 0.1::DOUBLE) * n OR upto < (p - 0.1::DOUBLE) * n
""",
}
