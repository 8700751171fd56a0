"""Queries of scalar functions over whole tables."""

from __future__ import annotations

import unicodedata

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.functions import hashing, names, text, values
from weftline.operators import pairs
from weftline.operators.lineage import cut, spread
from weftline.plans.relational import _TRIGRAMS
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


_TOKENS = "list_filter(regexp_split_to_array(trim(regexp_replace(regexp_replace(lower({0}), 'https?://[^ \\t\\r\\n]+', ' ', 'g'), '[^0-9a-z가-힣]+', ' ', 'g')), ' +'), lambda w: length(w) >= 2)"
_SHINGLES = "CASE WHEN len(t) >= 5 THEN list_transform(range(1, len(t) - 3), lambda i: array_to_string(t[i:i+4], ' ')) ELSE t END"


@query(f"SELECT doc_id, len({_TOKENS.format('text')}) AS n, md5(array_to_string({_TOKENS.format('text')}, ' ')) AS tokens FROM documents WHERE text IS NOT NULL")
def f01_tokens(s: SparkSession, d: str) -> DataFrame:
    t = text.tokens(F.col("text"))
    return table(s, d, "documents").where("text is not null").select("doc_id", t.alias("t")).select("doc_id", F.size("t").cast("long").alias("n"), F.md5(F.array_join("t", " ")).alias("tokens"))


@query(f"WITH t AS (SELECT doc_id, {_TOKENS.format('text')} AS t FROM documents WHERE text IS NOT NULL) SELECT doc_id, len({_SHINGLES}) AS n, md5(array_to_string({_SHINGLES}, '|')) AS shingles FROM t")
def f02_shingles(s: SparkSession, d: str) -> DataFrame:
    t = table(s, d, "documents").where("text is not null").select("doc_id", text.tokens(F.col("text")).alias("t")).select("doc_id", text.shingles(F.col("t")).alias("g"))
    return t.select("doc_id", F.size("g").cast("long").alias("n"), F.md5(F.array_join("g", "|")).alias("shingles"))


@query("SELECT doc_id, ('0x' || substr(md5('7|' || text), 1, 15))::BIGINT AS hash FROM documents WHERE text IS NOT NULL")
def f03_hash60(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "documents").where("text is not null").select("doc_id", hashing.hash60(F.col("text"), 7).alias("hash"))


@query("""WITH w AS (SELECT p_partkey, list_filter(string_split(lower(p_name), ' '), lambda x: x <> '') AS w FROM part), h AS (SELECT p_partkey, len(w) AS n, unnest(list_transform(w, lambda x: ('0x' || substr(md5('0|' || x), 1, 15))::BIGINT)) AS h FROM w),
b AS (SELECT p_partkey, i, sum((h >> i) & 1) AS c, max(n) AS n FROM h, range(0, 60) r(i) GROUP BY p_partkey, i) SELECT p_partkey, sum(CASE WHEN 2 * c > n THEN (1::BIGINT << i) ELSE 0 END)::BIGINT AS simhash FROM b GROUP BY 1""")
def f04_simhash(s: SparkSession, d: str) -> DataFrame:
    w = F.filter(F.split(F.lower("p_name"), " "), lambda x: x != "")
    return table(s, d, "part").select("p_partkey", hashing.simhash60(w).alias("simhash"))


_PERMS = ", ".join(f"({i}, {a}, {b})" for i, (a, b) in enumerate(map(hashing.permutation, range(16))))


@query(f"""WITH t AS (SELECT p_partkey, {_TRIGRAMS.format('p_name')} AS g FROM part), h AS (SELECT p_partkey, ('0x' || substr(md5(x), 1, 7))::BIGINT AS h FROM (SELECT p_partkey, unnest(g) AS x FROM t)),
m AS (SELECT p_partkey, i, min((h * a + b) % {hashing.PRIME}) AS v FROM h, (VALUES {_PERMS}) p(i, a, b) GROUP BY ALL) SELECT p_partkey, string_agg(v, ',' ORDER BY i) AS sketch FROM m GROUP BY 1""")
def f05_minhash(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "part").select("p_partkey", F.array_join(hashing.minhash(hashing.trigrams(F.col("p_name")), 16), ",").alias("sketch"))


@query(f"""WITH t AS (SELECT p_partkey, {_TRIGRAMS.format('p_name')} AS g FROM part), h AS (SELECT p_partkey, ('0x' || substr(md5(x), 1, 7))::BIGINT AS h FROM (SELECT p_partkey, unnest(g) AS x FROM t)),
m AS (SELECT p_partkey, i, min((h * a + b) % {hashing.PRIME}) AS v FROM h, (VALUES {_PERMS}) p(i, a, b) GROUP BY ALL)
SELECT a.p_partkey, count(*) FILTER (WHERE a.v = b.v) / 16.0 AS similarity FROM m a JOIN m b ON b.p_partkey = 1 AND a.i = b.i GROUP BY 1""")
def f06_sketch_jaccard(s: SparkSession, d: str) -> DataFrame:
    m = table(s, d, "part").select("p_partkey", hashing.minhash(hashing.trigrams(F.col("p_name")), 16).alias("m"))
    one = m.where("p_partkey = 1").select(F.col("m").alias("one"))
    return m.crossJoin(F.broadcast(one)).select("p_partkey", hashing.sketch_jaccard(F.col("m"), F.col("one")).alias("similarity"))


def _shingled(s: SparkSession, d: str) -> DataFrame:
    docs = spread(table(s, d, "documents").where("text is not null").select("doc_id", "text"), "doc_id")
    # tokens are written first: within the lambda of shingles they would be made again for every run
    return cut(docs.select("doc_id", text.tokens(F.col("text")).alias("t"))).select("doc_id", text.shingles(F.col("t")).alias("g"))


_SIM60 = "SELECT doc_id, sum(CASE WHEN 2 * c > n THEN (1::BIGINT << i) ELSE 0 END)::BIGINT AS s FROM (SELECT doc_id, i, sum((h >> i) & 1) AS c, max(n) AS n FROM h, range(0, 60) r(i) GROUP BY doc_id, i) GROUP BY 1"


@query(f"""WITH t AS (SELECT doc_id, {_TOKENS.format('text')} AS t FROM documents WHERE text IS NOT NULL), h AS (SELECT doc_id, len(t) AS n, unnest(list_transform(t, lambda x: ('0x' || substr(md5('0|' || x), 1, 15))::BIGINT)) AS h FROM t), s AS ({_SIM60}) SELECT doc_id, coalesce(s, 0) AS simhash FROM t LEFT JOIN s USING (doc_id)""")
def f04_simhash_documents(s: SparkSession, d: str) -> DataFrame:
    docs = spread(table(s, d, "documents").where("text is not null").select("doc_id", "text"), "doc_id")
    return hashing.add_simhash(docs, text.tokens(F.col("text")), "simhash").select("doc_id", "simhash")


@query(f"""WITH t AS (SELECT doc_id, {_TOKENS.format('text')} AS t FROM documents WHERE text IS NOT NULL), h AS (SELECT doc_id, ('0x' || substr(x, 1, 8))::BIGINT AS a, ('0x' || substr(x, 9, 8))::BIGINT AS b FROM (SELECT doc_id, md5('0|' || unnest(t)) AS x FROM t)),
c AS (SELECT doc_id, i, 2 * sum((a >> i) & 1) > count(*) AS hi, 2 * sum((b >> i) & 1) > count(*) AS lo FROM h, range(0, 32) r(i) GROUP BY ALL), s AS (SELECT doc_id, sum(CASE WHEN hi THEN 1::BIGINT << i ELSE 0 END)::BIGINT AS hi, sum(CASE WHEN lo THEN 1::BIGINT << i ELSE 0 END)::BIGINT AS lo FROM c GROUP BY 1)
SELECT t.doc_id, lpad(lower(to_hex(coalesce(hi, 0))), 8, '0') || lpad(lower(to_hex(coalesce(lo, 0))), 8, '0') AS simhash FROM t LEFT JOIN s USING (doc_id)""")
def f04_simhash64_documents(s: SparkSession, d: str) -> DataFrame:
    docs = spread(table(s, d, "documents").where("text is not null").select("doc_id", "text"), "doc_id")
    return docs.select("doc_id", hashing.simhash64(text.tokens(F.col("text"))).alias("simhash"))


@query()
def f03_blake2b(s: SparkSession, d: str) -> DataFrame:
    """64 bits of keyed BLAKE2b of every document; no SQL engine has it, tests compare it with the library's."""
    docs = spread(table(s, d, "documents").where("text is not null").select("doc_id", "text"), "doc_id")
    return docs.select("doc_id", hashing.hash64(F.col("text"), 7, "blake2b").alias("hash"))


_PERMS128 = ", ".join(f"({i}, {a}, {b})" for i, (a, b) in enumerate(map(hashing.permutation, range(128))))
_SKETCHED = f"""WITH t AS MATERIALIZED (SELECT doc_id, {_TOKENS.format('text')} AS t FROM documents WHERE text IS NOT NULL), h AS MATERIALIZED (SELECT doc_id, ('0x' || substr(md5(x), 1, 7))::BIGINT AS h FROM (SELECT doc_id, unnest(list_distinct({_SHINGLES})) AS x FROM t)),
m AS MATERIALIZED (SELECT doc_id, i, min((h * a + b) % {hashing.PRIME}) AS v FROM h, (VALUES {_PERMS128}) p(i, a, b) GROUP BY ALL) """


@query(_SKETCHED + "SELECT t.doc_id, string_agg(v, ',' ORDER BY i) AS sketch FROM t LEFT JOIN m USING (doc_id) GROUP BY 1")
def f05_minhash_documents(s: SparkSession, d: str) -> DataFrame:
    return hashing.add_minhash(_shingled(s, d), F.col("g"), "m").select("doc_id", F.array_join("m", ",").alias("sketch"))


@query(_SKETCHED + ", e AS (SELECT q.doc_id AS query, r.doc_id, count(*) / 128 AS s FROM m q JOIN m r ON q.i = r.i AND q.v = r.v WHERE q.doc_id % 100 = 0 GROUP BY ALL) SELECT q.doc_id AS query, r.doc_id, coalesce(s, 0) AS similarity FROM t q JOIN t r ON q.doc_id % 100 = 0 LEFT JOIN e ON e.query = q.doc_id AND e.doc_id = r.doc_id")
def f06_sketch_jaccard_documents(s: SparkSession, d: str) -> DataFrame:
    """Every document with an id divisible by 100 against all."""
    m = cut(hashing.add_minhash(_shingled(s, d), F.col("g"), "m").select(F.col("doc_id").cast("long").alias("doc_id"), "m"))
    return pairs.sketch_similarities(m.where("doc_id % 100 = 0"), m, "doc_id", "m")


@query("SELECT post_id, url, CASE WHEN regexp_matches(url, '^[a-zA-Z]+://') THEN lower(regexp_extract(url, '^[a-zA-Z]+://([^/?#]+)', 1)) || '/' || list_last(string_split(regexp_extract(url, '^[a-zA-Z]+://[^/?#]+([^?#]*)', 1), '/')) ELSE url END AS token FROM (SELECT DISTINCT post_id, url FROM ss_normalized_posts)")
def f09_image_token(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "ss_normalized_posts").select("post_id", "url").distinct().select("post_id", "url", text.image_token(F.col("url")).alias("token"))


@query("SELECT DISTINCT post_id, 'em:' || lower(regexp_extract(url, '^[a-zA-Z]+://([^/?#]+)', 1)) AS token FROM ss_normalized_posts")
def f10_embed_token(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "ss_normalized_posts").select("post_id", text.embed_token(F.col("url"), F.lit(None).cast("string")).alias("token")).distinct()


@query("WITH u AS (SELECT url FROM deals UNION ALL SELECT url || '.JPG?w=1' FROM deals WHERE id % 3 = 0 UNION ALL SELECT url || '/pngs' FROM deals) SELECT regexp_matches(lower(url), '\\.(png|jpe?g|gif|webp|bmp|svg)(\\?.*)?$') AS image, count(DISTINCT url) AS n FROM u WHERE url IS NOT NULL GROUP BY 1")
def f11_image_url(s: SparkSession, d: str) -> DataFrame:
    """Addresses of deals, a third also as those of images, and some that only look like it."""
    u = table(s, d, "deals").select("id", "url").where("url is not null")
    u = u.select("url").unionByName(u.where("id % 3 = 0").select(F.concat("url", F.lit(".JPG?w=1")).alias("url"))).unionByName(u.select(F.concat("url", F.lit("/pngs")).alias("url")))
    return u.distinct().groupBy(text.is_image_url(F.col("url")).alias("image")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT DISTINCT post_id, md5(coalesce(title, '') || '|' || coalesce(city, '') || '|' || coalesce(payment, '')) AS rev FROM ss_normalized_posts")
def f12_md5_key(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "ss_normalized_posts").select("post_id", hashing.md5_key("title", "city", "payment").alias("rev")).distinct()


@query("SELECT name, to_json(list_sort(aliases_keyb))::VARCHAR AS aliases FROM phone_models")
def f13_sorted_json(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "phone_models").select("name", values.sorted_json(F.col("aliases_keyb")).alias("aliases"))


def _literal(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


#: NFKC and case folding in SQL: compatibility forms and folded letters one by one, from Unicode's data; composition by nfc_normalize.
_COMPATIBLE = {ch: d for c in range(0xA0, 0x110000) if not 0xAC00 <= c <= 0xD7A3 and not 0xD800 <= c <= 0xDFFF for ch in [chr(c)] if (d := unicodedata.normalize("NFKD", ch)) != unicodedata.normalize("NFD", ch)}
_FOLDED = {ch: d for c in range(0x80, 0x20000) if not 0xD800 <= c <= 0xDFFF for ch in [chr(c)] if (d := ch.casefold()) != ch}


def _mapped(c: str, m: str) -> str:
    return f"array_to_string(list_transform(regexp_extract_all({c}, '(?s).'), lambda ch: coalesce({m}[ch], ch)), '')"


_MAPS = "m AS MATERIALIZED (SELECT " + ", ".join("MAP {" + ", ".join(f"{_literal(k)}: {_literal(v)}" for k, v in m.items()) + f"}} AS {n}" for n, m in (("compatible", _COMPATIBLE), ("folded", _FOLDED))) + ")"


def key_a_sql(c: str) -> str:
    """Key-A of a column, beside a row of ``_MAPS``."""
    folded = _mapped(f"lower(nfc_normalize({_mapped(c, 'compatible')}))", "folded")
    return f"trim(regexp_replace(regexp_replace({folded}, '[^0-9a-z가-힣+ ]', ' ', 'g'), ' +', ' ', 'g'))"


_WIDE, _HALF = "".join(map(chr, range(0xFF01, 0xFF5F))) + "　", ("".join(map(chr, range(0x21, 0x7F))) + " ").replace("'", "''")


@query(f"WITH {_MAPS}, v AS (SELECT DISTINCT model AS v FROM deals WHERE model IS NOT NULL), k AS (SELECT v, {key_a_sql('v')} AS k FROM v, m) SELECT v AS model, k AS key_a, replace(k, ' ', '') AS key_b FROM k")
def f14_keys(s: SparkSession, d: str) -> DataFrame:
    m = table(s, d, "deals").select("model").where("model is not null").distinct()
    return m.select("model", text.key_a(F.col("model")).alias("key_a"), text.key_b(F.col("model")).alias("key_b"))


@query("SELECT doc_id, md5(trim(regexp_replace(replace(replace(replace(replace(replace(regexp_replace(text, '<[^<>]*>', ' ', 'gs'), '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&amp;', '&'), '[ \\t\\r\\n\\x{A0}]+', ' ', 'g'))) AS plain FROM documents WHERE text IS NOT NULL")
def f15_strip_html(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "documents").where("text is not null").select("doc_id", F.md5(text.strip_html(F.col("text"))).alias("plain"))


@query("SELECT DISTINCT url, lower(regexp_extract(url, '^[a-zA-Z]+://([^/?#]+)', 1)) || regexp_extract(url, '^[a-zA-Z]+://[^/?#]+([^?#]*)', 1) AS norm FROM deals WHERE url IS NOT NULL")
def f17_norm_url(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "deals").select("url").where("url is not null").distinct().select("url", text.norm_url(F.col("url")).alias("norm"))


@query("""SELECT post_id, x.i::INT AS "at", x.u AS url FROM (SELECT DISTINCT post_id, unnest([{i: 0, u: 'https://deal-board.example/a/' || post_id || '.png'}, {i: 1, u: 'https://cdn.example/' || post_id || '-2x.png'}, {i: 2, u: 'https://deal-board.example/r/' || post_id || '.webp'}]) AS x FROM ss_normalized_posts)""")
def f18_abs_url(s: SparkSession, d: str) -> DataFrame:
    """Addresses of a set of sources, made absolute, each once, in order of first occurrence."""
    srcset = F.concat("post_id", F.lit(".png 1x, //cdn.example/"), "post_id", F.lit("-2x.png 2x , /r/"), "post_id", F.lit(".webp 640w,"), "post_id", F.lit(".png 3x"))
    urls = text.abs_urls(F.lit("https://deal-board.example/a/list?x=1"), text.srcset(srcset))
    return table(s, d, "ss_normalized_posts").select("post_id").distinct().select("post_id", F.posexplode(urls).alias("at", "url"))


@query("SELECT event_id, strftime(ts + INTERVAL 9 HOUR, '%Y-%m-%d') AS day FROM events")
def f43_kst_day(s: SparkSession, d: str) -> DataFrame:
    iso = F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return table(s, d, "events").select("event_id", F.date_format(text.utc_iso_to_kst_date(iso), "yyyy-MM-dd").alias("day"))


@query("""WITH e AS (SELECT event_id, event_id % 8 AS k, ts, TIMESTAMP '2024-02-01 00:00:00' AS now, ts + INTERVAL 9 HOUR AS kst FROM events)
SELECT event_id, strftime(CASE k WHEN 0 THEN date_trunc('minute', ts) WHEN 1 THEN now - to_minutes(event_id % 50) WHEN 2 THEN now - to_hours(event_id % 20) WHEN 3 THEN now - to_minutes(event_id % 300) WHEN 4 THEN DATE '2024-02-01' + (date_trunc('minute', kst) - date_trunc('day', kst)) - INTERVAL 9 HOUR WHEN 5 THEN date_trunc('minute', ts) WHEN 6 THEN date_trunc('day', kst) - INTERVAL 9 HOUR ELSE date_trunc('second', ts) END, '%Y-%m-%d %H:%M:%S') AS utc FROM e""")
def f20_kst_to_utc(s: SparkSession, d: str) -> DataFrame:
    """Every format that boards write, by turns."""
    kst, n = F.from_utc_timestamp(F.col("ts").cast("timestamp"), "Asia/Seoul"), F.col("event_id")
    forms = [F.date_format(kst, "yy.MM.dd HH:mm"), F.concat((n % 50).cast("string"), F.lit("분 전")), F.concat((n % 20).cast("string"), F.lit("시간 전")), (n % 300).cast("string"), F.date_format(kst, "HH:mm"), F.date_format(kst, "MM.dd HH:mm"), F.date_format(kst, "yyyy-MM-dd"), F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss'Z'")]
    board = F.get(F.array(*forms), (n % 8).cast("int"))
    return table(s, d, "events").select("event_id", F.date_format(text.kst_to_utc(board, F.lit("2024-02-01 00:00:00").cast("timestamp")), "yyyy-MM-dd HH:mm:ss").alias("utc"))


@query("SELECT doc_id FROM documents WHERE regexp_matches(regexp_replace(text, '[ \\t\\r\\n\\x{A0}]', '', 'g'), '비오는날|물었다|thelasttwo')")
def f21_restricted(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "documents").where(text.restricted(F.col("text"), ["비오는날", "물었다", "thelasttwo"])).select("doc_id")


@query("""SELECT name, CASE WHEN regexp_matches(name, '스팩') THEN 'SPAC' WHEN regexp_matches(name, '리츠') THEN 'REIT' WHEN regexp_matches(name, '(펀드|투자회사)$') THEN 'fund' WHEN regexp_matches(name, '우[A-Z]?\\(전환\\)$') THEN 'convertible preferred' WHEN regexp_matches(name, '[0-9]*우[A-Z]?$') THEN 'preferred' ELSE 'common' END AS kind FROM (SELECT DISTINCT name FROM stockcodename WHERE name IS NOT NULL)""")
def f22_security_type(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "stockcodename").select("name").where("name is not null").distinct().select("name", names.security_type(F.col("name")).alias("kind"))


@query("""SELECT name, CASE WHEN regexp_matches(name, '스팩|리츠') OR regexp_extract(name, '^(.+?)[0-9]*우[A-Za-z]*(?:\\(전환\\))?$', 1) = '' THEN name ELSE regexp_extract(name, '^(.+?)[0-9]*우[A-Za-z]*(?:\\(전환\\))?$', 1) END AS issuer FROM (SELECT DISTINCT name FROM stockcodename WHERE name IS NOT NULL)""")
def f23_base_name(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "stockcodename").select("name").where("name is not null").distinct().select("name", names.company_base_name(F.col("name")).alias("issuer"))


@query("WITH m AS (SELECT MAP {" + ", ".join(f"'{k}': '{v}'" for k, v in names.LETTERS.items()) + "} AS m) SELECT name, array_to_string(list_transform(string_split(upper(name), ''), lambda c: coalesce(m[c], c)), '') AS reading FROM (SELECT DISTINCT name FROM stockcodename WHERE regexp_matches(name, '[A-Za-z&]')), m")
def f24_letters(s: SparkSession, d: str) -> DataFrame:
    n = table(s, d, "stockcodename").select("name").where(F.col("name").rlike("[A-Za-z&]")).distinct()
    return n.select("name", names.letters_to_hangul(F.col("name")).alias("reading"))


def _list(keys: list[str]) -> str:
    return "[" + ", ".join(f"'{k}'" for k in keys) + "]"


@query(f"""SELECT name, array_to_string(list_transform(string_split(name, ''), lambda c: CASE WHEN unicode(c) BETWEEN 44032 AND 55203 THEN {_list(names.hangul.INITIAL_KEYS)}[(unicode(c) - 44032) // 588 + 1] || {_list(names.hangul.VOWEL_KEYS)}[(unicode(c) - 44032) % 588 // 28 + 1] || {_list(names.hangul.FINAL_KEYS)}[(unicode(c) - 44032) % 28 + 1] ELSE c END), '') AS typed FROM (SELECT DISTINCT canonical_name AS name FROM dim_company)""")
def f25_keyboard(s: SparkSession, d: str) -> DataFrame:
    n = table(s, d, "dim_company").select(F.col("canonical_name").alias("name")).distinct()
    return n.select("name", names.hangul_to_keys(F.col("name")).alias("typed"))


@query("SELECT DISTINCT ticker, CASE WHEN length(ticker) >= 6 THEN ticker ELSE lpad(ticker, 6, '0') END AS code FROM stockcodename")
def f26_pad_ticker(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "stockcodename").select("ticker").distinct().select("ticker", names.pad_ticker(F.col("ticker")).alias("code"))


_LEGAL = f"regexp_replace({{0}}, '{names.LEGAL_PATTERN}', ' \\1', 'g')"


def _width(c: str) -> str:
    return f"translate(regexp_replace(translate({c}, '{_WIDE}', '{_HALF}'), '[\\x{{0300}}-\\x{{036F}}]', '', 'g'), '{''.join(names.ACCENTED)}', '{''.join(names.ACCENTED.values())}')"



def normalized_sql(c: str) -> str:
    return f"regexp_replace(regexp_replace({_LEGAL.format('lower(' + _width(c) + ')')}, '\\([^()]*\\)', ' ', 'g'), '[^0-9a-z가-힣]', '', 'g')"


@query(f"SELECT company_name, {normalized_sql('company_name')} AS normalized FROM (SELECT DISTINCT company_name FROM pension WHERE company_name IS NOT NULL)")
def f27_normalize(s: SparkSession, d: str) -> DataFrame:
    n = table(s, d, "pension").select("company_name").where("company_name is not null").distinct()
    return n.select("company_name", names.normalize_company(F.col("company_name")).alias("normalized"))


@query(f"SELECT company_name, nullif(trim(regexp_replace(trim(regexp_replace(regexp_replace({_LEGAL.format(_width('company_name'))}, '\\([^()]*\\)', ' ', 'g'), '[ \\t\\r\\n]+', ' ', 'g')), ' +{names.BRANCH}', '')), '') AS canonical FROM (SELECT DISTINCT company_name FROM pension WHERE company_name IS NOT NULL)")
def f28_canonicalize(s: SparkSession, d: str) -> DataFrame:
    n = table(s, d, "pension").select("company_name").where("company_name is not null").distinct()
    return n.select("company_name", names.canonicalize_company(F.col("company_name")).alias("canonical"))


_FORMS = "list_filter([" + ", ".join(f"CASE WHEN contains(company_name, '{k}') THEN '{v}' END" for k, v in [*((f, f) for f in names.LEGAL_FORMS), *names.LEGAL_SHORT.items()]) + "], lambda x: x IS NOT NULL)"


@query(f"SELECT company_name, nullif(array_to_string(list_sort(list_distinct({_FORMS})), ','), '') AS types FROM (SELECT DISTINCT company_name FROM pension WHERE company_name IS NOT NULL)")
def f29_company_types(s: SparkSession, d: str) -> DataFrame:
    n = table(s, d, "pension").select("company_name").where("company_name is not null").distinct()
    return n.select("company_name", F.array_join(names.company_types(F.col("company_name")), ",").alias("types"))


_SIM = "len(list_intersect({0}, {1})) / (len({0}) + len({1}) - len(list_intersect({0}, {1})))"


@query(f"WITH g AS (SELECT a.alias_id, {_TRIGRAMS.format('a.alias')} AS x, {_TRIGRAMS.format('c.canonical_name')} AS y FROM (SELECT DISTINCT alias_id, alias, company_id FROM company_alias) a JOIN dim_company c USING (company_id)) SELECT alias_id, round(CASE WHEN len(x) + len(y) > 0 THEN {_SIM.format('x', 'y')} ELSE 0 END, 6) AS similarity FROM g")
def f30_trigram_similarity(s: SparkSession, d: str) -> DataFrame:
    a = table(s, d, "company_alias").select("alias_id", "alias", "company_id").distinct().join(table(s, d, "dim_company").select("company_id", "canonical_name"), "company_id")
    return a.select("alias_id", F.round(hashing.trigram_similarity(F.col("alias"), F.col("canonical_name")), 6).alias("similarity"))


@query("SELECT id, concat_ws('-', addr_sigungu_code, legal_dong_addr_code) AS addr_key, split_part(concat_ws('-', addr_sigungu_code, legal_dong_addr_code), '-', 1) AS head FROM pension")
def f31_addr_key(s: SparkSession, d: str) -> DataFrame:
    k = names.addr_key(F.col("addr_sigungu_code"), F.col("legal_dong_addr_code"))
    return table(s, d, "pension").select("id", k.alias("addr_key"), F.split_part(k, F.lit("-"), F.lit(1)).alias("head"))


@query(f"""WITH g AS (SELECT p.id, c.company_id, p.business_reg_num = c.business_reg_num AS exact, p.industry_code = c.industry_code AS ind, p.addr_sigungu_code || '-' || p.legal_dong_addr_code = c.addr_key AS addr, {_TRIGRAMS.format('p.company_name')} AS x, {_TRIGRAMS.format('c.canonical_name')} AS y
FROM pension p JOIN dim_company c ON p.business_reg_num = c.business_reg_num), s AS (SELECT id, company_id, coalesce(ind, false)::INT AS i, coalesce(addr, false)::INT AS a, CASE WHEN len(x) + len(y) > 0 THEN {_SIM.format('x', 'y')} ELSE 0 END AS sim FROM g)
SELECT id, company_id, round(least(1, 0.95::DOUBLE + 0.1::DOUBLE * i + 0.1::DOUBLE * a), 6) AS by_number, round(greatest(0, least(1, sim + 0.2 * i + 0.2 * a)), 6) AS by_name FROM s""")
def f32_match_score(s: SparkSession, d: str) -> DataFrame:
    p, c = table(s, d, "pension"), table(s, d, "dim_company")
    j = p.select("id", "company_name", "business_reg_num", F.col("industry_code").alias("pi"), F.concat(F.col("addr_sigungu_code"), F.lit("-"), F.col("legal_dong_addr_code")).alias("pa")).join(c, "business_reg_num")
    sim = hashing.trigram_similarity(F.col("company_name"), F.col("canonical_name"))
    score = lambda exact: F.round(names.match_score(F.lit(exact), sim, F.col("pi") == F.col("industry_code"), F.col("pa") == F.col("addr_key")), 6)
    return j.select("id", "company_id", score(True).alias("by_number"), score(False).alias("by_name"))


@query("SELECT event_id, strftime(to_timestamp((floor(epoch(ts))::BIGINT // 600) * 600) AT TIME ZONE 'UTC', '%Y-%m-%d %H:%M:%S') AS bucket FROM events")
def f33_bucket(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "events").select("event_id", F.date_format(values.bucket_floor(F.col("ts").cast("timestamp"), 600), "yyyy-MM-dd HH:mm:ss").alias("bucket"))


@query("WITH e AS (SELECT user_id, arg_min(value, struct_pack(a := ts, b := event_id)) AS a, arg_max(value, struct_pack(a := ts, b := event_id)) AS z, min(event_id) AS i, max(event_id) AS j FROM events GROUP BY 1) SELECT user_id, round((coalesce(z, 0) - coalesce(a, 0)) + 3.0 * (j - i), 4) AS score FROM e")
def f34_weighted_delta(s: SparkSession, d: str) -> DataFrame:
    o = F.struct("ts", "event_id")
    e = table(s, d, "events").groupBy("user_id").agg(F.min_by("value", o).alias("a"), F.max_by("value", o).alias("z"), F.min("event_id").alias("i"), F.max("event_id").alias("j"))
    return e.select("user_id", F.round(values.weighted_delta([(F.col("a"), F.col("z"), 1.0), (F.col("i"), F.col("j"), 3.0)]), 4).alias("score"))


@query("""WITH p AS (SELECT doc_id, text, chr(10) || text AS t FROM documents WHERE text IS NOT NULL), a AS (SELECT *, CASE WHEN regexp_matches(t, '\n(그런데|Later)') THEN length(regexp_extract(t, '(?s)^(.*?\n)(?:그런데|Later)', 1)) ELSE 0 END AS pos FROM p)
SELECT doc_id, CASE WHEN pos <= 1 THEN 1 ELSE 2 END AS parts, md5(CASE WHEN pos <= 1 THEN text ELSE substr(text, 1, pos - 1) END) AS first, CASE WHEN pos > 1 THEN md5(substr(text, pos)) END AS rest FROM a""")
def f41_split(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "documents").where("text is not null").select("doc_id", text.split_scenarios(F.col("text"), "그런데|Later").alias("p")).select("doc_id", F.size("p").alias("parts"), F.md5(F.get("p", F.lit(0))).alias("first"), F.md5(F.get("p", F.lit(1))).alias("rest"))


@query("SELECT strftime(d, '%Y%m%d') || '_list.csv' AS file, strftime(d, '%Y-%m-%d') AS day FROM (SELECT DISTINCT o_orderdate::DATE AS d FROM orders)")
def f44_filename_date(s: SparkSession, d: str) -> DataFrame:
    f = table(s, d, "orders").select(F.concat(F.date_format("o_orderdate", "yyyyMMdd"), F.lit("_list.csv")).alias("file")).distinct()
    return f.select("file", F.date_format(text.date_from_filename(F.col("file")), "yyyy-MM-dd").alias("day"))


@query("SELECT DISTINCT title, trim(regexp_replace(regexp_replace(title, '[\\\\/:*?\"<>|]', '_', 'g'), '_+', '_', 'g')) AS file FROM ss_normalized_posts WHERE title IS NOT NULL")
def f45_filename(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "ss_normalized_posts").select("title").where("title is not null").distinct().select("title", text.safe_filename(F.col("title")).alias("file"))


@query("SELECT event_id, (props->>'k')::BIGINT AS k FROM events")
def f46_salvage_json(s: SparkSession, d: str) -> DataFrame:
    # every third row is broken the way model answers are
    n = F.col("event_id") % 3
    broken = F.when(n == 0, F.concat(F.lit("```json\n"), F.regexp_replace("props", "}", ",}"), F.lit("\n```"))).when(n == 1, F.concat(F.lit("Sure: "), "props")).otherwise(F.col("props"))
    return table(s, d, "events").select("event_id", values.salvage_json(broken, "k long")["k"].alias("k"))


@query("SELECT o_orderkey, round_even(o_totalprice, 0)::BIGINT AS whole FROM orders")
def f47_safe_int(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "orders").select("o_orderkey", values.safe_int(F.col("o_totalprice").cast("decimal(18,2)").cast("string")).alias("whole"))


@query("SELECT c_custkey, greatest(0, least(1, c_acctbal / 5000)) AS share FROM customer")
def f48_clamp(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "customer").select("c_custkey", values.clamp01(F.col("c_acctbal") / 5000).alias("share"))


@query("SELECT event_id, (props->>'k')::BIGINT AS k, json_type(props, '$.k') IS NOT NULL AS has, to_json(struct_pack(type := event_type, k := (props->>'k')::BIGINT))::VARCHAR AS object FROM events")
def f49_json(s: SparkSession, d: str) -> DataFrame:
    k = F.get_json_object("props", "$.k").try_cast("long")
    return table(s, d, "events").select("event_id", k.alias("k"), k.isNotNull().alias("has"), F.to_json(F.struct(F.col("event_type").alias("type"), k.alias("k"))).alias("object"))
