"""Text, markup, URL and date expressions: Column in, Column out, inside the JVM but for ``key_a`` and ``key_b``.

Classes of characters are spelled out, so results do not depend on a regular
expression dialect. A null input gives null unless stated otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from weftline.functions.names import nfkc_fold

WORD_CLASS = "0-9a-z가-힣"


def tokens(c: Column) -> Column:
    """Lower-case words of letters a-z, digits and Hangul, URLs removed, one-character words dropped."""
    s = F.regexp_replace(F.lower(c), r"https?://[^ \t\r\n]+", " ")
    s = F.regexp_replace(s, f"[^{WORD_CLASS}]+", " ")
    return F.filter(F.split(F.trim(s), " +"), lambda x: F.length(x) >= 2)


def shingles(words: Column, k: int = 5) -> Column:
    """Runs of k words joined by a space; fewer than k words stay single words."""
    n = F.size(words)
    runs = F.transform(F.sequence(F.lit(0), F.greatest(n - k, F.lit(0))), lambda i: F.array_join(F.slice(words, i + 1, k), " "))
    return F.when(n >= k, runs).otherwise(words)


def key_a(c: Column) -> Column:
    """Lower-case letters, digits, Hangul, + and single spaces, after NFKC and case folding (an Arrow function)."""
    return F.trim(F.regexp_replace(F.regexp_replace(nfkc_fold(c), f"[^{WORD_CLASS}+ ]", " "), " +", " "))


def key_b(c: Column) -> Column:
    """``key_a`` without spaces."""
    return F.replace(key_a(c), F.lit(" "), F.lit(""))


def strip_html(c: Column) -> Column:
    """Text of a fragment: tags become spaces, common entities are decoded, white space is collapsed."""
    s = F.regexp_replace(c, r"(?s)<[^<>]*>", " ")
    for entity, ch in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&amp;", "&")):
        s = F.replace(s, F.lit(entity), F.lit(ch))
    return F.trim(F.regexp_replace(s, r"[ \t\r\n\x{A0}]+", " "))


def html_blocks(c: Column) -> Column:
    """Ordered blocks of a fragment: array<struct<kind, value>> of text runs and image addresses."""
    cells = F.split(F.regexp_replace(c, r"(?is)<img[^<>]*?src=[\"']?([^\"' >]+)[^<>]*>", "\u0001\u0002$1\u0001"), "\u0001")
    blocks = F.transform(cells, lambda x: F.when(x.startswith("\u0002"), F.struct(F.lit("image").alias("kind"), F.substring(x, F.lit(2), F.length(x)).alias("value"))).otherwise(F.struct(F.lit("text").alias("kind"), strip_html(x).alias("value"))))
    return F.filter(blocks, lambda b: b["value"] != "")


def is_image_url(c: Column) -> Column:
    return F.lower(c).rlike(r"\.(png|jpe?g|gif|webp|bmp|svg)(\?.*)?$")


def url_host(c: Column) -> Column:
    return F.lower(F.regexp_extract(c, r"^[a-zA-Z]+://([^/?#]+)", 1))


def url_path(c: Column) -> Column:
    return F.regexp_extract(c, r"^[a-zA-Z]+://[^/?#]+([^?#]*)", 1)


def norm_url(c: Column) -> Column:
    """Lower-case host and decoded path, no scheme, query or fragment."""
    return F.concat(url_host(c), F.coalesce(F.try_url_decode(url_path(c)), url_path(c)))


def abs_url(base: Column, c: Column) -> Column:
    """``c`` made absolute against ``base``."""
    scheme = F.regexp_extract(base, r"^([a-zA-Z]+)://", 1)
    origin = F.regexp_extract(base, r"^([a-zA-Z]+://[^/?#]+)", 1)
    folder = F.regexp_extract(base, r"^([a-zA-Z]+://[^/?#]+(?:/[^?#/]*)*)/[^/?#]*", 1)
    return F.when(c.rlike("^[a-zA-Z]+://"), c).when(c.startswith("//"), F.concat(scheme, F.lit(":"), c)).when(c.startswith("/"), F.concat(origin, c)).otherwise(F.concat(F.when(folder == "", origin).otherwise(folder), F.lit("/"), c))


def srcset(c: Column) -> Column:
    """Addresses of a srcset attribute, in order, without their widths and densities."""
    return F.filter(F.transform(F.split(c, ","), lambda x: F.split_part(F.trim(x), F.lit(" "), F.lit(1))), lambda x: x != "")


def abs_urls(base: Column, urls: Column) -> Column:
    """Addresses made absolute, each once, in order of first occurrence."""
    return F.array_distinct(F.transform(urls, lambda x: abs_url(base, x)))


def image_token(c: Column) -> Column:
    """host/last path segment of a URL; other strings stay."""
    return F.when(c.rlike("^[a-zA-Z]+://"), F.concat(url_host(c), F.lit("/"), F.element_at(F.split(url_path(c), "/"), -1))).otherwise(c)


def embed_token(url: Column, video_id: Column) -> Column:
    """yt:<id> for videos, the status number of micro-posts, else em:<host>."""
    status = F.regexp_extract(url, r"/status/([0-9]+)", 1)
    return F.when(url_host(url).rlike(r"(^|\.)(youtube\.com|youtu\.be)$") & video_id.isNotNull(), F.concat(F.lit("yt:"), video_id)).when(status != "", F.concat(F.lit("x:"), status)).otherwise(F.concat(F.lit("em:"), url_host(url)))


def count_hits(c: Column, terms: list[str]) -> Column:
    """How many of ``terms`` occur in the text."""
    return F.size(F.filter(F.array(*[F.lit(t) for t in terms]), lambda t: F.contains(c, t)))


#: Terms of a dictionary that may stand in a plan.
MOST_TERMS = 20_000


def match_terms(c: Column, terms: dict[str, str]) -> Column:
    """Distinct names of the dictionary terms that occur, longest term first where they overlap, in order of occurrence.

    ``terms``: term -> name, both compared as given; terms of a dictionary
    are literals of the plan, so more than ``MOST_TERMS`` are refused.
    """
    import re

    if len(terms) > MOST_TERMS:
        raise ValueError(f"a dictionary of {len(terms)} terms is longer than {MOST_TERMS}")
    alternatives = "|".join(re.escape(t) for t in sorted(terms, key=lambda t: (-len(t), t)))
    names = F.create_map(*[F.lit(x) for kv in terms.items() for x in kv])
    return F.array_distinct(F.transform(F.regexp_extract_all(c, F.lit(f"({alternatives})"), 1), lambda t: F.try_element_at(names, t)))


def split_scenarios(c: Column, marker: str) -> Column:
    """The text before and from the first line that begins with ``marker`` (a pattern): one or two parts."""
    # measured in characters: positions of matches count surrogates
    at = F.length(F.regexp_extract(F.concat(F.lit("\n"), c), f"(?s)^(.*?\n)(?:{marker})", 1))
    return F.when(at <= 1, F.array(c)).otherwise(F.array(F.substring(c, F.lit(1), at - 1), F.substring(c, at, F.length(c))))


def utc_iso_to_kst_date(c: Column) -> Column:
    """Calendar day in Seoul of an ISO time in UTC; null if it can't be read."""
    return F.to_date(F.from_utc_timestamp(F.try_to_timestamp(F.regexp_replace(F.substring(c, 1, 19), "T", " "), F.lit("yyyy-MM-dd HH:mm:ss")), "Asia/Seoul"))


def kst_to_utc(c: Column, as_of: Column) -> Column:
    """Time in UTC of what Korean boards write: minutes or hours ago, HH:mm, MM.DD HH:mm, [YY]YY.MM.DD, ISO.

    ``as_of`` is the reading time in UTC. A bare number counts minutes ago; a
    month and day still to come belong to the year before.
    """
    now = F.from_utc_timestamp(as_of, "Asia/Seoul")
    s = F.trim(c)
    ago = lambda pattern, seconds: F.when(s.rlike(pattern), F.timestamp_seconds(F.unix_timestamp(as_of) - F.regexp_extract(s, r"([0-9]+)", 1).cast("long") * seconds))
    full = F.regexp_replace(s, r"^([0-9]{2})[./-]([0-9]{2})[./-]([0-9]{2})(?![0-9])", "20$1-$2-$3")
    full = F.regexp_replace(full, r"^([0-9]{4})[./-]([0-9]{1,2})[./-]([0-9]{1,2})\.?", "$1-$2-$3")
    read = F.coalesce(*[F.try_to_timestamp(full, F.lit(f)) for f in ("yyyy-M-d HH:mm:ss", "yyyy-M-d HH:mm", "yyyy-M-d")])
    clock = F.try_to_timestamp(F.concat_ws(" ", F.date_format(now, "yyyy-MM-dd"), s), F.lit("yyyy-MM-dd HH:mm"))
    day = F.try_to_timestamp(F.concat(F.date_format(now, "yyyy."), s), F.lit("yyyy.MM.dd HH:mm"))
    day = F.when(day > now, F.add_months(day, -12).cast("timestamp") + (day - F.date_trunc("day", day))).otherwise(day)
    iso = F.when(s.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}T.*Z$"), F.try_to_timestamp(F.regexp_replace(F.substring(s, 1, 19), "T", " "), F.lit("yyyy-MM-dd HH:mm:ss")))
    utc = lambda x: F.to_utc_timestamp(x, "Asia/Seoul")
    return F.coalesce(ago(r"^[0-9]+ *(분|min)", 60), ago(r"^[0-9]+ *(시간|hour)", 3600), ago(r"^[0-9]{1,3}$", 60), iso, F.when(s.rlike("^[0-9]{1,2}:[0-9]{2}$"), utc(clock)), F.when(s.rlike(r"^[0-9]{2}\.[0-9]{2} [0-9]{2}:[0-9]{2}$"), utc(day)), utc(read))


def date_from_filename(c: Column) -> Column:
    """Date in a file's name: YYYYMMDD, 'Y년 M월' (its first day) or MM_DD_YYYY; null without a valid one."""
    month = F.try_to_date(F.concat_ws("-", F.regexp_extract(c, "([0-9]{4})년", 1), F.lpad(F.regexp_extract(c, "년 *([0-9]{1,2})월", 1), 2, "0"), F.lit("01")), "yyyy-MM-dd")
    return F.coalesce(F.try_to_date(F.regexp_extract(c, "((?:19|20)[0-9]{6})", 1), "yyyyMMdd"), month, F.try_to_date(F.regexp_extract(c, "([0-9]{2}_[0-9]{2}_[0-9]{4})", 1), "MM_dd_yyyy"))


def safe_filename(c: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(c, r"[\\/:*?\"<>|]", "_"), "_+", "_"))


def restricted(c: Column, words: list[str]) -> Column:
    """Whether the text without white space contains one of ``words`` (removed or hidden posts)."""
    return F.regexp_replace(c, r"[ \t\r\n\x{A0}]", "").rlike("|".join(words))
