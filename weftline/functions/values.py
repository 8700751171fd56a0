"""Numbers, times, JSON and file contents: Column in, Column out."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def bucket_floor(ts: Column, seconds: int) -> Column:
    """Start of the time bucket, as epoch seconds rounded down."""
    return F.timestamp_seconds(F.floor(F.unix_timestamp(ts) / seconds) * seconds)


def since(ts: Column, as_of: Column, seconds: int, closed: str = "left") -> Column:
    """ts within the trailing window; ``closed``: left >=, none >, both >= and <= as_of."""
    start = F.timestamp_seconds(F.unix_timestamp(as_of) - seconds)
    return {"left": ts >= start, "none": ts > start, "both": (ts >= start) & (ts <= as_of)}[closed]


def changed(a: Column, b: Column) -> Column:
    """IS DISTINCT FROM."""
    return ~a.eqNullSafe(b)


def decay(p: Column, age_hours: Column, tau: float) -> Column:
    """p exp(-age / tau), a negative age counting as none."""
    return p * F.exp(-F.greatest(age_hours, F.lit(0.0)) / tau)


def weighted_delta(parts: list[tuple[Column, Column, float]]) -> Column:
    """Sum of weight * (last - first), nulls as zero."""
    total = F.lit(0.0)
    for first, last, weight in parts:
        total = total + weight * (F.coalesce(last, F.lit(0)) - F.coalesce(first, F.lit(0)))
    return total


def ratio(a: Column, b: Column, digits: int) -> Column:
    """a / b, halves rounded to even; null where b is 0 or null."""
    return F.when(b != 0, F.bround(a / b, digits))


def clamp01(c: Column) -> Column:
    return F.when(c.isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(1.0), c)))


def safe_int(c: Column) -> Column:
    """Numbers in text, halves to even; null for anything else."""
    return F.when(F.trim(c).rlike(r"^[+-]?[0-9]{1,15}(\.[0-9]+)?$"), F.bround(F.trim(c).try_cast("double")).cast("long"))


def salvage_json(c: Column, schema: str) -> Column:
    """Parsed JSON; if that fails, of the outermost braces without fences, control characters and trailing commas."""
    inner = F.regexp_extract(F.regexp_replace(c, r"[\x00-\x08\x0B\x0C\x0E-\x1F]", ""), r"(?s)(\{.*\})", 1)
    cleaned = F.regexp_replace(inner, r",\s*([}\]])", "$1")
    strict = {"mode": "PERMISSIVE"}
    ok = lambda x: F.when(F.is_valid_utf8(x) & F.try_parse_json(x).isNotNull(), F.from_json(x, schema, strict))
    return F.coalesce(ok(c), ok(cleaned))


def sorted_json(c: Column) -> Column:
    """Sorted array as one canonical JSON string."""
    return F.to_json(F.array_sort(c))


def scrub(c: Column, most: int) -> Column:
    """Without control characters, cut at ``most`` characters."""
    return F.substring(F.regexp_replace(c, r"[\x00-\x1F\x7F]", " "), 1, most)


def unique_capped(c: Column, n: int) -> Column:
    """First ``n`` distinct items in order of first occurrence."""
    return F.slice(F.array_distinct(c), 1, n)


def image_mime(content: Column) -> Column:
    """Kind of an image by its first bytes, null if unknown."""
    head = F.hex(F.substring(content, 1, 12))
    return F.when(head.startswith("89504E470D0A1A0A"), "image/png").when(head.startswith("FFD8FF"), "image/jpeg").when(head.startswith("474946383"), "image/gif").when(head.startswith("52494646") & head.endswith("57454250"), "image/webp").when(head.startswith("424D"), "image/bmp")
