"""Names of securities, companies and keyboards; Column expressions and Arrow functions."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from weftline.functions import hangul

# Kinds of securities, in the order in which they are tried, by patterns on the Korean name.
SECURITY_KINDS = [("SPAC", r"스팩"), ("REIT", r"리츠"), ("fund", r"(펀드|투자회사)$"), ("convertible preferred", r"우[A-Z]?\(전환\)$"), ("preferred", r"[0-9]*우[A-Z]?$")]
# Korean readings of Latin letters and the ampersand.
LETTERS = dict(zip("ABCDEFGHIJKLMNOPQRSTUVWXYZ&", "에이 비 씨 디 이 에프 지 에이치 아이 제이 케이 엘 엠 엔 오 피 큐 알 에스 티 유 브이 더블유 엑스 와이 제트 앤".split()))
# Legal forms of companies.
LEGAL_FORMS = ["주식회사", "유한회사", "유한책임회사", "합자회사", "합명회사", "재단법인", "사단법인", "협동조합"]
LEGAL_SHORT = {"㈜": "주식회사", "(주)": "주식회사", "(유)": "유한회사", "(재)": "재단법인", "(사)": "사단법인", "(협)": "협동조합"}
# Further legal forms taken off names, and names of institutions that hold one and keep it.
LEGAL_WORDS = [
    *LEGAL_FORMS, "유한법인", "학교법인", "사회복지법인", "세무법인", "의료법인", "법무법인", "영농조합법인", "영어조합법인", "농업회사법인",
    "신용협동조합", "농업협동조합", "수산업협동조합", "새마을금고", "사회적협동조합", "사회협동조합",
]
PROTECTED = ["새마을금고", "신용협동조합", "농업협동조합"]
#: First group: what is kept. Read alike by Java's and RE2's regular expressions.
LEGAL_PATTERN = f"({'|'.join(PROTECTED)})|\\( *[주유합사재협] *\\)|[주유합사재] *\\)|㈜|" + "|".join(w.replace("회사", " *회사") for w in sorted(LEGAL_WORDS, key=lambda w: (-len(w), w)))
#: Letters with marks and the letters they are without, from Unicode's decompositions.
ACCENTED = {chr(c): d[0] for c in [*range(0xC0, 0x250), *range(0x1E00, 0x1F00)] if len(d := unicodedata.normalize("NFD", chr(c))) > 1 and d[0].isascii() and all(unicodedata.category(x) == "Mn" for x in d[1:])}
BRANCH = r"(본점|지점|지사|센터|영업소|[가-힣]{1,6}점)$"


def security_type(c: Column) -> Column:
    kind = F.lit("common")
    for name, pattern in reversed(SECURITY_KINDS):
        kind = F.when(c.rlike(pattern), name).otherwise(kind)
    return F.when(c.isNotNull(), kind)


def company_base_name(c: Column) -> Column:
    """Issuer's name: what precedes the mark of a preferred share; SPACs and REITs keep theirs whole."""
    base = F.regexp_extract(c, r"^(.+?)[0-9]*우[A-Za-z]*(?:\(전환\))?$", 1)
    return F.when(security_type(c).isin("SPAC", "REIT") | (base == ""), c).otherwise(base)


def letters_to_hangul(c: Column) -> Column:
    """Latin letters and & as they are read in Korean; other characters stay."""
    readings = F.create_map(*[F.lit(x) for kv in LETTERS.items() for x in kv])
    return F.array_join(F.transform(F.split(F.upper(c), ""), lambda ch: F.coalesce(F.try_element_at(readings, ch), ch)), "")


def hangul_to_keys(c: Column) -> Column:
    """Keystrokes that type a Korean name on a Latin layout, by jamo arithmetic inside the JVM."""
    table = lambda keys: F.array(*[F.lit(k) for k in keys])
    single = {j: k for js, ks in ((hangul.INITIALS, hangul.INITIAL_KEYS), (hangul.VOWELS, hangul.VOWEL_KEYS)) for j, k in zip(js, ks)}
    loose = F.create_map(*[F.lit(x) for kv in single.items() for x in kv])

    def key(ch: Column) -> Column:
        at = F.ascii(ch) - hangul.BASE
        typed = F.concat(F.get(table(hangul.INITIAL_KEYS), F.floor(at / 588).cast("int")), F.get(table(hangul.VOWEL_KEYS), F.floor(at % 588 / 28).cast("int")), F.get(table(hangul.FINAL_KEYS), (at % 28).cast("int")))
        return F.when((at >= 0) & (at <= hangul.LAST - hangul.BASE), typed).otherwise(F.coalesce(F.try_element_at(loose, ch), ch))

    return F.array_join(F.transform(F.split(c, ""), key), "")


@F.pandas_udf(StringType())
def keys_to_hangul(s: pd.Series) -> pd.Series:
    return s.map(lambda x: None if x is None else hangul.from_keys(x))


@F.pandas_udf(StringType())
def nfkc(s: pd.Series) -> pd.Series:
    return s.map(lambda x: None if x is None else unicodedata.normalize("NFKC", x))


@F.pandas_udf(StringType())
def nfkc_fold(s: pd.Series) -> pd.Series:
    """NFKC, then case folding."""
    return s.map(lambda x: None if x is None else unicodedata.normalize("NFKC", x).casefold())


@F.pandas_udf(StringType())
def unaccent(s: pd.Series) -> pd.Series:
    """Without combining marks; Hangul stays composed."""
    return s.map(lambda x: None if x is None else unicodedata.normalize("NFC", "".join(ch for ch in unicodedata.normalize("NFD", x) if unicodedata.category(ch) != "Mn")))


def pad_ticker(c: Column) -> Column:
    """Zeros in front up to six characters; longer codes stay whole."""
    return F.when(F.length(c) >= 6, c).otherwise(F.lpad(c, 6, "0"))


def _half_width(c: Column) -> Column:
    return F.translate(F.translate(c, "".join(map(chr, range(0xFF01, 0xFF5F))), "".join(map(chr, range(0x21, 0x7F)))), "　", " ")


def plain_letters(c: Column) -> Column:
    """Latin letters without their marks, composed or not, inside the JVM; ``unaccent`` knows all scripts."""
    return F.translate(F.regexp_replace(c, r"[\x{0300}-\x{036F}]", ""), "".join(ACCENTED), "".join(ACCENTED.values()))


def _no_legal_form(c: Column) -> Column:
    return F.regexp_replace(c, LEGAL_PATTERN, " $1")


def normalize_company(c: Column) -> Column:
    """Lower-case letters without accents, digits and Hangul, without legal forms and what stands in parentheses.

    Credit unions and the like keep the legal form that is part of their name.
    """
    s = F.regexp_replace(_no_legal_form(F.lower(plain_letters(_half_width(c)))), r"\([^()]*\)", " ")
    return F.regexp_replace(s, "[^0-9a-z가-힣]", "")


def canonicalize_company(c: Column) -> Column:
    """Name without legal form, parentheses and branch, letter case kept, white space collapsed; '' becomes null."""
    s = F.regexp_replace(_no_legal_form(plain_letters(_half_width(c))), r"\([^()]*\)", " ")
    s = F.trim(F.regexp_replace(s, r"[ \t\r\n]+", " "))
    s = F.trim(F.regexp_replace(s, f" +{BRANCH}", ""))
    return F.nullif(s, F.lit(""))


def company_types(c: Column) -> Column:
    """Distinct legal forms named, sorted; null if none."""
    found = [F.when(F.contains(c, F.lit(f)), F.lit(f)) for f in LEGAL_FORMS]
    short = [F.when(F.contains(c, F.lit(k)), F.lit(f)) for k, f in LEGAL_SHORT.items()]
    a = F.array_sort(F.array_distinct(F.array_compact(F.array(*found, *short))))
    return F.when(F.size(a) > 0, a)


def company_type(c: Column) -> Column:
    """The first legal form named, in the order of LEGAL_FORMS; null if none."""
    named = lambda f: [F.contains(c, F.lit(x)) for x in (f, *(k for k, v in LEGAL_SHORT.items() if v == f))]
    return F.coalesce(*[F.when(F.array_contains(F.array(*named(f)), True), F.lit(f)) for f in LEGAL_FORMS])


def addr_key(sigungu: Column, dong: Column) -> Column:
    return F.concat_ws("-", sigungu, dong)


def match_score(exact: Column, similarity: Column, industry: Column, address: Column, null_is_one: bool = False) -> Column:
    """Score in [0, 1] of a match: 0.95 and 0.1 bonuses for an exact number, else similarity and 0.2 bonuses.

    With ``null_is_one`` an unknown comparison makes the score 1, as LEAST and
    GREATEST do that skip nulls; by default it brings no bonus.
    """
    i, a = (x.cast("int") if null_is_one else F.coalesce(x, F.lit(False)).cast("int") for x in (industry, address))
    return F.when(exact, F.least(F.lit(1.0), 0.95 + 0.1 * i + 0.1 * a)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), similarity + 0.2 * i + 0.2 * a)))


def stem_id(c: Column, prefix: str) -> Column:
    """Number after ``prefix`` in a file's name, null if there is none."""
    return F.regexp_extract(c, f"{prefix}-([0-9]+)", 1).try_cast("long")
