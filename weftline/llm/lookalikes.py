"""Bringing text that looks the same to one consistent form.

Classes of code points and strings that look alike are the connected
components of stated and derived likenesses (union-find, so they are
transitive). Each class is represented by its member that is most frequent in
the data; texts are rewritten greedily, longest pattern first, by an
Aho-Corasick automaton over all members, until nothing changes.
"""

from __future__ import annotations

import itertools
import sys
import unicodedata
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Letters of other scripts beside the Latin letters they look like.
HOMOGLYPHS = {
    "A": "ΑАᎪ", "B": "ΒВᏴ", "C": "СϹᏟ", "D": "Ꭰ", "E": "ΕЕᎬ", "G": "Ԍ", "H": "ΗНᎻ", "I": "ΙІӀⅠ", "J": "ЈᎫ", "K": "ΚКᏦ",
    "L": "ᏞⅬ", "M": "ΜМᎷⅯ", "N": "Ν", "O": "ΟОՕ", "P": "ΡРᏢ", "Q": "Ԛ", "S": "ЅՏᏚ", "T": "ΤТᎢ", "U": "Ս", "V": "ѴᏙⅤ",
    "W": "ԜᎳ", "X": "ΧХⅩ", "Y": "ΥУҮ", "Z": "ΖᏃ",
    "a": "аα", "c": "сϲⅽ", "d": "ԁⅾ", "e": "е", "h": "һհ", "i": "іⅰι", "j": "јϳ", "k": "κк", "l": "ⅼӏ", "m": "ⅿ", "n": "ո",
    "o": "оοօ", "p": "рρ", "q": "ԛ", "s": "ѕ", "u": "υս", "v": "νѵⅴ", "w": "ԝ", "x": "хχⅹ", "y": "уүγ",
}
# Format characters (category Cf) that do show.
VISIBLE_FORMAT = "؀؁؂؃؄؅۝܏࢐࢑࣢𑂽𑃍"
# Invisible code points outside category Cf: grapheme joiner, Hangul and Khmer fillers, variation selectors.
INVISIBLE_RANGES = [(0x034F, 0x034F), (0x115F, 0x1160), (0x17B4, 0x17B5), (0x180B, 0x180F), (0x3164, 0x3164), (0xFE00, 0xFE0F), (0xFFA0, 0xFFA0), (0xE0100, 0xE01EF)]


class UnionFind:
    def __init__(self) -> None:
        self.parent: dict[str, str] = {}

    def find(self, x: str) -> str:
        root = x
        while (up := self.parent.setdefault(root, root)) != root:
            root = up
        while self.parent[x] != root:
            self.parent[x], x = root, self.parent[x]
        return root

    def union(self, a: str, b: str) -> None:
        a, b = self.find(a), self.find(b)
        if a != b:
            self.parent[max(a, b)] = min(a, b)

    def classes(self) -> list[list[str]]:
        by: dict[str, list[str]] = {}
        for x in self.parent:
            by.setdefault(self.find(x), []).append(x)
        return list(by.values())


@lru_cache(maxsize=1)
def classes() -> tuple[list[list[str]], list[str]]:
    """(classes of code points and strings that look alike, code points that don't show at all).

    Likenesses come from Unicode data: full- and half-width forms, letters of
    mathematical alphabets, all space characters, canonical compositions (every order of their marks that
    composes alike), isolated conjoining jamo and compatibility jamo; and from
    HOMOGLYPHS. Their number is bounded by Unicode, not by the data.
    """
    uf = UnionFind()
    hidden = [chr(c) for a, b in INVISIBLE_RANGES for c in range(a, b + 1)]
    decomposed = []
    for c in range(sys.maxunicode + 1):
        if 0xAC00 <= c <= 0xD7A3 or 0xD800 <= c <= 0xDFFF:
            continue
        ch = chr(c)
        kind = unicodedata.category(ch)
        if kind == "Cn" or any(a <= c <= b for a, b in INVISIBLE_RANGES):
            continue
        if kind == "Zs":
            uf.union(ch, " ")
            continue
        if kind == "Cf" and ch not in VISIBLE_FORMAT:
            hidden.append(ch)
            continue
        how = unicodedata.decomposition(ch)
        # letters and digits of mathematical alphabets are those of a font
        if how.startswith(("<wide>", "<narrow>", "<font>")):
            uf.union(ch, "".join(chr(int(x, 16)) for x in how.split()[1:]))
        elif how.startswith("<compat>") and 0x3131 <= c <= 0x318E and len(how.split()) == 2:
            uf.union(ch, chr(int(how.split()[1], 16)))
        elif how and how[0] != "<":
            decomposed.append(ch)
    for latin, others in HOMOGLYPHS.items():
        for other in others:
            uf.union(latin, other)
    single = {x: min(m for m in group) for group in uf.classes() for x in group if len(x) == 1}
    for ch in decomposed:
        parts = unicodedata.normalize("NFD", ch)
        # members of letters' classes compose like the letters themselves
        uf.union(ch, "".join(single.get(x, x) for x in parts))
        if 2 < len(parts) <= 4:
            for marks in itertools.permutations(parts[1:]):
                if unicodedata.normalize("NFC", s := parts[0] + "".join(marks)) == unicodedata.normalize("NFC", parts):
                    uf.union(ch, "".join(single.get(x, x) for x in s))
        half = unicodedata.normalize("NFC", parts[:-1])
        if len(parts) > 2 and len(half) == 1:
            uf.union(ch, half + parts[-1])
    return uf.classes(), sorted(set(hidden) - set(uf.parent))


def _pick(group: list[str], seen: dict[str, int]) -> str:
    """Most frequent member; of equals the shortest, plainest one."""
    singles = [m for m in group if len(m) == 1] or group
    # an isolated jamo stands as one that never combines with its neighbours
    singles = [m for m in singles if "ㄱ" <= m <= "ㆎ"] or singles
    return min(singles, key=lambda m: (-seen.get(m, 0), not m.isascii(), len(unicodedata.normalize("NFD", m)), m))


def representatives(seen: dict[str, int]) -> dict[str, str]:
    """Pattern -> what it is rewritten to, for the character frequencies ``seen``."""
    groups, hidden = classes()
    single = {}
    for group in groups:
        best = _pick(group, seen)
        single |= {m: best for m in group if len(m) == 1}
    rewrite = {ch: "" for ch in hidden}
    for group in groups:
        best = _pick(group, seen)
        for m in group:
            if m != best:
                rewrite[m] = best
            # a string's letters may already have been rewritten to their own representatives
            if len(m) > 1 and (alt := "".join(single.get(x, x) for x in m)) != best:
                rewrite[alt] = best
    return rewrite


def _hangul(text: str) -> str:
    """Compose conjoining jamo; their 11,172 strings follow from arithmetic and need no patterns."""
    out: list[str] = []
    for ch in text:
        c = ord(ch)
        if out and 0x1161 <= c <= 0x1175 and 0x1100 <= (p := ord(out[-1])) <= 0x1112:
            out[-1] = chr(0xAC00 + ((p - 0x1100) * 21 + (c - 0x1161)) * 28)
        elif out and 0x11A8 <= c <= 0x11C2 and 0xAC00 <= (p := ord(out[-1])) <= 0xD7A3 and (p - 0xAC00) % 28 == 0:
            out[-1] = chr(p + c - 0x11A7)
        else:
            out.append(ch)
    return "".join(out)


class Rewriter:
    """Greedy leftmost-longest rewriting to representatives, repeated until nothing changes."""

    def __init__(self, rewrite: dict[str, str]) -> None:
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        # isolated jamo are rewritten last: before that they may be parts of syllables
        self.late = {k: v for k, v in rewrite.items() if len(k) == 1 and (0x1100 <= ord(k) <= 0x11FF or 0x3131 <= ord(k) <= 0x318E or 0xFFA0 <= ord(k) <= 0xFFDC)}
        early = {k: v for k, v in rewrite.items() if k not in self.late}
        for pattern, best in early.items():
            self.automaton.add_word(pattern, (len(pattern), best))
        self.automaton.make_automaton()
        self.touched = frozenset(x[-1] for x in rewrite)
        self.late_map = str.maketrans(self.late)
        self.jamo = frozenset(map(chr, range(0x1100, 0x1200))) | frozenset(self.late)

    def _pass(self, text: str) -> str:
        out, at = [], 0
        for end, (n, best) in self.automaton.iter_long(text):
            start = end - n + 1
            out.append(text[at:start])
            out.append(best)
            at = end + 1
        return "".join([*out, text[at:]]) if at else text

    def __call__(self, text: str) -> str:
        if self.touched.isdisjoint(text) and self.jamo.isdisjoint(text):
            return text
        # canonical order of marks first: their order alone doesn't show
        while (new := self._pass(unicodedata.normalize("NFC", text))) != text:
            text = new
        if not self.jamo.isdisjoint(text):
            text = _hangul(text).translate(self.late_map)
        return text


@lru_cache(maxsize=1)
def plain_rewriter() -> Rewriter:
    """For single texts without a corpus: the plainest member stands for its class."""
    return Rewriter(representatives({}))


def character_counts(df: DataFrame, text: str) -> DataFrame:
    """(ch, n) over all texts; counted per Arrow batch, then combined. At most one row per Unicode code point."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[str] = Counter()
        for b in batches:
            total.update("".join(x for x in b.column(0).to_pylist() if x))
        yield pa.RecordBatch.from_arrays([pa.array(list(total.keys()), pa.string()), pa.array(list(total.values()), pa.int64())], ["ch", "n"])

    # group under the binary form: collations never merge characters here
    return df.select(F.col(text).cast("string").alias("t")).mapInArrow(count, "ch string, n long").groupBy("ch").agg(F.sum("n").alias("n"))


def canonical_text(df: DataFrame, key: list[str], text: str, counts: DataFrame | None = None) -> DataFrame:
    """(key..., raw, canonical): ``canonical`` is equal for texts that look the same.

    Null texts are left out, empty ones stay (and equal texts of invisible
    characters only). Repeated rows stay repeated. ``counts`` may hold the
    character frequencies of a larger corpus; by default those of ``df``. The
    counts are collected: at most 1,114,112 rows, one per Unicode code point.
    """
    rows = df.select(*key, F.col(text).cast("string").alias("raw")).where(F.col("raw").isNotNull())
    seen = {r["ch"]: r["n"] for r in (counts if counts is not None else character_counts(rows, "raw")).toLocalIterator()}
    rewrite = representatives(seen)
    where = rows.columns.index("raw")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fix = Rewriter(rewrite)
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([fix(x) for x in b.column(where).to_pylist()], pa.string())], [*b.schema.names, "canonical"])

    fields = ", ".join(f"`{c}` {t}" for c, t in rows.dtypes)
    return rows.mapInArrow(run, f"{fields}, canonical string")


def same_look_pairs(df: DataFrame, field: str, key: str, text: str) -> DataFrame:
    """(field, key_a, key_b): keys of one field whose texts look the same but differ, key_a < key_b.

    A key that has several texts pairs with each other key once. Different
    spellings of a class are paired first and their keys joined to them, so
    equal texts never meet and pairs are formed only where they are results.
    """
    rows = canonical_text(df.select(F.col(field).alias("f"), F.col(key).alias("k"), F.col(text).alias("t")).distinct(), ["f", "k"], "t")
    rows = rows.where(F.col("f").isNotNull() & F.col("k").isNotNull())
    spellings = rows.select("f", "canonical", "raw").distinct()
    a = spellings.select("f", "canonical", F.col("raw").alias("raw_a"))
    b = spellings.select("f", "canonical", F.col("raw").alias("raw_b"))
    unlike = a.join(b, ["f", "canonical"]).where("raw_a < raw_b").select("f", "raw_a", "raw_b")
    keys = lambda x: rows.select("f", F.col("raw").alias(f"raw_{x}"), F.col("k").alias(x))
    met = unlike.join(keys("a"), ["f", "raw_a"]).join(keys("b"), ["f", "raw_b"]).where("a <> b")
    return met.select(F.col("f").alias("field"), F.least("a", "b").alias("key_a"), F.greatest("a", "b").alias("key_b")).distinct()
