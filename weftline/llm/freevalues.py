"""Mapping freely entered values to a reference list.

A symmetric-delete dictionary over all spellings of the list answers bounded
edit-distance lookups: a spelling and a value are candidates if deleting up to
``max_edits`` characters from each can make them equal. Candidates are ranked
by a weighted Damerau-Levenshtein distance (a changed jamo weighs less than a
changed letter, a doubled character less than a foreign one) and by how often
the data contain the entry. Values that reach no entry, or several alike, are
reported as UNMATCHED.

Numbers name generations, so they are never edited, nor is the letter of a
code such as S24. Endings that many different entries carry (colours, sales
conditions) are learned from the data: see ``decorations``.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from weftline.functions import hangul
from weftline.llm.lookalikes import HOMOGLYPHS, plain_rewriter
from weftline.operators.lineage import cut

UNMATCHED = "UNMATCHED"
#: Reference entries per pass; longer lists are looked up in several passes, with the same results.
BLOCK = 50_000
_MARKS = re.compile("[̀-ͯ]")
#: Small forms of capitals that look Latin: text that was lower-cased after a look-alike had slipped in.
_LOWERED = str.maketrans({c.lower(): latin.lower() for latin, others in HOMOGLYPHS.items() if latin.isupper() for c in others if c.lower() != c})
_CODE = re.compile(r"([a-z]*)(\d+)")


def fold(text: str) -> str:
    """One form for look-alikes, compatibility forms, letter case and accents."""
    text = unicodedata.normalize("NFKC", plain_rewriter()(text))
    return unicodedata.normalize("NFC", _MARKS.sub("", unicodedata.normalize("NFD", text.casefold())))


def compact(text: str) -> str:
    return re.sub(r"[^\w+]|_", "", text)


def _codes(text: str) -> list[tuple[str, str]]:
    """Numbers with their code letter: a lone letter (or one letter repeated) before them."""
    return [(m[1][:1] if len(set(m[1])) == 1 else "", m[2]) for m in _CODE.finditer(text)]


def _forms(value: str) -> list[tuple[str, float]]:
    """(spelling, cost) under which a value is looked up."""
    folded = fold(value)
    forms = {compact(folded): 0.0}
    if (small := value.translate(_LOWERED)) != value:
        forms.setdefault(compact(fold(small)), 0.05)
    words = re.findall(r"[^\W_]+\+?", folded)
    if len(words) > 1:
        forms.setdefault("\0".join(sorted(words)), 0.05)
    # lower-case Latin runs may be Hangul typed on the wrong layout
    plain = unicodedata.normalize("NFKC", plain_rewriter()(value))
    typed = re.sub(r"[a-zQWERTOP]*[a-z][a-zQWERTOP]*", lambda m: hangul.from_keys(m[0]), plain)
    if typed != plain:
        forms.setdefault(compact(fold(typed)), 0.1)
    return [(f, c) for f, c in forms.items() if f]


def _substitution(a: str, b: str) -> float:
    x, y = hangul.split(a), hangul.split(b)
    return 0.3 + 0.25 * sum(i != j for i, j in zip(x, y)) if x and y else 1.0


def distance(a: str, b: str, limit: float) -> float:
    """Weighted Damerau-Levenshtein distance (adjacent transpositions), infinite beyond ``limit``."""
    if abs(len(a) - len(b)) * 0.5 > limit:
        return math.inf

    def gap(s: str, i: int) -> float:
        """Of leaving out s[i]."""
        jamo = "ᄀ" <= s[i] <= "ᇿ"
        return 0.5 if jamo or i and s[i] == s[i - 1] or i + 1 < len(s) and s[i] == s[i + 1] else 1.0

    before: list[float] = []
    row = [0.0]
    for j in range(len(b)):
        row.append(row[-1] + gap(b, j))
    for i in range(len(a)):
        new = [row[0] + gap(a, i)]
        for j in range(len(b)):
            best = min(row[j + 1] + gap(a, i), new[j] + gap(b, j), row[j] + (0 if a[i] == b[j] else _substitution(a[i], b[j])))
            if i and j and a[i] == b[j - 1] and a[i - 1] == b[j] and a[i] != b[j]:
                best = min(best, before[j - 1] + 0.7)
            new.append(best)
        # a transposition reaches back two rows
        if min(new) > limit and min(row) > limit:
            return math.inf
        before, row = row, new
    return row[-1] if row[-1] <= limit else math.inf


def _limit(n: int) -> float:
    """Greatest distance accepted for a spelling of n characters."""
    return 0.65 if n <= 2 else 0.8 if n == 3 else 1.05 if n < 8 else 1.6


def _deletes(key: str, edits: int) -> set[str]:
    out, last = {key}, {key}
    for _ in range(edits):
        last = {s[:i] + s[i + 1 :] for s in last for i in range(len(s)) if not s[i].isdigit()}
        out |= last
    return out


class Dictionary:
    """Symmetric-delete dictionary of one field's entries: name -> spellings."""

    def __init__(self, entries: dict[str, list[str]], max_edits: int = 2) -> None:
        self.max_edits = max_edits
        self.exact: dict[str, set[str]] = defaultdict(set)
        self.words: dict[str, set[str]] = defaultdict(set)
        for name, spellings in entries.items():
            for s in {name, *(x for x in spellings if x)}:
                folded = fold(s)
                if key := compact(folded):
                    self.exact[key].add(name)
                words = re.findall(r"[^\W_]+\+?", folded)
                if len(words) > 1:
                    self.words["\0".join(sorted(words))].add(name)
        self.longest = max(map(len, self.exact), default=0)
        self.deleted: dict[str, list[str]] = defaultdict(list)
        for key in self.exact:
            for d in _deletes(key, self._edits(key)):
                self.deleted[d].append(key)

    def _edits(self, key: str) -> int:
        return min(self.max_edits, 2 if len(key) >= 8 else 1)

    def prefix(self, value: str) -> tuple[set[str], int, str] | None:
        """Names of the longest spelling that ``value`` begins with, its length and the rest; no rest if value is itself a spelling."""
        s = compact(fold(value))
        return next(((self.exact[s[:i]], i, s[i:]) for i in range(min(len(s), self.longest), 0, -1) if s[:i] in self.exact), None)

    def candidates(self, value: str, decorations: frozenset[str] = frozenset()) -> dict[str, float]:
        """name -> least cost, of the names within reach; exact spellings end the search."""
        return self.reach(value, decorations)[0]

    def reach(self, value: str, decorations: frozenset[str] = frozenset()) -> tuple[dict[str, float], bool]:
        """(name -> least cost, whether by exact spellings)."""
        best: dict[str, float] = {}

        def offer(names: Iterable[str], cost: float) -> None:
            for n in names:
                best[n] = min(cost, best.get(n, math.inf))

        forms = _forms(value)
        seen = {f for f, _ in forms}
        for form, cost in forms:  # grows while endings are taken off
            for end in decorations:
                if "\0" not in form and len(form) > len(end) and form.endswith(end) and (cut_off := form[: -len(end)]) not in seen:
                    seen.add(cut_off)
                    forms.append((cut_off, cost + 0.05))
        for form, cost in forms:
            offer(self.words.get(form, ()) if "\0" in form else self.exact.get(form, ()), cost)
        if best:
            return best, True
        for form, cost in forms:
            # what is longer than all spellings by more than the edits is near none
            if "\0" in form or len(form) > self.longest + self.max_edits:
                continue
            codes = _codes(form)
            for key in {k for d in _deletes(form, self._edits(form)) for k in self.deleted.get(d, ())}:
                if codes == _codes(key) and (w := distance(form, key, limit := _limit(min(len(key), len(form))))) <= limit:
                    offer(self.exact[key], cost + w)
        return best, False


def _dictionaries(entries: list[tuple[str, str, list[str]]], max_edits: int) -> dict[str, Dictionary]:
    by: dict[str, dict[str, list[str]]] = defaultdict(dict)
    for field, name, spellings in entries:
        by[field].setdefault(name, []).extend(spellings)
    return {f: Dictionary(e, max_edits) for f, e in by.items()}


def _blocks(reference: DataFrame, size: int) -> Iterator[list[tuple[str, str, list[str]]]]:
    block: list[tuple[str, str, list[str]]] = []
    for r in reference.select("field", "name", "spellings").where("field is not null and name is not null").toLocalIterator():
        block.append((r["field"], r["name"], [x for x in r["spellings"] or [] if x]))
        if len(block) == size:
            yield block
            block = []
    yield block


def _only_block(reference: DataFrame, size: int) -> list[tuple[str, str, list[str]]] | None:
    """The reference if it is one block, else None."""
    blocks = _blocks(reference, size)
    entries = next(blocks)
    return entries if next(blocks, None) in (None, []) else None


def _in_blocks(values: DataFrame, reference: DataFrame, size: int, only: list[tuple[str, str, list[str]]] | None, work: Callable[[dict[str, Dictionary], str, str], Iterable[tuple]], schema: str, max_edits: int) -> DataFrame:
    """Rows of ``work(dictionaries, field, value)`` for every value and block of the reference; the driver holds one block, or two."""
    names = [x.split()[0] for x in schema.split(", ")]
    blocks, out = iter([only]) if only is not None else _blocks(reference, size), None
    entries = next(blocks)
    while entries is not None:
        after = next(blocks, None)

        def run(batches: Iterable[pa.RecordBatch], entries=entries) -> Iterator[pa.RecordBatch]:
            dictionaries = _dictionaries(entries, max_edits)
            for b in batches:
                rows = [(f, v, *r) for f, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist()) if f in dictionaries and v for r in work(dictionaries, f, v)]
                yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in rows], arrow)

        empty = values.sparkSession.createDataFrame([], schema)
        arrow = to_arrow_schema(empty.schema)
        part = values.select("field", "value").mapInArrow(run, schema)
        if after is not None or out is not None:
            part = cut(part)
        out = part if out is None else out.unionByName(part)
        entries = after
    return out


def _near_word(end: str, word: str) -> bool:
    """Whether an ending is a word of the reference list, or one misspelt."""
    return distance(end, word, 1.1) <= (1.1 if word.isascii() and len(word) > 2 else 0.6)


def _words_of(name: str, spellings: list[str] | None) -> set[str]:
    return {w for x in (name, *(spellings or [])) if x for w in re.findall(r"[^\W_]+\+?", fold(x))}


def decorations(values: DataFrame, reference: DataFrame, share: float = 0.15, block: int = BLOCK, only: list[tuple[str, str, list[str]]] | None = None) -> dict[str, frozenset[str]]:
    """Endings, by field, that follow spellings of at least ``share`` of all entries (two at least).

    ``values``: (field, value). Endings within an edit of a word of the
    reference list are misspelt parts of names and don't count. An ending
    needs that many entries to vote for it, so few can come of it. Blocks of
    the reference vote together: of all blocks the longest spelling counts.
    ``only`` is the reference where it is one block, so it isn't read again.
    """
    r = reference.where("field is not null and name is not null")
    if only is not None:
        names = {f: {n for g, n, _ in only if g == f} for f in {e[0] for e in only}}
        sizes = {f: len(n) for f, n in names.items()}
    else:
        sizes = {x["field"]: x["n"] for x in r.groupBy("field").agg(F.countDistinct("name").alias("n")).toLocalIterator()}
    least = {f: max(2, math.ceil(share * n)) for f, n in sizes.items()}

    def vote(dictionaries: dict[str, Dictionary], field: str, value: str) -> list[tuple]:
        p = dictionaries[field].prefix(value)
        return [(p[1], p[2], n) for n in p[0]] if p else []

    found = _in_blocks(values, r, block, only, vote, "field string, value string, length int, ending string, name string", 1)
    longest = found.groupBy("field", "value").agg(F.max("length").alias("l"), F.max_by("ending", "length").alias("ending"), F.collect_set(F.struct("length", "name")).alias("by")).where("ending <> ''")
    votes = longest.select("field", "ending", F.explode(F.filter("by", lambda x: x["length"] == F.col("l"))).alias("x")).groupBy("field", "ending").agg(F.countDistinct("x.name").alias("n"))
    votes = votes.where(F.col("n") >= F.coalesce(*[F.when(F.col("field") == f, k) for f, k in least.items()], F.lit(2)))
    ends: dict[str, set[str]] = defaultdict(set)
    for x in votes.toLocalIterator():
        ends[x["field"]].add(x["ending"])
    if not ends:
        return {}
    if only is not None:
        for field, w in {(f, w) for f, n, spellings in only if f in ends for w in _words_of(n, spellings)}:
            ends[field] -= {e for e in ends[field] if _near_word(e, w)}
        return {f: frozenset(v) for f, v in ends.items()}

    def words(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            near: set[tuple[str, str]] = set()
            seen: set[tuple[str, str]] = set()
            for f, n, spellings in zip(*(c.to_pylist() for c in b.columns)):
                for w in _words_of(n, spellings):
                    if f in ends and (f, w) not in seen:
                        seen.add((f, w))
                        near |= {(f, e) for e in ends[f] if _near_word(e, w)}
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in near], pa.string()) for k in (0, 1)], ["field", "ending"])

    for x in r.select("field", "name", "spellings").mapInArrow(words, "field string, ending string").distinct().toLocalIterator():
        ends[x["field"]].discard(x["ending"])
    return {f: frozenset(v) for f, v in ends.items()}


def match_values(values: DataFrame, reference: DataFrame, *, max_edits: int = 2, share: float = 0.15, margin: float = 0.2, outnumber: int = 1000, block: int = BLOCK) -> DataFrame:
    """(field, value, name, cost): the entry meant by each distinct value, or UNMATCHED.

    ``values``: field, value, n (how often it occurs); ``reference``: field,
    name, spellings. The best entry is taken if the next one costs at least
    ``margin`` more or is ``outnumber`` times rarer in the data; otherwise the
    value doesn't single one out. Null, empty and unreadable values and fields
    without a list are UNMATCHED; of repeated rows one result comes out. The
    dictionary is broadcast in blocks of ``block`` entries, whose size changes
    no result: endings are learned over all blocks, and an exact spelling in
    one block overrules near ones in others.
    """
    values = cut(values.select("field", "value", "n").groupBy("field", "value").agg(F.sum("n").alias("n")))
    only = _only_block(reference, block)
    ends = decorations(values, reference, share, block, only)

    def look(dictionaries: dict[str, Dictionary], field: str, value: str) -> list[tuple]:
        best, exact = dictionaries[field].reach(value, ends.get(field, frozenset()))
        return [(n, c, exact) for n, c in best.items()]

    found = cut(_in_blocks(values, reference, block, only, look, "field string, value string, name string, cost double, exact boolean", max_edits))
    often = found.where("cost = 0").join(values, ["field", "value"]).groupBy("field", "name").agg(F.sum("n").alias("often"))
    ranked = found.join(often, ["field", "name"], "left").groupBy("field", "value").agg(F.bool_or("exact").alias("exact"), F.sort_array(F.collect_set(F.struct("cost", (-F.coalesce("often", F.lit(0))).alias("rare"), "name", "exact"))).alias("c"))
    # a name may be offered by several blocks: its least cost counts
    ranked = ranked.select("field", "value", F.filter("c", lambda x: x["exact"] == F.col("exact")).alias("c"))
    ranked = ranked.withColumn("c", F.filter("c", lambda x, i: F.array_position(F.transform("c", lambda y: y["name"]), x["name"]) == i + 1))
    a, b = F.get("c", F.lit(0)), F.get("c", F.lit(1))
    single = b.isNull() | (b["cost"] - a["cost"] >= margin) | (a["rare"] <= b["rare"] * outnumber) & (a["rare"] < 0)
    best = ranked.where(single).select(F.col("field").alias("f"), F.col("value").alias("v"), a["name"].alias("name"), a["cost"].alias("cost"))
    on = (F.col("field") == F.col("f")) & (F.col("value") == F.col("v"))
    return values.join(best, on, "left").select("field", "value", F.coalesce("name", F.lit(UNMATCHED)).alias("name"), "cost")


def map_column_values(rows: DataFrame, row_id: str, fields: list[str], reference: DataFrame, **options) -> DataFrame:
    """(row id, field, name) for each row and field whose value isn't itself a listed name; once per id.

    Values are matched once each, however many rows hold them, and joined
    back; where one value holds a large share of the rows the join's skewed
    partition is split at run time. If rows of one id differ in a field, each
    differing value has its row. A null value is UNMATCHED.
    """
    long = rows.select(F.col(row_id).alias("__id"), F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("value")) for f in fields])).alias("x")).select("__id", "x.*")
    listed = reference.select("field", F.col("name").alias("value")).distinct()
    values = long.groupBy("field", "value").agg(F.count(F.lit(1)).alias("n"))
    matched = match_values(values, reference, **options)
    missed = long.join(listed, ["field", "value"], "left_anti").distinct()
    m = matched.select(F.col("field").alias("f"), F.col("value").alias("v"), "name")
    joined = missed.join(m, (F.col("field") == F.col("f")) & F.col("value").eqNullSafe(F.col("v")), "left")
    return joined.select(F.col("__id").alias(row_id), "field", F.coalesce("name", F.lit(UNMATCHED)).alias("name")).distinct()
