"""Linking variant spellings of organisations' names.

A name is read into its core and its line of business, whatever its script,
legal form, order, layout or punctuation. Lines of business and their spellings
are learned from the established names: see ``learn_trades``. Cores are then compared by a
pigeonhole segment join: a core cut into k+1 segments keeps at least one of
them whole under k edits, so names are looked up by position-shifted
substrings in an inverted index of segments, and candidates are verified by a
banded edit distance. Hangul cores are compared syllable by syllable, Latin
ones letter by letter against the romanised core.

Each rarer spelling follows the nearest established one (a known name, or one
that is written more often), so two established names that look alike stay
apart, and like names are never chained together.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.functions import hangul
from weftline.llm.freevalues import distance, fold
from weftline.llm.lookalikes import plain_rewriter
from weftline.operators.lineage import cut, spread

# Legal forms, after NFKC and in lower case, and words put before or after names.
LEGAL = re.compile(r"주식회사|유한회사|재단법인|사단법인|협동조합|\(\s*(?:주|유|재|사|협)\s*\)|^\s*(?:주|유|재|협)\s*\)|(?<![a-z])(?:co\.?\s*,?\s*ltd|inc|corp|ltd|llc|limited)(?![a-z])\.?")
BEFORE, AFTER = ("구", "우리", "舊"), ("쪽", "네")
#: Latin text that reads as romanised Hangul throughout.
_ROMANISED = re.compile(f"(?:(?:{'|'.join(sorted(filter(None, hangul.INITIAL_LATIN), key=lambda x: -len(x)))})?(?:{'|'.join(sorted(hangul.VOWEL_LATIN, key=lambda x: -len(x)))})(?:ng|[knltmp])?)+")
_SPACES = re.compile(r"[^\w&]+|_")


def _words(text: str) -> list[str]:
    """Words of a name in one form, without legal forms and words put before."""
    plain = plain_rewriter()(text)
    # Hangul typed on a Latin layout: a long run that turns into syllables entirely
    for run in re.findall(r"[A-Za-z]{8,}", plain):
        typed = hangul.from_keys(run)
        if not re.search(r"[A-Za-z]", typed) and not _ROMANISED.fullmatch(run.lower()):
            plain = plain.replace(run, typed)
    words = [w for w in _SPACES.sub(" ", LEGAL.sub(" ", fold(plain))).split() if w]
    while len(words) > 1 and words[0] in BEFORE:
        words.pop(0)
    return words


def _script(core: str) -> str:
    return "h" if any("가" <= ch <= "힣" for ch in core) else "l"


class Reader:
    """Reads names, given spellings of lines of business: spelling -> line."""

    def __init__(self, trades: dict[str, str] | None = None) -> None:
        self.trades = trades or {}
        by_length = sorted(self.trades, key=lambda t: (-len(t), t))
        self.korean, self.latin = [t for t in by_length if _script(t) == "h"], [t for t in by_length if _script(t) == "l"]
        self.memo: dict[str, tuple[str, str, str]] = {}

    def __call__(self, text: str) -> tuple[str, str, str]:
        """(core, trade or '', script 'h' or 'l'); empty core for unreadable names."""
        if (known := self.memo.get(text)) is None:
            if len(self.memo) > 100_000:
                self.memo.clear()
            known = self.memo[text] = self._read(text)
        return known

    def _read(self, text: str) -> tuple[str, str, str]:
        words, trade = _words(text), ""
        for i in (len(words) - 1, 0):
            if len(words) > 1 and (t := self.trades.get(words[i])):
                trade = t
                words.pop(i)
                break
        core = "".join(words)
        if not trade:
            core, trade = self._attached(core)
        if not trade and core.endswith(AFTER) and len(core) > 3:
            core = core[:-1]
        core = re.sub(r"\W", "", core)
        return core, trade, _script(core)

    def _attached(self, core: str) -> tuple[str, str]:
        for t in self.korean:
            if core.endswith(t) and len(core) - len(t) >= 2:
                return core[: -len(t)], self.trades[t]
        for t in self.latin:
            head = core[: -len(t)]
            if core.endswith(t) and len(head) >= 2 and (len(t) > 3 and len(head) > 5 or "가" <= head[-1] <= "힣"):
                return head, self.trades[t]
        for t in self.korean:
            if core.startswith(t) and len(core) - len(t) >= 3:
                return core[len(t) :], self.trades[t]
        return core, ""


#: Longest ending that is taken for a line of business.
ENDING = 7


def units(counts: dict[str, int], least: float, top: float = 0.25) -> set[str]:
    """Endings that are words of their own: what stands before them varies.

    ``counts``: names by ending, for endings of every length. From the last
    character on an ending is drawn out as long as one character in front of
    it makes up more than ``top`` of its names.
    """
    longer: dict[str, list[str]] = {}
    for e in counts:
        longer.setdefault(e[1:], []).append(e)
    out, todo = set(), [e for e in longer.get("", []) if counts[e] >= least]
    while todo:
        e = todo.pop()
        before = longer.get(e, [])
        if max((counts[b] for b in before), default=0) <= top * counts[e] + 1.5:
            out |= {e} if len(e) > 1 else set()
        else:
            todo += [b for b in before if counts[b] >= least]
    return out


def learn_trades(known: DataFrame, names: DataFrame, *, share: float = 0.005, least: int = 3, sure: float = 0.6) -> Reader:
    """Reader with the lines of business that the names of ``known`` (name) end in and their spellings in ``names`` (name).

    A line of business is an ending of Hangul that ``share`` of the different
    known names have (``least`` at least), see ``units``. Another spelling of
    it, in any script, is what stands beside the core of known names of that
    line: a word beside it or the rest behind it, for ``least`` different
    cores, and in ``sure`` of the cases the same line. What reaches the driver
    is bounded by the shares: at most 4 * ENDING / share endings.
    """
    plain = lambda df: df.select(F.col("name").cast("string").alias("name")).where("name is not null").distinct()

    def compact(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array(["".join(_words(t)) for t in b.column(0).to_pylist()], pa.string())], ["s"])

    def tails(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = [t[-n:] for t in b.column(0).to_pylist() for n in range(1, min(ENDING, len(t) - 2) + 1) if all("가" <= ch <= "힣" for ch in t[-n:])]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], ["e"])

    forms = cut(plain(known).mapInArrow(compact, "s string").where("s <> ''").distinct())
    total = forms.agg(F.greatest(F.lit(float(least)), share * F.count(F.lit(1))).alias("enough"))
    often = forms.mapInArrow(tails, "e string").groupBy("e").agg(F.count(F.lit(1)).alias("n")).join(F.broadcast(total), F.col("n") >= F.col("enough") / 4).collect()
    enough = often[0]["enough"] if often else least
    lines = {e: e for e in units({r["e"]: r["n"] for r in often}, enough)}
    first = Reader(lines)

    def keys(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = {(key, trade) for t in b.column(0).to_pylist() for core, trade, script in [first(t)] if trade for _, key in _keys(core, script)}
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], pa.string()) for k in (0, 1)], ["head", "trade"])

    def beside(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = set()
            for t in b.column(0).to_pylist():
                words = _words(t)
                s = "".join(words)
                if first(t)[1]:
                    continue
                out |= {(s[:i], s[i:]) for i in range(2 if _script(s) == "h" else 5, len(s)) if len(s) - i <= 3 * ENDING}
                if len(words) > 1:
                    out |= {("".join(words[1:]), words[0]), ("".join(words[:-1]), words[-1])}
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], pa.string()) for k in (0, 1)], ["head", "tail"])

    votes = plain(names).mapInArrow(beside, "head string, tail string").distinct().join(forms.mapInArrow(keys, "head string, trade string").distinct(), "head")
    votes = votes.groupBy("tail", "trade").agg(F.count(F.lit(1)).alias("n"))
    best = votes.groupBy("tail").agg(F.max(F.struct("n", "trade")).alias("b"), F.sum("n").alias("all")).where((F.col("b.n") >= max(least, enough / 10)) & (F.col("b.n") >= sure * F.col("all")))
    spelled = {r["tail"]: r["trade"] for r in best.select("tail", "b.trade").toLocalIterator()}
    return Reader({**{t: line for t, line in spelled.items() if len(t) > 1}, **lines})


def segments(key: str, k: int) -> list[tuple[int, str]]:
    """``key`` cut into k+1 even pieces: (start, piece)."""
    n = len(key)
    cuts = [n * i // (k + 1) for i in range(k + 2)]
    return [(a, key[a:b]) for a, b in zip(cuts, cuts[1:])]


def probes(key: str, k: int) -> Iterator[tuple[int, int, int, str]]:
    """(length of the other key, its segment's number, place, substring) that a key within k edits can match."""
    for n in range(max(1, len(key) - k), len(key) + k + 1):
        cuts = [n * i // (k + 1) for i in range(k + 2)]
        for number, (a, b) in enumerate(zip(cuts, cuts[1:])):
            for at in range(max(0, a - k), min(len(key) - (b - a), a + k) + 1):
                if b > a:
                    yield n, number, at, key[at : at + b - a]


def banded(a: str, b: str, k: int) -> int:
    """Edits between a and b with adjacent transpositions as one, in a band of k; k + 1 beyond."""
    if abs(len(a) - len(b)) > k:
        return k + 1
    far = k + 1
    before: dict[int, int] = {}
    row = {j: j for j in range(min(len(b), k) + 1)}
    for i in range(1, len(a) + 1):
        new: dict[int, int] = {}
        for j in range(max(0, i - k), min(len(b), i + k) + 1):
            if j == 0:
                new[0] = i
                continue
            best = min(row.get(j, far) + 1, new.get(j - 1, far) + 1, row.get(j - 1, far) + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                best = min(best, before.get(j - 2, far) + 1)
            new[j] = best
        if min(new.values()) > k and min(row.values()) > k:
            return far
        before, row = row, new
    return min(far, row.get(len(b), far))


#: Edits allowed in Hangul cores (syllables) and Latin ones (letters). A transposition spoils both segments only across their
#: border: Hangul cores are found by their sorted form then, Latin ones by the form with the two letters at the border swapped.
K = 1
#: Letters from which on Latin cores within the edits allowed are one name.
LATIN = 6


def cost(script: str, a: str, b: str) -> float | None:
    """How far apart two cores are, None if they are different names."""
    if a == b:
        return 0.0
    if script == "h":
        # one changed jamo, one doubled syllable or one transposition
        w = distance(a, b, 0.75)
        return w if w <= 0.75 else None
    return 0.8 if min(len(a), len(b)) >= LATIN and banded(a, b, K) == 1 else None


def _keys(core: str, script: str) -> list[tuple[str, str]]:
    """Keys under which a core is found: Hangul, and its Latin reading."""
    return [("h", core), ("l", hangul.to_latin(core))] if script == "h" else [("l", core)]


def _swapped(key: str) -> str:
    """``key`` with the two letters at the border of its segments swapped."""
    at = len(key) // 2
    return key[: at - 1] + key[at] + key[at - 1] + key[at + 1 :]


def _open(syllable: str) -> list[str]:
    """A syllable with each of its jamo left open: one changed jamo leaves a lone syllable no segment to meet in."""
    jamo = hangul.split(syllable)
    return [".".join("?" if i == k else str(j) for i, j in enumerate(jamo)) for k in range(3)] if jamo else []


#: Keys under one segment from which on what is left of them must nearly agree, too.
CROWDED = 1000
_GAP = "\x01"


def without(rest: str, k: int) -> set[str]:
    """``rest`` with up to k characters deleted. Two rests within k edits have one in common."""
    out = last = {rest}
    for _ in range(k):
        last = {s[:i] + s[i + 1 :] for s in last for i in range(len(s)) if s[i] != _GAP}
        out = out | last
    return out


def segment_join(left: DataFrame, right: DataFrame, crowded: int = CROWDED) -> DataFrame:
    """(l, r, cost) of keys of ``left`` and ``right`` (id, core, trade, script) within the edits allowed.

    Keys meet only within a trade; a left name without one meets all. Names
    of one script meet as they are, those of two by their Latin reading. Index
    and probes are hashed, joined and verified where they meet; neither side
    is broadcast by hand or gathered. A segment that more than ``crowded``
    keys share would make all of them meet: there a key is looked up by the
    segment together with each form of its rest with up to k characters
    deleted, which loses no pair within k edits.
    """

    def index(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for i, core, trade, script in zip(*(c.to_pylist() for c in b.columns)):
                # n: Latin cores, as Hangul ones look them up
                for kind, key in [*_keys(core, script), *([("n", core)] if script == "l" else [])]:
                    for block in ("*", trade) if trade else ("*",):
                        out.append((f"{block}|{kind}|=|{key}", i, key, None))
                        if kind == "h":
                            out.append((f"{block}|{kind}|~|{''.join(sorted(key))}", i, key, None))
                            out += [(f"{block}|{kind}|?|{form}", i, key, None) for form in (_open(key) if len(key) == 1 else ())]
                        if kind == "h" or len(key) >= LATIN:
                            out += [(f"{block}|{kind}|{len(key)}.{n}|{s}", i, key, key[:a] + _GAP + key[a + len(s) :]) for n, (a, s) in enumerate(segments(key, K)) if s]
            yield _batch(out)

    def probe(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for i, core, trade, script in zip(*(c.to_pylist() for c in b.columns)):
                block = trade or "*"
                for kind, key in (("h", core), ("n", hangul.to_latin(core))) if script == "h" else (("l", core),):
                    out.append((f"{block}|{kind}|=|{key}", i, key, None))
                    if kind == "h":
                        out.append((f"{block}|{kind}|~|{''.join(sorted(key))}", i, key, None))
                        out += [(f"{block}|{kind}|?|{form}", i, key, None) for form in (_open(key) if len(key) == 1 else ())]
                    elif len(key) >= LATIN:
                        out.append((f"{block}|{kind}|=|{_swapped(key)}", i, key, None))
                    if kind == "h" or len(key) >= LATIN:
                        out += [(f"{block}|{kind}|{n}.{number}|{s}", i, key, key[:at] + _GAP + key[at + len(s) :]) for n, number, at, s in probes(key, K) if kind == "h" or n >= LATIN]
            yield _batch(out)

    def _batch(rows: list[tuple]) -> pa.RecordBatch:
        rows = list(dict.fromkeys(rows))
        kinds = (pa.string(), pa.int64(), pa.string(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], ["at", "i", "key", "rest"])

    def spread(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = [(f"{h}|{v}", i, key, s) for h, i, key, s, rest in zip(*(c.to_pylist() for c in b.columns)) for v in without(rest, K)]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate((pa.string(), pa.int64(), pa.string(), pa.string()))], ["at", "i", "key", "s"])

    def verify(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ok = [(x, y, w) for x, y, s, p, q in zip(*(c.to_pylist() for c in b.columns)) if (w := cost(s, p, q)) is not None]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in ok], pa.int64()), pa.array([r[1] for r in ok], pa.int64()), pa.array([r[2] for r in ok], pa.float64())], ["l", "r", "cost"])

    cols = ["id", "core", "trade", "script"]
    # places are compared by 64-bit hashes: the few pairs that meet by chance fail verification
    place = lambda df, f: df.select(*cols).mapInArrow(f, "at string, i long, key string, rest string").select(F.xxhash64("at").alias("h"), "i", "key", F.split_part("at", F.lit("|"), F.lit(2)).alias("s"), "rest")
    x, y = place(left, probe), cut(place(right, index))
    full = y.where("rest is not null").groupBy("h").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > crowded).select("h")
    meet = lambda x, y: x.select("h", F.col("i").alias("l"), F.col("key").alias("lk"), "s").join(y.select("h", F.col("i").alias("r"), F.col("key").alias("rk")), "h").where("l <> r").select("l", "r", "s", "lk", "rk")
    if full.take(1):
        full = cut(full)
        finer = lambda df: df.join(full, "h", "left_semi").where("rest is not null").select("h", "i", "key", "s", "rest").mapInArrow(spread, "at string, i long, key string, s string").select(F.xxhash64("at").alias("h"), "i", "key", "s")
        met = meet(x, y.join(full, "h", "left_anti")).unionByName(meet(finer(x), finer(y))).distinct()
    else:
        met = meet(x, y).distinct()
    return met.mapInArrow(verify, "l long, r long, cost double").groupBy("l", "r").agg(F.min("cost").alias("cost"))


def read_names(df: DataFrame, columns: list[str], text: str, reader: Reader) -> DataFrame:
    """columns of ``df`` and core, trade, script of ``text``; null and unreadable texts have an empty core."""
    rows = df.select(*columns, F.coalesce(F.col(text).cast("string"), F.lit("")).alias("__t"))
    at = rows.columns.index("__t")
    trades = reader.trades

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = Reader(trades)
        for b in batches:
            names = [read(t) for t in b.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[:at], *(pa.array([r[k] for r in names], pa.string()) for k in range(3))], [*b.schema.names[:at], "core", "trade", "script"])

    fields = ", ".join(f"`{c}` {t}" for c, t in rows.dtypes if c != "__t")
    return rows.mapInArrow(run, f"{fields}{', ' if fields else ''}core string, trade string, script string")


def establish(names: DataFrame, known: DataFrame) -> DataFrame:
    """(core, trade, script, n, to_core, to_trade): the established name that each distinct name stands for.

    ``names``: core, trade, script, n; ``known``: core, trade of established
    names. A known name stands for itself; another follows the nearest known
    name within reach, else the nearest that is written more often, else
    itself. A name without a trade follows only if one trade alone is in
    reach; of names equally near the one written more often counts.
    """
    known = known.select("core", "trade").where("core <> ''").distinct().withColumn("known", F.lit(1))
    spelled = names.where("core <> ''").groupBy("core", "trade", "script").agg(F.sum("n").alias("n"))
    # a short core whose ending only looks like a trade is the whole core of a name without one
    spelled = cut(spelled.join(known, ["core", "trade"], "left").withColumn("whole", F.col("known").isNull() & (F.length("core") <= 2) & (F.col("script") == "h")).select(F.col("core").alias("own_core"), F.col("trade").alias("own_trade"), F.when(F.col("whole"), F.concat("core", "trade")).otherwise(F.col("core")).alias("core"), F.when(F.col("whole"), "").otherwise(F.col("trade")).alias("trade"), "script", "n"))
    own = spelled.groupBy("core", "trade", "script").agg(F.sum("n").alias("n"))
    nodes = own.join(known, ["core", "trade"], "full")
    nodes = nodes.select("core", "trade", F.coalesce("script", F.when(F.col("core").rlike("[가-힣]"), "h").otherwise("l")).alias("script"), F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("known", F.lit(0)).alias("known"))
    # numbers that stand for names: hashes, of another seed where two names should share one
    for seed in range(100):
        numbered = cut(nodes.withColumn("id", F.xxhash64(F.lit(seed), "core", "trade")))
        if not numbered.groupBy("id").agg(F.count(F.lit(1)).alias("k")).where("k > 1").take(1):
            break
    nodes = numbered
    # the copy of few names is one file: keys and probes are made on all cores
    pairs = segment_join(spread(nodes.where("known = 0"), "id"), spread(nodes, "id"))
    side = lambda p: nodes.select(F.col("id").alias(p), F.col("n").alias(f"{p}n"), F.col("known").alias(f"{p}known"), F.col("trade").alias(f"{p}trade"), F.col("script").alias(f"{p}script"))
    up = pairs.join(side("l"), "l").join(side("r"), "r").where("rknown = 1 or rn > ln or (rn = ln and r < l)").where("rtrade <> '' or ltrade = ''")
    # Hangul follows a Latin spelling only if no Hangul one is in reach: both spellings of one name are no two names
    up = up.withColumn("across", (F.col("lscript") == "h") & (F.col("rscript") == "l"))
    alone = up.groupBy("l").agg(F.min("across").alias("only"))
    up = up.join(alone, "l").where(F.col("across") == F.col("only"))
    ranked = up.groupBy("l", "ltrade").agg(
        F.min(F.struct((1 - F.col("rknown")).alias("a"), F.round("cost", 3).alias("b"), (-F.col("rn")).alias("c"), "r")).alias("best"),
        F.countDistinct(F.when((F.col("cost") == 0) & (F.col("rtrade") != ""), F.col("r"))).alias("exact"),
        F.countDistinct(F.when(F.col("rtrade") != "", F.col("r"))).alias("all"),
    )
    # without a trade: an exact core beats near ones, and must be single
    ranked = ranked.where("ltrade <> '' or exact = 1 or (exact = 0 and `all` = 1)")
    parent = cut(nodes.join(ranked.select(F.col("l").alias("id"), F.col("best.r").alias("to")), "id", "left").select("id", F.coalesce("to", "id").alias("to")))
    # parents are strictly stronger, so following them ends; every round doubles the distance followed
    while True:
        hop = parent.select(F.col("id").alias("to"), F.col("to").alias("further"))
        new = cut(parent.join(hop, "to", "left").select("id", F.coalesce("further", "to").alias("new"), "to"))
        moved = new.where(F.col("new") != F.col("to")).limit(1).count()
        parent = new.select("id", F.col("new").alias("to"))
        if not moved:
            break
    ends = nodes.select(F.col("id").alias("to"), F.col("core").alias("to_core"), F.col("trade").alias("to_trade"))
    led = nodes.where("n > 0").join(parent, "id").join(ends, "to").select("core", "trade", "to_core", "to_trade")
    return spelled.join(led, ["core", "trade"]).select(F.col("own_core").alias("core"), F.col("own_trade").alias("trade"), "script", "n", "to_core", "to_trade")


def link_variants(names: DataFrame, row_id: str, spellings: list[str], known: DataFrame, known_name: str, known_id: str | None = None, row_known_id: str | None = None, reader: Reader | None = None) -> DataFrame:
    """(row_id, core, trade): the established name each row of ``names`` stands for.

    The first of ``spellings`` that can be read counts; a later one replaces
    it where it reads as a known name and the first does not. ``known`` lists
    established names; rows that carry the id of one (``row_known_id``) stand
    for it. Rows with null, empty or unreadable spellings are left out, unless
    they carry such an id. Equal rows under one id count once. ``reader`` may
    name the lines of business; they are learned from ``known`` otherwise.
    """
    spelled = names.select(F.explode(F.array(*[F.col(c).cast("string") for c in spellings])).alias("name"))
    reader = reader or learn_trades(known.select(F.col(known_name).alias("name")), spelled)
    k = cut(read_names(known, [F.col(known_id).alias("kid")] if known_id else [F.lit(None).cast("long").alias("kid")], known_name, reader).where("core <> ''"))
    rows = names.select(F.col(row_id).alias("id"), *([F.col(row_known_id).alias("kid")] if row_known_id else [F.lit(None).cast("long").alias("kid")]), F.posexplode(F.array(*[F.col(c).cast("string") for c in spellings])).alias("at", "t")).where(F.col("t").isNotNull()).distinct()
    read = cut(read_names(rows, ["id", "kid", "at"], "t", reader).where("core <> ''"))
    is_known = k.select("core", "trade").distinct().withColumn("known", F.lit(1))
    best = read.join(is_known, ["core", "trade"], "left").groupBy("id", "kid").agg(F.min(F.struct((1 - F.coalesce("known", F.lit(0))).alias("a"), "at", "core", "trade", "script")).alias("b")).select("id", "kid", "b.core", "b.trade", "b.script")
    best = cut(best)
    by_id = k.where(F.col("kid").isNotNull()).select("kid", F.col("core").alias("kcore"), F.col("trade").alias("ktrade")).distinct()
    names_ = best.groupBy("core", "trade", "script").agg(F.count(F.lit(1)).alias("n"))
    to = establish(names_, k).select("core", "trade", "to_core", "to_trade")
    out = best.join(to, ["core", "trade"], "left").join(by_id, "kid", "left")
    return out.select(F.col("id").alias(row_id), F.coalesce("kcore", "to_core").alias("core"), F.coalesce("ktrade", "to_trade").alias("trade")).distinct()


def variant_pairs(linked: DataFrame, row_id: str) -> DataFrame:
    """All pairs a < b of rows that stand for one name, as <row_id>_a and <row_id>_b."""
    a = linked.select("core", "trade", F.col(row_id).alias(f"{row_id}_a"))
    b = linked.select("core", "trade", F.col(row_id).alias(f"{row_id}_b"))
    return a.join(b, ["core", "trade"]).where(F.col(f"{row_id}_a") < F.col(f"{row_id}_b")).select(f"{row_id}_a", f"{row_id}_b").distinct()
