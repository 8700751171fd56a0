"""Per-document text quality: statistics, and lines labelled by a hidden Markov model.

Every line is prose, list, table or junk. Its statistics (shares of letters,
digits, symbols, foreign characters, sentence ends, particles, common words
and so on), each cut into a few levels, are the observations of a hidden
Markov model whose states are the four labels; the levels are taken as
independent given the state and the prevailing script.

Lines that plain signs can tell seed the model, once: their levels and
successions are counted over all documents. From there on the model knows
levels only. It is estimated again from the expected counts of the forward-
backward algorithm over all documents, and a line's label is the state of
greatest posterior probability. Only these counts, some 1,500 numbers whatever
the corpus, reach the driver; they are whole numbers, so they don't depend on
how the documents are partitioned.

Nearly all statistics are sums over a line's words. A word is looked at once
for each time a worker meets it anew; lines are sums of rows in numpy.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.operators.lineage import cut, spread

STATES = ("prose", "list", "table", "junk")
PROSE, LIST, TABLE, JUNK, UNKNOWN = range(5)
K = len(STATES)

# Syllables Korean sentences and clauses end in, and particles.
KO_END = re.compile(r"(?:[다요까죠네]|시오|음|함|것은|[나가]요|[인는은]가)[)\"'”’]*[.!?~…\u3002]*[ㅎㅋㅠㅜ^~!]*$")
KO_PARTICLE = re.compile(r"[가-힣](?:은|는|이|가|을|를|에|의|로|도|만|고|서|면|데|며|지|와|과|께|한|할|던|게|인|쯤|까지|부터|에서|지만|려고|으로|하고|처럼|보다|라고)[,.]?$")
CLOSING = re.compile(r"[.!?~…。！？．][)\"'”’]*$")
BULLET = re.compile(r"\s*(?:[-·•▶▷*+○●◦–—■□◆◇★☆#]|\d{1,3}[.)]|[①-⑳]|\[[^\]]*\]) ?\S")
KEY_VALUE = re.compile(r"\s*\S{1,12}(?: \S{1,8})?\s*[:=]\s*\S+(?: \S+)?\s*$")
COUNTER = re.compile(r"\[\d+\]$")
LINK = re.compile(r"(?:https?://|www\.)\S")
HEX = re.compile(r"\b(?=[0-9a-f]*\d)(?=[0-9a-f]*[a-f])[0-9a-f]{16,}\b|\b[A-Za-z0-9+/]{40,}={0,2}")
LOG = re.compile(r"\s*(?:\[?\d{4}-\d\d-\d\d[T ])?\d\d:\d\d:\d\d|\b(?:INFO|WARN|ERR|ERROR|DEBUG)\b")
TAG = re.compile(r"</?[a-zA-Z][^<>]*>")
ENTITY = re.compile(r"&#?\w+;|%[0-9A-F]{2}|�")
GAPS = re.compile(r"\S {2,}\S")
CONSONANTS = re.compile(r"[bcdfghjklmnpqrstvwxz]{4,}")
VOWELS = re.compile("[aeiouyáé]")
LATIN = re.compile(r"[A-Za-zÀ-ÖØ-öø-ɏ]+")
EDGE = re.compile(r"^\W+|\W+$")
# The kinds of characters that words are made of, and marks of amusement after a sentence.
NOT_HANGUL, NOT_LATIN, NOT_DIGIT, NOT_JAMO = (re.compile(f"[^{k}]+") for k in ("가-힣", "A-Za-záéÁÉ", "0-9", "ㄱ-ㅣ"))
NOT_SYMBOL = re.compile(r"[^!-/:-@\[-`{-~]+")
PLAIN = re.compile(r"[가-힣!-~ㄱ-ㅣáéÁÉ“”‘’…·\x00-\x1f\x7f]+")
NOT_DELIMITER = re.compile(r"[^,|;:=<>{}\"#\[\]·/]+")
REPEATED = re.compile(r"([.!?~…^])\1{2,}")
AMUSED = re.compile(r"[ㅎㅋㅠㅜ~!.^?😀-🙏]+$")
QUOTATION = re.compile(r"(?m)(^[ \t]*>[^\n]*)((?:\n[ \t]*>[^\n]*)+)")

#: What a word adds to its line.
WORD = ["n", "hangul", "latin", "digit", "jamo", "symbol", "odd", "hit", "ko", "particle", "end", "closing", "runs", "lower", "garbled", "delimiters", "entities", "mark", "hash", "cells", "long_cell", "hex", "link", "finish", "count", "amused"]
_AT = {name: i for i, name in enumerate(WORD)}
#: Upper ends of the levels of each statistic; a statistic has at most 8 levels.
CUTS = {
    "hangul": (0.02, 0.3, 0.6, 0.85), "latin": (0.02, 0.3, 0.6, 0.9), "digit": (0.0, 0.08, 0.2, 0.4), "symbol": (0.01, 0.06, 0.12, 0.25, 0.5), "odd": (0.0, 0.05, 0.2, 0.5),
    "common": (0.0, 0.12, 0.25, 0.42, 0.58, 0.75), "together": (0.0, 0.15, 0.3, 0.5), "particles": (-0.5, 0.1, 0.25, 0.45), "ends": (0.0, 0.04, 0.12, 0.25), "closing": (0.0, 0.03, 0.08, 0.2),
    "lower": (-0.5, 0.2, 0.6, 0.9), "garbled": (-0.5, 0.05, 0.25, 0.5), "delimiters": (0.0, 0.12, 0.3, 0.7, 1.5), "words": (1, 3, 6, 10, 25), "length": (2.2, 3.2, 4.6, 6.5, 10),
    "bullet": (0,), "last": (0,), "layout": (0, 1), "marks": (0.0, 0.08, 0.15, 0.3), "hashes": (0.0, 0.3, 0.6), "jamo": (0.0, 0.1, 0.4), "sign": (0, 1, 2, 3, 4, 5, 6),
}
FEATURES = len(CUTS)
#: Expected counts are kept in whole units of this, so that their sums don't depend on their order.
UNIT = 1 << 10
#: Characters of texts that are observed at a time, and distinct words a worker remembers.
CHUNK, MEMORY = 2_000_000, 200_000


class Words(dict):
    """Number of each word's row; rows are what words add to their lines."""

    def __init__(self, common: frozenset[str]) -> None:
        super().__init__()
        self.common, self.new, self.rows = common, [], np.zeros((0, len(WORD)), np.int32)

    def __missing__(self, word: str) -> int:
        at = self[word] = len(self)
        self.new.append(self.look(word))
        return at

    def look(self, raw: str) -> list[int]:
        w = raw if raw.isascii() else "".join(ch for ch in unicodedata.normalize("NFC", raw) if unicodedata.category(ch) != "Cf")
        w = REPEATED.sub(r"\1\1\1", w)
        hangul, latin, digit, jamo = (len(k.sub("", w)) for k in (NOT_HANGUL, NOT_LATIN, NOT_DIGIT, NOT_JAMO))
        rest = PLAIN.sub("", w)
        hit = EDGE.sub("", w).lower() in self.common
        # frequent words tell nothing of sentences: heaps are made of them
        ko = hangul > 0 and not hit
        runs = LATIN.findall(w)
        garbled = sum(bool(CONSONANTS.search(x.lower())) and len(x) > 4 or len(x) > 3 and not VOWELS.search(x.lower()) for x in runs)
        finish = bool(KO_END.search(AMUSED.sub("", w)) or CLOSING.search(w))
        end = ko and bool(KO_END.search(w))
        symbol = len(NOT_SYMBOL.sub("", w)) + sum(not ch.isalnum() for ch in rest)
        return [len(w), hangul, latin, digit, jamo, symbol, len(rest), hit, ko, ko and bool(KO_PARTICLE.search(w)), end, bool(CLOSING.search(w)), len(runs), sum(x.islower() for x in runs), garbled,
                len(NOT_DELIMITER.sub("", w)), len(ENTITY.findall(w)), w in "|>·", w[:1] == "#", w.count(","), 0, bool(HEX.search(w)), bool(LINK.search(w)), finish, bool(COUNTER.search(w)), not AMUSED.sub("", w)]

    def matrix(self) -> np.ndarray:
        if self.new:
            self.rows, self.new = np.concatenate([self.rows, np.array(self.new, dtype=np.int32)]), []
        return self.rows


def lines_of(text: str) -> list[str]:
    """Lines that hold more than white space; a quotation is one line, however its lines were broken."""
    if "\n>" in text or "\n " in text and ">" in text:
        text = QUOTATION.sub(lambda m: m[1] + re.sub(r"\n[ \t]*>", " ", m[2]), text)
    return [line for line in text.splitlines() if line and not line.isspace()]


def observe(texts: list[str], words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(levels, seeds, sizes of all lines, number of lines of each text)."""
    at: list[int] = []
    first, extra, sizes, per = [], [], [], []
    for text in texts:
        lines = lines_of(text)
        per.append(len(lines))
        for line in lines:
            ws = line.split()
            if ws[0][0] in ">※":
                ws[0] = ws[0][1:]
                if not ws[0] and len(ws) > 1:
                    ws.pop(0)
            # dashes between all words are a way of writing
            if len(ws) > 9 and 3 * (dashes := ws.count("-")) > len(ws) - 1 and dashes < len(ws):
                ws = [w for w in ws if w != "-"]
            tags = len(TAG.findall(line)) if "<" in line else 0
            gaps = len(GAPS.findall(line.strip())) if "  " in line else 0
            tabs, bars = line.count("\t"), line.count("|")
            head = line.lstrip()
            few = len(ws) < 6
            extra.append((tags, gaps, tabs, bars, bool(BULLET.match(line)), head[:1] == "|", head[:1] in "{[" and line.count('":') > 1 or bool(LOG.match(line)), few and bool(KEY_VALUE.match(line)), _cells(line), _small_start(head), head[:1].isupper()))
            first.append(len(at))
            at.extend(map(words.__getitem__, ws))
            sizes.append(len(line))
    m, count = words.matrix(), np.array(per, dtype=np.int64)
    if not first:
        return np.zeros((0, FEATURES), np.uint8), np.zeros(0, np.uint8), np.zeros(0, np.int64), count
    idx, start = np.array(at, dtype=np.int64), np.array(first, dtype=np.int64)
    stop = np.append(start[1:], len(idx))
    s = dict(zip(WORD, np.add.reduceat(m[idx], start, axis=0).T))
    hit = m[idx, _AT["hit"]].astype(bool)
    pair = np.append(hit[1:] & hit[:-1], False)
    pair[stop - 1] = False
    together = np.add.reduceat(pair.astype(np.int64), start)
    # the last word that isn't mere amusement
    amused = m[idx, _AT["amused"]].astype(bool)
    spoken = np.maximum.reduceat(np.where(amused, -1, np.arange(len(idx))), start)
    last = m[np.where(spoken < 0, idx[stop - 1], idx[spoken]), _AT["finish"]].astype(bool) | m[idx[stop - 1], _AT["finish"]].astype(bool)
    counter = m[idx[stop - 1], _AT["count"]].astype(bool)
    x = dict(zip(("tags", "gaps", "tabs", "bars", "bullet", "bar", "log", "pair", "cells", "small", "capital"), np.array(extra, dtype=np.int64).T))
    nw = stop - start
    n = np.maximum(1, s["n"])
    share = lambda a, b: a / np.maximum(1, b)
    v = {
        **{k: s[k] / n for k in ("hangul", "latin", "digit", "symbol", "odd")},
        "common": share(s["hit"], nw), "together": share(together, nw - 1),
        "particles": np.where(s["ko"] > 0, share(s["particle"], s["ko"]), -1), "ends": share(s["end"], nw), "closing": share(s["closing"], nw),
        "lower": np.where(s["runs"] > 0, share(s["lower"], s["runs"]), -1), "garbled": np.where(s["runs"] > 0, share(s["garbled"], s["runs"]), -1),
        "delimiters": share(s["delimiters"] + x["tabs"], nw), "words": nw, "length": n / np.maximum(1, nw),
        "bullet": x["bullet"], "last": last, "layout": np.minimum(2, x["tags"] + (x["gaps"] > 1) + x["tabs"] + (x["bars"] > 2)),
        "marks": share(s["mark"], nw), "hashes": share(s["hash"], nw), "jamo": s["jamo"] / n,
        # what is either there or not, the rarest first
        "sign": np.select([x["log"] > 0, (s["hex"] > 0) | (s["entities"] * 4 > nw), x["cells"] == 2, x["cells"] == 1, x["pair"] > 0, counter | (s["link"] > 0) & (nw < 9), (s["latin"] > s["hangul"]) & (nw <= 12) & (x["small"] > 0)], [1, 2, 3, 4, 5, 6, 7], 0),
    }
    levels = np.stack([np.searchsorted(c, v[k], side="left") for k, c in CUTS.items()], axis=1).astype(np.uint8)
    return levels, _seeds(v, s, x, nw, n, last, counter), np.array(sizes, dtype=np.int64), count


def _cells(line: str) -> int:
    """0; 1 for a line of at least four short cells between commas, 2 if it has no spaces after them."""
    if line.count(",") < 3:
        return 0
    cells = line.split(",")
    short = sum(len(c.split()) <= 4 for c in cells) > 0.9 * len(cells)
    return (2 if line.count(", ") < len(cells) / 2 else 1) if short else 0


def _small_start(head: str) -> bool:
    return next((ch for ch in head if ch.isalpha()), "A").islower()


def _seeds(v: dict, s: dict, x: dict, nw: np.ndarray, n: np.ndarray, last: np.ndarray, counter: np.ndarray) -> np.ndarray:
    """The label that plain signs give a line, UNKNOWN where none does; the first that holds counts."""
    latin = s["latin"] > s["hangul"]
    signs = [
        ((x["tags"] >= 4) | (x["tabs"] >= 2) | (x["bars"] >= 3) & (x["bar"] > 0), TABLE),
        ((v["odd"] > 0.3) | (v["jamo"] > 0.4) | (s["entities"] * 4 > nw) & (s["entities"] > 1) | (v["symbol"] > 0.5) | (s["hex"] > 0) & (nw < 4), JUNK),
        (x["log"] > 0, JUNK),
        ((s["runs"] >= 4) & (v["garbled"] > 0.4) & latin, JUNK),
        ((nw >= 6) & (s["hangul"] > s["latin"]) & (s["closing"] == 0) & ((v["common"] > 0.5) | (v["common"] > 0.35) & (s["end"] == 0) & (v["particles"] < 0.3)), JUNK),
        ((nw >= 6) & (v["common"] > 0.7), JUNK),
        ((nw >= 8) & (v["common"] > 0.6) & ~(s["hangul"] > s["latin"]) & (s["closing"] == 0) & (v["together"] > 0.35), JUNK),
        ((x["cells"] == 2) & ~last, TABLE),
        ((x["cells"] == 1) & ~last, LIST),
        ((x["gaps"] >= 2) & (s["digit"] > 0) & (nw < 12), TABLE),
        (counter | (s["link"] > 0) & (nw < 9) | (x["pair"] > 0), LIST),
        ((v["marks"] > 0.15) & (nw > 5), LIST),
        ((nw > 3) & (v["hashes"] > 0.6), LIST),
        # sentences: Korean with particles and an ending, English with function words in between
        ((s["ko"] >= 3) & (s["end"] > 0) & (last | (s["end"] * 25 >= nw)) & (v["particles"] >= 0.15) & (v["common"] < 0.5) & (s["hangul"] >= s["latin"] * 0.5), PROSE),
        ((s["runs"] >= 7) & latin & (v["common"] >= 0.18) & (v["common"] <= 0.62) & (v["lower"] > 0.45) & (v["together"] < 0.42) & (s["closing"] > 0) & (x["bullet"] == 0) & ((nw > 9) | (x["capital"] > 0)), PROSE),
        (latin & (nw <= 12) & (x["small"] > 0), LIST),
        ((x["bullet"] > 0) & (nw < 12) & (s["end"] == 0), LIST),
        ((nw < 10) & (s["end"] == 0) & (s["closing"] == 0), LIST),
    ]
    return np.select([c for c, _ in signs], [np.uint8(k) for _, k in signs], default=np.uint8(UNKNOWN)).astype(np.uint8)


class Model:
    """Whole-number counts -> log probabilities, with one added to every count."""

    def __init__(self, start: np.ndarray, move: np.ndarray, level: np.ndarray) -> None:
        log = lambda c: np.log((c + 1) / (c + 1).sum(axis=-1, keepdims=True))
        self.start, self.move = np.exp(log(start)), np.exp(log(move + np.eye(K) * 20))
        # level: script, state, statistic, level
        self.emit = log(level)

    def weigh(self, levels: np.ndarray) -> np.ndarray:
        """Likelihood of every line in every state, but for a factor of the line."""
        script = _script(levels)
        out = np.zeros((len(levels), K))
        for f in range(FEATURES):
            out += self.emit[script, :, f, levels[:, f]]
        return np.exp(out - out.max(axis=1, keepdims=True)) if len(out) else out

    def posteriors(self, levels: np.ndarray, count: np.ndarray, moves: np.ndarray | None = None) -> np.ndarray:
        """Forward-backward over all texts at once: probability of every state for every line.

        ``moves`` takes up the expected moves from state to state, in UNITs.
        """
        here = self.weigh(levels)
        first = np.cumsum(count) - count
        order = np.argsort(-count, kind="stable")
        first, longest = first[order], count[order]
        alpha, beta = np.empty_like(here), np.ones_like(here)
        most = int(longest[0]) if len(longest) else 0
        # texts with more than t lines come first
        alive = np.searchsorted(-longest, -np.arange(most), side="left")
        for t in range(most):
            i = first[: alive[t]] + t
            a = (self.start if t == 0 else _through(alpha[i - 1], self.move)) * here[i]
            alpha[i] = a / a.sum(axis=1, keepdims=True)
        back = np.ascontiguousarray(self.move.T)
        for t in range(most - 1, 0, -1):
            i = first[: alive[t]] + t
            after = beta[i] * here[i]
            b = _through(after, back)
            beta[i - 1] = b / b.sum(axis=1, keepdims=True)
            if moves is not None:
                both = alpha[i - 1][:, :, None] * self.move * after[:, None, :]
                moves += np.rint(both * (UNIT / both.sum(axis=(1, 2), keepdims=True))).astype(np.int64).sum(axis=0)
        post = alpha * beta
        return post / post.sum(axis=1, keepdims=True) if len(post) else post


def _through(a: np.ndarray, move: np.ndarray) -> np.ndarray:
    """a @ move, each row the same whatever rows stand beside it."""
    return (a[:, :, None] * move).sum(axis=1)


def _script(levels: np.ndarray) -> np.ndarray:
    """Whether a line has more Latin letters than Hangul; levels are told apart by this as well as by the state."""
    return (levels[:, 1] > levels[:, 0]).astype(np.int64)


def _common(words: DataFrame, column: str) -> frozenset[str]:
    """The list of frequent words: bounded by what it is, a short list; at most 100,000 are taken in."""
    rows = [r[0] for r in words.select(F.lower(F.trim(column))).distinct().limit(100_001).toLocalIterator()]
    if len(rows) > 100_000:
        raise ValueError("the list of common words is longer than 100,000")
    return frozenset(w for w in rows if w)


def observe_lines(docs: DataFrame, doc_id: str, text: str, common: frozenset[str]) -> DataFrame:
    """(d, seen, seeds, sizes), written once: per document the levels of its lines, the labels of plain signs, the lines' lengths.

    A line takes FEATURES bytes, whatever its length.
    """
    rows = spread(docs.select(F.col(doc_id).alias("d"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("t")), "d")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words(common)
        for b in batches:
            texts = b.column(1).to_pylist()
            for lo, hi in _chunks([len(t) for t in texts]):
                if len(words) > MEMORY:
                    words = Words(common)
                levels, seeds, sizes, count = observe(texts[lo:hi], words)
                offset = np.append(0, np.cumsum(count)).astype(np.int32)
                binary = lambda data, width: pa.Array.from_buffers(pa.binary(), hi - lo, [None, pa.py_buffer((offset * width).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))])  # noqa: B023, E731
                yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, hi - lo), binary(levels, FEATURES), binary(seeds, 1), pa.ListArray.from_arrays(pa.array(offset), pa.array(sizes, pa.int64()))], ["d", "seen", "seeds", "sizes"])

    return cut(rows.mapInArrow(run, f"d {dict(rows.dtypes)['d']}, seen binary, seeds binary, sizes array<long>"))


def _chunks(sizes: list[int]) -> Iterator[tuple[int, int]]:
    lo = size = 0
    for i, n in enumerate(sizes):
        if size and size + n > CHUNK:
            yield lo, i
            lo, size = i, 0
        size += n + 1
    if lo < len(sizes):
        yield lo, len(sizes)


def _unpack(seen: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    data = b"".join(x or b"" for x in seen.to_pylist())
    levels = np.frombuffer(data, dtype=np.uint8).reshape(-1, FEATURES)
    return levels, np.array([len(x or b"") // FEATURES for x in seen.to_pylist()], dtype=np.int64)


def _count(observed: DataFrame, model: Model | None) -> Model:
    """Model estimated from the seeds (None) or from what ``model`` expects of every line."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start, move, level = np.zeros(K, np.int64), np.zeros((K, K), np.int64), np.zeros((2, K, FEATURES, 8), np.int64)
        for b in batches:
            levels, count = _unpack(b.column(0))
            first = np.zeros(len(levels), dtype=bool)
            first[(np.cumsum(count) - count)[count > 0]] = True
            if model is None:
                told = np.frombuffer(b"".join(x or b"" for x in b.column(1).to_pylist()), dtype=np.uint8)
                post = np.eye(K + 1, dtype=np.int64)[told][:, :K] * UNIT
                both = ~first[1:] & (told[:-1] < K) & (told[1:] < K)
                move += UNIT * np.bincount(told[:-1][both].astype(np.int64) * K + told[1:][both], minlength=K * K).reshape(K, K)
            else:
                post = np.rint(model.posteriors(levels, count, move) * UNIT).astype(np.int64)
            start += post[first].sum(axis=0)
            script = _script(levels)
            for f in range(FEATURES):
                for k in range(K):
                    level[:, k, f] += np.bincount(script * 8 + levels[:, f], post[:, k], 16).astype(np.int64).reshape(2, 8)
        total = np.concatenate([start, move.ravel(), level.ravel()])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], ["i", "n"])

    rows = observed.select("seen", "seeds").mapInArrow(run, "i long, n long").groupBy("i").agg(F.sum("n").alias("n")).collect()
    total = np.zeros(K + K * K + 2 * K * FEATURES * 8)
    for r in rows:
        total[r["i"]] = r["n"] / UNIT
    return Model(total[:K], total[K : K + K * K].reshape(K, K), total[K + K * K :].reshape(2, K, FEATURES, 8))


def fit(observed: DataFrame, rounds: int = 1) -> Model:
    """Model of all documents: seeded once, then estimated ``rounds`` times by forward-backward."""
    model = _count(observed, None)
    for _ in range(rounds):
        model = _count(observed, model)
    return model


def line_shares(docs: DataFrame, doc_id: str, text: str, common_words: DataFrame, word: str = "word", rounds: int = 1) -> DataFrame:
    """(doc_id, lines, chars, prose, list, table, junk): characters of each label as shares of all.

    Characters are those of lines with more than white space. Documents
    without such lines (and null texts) have no lines, 0 characters and null
    shares. Repeated rows give repeated results; other columns are ignored.
    """
    observed = observe_lines(docs, doc_id, text, _common(common_words, word))
    model = fit(observed, rounds)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            levels, count = _unpack(b.column(1))
            label = model.posteriors(levels, count).argmax(axis=1)
            size = np.asarray(b.column(2).flatten(), dtype=np.int64)
            doc = np.repeat(np.arange(len(count)), count)
            chars = np.bincount(doc, size, len(count))
            shares = [np.bincount(doc[label == k], size[label == k], len(count)) / np.maximum(chars, 1) for k in range(4)]
            none = chars == 0
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(count.astype(np.int32)), pa.array(chars.astype(np.int64)), *(pa.array(x, pa.float64(), mask=none) for x in shares)], ["d", "lines", "chars", *STATES])

    kind = dict(observed.dtypes)["d"]
    return observed.select("d", "seen", "sizes").mapInArrow(run, f"d {kind}, lines int, chars long, prose double, list double, `table` double, junk double").withColumnRenamed("d", doc_id)


def statistics(docs: DataFrame, doc_id: str, text: str, common_words: DataFrame, word: str = "word") -> DataFrame:
    """(doc_id, words, mean_word_length, symbol_ratio, closed_lines, common_share), inside the JVM.

    Words are separated by spaces, tabs and line ends; symbols are ASCII
    characters other than letters, digits and white space; ``closed_lines`` is
    the share of non-blank lines that end in . ! or ?. Ratios without a base
    are null, and so is everything of a null text but its 0 words.
    """
    common = F.array(*[F.lit(w) for w in sorted(_common(common_words, word))])
    t = F.coalesce(F.col(text).cast("string"), F.lit(""))
    d = docs.select(F.col(doc_id), t.alias("t")).withColumns({
        "w": F.filter(F.split("t", r"[ \t\r\n]+"), lambda x: x != ""),
        "l": F.filter(F.split("t", r"\n"), lambda x: F.trim(F.regexp_replace(x, r"[\t\r]", "")) != ""),
    })
    letters = F.aggregate("w", F.lit(0), lambda a, x: a + F.length(x))
    closed = F.size(F.filter("l", lambda x: x.rlike(r"[.!?][ \t\r]*$")))
    hits = F.size(F.filter("w", lambda x: F.array_contains(common, F.lower(F.regexp_replace(x, r"^[!-/:-@\[-`{-~]+|[!-/:-@\[-`{-~]+$", "")))))
    ratio = lambda a, b: F.when(b > 0, F.round(a / b, 6))
    return d.select(
        doc_id,
        F.size("w").alias("words"),
        ratio(letters, F.size("w")).alias("mean_word_length"),
        ratio(F.length(F.regexp_replace("t", r"[^!-/:-@\[-`{-~]", "")), F.length("t")).alias("symbol_ratio"),
        ratio(closed, F.size("l")).alias("closed_lines"),
        ratio(hits, F.size("w")).alias("common_share"),
    )
