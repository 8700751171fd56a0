"""Finding evaluation texts in a corpus: Wu-Manber search for shared runs.

A document leaks an item if both share an unbroken run of at least ``run``
letters and digits. Items are cut into pieces of half that length, so that
every such run holds a whole piece; the pieces are the patterns, all of one
length m, equal ones but once.

The shift table maps a block of characters to the least distance from its end
to the end of any piece that holds it; a block that no piece holds lets the
window move on by m - block + 1. A block at distance 0 ends pieces: it selects
a bucket, in which the first block of the window selects pieces, and direct
comparison confirms one. Then the run is followed to both sides of the piece.
Pieces that many items share (stock phrases) are followed once for all places
with the same text on one side; the text on the other side is looked up, so a
document that uses a stock phrase isn't compared with every item that does.
"""

from __future__ import annotations

import re
import unicodedata
from collections import defaultdict
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from weftline.operators.lineage import cut, spread

RUN = 60
BLOCK_LEN = 10
#: Letters of items per pass over the corpus; larger item sets are searched in several passes. Longer items come in slices.
PASS_CHARS = 2_000_000
_OTHER = re.compile(r"[\W_]+")


def letters(text: str) -> str:
    """NFKC, lower case, letters and digits only."""
    return _OTHER.sub("", (text if text.isascii() else unicodedata.normalize("NFKC", text)).lower())


class Searcher:
    """Shift table and buckets of (key, letters) items."""

    def __init__(self, items: list[tuple[object, str]], run: int = RUN, block: int = BLOCK_LEN) -> None:
        self.m = m = (run + 1) // 2
        self.block = b = min(block, m)
        self.need = run - m
        self.keys = [key for key, _ in items]
        # the text on both sides of a piece, as far as a run needs it
        self.sides: dict[str, list[tuple[str, str, int]]] = defaultdict(list)
        for i, (_, s) in enumerate(items):
            for at in range(0, len(s) - m + 1, m) if len(s) >= run else ():
                self.sides[s[at : at + m]].append((s[max(0, at - self.need) : at], s[at + m : at + m + self.need], i))
        self.most = m - b + 1
        self.shift: dict[str, int] = {}
        self.buckets: dict[str, dict[str, list[str]]] = defaultdict(lambda: defaultdict(list))
        for piece in self.sides:
            for end in range(b, m + 1):
                part = piece[end - b : end]
                self.shift[part] = min(m - end, self.shift.get(part, self.most))
            self.buckets[piece[-b:]][piece[:b]].append(piece)
        self._grouped: dict[str, tuple[bool, dict[str, list[tuple[str, int]]]]] = {}
        self._looked: dict[tuple[str, str, int], dict[str, list[int]]] = {}

    def _groups(self, piece: str) -> tuple[bool, dict[str, list[tuple[str, int]]]]:
        """(grouped by left text?, that side's text -> [(other side's text, item)]), by the side with fewer different texts."""
        if (known := self._grouped.get(piece)) is None:
            sides = self.sides[piece]
            by_left = len({x for x, _, _ in sides}) <= len({y for _, y, _ in sides})
            groups: dict[str, list[tuple[str, int]]] = defaultdict(list)
            for left, right, i in sides:
                groups[left if by_left else right].append((right, i) if by_left else (left, i))
            known = self._grouped[piece] = (by_left, dict(groups))
        return known

    def _lookup(self, piece: str, side: str, n: int, by_left: bool) -> dict[str, list[int]]:
        """The n characters on the other side -> items."""
        if (known := self._looked.get((piece, side, n))) is None:
            known = defaultdict(list)
            for other, i in self._groups(piece)[1][side]:
                if len(other) >= n:
                    known[other[:n] if by_left else other[len(other) - n :]].append(i)
            self._looked[piece, side, n] = known
        return known

    def _follow(self, doc: str, at: int, piece: str) -> Iterator[int]:
        """Items that share a run through the piece found at ``at``."""
        by_left, groups = self._groups(piece)
        end = at + self.m
        for side in groups:
            same, most = 0, min(len(side), at if by_left else len(doc) - end)
            if by_left:
                while same < most and side[-same - 1] == doc[at - same - 1]:
                    same += 1
            else:
                while same < most and side[same] == doc[end + same]:
                    same += 1
            n = self.need - same
            other = doc[end : end + n] if by_left else doc[max(0, at - n) : at]
            if len(other) == n:
                yield from self._lookup(piece, side, n, by_left).get(other, ())

    def search(self, text: str) -> list[object]:
        """Keys of the items that ``text`` shares a run with."""
        doc = letters(text)
        found: dict[int, None] = {}
        m, b, most, shift = self.m, self.block, self.most, self.shift.get
        end, n = m, len(doc)
        while end <= n:
            part = doc[end - b : end]
            if step := shift(part, most):
                end += step
                continue
            for piece in self.buckets[part].get(doc[end - m : end - m + b], ()):
                if doc.startswith(piece, end - m):
                    found.update(dict.fromkeys(self._follow(doc, end - m, piece)))
            end += 1
        return list(dict.fromkeys(self.keys[i] for i in found))


def _slices(items: DataFrame, run: int, most: int) -> DataFrame:
    """(i, s): letters of every item in slices of ``most`` that overlap by run - 1, so no run is lost."""
    kind = items.schema["i"].dataType
    schema = T.StructType([T.StructField("i", kind), T.StructField("s", T.StringType())])
    arrow = to_arrow_schema(schema)

    def cut_up(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                s = letters(t)
                out += [(i, s[at : at + most]) for at in range(0, max(1, len(s) - run + 1), most - run + 1)] if len(s) >= run else []
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], arrow.field(k).type) for k in (0, 1)], ["i", "s"])

    return items.mapInArrow(cut_up, schema)


def _passes(slices: DataFrame, chars: int) -> Iterator[list[tuple[object, str]]]:
    """Slices, as many at a time as have ``chars`` letters; the driver holds one pass."""
    block: list[tuple[object, str]] = []
    size = 0
    for r in slices.toLocalIterator():
        if block and size + len(r["s"]) > chars:
            yield block
            block, size = [], 0
        block.append((r["i"], r["s"]))
        size += len(r["s"])
    yield block


def leaked_items(docs: DataFrame, doc_id: str, text: str, items: DataFrame, item_id: str, item_text: str, *, run: int = RUN, pass_chars: int = PASS_CHARS) -> DataFrame:
    """Distinct (doc_id, item_id) of documents and the items they share a run of ``run`` letters and digits with.

    Whole texts are searched, each where it lies: no shuffle of the corpus,
    only of the matches. Items are broadcast ``pass_chars`` letters at a time;
    if they need more than one pass, each pass's matches are written before
    the next begins, so neither driver nor executors hold more than one. Null
    texts and texts shorter than ``run`` match nothing; null ids are kept as
    ids. An id column of the same name in both is not confused.
    """
    rows = spread(docs.select(F.col(doc_id).alias("d"), F.col(text).cast("string").alias("t")).where(F.col("t").isNotNull()), "d")
    schema = T.StructType([T.StructField("d", docs.schema[doc_id].dataType), T.StructField("i", items.schema[item_id].dataType)])
    arrow = to_arrow_schema(schema)
    slices = _slices(items.select(F.col(item_id).alias("i"), F.col(item_text).cast("string").alias("t")).where(F.col("t").isNotNull()), run, max(pass_chars // 2, 2 * run))
    passes = _passes(slices, pass_chars)
    block, found = next(passes), None
    while block is not None:
        after = next(passes, None)

        def find(batches: Iterable[pa.RecordBatch], block=block) -> Iterator[pa.RecordBatch]:
            searcher = Searcher(block, run)
            for b in batches:
                ids, hits = [], []
                for d, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                    for i in searcher.search(t):
                        ids.append(d)
                        hits.append(i)
                yield pa.RecordBatch.from_arrays([pa.array(ids, arrow.field(0).type), pa.array(hits, arrow.field(1).type)], ["d", "i"])

        part = rows.mapInArrow(find, schema)
        if after is not None or found is not None:
            part = cut(part.distinct())
        found = part if found is None else found.unionByName(part)
        block = after
    names = [doc_id, item_id if item_id != doc_id else f"item_{item_id}"]
    return found.distinct().toDF(*names)
