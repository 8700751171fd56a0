"""Clusters of near-duplicate posts: building, merging and their bookkeeping."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.functions import hashing
from weftline.operators import pairs, relational as rel
from weftline.operators.lineage import cut, spread

#: Kinds of evidence; each is a MinHash sketch of 128 positions, null where a post has none.
EVIDENCE = ("text", "gallery", "embed")


def confirm(text: Column, gallery: Column, embed: Column) -> Column:
    """struct<similarity, kind> of two posts by their evidence, null if they aren't near-duplicates."""
    by = lambda s, kind: F.struct(s.alias("similarity"), F.lit(kind).alias("kind"))
    return (
        F.when(text >= 0.75, by(text, "text"))
        .when((gallery >= 0.80) & (text >= 0.55), by((gallery + text) / 2, "both"))
        .when((embed >= 0.85) & ((text >= 0.50) | (gallery >= 0.60)), by(F.greatest(embed, (text + gallery) / 2), "embed"))
    )


def member_similarity(text: Column, gallery: Column, embed: Column) -> Column:
    """How alike members of two clusters are: the best of text, text and gallery together, and embeds that either supports."""
    both = F.when((gallery > 0) & (text > 0), (gallery + text) / 2).otherwise(0.0)
    return F.greatest(text, both, F.when((embed > 0) & ((text >= 0.5) | (gallery >= 0.6)), embed).otherwise(0.0))


def decoded(sketch: Column) -> Column:
    """array<int> of the word hashes that hold a position of a MinHash sketch: they make the same sketch again (an Arrow function)."""

    @F.pandas_udf("array<int>")
    def words(sketches: pd.Series) -> pd.Series:
        return sketches.map(lambda m: None if m is None or not len(m) else np.unique(hashing.unpermuted(np.asarray(m))).astype(np.int32))

    return words(sketch)


#: Equal positions that each rule asks for at least: text alone; gallery with text; embed with text or gallery. Its first
#: kind of evidence is what posts are looked up by.
_LEAST = {"text": 96, "gallery": 103, "embed": 109}
#: Counters of how often words occur; words that share one count as equally rare.
_COUNTERS = 1 << 16


def _packed(m: np.ndarray) -> np.ndarray:
    """The last bit of all 128 positions."""
    return np.packbits((m & 1).astype(np.uint8), axis=1).view(np.uint64)


def _same(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Equal positions, row by row; rows of -1 equal nothing."""
    return ((x == y) & (x >= 0)).sum(axis=1)


def _met(tx: np.ndarray, ty: np.ndarray, sx: np.ndarray, sy: np.ndarray) -> np.ndarray:
    """Whether posts share a bucket: one of 32 bands of 4 positions of the text, or a slice of 15 bits of the SimHash."""
    z = sx ^ sy
    slices = np.zeros(len(z), bool)
    for i in range(4):
        slices |= (z >> (15 * i)) & 32767 == 0
    return slices | (tx == ty).reshape(len(tx), 32, 4).all(axis=2).any(axis=1)


def _confirmed(t: np.ndarray, g: np.ndarray, e: np.ndarray) -> np.ndarray:
    """The number of the kind by which ``confirm`` holds for equal positions, 0 if it doesn't."""
    t, g, e = t / 128, g / 128, e / 128
    return np.select([t >= 0.75, (g >= 0.80) & (t >= 0.55), (e >= 0.85) & ((t >= 0.50) | (g >= 0.60))], [1, 2, 3], 0)


def _close(m: np.ndarray, least: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows of ``m`` with ``least`` equal positions or more, in blocks."""
    bits = _packed(m)
    for lo in range(0, len(m), 256):
        far = np.bitwise_count(bits[lo : lo + 256, None, 0] ^ bits[None, lo:, 0])
        far += np.bitwise_count(bits[lo : lo + 256, None, 1] ^ bits[None, lo:, 1])
        i, j = np.nonzero(far <= 128 - least)
        up = i < j
        i, j = i[up] + lo, j[up] + lo
        for at in range(0, len(i), 1 << 16):
            a, b = i[at : at + (1 << 16)], j[at : at + (1 << 16)]
            near = _same(m[a], m[b]) >= least
            yield a[near], b[near]


def text_links(texts: DataFrame, nodes: DataFrame) -> DataFrame:
    """(a, b) of texts that are connected by posts that meet in a bucket and are confirmed; not all such pairs, but enough to connect all.

    ``texts``: first, simhash, text; ``nodes``: these of every distinct
    evidence, with gallery and embed. Evidence is sets of word hashes.

    If n positions of two sketches are equal, the words both have hold n of
    the 128 positions of either. So among the rarest words that hold more than
    128 - n of a post's positions is the rarest one they share: posts are
    looked up by those words alone, and compared where they meet. Nothing is
    lost by that, no pair is shuffled that isn't confirmed, and sketches are
    made where they are compared, not stored.
    """
    kind_of = dict(nodes.dtypes)["first"]
    words = "first {0}, simhash long, text array<int>, gallery array<int>, embed array<int>".format(kind_of)
    none = F.lit(None).cast("array<int>")
    parts = max(int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions")), texts.sparkSession.sparkContext.defaultParallelism)
    found = []
    for kind, least in _LEAST.items():
        df = (texts.withColumns({"gallery": none, "embed": none}) if kind == "text" else nodes if kind == "embed" else nodes.select("first", "simhash", "text", "gallery").distinct().withColumn("embed", none)).select("first", "simhash", "text", "gallery", "embed").where(F.size(kind) > 0)
        often = np.zeros(_COUNTERS, np.int64)
        for r in df.select(F.explode(kind).alias("w")).groupBy((F.col("w") % _COUNTERS).alias("w")).agg(F.count(F.lit(1)).alias("n")).toLocalIterator():
            often[r["w"]] = r["n"]
        keyed = spread(df, "first").mapInArrow(_keys(kind, least, often), f"word int, {words}")
        # a fixed number of parts: what a part costs follows the pairs in it, not its bytes
        found.append(keyed.repartition(parts, "word").sortWithinPartitions("word").mapInArrow(_compare(kind, least), f"a {kind_of}, b {kind_of}"))
    return found[0].unionByName(found[1]).unionByName(found[2])


def _keys(kind: str, least: int, often: np.ndarray):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            column = b.column(b.schema.get_field_index(kind))
            m, w, row, held = hashing.sketches(column, held=True)
            keep = held > 0
            w, row, held = w[keep], row[keep], held[keep]
            order = np.lexsort((w, often[w % _COUNTERS], row))
            w, row, held = w[order], row[order], held[order]
            before = np.cumsum(held) - held
            first = np.searchsorted(row, row)
            near = before - before[first] <= 128 - least
            out = b.take(pa.array(row[near]))
            yield pa.RecordBatch.from_arrays([pa.array(w[near].astype(np.int32)), *out.columns], ["word", *b.schema.names])

    return run


def _compare(kind: str, least: int):
    def links(t: pa.Table) -> Iterator[pa.RecordBatch]:
        word = t["word"].to_numpy()
        starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
        ends = np.r_[starts[1:], len(word)]
        a, b = [], []
        for lo, hi in zip(starts, ends):
            if hi - lo < 2:
                continue
            part = t.slice(lo, hi - lo).combine_chunks()
            m = {k: hashing.sketches(part[k].combine_chunks())[0] for k in (("text",) if kind == "text" else ("text", "gallery") if kind == "gallery" else EVIDENCE)}
            s = part["simhash"].to_numpy()
            parent = list(range(hi - lo))

            def top(x: int) -> int:
                while parent[x] != x:
                    parent[x] = parent[parent[x]]
                    x = parent[x]
                return x

            for i, j in _close(m[kind], least):
                zero = np.zeros(len(i), np.int64)
                like = [_same(m[k][i], m[k][j]) if k in m else zero for k in EVIDENCE]
                ok = (_confirmed(*like) > 0) & _met(m["text"][i], m["text"][j], s[i], s[j])
                for x, y in zip(i[ok].tolist(), j[ok].tolist()):
                    p, q = top(x), top(y)
                    if p != q:
                        parent[max(p, q)] = min(p, q)
                        a.append(lo + x)
                        b.append(lo + y)
        ids = t["first"].combine_chunks()
        yield pa.RecordBatch.from_arrays([ids.take(pa.array(x, pa.int64())) for x in (a, b)], ["a", "b"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[pa.RecordBatch] = []
        for b in batches:
            if not b.num_rows:
                continue
            # a word's rows are compared once all are there
            words = b["word"].to_numpy()
            cut_at = int(np.searchsorted(words, words[-1]))
            if kept and (cut_at or words[0] != kept[-1]["word"][-1].as_py()):
                yield from links(pa.Table.from_batches([*kept, b.slice(0, cut_at)]))
                kept = []
            elif cut_at:
                yield from links(pa.Table.from_batches([b.slice(0, cut_at)]))
            kept.append(b.slice(cut_at))
        if kept:
            yield from links(pa.Table.from_batches(kept))

    return run


def _own(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """similarity and kind of posts with their representatives in place of both's evidence."""
    for b in batches:
        sketch = lambda c: hashing.sketches(b[c])[0]  # noqa: B023, E731
        mine, theirs = ([sketch(f"{p}{k}") for k in EVIDENCE] for p in ("", "rep_"))
        like = [_same(x, y) for x, y in zip(mine, theirs)]
        rule = _confirmed(*like) * _met(mine[0], theirs[0], b["simhash"].to_numpy(), b["rep_simhash"].to_numpy())
        rule[b["is_representative"].to_numpy(zero_copy_only=False)] = 0
        t, g, e = (x / 128 for x in like)
        similarity = np.select([rule == 1, rule == 2, rule == 3], [t, (g + t) / 2, np.maximum(e, (t + g) / 2)], 0.0)
        kinds = pa.array([None, "text", "both", "embed"]).take(pa.array(rule))
        yield pa.RecordBatch.from_arrays([b["component"], b["post_id"], pa.array(similarity), kinds, b["is_representative"], b["size"]], ["component", "post_id", "similarity", "kind", "is_representative", "size"])


def build_clusters(posts: DataFrame, known: DataFrame, *, since: Column | None = None) -> DataFrame:
    """(cluster, post_id, similarity, kind, is_representative, size): clusters of two posts and more.

    ``posts``: post_id, at, score (the hot score where it is fresh, else what
    stands for it), simhash and the evidence, as MinHash sketches or, smaller,
    as array<int> of word hashes (``hashing.small_hash``); those before
    ``since`` take no part. ``known``: cluster, post_id of clusters there are. A cluster keeps
    the least known id of its members, a new one is named after its least
    member. The member of the greatest score (of equals the least id)
    represents it; similarity and kind are those of the member's own pair with
    it, 0 and null if they were not confirmed directly (and for itself).
    Posts of equal text are one text for the search, however many there are.
    """
    recent = posts if since is None else posts.where(F.col("at") >= since)
    words = {k: F.array_sort(decoded(F.col(k)) if kind == "array<bigint>" else F.array_distinct(k)) for k, kind in recent.dtypes if k in EVIDENCE}
    sized = lambda k: [F.coalesce(F.size(k), F.lit(-1)), F.col(k)]
    recent = recent.select("post_id", "score", "simhash", *[c.alias(k) for k, c in words.items()]).where(F.size("text") > 0)
    recent = cut(recent.withColumn("tid", F.xxhash64("simhash", *sized("text"))).withColumn("nid", F.xxhash64("tid", *sized("gallery"), *sized("embed"))))
    texts = cut(recent.groupBy("tid").agg(F.min("post_id").alias("first"), F.count(F.lit(1)).alias("n"), F.first("simhash").alias("simhash"), F.first("text").alias("text")))
    nodes = recent.where("size(gallery) > 0 or size(embed) > 0").groupBy("nid").agg(*[F.first(c).alias(c) for c in ("tid", "simhash", *EVIDENCE)])
    nodes = cut(nodes.join(texts.select("tid", "first"), "tid").select("first", "simhash", *EVIDENCE))
    comp = pairs.components(cut(text_links(texts.select("first", "simhash", "text"), nodes)))
    groups = texts.join(comp.select(F.col("node").alias("first"), "component"), "first", "left").where("n > 1 or component is not null").select("tid", F.coalesce("component", "first").alias("component"))
    members = cut(recent.join(groups, "tid").select("component", "post_id", "score", "simhash", *EVIDENCE))
    heads = members.groupBy("component").agg(F.min_by(F.struct("post_id", "simhash", *EVIDENCE), F.struct((-F.coalesce("score", F.lit(0.0))).alias("a"), "post_id")).alias("rep"), F.count(F.lit(1)).alias("size"))
    both = members.join(heads, "component").select("component", "post_id", "simhash", *EVIDENCE, F.col("rep.simhash").alias("rep_simhash"), *[F.col(f"rep.{k}").alias(f"rep_{k}") for k in EVIDENCE], (F.col("post_id") == F.col("rep.post_id")).alias("is_representative"), "size")
    id_of = dict(members.dtypes)["post_id"]
    out = both.mapInArrow(_own, f"component {id_of}, post_id {id_of}, similarity double, kind string, is_representative boolean, size long")
    ids = members.select("component", "post_id").join(known.select(F.col("post_id"), F.col("cluster").alias("old")), "post_id").groupBy("component").agg(F.min("old").alias("old"))
    return out.join(ids, "component", "left").select(F.coalesce("old", F.concat(F.lit("c"), F.col("component").cast("string"))).alias("cluster"), "post_id", "similarity", "kind", "is_representative", "size")


def merge_decisions(clusters: DataFrame, members: DataFrame, evidence: DataFrame, *, least: float = 0.8, top: int = 8) -> DataFrame:
    """(cluster, kept): which cluster each merged cluster goes into.

    ``clusters``: cluster, representative, created, size; ``members``:
    cluster, post_id, score; ``evidence``: post_id, text, gallery, embed.
    Clusters whose representatives share a band are compared by their ``top``
    members; see ``pipelines.merge_clusters``. Of those that merge, directly
    or through others, the greatest is kept, of equals the oldest, then the
    least id: merging in any order would end there.
    """
    from weftline.plans.pipelines import merge_clusters

    reps = clusters.join(evidence.select(F.col("post_id").alias("representative"), "text"), "representative")
    keys = F.transform(hashing.bands(F.col("text"), 32, 4), lambda b: F.concat_ws(":", b["position"].cast("string"), b["value"]))
    met = pairs.candidate_pairs(reps.where("text is not null"), "cluster", keys)
    ranked = rel.before(members.select("cluster", "post_id", "score"), ["cluster"], [F.desc("score"), F.col("post_id")])
    m = ranked.where(F.col("before") < top).join(evidence, "post_id").select(F.col("cluster").alias("group"), (F.col("before") + 1).alias("rank"), *EVIDENCE)
    like = [hashing.sketch_jaccard(F.col(f"ma.{k}"), F.col(f"mb.{k}")) for k in EVIDENCE]
    parts = merge_clusters(m, met, member_similarity(*like), least, top).select("cluster", F.col("kept").alias("component"))
    sized = parts.join(clusters, "cluster")
    kept = sized.groupBy("component").agg(F.min_by("cluster", F.struct((-F.col("size")).alias("a"), "created", "cluster")).alias("kept"))
    return parts.join(kept, "component").select("cluster", "kept")


def apply_merges(clusters: DataFrame, members: DataFrame, decisions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(clusters, members) after merging: members moved, dropped clusters gone, size and representative made anew.

    ``members``: cluster, post_id, score, is_representative. A post that both
    clusters had is a member once. Clusters that don't merge stay as they are.
    """
    to = decisions.select("cluster", "kept")
    moved = members.join(to, "cluster", "left").withColumn("__own", F.col("kept").isNull() | (F.col("kept") == F.col("cluster"))).withColumn("cluster", F.coalesce("kept", "cluster"))
    once = rel.keep_first(moved.withColumn("__o", F.when(F.col("__own"), 0).otherwise(1)), ["cluster", "post_id"], ["__o"])
    touched = to.select(F.col("kept").alias("cluster")).distinct()
    new = once.join(touched, "cluster", "left_semi").groupBy("cluster").agg(F.count(F.lit(1)).alias("__size"), F.min_by("post_id", F.struct((-F.coalesce("score", F.lit(0.0))).alias("a"), "post_id")).alias("__rep"))
    gone = to.where("cluster <> kept").select("cluster")
    left = clusters.join(gone, "cluster", "left_anti").join(new, "cluster", "left").withColumns({"size": F.coalesce("__size", "size"), "representative": F.coalesce("__rep", "representative")}).select(*clusters.columns)
    reps = left.select("cluster", F.col("representative").alias("__r"))
    return left, once.join(reps, "cluster").withColumn("is_representative", F.col("post_id") == F.col("__r")).select("cluster", "post_id", "score", "is_representative")
