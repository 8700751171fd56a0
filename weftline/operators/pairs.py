"""Similarity joins, near-duplicates, connected components and nearest names."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from weftline.functions import hashing, text
from weftline.operators.lineage import cut, forget, spread


def candidate_pairs(df: DataFrame, row_id: str, buckets: Column) -> DataFrame:
    """Distinct (a, b), a < b, of rows that share a bucket of ``buckets``, an array of keys."""
    b = df.select(F.col(row_id).alias("a"), F.explode(F.array_distinct(buckets)).alias("bucket"))
    return b.join(b.withColumnRenamed("a", "b"), "bucket").where("a < b").select("a", "b").distinct()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the least node each node is connected to.

    Labels spread to neighbours and are then followed to their own labels, so
    the rounds grow with the logarithm of the longest path; lineage is cut in
    every round and only the number of changes reaches the driver.
    """
    e = edges.select(F.col(a).alias("x"), F.col(b).alias("y")).where("x is not null and y is not null and x <> y")
    e = cut(e.union(e.select("y", "x")).distinct())
    label = cut(e.groupBy("x").agg(F.least(F.min("y"), F.col("x")).alias("l")).select(F.col("x").alias("node"), "l"))
    while True:
        near = e.join(label.withColumnRenamed("node", "y"), "y").groupBy(F.col("x").alias("node")).agg(F.min("l").alias("m"))
        spread = label.join(near, "node").select("node", F.col("l").alias("old"), F.least("l", "m").alias("l"))
        # follow the label of the label
        follow = spread.select(F.col("node").alias("l"), F.col("l").alias("ll"))
        new = cut(spread.join(follow, "l", "left").select("node", "old", F.least("l", F.coalesce("ll", "l")).alias("l")))
        moved = new.where("l <> old").limit(1).count()
        forget(label)
        label = new.select("node", "l")
        if not moved:
            forget(e)
            return label.select("node", F.col("l").alias("component"))


def jaccard_links(df: DataFrame, row_id: str, items: str, least: float) -> DataFrame:
    """(a, b, similarity), a < b: all pairs of rows whose sets of ``items`` (array<long>) reach ``least``.

    Exact, by prefix filtering: with items ordered rarest first, two sets that
    similar share one of their first n - ceil(least n) + 1 items. Common items
    come last, so boilerplate opens no candidates, and sizes must fit.
    """
    sets = cut(df.select(F.col(row_id).alias("id"), F.array_distinct(items).alias("s")).where(F.size("s") > 0).withColumn("n", F.size("s")))
    flat = sets.select("id", "n", F.explode("s").alias("item"))
    often = flat.groupBy("item").agg(F.count(F.lit(1)).alias("f"))
    # an item of one set links nothing, but keeps its place in the order
    ranked = flat.join(often, "item").withColumn("at", F.row_number().over(Window.partitionBy("id").orderBy("f", "item")))
    prefix = cut(ranked.where((F.col("f") > 1) & (F.col("at") <= F.col("n") - F.ceil(F.col("n") * F.lit(least) - 1e-9) + 1)).select("id", "n", "item", "at"))
    l, r = (prefix.select("item", F.col("id").alias(x), F.col("n").alias(f"n{x}"), F.col("at").alias(f"at{x}")) for x in "ab")
    room = F.least(F.col("na") - F.col("ata"), F.col("nb") - F.col("atb")) + 1
    fits = (F.col("a") < F.col("b")) & (F.least("na", "nb") >= F.greatest("na", "nb") * least - 1e-9)
    met = l.join(r, "item").where(fits).groupBy("a", "b", "na", "nb").agg(F.min(F.struct("ata", room.alias("room"))).alias("m"))
    # at the first shared item no more than what follows it can be shared
    need = (F.col("na") + F.col("nb")) * least / (1 + least) - 1e-9
    met = met.where(F.col("m.room") >= need).select("a", "b")
    both = met.join(sets.select(F.col("id").alias("a"), F.col("s").alias("sa")), "a").join(sets.select(F.col("id").alias("b"), F.col("s").alias("sb")), "b")
    return both.select("a", "b", F.round(hashing.set_similarity(F.col("sa"), F.col("sb")), 6).alias("similarity")).where(F.col("similarity") >= least - 1e-9)


def _distinct_texts(docs: DataFrame, doc_id: str, column: str) -> tuple[DataFrame, DataFrame]:
    """(d, t, key) per document and (key, id, copies, t) per distinct token sequence: ``id`` is its least document, ``t`` its tokens."""
    # tokens are made once: what follows reads the written copy
    rows = spread(docs.select(F.col(doc_id).alias("d"), F.col(column).alias("t")), "d")
    rows = cut(rows.select("d", F.array_join(text.tokens(F.col("t")), " ").alias("t")))
    rows = rows.withColumn("key", F.when(F.col("t") != "", F.md5("t")))
    texts = cut(rows.where(F.col("key").isNotNull()).groupBy("key").agg(F.min("d").alias("id"), F.count(F.lit(1)).alias("copies"), F.first("t").alias("t")).withColumn("t", F.split("t", " ")))
    return rows, texts


def near_duplicates(docs: DataFrame, doc_id: str, column: str, *, words: int = 5, least: float = 0.8) -> DataFrame:
    """(doc_id, class_id, copies, links): one row per document.

    Documents whose word shingles are ``least`` similar or more are linked;
    ``class_id`` is the least id connected by links. Equal token sequences are
    one text for the join: ``copies`` counts its documents, ``links`` the other
    texts it is linked to. Texts without a word, and null texts, are in no
    class but their own.
    """
    rows, texts = _distinct_texts(docs, doc_id, column)
    shingled = texts.select("id", F.transform(text.shingles(F.col("t"), words), lambda s: F.xxhash64(s)).alias("s"))
    links = cut(jaccard_links(shingled, "id", "s", least))
    degree = links.select(F.explode(F.array("a", "b")).alias("id")).groupBy("id").agg(F.count(F.lit(1)).alias("links"))
    comp = components(links)
    classes = texts.join(comp.withColumnRenamed("node", "id"), "id", "left").join(degree, "id", "left").select("key", "copies", F.coalesce("component", "id").alias("class_id"), F.coalesce("links", F.lit(0)).alias("links"))
    return rows.select("d", "key").join(classes, "key", "left").select(F.col("d").alias(doc_id), F.coalesce("class_id", "d").alias("class_id"), F.coalesce("copies", F.lit(1)).alias("copies"), F.coalesce("links", F.lit(0)).alias("links"))


def lsh_links(sigs: DataFrame, row_id: str, sketch: str, items: str, *, count: int = 32, rows: int = 4, least: float = 0.8) -> DataFrame:
    """(a, b, similarity), a < b, of rows whose MinHash sketches share a band and whose sets of ``items`` reach ``least``.

    The sketch only proposes pairs; similarity is the exact one of the sets.
    """
    keys = F.transform(hashing.bands(F.col(sketch), count, rows), lambda b: F.concat_ws(":", b["position"].cast("string"), b["value"]))
    pairs = candidate_pairs(sigs.where(F.col(sketch).isNotNull()), row_id, keys)
    s = sigs.select(F.col(row_id).alias("id"), F.col(items).alias("s"))
    both = pairs.join(s.select(F.col("id").alias("a"), F.col("s").alias("sa")), "a").join(s.select(F.col("id").alias("b"), F.col("s").alias("sb")), "b")
    return both.select("a", "b", F.round(hashing.set_similarity(F.col("sa"), F.col("sb")), 6).alias("similarity")).where(F.col("similarity") >= least - 1e-9)


def sketch_links(docs: DataFrame, doc_id: str, column: str, *, words: int = 5, least: float = 0.8) -> DataFrame:
    """(a, b, similarity), a < b: links that MinHash bands find; their components are the classes of ``near_duplicates``, up to recall.

    Equal token sequences are one text for the search: its least document is
    linked to each of its others, at 1, and to those of like texts.
    """
    rows, texts = _distinct_texts(docs, doc_id, column)
    copies = rows.join(texts.select("key", "id"), "key").where("d <> id").select(F.col("id").alias("a"), F.col("d").alias("b"), F.lit(1.0).alias("similarity"))
    sets = texts.select("id", F.array_distinct(text.shingles(F.col("t"), words)).alias("g"))
    sigs = hashing.add_minhash(sets, F.col("g"), "m").select("id", "m", F.transform("g", lambda x: F.xxhash64(x)).alias("s"))
    return lsh_links(cut(sigs), "id", "m", "s", least=least).union(copies)


def sketch_similarities(queries: DataFrame, sigs: DataFrame, row_id: str, sketch: str, n: int = 128, block: int = 128) -> DataFrame:
    """(query, row_id, similarity): ``sketch_jaccard`` of every query with every row, itself included; ids are long, sketches have ``n`` positions.

    Rows meet in blocks of about ``block``, compared in numpy. Missing
    sketches are 0 similar to all.
    """

    def blocks(df: DataFrame, side: str, none: int) -> DataFrame:
        parts = df.count() // block + 1
        m = F.coalesce(F.col(sketch), F.array_repeat(F.lit(none).cast("long"), n)).cast("array<int>")
        return df.select(F.pmod(F.xxhash64(row_id), F.lit(parts)).alias("at"), F.struct(F.col(row_id).alias("i"), m.alias("m")).alias("r")).groupBy("at").agg(F.collect_list("r").alias("r")).select(F.col("r.i").alias(f"{side}i"), F.flatten("r.m").alias(f"{side}m"))

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(b.num_rows):
                qi, qm, ri, rm = (np.asarray(b.column(c)[k].values) for c in range(4))
                q, r = qm.reshape(len(qi), -1), rm.reshape(len(ri), -1)
                same = np.stack([(r == one).mean(axis=1) for one in q])
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(qi, len(ri))), pa.array(np.tile(ri, len(qi))), pa.array(same.ravel())], ["query", row_id, "similarity"])

    both = blocks(queries, "q", -2).crossJoin(blocks(sigs, "r", -1))
    return both.select("qi", "qm", "ri", "rm").mapInArrow(compare, f"query long, `{row_id}` long, similarity double")


def knn_trigram(left: DataFrame, right: DataFrame, name: str, k: int, least: float = 0.0) -> DataFrame:
    """(left name, right name, similarity, place): the k most similar right names that share a trigram.

    Distinct names meet in an inverted index of trigrams; the intersection is
    counted by the join itself, so no name is compared that shares nothing.
    """
    l = left.select(F.col(name).alias("l")).where("l is not null").distinct().withColumn("g", hashing.trigrams(F.col("l")))  # noqa: E741
    r = right.select(F.col(name).alias("r")).where("r is not null").distinct().withColumn("g", hashing.trigrams(F.col("r")))
    lx = l.select("l", F.size("g").alias("nl"), F.explode("g").alias("t"))
    rx = r.select("r", F.size("g").alias("nr"), F.explode("g").alias("t"))
    met = lx.join(rx, "t").groupBy("l", "r", "nl", "nr").agg(F.count(F.lit(1)).alias("both"))
    sim = met.select("l", "r", (F.col("both") / (F.col("nl") + F.col("nr") - F.col("both"))).alias("similarity")).where(F.col("similarity") >= least)
    w = Window.partitionBy("l").orderBy(F.desc("similarity"), "r")
    return sim.withColumn("place", F.row_number().over(w)).where(F.col("place") <= k)


def tiered_matches(left: DataFrame, right: DataFrame, within: list[str], key: str, name: str, tiers: list[str], least: float = 0.85) -> DataFrame:
    """(within, key, name, tier, ratio): for each left row its best right row of the same ``within``.

    ``tiers`` are columns of both sides that are compared for equality in this
    order; what none settles is compared by the last of them as a sequence:
    twice the characters in matching blocks over all characters, ``least`` or
    more (difflib's ratio, over Arrow batches). Of equals the least name
    counts. Only what equality leaves open is compared, and only within its
    group. Nulls equal nothing.
    """
    from difflib import SequenceMatcher

    @F.pandas_udf("double")
    def ratio(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([SequenceMatcher(None, x, y).ratio() if x is not None and y is not None else 0.0 for x, y in zip(a, b)])

    l = left.select(*within, key, *[F.col(t).alias(f"__l{i}") for i, t in enumerate(tiers)])  # noqa: E741
    r = right.select(*[F.col(c).alias(f"__w{i}") for i, c in enumerate(within)], name, *[F.col(t).alias(f"__r{i}") for i, t in enumerate(tiers)])
    on = [F.col(c) == F.col(f"__w{i}") for i, c in enumerate(within)]
    found, rest, last = None, l, len(tiers) - 1
    for i in range(len(tiers)):
        hit = rest.join(r, [*on, F.col(f"__l{i}") == F.col(f"__r{i}")]).groupBy(*within, key).agg(F.min(name).alias(name))
        hit = cut(hit.select(*within, key, name, F.lit(i + 1).alias("tier"), F.lit(1.0).alias("ratio")))
        found = hit if found is None else found.unionByName(hit)
        rest = rest.join(hit, [*within, key], "left_anti")
    near = rest.join(r, on).withColumn("ratio", ratio(f"__l{last}", f"__r{last}")).where(F.col("ratio") >= least)
    near = near.groupBy(*within, key).agg(F.max(F.struct("ratio", F.lit(0))).alias("top"), F.min_by(name, F.struct(-F.col("ratio"), name)).alias(name))
    return found.unionByName(near.select(*within, key, name, F.lit(len(tiers) + 1).alias("tier"), F.col("top.ratio").alias("ratio")))


def best_matches(pairs: DataFrame, members: DataFrame, similarity: Column, top: int = 8) -> DataFrame:
    """(a, b, best1..best3): per pair of groups the greatest of the best matches of a's members in b.

    ``members``: group, rank, payload columns; only the ``top`` of each group
    take part. ``similarity`` speaks of the payload structs ``ma`` and ``mb``.
    """
    m = members.where(F.col("rank") <= top)
    payload = F.struct(*[c for c in members.columns if c not in ("group", "rank")])
    ma = m.select(F.col("group").alias("a"), F.col("rank").alias("ra"), payload.alias("ma"))
    mb = m.select(F.col("group").alias("b"), payload.alias("mb"))
    best = pairs.select("a", "b").distinct().join(ma, "a").join(mb, "b").groupBy("a", "b", "ra").agg(F.max(similarity).alias("s"))
    out = best.groupBy("a", "b").agg(F.sort_array(F.collect_list("s"), asc=False).alias("s"))
    return out.select("a", "b", *[F.coalesce(F.get("s", F.lit(i)), F.lit(0.0)).alias(f"best{i + 1}") for i in range(3)])
