"""Comment trees: nested JSON or parent links to rows with paths, and back."""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.operators.lineage import cut, forget


def _walk(nodes: list, parent: str | None, root: str | None, path: str, depth: int, compat: bool) -> Iterator[tuple]:
    for i, node in enumerate(nodes, 1):
        # a node without id is left out with all below it, but keeps its place in the count
        if not isinstance(node, dict) or not (cid := node.get("id")):
            continue
        cid = str(cid)
        own_root = root or cid
        if compat:
            root = own_root
        at = f"{path}.{i:03d}" if path else f"{i:03d}"
        yield cid, parent, own_root, at, depth, node.get("author"), node.get("content")
        yield from _walk(node.get("replies") or [], cid, own_root, at, depth + 1, compat)


def flatten_comments(df: DataFrame, post_id: str, json_col: str, compat: bool = False) -> DataFrame:
    """(post_id, id, parent_id, root_id, path, depth, author, content) of nested comments, depth first.

    ``json_col``: array of {id, author, content, replies: [...]}. Unreadable or
    null JSON gives no rows. With ``compat`` later top-level comments inherit
    the root of the first.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for p, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                try:
                    nodes = json.loads(text or "[]")
                except ValueError:
                    nodes = []
                out += [(p, *row) for row in _walk(nodes if isinstance(nodes, list) else [], None, None, "", 0, compat)]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], pa.int32() if i == 5 else pa.string()) for i in range(8)], ["post_id", "id", "parent_id", "root_id", "path", "depth", "author", "content"])

    return df.select(F.col(post_id).cast("string"), F.col(json_col)).mapInArrow(run, "post_id string, id string, parent_id string, root_id string, path string, depth int, author string, content string")


def build_paths(edges: DataFrame, node: str, parent: str, order: str) -> DataFrame:
    """(node, root, path, depth) of rows with parent links; siblings in ``order``, then by node.

    Every round doubles how far up each node has looked, so a chain of a
    million takes twenty joins. Nodes whose parents lead to no root (cycles,
    missing parents) are left out. ``node`` is unique.
    """
    from pyspark.sql.window import Window

    w = Window.partitionBy(parent).orderBy(order, node)
    e = edges.select(F.col(node).alias("node"), F.col(parent).alias("up"), F.row_number().over(w).cast("string").alias("i"))
    # seen: the path from below ``up`` to the node, ``depth`` steps so far
    seen = cut(e.select("node", "up", F.col("node").alias("root"), F.lpad("i", F.greatest(F.lit(3), F.length("i")), F.lit("0")).alias("path"), F.lit(0).alias("depth")))
    done, left = -1, -1
    while True:
        n, ended = seen.agg(F.count(F.lit(1)), F.count_if(F.col("up").isNull())).first()
        if ended == n or (ended, n) == (done, left):
            return seen.where("up is null").select("node", "root", "path", "depth")
        done, left = ended, n
        above = seen.select(F.col("node").alias("up"), F.col("up").alias("up2"), F.col("root").alias("r2"), F.col("path").alias("p2"), F.col("depth").alias("d2"))
        # a parent that isn't there ends the search without a root
        open_ = seen.where("up is not null").join(above, "up").select("node", F.col("up2").alias("up"), F.col("r2").alias("root"), F.concat_ws(".", "p2", "path").alias("path"), (F.col("depth") + F.col("d2") + 1).alias("depth"))
        longer = cut(seen.where("up is null").unionByName(open_))
        forget(seen)
        seen = longer
