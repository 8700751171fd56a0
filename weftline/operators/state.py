"""State-changing operators on snapshots: each returns the new snapshot, nothing is changed in place."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.operators import checks
from weftline.operators.lineage import cut
from weftline.operators.relational import keep_first


def upsert(target: DataFrame, source: DataFrame, keys: list[str], *, update: dict[str, Column] | None = None, when: Column | None = None, insert: bool = True, merge: str = "overwrite", check: bool = True) -> DataFrame:
    """``target`` after inserting or updating by ``source``, and ``_action``: inserted, updated, unchanged or kept.

    ``merge``: overwrite takes all source values, sparse only those that
    aren't null, fill only where the target is null. ``update`` gives the new
    value of single columns in terms of ``t.<c>`` and ``s.<c>``; ``when`` guards
    updates in the same terms. ``unchanged`` rows met a source row that changes
    nothing, ``kept`` rows met none or were guarded. Two source rows of one key
    are an error, as they are to a conflict clause.
    """
    if check:
        checks.assert_unique(source, keys)
    cols = [c for c in target.columns if c not in keys]
    t = target.select(*[F.col(k).alias(f"__t_{k}") for k in keys], F.struct(*(cols or keys)).alias("t"), F.lit(1).alias("__t"))
    have = [c for c in cols if c in source.columns]
    s = source.select(*[F.col(k).alias(f"__s_{k}") for k in keys], F.struct(*(have or keys)).alias("s"), F.lit(1).alias("__s"))
    on = [F.col(f"__t_{k}") == F.col(f"__s_{k}") for k in keys]
    j = t.join(s, on, "full" if insert else "left")
    meet = F.col("__t").isNotNull() & F.col("__s").isNotNull()
    act = meet & (F.coalesce(when, F.lit(False)) if when is not None else F.lit(True))
    new = F.col("__t").isNull()
    out, diff = [], F.lit(False)
    for c in cols:
        old, inc = F.col(f"t.{c}"), F.col(f"s.{c}") if c in have else None
        if update and c in update:
            value = update[c]
        elif inc is None:
            value = old
        else:
            value = {"overwrite": inc, "sparse": F.coalesce(inc, old), "fill": F.coalesce(old, inc)}[merge]
        first = inc if inc is not None else (update[c] if update and c in update else F.lit(None))
        out.append(F.when(act, value).when(new, first).otherwise(old).alias(c))
        diff = diff | (act & ~value.eqNullSafe(old))
    action = F.when(new, "inserted").when(diff, "updated").when(act, "unchanged").otherwise("kept")
    return j.select(*[F.coalesce(f"__t_{k}", f"__s_{k}").alias(k) for k in keys], *out, action.alias("_action"))


def insert_new(target: DataFrame, source: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """``target`` and the first source row of each key it lacks; existing rows stay as they are."""
    return target.unionByName(keep_first(source, keys, order).join(target.select(*keys), keys, "left_anti").select(*target.columns))


def update_from(target: DataFrame, source: DataFrame, keys: list[str], cols: list[str], only_changed: bool = True) -> DataFrame:
    """Rows of ``target`` that ``source`` changes: keys, old_<c>, <c>."""
    s = source.select(*keys, *[F.col(c).alias(f"__{c}") for c in cols])
    j = target.join(s, keys)
    if only_changed:
        j = j.where(reduce(lambda a, b: a | b, [~F.col(c).eqNullSafe(F.col(f"__{c}")) for c in cols]))
    return j.select(*keys, *[F.col(c).alias(f"old_{c}") for c in cols], *[F.col(f"__{c}").alias(c) for c in cols])


def scd_apply(known: DataFrame, today: DataFrame, keys: list[str], name: str, as_of: Column) -> DataFrame:
    """Open and closed intervals after a full listing: keys, name, listed, delisted, action.

    ``known``: keys, name, listed, delisted; ``today``: keys, name. A listed
    record that was closed is opened again, a new name replaces the old, a
    record that is gone is closed once.
    """
    t = today.select(*keys, F.col(name).alias("__new"), F.lit(1).alias("__n"))
    j = known.withColumn("__o", F.lit(1)).join(t, keys, "full")
    here, old = F.col("__n").isNotNull(), F.col("__o").isNotNull()
    action = F.when(~old, "listed").when(here & F.col("delisted").isNotNull(), "relisted").when(here & ~F.col(name).eqNullSafe(F.col("__new")) & F.col("__new").isNotNull(), "renamed").when(~here & F.col("delisted").isNull(), "delisted").otherwise("same")
    return j.select(*keys, F.coalesce("__new", name).alias(name), F.coalesce("listed", as_of).alias("listed"), F.when(here, F.lit(None)).otherwise(F.coalesce("delisted", as_of)).alias("delisted"), action.alias("action"))


def find_or_create(children: DataFrame, parents: DataFrame, name: str, parent_id: str) -> tuple[DataFrame, DataFrame]:
    """(children with parent ids, parents with the new ones); a new id is the md5 of its name, so reruns agree."""
    lacking = children.select(name).where(F.col(name).isNotNull()).distinct().join(parents.select(name), name, "left_anti")
    grown = parents.unionByName(lacking.select(F.md5(name).alias(parent_id), name), allowMissingColumns=True)
    return children.drop(parent_id).join(grown.select(name, parent_id), name, "left"), grown


def replace_children(target: DataFrame, source: DataFrame, parent: str, key: list[str], drop_when_empty: DataFrame | None = None) -> DataFrame:
    """Children after a sync: those of parents in ``source`` are replaced by it, others stay.

    A parent without children in ``source`` keeps its own, unless it is listed
    in ``drop_when_empty``.
    """
    synced = source.select(parent).distinct()
    if drop_when_empty is not None:
        synced = synced.unionByName(drop_when_empty.select(parent)).distinct()
    kept = target.join(synced, parent, "left_anti")
    return kept.unionByName(keep_first(source, [parent, *key], [c for c in source.columns if c not in (parent, *key)] or [parent]).select(*target.columns))


def dequeue(queue: DataFrame, due: Column, order: list[Column], n: int) -> DataFrame:
    """The next ``n`` due rows in ``order``: a top-k, not a sort of the queue."""
    return queue.where(due).orderBy(*order).limit(n)


def claim(queue: DataFrame, key: list[str], due: Column, order: list[Column], n: int, changes: dict[str, Column]) -> DataFrame:
    """Queue with the next ``n`` due rows changed (their state, owner, time); single writer."""
    taken = dequeue(queue, due, order, n).select(*key).withColumn("__c", F.lit(1))
    j = queue.join(taken, key, "left")
    return j.select(*[F.when(F.col("__c").isNotNull(), changes[c]).otherwise(F.col(c)).alias(c) if c in changes else F.col(c) for c in queue.columns])


def apply_to(queue: DataFrame, events: DataFrame, key: list[str], changes: dict[str, Column]) -> DataFrame:
    """Queue with the rows named in ``events`` changed: completion, failure, cancellation. Changes may use ``e.<c>``."""
    e = keep_first(events, key, [c for c in events.columns if c not in key] or key).select(*key, F.struct("*").alias("e"))
    j = queue.join(e, key, "left")
    return j.select(*[F.when(F.col("e").isNotNull(), changes[c]).otherwise(F.col(c)).alias(c) if c in changes else F.col(c) for c in queue.columns])


def advance_control(control: DataFrame, facts: DataFrame, name: str, month: str) -> DataFrame:
    """Control table with the greatest month of ``facts`` as the watermark of ``name``; it never goes back."""
    top = facts.agg(F.max(month).alias("last")).select(F.lit(name).alias("name"), "last")
    return control.unionByName(top).groupBy("name").agg(F.max("last").alias("last"))


def apply_cohort(cohort: DataFrame, queues: dict[str, tuple[DataFrame, Column, dict[str, Column]]]) -> dict[str, DataFrame]:
    """Several queues changed by one cohort (k), and ``cohort`` itself: all see the rows it had when this was called.

    ``queues``: name -> (queue, what its rows are named by in the cohort,
    changes). The cohort is written once, so a queue's changes don't move the
    cohort of the next; repeated and null names count once and not at all.
    """
    taken = cut(cohort.select("k").where("k is not null").distinct())
    out = {"cohort": taken}
    for name, (queue, key, changes) in queues.items():
        j = queue.withColumn("__key", key).join(taken.withColumn("__hit", F.lit(1)), F.col("__key") == F.col("k"), "left")
        out[name] = j.select(*[F.when(F.col("__hit").isNotNull(), changes[c]).otherwise(F.col(c)).alias(c) if c in changes else F.col(c) for c in queue.columns])
    return out


def supersede(queue: DataFrame, newer: DataFrame, key: list[str], open_: Column, changes: dict[str, Column]) -> DataFrame:
    """Queue whose open rows change where ``newer`` has work of the same key; rows that aren't open stay."""
    marked = queue.join(newer.select(*key).distinct().withColumn("__newer", F.lit(1)), key, "left")
    hit = F.col("__newer").isNotNull() & F.coalesce(open_, F.lit(False))
    return marked.select(*[F.when(hit, changes[c]).otherwise(F.col(c)).alias(c) if c in changes else F.col(c) for c in queue.columns])
